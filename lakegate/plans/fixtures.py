"""Dirty landing views built from the driver tables, plus their specification sheets.

A "dirty view" is what an ingestion job sees after reading landed text files:
every business column is text, some cells carry known faults, and each row
belongs to a (virtual) landed file named after its month.  Each view exists in
two spellings that were checked to be equal row for row: a Spark DataFrame and
a DuckDB SQL text used by the oracle queries.

All views cover the whole source table; the modulo expressions only choose
which cells carry a fault, they never drop rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegate.session import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; spread over all cores when its file has fewer row groups than cores."""
    return spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def _money_text(c) -> F.Column:
    """double -> DECIMAL(18,2) text with a decimal comma (engines print doubles differently)."""
    return F.replace(c.cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(","))


# ------------------------------------------------------------------ orders
def dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        k.alias("_line_order"),
        F.concat(F.lit("orders_"), F.date_format("o_orderdate", "yyyyMM"), F.lit("01.csv")).alias("_file_name"),
        k.cast("string").alias("orderkey"),
        F.when(k % 11 == 0, F.lit("")).when(k % 13 == 0, F.lit("bad"))
         .otherwise(F.col("o_custkey").cast("string")).alias("custkey"),
        F.when(k % 17 == 0, F.lit("N/A")).otherwise(_money_text(F.col("o_totalprice"))).alias("totalprice"),
        F.when(k % 19 == 0, F.lit("31/02/1997"))
         .otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")).alias("orderdate"),
        F.when(k % 23 == 0, F.lit("")).otherwise(F.col("o_orderstatus")).alias("orderstatus"),
        F.col("o_orderpriority").alias("orderpriority"),
    )


DIRTY_ORDERS_SQL = """
SELECT o_orderkey AS _line_order,
       'orders_' || strftime(o_orderdate, '%Y%m') || '01.csv' AS _file_name,
       CAST(o_orderkey AS VARCHAR) AS orderkey,
       CASE WHEN o_orderkey % 11 = 0 THEN '' WHEN o_orderkey % 13 = 0 THEN 'bad'
            ELSE CAST(o_custkey AS VARCHAR) END AS custkey,
       CASE WHEN o_orderkey % 17 = 0 THEN 'N/A'
            ELSE replace(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',') END AS totalprice,
       CASE WHEN o_orderkey % 19 = 0 THEN '31/02/1997' ELSE strftime(o_orderdate, '%d/%m/%Y') END AS orderdate,
       CASE WHEN o_orderkey % 23 = 0 THEN '' ELSE o_orderstatus END AS orderstatus,
       o_orderpriority AS orderpriority
FROM orders
"""

ORDERS_TABLE_ROWS = [{
    "Delta Table Name": "orders",
    "Filename Pattern": "orders_<yyyy><mm><dd>.csv",
    "Input Format": "csv",
    "Input delimiter": ";",
    "Input charset": "UTF-8",
    "Input header": "FIRST_LINE",
    "Ingestion mode": "DELTA_FROM_NON_HISTORIZED",
    "Last Table Name": "nan",
    "Invalid column per line tolerance": "30%",
    "Rejected line per file tolerance": "7%",
    "Partitioning": "yyyy/mm",
}]

ORDERS_COLUMN_ROWS = [
    {"Delta Table Name": "orders", "Column Name": "orderkey", "Field type": "LONG",
     "Is Nullable": "false", "Error action": "ICT_DRIVEN", "Is Special": "IsMergeKey",
     "Comment": "order number"},
    {"Delta Table Name": "orders", "Column Name": "custkey", "Field type": "LONG",
     "Is Nullable": "false", "Error action": "ICT_DRIVEN", "Rejected line per file tolerance": "20%"},
    {"Delta Table Name": "orders", "Column Name": "totalprice", "Field type": "DECIMAL",
     "Is Nullable": "false", "Error action": "REJECT"},
    {"Delta Table Name": "orders", "Column Name": "orderdate", "Field type": "DATE",
     "Transformation Type": "date", "Transformation pattern": "dd/MM/yyyy",
     "Is Nullable": "false", "Error action": "ICT_DRIVEN", "Is Special": "IsStartValidity",
     "Rejected line per file tolerance": "10%"},
    {"Delta Table Name": "orders", "Column Name": "orderstatus", "Field type": "STRING",
     "Transformation Type": "lowercase", "Is Nullable": "false", "Error action": "LOG_ONLY"},
    {"Delta Table Name": "orders", "Column Name": "orderpriority", "Field type": "STRING",
     "Transformation Type": "regex", "Transformation pattern": "^[0-9]+-",
     "Regex replacement": "nan", "Is Nullable": "true", "Error action": "nan"},
]


# ---------------------------------------------------------------- lineitem
def dirty_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    k = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    return li.select(
        k.alias("_line_order"),
        F.concat(F.lit("lineitem_"), F.date_format("l_shipdate", "yyyyMM"), F.lit("01.csv")).alias("_file_name"),
        F.col("l_orderkey").cast("string").alias("orderkey"),
        F.col("l_linenumber").cast("string").alias("linenumber"),
        F.when(k % 29 == 0, F.lit("x")).otherwise(F.col("l_partkey").cast("string")).alias("partkey"),
        F.col("l_suppkey").cast("string").alias("suppkey"),
        F.when(k % 31 == 0, F.lit("")).otherwise(_money_text(F.col("l_quantity"))).alias("quantity"),
        F.when(k % 37 == 0, F.lit("n/a")).otherwise(_money_text(F.col("l_extendedprice"))).alias("extendedprice"),
        _money_text(F.col("l_discount")).alias("discount"),
        _money_text(F.col("l_tax")).alias("tax"),
        F.col("l_returnflag").alias("returnflag"),
        F.col("l_linestatus").alias("linestatus"),
        F.when(k % 41 == 0, F.lit("2024-13-01"))
         .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("shipdate"),
    )


DIRTY_LINEITEM_SQL = """
SELECT l_orderkey * 8 + l_linenumber AS _line_order,
       'lineitem_' || strftime(l_shipdate, '%Y%m') || '01.csv' AS _file_name,
       CAST(l_orderkey AS VARCHAR) AS orderkey,
       CAST(l_linenumber AS VARCHAR) AS linenumber,
       CASE WHEN (l_orderkey * 8 + l_linenumber) % 29 = 0 THEN 'x' ELSE CAST(l_partkey AS VARCHAR) END AS partkey,
       CAST(l_suppkey AS VARCHAR) AS suppkey,
       CASE WHEN (l_orderkey * 8 + l_linenumber) % 31 = 0 THEN ''
            ELSE replace(CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR), '.', ',') END AS quantity,
       CASE WHEN (l_orderkey * 8 + l_linenumber) % 37 = 0 THEN 'n/a'
            ELSE replace(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',') END AS extendedprice,
       replace(CAST(CAST(l_discount AS DECIMAL(18,2)) AS VARCHAR), '.', ',') AS discount,
       replace(CAST(CAST(l_tax AS DECIMAL(18,2)) AS VARCHAR), '.', ',') AS tax,
       l_returnflag AS returnflag,
       l_linestatus AS linestatus,
       CASE WHEN (l_orderkey * 8 + l_linenumber) % 41 = 0 THEN '2024-13-01'
            ELSE strftime(l_shipdate, '%Y-%m-%d') END AS shipdate
FROM lineitem
"""

LINEITEM_TABLE_ROWS = [{
    "Delta Table Name": "lineitem", "Filename Pattern": "lineitem_<yyyy><mm><dd>.csv",
    "Input Format": "csv", "Input delimiter": ",", "Input header": "HEADER_USE",
    "Ingestion mode": "FULL_KEY_REPLACE",
    "Invalid column per line tolerance": "10%", "Rejected line per file tolerance": "5%",
}]

LINEITEM_COLUMN_ROWS = [
    {"Delta Table Name": "lineitem", "Column Name": "orderkey", "Field type": "LONG",
     "Is Nullable": "false", "Is Special": "IsMergeKey"},
    {"Delta Table Name": "lineitem", "Column Name": "linenumber", "Field type": "INTEGER",
     "Is Nullable": "false", "Is Special": "IsMergeKey"},
    {"Delta Table Name": "lineitem", "Column Name": "partkey", "Field type": "LONG",
     "Is Nullable": "false", "Error action": "ICT_DRIVEN"},
    {"Delta Table Name": "lineitem", "Column Name": "suppkey", "Field type": "LONG"},
    {"Delta Table Name": "lineitem", "Column Name": "quantity", "Field type": "DECIMAL(18,2)",
     "Is Nullable": "false", "Error action": "LOG_ONLY"},
    {"Delta Table Name": "lineitem", "Column Name": "extendedprice", "Field type": "DECIMAL(18,2)",
     "Is Nullable": "false", "Error action": "REJECT"},
    {"Delta Table Name": "lineitem", "Column Name": "discount", "Field type": "DECIMAL(18,2)"},
    {"Delta Table Name": "lineitem", "Column Name": "tax", "Field type": "DECIMAL(18,2)"},
    {"Delta Table Name": "lineitem", "Column Name": "returnflag", "Field type": "STRING",
     "Transformation Type": "lowercase"},
    {"Delta Table Name": "lineitem", "Column Name": "linestatus", "Field type": "STRING"},
    {"Delta Table Name": "lineitem", "Column Name": "shipdate", "Field type": "DATE",
     "Transformation pattern": "yyyy-MM-dd", "Is Nullable": "false", "Error action": "ICT_DRIVEN",
     "Is Special": "IsStartValidity"},
]


# ------------------------------------------------------- second orders batch
def orders_batch2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Next landing of open orders: same keys, price +1.00, one file dated later.

    Open orders ('O') are the rows a source system re-sends; the batch covers all
    of them.
    """
    o = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "O")
    return o.select(
        F.col("o_orderkey").alias("_line_order"),
        F.lit("orders_20990101.csv").alias("_file_name"),
        F.col("o_orderkey").cast("string").alias("orderkey"),
        F.col("o_custkey").cast("string").alias("custkey"),
        _money_text(F.col("o_totalprice") + F.lit(1)).alias("totalprice"),
        F.date_format(F.date_add(F.col("o_orderdate").cast("date"), 30), "dd/MM/yyyy").alias("orderdate"),
        F.lit("F").alias("orderstatus"),
        F.col("o_orderpriority").alias("orderpriority"),
    )


ORDERS_BATCH2_SQL = """
SELECT o_orderkey AS _line_order,
       'orders_20990101.csv' AS _file_name,
       CAST(o_orderkey AS VARCHAR) AS orderkey,
       CAST(o_custkey AS VARCHAR) AS custkey,
       replace(CAST(CAST(o_totalprice + 1 AS DECIMAL(18,2)) AS VARCHAR), '.', ',') AS totalprice,
       strftime(CAST(o_orderdate AS DATE) + INTERVAL 30 DAY, '%d/%m/%Y') AS orderdate,
       'F' AS orderstatus,
       o_orderpriority AS orderpriority
FROM orders WHERE o_orderstatus = 'O'
"""
