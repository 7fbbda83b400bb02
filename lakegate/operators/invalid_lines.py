"""Invalid-lines table (SNK-4, QUA-21, RPT-2/5, AGG-3)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakegate.operators.rules import ERRORS, LINE_REJECTED, REJECT, error_codes_text

INVALID_LINE_COLUMNS = ("invalid_line_id", "filename", "rejection_date", "rejection_reason", "error_type",
                        "error_details", "line_number", "raw_data")


def invalid_lines(numbered: DataFrame, business: Sequence[str], *, id_col: str, line_col: str,
                  raw_col: str, rejection_date: Column, file_col: str = "_file_name") -> DataFrame:
    """SNK-4: one row per rejected line (REJECT action or ICT line gate) with the
    reason, the first error code, all error codes, the line number, the raw text
    and the source columns."""
    rej = numbered.filter(F.col(LINE_REJECTED))
    first = F.try_element_at(F.col(ERRORS), F.lit(1))
    return rej.select(
        F.col(id_col).cast("long").alias("invalid_line_id"),
        F.col(file_col).alias("filename"),
        rejection_date.cast("timestamp_ntz").alias("rejection_date"),
        F.when(F.col(REJECT), F.lit("REJECT")).otherwise(F.lit("ICT_DRIVEN")).alias("rejection_reason"),
        first["code"].alias("error_type"),
        error_codes_text().alias("error_details"),
        F.col(line_col).cast("long").alias("line_number"),
        F.col(raw_col).alias("raw_data"),
        *[F.col(f"`{c}`") for c in business],
    )


def summary(invalid: DataFrame, table_name: str) -> DataFrame:
    """RPT-2 / AGG-3: per reason and error type the line count and distinct files."""
    return invalid.groupBy("rejection_reason", "error_type").agg(
        F.count(F.lit(1)).alias("lines"), F.count_distinct("filename").alias("files")
    ).select(F.lit(table_name).alias("table_name"), "*")


def summary_of_tables(invalid: Mapping[str, DataFrame]) -> DataFrame:
    """RPT-2 over all tables: lines and distinct files per table, reason and error type, with subtotals per reason,
    per table and over all (``level`` 0 to 3; the columns summed over are NULL). One rollup, one shuffle."""
    parts = [df.select(F.lit(t).alias("table_name"), "rejection_reason", "error_type", "filename") for t, df in invalid.items()]
    return reduce(DataFrame.unionByName, parts).rollup("table_name", "rejection_reason", "error_type").agg(
        F.bit_count(F.grouping_id()).cast("int").alias("level"), F.count(F.lit(1)).alias("lines"),
        F.count_distinct("table_name", "filename").alias("files"))


def latest(invalid: DataFrame, n: int = 10) -> DataFrame:
    """SRT-2: the latest ``n`` invalid lines (a top-k report) with their ``rank``."""
    order = [F.desc("rejection_date"), F.asc("filename"), F.asc("line_number")]
    return invalid.orderBy(*order).limit(n).withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def by_file(invalid: DataFrame) -> DataFrame:
    """RPT-5: invalid lines per file."""
    return invalid.groupBy("filename").agg(F.count(F.lit(1)).alias("lines"))


def count_lines(invalid: DataFrame) -> DataFrame:
    """QUA-21: number of invalid lines."""
    return invalid.agg(F.count(F.lit(1)).alias("invalid_lines"))
