"""Registered queries: one per operator family of the inventory.

Each query takes ``(spark, sf_dir)``, reads the driver tables below ``sf_dir``
(whole tables, no subsets) and returns a DataFrame without running it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegate.functions import dates as fd
from lakegate.functions import text as ft
from lakegate.operators import files as fl
from lakegate.operators import invalid_lines as il
from lakegate.operators import modes as md
from lakegate.operators import projections as pj
from lakegate.operators import quality as qa
from lakegate.operators import tracking as tk
from lakegate.operators.gates import TO_ALL, TO_LAST, GateParams, file_decisions, file_stats
from lakegate.operators.rules import N_ICT, explode_errors, validate
from lakegate.plans import common as cm
from lakegate.plans import fixtures as fx
from lakegate.plans import landings as ld
from lakegate.plans import reports as rp
from lakegate.plans.specs import ColumnRule, normalise_table_sheet, resolve_table_config, table_sheet
from lakegate.session import scratch_path
from lakegate.sources import archives as ar
from lakegate.sources import delimited as dl
from lakegate.sources import landing as lg
from lakegate.streaming import staging as st

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


ORDER_VALUES = ["orderkey", "custkey", "totalprice", "orderdate", "orderstatus", "orderpriority"]


# ---------------------------------------------------------------- rules (A)
@query("typed_orders")
def typed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QUA-1/2/4/5/13/14, PRJ-5/7: dirty orders text -> typed columns + line decisions."""
    v = cm.validated(spark, sf_dir, "orders")
    return v.select("_file_name", "_line_order", *ORDER_VALUES, *cm.line_summary_columns())


@query("typed_lineitem")
def typed_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = cm.validated(spark, sf_dir, "lineitem")
    cols = ["orderkey", "linenumber", "partkey", "suppkey", "quantity", "extendedprice", "discount", "tax",
            "returnflag", "linestatus", "shipdate"]
    return v.select("_file_name", "_line_order", *cols, *[c for c in cm.line_summary_columns()])


@query("error_rows")
def error_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QUA-6/7/8 error table: one row per recorded error."""
    v = cm.validated(spark, sf_dir, "orders")
    return explode_errors(v, ["_file_name", "_line_order"])


@query("ict_lines")
def ict_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QUA-10: lines with ICT_DRIVEN errors and the ICT line decision."""
    v = cm.validated(spark, sf_dir, "orders")
    return v.filter(F.col(N_ICT) > 0).select("_file_name", "_line_order", F.col(N_ICT).alias("n_ict"),
                                              F.col("_ict_rejected").alias("ict_rejected"),
                                              F.col("_line_rejected").alias("line_rejected"))


def _decisions(spark: SparkSession, sf_dir: str, params: GateParams | None = None) -> DataFrame:
    trule, crules = cm.rules_for(spark, "orders")
    v = cm.validated(spark, sf_dir, "orders")
    return file_decisions(file_stats(v, crules), crules, params or GateParams(rlt=trule.rlt))


@query("rlt_files")
def rlt_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QUA-9/11: per-file tolerance decisions."""
    return _decisions(spark, sf_dir).drop("rows_to_last", "rows_to_all")


@query("fail_fast")
def fail_fast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QUA-12: error share per file against the fail-fast threshold (30 %) -> 000000007."""
    trule, _ = cm.rules_for(spark, "orders")
    d = _decisions(spark, sf_dir, GateParams(rlt=trule.rlt, fail_fast_enabled=True, fail_fast_threshold=30))
    return d.select("_file_name", "total_lines", "error_lines", "fail_fast", "file_reason", "file_status")


@query("column_abort")
def column_abort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QUA-9: invalid share per ICT_DRIVEN column against its tolerance."""
    trule, crules = cm.rules_for(spark, "orders")
    v = cm.validated(spark, sf_dir, "orders")
    s = file_stats(v, crules)
    d = file_decisions(s, crules, GateParams(rlt=trule.rlt))
    return d.join(s.select("_file_name", "invalid_custkey", "invalid_orderdate"), "_file_name") \
        .select("_file_name", "total_lines", "invalid_custkey", "invalid_orderdate", "aborted_columns")


# ---------------------------------------------------------------- reports (F)
@query("quality_log")
def quality_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RPT-4: per file total / valid / invalid rows (the flagship query)."""
    return rp.quality_log(_decisions(spark, sf_dir), "orders")


@query("execution_report")
def execution_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RPT-3: per file processed / rejected / written rows and status."""
    _, decisions = cm.routed(spark, sf_dir, "orders")
    return rp.execution_report(decisions, "orders")


# ------------------------------------------------------------ file gates (B)


@query("file_manifest_orders")
def file_manifest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FIL-1, FIL-8, SCA-3/4, SRC-2 over the landed file names."""
    return fl.describe_files(cm.landing_manifest(spark, sf_dir))


def generated_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names built from every distinct order date: valid, month 13, day 32,
    30 February, year 200 years back, and an undated name."""
    o = fx.table(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("d")).distinct()
    ymd = F.date_format("d", "yyyyMMdd")
    y = F.date_format("d", "yyyy")
    names = F.array(
        F.concat(F.lit("orders_"), ymd, F.lit(".csv")),
        F.concat(F.lit("orders_"), y, F.lit("13"), F.date_format("d", "dd"), F.lit(".csv")),
        F.concat(F.lit("orders_"), F.date_format("d", "yyyyMM"), F.lit("32.csv")),
        F.concat(F.lit("orders_"), y, F.lit("0230.csv")),
        F.concat(F.lit("orders_"), (F.year("d") - 200).cast("string"), F.date_format("d", "MMdd"), F.lit(".csv")),
        F.concat(F.lit("orders_extra_"), F.date_format("d", "dd"), F.lit(".csv")),
    )
    return o.select(F.explode(names).alias("filename")).distinct()


@query("filename_date_gate")
def filename_date_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FIL-2 (undated passes) and FIL-3 (date required)."""
    g = fl.date_gate(generated_names(spark, sf_dir))
    from lakegate.functions.dates import filename_date_reason
    return g.select("filename", "date_reason", "date_error_code",
                    filename_date_reason(F.col("filename"), require_date=True).alias("strict_reason"))


TABLE_CONF_ROWS = [
    {"Delta Table Name": "orders", "Filename Pattern": "orders_<yyyy><mm><dd>.csv", "last_table_name_conf": "nan"},
    {"Delta Table Name": "lineitem", "Filename Pattern": "lineitem_<yyyy><mm><dd>.csv",
     "delta_table_name_conf": "li", "last_table_name_conf": "lineitem_current"},
    {"Delta Table Name": "ordersarchive", "Filename Pattern": "<yyyy><mm><dd>.csv"},
]


def table_conf(spark: SparkSession) -> DataFrame:
    return normalise_table_sheet(table_sheet(spark, TABLE_CONF_ROWS))


def name_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each landed name as sent, with a capitalised and an upper-case first part."""
    m = cm.landing_manifest(spark, sf_dir).select("filename")
    first = F.substring_index("filename", "_", 1)
    rest = F.expr("substring(filename, length(substring_index(filename, '_', 1)) + 1)")
    variants = F.array(F.col("filename"), F.concat(F.initcap(first), rest), F.concat(F.upper(first), rest))
    return m.select(F.explode(variants).alias("filename")).distinct()


@query("fix_part_gate")
def fix_part_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FIL-4/5/6: case-sensitive fixed part vs the configured file-name pattern."""
    files = fl.describe_files(name_variants(spark, sf_dir)).select("filename", "table_name")
    g = fl.fix_part_gate(files, table_conf(spark))
    return g.select("filename", "table_name", "fix_part_expected", "fix_part_actual", "fix_part_reason",
                    "fix_part_error_code")


@query("table_names")
def table_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FIL-18 + MOD-7: config row of each landed file's table (exact, then contained
    name) and the resolved `_all` / `_last` table names."""
    m = cm.landing_manifest(spark, sf_dir).select("filename")
    arch = m.select(F.regexp_replace("filename", "^orders_", "ordersarchive_").alias("filename"))
    other = m.select(F.regexp_replace("filename", "^orders_", "orders2_").alias("filename"))
    files = fl.describe_files(m.unionByName(arch).unionByName(other).distinct()).select("filename", "table_name")
    r = resolve_table_config(files, table_conf(spark), allow_substring=True)
    return r.select("filename", "table_name", F.col("cfg_table_name").alias("config_table"),
                    F.col("cfg_all_table").alias("all_table"), F.col("cfg_last_table").alias("last_table"))


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = fl.describe_files(cm.landing_manifest(spark, sf_dir))
    return fl.history_checks(files, cm.tracking_history(spark, sf_dir))


@query("file_validation")
def file_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FIL-10: duplicate and order checks together, first error code wins."""
    return _history(spark, sf_dir).select("filename", "table_name", "file_date", "is_duplicate", "is_late",
                                          F.size("errors").alias("n_errors"), "error_code", "valid")


@query("duplicate_files")
def duplicate_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FIL-7 / JOI-3: files already registered as SUCCESS for their table."""
    h = _history(spark, sf_dir).filter("is_duplicate")
    return h.select("filename", "table_name", F.lit("000000002").alias("error_code"),
                    F.filter("errors", lambda e: e["code"] == "000000002")[0]["message"].alias("message"))


@query("file_order_gate")
def file_order_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FIL-9 / JOI-5 / AGG-4: file date vs the table's latest SUCCESS date."""
    return _history(spark, sf_dir).select("filename", "table_name", "file_date", "last_date", "is_late")


def _tracking_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = tk.registrations(cm.run_outcomes(spark, sf_dir).withColumn("row_count", F.col("rows_ingested")),
                           cm.as_of())
    return cm.tracking_history(spark, sf_dir).unionByName(new)


@query("tracking_register")
def tracking_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FIL-11: tracking rows written by the run (every outcome, explicit schema)."""
    return tk.registrations(cm.run_outcomes(spark, sf_dir).withColumn("row_count", F.col("rows_ingested")),
                            cm.as_of())


@query("tracking_summary")
def tracking_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RPT-1 / AGG-1: registrations per status after the run."""
    return tk.status_counts(_tracking_after(spark, sf_dir))


@query("tracking_summary_ranked")
def tracking_summary_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRT-1: registrations per status, the most frequent first."""
    return tk.ranked(tk.status_counts(_tracking_after(spark, sf_dir)), "count", "status")


@query("tracking_by_table")
def tracking_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-2: files, rows, successes and failures per table."""
    return tk.by_table(_tracking_after(spark, sf_dir))


@query("tracking_latest10")
def tracking_latest10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRT-2: the ten latest registrations (a top-k report)."""
    return tk.latest(_tracking_after(spark, sf_dir), 10)


@query("tracking_retention")
def tracking_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FIL-13: tracking rows kept by a 90-day retention at the run date."""
    return tk.retain(_tracking_after(spark, sf_dir), cm.as_of(), 90)


@query("quarantine_manifest")
def quarantine_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FIL-14: rejected files with code and reason."""
    o = cm.run_outcomes(spark, sf_dir).filter(F.col("status") == "FAILED")
    return fl.quarantine(o, cm.as_of())


@query("completeness_check")
def completeness_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FIL-17: received = ingested + ignored + rejected + technical errors, per table."""
    received = fl.describe_files(cm.landing_manifest(spark, sf_dir)).select("table_name", "filename")
    return rp.completeness(received, cm.run_outcomes(spark, sf_dir))


@query("run_status")
def run_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RPT-7: per table file/row counts and SUCCESS / PARTIAL / NO_DATA / ERROR."""
    return rp.run_status(cm.run_outcomes(spark, sf_dir))


@query("empty_files")
def empty_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FIL-16: expected orders files (one per shipping month in lineitem) without lines."""
    li = fx.table(spark, sf_dir, "lineitem")
    expected = li.select(F.concat(F.lit("orders_"), F.date_format("l_shipdate", "yyyyMM"),
                                  F.lit("01.csv")).alias("filename")).distinct()
    lines = fx.dirty_orders(spark, sf_dir).select("_file_name")
    return fl.empty_files(expected, lines).select("filename", "lines", "is_empty")


@query("column_count_gate")
def column_count_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FIL-15: ';'-delimited customer lines (one file per nation) vs 5 configured columns;
    every 50th customer line carries an extra field."""
    from lakegate.operators.gates import column_count_gate as ccg
    c = fx.table(spark, sf_dir, "customer")
    text = F.concat_ws(";", F.col("c_custkey").cast("string"), "c_name", F.col("c_nationkey").cast("string"),
                       F.col("c_acctbal").cast("decimal(18,2)").cast("string"), "c_mktsegment")
    text = F.when(F.col("c_custkey") % 50 == 0, F.concat(text, F.lit(";extra"))).otherwise(text)
    lines = c.select(F.concat(F.lit("customer_"), F.col("c_nationkey").cast("string"), F.lit(".csv")).alias("_file_name"),
                     text.alias("line"))
    return ccg(lines, "line", ";", 5)


# ------------------------------------------------- projections & quality (C/D)

HEADER_CASES = ["ORDERKEY", "CustKey", "totalprice", "OrderDate", " orderstatus ", "orderpriority"]


@query("header_line_filter")
def header_line_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-4 (D6): each file gets a header line (names in mixed case) and a near-header
    line (one cell differs); only the real header is dropped."""
    d = fx.dirty_orders(spark, sf_dir)
    files = d.select("_file_name").distinct()
    header = files.select("_file_name", F.lit(-1).cast("long").alias("_line_order"),
                          *[F.lit(v).alias(c) for v, c in zip(HEADER_CASES, ORDER_VALUES)])
    near = files.select("_file_name", F.lit(-2).cast("long").alias("_line_order"),
                        *[F.lit(v if c != "totalprice" else None).alias(c) for v, c in zip(HEADER_CASES, ORDER_VALUES)])
    allrows = d.unionByName(header).unionByName(near)
    kept = pj.drop_header_lines(allrows, ORDER_VALUES)
    return kept.groupBy("_file_name").agg(F.count(F.lit(1)).alias("lines_kept"),
                                           F.count_if(F.col("_line_order") < 0).alias("header_like_kept"))


@query("positional_rename")
def positional_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-2: a header-less read gives _c0.._c11 (out of string order); names come from
    the configured order."""
    li = fx.dirty_lineitem(spark, sf_dir)
    names = ["orderkey", "linenumber", "partkey", "suppkey", "quantity", "extendedprice", "discount", "tax",
             "returnflag", "linestatus", "shipdate"]
    pos = li.select("_file_name", *[F.col(c).alias(f"_c{i}") for i, c in enumerate(names)])
    shuffled = pos.select("_file_name", *[f"_c{i}" for i in sorted(range(len(names)), key=str)])
    return pj.positional_rename(shuffled, names)


@query("lowercase_names")
def lowercase_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-1: names from a HEADER_USE file in upper case are lower-cased (technical '_' kept)."""
    d = fx.dirty_orders(spark, sf_dir)
    upper = d.select("_file_name", *[F.col(c).alias(c.upper()) for c in ORDER_VALUES])
    return pj.lowercase_names(upper)


@query("missing_columns")
def missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-6 / QUA-17: files sent without `orderpriority` -> one INFO row per file."""
    d = fx.dirty_orders(spark, sf_dir).drop("orderpriority")
    return pj.missing_column_report(d, d.columns, ORDER_VALUES, "orders")


@query("date_strict")
def date_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QUA-2 / SCA-6: one pattern, no fallback; standard output text."""
    d = fx.dirty_orders(spark, sf_dir)
    parsed = F.when(~ft.is_blank("orderdate"), fd.parse_strict("orderdate", "dd/MM/yyyy"))
    return d.select("_line_order", F.col("orderdate").alias("raw"), parsed.alias("parsed"),
                    fd.to_output_text(parsed).alias("output_text"),
                    (~ft.is_blank("orderdate") & parsed.isNull()).alias("is_error"))


@query("date_multi_default")
def date_multi_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QUA-3 / QUA-18: several patterns, first match wins, else the default date;
    EMPTY_DATE / INVALID_DATE logged."""
    li = fx.dirty_lineitem(spark, sf_dir)
    o = fx.dirty_orders(spark, sf_dir)
    raw = li.select(F.col("_line_order"), F.lit("lineitem").alias("src"), F.col("shipdate").alias("raw")) \
        .unionByName(o.select("_line_order", F.lit("orders").alias("src"), F.col("orderdate").alias("raw")))
    pats = ["yyyy-MM-dd", "dd/MM/yyyy"]
    first = fd.parse_multi("raw", pats)
    out = fd.parse_multi("raw", pats, default="1900-01-01 00:00:00")
    status = (F.when(first.isNull() & ft.is_blank("raw"), F.lit("EMPTY_DATE"))
              .when(first.isNull(), F.lit("INVALID_DATE")))
    return raw.select("src", "_line_order", "raw", out.alias("parsed"), status.alias("error_message"))


@query("text_transforms")
def text_transforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCA-1/2/5: uppercase, lowercase, regex replace (empty replacement deletes), trim."""
    c = fx.table(spark, sf_dir, "customer")
    return c.select(
        "c_custkey",
        ft.transform(F.col("c_mktsegment"), "lowercase").alias("segment_lower"),
        ft.transform(F.col("c_name"), "uppercase").alias("name_upper"),
        ft.transform(F.col("c_name"), "regex", "#0*", "").alias("name_regex"),
        ft.transform(F.col("c_name"), "regex", "[0-9]", "9").alias("name_digits"),
        F.length(F.trim(F.col("c_name"))).alias("name_length"),
    )


@query("filename_enrich")
def filename_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-10 'filename-modified': a new column = regex match on the file name."""
    from lakegate.plans.specs import ColumnRule
    d = fx.dirty_orders(spark, sf_dir)
    rules = [ColumnRule("orderkey", "LONG", nullable=False),
             ColumnRule("file_suffix", enrich="filename-modified", pattern=".{12}$"),
             ColumnRule("file_month", enrich="filename-modified", pattern="[0-9]{6}")]
    v = validate(d, rules)
    return v.select("_file_name", "orderkey", "file_suffix", "file_month")


def _numbered_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty orders with their dense line number within each landed file."""
    d = fx.dirty_orders(spark, sf_dir)
    return qa.dense_line_numbers(d, ["_file_name"], ["_line_order"], "line_number")


@query("line_numbers")
def line_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QUA-20 / WIN-1: dense 1..n line numbers per file (skew-safe)."""
    return _numbered_orders(spark, sf_dir).select("_file_name", "_line_order", "line_number")


def _invalid_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    trule, crules = cm.rules_for(spark, "orders")
    v = validate(_numbered_orders(spark, sf_dir), crules, ict=trule.ict, raw_data_sep=";")
    rejected_on = F.to_timestamp_ntz(F.concat(F.regexp_extract("_file_name", r"(\d{8})", 1), F.lit("000000")),
                                     F.lit("yyyyMMddHHmmss")) + F.expr("INTERVAL 1 DAY")
    return il.invalid_lines(v, ORDER_VALUES, id_col="_line_order", line_col="line_number", raw_col="_raw_data",
                            rejection_date=rejected_on)


@query("invalid_lines")
def invalid_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-4: the invalid-lines table of the orders landing."""
    return _invalid_orders(spark, sf_dir)


@query("invalid_lines_summary")
def invalid_lines_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RPT-2 / RPT-5 / AGG-3: lines and distinct files per reason and error type."""
    return il.summary(_invalid_orders(spark, sf_dir), "orders")


@query("invalid_lines_latest10")
def invalid_lines_latest10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRT-2 / RPT-2: the ten latest invalid lines (a top-k report)."""
    return il.latest(_invalid_orders(spark, sf_dir), 10).select(
        "filename", "line_number", "rejection_date", "rejection_reason", "error_type", "rank")


@query("invalid_lines_by_file_ranked")
def invalid_lines_by_file_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RPT-5: files by their number of invalid lines, the worst first."""
    return tk.ranked(il.by_file(_invalid_orders(spark, sf_dir)), "lines", "filename")


RETENTION_AS_OF = "1998-09-01 00:00:00"


@query("invalid_lines_retention")
def invalid_lines_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QUA-21: invalid lines kept by a 30-day retention on 1998-09-01 (a new version)."""
    inv = _invalid_orders(spark, sf_dir)
    return tk.retain(inv, F.lit(RETENTION_AS_OF).cast("timestamp_ntz"), 30, date_col="rejection_date") \
        .select("invalid_line_id", "filename", "rejection_date", "line_number")


@query("error_sample_top")
def error_sample_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QUA-19: the first 3 errors of each (file, column) by line order (a sampling report)."""
    e = error_rows(spark, sf_dir)
    return qa.top_n_per_group(e, ["_file_name", "column"], ["_line_order"], 3) \
        .select("_file_name", "column", "sample_rank", "_line_order", "code", "raw_value")


@query("null_checks")
def null_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QUA-14: NULL_VALUE errors per file and column."""
    e = error_rows(spark, sf_dir).filter(F.col("code") == "NULL_VALUE")
    return e.groupBy("_file_name", "column", "action").agg(F.count(F.lit(1)).alias("null_values"))


@query("type_mismatch")
def type_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QUA-13: unparsable values per column (count, distinct raw values, smallest example)."""
    e = error_rows(spark, sf_dir).filter(F.col("code").isin("TYPE_MISMATCH", "DATE_PARSE_ERROR"))
    return e.groupBy("column", "code").agg(F.count(F.lit(1)).alias("errors"),
                                           F.count_distinct("raw_value").alias("distinct_values"),
                                           F.min("raw_value").alias("example"))


@query("duplicate_keys")
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QUA-15: customers with more than one order line in the landing."""
    v = cm.validated(spark, sf_dir, "orders")
    return qa.duplicate_keys(v, ["custkey"], "orders")


@query("all_null_columns")
def all_null_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QUA-16: per file non-null counts and FILE_EMPTY when every column is NULL."""
    v = cm.validated(spark, sf_dir, "orders")
    return qa.null_profile(v, ORDER_VALUES)


# ----------------------------------------------------------------- modes (E)

TECH_AND_VALUES = ["FILE_LINE_ID", "FILE_NAME_RECEIVED", "FILE_EXTRACTION_DATE", "FILE_PROCESS_DATE", *ORDER_VALUES]


def orders_batch(spark: SparkSession, sf_dir: str, second: bool = False) -> tuple[DataFrame, DataFrame]:
    """(`_last` rows, `_all` rows) of one accepted orders landing, technical columns first.

    Batch 1 = the dirty orders landing processed the day before the run date;
    batch 2 = the re-sent open orders processed on the run date.
    """
    dirty = fx.orders_batch2(spark, sf_dir) if second else fx.dirty_orders(spark, sf_dir)
    numbered = qa.dense_line_numbers(dirty, ["_file_name"], ["_line_order"], "line_number")
    routed, _ = cm.routed(spark, sf_dir, "orders", dirty=numbered)
    processed = cm.as_of() if second else cm.as_of() - F.expr("INTERVAL 1 DAY")

    def tech(df: DataFrame) -> DataFrame:
        return pj.with_technical_columns(df, ORDER_VALUES, line_col="line_number", file_col="_file_name",
                                         extraction_date=fd.file_date(F.col("_file_name")), process_date=processed)
    return tech(routed.filter(F.col(TO_LAST))), tech(routed.filter(F.col(TO_ALL)))


@query("mode_full_snapshot")
def mode_full_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MOD-1: after two snapshots `_last` is the second batch, `_all` holds both."""
    first = md.full_snapshot(None, None, orders_batch(spark, sf_dir)[0])
    both = md.full_snapshot(first.last, first.all, orders_batch(spark, sf_dir, second=True)[0])
    return both.last.withColumn("kept_in", F.lit("last")).unionByName(both.all.withColumn("kept_in", F.lit("all")))


@query("mode_delta_flow")
def mode_delta_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MOD-2: `_all` after two flow batches (`_last` is never written)."""
    l1, a1 = orders_batch(spark, sf_dir)
    l2, a2 = orders_batch(spark, sf_dir, second=True)
    r1 = md.delta_from_flow(None, None, a1)
    return md.delta_from_flow(r1.last, r1.all, a2).all


@query("mode_upsert")
def mode_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MOD-3: `_last` after upserting batch 2 on orderkey, compared by orderdate."""
    _, crules = cm.rules_for(spark, "orders")
    from lakegate.plans.specs import merge_keys, start_validity_column
    l1, _ = orders_batch(spark, sf_dir)
    l2, _ = orders_batch(spark, sf_dir, second=True)
    return md.upsert(l1, l2, merge_keys(crules), start_validity_column(crules))


@query("mode_full_snapshot_files")
def mode_full_snapshot_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MOD-1 over a batch of many dated files: `_last` is the newest file's rows."""
    l1, _ = orders_batch(spark, sf_dir)
    return md.full_snapshot(None, None, md.newest_file(l1)).last


@query("mode_key_replace_files")
def mode_key_replace_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MOD-5 over many dated files: per custkey the rows of the newest file that holds it."""
    l1, _ = orders_batch(spark, sf_dir)
    l2, _ = orders_batch(spark, sf_dir, second=True)
    return md.key_replace(None, md.newest_file_per_key(l1.unionByName(l2), ["custkey"]), ["custkey"])


@query("mode_upsert_new_column")
def mode_upsert_new_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MOD-3 / SNK-7: a column that the target lacks arrives with batch 2."""
    _, crules = cm.rules_for(spark, "orders")
    from lakegate.plans.specs import merge_keys, start_validity_column
    l1, _ = orders_batch(spark, sf_dir)
    l2, _ = orders_batch(spark, sf_dir, second=True)
    out = md.upsert(l1, l2.withColumn("note", F.lit("batch 2")), merge_keys(crules), start_validity_column(crules))
    return out.select("orderkey", "FILE_NAME_RECEIVED", "FILE_LINE_ID", "orderdate", "note")


@query("mode_historized")
def mode_historized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MOD-4: `_last` after two historised batches (append)."""
    l1, _ = orders_batch(spark, sf_dir)
    l2, _ = orders_batch(spark, sf_dir, second=True)
    r1 = md.historized(None, None, l1)
    return md.historized(r1.last, r1.all, l2).last


@query("mode_key_replace")
def mode_key_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MOD-5: `_last` after replacing every key present in batch 2."""
    l1, _ = orders_batch(spark, sf_dir)
    l2, _ = orders_batch(spark, sf_dir, second=True)
    return md.key_replace(l1, l2, ["orderkey"])


@query("technical_columns")
def technical_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-8: `_all` rows of batch 1 with the four technical columns first."""
    return orders_batch(spark, sf_dir)[1]


@query("partition_columns")
def partition_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-5: partition values (yyyy/mm/dd/hhmmss scheme) of the `_all` rows, with row counts."""
    a = pj.with_partitions(orders_batch(spark, sf_dir)[1], "yyyy/mm/dd/hhmmss")
    return a.groupBy("yyyy", "mm", "dd", "hhmmss").agg(F.count(F.lit(1)).alias("rows"))


@query("last_vs_all")
def last_vs_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RPT-6 / SET-2: row counts of `_last` (after upsert) and `_all` (both batches)."""
    l1, a1 = orders_batch(spark, sf_dir)
    l2, a2 = orders_batch(spark, sf_dir, second=True)
    r = md.apply_mode("delta_from_non_historized", l1, a1, a2, ["orderkey"], "orderdate")
    return rp.row_counts({"orders_last": r.last, "orders_all": r.all})


@query("staging_stats")
def staging_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-6: rows and distinct files per staging table."""
    return rp.staging_stats({"orders_staging": fx.dirty_orders(spark, sf_dir),
                             "lineitem_staging": fx.dirty_lineitem(spark, sf_dir)})


# --------------------------------------------------------------- sources (G)

ORDER_B = ["orderdate", "orderkey", "orderpriority", "custkey", "orderstatus", "totalprice"]


def _landing_frame(df: DataFrame) -> DataFrame:
    """Reader output -> (_file_name = landed name from the folder, values)."""
    return df.select(F.col(ld.LANDING).alias("_file_name"), *ORDER_VALUES)


@query("csv_roundtrip_headers")
def csv_roundtrip_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-4..7 / H2: the dirty orders written as ';' CSV and read back under the
    three header modes.  For HEADER_USE the files of the second half of each year
    put their columns in another order; names are mapped per file from its header."""
    d = fx.dirty_orders(spark, sf_dir)
    root = scratch_path(spark, "csv-landing")
    ld.write_csv(d, root, ORDER_VALUES)
    mixed = scratch_path(spark, "csv-mixed")
    first_half = F.substring(F.regexp_extract("_file_name", r"(\d{8})", 1), 5, 2).cast("int") <= 6
    ld.write_csv(d.filter(first_half), mixed, ORDER_VALUES)
    ld.write_csv(d.filter(~first_half), mixed, ORDER_B, mode="append")
    out = None
    for mode, path in (("", root), ("FIRST_LINE", root), ("HEADER_USE", mixed)):
        r = dl.read_delimited(spark, path, ORDER_VALUES, header_mode=mode, delimiter=";")
        r = r.select(F.regexp_extract("_file_path", r"landing_name=([^/]+)/", 1).alias("_file_name"), *ORDER_VALUES,
                     F.lit(mode or "DEFAULT").alias("header_mode"))
        out = r if out is None else out.unionByName(r)
    return out


@query("corrupt_records")
def corrupt_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-8: text landing where some lines lose their last field or gain one; the
    parser keeps them in ``_corrupt_record``."""
    d = fx.dirty_orders(spark, sf_dir)
    k = F.col("_line_order")
    full = F.concat_ws(";", *ORDER_VALUES)
    short = F.concat_ws(";", *ORDER_VALUES[:-1])
    line = F.when(k % 29 == 0, short).when(k % 31 == 0, F.concat(full, F.lit(";extra"))).otherwise(full)
    root = scratch_path(spark, "text-landing")
    ld.write_text_with_header(d, root, ORDER_VALUES, line)
    r = dl.read_delimited(spark, root, ORDER_VALUES, header_mode="FIRST_LINE", delimiter=";")
    bad = dl.corrupt_lines(r)
    return bad.select(F.regexp_extract("_file_path", r"landing_name=([^/]+)/", 1).alias("_file_name"),
                      F.col(dl.CORRUPT).alias("corrupt_record"), *ORDER_VALUES)


@query("json_parquet_sources")
def json_parquet_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-9: the dirty orders as JSON and as Parquet landings, read back as text."""
    d = fx.dirty_orders(spark, sf_dir)
    jroot, proot = scratch_path(spark, "json-landing"), scratch_path(spark, "parquet-landing")
    ld.write_json(d, jroot, ORDER_VALUES)
    ld.write_parquet(d, proot, ORDER_VALUES)
    j = dl.read_json(spark, jroot, ORDER_VALUES + [ld.LANDING])
    p = dl.read_parquet_as_text(spark, proot, ORDER_VALUES + [ld.LANDING])
    return _landing_frame(j).withColumn("format", F.lit("json")) \
        .unionByName(_landing_frame(p).withColumn("format", F.lit("parquet")))


@query("landing_listing")
def landing_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-2/3/11: listing of a mixed landing (CSV, JSON, Parquet folders) without
    reading content: landed names per detected format."""
    d = fx.dirty_orders(spark, sf_dir)
    root = scratch_path(spark, "mixed-landing")
    ld.write_csv(d, f"{root}/csv", ORDER_VALUES)
    ld.write_json(d, f"{root}/json", ORDER_VALUES)
    ld.write_parquet(d, f"{root}/parquet", ORDER_VALUES)
    m = lg.landing_manifest(spark, root)
    return (m.select(F.regexp_extract("path", r"landing_name=([^/]+)/", 1).alias("landing_name"), "file_format")
            .groupBy("landing_name", "file_format").agg(F.lit(True).alias("present")))


@query("zip_expand")
def zip_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-1: the dirty orders packed by tasks into zip archives (one entry per
    landed name, plus __MACOSX and dot entries), expanded one task per archive."""
    d = fx.dirty_orders(spark, sf_dir)
    root = scratch_path(spark, "zip-landing")
    ld.write_zips(d, root, ORDER_VALUES)
    lines = ar.expand_archives(spark, root)
    parsed = ar.parse_lines(lines.filter(F.col("status") == "OK"), ORDER_VALUES, ";")
    return parsed.select("entry_name", "table_name", "line_no", *ORDER_VALUES)


ML_VALUES = ["orderkey", "note", "orderpriority"]


def _multi_line_orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, F.Column]:
    """Orders with a note of two lines that holds the delimiter and a quote, and their text as the source sends it."""
    d = fx.dirty_orders(spark, sf_dir)
    note = F.concat(F.col("orderstatus"), F.lit(';"'), F.col("totalprice"), F.lit('"\nline 2'))
    quoted = F.concat(F.lit('"'), F.replace(note, F.lit('"'), F.lit('\\"')), F.lit('"'))
    return d, F.concat_ws(";", "orderkey", quoted, "orderpriority")


@query("csv_quote_ml")
def csv_quote_ml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-4 / SRC-1: records of several lines (a quoted note with line ends, delimiters and escaped
    quotes), landed directly and in archives: both give the same records."""
    d, line = _multi_line_orders(spark, sf_dir)
    root, zips = scratch_path(spark, "ml-landing"), scratch_path(spark, "ml-zips")
    ld.write_text_with_header(d, root, ML_VALUES, line)
    direct = dl.read_delimited(spark, root, ML_VALUES, header_mode="FIRST_LINE", delimiter=";", multiline=True)
    direct = direct.select(F.regexp_extract("_file_path", r"landing_name=([^/]+)/", 1).alias("file_name"), *ML_VALUES,
                           F.col(dl.CORRUPT).isNotNull().alias("corrupt"), F.lit("direct").alias("source"))
    ld.write_zips(d, zips, ML_VALUES, line=line)
    lines = ar.expand_archives(spark, zips, skip_header=False).filter("status = 'OK'")
    parsed = ar.parse_lines(ar.records(lines, ["archive", "entry_name"]).filter("record_no > 1"), ML_VALUES, ";", dl.CORRUPT)
    return direct.unionByName(parsed.select(F.col("entry_name").alias("file_name"), *ML_VALUES,
                                            F.col(dl.CORRUPT).isNotNull().alias("corrupt"), F.lit("archive").alias("source")))


@query("zip_json")
def zip_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-1 / SRC-9: the dirty orders as JSON entries of archives, read as landed JSON files are."""
    d = fx.dirty_orders(spark, sf_dir).withColumn("_file_name", F.regexp_replace("_file_name", "csv$", "json"))
    root = scratch_path(spark, "zip-json-landing")
    ld.write_zips(d, root, ORDER_VALUES, line=F.to_json(F.struct(*ORDER_VALUES)))
    lines = ar.expand_archives(spark, root, skip_header=False).filter("status = 'OK'")
    return ar.parse_json_lines(lines, ORDER_VALUES, dl.CORRUPT).select("entry_name", "table_name", "line_no", *ORDER_VALUES)


@query("header_use_extra_cell")
def header_use_extra_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-5 / SRC-8 / FIL-15: under HEADER_USE a line with fewer or more fields than its file's header
    is a bad record, kept whole; blank fields count."""
    d = fx.dirty_orders(spark, sf_dir)
    k = F.col("_line_order")
    full, short = F.concat_ws(";", *ORDER_VALUES), F.concat_ws(";", *ORDER_VALUES[:-1])
    line = F.when(k % 29 == 0, short).when(k % 31 == 0, F.concat(full, F.lit(";extra"))).otherwise(full)
    root = scratch_path(spark, "header-use-landing")
    ld.write_text_with_header(d, root, ORDER_VALUES, line)
    bad = dl.corrupt_lines(dl.read_delimited(spark, root, ORDER_VALUES, header_mode="HEADER_USE", delimiter=";"))
    return bad.select(F.regexp_extract("_file_path", r"landing_name=([^/]+)/", 1).alias("_file_name"),
                      F.col(dl.CORRUPT).alias("corrupt_record"), *ORDER_VALUES)


# -------------------------------------------------------------- streaming (H)

EVENT_VALUES = ["event_id", "ts", "user_id", "event_type", "value", "props"]
EVENT_RULES = [
    ColumnRule("event_id", "LONG", nullable=False),
    ColumnRule("ts", "TIMESTAMP", pattern="yyyy-MM-dd HH:mm:ss.SSSSSS", nullable=False),
    ColumnRule("user_id", "LONG", nullable=False, special="ismergekey"),
    ColumnRule("event_type", "STRING"),
    ColumnRule("value", "DECIMAL(18,2)", action="LOG_ONLY"),
    ColumnRule("props", "STRING"),
]


def write_events_landing(spark: SparkSession, sf_dir: str) -> str:
    """The events table as one JSON-lines file per day (text cells)."""
    e = fx.table(spark, sf_dir, "events")
    text = e.select(
        F.concat(F.lit("events_"), F.date_format("ts", "yyyyMMdd"), F.lit(".json")).alias(ld.LANDING),
        F.col("event_id").cast("string").alias("event_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
        F.col("user_id").cast("string").alias("user_id"),
        "event_type",
        F.col("value").cast("decimal(18,2)").cast("string").alias("value"),
        "props",
    )
    root = scratch_path(spark, "events-landing")
    text.repartition(ld.LANDING).write.partitionBy(ld.LANDING).json(root)
    return root


@query("stream_events_staging")
def stream_events_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-1/2, SNK-1: the events landing streamed (5 files per micro-batch, availableNow)
    into a staging table; returns the staged rows."""
    root = write_events_landing(spark, sf_dir)
    s = st.landing_stream(spark, root, EVENT_VALUES, "json", max_files_per_trigger=5)
    s = s.select(F.regexp_extract("_file_path", r"landing_name=([^/]+)/", 1).alias("_file_name"), *EVENT_VALUES)
    staging = scratch_path(spark, "events_staging")
    stats = st.stage(s, staging, scratch_path(spark, "events-staging-ckpt"))
    if stats.rows <= 0:
        raise RuntimeError("stream staged no rows")
    return spark.read.parquet(staging)


@query("stream_staging_stats")
def stream_staging_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-2 / STR-3: the staging tables found below a folder, and the rows that the run of one reported."""
    s = st.landing_stream(spark, write_events_landing(spark, sf_dir), EVENT_VALUES, "json", max_files_per_trigger=20)
    base = scratch_path(spark, "staging-base")
    stats = st.stage(s.drop("_file_path"), f"{base}/events_staging", scratch_path(spark, "staging-stats-ckpt"))
    return st.list_staging_tables(spark, base).withColumns({"reported_rows": F.lit(stats.rows), "status": F.lit(stats.status)})


@query("stream_upsert_events")
def stream_upsert_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MOD-3 inside foreachBatch: latest event per user, compared by (ts, event_id)."""
    root = write_events_landing(spark, sf_dir)
    s = st.landing_stream(spark, root, EVENT_VALUES, "json", max_files_per_trigger=5)
    target = scratch_path(spark, "events_last")

    def step(current: DataFrame | None, batch: DataFrame) -> DataFrame:
        v = validate(batch, EVENT_RULES, keep=["_file_name"])
        ok = v.filter(~F.col("_line_rejected")).select("_file_name", *EVENT_VALUES) \
            .withColumn("event_rank", F.struct("ts", "event_id"))
        return md.upsert(current, ok, ["user_id"], "event_rank", tiebreak=("event_id",))

    st.apply_in_batches(s, target, scratch_path(spark, "events-last-ckpt"), step)
    from lakegate.plans.tables import read_current
    return read_current(spark, target).select("user_id", "event_id", "ts", "event_type", "value", "props")


# ------------------------------------------------------- end-to-end run (I)
LINEITEM_VALUES = ["orderkey", "linenumber", "partkey", "suppkey", "quantity", "extendedprice", "discount", "tax",
                   "returnflag", "linestatus", "shipdate"]


@query("ingest_run_quality")
def ingest_run_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E2 end to end: the dirty orders (';', FIRST_LINE) and lineitem (',', HEADER_USE)
    landings written as real named files, ingested by one run (file gates, reads,
    line numbers, validation, staging, tolerance gates, modes, sinks); returns the
    run's quality log (RPT-4) for both tables."""
    from lakegate.plans.ingest import Ingestion, RunParams
    from lakegate.plans.specs import column_sheet
    land = scratch_path(spark, "named-landing")
    ld.write_named_csv(fx.dirty_orders(spark, sf_dir), land, ORDER_VALUES, ";")
    ld.write_named_csv(fx.dirty_lineitem(spark, sf_dir), land, LINEITEM_VALUES, ",")
    tsheet = table_sheet(spark, fx.ORDERS_TABLE_ROWS + fx.LINEITEM_TABLE_ROWS)
    csheet = column_sheet(spark, fx.ORDERS_COLUMN_ROWS + fx.LINEITEM_COLUMN_ROWS)
    run = Ingestion(spark, tsheet, csheet, scratch_path(spark, "warehouse"), RunParams())
    return run.run(land, "r1", run_at=cm.AS_OF).quality_log


def _ordered_run(spark: SparkSession, sf_dir: str, repeat: int):
    """The orders landing ingested ``repeat`` times under one run id -> warehouse."""
    from lakegate.plans.ingest import Ingestion, RunParams
    from lakegate.plans.specs import column_sheet
    land, wh = scratch_path(spark, "rerun-landing"), scratch_path(spark, "rerun-warehouse")
    ld.write_named_csv(fx.dirty_orders(spark, sf_dir), land, ORDER_VALUES, ";")
    run = Ingestion(spark, table_sheet(spark, fx.ORDERS_TABLE_ROWS), column_sheet(spark, fx.ORDERS_COLUMN_ROWS), wh,
                    RunParams())
    for _ in range(repeat):
        run.run(land, "r1", run_at=cm.AS_OF)
    return wh


@query("ingest_rerun_last")
def ingest_rerun_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E2: `_last` after a run and its repetition under the same run id (nothing doubled)."""
    from lakegate.plans.tables import read_current
    return read_current(spark, f"{_ordered_run(spark, sf_dir, 2)}/orders_last").select(*TECH_AND_VALUES)


@query("ingest_rerun_tracking")
def ingest_rerun_tracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FIL-11: tracking after a run and its repetition (a run is no history to itself)."""
    from lakegate.plans.tables import read_runs
    return read_runs(spark, f"{_ordered_run(spark, sf_dir, 2)}/tracking").select(
        "table_name", "filename", "status", "row_count")


@query("ingest_table_error")
def ingest_table_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1: a table whose mode lacks its merge keys ends as ERROR, the other is ingested."""
    from lakegate.plans.ingest import Ingestion, RunParams
    from lakegate.plans.specs import column_sheet
    land = scratch_path(spark, "error-landing")
    ld.write_named_csv(fx.dirty_orders(spark, sf_dir), land, ORDER_VALUES, ";")
    ld.write_named_csv(fx.dirty_lineitem(spark, sf_dir), land, LINEITEM_VALUES, ",")
    tables = fx.ORDERS_TABLE_ROWS + [r | {"Ingestion mode": "DELTA_FROM_NON_HISTORIZED"} for r in fx.LINEITEM_TABLE_ROWS]
    columns = fx.ORDERS_COLUMN_ROWS + [r | {"Is Special": None} for r in fx.LINEITEM_COLUMN_ROWS]
    run = Ingestion(spark, table_sheet(spark, tables), column_sheet(spark, columns), scratch_path(spark, "error-warehouse"),
                    RunParams())
    return run.run(land, "r1", run_at=cm.AS_OF).outcomes.select("table_name", "filename", "status", "rows_ingested")


def _orders_ingestion(spark: SparkSession, warehouse: str, mode: str | None = None, **params):
    """An ingestion of the orders table alone, by another mode if given."""
    from lakegate.plans.ingest import Ingestion, RunParams
    from lakegate.plans.specs import column_sheet
    rows = [r | ({"Ingestion mode": mode} if mode else {}) for r in fx.ORDERS_TABLE_ROWS]
    return Ingestion(spark, table_sheet(spark, rows), column_sheet(spark, fx.ORDERS_COLUMN_ROWS), warehouse,
                     RunParams(**params))


def _landed(spark: SparkSession, df: DataFrame, name: str) -> str:
    root = scratch_path(spark, name)
    ld.write_named_csv(df, root, ORDER_VALUES, ";")
    return root


def _two_batches(spark: SparkSession, sf_dir: str, mode: str, warehouse: str) -> DataFrame:
    """Both orders landings ingested by ``mode``, the re-sent orders a day later -> `_last`."""
    from lakegate.plans.tables import read_current
    run = _orders_ingestion(spark, warehouse, mode, duplicate_check_enabled=False, file_order_check_enabled=False)
    before = (dt.datetime.fromisoformat(cm.AS_OF) - dt.timedelta(days=1)).isoformat(" ")
    run.run(_landed(spark, fx.dirty_orders(spark, sf_dir), "first-landing"), "r1", run_at=before)
    run.run(_landed(spark, fx.orders_batch2(spark, sf_dir), "second-landing"), "r2", run_at=cm.AS_OF)
    return read_current(spark, f"{warehouse}/orders_last").select(*TECH_AND_VALUES)


@query("ingest_upsert_buckets")
def ingest_upsert_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MOD-3 / JOI-1 in two runs: `_last` in buckets of the merge key, of which the second run rewrites
    those that hold its keys."""
    return _two_batches(spark, sf_dir, "DELTA_FROM_NON_HISTORIZED", scratch_path(spark, "upsert-warehouse"))


@query("ingest_key_replace_buckets")
def ingest_key_replace_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MOD-5 / JOI-2 in two runs over a table in buckets."""
    return _two_batches(spark, sf_dir, "FULL_KEY_REPLACE", scratch_path(spark, "key-replace-warehouse"))


@query("ingest_rejected_snapshot")
def ingest_rejected_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MOD-1: a run whose only files are rejected by the tolerance gate leaves the snapshot as it was."""
    from lakegate.plans.tables import read_current
    wh = scratch_path(spark, "snapshot-warehouse")
    run = _orders_ingestion(spark, wh, "FULL_SNAPSHOT")
    dirty = fx.dirty_orders(spark, sf_dir)
    run.run(_landed(spark, dirty, "snapshot-landing"), "r1", run_at=cm.AS_OF)
    bad = dirty.withColumns({c: F.lit("bad") for c in ("orderkey", "custkey", "totalprice", "orderdate")}) \
        .withColumn("_file_name", F.regexp_replace("_file_name", "_19", "_20"))
    run.run(_landed(spark, bad, "rejected-landing"), "r2", run_at=cm.AS_OF)
    return read_current(spark, f"{wh}/orders_last").select(*TECH_AND_VALUES)


@query("ingest_same_names")
def ingest_same_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FIL-16 / FIL-17: files of one name in two folders are judged, counted and reported each on its own."""
    root = scratch_path(spark, "same-names-landing")
    dirty = fx.dirty_orders(spark, sf_dir)
    ld.write_named_csv(dirty, f"{root}/a", ORDER_VALUES, ";")
    ld.write_named_csv(dirty.filter(F.col("_line_order") % 2 == 0), f"{root}/b", ORDER_VALUES, ";")
    run = _orders_ingestion(spark, scratch_path(spark, "same-names-warehouse"), duplicate_check_enabled=False)
    out = run.run(root, "r1", run_at=cm.AS_OF).outcomes
    return out.select(F.regexp_extract("path", "/([ab])/[^/]*$", 1).alias("folder"), "filename", "total_lines", "rejected_lines")


@query("ingest_older_rerun")
def ingest_older_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FIL-11: two runs, then the first one again: it is judged as of its own time, so tracking stays as it was."""
    from lakegate.plans.tables import read_runs
    dirty, wh = fx.dirty_orders(spark, sf_dir), scratch_path(spark, "older-warehouse")
    early = F.substring("_file_name", 8, 4) < "1995"
    run = _orders_ingestion(spark, wh)
    first = _landed(spark, dirty.filter(early), "older-landing")
    run.run(first, "r1", run_at="2025-12-30 00:00:00")
    run.run(_landed(spark, dirty.filter(~early), "newer-landing"), "r2", run_at="2025-12-31 00:00:00")
    run.run(first, "r1", run_at=cm.AS_OF)
    return read_runs(spark, f"{wh}/tracking").select("table_name", "filename", "status", "row_count")


def _one_run(spark: SparkSession, sf_dir: str, name: str, **params):
    """The orders landing ingested once -> (run result, warehouse)."""
    wh = scratch_path(spark, f"{name}-warehouse")
    land = _landed(spark, fx.dirty_orders(spark, sf_dir), f"{name}-landing")
    return _orders_ingestion(spark, wh, **params).run(land, "r1", run_at=cm.AS_OF), wh


@query("ingest_fail_fast")
def ingest_fail_fast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QUA-12 in a run: the first file past the threshold fails with 000000007, those behind it don't start;
    neither has invalid lines, of the others every rejected line is one."""
    result, wh = _one_run(spark, sf_dir, "fail-fast", fail_fast_enabled=True, fail_fast_threshold=30)
    lines = spark.read.parquet(f"{wh}/orders_invalid_lines").groupBy("filename").agg(F.count(F.lit(1)).alias("invalid_lines"))
    return result.outcomes.join(lines, "filename", "left").select(
        "filename", "status", "error_code", "rows_ingested", F.coalesce("invalid_lines", F.lit(0)).alias("invalid_lines"))


@query("ingest_error_log")
def ingest_error_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-3 / SET-1: the error log of a run, one row per error of every column."""
    _, wh = _one_run(spark, sf_dir, "error-log")
    return spark.read.parquet(f"{wh}/orders_errors").select(
        "table_name", "filename", "line_number", "error_pos", "column", "code", "action", "message", "raw_value")


@query("ingest_mode_stats")
def ingest_mode_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MOD-9: mode, rows handed to it and tables written."""
    return _one_run(spark, sf_dir, "mode-stats")[0].mode_stats


@query("ingest_quality_issues")
def ingest_quality_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QUA-15 / QUA-16 in a run: keys that the accepted lines repeat (every third order is sent once more)."""
    dirty = fx.dirty_orders(spark, sf_dir)
    wh = scratch_path(spark, "issues-warehouse")
    land = _landed(spark, dirty.unionByName(dirty.filter(F.col("_line_order") % 3 == 0)), "issues-landing")
    _orders_ingestion(spark, wh).run(land, "r1", run_at=cm.AS_OF)
    return spark.read.parquet(f"{wh}/orders_quality_issues").select(
        "table_name", "filename", "column_name", "key_value", "error_message", "error_count")


@query("ingest_retention")
def ingest_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FIL-13 / QUA-21 in storage: what two runs, 60 days apart, leave after a purge (30 days of invalid lines,
    90 of tracking): rows per file in both tables."""
    from lakegate.plans.tables import read_runs
    dirty, wh = fx.dirty_orders(spark, sf_dir), scratch_path(spark, "purge-warehouse")
    early = F.substring("_file_name", 8, 4) < "1995"
    run = _orders_ingestion(spark, wh)
    run.run(_landed(spark, dirty.filter(early), "purge-first"), "r1", run_at="2025-11-02 00:00:00")
    run.run(_landed(spark, dirty.filter(~early), "purge-second"), "r2", run_at=cm.AS_OF)
    run.purge("2026-01-10 00:00:00")
    parts = [read_runs(spark, f"{wh}/{t}").select(F.lit(t).alias("kept_in"), "filename")
             for t in ("orders_invalid_lines", "tracking")]
    return parts[0].unionByName(parts[1]).groupBy("kept_in", "filename").agg(F.count(F.lit(1)).alias("kept_rows"))


@query("history_type_change")
def history_type_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-7: runs of a table whose columns changed their type (int to bigint, decimal to double, date to text,
    one column more) read as one table of the wider types."""
    from lakegate.plans import tables as tb
    o, root = fx.table(spark, sf_dir, "orders"), scratch_path(spark, "type-change")
    tb.write_run(o.filter("o_orderkey % 2 = 0").select(
        F.col("o_orderkey").cast("int").alias("orderkey"), F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        F.col("o_orderdate").cast("date").alias("day")), root, "a")
    tb.write_run(o.filter("o_orderkey % 2 <> 0").select(
        F.col("o_orderkey").cast("long").alias("orderkey"), F.col("o_totalprice").cast("decimal(18,2)").cast("double").alias("price"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.col("o_orderstatus").alias("status")), root, "b")
    return tb.read_runs(spark, root).select("orderkey", "price", "day", "status")


@query("parquet_types")
def parquet_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-9: Parquet files of one landing whose columns differ in type, read as text."""
    o, root = fx.table(spark, sf_dir, "orders"), scratch_path(spark, "parquet-types")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    o.filter("o_orderkey % 2 = 0").select(key.cast("int").alias("orderkey"), cust.cast("long").alias("custkey")) \
        .write.parquet(f"{root}/a")
    o.filter("o_orderkey % 2 <> 0").select(key.cast("string").alias("orderkey"), F.col("o_orderstatus").alias("status")) \
        .write.parquet(f"{root}/b")
    names = ["orderkey", "custkey", "status"]
    return dl.read_parquet_as_text(spark, root, names, glob="*.parquet").select(*names)


@query("invalid_lines_all_tables")
def invalid_lines_all_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RPT-2 over all tables: invalid lines of orders and lineitem with subtotals."""
    parts = {}
    for kind, values in (("orders", ORDER_VALUES), ("lineitem", LINEITEM_VALUES)):
        v = cm.validated(spark, sf_dir, kind).withColumn("_raw", F.lit(None).cast("string"))
        parts[kind] = il.invalid_lines(v, values, id_col="_line_order", line_col="_line_order", raw_col="_raw",
                                       rejection_date=cm.as_of())
    return il.summary_of_tables(parts)


@query("files_by_table")
def files_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-3 / SRC-11: landed files grouped per derived table (count, first / last name, folders)."""
    return fl.files_by_table(fl.describe_files(cm.landing_manifest(spark, sf_dir)))


@query("stream_ingest_orders")
def stream_ingest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-1 + E2 in a stream: the named orders landing taken 40 files per micro-batch;
    each batch runs file gates, rules, tolerance gates and the upsert; returns `_last`.
    (The landing writer gives files arbitrary modification times, so the file-order
    check - an independent toggle - is off here.)"""
    from lakegate.plans.ingest import Ingestion, RunParams
    from lakegate.plans.specs import column_sheet
    from lakegate.plans.tables import read_current
    land = scratch_path(spark, "named-orders-landing")
    ld.write_named_csv(fx.dirty_orders(spark, sf_dir), land, ORDER_VALUES, ";")
    wh = scratch_path(spark, "stream-warehouse")
    run = Ingestion(spark, table_sheet(spark, fx.ORDERS_TABLE_ROWS), column_sheet(spark, fx.ORDERS_COLUMN_ROWS),
                    wh, RunParams(file_order_check_enabled=False))
    run.run_stream(land, "orders", scratch_path(spark, "stream-ingest-ckpt"), "s", max_files_per_trigger=40,
                   run_at=cm.AS_OF)
    return read_current(spark, f"{wh}/orders_last").select(*TECH_AND_VALUES)


@query("stream_ingest_archives")
def stream_ingest_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-1 / SRC-1: the landing of ``stream_ingest_orders`` packed into archives, three a micro-batch; their
    entries go through the same gates, rules and upsert and give the same `_last`."""
    from lakegate.plans.ingest import Ingestion, RunParams
    from lakegate.plans.specs import column_sheet
    from lakegate.plans.tables import read_current
    land, wh = scratch_path(spark, "orders-archives"), scratch_path(spark, "stream-archives-warehouse")
    ld.write_zips(fx.dirty_orders(spark, sf_dir), land, ORDER_VALUES, archives=8)
    run = Ingestion(spark, table_sheet(spark, fx.ORDERS_TABLE_ROWS), column_sheet(spark, fx.ORDERS_COLUMN_ROWS),
                    wh, RunParams(file_order_check_enabled=False))
    run.run_stream(land, None, scratch_path(spark, "stream-archives-ckpt"), "s", max_files_per_trigger=3, run_at=cm.AS_OF)
    return read_current(spark, f"{wh}/orders_last").select(*TECH_AND_VALUES)


@query("validity_ranges")
def validity_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D16 (optional view): validity ranges of the historised `_all` rows of both
    orders batches, per orderkey ordered by orderdate (the IsStartValidity column)."""
    _, a1 = orders_batch(spark, sf_dir)
    _, a2 = orders_batch(spark, sf_dir, second=True)
    r = md.historized(None, a1, a2)
    v = md.validity_ranges(r.all, ["orderkey"], "orderdate")
    return v.select("orderkey", "FILE_NAME_RECEIVED", "FILE_LINE_ID", "orderdate", "valid_from", "valid_to")
