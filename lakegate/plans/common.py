"""Shared building blocks of the registered queries (orders / lineitem slices)."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegate.operators.gates import GateParams, gate
from lakegate.operators.rules import (ICT_REJECTED, LINE_REJECTED, N_ERRORS, N_ICT, REJECT,
                                      error_codes_text, validate)
from lakegate.plans import fixtures as fx
from lakegate.plans.specs import (ColumnRule, TableRule, column_sheet, load_column_rules,
                                  load_table_rules, table_sheet)

# Fixed clock of the demo runs (SCA-9): processing dates are a parameter so results are testable.
AS_OF = "2026-01-01 00:00:00"


def as_of() -> F.Column:
    return F.lit(AS_OF).cast("timestamp_ntz")


_RULES: dict[tuple[str, int], tuple[TableRule, tuple[ColumnRule, ...]]] = {}


def rules_for(spark: SparkSession, kind: str) -> tuple[TableRule, list[ColumnRule]]:
    """Rules of the orders / lineitem fixtures, loaded once per session."""
    key = (kind, id(spark))
    if key not in _RULES:
        if kind == "orders":
            trows, crows = fx.ORDERS_TABLE_ROWS, fx.ORDERS_COLUMN_ROWS
        else:
            trows, crows = fx.LINEITEM_TABLE_ROWS, fx.LINEITEM_COLUMN_ROWS
        trule = load_table_rules(table_sheet(spark, trows))[kind]
        _RULES[key] = (trule, tuple(load_column_rules(column_sheet(spark, crows), kind)))
    t, c = _RULES[key]
    return t, list(c)


def validated(spark: SparkSession, sf_dir: str, kind: str = "orders", dirty: DataFrame | None = None) -> DataFrame:
    trule, crules = rules_for(spark, kind)
    if dirty is None:
        dirty = fx.dirty_orders(spark, sf_dir) if kind == "orders" else fx.dirty_lineitem(spark, sf_dir)
    return validate(dirty, crules, ict=trule.ict)


def routed(spark: SparkSession, sf_dir: str, kind: str = "orders", params: GateParams | None = None,
           dirty: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    trule, crules = rules_for(spark, kind)
    v = validated(spark, sf_dir, kind, dirty)
    return gate(v, crules, params or GateParams(rlt=trule.rlt))


def line_summary_columns() -> list[F.Column]:
    return [F.col(N_ERRORS).alias("n_errors"), F.col(N_ICT).alias("n_ict"),
            error_codes_text().alias("error_codes"), F.col(REJECT).alias("reject"),
            F.col(ICT_REJECTED).alias("ict_rejected"), F.col(LINE_REJECTED).alias("line_rejected")]


# ------------------------------------------------------------- file manifests
def landing_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of the orders and lineitem landings with their line counts (from the data)."""
    parts = []
    for kind, dirty in (("orders", fx.dirty_orders(spark, sf_dir)), ("lineitem", fx.dirty_lineitem(spark, sf_dir))):
        parts.append(dirty.groupBy(F.col("_file_name").alias("filename"))
                     .agg(F.count(F.lit(1)).alias("lines")))
    m = parts[0].unionByName(parts[1])
    return m.select(F.concat(F.lit("/landing/"), F.col("filename")).alias("path"), "filename", "lines")


def tracking_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracking state before the run, derived from the landing: orders files up to
    1996-06 were ingested (SUCCESS) the day after their date; the 1997-01..03 files
    failed then."""
    from lakegate.operators.files import describe_files
    from lakegate.operators.tracking import registrations
    m = describe_files(landing_manifest(spark, sf_dir)).filter(F.col("table_name") == "orders")
    fd = F.col("file_date")
    status = (F.when(fd <= F.lit("1996-06-01 00:00:00").cast("timestamp_ntz"), F.lit("SUCCESS"))
              .when(fd.between(F.lit("1997-01-01 00:00:00").cast("timestamp_ntz"),
                               F.lit("1997-03-01 00:00:00").cast("timestamp_ntz")), F.lit("FAILED")))
    hist = m.select("table_name", "filename", "file_date", status.alias("status"),
                    F.col("lines").alias("row_count")).filter(F.col("status").isNotNull())
    return registrations(hist, F.col("file_date") + F.expr("INTERVAL 1 DAY"))


def run_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per received file of both landings: history gate, tolerance gate,
    rows written and the final status (SUCCESS / FAILED / SKIPPED)."""
    from lakegate.operators.files import describe_files, history_checks
    frames = []
    for kind in ("orders", "lineitem"):
        _, d = routed(spark, sf_dir, kind)
        frames.append(d.select(
            F.lit(kind).alias("kind"), F.col("_file_name").alias("filename"),
            F.col("total_lines"), F.col("rejected_lines"), "file_status", "file_reason",
            "rows_to_all", "rows_to_last"))
    files = frames[0].unionByName(frames[1])
    files = describe_files(files.withColumn("path", F.concat(F.lit("/landing/"), F.col("filename"))))
    h = history_checks(files, tracking_history(spark, sf_dir))
    status = (F.when(F.col("total_lines") == 0, F.lit("SKIPPED"))
              .when(F.col("error_code").isNotNull(), F.lit("FAILED"))
              .when(F.col("file_status") == "REJECTED", F.lit("FAILED"))
              .otherwise(F.lit("SUCCESS")))
    code = F.coalesce(F.col("error_code"), F.col("file_reason"))
    reason = F.coalesce(F.try_element_at(F.col("errors"), F.lit(1))["message"], F.col("file_reason"))
    ok = status == "SUCCESS"
    return h.select(
        "table_name", "filename", "file_date", "total_lines", "rejected_lines",
        F.when(ok, F.col("rows_to_all")).otherwise(F.lit(0)).cast("long").alias("rows_ingested"),
        F.when(ok, F.col("rows_to_last")).otherwise(F.lit(0)).cast("long").alias("rows_to_last"),
        F.when(ok, F.col("rejected_lines")).otherwise(F.col("total_lines")).cast("long").alias("rows_rejected"),
        status.alias("status"),
        F.when(~ok, code).alias("error_code"),
        F.when(~ok, reason).alias("reason"),
    )
