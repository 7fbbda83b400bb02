"""Report frames (RPT-1..7, FIL-17, AGG-6, SET-2).

Dashboards and console printing of the reference are re-aimed as DataFrames a
user can write or display; every report is an aggregate over the run's frames.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegate.operators.gates import ROWS_TO_ALL, ROWS_TO_LAST


def quality_log(decisions: DataFrame, table_name: str, file_col: str = "_file_name") -> DataFrame:
    """RPT-4: per file total / valid / invalid rows."""
    return decisions.select(
        F.lit(table_name).alias("table_name"),
        F.col(file_col).alias("filename"),
        F.col("total_lines").alias("total_rows"),
        (F.col("total_lines") - F.col("rejected_lines")).alias("valid_rows"),
        F.col("rejected_lines").alias("invalid_rows"),
        F.col("file_status").alias("status"),
    )


def execution_report(decisions: DataFrame, table_name: str, file_col: str = "_file_name") -> DataFrame:
    """RPT-3: per file rows processed, rejected, invalid cells, rows written, final status."""
    return decisions.select(
        F.lit(table_name).alias("table_name"),
        F.col(file_col).alias("filename"),
        F.col("total_lines").alias("rows_processed"),
        F.col("rejected_lines").alias("rows_rejected"),
        F.col("errors").alias("invalid_cells"),
        ROWS_TO_LAST, ROWS_TO_ALL,
        F.when(F.col("file_status") == "ACCEPTED", F.lit("SUCCESS")).otherwise(F.lit("FAILED")).alias("status"),
        F.col("file_reason").alias("reason"),
    )


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """RPT-6 / SET-2: UNION ALL of per-table row counts."""
    frames = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
              for name, df in tables.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def staging_stats(staging: Mapping[str, DataFrame], file_col: str = "_file_name") -> DataFrame:
    """AGG-6: per staging table row count and number of distinct files."""
    frames = [df.select(F.lit(name).alias("table_name"), F.col(file_col).alias("filename"))
              for name, df in staging.items()]
    u = frames[0]
    for f in frames[1:]:
        u = u.unionByName(f)
    return u.groupBy("table_name").agg(F.count(F.lit(1)).alias("row_count"),
                                      F.count_distinct("filename").alias("file_count"))


def run_status(outcomes: DataFrame) -> DataFrame:
    """RPT-7: per table processed / failed / skipped files, rows ingested / rejected,
    and the run status SUCCESS / PARTIAL / NO_DATA / ERROR.

    ``outcomes``: one row per file with table_name, status (SUCCESS / FAILED /
    SKIPPED / ERROR), rows_ingested, rows_rejected.  One table failing does not
    change another table's status.
    """
    agg = outcomes.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("files_received"),
        F.count_if(F.col("status") == "SUCCESS").alias("files_processed"),
        F.count_if(F.col("status") == "FAILED").alias("files_failed"),
        F.count_if(F.col("status") == "SKIPPED").alias("files_skipped"),
        F.count_if(F.col("status") == "ERROR").alias("files_error"),
        F.sum("rows_ingested").cast("long").alias("rows_ingested"),
        F.sum("rows_rejected").cast("long").alias("rows_rejected"),
    )
    status = (F.when(F.col("files_error") > 0, F.lit("ERROR"))
              .when((F.col("files_processed") > 0) & (F.col("files_failed") + F.col("files_skipped") == 0),
                    F.lit("SUCCESS"))
              .when(F.col("files_processed") > 0, F.lit("PARTIAL"))
              .otherwise(F.lit("NO_DATA")))
    return agg.withColumn("run_status", status)


def completeness(received: DataFrame, outcomes: DataFrame, file_col: str = "filename") -> DataFrame:
    """FIL-17: per table received = ingested + ignored + rejected + technical errors.

    ``received``: table_name and ``file_col`` (the path, where names can repeat) of every
    file of the manifest.  ``outcomes``: the same and status.  Files and outcomes meet on
    ``file_col``; a received file without an outcome, or an outcome without a received
    file, makes the table incomplete.
    """
    got = received.select(F.col(file_col).alias("_file"), F.col("table_name").alias("_received"))
    out = outcomes.select(F.col(file_col).alias("_out"), F.col("table_name").alias("_outcome"), "status")
    j = got.join(out, F.col("_file") == F.col("_out"), "full_outer").select(
        F.coalesce("_outcome", "_received").alias("table_name"), F.col("_file").isNotNull().alias("_has_file"), "status")
    agg = j.groupBy("table_name").agg(
        F.count_if("_has_file").alias("received"),
        F.count_if(F.col("status") == "SUCCESS").alias("ingested"),
        F.count_if(F.col("status") == "SKIPPED").alias("ignored"),
        F.count_if(F.col("status") == "FAILED").alias("rejected"),
        F.count_if(F.col("status") == "ERROR").alias("technical_errors"),
        F.count_if(F.col("_has_file") & F.col("status").isNotNull()).alias("_matched"),
        F.count(F.lit(1)).alias("_all"),
    )
    return agg.select("table_name", "received", "ingested", "ignored", "rejected", "technical_errors",
                      (F.col("_matched") == F.col("_all")).alias("complete"))
