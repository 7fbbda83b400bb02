"""Processed-file tracking (FIL-11..13, RPT-1, AGG-1/2, SRT-1/2).

The tracking table has an explicit schema, so every outcome is written,
including FAILED files and undated files (D17).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRACKING_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType(), False),
    T.StructField("filename", T.StringType(), False),
    T.StructField("file_date", T.TimestampNTZType(), True),
    T.StructField("processed_date", T.TimestampNTZType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("row_count", T.LongType(), True),
])


def registrations(outcomes: DataFrame, processed_at: Column) -> DataFrame:
    """FIL-11: outcome rows (table_name, filename, file_date, status, row_count) -> tracking rows."""
    return outcomes.select(
        F.col("table_name").cast("string"),
        F.col("filename").cast("string"),
        F.col("file_date").cast("timestamp_ntz"),
        processed_at.cast("timestamp_ntz").alias("processed_date"),
        F.col("status").cast("string"),
        F.when(F.col("status") == "SUCCESS", F.col("row_count")).otherwise(F.lit(0)).cast("long").alias("row_count"),
    )


def processed_files(tracking: DataFrame, table_name: str | None = None) -> DataFrame:
    """FIL-12: listing, optionally for one table."""
    return tracking if table_name is None else tracking.filter(F.col("table_name") == table_name)


def retain(tracking: DataFrame, as_of: Column, days: int, date_col: str = "processed_date") -> DataFrame:
    """FIL-13 / QUA-21: keep rows not older than ``days`` before ``as_of`` (a new version, never in place)."""
    return tracking.filter(F.col(date_col) >= F.date_sub(as_of.cast("date"), days).cast("timestamp_ntz"))


def status_counts(tracking: DataFrame) -> DataFrame:
    """RPT-1 / AGG-1: count per status."""
    return tracking.groupBy("status").agg(F.count(F.lit(1)).alias("count"))


def ranked(counts: DataFrame, count_col: str, *ties: str) -> DataFrame:
    """SRT-1: groups in the order of their count, the most frequent first, with their ``rank``.

    For frames with a row per group of a report, after the aggregation.
    """
    order = Window.orderBy(F.desc(count_col), *[F.asc(t) for t in ties])
    return counts.withColumn("rank", F.row_number().over(order)).orderBy("rank")


def by_table(tracking: DataFrame) -> DataFrame:
    """AGG-2: per table files, rows, successes, failures."""
    return tracking.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("row_count").cast("long").alias("rows"),
        F.count_if(F.col("status") == "SUCCESS").alias("success"),
        F.count_if(F.col("status") == "FAILED").alias("failed"),
    )


def latest(tracking: DataFrame, n: int = 10) -> DataFrame:
    """SRT-2: the latest ``n`` registrations (top-k; ties broken by table and file name)."""
    return tracking.orderBy(F.desc("processed_date"), F.asc("table_name"), F.asc("filename")).limit(n)
