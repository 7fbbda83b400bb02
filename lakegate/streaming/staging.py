"""Incremental file ingestion with Structured Streaming (STR-1..3, SNK-1, MOD-3 in a stream).

* ``landing_stream``: the file source with an explicit all-text schema; each
  file is taken exactly once (the source's checkpoint remembers it), existing
  files included, no notifications needed.
* ``stage``: append to a staging table (the Parquet file sink is exactly-once
  through its own metadata log) with ``trigger(availableNow=True)``: everything
  present is processed in bounded micro-batches, then the query stops.
* ``apply_in_batches``: the batch functions (rules, gates, modes) run unchanged
  inside ``foreachBatch``; each micro-batch writes the table version named after
  its batch id, computed from the latest version *before* it, so a replayed
  batch rewrites nothing and never applies twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegate.functions.filenames import base_name, plain_path
from lakegate.plans import tables as tb
from lakegate.sources.delimited import CORRUPT, _options, text_schema


def landing_stream(spark: SparkSession, root: str, names: Sequence[str], fmt: str = "csv", *,
                   header: bool = True, delimiter: str = ",", charset: str | None = "UTF-8",
                   max_files_per_trigger: int | None = None, glob: str | None = None) -> DataFrame:
    """STR-1: unbounded frame of text columns + ``_file_name`` / ``_file_path``."""
    r = spark.readStream.schema(text_schema([n.lower() for n in names]))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if glob:
        r = r.option("pathGlobFilter", glob)
    r = r.option("recursiveFileLookup", "true")
    if fmt.startswith("csv"):
        r = r.options(**_options(delimiter, charset, fmt.endswith("_ml"))).option("header", "true" if header else "false")
        df = r.csv(root)
    elif fmt == "json":
        df = r.option("columnNameOfCorruptRecord", CORRUPT).json(root)
    else:
        raise ValueError(f"unsupported stream format {fmt}")
    path = plain_path("_metadata.file_path")
    return df.select("*", base_name(path).alias("_file_name"), path.alias("_file_path"))


def file_stream(spark: SparkSession, root: str, max_files_per_trigger: int) -> DataFrame:
    """The landing's files as a stream of ``path, length, modificationTime``; no content is read."""
    listed = (spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
              .option("recursiveFileLookup", "true").option("maxFilesPerTrigger", str(max_files_per_trigger)).load(root))
    return listed.select(plain_path("_metadata.file_path").alias("path"), "length", "modificationTime")


@dataclass
class RunStats:
    rows: int
    batches: int
    status: str  # SUCCESS / NO_DATA


def committed_batches(spark: SparkSession, checkpoint: str) -> int:
    """Micro-batches that a query with this checkpoint has committed so far (batch ids count from 0)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/commits")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    return max((int(n) + 1 for n in names if n.isdigit()), default=0)


def _staged_rows(spark: SparkSession, path: str) -> int:
    """Rows that the sink's log names; Parquet footers alone are read."""
    jvm = spark.sparkContext._jvm
    log = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_spark_metadata")
    exists = log.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(log)
    return spark.read.parquet(path).count() if exists else 0


def stage(stream: DataFrame, staging_path: str, checkpoint: str, query_name: str | None = None) -> RunStats:
    """SNK-1 / STR-2: append the stream to ``<table>_staging`` (Parquet file sink) and run once.

    Rows and batches are counted from what the sink and the checkpoint have committed, so their number
    doesn't matter: a query keeps only its latest progress reports, ``lastProgress`` only the last one.
    """
    spark = stream.sparkSession
    w = (stream.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True))
    if query_name:
        w = w.queryName(query_name)
    rows, batches = _staged_rows(spark, staging_path), committed_batches(spark, checkpoint)
    w.start(staging_path).awaitTermination()
    rows = _staged_rows(spark, staging_path) - rows
    return RunStats(rows, committed_batches(spark, checkpoint) - batches, "SUCCESS" if rows else "NO_DATA")


def latest_before(spark: SparkSession, root: str, batch_id: int) -> DataFrame | None:
    vs = [v for v in tb.committed_versions(spark, root) if v < batch_id]
    if not vs:
        return None
    return spark.read.parquet(f"{root.rstrip('/')}/v={vs[-1]}")


def apply_in_batches(stream: DataFrame, target_root: str, checkpoint: str,
                     step: Callable[[DataFrame | None, DataFrame], DataFrame]) -> RunStats:
    """Run ``step(current_target, micro_batch) -> new_target`` per micro-batch,
    writing target version = batch id (idempotent on replay)."""

    seen_rows: dict[int, int] = {}

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id in tb.committed_versions(spark, target_root):
            return  # replay of a batch already applied
        current = latest_before(spark, target_root, batch_id)
        cached = batch.persist()
        seen_rows[batch_id] = cached.count()
        tb.write_version(step(current, cached), target_root, version=batch_id)
        cached.unpersist()

    q = (stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    # numInputRows grows with every action on a micro-batch, so count each batch once here
    rows = sum(seen_rows.values())
    return RunStats(rows, len([n for n in seen_rows.values() if n > 0]), "SUCCESS" if rows else "NO_DATA")


def list_staging_tables(spark: SparkSession, base: str) -> DataFrame:
    """STR-3: staging tables found below ``base``."""
    return tb.list_tables(spark, base, "_staging")
