"""Session helpers: one place for the settings the library relies on.

The library never creates machine-local scratch space on a cluster.  Scratch
writes (checkpoints, staging copies made by the demo queries) go below the
shared folder named by ``spark.checkpoint.dir``; a local folder is only chosen
when that setting is unset *and* Spark runs in local mode (tests, laptops).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

LEAN_CONF = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}
"""Shuffle files go when their query has ended, not when the driver next happens to collect garbage; Parquet copies
are packed closer than by Spark's default."""


def get_spark(master: str | None = None, app: str = "lakegate", **conf: str) -> SparkSession:
    """Build (or reuse) a session with AQE on and a UTC session clock."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def lean_on_disk(spark: SparkSession) -> Iterator[None]:
    """``LEAN_CONF`` for the queries that run inside; what the session sets itself stays."""
    mine = {k: v for k, v in LEAN_CONF.items() if spark.conf.get(k, None) is None}
    for key, value in mine.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in mine:
            spark.conf.unset(key)


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/ABFS) before running lakegate on a cluster"
        )
    local = tempfile.mkdtemp(prefix="lakegate-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder (never reused)."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/lakegate-scratch/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss); never a local checkpoint."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python code in tasks can open local test paths."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path


def ensure_dir(path: str) -> None:
    """Create a folder when the path is a local one (no-op for object stores)."""
    p = local_path(path)
    if "://" not in p:
        os.makedirs(p, exist_ok=True)


def spread(df: DataFrame) -> DataFrame:
    """Round-robin a frame over the cluster's cores when its scan yields fewer
    partitions than cores (a few large row groups).  CPU-heavy row work (parsing,
    validation) then uses every core; a large input already has more splits than
    cores and is returned unchanged (no shuffle)."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df
