"""Target tables as versioned Parquet folders (SNK-2/3/5/7, H1).

Delta Lake is not available here, so MERGE / DELETE / retention become "write
the new table as the next version folder": ``<root>/v=<n>`` is written by a Spark
job whose commit marker (``_SUCCESS``) makes it visible; readers pick the highest
committed version.  A version is never rewritten in place (reading and
overwriting the same Parquet folder in one job is not legal), and a streaming
batch writes the version named after its batch id, so a replay is idempotent.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegate.functions.types import wider_type
from lakegate.plans.buckets import BUCKET, read_buckets

NO_FILES = "UNABLE_TO_INFER_SCHEMA"
"""Spark's condition for folders without a data file, as a partitioned write of no rows leaves them."""


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def committed_versions(spark: SparkSession, root: str) -> list[int]:
    """Version numbers below ``root`` that carry a commit marker."""
    return [n for n, _, _ in run_versions(spark, root)]


def current_version(spark: SparkSession, root: str) -> int | None:
    v = committed_versions(spark, root)
    return v[-1] if v else None


def read_current(spark: SparkSession, root: str) -> DataFrame | None:
    """The table as it is (schema-merged): its buckets, else the latest committed version; None for a new table."""
    in_buckets = read_buckets(spark, root)
    if in_buckets is not None:
        return in_buckets.drop(BUCKET)
    versions = run_versions(spark, root)
    if not versions:
        return read_runs(spark, root)  # a table that is only appended to (HISTORIZED)
    return spark.read.option("mergeSchema", "true").parquet(versions[-1][2])


def write_version(df: DataFrame, root: str, version: int | None = None,
                  partition_by: Sequence[str] = ()) -> int:
    """Write ``df`` as version ``version`` (default: next).  An existing committed
    version with that number is left as is (idempotent replay)."""
    spark = df.sparkSession
    if version is None:
        cur = current_version(spark, root)
        version = 0 if cur is None else cur + 1
    elif version in committed_versions(spark, root):
        return version
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(f"{root.rstrip('/')}/v={version}")
    return version


def run_versions(spark: SparkSession, root: str) -> list[tuple[int, str | None, str]]:
    """``(number, run id, path)`` of the committed versions below ``root``, in order."""
    fs, p, jvm = _fs(spark, root)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        m = re.fullmatch(r"v=(\d+)(?:__(.*))?", st.getPath().getName())
        if m and st.isDirectory() and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            out.append((int(m[1]), m[2], st.getPath().toString()))
    return sorted(out, key=lambda v: v[0])


def _of_run(versions: list[tuple[int, str | None, str]], run_id: str) -> int | None:
    return next((n for n, run, _ in versions if run == _folder(run_id)), None)


def _folder(run_id: str) -> str:
    return re.sub(r"[^A-Za-z0-9._-]", "_", run_id)


def read_before(spark: SparkSession, root: str, run_id: str) -> DataFrame | None:
    """The table as it was before ``run_id`` wrote it (a retry starts from there again)."""
    versions = run_versions(spark, root)
    own = _of_run(versions, run_id)
    before = [path for n, _, path in versions if own is None or n < own]
    return spark.read.option("mergeSchema", "true").parquet(before[-1]) if before else None


def write_run_version(df: DataFrame, root: str, run_id: str, keep: int = 3) -> str:
    """Write the version of ``run_id``, again if it is there already, and expire versions but the
    latest ``keep`` (at least two: a retry reads the one before its own)."""
    spark = df.sparkSession
    versions = run_versions(spark, root)
    number = _of_run(versions, run_id)
    if number is None:
        number = versions[-1][0] + 1 if versions else 0
    path = f"{root.rstrip('/')}/v={number}__{_folder(run_id)}"
    df.write.mode("overwrite").parquet(path)
    fs, _, jvm = _fs(spark, root)
    for _, _, old in run_versions(spark, root)[:-max(2, keep)]:
        fs.delete(jvm.org.apache.hadoop.fs.Path(old), True)
    return path


def list_tables(spark: SparkSession, base: str, suffix: str = "_staging") -> DataFrame:
    """STR-3: table folders below ``base`` whose name ends with ``suffix``."""
    fs, p, _ = _fs(spark, base)
    names = []
    if fs.exists(p):
        names = [st.getPath().getName() for st in fs.listStatus(p)
                 if st.isDirectory() and st.getPath().getName().endswith(suffix)]
    return spark.createDataFrame([(n,) for n in sorted(names)], "table_name string")


def write_run(df: DataFrame, root: str, run_id: str, partition_by: Sequence[str] = ()) -> str:
    """Append-only table: this run's rows in ``<root>/run=<run_id>`` (rewritten as a
    whole on a retry of the same run, so a retried job never duplicates rows)."""
    path = f"{root.rstrip('/')}/run={run_id}"
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def read_runs(spark: SparkSession, root: str, schema=None) -> DataFrame | None:
    """All committed run folders of an append-only table (``run`` column added); without any, or
    where no run has left a row in a partitioned table, None or an empty frame of ``schema``."""
    fs, p, jvm = _fs(spark, root)
    if not fs.exists(p):
        return None if schema is None else spark.createDataFrame([], schema)
    done = [st.getPath().toString() for st in fs.listStatus(p)
            if st.isDirectory() and st.getPath().getName().startswith("run=")
            and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS"))]
    try:
        if done:
            return merged(spark, done, root)
    except AnalysisException as exc:
        if exc.getCondition() != NO_FILES:
            raise
    return None if schema is None else spark.createDataFrame([], schema)


def merged(spark: SparkSession, paths: Sequence[str], base: str | None = None) -> DataFrame:
    """Parquet folders or files as one frame (SNK-7): columns of any of them; types that differ become the wider one.

    Spark merges the schemas in one job.  Only where it can't, because a column has
    changed its type, the paths are read by schema (one footer each) and cast.
    """
    reader = spark.read if base is None else spark.read.option("basePath", base)
    try:
        return reader.option("mergeSchema", "true").parquet(*paths)
    except Exception as exc:  # a Java exception that PySpark gives no class of its own
        if "CANNOT_MERGE" not in str(exc):
            raise
    by_schema: dict[tuple, list[str]] = {}
    for path in paths:
        try:
            by_schema.setdefault(tuple(reader.parquet(path).dtypes), []).append(path)
        except AnalysisException as exc:
            if exc.getCondition() != NO_FILES:
                raise
    types: dict[str, str] = {}
    for schema in by_schema:
        for name, kind in schema:
            types[name] = wider_type(types.get(name, kind), kind)
    frames = [reader.parquet(*same).select(*[F.col(f"`{c}`").cast(types[c]).alias(c) for c, _ in schema])
              for schema, same in by_schema.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def expire_runs(spark: SparkSession, root: str, date_col: str, oldest: str) -> tuple[int, int]:
    """Remove rows older than ``oldest`` from an append-only table: run folders that hold no other rows are
    dropped, only mixed ones are rewritten. Returns how many folders were dropped and rewritten."""
    table = read_runs(spark, root)
    if table is None:
        return 0, 0
    old = F.col(date_col) < F.lit(oldest).cast("timestamp_ntz")
    folder = F.regexp_extract(F.input_file_name(), "/run=([^/]+)/", 1)
    found = (table.groupBy(folder.alias("run_folder")).agg(F.count_if(old).alias("old"), F.count(F.lit(1)).alias("n"))
             .filter("old > 0").collect())  # one row per run folder
    fs, _, jvm = _fs(spark, root)
    rewritten = 0
    for r in found:
        path = f"{root.rstrip('/')}/run={r['run_folder']}"
        if r["old"] < r["n"]:
            aside = f"{root.rstrip('/')}/.kept-{r['run_folder']}"  # hidden from readers; the folder itself is being replaced
            spark.read.parquet(path).filter(~old).write.mode("overwrite").parquet(aside)
            spark.read.parquet(aside).write.mode("overwrite").parquet(path)
            fs.delete(jvm.org.apache.hadoop.fs.Path(aside), True)
            rewritten += 1
        else:
            fs.delete(jvm.org.apache.hadoop.fs.Path(path), True)
    return len(found) - rewritten, rewritten
