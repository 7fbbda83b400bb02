"""Current tables in hash buckets of their merge keys (MOD-3, MOD-5, JOI-1).

``_last`` of a keyed mode lies in ``<root>/of=<n>/_bucket=<k>`` folders.  A batch
reads and rewrites only the buckets that hold its keys (partition pruning on the
way in, dynamic partition overwrite on the way out), so an upsert of one key in a
hundred costs its buckets, not the table.  The number of buckets is chosen when a
table is first written (about one gigabyte each is a good size) and stays with it.

Before buckets are overwritten their rows are kept in ``<before>/run=<id>``.  The
merge reads that copy, never the folders that it replaces, and a repetition of
the run starts from it again, so a retried or corrected run leaves no trace of its
first attempt.

Rows with a null key match nothing; their bucket follows from the line they came
from, so they are spread like any others.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegate.functions.types import wider_type

BUCKET = "_bucket"
ROWS_AT_ONCE = 25_000_000
"""Rows whose buckets are merged in one job: the bound of the shuffle files that a merge keeps at a time."""


def _folders(spark: SparkSession, root: str) -> list:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s for s in fs.listStatus(path) if s.isDirectory()] if fs.exists(path) else []


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _numbered(spark: SparkSession, root: str, key: str) -> list[int]:
    """The numbers of the ``<key>=<number>`` folders below ``root``, ascending."""
    names = (s.getPath().getName() for s in _folders(spark, root))
    return sorted(int(m[1]) for m in (re.fullmatch(f"{key}=([0-9]+)", n) for n in names) if m)


def bucket_count(spark: SparkSession, root: str) -> int | None:
    """Number of buckets of the table, None if it isn't kept in buckets (yet)."""
    counts = _numbered(spark, root, "of")
    return counts[-1] if counts else None


def bucket_of(keys: Sequence[str], line: Sequence[str], count: int) -> Column:
    """The bucket of a row: by its keys, or by the line it came from where a key is null."""
    has_null = F.exists(F.array(*[F.col(f"`{k}`").isNull() for k in keys]), lambda x: x)
    by_line, by_keys = (F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in cols]) for cols in (line, keys))
    return F.pmod(F.when(has_null, by_line).otherwise(by_keys), F.lit(count)).cast("int")


def read_buckets(spark: SparkSession, root: str) -> DataFrame | None:
    """The table with its ``_bucket``, None if there is none."""
    count = bucket_count(spark, root)
    if count is None or not _numbered(spark, f"{root}/of={count}", BUCKET):
        return None
    return spark.read.option("mergeSchema", "true").parquet(f"{root}/of={count}")


def _numbers(df: DataFrame) -> set[int]:
    """The buckets that occur: at most as many as the table has."""
    return {r[0] for r in df.select(BUCKET).distinct().collect()}


def _sizes(df: DataFrame) -> dict[int, int]:
    """The buckets that occur and their rows: at most as many as the table has."""
    return {r[0]: r[1] for r in df.groupBy(BUCKET).count().collect()}


def _slices(sizes: dict[int, int]) -> list[list[int]]:
    """The buckets in turns of at most ``ROWS_AT_ONCE`` rows, or of one larger bucket."""
    out, rows = [], 0
    for bucket, n in sorted(sizes.items()):
        if not out or rows + n > ROWS_AT_ONCE:
            out.append([])
            rows = 0
        out[-1].append(bucket)
        rows += n
    return out


class BeforeImage:
    """What the buckets touched by one run held before it: ``try=<k>/rows`` and ``try=<k>/buckets``."""

    def __init__(self, spark: SparkSession, root: str, run_id: str):
        self.spark, self.root = spark, f"{root}/run={run_id}"

    def last(self) -> int | None:
        done = [k for k in _numbered(self.spark, self.root, "try")
                if any(s.getPath().getName() == "done" for s in _folders(self.spark, f"{self.root}/try={k}"))]
        return done[-1] if done else None

    def buckets(self, attempt: int) -> set[int]:
        return _numbers(self.spark.read.parquet(f"{self.root}/try={attempt}/buckets"))

    def rows(self, attempt: int) -> DataFrame | None:
        """The rows, None if the buckets held none."""
        rows = self.spark.read.parquet(f"{self.root}/try={attempt}/rows")
        return rows if BUCKET in rows.columns else None

    def write(self, rows: DataFrame | None, buckets: set[int]) -> int:
        """``done`` is written last: an image without it was never used."""
        attempt = max(_numbered(self.spark, self.root, "try"), default=-1) + 1
        path = f"{self.root}/try={attempt}"
        none = self.spark.createDataFrame([], "nothing string")
        (none if rows is None else rows).write.parquet(f"{path}/rows")
        self.spark.createDataFrame([(b,) for b in sorted(buckets)], f"{BUCKET} int").coalesce(1).write.parquet(f"{path}/buckets")
        none.write.parquet(f"{path}/done")
        return attempt


def has_image(spark: SparkSession, before_root: str, run_id: str) -> bool:
    """Whether an attempt of the run has changed the table."""
    return BeforeImage(spark, before_root, run_id).last() is not None


def _same_types(rows: DataFrame, like: dict[str, str]) -> DataFrame:
    return rows.select(*[F.col(f"`{c}`").cast(like.get(c, t)).alias(c) for c, t in rows.dtypes])


def merge(root: str, before_root: str, run_id: str, batch: DataFrame, keys: Sequence[str], line: Sequence[str],
          step: Callable[[DataFrame | None, DataFrame], DataFrame], new_count: int, latest: bool = True,
          kept_images: int = 3) -> set[int]:
    """Apply ``step(current rows, batch)`` to the buckets that hold the batch's keys; returns the buckets rewritten.

    ``step`` must keep rows in their bucket (both frames have the column ``_bucket``) and decide by bucket: it is
    applied to some of the buckets at a time where they hold more than ``ROWS_AT_ONCE`` rows.
    ``latest``: no later run has written the table, so a repetition may start from
    the run's own before-image.  A column whose type changed gets the wider of both
    types, and the whole table is rewritten once.
    """
    spark, root = batch.sparkSession, root.rstrip("/")
    count = bucket_count(spark, root) or new_count
    table = read_buckets(spark, root)
    changed = {}
    if table is not None:
        old, new = dict(table.dtypes), dict(batch.dtypes)
        changed = {c: wider_type(old[c], new[c]) for c in old.keys() & new.keys() if old[c] != new[c]}
        batch = _same_types(batch, changed)
    batch = batch.withColumn(BUCKET, bucket_of(keys, line, count))
    of_batch = _sizes(batch)
    touched = set(range(count)) if any(t != dict(table.dtypes)[c] for c, t in changed.items()) else set(of_batch)
    image = BeforeImage(spark, before_root, run_id)
    attempt = image.last() if latest else None
    known = set() if attempt is None else image.buckets(attempt)
    touched |= known
    if attempt is None or touched - known:
        parts = [] if attempt is None else [image.rows(attempt)]
        if table is not None:
            parts.append(table.where(F.col(BUCKET).isin(*sorted(touched - known))))
        parts = [_same_types(p, changed) for p in parts if p is not None]
        held = None
        for p in parts:
            held = p if held is None else held.unionByName(p, allowMissingColumns=True)
        attempt = image.write(held, touched)
    current = image.rows(attempt)
    if current is not None:
        current = _same_types(current, changed)
        if set(keys) & changed.keys():  # another type, another spelling, another bucket
            current = current.withColumn(BUCKET, bucket_of(keys, line, count))
    of_current = {} if current is None else _sizes(current)
    filled = {b: of_batch.get(b, 0) + of_current.get(b, 0) for b in of_batch.keys() | of_current.keys()}
    slices = _slices(filled)
    for some in slices or [[]]:
        mine = [f if f is None or len(slices) < 2 else f.where(F.col(BUCKET).isin(*some)) for f in (current, batch)]
        (step(*mine).repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(BUCKET).parquet(f"{root}/of={count}"))
    for empty in touched - filled.keys():
        _delete(spark, f"{root}/of={count}/{BUCKET}={empty}")
    images = sorted(_folders(spark, before_root), key=lambda s: s.getModificationTime())
    for old_image in images[:-max(1, kept_images)]:
        _delete(spark, old_image.getPath().toString())
    return touched
