"""Batch quality operators (QUA-15, 16, 19, 20, AGG-5/7, WIN-1)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakegate.session import cut_lineage


def duplicate_keys(df: DataFrame, keys: Sequence[str], table_name: str) -> DataFrame:
    """QUA-15 / AGG-5: keys seen more than once, one row per key with its count.

    A plain aggregation: partial counts are combined map-side, so a key holding a
    third of the rows costs one counter per task, not one task.
    """
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("error_count")).filter(F.col("error_count") > 1)
    return g.select(F.lit(table_name).alias("table_name"), F.lit(",".join(keys)).alias("column_name"),
                    *keys, F.lit("DUPLICATE_KEY").alias("error_message"), "error_count")


def null_profile(df: DataFrame, columns: Sequence[str], file_col: str = "_file_name") -> DataFrame:
    """QUA-16 / AGG-7: per file non-null counts of every column in one aggregation;
    a file whose columns are all NULL is FILE_EMPTY."""
    counts = [F.count(F.col(f"`{c}`")).alias(f"nonnull_{c}") for c in columns]
    g = df.groupBy(file_col).agg(F.count(F.lit(1)).alias("rows"), *counts)
    nulls = F.concat_ws(",", *[F.when(F.col(f"nonnull_{c}") == 0, F.lit(c)) for c in columns])
    all_null = F.lit(True)
    for c in columns:
        all_null = all_null & (F.col(f"nonnull_{c}") == 0)
    return g.select("*", nulls.alias("all_null_columns"),
                    F.when(all_null, F.lit("FILE_EMPTY")).alias("error_type"))


def quality_issues(accepted: DataFrame, lines: DataFrame, keys: Sequence[str], columns: Sequence[str],
                   table_name: str, repeated: DataFrame | None = None) -> DataFrame:
    """QUA-15 and QUA-16 as one table: keys that accepted lines repeat, and files whose columns are all NULL.
    ``repeated``: ``duplicate_keys`` of the accepted lines, if they are known."""
    text, number = "cast(null as string)", F.col("error_count").cast("long").alias("error_count")
    empty = null_profile(lines, columns).filter(F.col("error_type").isNotNull()).select(
        F.lit(table_name).alias("table_name"), F.col("_file_name").alias("filename"), F.col("all_null_columns").alias("column_name"),
        F.expr(text).alias("key_value"), F.col("error_type").alias("error_message"), F.col("rows").cast("long").alias("error_count"))
    if not keys:
        return empty
    repeated = (duplicate_keys(accepted, keys, table_name) if repeated is None else repeated).select(
        "table_name", F.expr(text).alias("filename"), "column_name",
        F.concat_ws(",", *[F.col(f"`{k}`").cast("string") for k in keys]).alias("key_value"), "error_message", number)
    return repeated.unionByName(empty)


def top_n_per_group(df: DataFrame, group: Sequence[str], order: Sequence[str], n: int,
                    rank_col: str = "sample_rank") -> DataFrame:
    """QUA-19 / SRT-3: the first ``n`` rows of each group (deterministic top-n).

    ``row_number() <= n`` is planned with a partial group limit before the
    shuffle, so every task ships at most ``n`` rows per group even for a hot group.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def dense_line_numbers(df: DataFrame, group: Sequence[str], order: Sequence[str],
                       out: str = "line_number") -> DataFrame:
    """QUA-20 / WIN-1 / H3: 1..n within each group in ``order``, without putting a
    group in one task.

    Rows are range-partitioned on (group, order) so a hot group spreads over many
    tasks; each task numbers its sorted rows with consecutive ids; a reliable
    checkpoint freezes that layout; per (group, task) counts are turned into
    offsets over a frame with one row per (group, task), which is joined back.
    """
    cols = [*group, *order]
    ranged = (df.repartitionByRange(*[F.col(c) for c in cols])
              .sortWithinPartitions(*cols)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mono", F.monotonically_increasing_id()))
    ranged = cut_lineage(ranged)
    stats = ranged.groupBy(*group, "_pid").agg(F.min("_mono").alias("_first"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = stats.select(*[F.col(c).alias(f"_o_{c}") for c in group], F.col("_pid").alias("_o_pid"), "_first",
                        F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    cond = F.col("_pid") == F.col("_o_pid")
    for c in group:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_o_{c}"))
    j = ranged.join(offs, cond, "inner")
    return j.select(*[F.col(f"`{c}`") for c in df.columns],
                    (F.col("_off") + F.col("_mono") - F.col("_first") + 1).cast("long").alias(out))


def file_line_numbers(scan: DataFrame, path_col: str = "_file_path", block_col: str = "_block",
                      rid_col: str = "_rid", out: str = "line_number",
                      store: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """H3 for real files: 1..n per file in file order, no checkpoint needed.

    ``scan`` must carry the file path, the split start (``_metadata.file_block_start``)
    and ``monotonically_increasing_id()`` taken right on the file scan: ids are
    consecutive within a split and a file scan is read the same way every time.
    Per (file, split) counts become offsets over a frame with one row per split,
    which is joined back - a hot file spread over many splits stays spread.
    ``store`` writes the offsets and reads them again: their size is then known
    before the join, which deals out no lines for a few splits.
    """
    stats = scan.groupBy(path_col, block_col).agg(F.min(rid_col).alias("_first"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(path_col).orderBy(block_col).rowsBetween(Window.unboundedPreceding, -1)
    offs = stats.select(F.col(path_col).alias("_o_path"), F.col(block_col).alias("_o_block"), "_first",
                        F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    offs = offs if store is None else store(offs)
    j = scan.join(offs, (scan[path_col] == offs["_o_path"]) & (scan[block_col] == offs["_o_block"]), "inner")
    return j.select(*[F.col(f"`{c}`") for c in scan.columns],
                    (F.col("_off") + F.col(rid_col) - F.col("_first") + 1).cast("long").alias(out))
