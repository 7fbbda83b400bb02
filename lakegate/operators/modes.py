"""Ingestion modes as pure functions of DataFrames (MOD-1..6, MOD-9, JOI-1/2).

Each mode maps (current `_last`, current `_all`, accepted batch) to the new
versions of both tables; writing them is the caller's business
(``lakegate.plans.tables``), so a replayed batch produces the same result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegate.constants import (MODE_DELTA_FROM_FLOW, MODE_FULL_KEY_REPLACE, MODE_FULL_SNAPSHOT,
                                MODE_HISTORIZED, MODE_UPSERT)


FILE_ORDER = ("FILE_EXTRACTION_DATE", "FILE_NAME_RECEIVED")


@dataclass
class ModeResult:
    mode: str
    last: DataFrame | None      # None = `_last` not written by this mode
    all: DataFrame | None
    last_written: bool
    all_written: bool


def _union(a: DataFrame | None, b: DataFrame) -> DataFrame:
    return b if a is None else a.unionByName(b, allowMissingColumns=True)


def full_snapshot(last: DataFrame | None, all_: DataFrame | None, batch: DataFrame) -> ModeResult:
    """MOD-1: `_last` := batch; `_all` += batch."""
    return ModeResult(MODE_FULL_SNAPSHOT, batch, _union(all_, batch), True, True)


def delta_from_flow(last: DataFrame | None, all_: DataFrame | None, batch: DataFrame) -> ModeResult:
    """MOD-2 (D13): `_all` += batch; `_last` untouched."""
    return ModeResult(MODE_DELTA_FROM_FLOW, last, _union(all_, batch), False, True)


def historized(last: DataFrame | None, all_: DataFrame | None, batch: DataFrame) -> ModeResult:
    """MOD-4 (D16): append to both tables."""
    return ModeResult(MODE_HISTORIZED, _union(last, batch), _union(all_, batch), True, True)


def _has_null_key(keys: Sequence[str]) -> Column:
    out = F.lit(False)
    for k in keys:
        out = out | F.col(f"`{k}`").isNull()
    return out


def latest_per_key(df: DataFrame, keys: Sequence[str], cmp: str, tiebreak: Sequence[str]) -> DataFrame:
    """D15/H7: one row per key: highest ``cmp`` (NULL lowest), then highest ``tiebreak``.

    An aggregation of ``max(struct(...))``: partial maxima are combined map-side,
    so a key with millions of rows costs one value per task.
    """
    cols = [c for c in df.columns if c not in keys]
    packed = F.struct(F.col(f"`{cmp}`").alias("_cmp"), *[F.col(f"`{t}`").alias(f"_t{i}") for i, t in enumerate(tiebreak)],
                      F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_row"))
    best = df.groupBy(*keys).agg(F.max(packed).alias("_best"))
    return best.select(*keys, *[F.col("_best._row")[c].alias(c) for c in cols]).select(*df.columns)


def upsert(last: DataFrame | None, batch: DataFrame, keys: Sequence[str], cmp: str,
           tiebreak: Sequence[str] = ("FILE_NAME_RECEIVED", "FILE_LINE_ID"), null_safe: bool = False,
           repeated: DataFrame | None = None) -> DataFrame:
    """MOD-3 / JOI-1 (D14/D15): per key keep the target row unless the batch row's
    ``cmp`` is strictly greater (a NULL target value loses to a non-NULL one; ties
    keep the target); keys absent from the target are inserted.  Several batch rows
    of one key: the latest ``cmp`` wins (then ``tiebreak``).

    Target and batch are unioned and reduced with one ``max(struct(cmp, is_target,
    tiebreak, row))`` per key - a map-side-combined aggregation, no join, no skew.
    Rows with a NULL key never match anything (``null_safe=True`` lets NULL match NULL);
    ``tiebreak`` must identify a line (file name + line number by default).

    ``repeated``: the keys (columns of their names) that ``batch`` holds more than once, if they are
    known. Without a target the rows of all other keys are the result as they are, and only rows of
    these are aggregated.
    """
    if not keys:
        raise ValueError("upsert needs merge keys (IsMergeKey columns)")
    if repeated is not None and last is None and not null_safe:
        several = repeated.select(*[F.col(f"`{c}`").alias(f"_k_{c}") for c in repeated.columns])
        same_key = _and([F.col(f"`{c}`") == F.col(f"_k_{c}") for c in repeated.columns])
        one_each = upsert(None, batch.join(several, same_key, "left_semi"), keys, cmp, tiebreak)
        return batch.join(several, same_key, "left_anti").unionByName(one_each)
    tb = [F.col(f"`{t}`") for t in tiebreak]
    src = batch.select(*batch.columns, F.lit(0).alias("_is_target"))
    # A column that only one side has (the sheet gained or lost it) is NULL on the other.
    both = src if last is None else src.unionByName(last.withColumn("_is_target", F.lit(1)), allowMissingColumns=True)
    columns = [c for c in both.columns if c != "_is_target"]
    cols = [c for c in columns if c not in keys]
    packed = F.struct(F.col(f"`{cmp}`").alias("_cmp"), F.col("_is_target"),
                      *[t.alias(f"_t{i}") for i, t in enumerate(tb)],
                      F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_row"))
    group = [F.col(f"`{k}`") for k in keys]
    if not null_safe:
        # A row with a NULL key is its own group (its line identity joins the key), so it
        # passes through unchanged - still one aggregation, one pass over the inputs.
        group.append(F.when(_has_null_key(keys), F.struct(F.col("_is_target"), *tb)).alias("_nk"))
    best = both.groupBy(*group).agg(F.max(packed).alias("_best"))
    return best.select(*keys, *[F.col("_best._row")[c].alias(c) for c in cols]).select(*columns)


def key_replace(last: DataFrame | None, batch: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """MOD-5 / JOI-2 (D15): drop every target row whose composite key occurs in the
    batch (left anti join on all keys together), then add all batch rows."""
    if not keys:
        raise ValueError("key replace needs merge keys (IsMergeKey columns)")
    if last is None:
        return batch
    bkeys = batch.select(*[F.col(f"`{k}`").alias(f"_k_{k}") for k in keys]).distinct()
    cond = None
    for k in keys:
        c = F.col(f"`{k}`").eqNullSafe(F.col(f"_k_{k}")) if null_safe else (F.col(f"`{k}`") == F.col(f"_k_{k}"))
        cond = c if cond is None else cond & c
    kept = last.join(bkeys, cond, "left_anti")
    return batch.unionByName(kept, allowMissingColumns=True)


def newest_file(batch: DataFrame, order: Sequence[str] = FILE_ORDER, files: DataFrame | None = None) -> DataFrame:
    """MOD-1 over several files: the rows of the newest file (date, then name); a mode applies
    file by file, so each snapshot replaces the one before. ``files``: the accepted files, where
    the newest one may have no rows."""
    newest = (batch if files is None else files).agg(F.max(F.struct(*order)).alias("_newest"))
    cond = _and([F.col(f"`{c}`").eqNullSafe(F.col(f"_newest.`{c}`")) for c in order])
    return batch.join(newest, cond, "left_semi")


def newest_file_per_key(batch: DataFrame, keys: Sequence[str], order: Sequence[str] = FILE_ORDER,
                        repeated: DataFrame | None = None,
                        store: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """MOD-5 over several files: per key all rows of the newest file that holds it.

    Rows of older files go; a key that one file alone holds loses none, so only keys of several files are
    joined. ``repeated``: the keys (columns of their names) that ``batch`` holds more than once, if they are
    known; no others are looked at. ``store`` writes the keys of several files and reads them again: their size
    is then known before the join, which deals out no rows for a few keys.
    """
    file = F.struct(*order)
    lines = batch
    if repeated is not None:
        some = repeated.select(*[F.col(f"`{k}`").alias(f"_r_{k}") for k in keys])
        lines = batch.join(some, _and([F.col(f"`{k}`").eqNullSafe(F.col(f"_r_{k}")) for k in keys]), "left_semi")
    held = lines.groupBy(*[F.col(f"`{k}`").alias(f"_k_{k}") for k in keys]).agg(
        F.max(file).alias("_newest"), F.min(file).alias("_oldest"))
    several = held.filter(~F.col("_newest").eqNullSafe(F.col("_oldest"))).drop("_oldest")
    several = several if store is None else store(several)
    same_key = [F.col(f"`{k}`").eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    same_file = [F.col(f"`{c}`").eqNullSafe(F.col(f"_newest.`{c}`")) for c in order]
    return batch.join(several, _and(same_key) & ~_and(same_file), "left_anti")


def _and(conditions: Sequence[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def apply_mode(mode: str | None, last: DataFrame | None, all_: DataFrame | None, batch: DataFrame,
               keys: Sequence[str] = (), cmp: str | None = None,
               tiebreak: Sequence[str] = ("FILE_NAME_RECEIVED", "FILE_LINE_ID"), repeated: DataFrame | None = None) -> ModeResult:
    """MOD-6: case-insensitive dispatch; unknown or empty -> DELTA_FROM_FLOW (v2). ``repeated``: see ``upsert``."""
    m = (mode or "").strip().upper()
    if m == MODE_FULL_SNAPSHOT:
        return full_snapshot(last, all_, batch)
    if m == MODE_HISTORIZED:
        return historized(last, all_, batch)
    if m == MODE_UPSERT:
        cmp_col = cmp or "FILE_PROCESS_DATE"
        return ModeResult(MODE_UPSERT, upsert(last, batch, keys, cmp_col, tiebreak, repeated=repeated), _union(all_, batch), True, True)
    if m == MODE_FULL_KEY_REPLACE:
        return ModeResult(MODE_FULL_KEY_REPLACE, key_replace(last, batch, keys), _union(all_, batch), True, True)
    return delta_from_flow(last, all_, batch)


def mode_stats(result: ModeResult, batch: DataFrame) -> DataFrame:
    """MOD-9: mode, rows in the batch and which tables were written (one row)."""
    return batch.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(result.mode).alias("mode"), "rows",
        F.lit(result.last_written).alias("last_written"), F.lit(result.all_written).alias("all_written"))


def validity_ranges(history: DataFrame, keys: Sequence[str], start: str,
                    tiebreak: Sequence[str] = ("FILE_NAME_RECEIVED", "FILE_LINE_ID")) -> DataFrame:
    """D16 (optional view over a historised table): ``valid_from`` = the row's start
    value, ``valid_to`` = the next start of the same key (NULL for the current row).

    A plain ``lead`` over ``partitionBy(keys)`` would put a hot key in one task.
    Here rows are range-partitioned on (keys, start, tiebreak) - a hot key spans
    several tasks - and frozen by a reliable checkpoint; ``lead`` runs within each
    (task, key) slice, and the last row of a slice takes the first start of the
    same key in the next slice, found on a frame with one row per (task, key).
    """
    from pyspark.sql import Window

    from lakegate.session import cut_lineage
    order = [start, *tiebreak]
    cols = [*keys, *order]
    ranged = (history.repartitionByRange(*[F.col(f"`{c}`") for c in cols])
              .sortWithinPartitions(*[F.col(f"`{c}`") for c in cols])
              .withColumn("_pid", F.spark_partition_id()))
    ranged = cut_lineage(ranged)
    w = Window.partitionBy("_pid", *keys).orderBy(*[F.col(f"`{c}`") for c in order])
    inner = ranged.withColumn("_lead", F.lead(F.col(f"`{start}`")).over(w))
    firsts = (ranged.groupBy("_pid", *keys)
              .agg(F.min(F.struct(*[F.col(f"`{c}`").alias(f"_o{i}") for i, c in enumerate(order)]))["_o0"]
                   .alias("_first")))
    wn = Window.partitionBy(*keys).orderBy("_pid")
    nxt = firsts.select(*[F.col(f"`{k}`").alias(f"_n_{k}") for k in keys], F.col("_pid").alias("_n_pid"),
                        F.lead("_first").over(wn).alias("_next_first"))
    cond = F.col("_pid") == F.col("_n_pid")
    for k in keys:
        cond = cond & F.col(f"`{k}`").eqNullSafe(F.col(f"_n_{k}"))
    j = inner.join(nxt, cond, "left")
    return j.select(*[F.col(f"`{c}`") for c in history.columns],
                    F.col(f"`{start}`").alias("valid_from"),
                    F.coalesce(F.col("_lead"), F.col("_next_first")).alias("valid_to"))
