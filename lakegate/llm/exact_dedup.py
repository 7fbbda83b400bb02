"""Exact duplicates by progressive refinement (native: DataFrame functions only).

Texts count as equal when they are identical after deleting all white space
``[\\x20\\x09-\\x0D]``.  Refinement: (1) length of the normalised text and a hash
of its first characters, both from one scan, grouped with partial aggregation;
(2) only rows of groups with more than one row get the full SHA-256; (3) rows of
equal length and full hash form a group.

Defined results
* null text counts as empty; all empty texts form one group.
* of a group the row with the most code points in its original text stays, then
  the smallest doc_id (a null doc_id last), then the first row of the table, so
  exactly one row of a group stays also where whole rows repeat.
* an empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegate.llm.common import ASCII_SPACE, bit_filter, stored, text_or_empty, with_row_id, without_rows

PREFIX_CHARS = 64


def normalised(text: Column) -> Column:
    """The text without white space."""
    for ch in ASCII_SPACE:
        text = F.replace(text, F.lit(ch), F.lit(""))
    return text


def refine(docs: DataFrame, prefix_chars: int = PREFIX_CHARS, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: ``_row, doc_id, keep_id, group_size, kept`` and ``carry``.

    ``docs`` must be a stored table (its row numbers are taken from the scan).
    """
    norm = normalised(text_or_empty())
    base = with_row_id(docs).select(
        "_row", "doc_id", F.length(text_or_empty()).alias("_n"), norm.alias("_norm"), *carry)
    first = base.select(F.length("_norm").alias("_len"),
                        F.xxhash64(F.substring("_norm", 1, prefix_chars)).alias("_prefix"))
    shared = (first.groupBy("_len", "_prefix").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
              .select(F.xxhash64("_len", "_prefix").alias("_key")))
    survives = bit_filter(shared, "_key")
    key = F.xxhash64(F.length("_norm"), F.xxhash64(F.substring("_norm", 1, prefix_chars)))
    rows = stored(base.select(
        "_row", "doc_id", "_n", F.length("_norm").alias("_len"),
        F.when(survives(key), F.sha2("_norm", 256)).alias("_full"), *carry))
    best = F.min(F.struct((-F.col("_n")).alias("n"), F.col("doc_id").isNull().alias("z"), "doc_id", "_row"))
    groups = stored(rows.where("_full is not null").groupBy("_len", "_full")
                          .agg(F.count(F.lit(1)).alias("group_size"), best.alias("_best")).where("group_size > 1")
                          .select("_len", "_full", "group_size", F.col("_best.doc_id").alias("keep_id"),
                                  F.col("_best._row").alias("_keep_row")))
    out = ("_row", "doc_id", "keep_id", "group_size", "kept", *carry)
    alone = rows.where("_full is null").select(
        "_row", "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), *carry)
    grouped = (rows.where("_full is not null").join(groups, ["_len", "_full"], "left")
               .select("_row", "doc_id", F.when(F.col("group_size").isNull(), F.col("doc_id"))
                       .otherwise(F.col("keep_id")).alias("keep_id"),
                       F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                       F.coalesce(F.col("_row") == F.col("_keep_row"), F.lit(True)).alias("kept"), *carry))
    return alone.select(*out).unionByName(grouped.select(*out))


def drop_copies(docs: DataFrame, prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    dropped = stored(refine(docs, prefix_chars).where(~F.col("kept")).select("_row"))
    return without_rows(docs, dropped)
