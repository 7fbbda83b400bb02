"""Mix sources to target weights (native: DataFrame functions only).

A low-discrepancy schedule: slot ``i`` is mapped to the golden-ratio point
``frac(i / phi)``, which picks a source through the cumulative weights; a slot's
rank among its source's slots picks one of the source's shuffled blocks of equal
token counts, going round the source again when it is through.  A source's last
slot takes a part of its block, so that its words are its target's, rounded, however
small the source is.  Ranks and token offsets are prefix sums over many small buckets, so a source with a third of all
rows is never one task.

Defined results
* size is the number of words ``[^\\x20\\x09-\\x0D]+``; null text has none.
* sources are ordered by code point, null last, and weigh 1, 2, 3, repeating.
* a source of no words has target 0; documents of no words are taken 0 words.
* rows that repeat a doc_id are mixed as rows of their own.
* an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakegate.llm.common import WORD_PATTERN, bit_filter, stored, fresh, text_or_empty, with_row_id

WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3
BLOCK_WORDS = 128
BUCKETS = 256
SLOT_CHUNK = 4096
GOLDEN_31 = 1327217885
"""2**31 divided by the golden ratio, made odd: i * this mod 2**31 is the golden-ratio point in fixed point."""


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD_PATTERN)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeat: int = MAX_REPEAT) -> DataFrame:
    """``source, source_size, target`` per source from ``source, size``.

    Shares follow the weights; a source that would exceed ``repeat`` times its
    size stops there and the excess is reshared.  In the order of cap per weight
    the sources that stop are a prefix, so one pass of running sums finds the
    common rate of the others.
    """
    total = (sizes.groupBy("source").agg(F.sum("size").alias("source_size")))
    ranked = total.withColumn("_i", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.pmod("_i", F.lit(len(weights))) + 1).cast("int"))
    capped = (ranked.withColumn("_w", weight).withColumn("_cap", F.lit(float(repeat)) * F.col("source_size"))
              .withColumn("_ratio", F.col("_cap") / F.col("_w")))
    order = W.orderBy("_ratio", "_i")
    rated = (capped
             .withColumn("_before", F.coalesce(F.sum("_cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)))
             .withColumn("_left", F.sum("_w").over(order.rowsBetween(0, W.unboundedFollowing)))
             .withColumn("_all", F.sum("source_size").over(order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
             .withColumn("_rate", (F.col("_all") - F.col("_before")) / F.col("_left"))
             .withColumn("_stops", F.col("_rate") > F.col("_ratio"))
             .withColumn("_common", F.first(F.when(~F.col("_stops"), F.col("_rate")), ignorenulls=True)
                         .over(order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))))
    target = F.when(F.col("_stops"), F.col("_cap")).otherwise(F.least(F.col("_cap"), F.col("_common") * F.col("_w")))
    return rated.select("source", "_i", "source_size", target.alias("target"))


def running_total(df: DataFrame, group: str, bucket: str, order: list, value: Column, name: str) -> DataFrame:
    """Add the sum of ``value`` over the earlier rows of ``group`` (buckets in order, then ``order``).

    One window per bucket, one over the bucket sums, and a join of the two.
    """
    valued = df.withColumn("_v", value)
    sums = valued.groupBy(group, bucket).agg(F.sum("_v").alias("_s"))
    before = W.partitionBy(group).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select(group, bucket, F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_start"))
    inside = W.partitionBy(group, bucket).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    local = valued.withColumn("_inside", F.coalesce(F.sum("_v").over(inside), F.lit(0)))
    return (local.join(starts, [group, bucket])
            .withColumn(name, F.col("_start") + F.col("_inside")).drop("_v", "_start", "_inside"))


def schedule(wanted: DataFrame, total: int) -> DataFrame:
    """Slots ``_i (source), rank``: golden-ratio points through the cumulative numbers of slots that sources want.

    ``wanted`` has ``_i, slots`` per source, ``total`` slots in all.  A source has as many slots as it wants: the
    points give it that many but for their small discrepancy, which is dropped or added behind them.
    """
    spark = wanted.sparkSession
    last = F.lead("_i").over(W.orderBy("_i")).isNull()
    ends = (wanted.where("slots > 0")
            .withColumn("_end", F.when(last, F.lit(float("inf"))).otherwise(F.sum("slots").over(W.orderBy("_i")).cast("double")))
            .agg(F.sort_array(F.collect_list(F.struct("_end", "_i"))).alias("a")))
    ends = stored(ends)
    point = (F.pmod(F.pmod("id", F.lit(1 << 31)) * F.lit(GOLDEN_31), F.lit(1 << 31)) + F.lit(0.5)) / F.lit(float(1 << 31))
    drawn = spark.range(total).select(F.col("id").alias("slot"), (point * F.lit(float(total))).alias("_u"),
                                      ends.scalar().alias("_ends"))
    hit = F.element_at(F.filter("_ends", lambda e: e["_end"] > F.col("_u")), 1)["_i"]
    picked = (drawn.select("slot", hit.alias("_i"))
              .withColumn("_chunk", F.floor(F.col("slot") / F.lit(SLOT_CHUNK))))
    ranked = running_total(picked, "_i", "_chunk", ["slot"], F.lit(1), "rank")
    got = F.coalesce("_got", F.lit(0))
    lacking = (wanted.join(picked.groupBy("_i").agg(F.count(F.lit(1)).alias("_got")), "_i", "left").where(got < F.col("slots"))
               .select("_i", F.explode(F.sequence(got, F.col("slots") - 1)).alias("rank")))
    return ranked.join(wanted, "_i").where("rank < slots").select("_i", "rank").unionByName(lacking)


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeat: int = MAX_REPEAT,
        block_words: int = BLOCK_WORDS, buckets: int = BUCKETS) -> DataFrame:
    """``_row, doc_id, size, source_size, target, taken`` per row of a stored table."""
    sized = stored(with_row_id(docs).select(
        "_row", "doc_id", "source", word_count(text_or_empty()).alias("size")))
    targets = stored(source_targets(sized.select("source", "size"), weights, repeat))
    # A source's target in whole rounds through its blocks, whole blocks of a last round, and a part of one block.
    b = F.lit(block_words)
    goal, rest = F.floor(F.col("target") + F.lit(0.5)), F.col("_goal") % F.col("source_size")
    wanted = stored(targets.where("source_size > 0").withColumn("_goal", goal).select(
        "_i", F.ceil(F.col("source_size") / b).alias("_blocks"), (rest % b).alias("_part"),
        F.expr("_goal div source_size").alias("_rounds"), F.floor(rest / b).alias("_more")).select(
        "_i", "_blocks", "_part", (F.col("_rounds") * F.col("_blocks") + F.col("_more")).alias("_whole"))
        .withColumn("slots", F.col("_whole") + F.when(F.col("_part") > 0, 1).otherwise(0)))
    total = wanted.agg(F.coalesce(F.sum("slots"), F.lit(0)).alias("t")).first()["t"]
    tagged = (sized.join(targets.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
              .drop("_s").withColumn("_key", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
    if not total:
        return tagged.select("_row", "doc_id", "size", "source_size", "target", F.lit(0).cast("long").alias("taken"))
    bucket = F.conv(F.substring("_key", 1, 4), 16, 10).cast("int") % F.lit(buckets)
    placed = stored(running_total(tagged.withColumn("_bucket", bucket), "_i", "_bucket", ["_key", "_row"],
                                        F.col("size"), "_at").drop("_bucket", "_key"))
    words = F.when(F.col("rank") < F.col("_whole"), b).otherwise(F.col("_part"))
    used = (schedule(wanted.select("_i", "slots"), total).join(wanted.drop("slots"), "_i")
            .groupBy("_i", (F.col("rank") % F.col("_blocks")).alias("_block"), words.alias("_words"))
            .agg(F.count(F.lit(1)).alias("_times")))
    pieces = (placed.where("size > 0")
              .select("_row", "_i", "_at", "size", F.explode(F.sequence(
                  F.floor(F.col("_at") / b), F.floor((F.col("_at") + F.col("size") - 1) / b))).alias("_block"))
              .select("_row", "_i", "_block", F.greatest(F.col("_at") - F.col("_block") * b, F.lit(0)).alias("_from"),
                      F.least(F.col("_at") + F.col("size") - F.col("_block") * b, b).alias("_to")))
    part = F.greatest(F.least(F.col("_to"), F.col("_words")) - F.col("_from"), F.lit(0))
    taken = (pieces.join(used, ["_i", "_block"]).groupBy("_row").agg(F.sum(part * F.col("_times")).alias("taken")))
    return (placed.join(taken, "_row", "left")
            .select("_row", "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))


def mixed_documents(docs: DataFrame, **parameters) -> DataFrame:
    """The mixed corpus with the columns of ``docs``.

    A document taken t words of its size s comes t div s times whole, and once
    more cut to its first t mod s words where that is not 0.
    """
    key, words = fresh(docs, "_row"), fresh(docs, "_words")
    whole, rest = F.expr("taken div size"), F.col("taken") % F.col("size")
    copies = F.concat(F.array_repeat(F.lit(-1).cast("long"), whole.cast("int")),
                      F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<bigint>")))
    taken = stored(mix(docs, **parameters).where("taken > 0").select(F.col("_row").alias(key), copies.alias(words)))
    maybe = bit_filter(taken, key)
    # always a sort-merge join, so that what it moves grows in step with the input
    rows = (with_row_id(docs, key).where(maybe(F.col(key))).join(taken.hint("merge"), key)
            .withColumn(words, F.explode(words)))
    text = F.when(F.col(words) < 0, F.col("text")).otherwise(first_words(F.col("text"), F.col(words)))
    out = rows.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word, white space kept."""
    parts = F.regexp_extract_all(text, F.lit("[\\x20\\x09-\\x0D]*" + WORD_PATTERN), F.lit(0))
    return F.array_join(F.slice(parts, F.lit(1), n.cast("int")), "")
