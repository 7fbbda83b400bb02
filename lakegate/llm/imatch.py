"""I-Match document fingerprints (native: DataFrame functions only).

Terms are the distinct lower-cased runs of letters and digits.  Document
frequencies over the whole corpus choose the lexicon: terms whose inverse
document frequency ``log2(N / df)`` lies in a band.  The lower end of the band
bounds the lexicon: at most (mean terms of a document) * 2**MAX_IDF terms fit
in, whatever the corpus size, so its bit map has a fixed size.

A fingerprint has one hash per randomised lexicon subset: the hash of the
document's sorted distinct terms in the subset.  A subset of level ``s`` is a
random ``1 / (SUBSETS * 4**s)`` of the lexicon, so long documents are described
by sparser subsets; each document carries two neighbouring levels chosen from
its number of terms, so that about one term meets a subset.  The likeness of two fingerprints is the share of equal
hashes among the subsets that hit either document, at their sparsest common
level, 0 without a common level.

Defined results
* null text counts as empty; a document without lexicon terms falls back to the
  hash of its whole term set, in one subset, so it still equals its copies;
  two empty documents have likeness 1.
* equal texts have equal fingerprints (they depend on the term set alone).
* the next document is the next row in (doc_id, row) order, null ids last, the
  first row after the last; a table of one row is its own next.
* an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakegate.llm.common import bit_filter, stored, text_or_empty, with_row_id

MIN_IDF = 1.0
MAX_IDF = 9.0
SUBSETS = 48
LEXICON_BITS = 24


def terms(text: Column) -> Column:
    """Hashes of the distinct terms of a text."""
    words = F.array_distinct(F.split(F.lower(text), "[^\\p{L}\\p{N}]+"))
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def lexicon(documents: DataFrame, min_idf: float, max_idf: float) -> DataFrame:
    """Term hashes whose idf lies in the band, from ``text`` of all documents."""
    exploded = documents.select(F.explode(terms(F.col("text"))).alias("term"))
    df = exploded.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    n = F.lit(max(1, documents.count()))
    idf = F.log2(n / F.col("df"))
    return df.where((idf >= min_idf) & (idf <= max_idf)).select("term")


def _short_hash(value: Column) -> Column:
    return F.shiftright(F.xxhash64(value), 32).cast("int")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.transform(F.array(value), body)[0]


def fingerprint(all_terms: Column, kept: Column, subsets: int = SUBSETS) -> Column:
    """Two levels, each an array of the level and one 32-bit hash per subset (null: no term of it).

    ``kept`` are the document's lexicon terms, ``all_terms`` all of its terms.
    """
    n = F.size(kept)
    level = F.floor(F.log2(F.greatest(n / F.lit(subsets), F.lit(1.0))) / 2).cast("int")

    def at(offset: int) -> Column:
        s = level + offset
        cells = F.pow(F.lit(4), s).cast("long") * subsets
        mine = F.transform(kept, lambda t: F.struct(F.pmod(F.xxhash64(t, s), cells).alias("c"), t.alias("t")))
        mine = F.sort_array(F.filter(mine, lambda x: x["c"] < subsets))
        hashes = _let(mine, lambda m: F.transform(F.sequence(F.lit(0), F.lit(subsets - 1)), lambda k: _let(
            F.filter(m, lambda x: x["c"] == k), lambda h: F.when(F.size(h) > 0, _short_hash(h)))))
        return F.concat(F.array(s), hashes)

    whole = F.array(F.lit(-1), _short_hash(F.sort_array(all_terms)))
    return F.when(n == 0, F.array(whole, whole)).otherwise(F.array(at(0), at(1)))


def as_text(fp: Column) -> Column:
    """``level:hash.hash...|level:...`` in hexadecimal, '-' for a subset without terms."""
    def one(level: Column) -> Column:
        hashes = F.transform(F.slice(level, 2, F.size(level) - 1),
                             lambda h: F.coalesce(F.substring(F.lpad(F.lower(F.hex(h)), 16, "0"), 9, 8), F.lit("-")))
        return F.concat_ws(":", level[0].cast("string"), F.array_join(hashes, "."))
    return F.array_join(F.transform(fp, one), "|")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes at the sparsest level that both fingerprints carry."""
    def compared(x: Column, y: Column) -> Column:
        pairs = F.arrays_zip(F.slice(x, 2, F.size(x) - 1).alias("x"), F.slice(y, 2, F.size(y) - 1).alias("y"))
        hit = F.filter(pairs, lambda p: p["x"].isNotNull() | p["y"].isNotNull())
        same = F.filter(hit, lambda p: p["x"] == p["y"])
        return F.when(F.size(hit) == 0, F.lit(0.0)).otherwise(F.size(same) / F.size(hit))

    def level(fp: Column, i: int) -> Column:
        return fp[i][0]

    return (F.when(level(a, 1) == level(b, 1), compared(a[1], b[1]))
            .when(level(a, 1) == level(b, 0), compared(a[1], b[0]))
            .when(level(a, 0) == level(b, 1), compared(a[0], b[1]))
            .otherwise(F.lit(0.0)))


def next_rows(ids: DataFrame) -> DataFrame:
    """``_row, doc_id, _n, _next`` for rows ``_row, doc_id, _n``: the following row in id order, the first after the last.

    Range partitions hold consecutive ids; each looks ahead on its own, and one
    row per partition, its first, links the partitions.
    """
    parts = stored(ids.repartitionByRange(
        ids.sparkSession.sparkContext.defaultParallelism * 4, F.col("doc_id").asc_nulls_last(), F.col("_row"))
        .withColumn("_p", F.spark_partition_id()))
    order = [F.col("doc_id").asc_nulls_last(), F.col("_row")]
    inside = parts.withColumn("_next", F.lead("_row").over(W.partitionBy("_p").orderBy(*order)))
    heads = (parts.groupBy("_p").agg(F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "_row")).alias("h"))
             .select("_p", F.col("h._row").alias("_head")))
    around = W.orderBy("_p")
    linked = heads.select(
        "_p", F.coalesce(F.lead("_head").over(around), F.first("_head").over(
            around.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))).alias("_after"))
    return (inside.join(linked, "_p").select("_row", "doc_id", "_n", F.coalesce("_next", "_after").alias("_next")))


def with_edits(docs: DataFrame) -> DataFrame:
    """``_row, doc_id, text, edited, _next``: the last quarter replaced by the start of the next document."""
    base = with_row_id(docs).select("_row", "doc_id", text_or_empty().alias("text"))
    order = stored(next_rows(base.select("_row", "doc_id", F.length("text").alias("_n"))))
    this, after = (base.select(F.col("_row").alias(name), "text") for name in ("_this", "_next"))  # one shuffle for both
    quarter = F.floor(F.col("_n") / 4).cast("int")
    starts = (after.join(order, "_next")
              .select(F.col("_row").alias("_this"), "doc_id", "_next", F.substring(F.col("text"), F.lit(1), quarter).alias("_start"),
                      (F.col("_n") - quarter).alias("_keep")))
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.col("_keep")), F.col("_start"))
    return this.join(starts, "_this").select(F.col("_this").alias("_row"), "doc_id", "text", edited.alias("edited"), "_next")


def fingerprints(docs: DataFrame, min_idf: float = MIN_IDF, max_idf: float = MAX_IDF,
                 subsets: int = SUBSETS) -> DataFrame:
    """Per row ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``."""
    words = stored(lexicon(docs.select(text_or_empty().alias("text")), min_idf, max_idf))
    in_lexicon = bit_filter(words, "term", LEXICON_BITS)
    about = ("_row", "doc_id", "_next", "n_chars", "edited_sha256")
    kept = with_edits(docs).select(
        "_row", "doc_id", "_next", F.length("text").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        F.array(terms(F.col("text")), terms(F.col("edited"))).alias("_terms"),
        in_lexicon.words().alias("_lexicon")).select(*about, F.transform("_terms", lambda all_terms: F.struct(
            all_terms.alias("t"), F.filter(all_terms, lambda t: in_lexicon(t, F.col("_lexicon"))).alias("k"))).alias("_k"))
    done = stored(kept.select(
        *about, fingerprint(F.col("_k")[0]["t"], F.col("_k")[0]["k"], subsets).alias("fp"),
        fingerprint(F.col("_k")[1]["t"], F.col("_k")[1]["k"], subsets).alias("edited_fp")))
    after = done.select(F.col("_row").alias("_next"), F.col("fp").alias("next_fp"))
    return done.join(after, "_next").select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256",
        as_text(F.col("fp")).alias("fingerprint"), as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))
