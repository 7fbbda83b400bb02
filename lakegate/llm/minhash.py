"""Near duplicates by circulant MinHash, banding and exact Jaccard confirmation.

Two permutations of the 32-bit integers make a whole signature: the first
scrambles the shingle hashes, the second, shifted circularly by k, gives the k-th
coordinate.  Bands of coordinates are bucket keys; candidate pairs are confirmed
on the full shingle sets.

Equal sets are one node from the start.  In a bucket every node meets the
bucket's first node (its hub), never all of its pairs; afterwards only buckets
that still hold several components matter.  Small ones compare the pairs across
components (at most ``SMALL`` / 2 per row).  Large ones that share nodes are
joined into families; a family's nodes are dealt to blocks of bounded size, and a
task takes two blocks, counts all their intersections as a matrix product, and
returns no more than one link per node.  So no candidate is dropped, no group is
in one task, and no list of a group's pairs is ever made.

Defined results
* words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; fewer than five words
  make one shingle; a text without words (or null) has no shingle and is linked
  with nothing.
* repeated rows and equal sets are linked with each other.
* component_id is the smallest doc_id reachable; of rows that repeat that doc_id
  all are marked kept, the stage keeps the first one.
* an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegate.llm.common import bit_filter, small_batches, stored, with_row_id, without_rows
from lakegate.llm.components import components
from lakegate.llm.segments import WordHashes, shingles

SHINGLE_WORDS = 5
THRESHOLD_PERCENT = 75
BANDS = 32
BAND_ROWS = 4
SMALL = 32
BLOCK = 192
_CHUNK = 4096


def _permute(x: np.ndarray, a: int, b: int) -> np.ndarray:
    """A permutation of the 32-bit integers, in place."""
    x *= np.uint32(a)
    x ^= x >> np.uint32(15)
    x *= np.uint32(b)
    x ^= x >> np.uint32(13)
    return x


def signature(shingle_set: np.ndarray, size: int) -> np.ndarray:
    """Circulant MinHash: coordinate k is min over the set of pi(sigma(x) + k)."""
    start = _permute((shingle_set >> np.uint64(32)).astype(np.uint32), 0x85EBCA6B, 0xC2B2AE35)
    shifts = np.arange(size, dtype=np.uint32)[:, None]
    least = np.full(size, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(start), _CHUNK):
        least = np.minimum(least, _permute(start[None, at:at + _CHUNK] + shifts, 0x9E3779B1, 0x846CA68B).min(axis=1))
    return least


def band_keys(sig: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key per band, different between bands."""
    rows = sig.reshape(bands, -1).astype(np.uint64)
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for j in range(rows.shape[1]):
        key = (key ^ rows[:, j]) * np.uint64(0xFF51AFD7ED558CCD)
        key ^= key >> np.uint64(32)
    return key.view(np.int64)


def signatures(docs: DataFrame, shingle_words: int, bands: int, band_rows: int) -> DataFrame:
    """``_row, doc_id, n_shingles, set_id, bands`` of ``_row, doc_id, text``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sizes, ids, keys = [], [], []
            for text in batch.column("text"):
                found = shingles(hashes.of(text.as_py()), shingle_words)
                sizes.append(len(found))
                ids.append(xxhash.xxh3_128_digest(found.tobytes()))
                keys.append(band_keys(signature(found, bands * band_rows), bands) if len(found) else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64()))], names=["_row", "doc_id", "n_shingles", "set_id", "bands"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("_row", "doc_id", "text").mapInArrow(
        run, f"_row long, doc_id {id_type}, n_shingles long, set_id binary, bands array<long>")


def confirmed(pairs: DataFrame, texts: DataFrame, shingle_words: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` of rows whose full shingle sets reach the threshold."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("_row")).distinct()
    maybe = bit_filter(ends, "_row")
    some = texts.select("_row", "text").where(maybe(F.col("_row")))
    with_b = pairs.join(some.select(F.col("_row").alias("b"), F.col("text").alias("text_b")), "b")
    both = with_b.join(some.select(F.col("_row").alias("a"), F.col("text").alias("text_a")), "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        last, left = None, np.zeros(0, np.uint64)
        for batch in batches:
            keep = []
            for a, text_a, text_b in zip(batch.column("a").to_pylist(), batch.column("text_a"), batch.column("text_b")):
                if a != last:
                    last, left = a, shingles(hashes.of(text_a.as_py()), shingle_words)
                right = shingles(hashes.of(text_b.as_py()), shingle_words)
                same = len(np.intersect1d(left, right, assume_unique=True))
                keep.append(100 * same >= percent * (len(left) + len(right) - same))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _labelled(rows: DataFrame, comp: DataFrame) -> DataFrame:
    """``rows`` with the component of their node (itself without links)."""
    return rows.join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _sizes_allow(percent: int):
    return 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")


def _hub_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of a bucket's first node with its other nodes, of sizes that can reach the threshold."""
    hubs = stored(rows.groupBy("key").agg(F.min(F.struct("node", "n")).alias("h"))
                        .select("key", F.col("h.node").alias("a"), F.col("h.n").alias("n_a")))
    pairs = rows.join(hubs, "key").where("node <> a").select(
        "a", F.col("node").alias("b"), "n_a", F.col("n").alias("n_b")).where(_sizes_allow(percent))
    return pairs.select("a", "b").distinct()


def _open_buckets(rows: DataFrame, comp: DataFrame) -> DataFrame:
    """The rows ``key, node, n, component, members`` of buckets with several components."""
    labelled = stored(_labelled(rows, comp))
    several = stored(labelled.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                                       F.count(F.lit(1)).alias("members"))
                           .where("lo <> hi").select("key", "members"))
    return stored(labelled.join(several, "key"))


def _cross_pairs(open_rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components in small buckets."""
    left = open_rows.select("key", F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("component").alias("c_a"))
    right = open_rows.select("key", F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("component").alias("c_b"))
    return (left.join(right, "key").where("a < b and c_a <> c_b").where(_sizes_allow(percent))
            .select("a", "b").distinct())


def _block_pairs(open_rows: DataFrame, block: int) -> DataFrame:
    """``pair, node``: the members of each two blocks of each family (and of each block with itself)."""
    hubs = stored(open_rows.groupBy("key").agg(F.min("node").alias("a")))
    family = components(open_rows.join(hubs, "key").select("a", F.col("node").alias("b")))
    sizes = stored(family.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks")))
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    return (family.join(sizes, "component").withColumn("_mine", mine)
            .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select(F.xxhash64("component", F.least("_mine", "_other"), F.greatest("_mine", "_other")).alias("pair"), "node"))


def block_links(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that span the components of the sets that reach the threshold, by counting intersections."""
    count = len(sets)
    sizes = np.array([len(x) for x in sets])
    _, column, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(count), sizes)
    shared = seen[column] > 1
    row, column = row[shared], column[shared]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((count, count), np.float32)
    starts = np.flatnonzero(np.r_[True, column[1:] != column[:-1]]) if len(column) else np.zeros(0, np.int64)
    for at in range(0, len(starts), _CHUNK):
        lo, hi = starts[at], starts[at + _CHUNK] if at + _CHUNK < len(starts) else len(column)
        part = np.unique(column[lo:hi], return_inverse=True)[1]
        held = np.zeros((count, int(part.max()) + 1), np.float32)
        held[row[lo:hi], part] = 1
        common += held @ held.T
    near = 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)
    label = np.arange(count)
    while True:
        least = np.where(near, label[None, :], count).min(axis=1)
        least = np.minimum(least, label)[np.minimum(least, label)]
        if (least == label).all():
            break
        label = least
    return [(int(label[i]), i) for i in range(count) if label[i] != i]


def family_links(open_rows: DataFrame, texts: DataFrame, shingle_words: int, percent: int, block: int) -> DataFrame:
    """Links ``a, b`` that connect whatever is near within the families of large buckets."""
    pairs = stored(_block_pairs(open_rows, block))
    some = pairs.select(F.col("node").alias("_row")).distinct()
    maybe = bit_filter(some, "_row")
    loaded = pairs.join(texts.where(maybe(F.col("_row"))).select(F.col("_row").alias("node"), "text"), "node")

    def run(table: pa.Table) -> pa.Table:
        hashes = WordHashes()
        sets = [shingles(hashes.of(t.as_py()), shingle_words) for t in table.column("text")]
        found = block_links(sets, percent)
        node = table.column("node").to_pylist()
        return pa.table({"a": pa.array([node[i] for i, _ in found], pa.int64()),
                         "b": pa.array([node[j] for _, j in found], pa.int64())})

    return loaded.groupBy("pair").applyInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, percent: int = THRESHOLD_PERCENT,
                    bands: int = BANDS, band_rows: int = BAND_ROWS, small: int = SMALL,
                    block: int = BLOCK) -> DataFrame:
    """``_row, doc_id, n_shingles, component_id, kept, first`` per row of a stored table.

    ``first`` marks one row of each component: the first of those kept.
    """
    small_batches(docs.sparkSession)
    texts = with_row_id(docs).select("_row", "doc_id", "text")
    sig = stored(signatures(texts, shingle_words, bands, band_rows))
    sets = stored(sig.where("n_shingles > 0").groupBy("set_id").agg(F.min("_row").alias("node")))
    member = stored(sig.where("n_shingles > 0").select("_row", "doc_id", "n_shingles", "set_id").join(sets, "set_id")
                          .select("_row", "doc_id", "n_shingles", "node"))
    is_node = bit_filter(sets, "node")
    nodes = stored(sig.where("n_shingles > 0").where(is_node(F.col("_row")))
                         .join(sets.select(F.col("node").alias("_row")), "_row", "left_semi")
                         .select(F.col("_row").alias("node"), F.col("n_shingles").alias("n"), "bands"))

    exploded = nodes.select("node", "n", F.explode("bands").alias("key"))
    shared = stored(exploded.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key"))
    maybe = bit_filter(shared, "key", 24)
    rows = stored(exploded.where(maybe(F.col("key"))).join(shared, "key").select("key", "node", "n"))

    links = stored(confirmed(stored(_hub_pairs(rows, percent)), texts, shingle_words, percent))
    opened = _open_buckets(rows, components(links))
    across = stored(_cross_pairs(opened.where(F.col("members") <= small), percent))
    links = links.unionByName(confirmed(across, texts, shingle_words, percent)).unionByName(
        family_links(opened.where(F.col("members") > small), texts, shingle_words, percent, block))
    comp = components(links)
    located = stored(_labelled(member, comp).select("_row", "doc_id", "n_shingles", "component"))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "_row"))
    lowest = stored(located.groupBy("component").agg(best.alias("m")).select(
        "component", F.col("m.doc_id").alias("component_id"), F.col("m._row").alias("_first")))
    linked = located.join(lowest, "component").select(
        "_row", "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
        (F.col("_row") == F.col("_first")).alias("first"))
    empty = sig.where("n_shingles = 0").select(
        "_row", "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"),
        F.lit(True).alias("first"))
    return linked.unionByName(empty)


def drop_near_duplicates(docs: DataFrame, **parameters) -> DataFrame:
    """One row of each component, with the columns of ``docs``."""
    dropped = stored(near_duplicates(docs, **parameters).where(~F.col("first")).select("_row"))
    return without_rows(docs, dropped)
