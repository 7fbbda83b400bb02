"""Lines that many documents share, by probing sharded minimal perfect hashes.

Keys (lines stripped of white space at both ends, A-Z lower-cased, long enough)
are hashed to 128 bits.  Per distinct key, partial aggregation counts the
documents that hold it and finds the largest of them.  The distinct keys are
dealt to shards of bounded size; each shard builds a minimal perfect hash, levels
of bit arrays as long as the keys left, that gives every key its own slot in
compact arrays of fingerprints, counts and largest documents.  Lines aren't
joined with lines: they stream through the shard's arrays and probe them.

Defined results
* null and empty texts have one empty line, shorter than any key.
* rows that repeat a doc_id count as one document and lose the same lines; a null
  doc_id counts as smaller than any other.
* a key's lines stay in the largest doc_id that holds it, all of them.
* an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegate.llm.common import ASCII_SPACE, bit_filter, small_batches, stored, with_row_id

MIN_CHARS = 40
MIN_DOCUMENTS = 5
SHARD_KEYS = 1 << 17
NULL_ID = -(1 << 63)
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def line_key(line: str, min_chars: int) -> bytes | None:
    """The key of a line, or None if it is too short to count."""
    key = line.strip(ASCII_SPACE)
    return key.encode("utf-8", "surrogatepass").lower() if len(key) >= min_chars else None


def key_hash(key: bytes) -> tuple[int, int]:
    value = xxhash.xxh3_128_intdigest(key)
    return (value >> 64) - (1 << 63), (value & ((1 << 64) - 1)) - (1 << 63)


def document_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """``_row, doc, line, hi, lo`` of every line with a key in ``_row, doc, text``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, lines, his, los, docs_ = [], [], [], [], []
            for row, doc, text in zip(batch.column("_row").to_pylist(), batch.column("doc").to_pylist(), batch.column("text")):
                for i, line in enumerate((text.as_py() or "").split("\n")):
                    key = line_key(line, min_chars)
                    if key is not None:
                        hi, lo = key_hash(key)
                        rows.append(row), docs_.append(doc), lines.append(i), his.append(hi), los.append(lo)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (rows, docs_, lines, his, los)],
                                             names=["_row", "doc", "line", "hi", "lo"])

    return docs.select("_row", "doc", "text").mapInArrow(run, "_row long, doc long, line long, hi long, lo long")


def _slots(hi: np.ndarray, lo: np.ndarray, level: int, size: int) -> np.ndarray:
    x = (hi.view(np.uint64) ^ (lo.view(np.uint64) * np.uint64(2 * level + 1))) + np.uint64((level * _MIX[0]) % (1 << 64))
    for m in _MIX:
        x = (x ^ (x >> np.uint64(31))) * np.uint64(m)
    return (x ^ (x >> np.uint64(29))) % np.uint64(size)


def build(hi: np.ndarray, lo: np.ndarray) -> list[np.ndarray]:
    """Levels of a minimal perfect hash: at each, the slots that exactly one of the keys left falls into."""
    levels = []
    while len(hi):
        size = max(64, 2 * len(hi))
        slots = _slots(hi, lo, len(levels), size)
        alone = np.bincount(slots.astype(np.int64), minlength=size) == 1
        levels.append(alone)
        left = ~alone[slots.astype(np.int64)]
        hi, lo = hi[left], lo[left]
    return levels


def ranks(levels: list[np.ndarray]) -> list[np.ndarray]:
    """For each level the number of slots taken before each of its slots."""
    found, before = [], 0
    for taken in levels:
        found.append(before + np.cumsum(taken) - taken)
        before += int(taken.sum())
    return found


def locate(levels: list[np.ndarray], starts: list[np.ndarray], hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """The slot of each key, -1 for keys that are certainly unknown."""
    found = np.full(len(hi), -1, np.int64)
    left = np.arange(len(hi))
    for level, (taken, start) in enumerate(zip(levels, starts)):
        slots = _slots(hi[left], lo[left], level, len(taken)).astype(np.int64)
        here = taken[slots]
        found[left[here]] = start[slots[here]]
        left = left[~here]
        if not len(left):
            break
    return found


def shard_index(keys: DataFrame, shards: int) -> DataFrame:
    """One row ``shard, sizes, bits, prints, counts, largest`` per shard of ``hi, lo, n, last``."""
    def run(table: pa.Table) -> pa.Table:
        hi, lo = (table.column(c).to_numpy().astype(np.int64) for c in ("hi", "lo"))
        levels = build(hi, lo)
        at = locate(levels, ranks(levels), hi, lo)
        columns = {}
        for name, source, kind in (("prints", lo & 0xFFFFFFFF, "<u4"), ("counts", table.column("n").to_numpy(), "<i8"),
                                   ("largest", table.column("last").to_numpy(), "<i8")):
            values = np.empty(len(hi), kind)
            values[at] = source
            columns[name] = values.tobytes()
        return pa.table({
            "shard": pa.array([table.column("shard")[0].as_py()], pa.int32()),
            "sizes": pa.array([[len(x) for x in levels]], pa.list_(pa.int64())),
            "bits": pa.array([b"".join(np.packbits(x).tobytes() for x in levels)], pa.binary()),
            **{k: pa.array([v], pa.binary()) for k, v in columns.items()}})

    return (keys.withColumn("shard", F.pmod("hi", F.lit(shards)).cast("int")).groupBy("shard").applyInArrow(
        run, "shard int, sizes array<long>, bits binary, prints binary, counts binary, largest binary"))


def dealt(lines: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """Index rows and probing lines, dealt by shard and salt, each shard's arrays ahead of its lines.

    A shard that more lines probe than others, as it holds a frequent line, is
    copied to as many salts as keep its lines to about twice the mean.
    """
    shard = F.pmod("hi", F.lit(shards)).cast("int").alias("shard")
    asked = lines.groupBy(shard).agg(F.count(F.lit(1)).alias("asked"))
    mean = asked.agg(F.avg("asked").alias("m"))
    salts = stored(asked.select("shard", F.greatest(F.lit(1), F.ceil(
        F.col("asked") / (2 * F.greatest(mean.scalar(), F.lit(1.0))))).cast("int").alias("salts")))
    arrays = (index.join(salts, "shard").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
              .drop("salts").withColumn("probe", F.lit(False)))
    probes = (lines.select(shard, "_row", "doc", "line", "hi", "lo").join(salts, "shard")
              .withColumn("salt", F.pmod(F.xxhash64("_row", "line"), F.col("salts")).cast("int"))
              .drop("salts").withColumn("probe", F.lit(True)))
    return (arrays.unionByName(probes, allowMissingColumns=True).repartition("shard", "salt")
            .sortWithinPartitions("shard", "salt", "probe"))


def probe(rows: DataFrame, min_documents: int) -> DataFrame:
    """``_row, line`` to drop: stream through the dealt rows with one shard's arrays at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = None
        for batch in batches:
            probing = batch.column("probe").to_numpy(zero_copy_only=False)
            heads = np.flatnonzero(~probing).tolist()
            for start, end in zip([0, *heads], [*heads, len(probing)]):
                if start < end and not probing[start]:
                    index = _opened(batch.slice(start, 1).to_pylist()[0])
                    start += 1
                if start < end:
                    part = batch.slice(start, end - start)
                    row, doc, line, hi, lo = (part.column(c).to_numpy() for c in ("_row", "doc", "line", "hi", "lo"))
                    levels, starts, prints, counts, largest = index
                    slot = locate(levels, starts, hi, lo)
                    known = (slot >= 0) & (prints[slot] == (lo & 0xFFFFFFFF).astype(np.uint32))
                    drop = known & (counts[slot] >= min_documents) & (largest[slot] != doc)
                    yield pa.RecordBatch.from_arrays([pa.array(row[drop]), pa.array(line[drop])], names=["_row", "line"])

    columns = ("probe", "_row", "doc", "line", "hi", "lo", "sizes", "bits", "prints", "counts", "largest")
    return rows.select(*columns).mapInArrow(run, "_row long, line long")


def _opened(r: dict) -> tuple:
    """The arrays of one index row."""
    bits, at, levels = np.frombuffer(r["bits"], np.uint8), 0, []
    for size in r["sizes"]:
        width = -(-size // 8)
        levels.append(np.unpackbits(bits[at:at + width], count=size).astype(bool))
        at += width
    return (levels, ranks(levels), np.frombuffer(r["prints"], "<u4"), np.frombuffer(r["counts"], "<i8"),
            np.frombuffer(r["largest"], "<i8"))


def kept_text(rows: DataFrame) -> DataFrame:
    """``rows`` (text, dropped) with ``n_lines``, ``n_dropped`` and ``kept``, the text of the lines that stay."""
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    left = F.array_except(F.sequence(F.lit(0).cast("long"), F.size(lines).cast("long") - 1), "dropped")
    stay = F.transform(left, lambda i: F.get(lines, i.cast("int")))
    kept = F.when(F.size("dropped") == 0, F.coalesce("text", F.lit(""))).otherwise(F.array_join(stay, "\n"))
    return rows.withColumns({"n_lines": F.size(lines).cast("long"), "n_dropped": F.size("dropped").cast("long"), "kept": kept})


def drop_shared_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS,
                      shard_keys: int = SHARD_KEYS) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept`` per row of a stored table with an integer doc_id."""
    small_batches(docs.sparkSession)
    base = with_row_id(docs).select("_row", "doc_id", F.coalesce("doc_id", F.lit(NULL_ID)).cast("long").alias("doc"), "text")
    lines = stored(document_lines(base, min_chars))
    keys = stored(lines.select("hi", "lo", "doc").distinct().groupBy("hi", "lo")
                        .agg(F.count(F.lit(1)).alias("n"), F.max("doc").alias("last")))
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = max(partitions, -(-keys.count() // shard_keys))
    index = stored(shard_index(keys, shards))
    dropped = probe(dealt(lines, index, shards), min_documents)
    per_row = stored(dropped.groupBy("_row").agg(F.collect_list("line").alias("dropped")))
    maybe = bit_filter(per_row, "_row")
    none = F.array().cast("array<bigint>")
    clear = base.where(~maybe(F.col("_row"))).withColumn("dropped", none)
    # always a sort-merge join, so that what it moves grows in step with the input
    touched = base.where(maybe(F.col("_row"))).join(per_row.hint("merge"), "_row", "left").withColumn("dropped", F.coalesce("dropped", none))
    columns = ["doc_id", "text", "dropped"]
    return (kept_text(clear.select(*columns)).unionByName(kept_text(touched.select(*columns)))
            .select("doc_id", "n_lines", "n_dropped", "kept"))
