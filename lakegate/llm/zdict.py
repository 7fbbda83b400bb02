"""Compression with raw-content zstandard dictionaries, and bounded labelled samples."""

from __future__ import annotations

import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_LABELS = 1000


def compressor(raw: bytes, **parameters) -> zstandard.ZstdCompressor:
    """A compressor primed with ``raw``, tuned for short inputs: long searches, short matches, bare frames."""
    settings = dict(strategy=zstandard.STRATEGY_BTLAZY2, min_match=3, search_log=4, chain_log=15, hash_log=15,
                    window_log=17, target_length=32)
    return zstandard.ZstdCompressor(
        dict_data=zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
        compression_params=zstandard.ZstdCompressionParameters(
            compression_level=3, write_content_size=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
            **(settings | parameters)))


def sample_condition(rows: DataFrame, label: str, per_label: int) -> tuple[Column, dict]:
    """A condition that holds for about ``per_label`` rows of each label, chosen by a hash of doc_id, and the label counts.

    The sample is bounded by the parameter and the number of labels, and needs no shuffle of the rows.
    """
    counts = {r[label]: r["n"] for r in
              rows.groupBy(label).agg(F.count(F.lit(1)).alias("n")).limit(MAX_LABELS + 1).collect()}
    if len(counts) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} labels")
    unit = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    condition = F.lit(False)
    for value, n in counts.items():
        condition = condition | (F.col(label).eqNullSafe(F.lit(value)) & (unit < per_label / n))
    return condition, counts
