"""Language identification by compression with per-language dictionaries.

For each language a raw-content zstandard dictionary is made of excerpts of
labelled documents.  A lower-cased text is cut into equal windows, every window
is compressed with every dictionary, and the language with the least total wins.
Short windows are compressed behind a primer of their language, whose own cost is
taken off, so that they are never stored uncompressed and their bytes still count.
A document is rejected where the margin to the second language is narrow.

Defined results
* null text, or text without a letter: language ``und``, score 0, rejected.
* the score is the margin: what the winner saves on the second, 0 to 1; with one
  learned language it is 1.
* ties go to the first language by code point.
* training without any labelled document gives ``und`` for every text.
* repeated rows get the same answer; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegate.llm.common import fresh, small_batches
from lakegate.llm.zdict import compressor, sample_condition

SAMPLE_DOCUMENTS = 400
EXCERPT_CHARS = 400
DICTIONARY_BYTES = 32768
PRIMER_BYTES = 2000
WINDOW_BYTES = 8192
SHORT_BYTES = 512
MIN_MARGIN = 0.002
RESULT = "lang string, score double, rejected boolean"


def train(labelled: DataFrame, sample_documents: int = SAMPLE_DOCUMENTS) -> dict[str, tuple[bytes, bytes]]:
    """Per language of ``doc_id, text, lang`` the dictionary and the primer.

    Fitted on a sample of about ``sample_documents`` documents of each language,
    of each its first ``EXCERPT_CHARS`` characters.
    """
    small_batches(labelled.sparkSession)
    rows = labelled.where("lang is not null and text is not null")
    chosen, _ = sample_condition(rows, "lang", sample_documents)
    excerpts: dict[str, list[str]] = {}
    for r in rows.where(chosen).select("lang", "doc_id", F.substring("text", 1, EXCERPT_CHARS).alias("t")).collect():
        excerpts.setdefault(r["lang"], []).append((str(r["doc_id"]), r["t"]))
    model = {}
    for lang in sorted(excerpts):
        texts = [t for _, t in sorted(excerpts[lang], key=lambda x: (x[0][::-1], x[1]))]
        raw = " ".join(texts).lower().encode("utf-8", "surrogatepass")
        cut = max(min(DICTIONARY_BYTES, len(raw) - PRIMER_BYTES), len(raw) // 2)
        model[lang] = (raw[:cut][:DICTIONARY_BYTES] or b" ", raw[cut:cut + PRIMER_BYTES])
    return model


class Identifier:
    """Applies a model inside a task."""

    def __init__(self, model: dict[str, tuple[bytes, bytes]], min_margin: float):
        self.min_margin = min_margin
        self.known = []
        for lang, (raw, primer) in model.items():
            c = compressor(raw)
            self.known.append((lang, c, primer, len(c.compress(primer))))

    def of(self, text: str | None) -> tuple[str, float, bool]:
        if not self.known or text is None or not any(map(str.isalpha, text)):
            return "und", 0.0, True
        raw = text.lower().encode("utf-8", "surrogatepass")
        count = max(1, round(len(raw) / WINDOW_BYTES))
        step = -(-len(raw) // count)
        windows = [raw[at:at + step] for at in range(0, len(raw), step)]
        totals = [(sum(len(c.compress(w)) if len(w) >= SHORT_BYTES else max(1, len(c.compress(primer + w)) - base)
                       for w in windows), lang) for lang, c, primer, base in self.known]
        totals.sort()
        best, lang = totals[0]
        margin = 1.0 if len(totals) == 1 else (totals[1][0] - best) / totals[1][0]
        return lang, margin, margin < self.min_margin


def predictor(model: dict[str, tuple[bytes, bytes]], min_margin: float = MIN_MARGIN):
    """A function ``text column -> struct of lang, score, rejected``."""
    @F.pandas_udf(RESULT)
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        identifier = Identifier(model, min_margin)
        for part in parts:
            yield pd.DataFrame([identifier.of(t) for t in part], columns=["lang", "score", "rejected"])

    return predict


def keep_identified(docs: DataFrame, model: dict[str, tuple[bytes, bytes]], min_margin: float = MIN_MARGIN) -> DataFrame:
    """The documents that are not rejected, with the columns of ``docs``."""
    answer = fresh(docs, "_language")
    return (docs.withColumn(answer, predictor(model, min_margin)("text")).where(~F.col(f"{answer}.rejected"))
            .select(*docs.columns))


def fold(doc_id: Column, folds: int) -> Column:
    """The document's fold: CRC-32 of the id as text, modulo ``folds``; 0 for a null id."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds
