"""Toxicity by compression distance.

Two dictionaries are made from labelled text.  The ordinary one holds ordinary
text.  The toxic one holds what distinguishes toxic documents: words, or stems of
words, that recur among them and are rare in ordinary text.  A text is cut into short windows at blanks; a window's distance is its
length compressed with the ordinary dictionary less that with both of them, behind the
same primer.  Windows that reach one of several thresholds are hits; a logistic
model of a document's hits at each threshold, fitted on the same sample,
calibrates how much each threshold counts and gives the score.

Defined results
* null and empty texts have no hit: their score is the model's value for that.
* without labelled documents of both kinds every score is the share of toxic ones, or 0.
* repeated rows get the same score; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegate.llm.common import small_batches
from lakegate.llm.zdict import compressor, sample_condition

SAMPLE_DOCUMENTS = 1500
SAMPLE_CHARS = 20000
COMPARED_BYTES = 1 << 21
ORDINARY_BYTES = 32768
TOXIC_BYTES = 4096
WINDOW_BYTES = 64
LONGEST_WINDOW = 128
PRIMER_BYTES = 64
MIN_WORD = 4
MIN_SHARE = 0.02
MAX_ORDINARY = 0.05
LONGEST_STEM = 16
THRESHOLDS = (2, 3, 4, 5, 6)


def _bytes(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "surrogatepass")


def windows(raw: bytes) -> list[bytes]:
    """Consecutive windows of about ``WINDOW_BYTES``, cut at blanks where there is one in reach."""
    found, at = [], 0
    while at < len(raw):
        end = raw.find(b" ", at + WINDOW_BYTES, at + LONGEST_WINDOW)
        end = min(len(raw), at + LONGEST_WINDOW) if end < 0 else end
        found.append(raw[at:end])
        at = end
    return found


class Distance:
    """Window distances under a model, inside a task or on the driver."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        self.head, self.tail = ordinary[:PRIMER_BYTES], ordinary[PRIMER_BYTES:PRIMER_BYTES + 16]
        self.ordinary, self.both = compressor(ordinary), compressor(ordinary + toxic)

    def of(self, raw: bytes) -> np.ndarray:
        framed = [self.head + w + self.tail for w in windows(raw)]
        return np.array([len(self.ordinary.compress(f)) - len(self.both.compress(f)) for f in framed], np.int64)


def distinguishing(toxic: list[bytes], ordinary: bytes) -> bytes:
    """Beginnings of words that recur in toxic documents and are rare in ordinary text, the commonest last.

    A beginning recurs as often as it has different neighbours, so copies of a text
    add nothing.  Each is as long as nearly all of its words agree: a whole word, or
    the stem of its forms.
    """
    met = set()
    for raw in toxic:
        words = [b"", *raw.split(), b""]
        met.update((b, w, a) for b, w, a in zip(words, words[1:], words[2:]) if MIN_WORD <= len(w) <= WINDOW_BYTES)
    counts = Counter(word[:n] for _, word, _ in met for n in range(MIN_WORD, min(len(word), LONGEST_STEM) + 1))
    longer = defaultdict(list)
    for stem in counts:
        longer[stem[:-1]].append(stem)
    share = len(ordinary) / max(1, sum(map(len, toxic)))
    kept = set()
    for stem, n in counts.items():
        if len(stem) == MIN_WORD and n >= max(2, MIN_SHARE * len(toxic)):
            while (best := max(longer[stem], key=counts.__getitem__, default=None)) and counts[best] >= 0.8 * counts[stem]:
                stem = best
            if ordinary.count(b" " + stem) <= MAX_ORDINARY * share * counts[stem]:
                kept.add(stem)
    return b" ".join([b"", *sorted(kept, key=lambda w: (counts[w], w)), b""])[-TOXIC_BYTES:]


def features(distances: np.ndarray, thresholds: tuple[int, ...] = THRESHOLDS) -> list[float]:
    """Constant; then for each threshold whether, how often and in what share windows reach it."""
    found = [1.0]
    for level in thresholds:
        hits = int((distances >= level).sum())
        found += [float(hits > 0), float(np.log1p(hits)), 10.0 * hits / max(1, len(distances))]
    return found


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton steps with a small ridge."""
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(x.shape[1])
    penalty[0, 0] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ w))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, sample_documents: int = SAMPLE_DOCUMENTS) -> dict:
    """A model from ``doc_id, text`` and ``doc_id, toxic``.

    Fitted on a sample of about ``sample_documents`` documents of each label, of
    each its first ``SAMPLE_CHARS`` characters.
    """
    small_batches(docs.sparkSession)
    known = labels.where("toxic in (0, 1) and doc_id is not null").select("doc_id", "toxic")
    chosen, counts = sample_condition(known, "toxic", sample_documents)
    sample = F.broadcast(known.where(chosen))  # bounded by the parameter
    rows = docs.select("doc_id", F.substring("text", 1, SAMPLE_CHARS).alias("t")).join(sample, "doc_id").collect()
    rows = sorted((str(r["doc_id"])[::-1], r["toxic"], _bytes(r["t"])) for r in rows)
    n1, n0 = counts.get(1, 0), counts.get(0, 0)
    toxic, ordinary = ([raw for _, y, raw in rows if y == label] for label in (1, 0))
    if not toxic or not ordinary:
        return {"constant": n1 / max(1, n1 + n0)}
    plain = b" ".join(ordinary)
    model = {"ordinary": plain[:ORDINARY_BYTES], "toxic": distinguishing(toxic, plain[:COMPARED_BYTES])}
    distance = Distance(model["ordinary"], model["toxic"])
    measured = [[distance.of(raw) for raw in part] for part in (ordinary, toxic)]
    x = np.array([features(d) for part in measured for d in part])
    y = np.repeat([0.0, 1.0], [len(ordinary), len(toxic)])
    weights = _fit(x, y)
    weights[0] += np.log(max(n1, 1) / max(n0, 1)) - np.log(len(toxic) / len(ordinary))  # back to the shares of the labels
    model["weights"] = weights.tolist()
    return model


def scorer(model: dict):
    """A function ``text column -> score``."""
    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if "constant" in model:
            for part in parts:
                yield pd.Series(model["constant"], index=part.index, dtype="float64")
            return
        distance, weights = Distance(model["ordinary"], model["toxic"]), np.array(model["weights"])
        for part in parts:
            x = np.array([features(distance.of(_bytes(t))) for t in part]).reshape(-1, len(weights))
            yield pd.Series(1 / (1 + np.exp(-x @ weights)), index=part.index)

    return score
