"""Alignment of two tokenizers over the same bytes by merge-path partitioning.

Tokenizer A sees a blank and the text, tokenizer B the text (it adds the blank), so
both cover the same bytes.  The token ends of a batch of documents are two sorted
lists; merging them gives every overlap of an A and a B token, and the ends both have
in common cut the tokens into groups.  The merge is divided beforehand: binary
searches on equally spaced diagonals of the merge grid, all at once, find how many A
and B ends lie before each cut, so every piece has the same work whether it holds a
thousand short documents or a part of a long one.  Pieces emit their overlaps
independently; an end that a cut leaves in two pieces is stitched together, and
groups run on across pieces.

A pair of ids that end together is a link.  Links are counted per document first,
then over the corpus; the counts meet the documents again by a broadcast where the
table of pairs is small (it is bounded by the vocabularies, and its rows are counted),
by a shuffled join beyond that.

Defined results
* null and empty texts, and texts whose tokens do not give back blank + text (a
  ``▁`` inside a text is read as a blank), have no tokens: zeros and empty groups.
* strings of special tokens inside a text are ordinary text.
* rows that repeat a doc_id, also a null one, are rows of their own and all count.
* texts of any length are aligned whole; an empty table gives an empty result;
  further columns are not looked at.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakegate.llm.common import written
from lakegate.llm.piece_encoding import BLANK, GROUP_SEGMENTS, LATIN, PieceEncoder, model_path
from lakegate.llm.segments import SLICE_CHARS, groups_of, of_worker

TOKENIZER_A = "byte_bpe_50k.json"
TOKENIZER_B = "piece_bpe_32k.model"
PIECE_WORK = 1 << 16
GROUP_DOCS = 256
CHUNK_CHARS = 64
CHUNKS_KEPT = 1 << 19
ID_BITS = 24
JOINED_TOKENS = 1 << 18
BROADCAST_PAIRS = 1 << 20

LINK_TYPE = "struct<a:int,b:int,n:long>"

# White space as the byte-level tokenizer sees it (Unicode White_Space).
_SPACE = ("\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B)))
          + "\u2028\u2029\u202f\u205f\u3000")


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable Latin-1 as it is, the rest from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class TokenBytes:
    """The bytes of each id of a vocabulary, and their lengths."""

    def __init__(self, tokens: list[bytes]):
        if len(tokens) > 1 << ID_BITS:
            raise ValueError("vocabulary too large")
        self.tokens = tokens
        self.lengths = np.array([len(t) for t in tokens], np.int64)

    def joined(self, ids: np.ndarray) -> Iterator[bytes]:
        for at in range(0, len(ids), JOINED_TOKENS):
            yield b"".join(map(self.tokens.__getitem__, ids[at:at + JOINED_TOKENS].tolist()))

    def spell(self, ids: np.ndarray, raw: bytes) -> bool:
        if int(self.lengths[ids].sum()) != len(raw):
            return False
        at = 0
        for part in self.joined(ids):
            if raw[at:at + len(part)] != part:
                return False
            at += len(part)
        return True


class ByteEncoder:
    """A byte-level tokenizer: ids of texts, special tokens' strings being ordinary text, and the ids' bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are the parallelism
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        letters = _byte_letters()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        tokens = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            tokens[i] = bytes(map(letters.__getitem__, token)) if all(c in letters for c in token) else token.encode()
        self.bytes = TokenBytes(tokens)

    def encode_many(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def piece_bytes(encoder: PieceEncoder) -> TokenBytes:
    """Pieces in UTF-8 with blanks, byte pieces as their byte, control pieces empty."""
    library = encoder.library
    single = {i: bytes([b]) for b, i in enumerate(encoder.byte_ids)}
    return TokenBytes([
        single.get(i) or (b"" if library.is_control(i) else library.id_to_piece(i).replace(BLANK, " ").encode())
        for i in range(library.get_piece_size())])


class Rows:
    """Rows of ids of different lengths in one flat array."""

    def __init__(self):
        self.flat, self.starts, self.lengths = (np.zeros(0, t) for t in (np.int32, np.int64, np.int64))

    def add(self, rows: list) -> None:
        lengths = np.array([len(r) for r in rows], np.int64)
        self.starts = np.append(self.starts, len(self.flat) + np.cumsum(lengths) - lengths)
        self.lengths = np.append(self.lengths, lengths)
        self.flat = np.append(self.flat, np.fromiter(chain.from_iterable(rows), np.int32, int(lengths.sum())))

    def take(self, rows: np.ndarray) -> np.ndarray:
        """The ids of ``rows`` one after the other."""
        lengths = self.lengths[rows]
        shift = np.repeat(self.starts[rows] - (np.cumsum(lengths) - lengths), lengths)
        return self.flat[shift + np.arange(len(shift))]

    def keep(self, rows: np.ndarray) -> None:
        lengths = self.lengths[rows]
        self.flat, self.lengths = self.take(rows), lengths
        self.starts = np.cumsum(lengths) - lengths


class ChunkIds:
    """A and B ids of chunks that both tokenizers encode in a text as on their own; those met often are kept.

    A splits a text between other characters and white space and between letters and
    marks; a chunk ends at such places if no piece of B holds characters on both sides.
    """

    def __init__(self, a: ByteEncoder, b: PieceEncoder, b_bytes: TokenBytes, entries: int = CHUNKS_KEPT):
        self.a, self.b, self.b_bytes, self.entries = a, b, b_bytes, entries
        self.places: dict[str, int] = {}
        self.a_rows, self.b_rows = Rows(), Rows()
        self.spelt, self.met = np.zeros(0, bool), np.zeros(0, np.int64)
        marks = b.marks_behind_letters()
        word = f"[{_SPACE}]*{LATIN}++(?=[{marks}])|" if marks else ""
        # No cut before white space that a piece of B holds behind another character (such as a return).
        joined = "".join(s for s in _SPACE if not b.never_joined(f"[^{_SPACE}{BLANK}]", BLANK if s == " " else s))
        on = f"(?:[{joined}][{_SPACE}]*[^{_SPACE}]*)*" if joined else ""
        self.pattern = re.compile(f"{word}[{_SPACE}]*[^{_SPACE}]+{on}|[{_SPACE}]+")

    def _learn(self, chunks: list[str]) -> None:
        if not chunks:
            return
        a_ids = self.a.encode_many(chunks)
        b_ids = [self.b.ids_of_segment(c.replace(" ", BLANK)) for c in chunks]
        spelt = [b"".join(map(self.a.bytes.tokens.__getitem__, x)) == b"".join(map(self.b_bytes.tokens.__getitem__, y)) == c.encode()
                 for x, y, c in zip(a_ids, b_ids, chunks)]
        self.spelt = np.append(self.spelt, np.array(spelt, bool))
        self.places.update(zip(chunks, range(len(self.places), len(self.places) + len(chunks))))
        self.a_rows.add(a_ids)
        self.b_rows.add(b_ids)
        self.met = np.append(self.met, np.zeros(len(chunks), np.int64))

    def forget(self) -> None:
        """Keep what was met twice or more lately, and short enough."""
        if len(self.places) > self.entries:
            chunks = list(self.places)
            kept = np.array([i for i in np.flatnonzero(self.met > 1).tolist() if len(chunks[i]) <= CHUNK_CHARS], np.int64)
            kept = kept[np.argsort(-self.met[kept], kind="stable")][:self.entries // 2]
            self.places = {chunks[i]: n for n, i in enumerate(kept.tolist())}
            self.a_rows.keep(kept)
            self.b_rows.keep(kept)
            self.spelt, self.met = self.spelt[kept], self.met[kept] // 2

    def of_many(self, texts: list[str]) -> list[np.ndarray]:
        """The places of the texts' chunks (valid until :meth:`forget`)."""
        short = [self.pattern.findall(t) if len(t) <= SLICE_CHARS else [] for t in texts]
        self._learn([c for c in set().union(*short) if c not in self.places])
        return [self._of_long(t) if len(t) > SLICE_CHARS else np.array(list(map(self.places.__getitem__, c)), np.int64)
                for t, c in zip(texts, short)]

    def _of_long(self, text: str) -> np.ndarray:
        found, parts = (m.group() for m in self.pattern.finditer(text)), []
        while group := list(islice(found, GROUP_SEGMENTS)):
            self._learn([c for c in set(group) if c not in self.places])
            parts.append(np.array(list(map(self.places.__getitem__, group)), np.int64))
        return np.concatenate(parts)


@dataclass
class Overlaps:
    """Overlapping tokens in order: index into A, index into B, byte where the overlap ends, whether both tokens end there."""

    a: np.ndarray
    b: np.ndarray
    end: np.ndarray
    together: np.ndarray

    def part(self, rows: slice) -> Overlaps:
        return Overlaps(self.a[rows], self.b[rows], self.end[rows], self.together[rows])

    def after(self, first: Overlaps) -> Overlaps:
        return Overlaps(*(np.concatenate([getattr(first, f), getattr(self, f)]) for f in ("a", "b", "end", "together")))


def merge_path(ends_a: np.ndarray, ends_b: np.ndarray, work: int) -> tuple[np.ndarray, np.ndarray]:
    """How many A and B ends the merge has taken at each multiple of ``work`` steps (A first where ends are equal).

    The binary searches of all diagonals run side by side.
    """
    total = len(ends_a) + len(ends_b)
    diagonal = np.append(np.arange(0, total, work), total)
    low, high = np.maximum(diagonal - len(ends_b), 0), np.minimum(diagonal, len(ends_a))
    while (low < high).any():
        open_ = low < high
        middle = (low + high) // 2
        # With `middle` A ends taken, is the next A end still to come before the last B end taken?
        b_last = np.where(open_, diagonal - middle - 1, 0)
        more = open_ & (ends_a[np.where(open_, middle, 0)] <= ends_b[b_last])
        low = np.where(more, middle + 1, low)
        high = np.where(open_ & ~more, middle, high)
    return low, diagonal - low


def merge_piece(ends_a: np.ndarray, ends_b: np.ndarray, a0: int, a1: int, b0: int, b1: int) -> Overlaps:
    """The overlaps that end at one of the piece's own ends."""
    mine_a, mine_b = ends_a[a0:a1], ends_b[b0:b1]
    b_of_a = np.searchsorted(mine_b, mine_a)
    a_of_b = np.searchsorted(mine_a, mine_b)
    equal = np.zeros(len(mine_a), bool)
    if len(mine_b):
        equal = (b_of_a < len(mine_b)) & (mine_b[np.minimum(b_of_a, len(mine_b) - 1)] == mine_a)
    alone = np.ones(len(mine_b), bool)
    alone[b_of_a[equal]] = False
    # Where the ends stand in the merged order, each shared end once.
    shared_before = np.concatenate([[0], np.cumsum(equal)])
    at_a = np.arange(len(mine_a)) + b_of_a - shared_before[:-1]
    at_b = (np.arange(len(mine_b)) + a_of_b - shared_before[a_of_b])[alone]
    out = Overlaps(*(np.empty(len(mine_a) + int(alone.sum()), t) for t in (np.int64, np.int64, np.int64, bool)))
    for values_of, a_values, b_values in ((out.a, np.arange(a0, a1), a0 + a_of_b), (out.b, b0 + b_of_a, np.arange(b0, b1)),
                                          (out.end, mine_a, mine_b), (out.together, equal, ~alone)):
        values_of[at_a] = a_values
        values_of[at_b] = b_values[alone]
    return out


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray, work: int = PIECE_WORK) -> Iterator[Overlaps]:
    """All overlaps, piece by piece; an end that two pieces share becomes one common end."""
    taken_a, taken_b = merge_path(ends_a, ends_b, work)
    held = None
    for bounds in zip(taken_a, taken_a[1:], taken_b, taken_b[1:]):
        piece = merge_piece(ends_a, ends_b, *map(int, bounds))
        if held is not None:
            if len(piece.end) and piece.end[0] == held.end[0]:
                held.together[0] = True
                piece = piece.part(slice(1, None))
            piece = piece.after(held)
        if len(piece.end):
            yield piece.part(slice(None, -1))
            held = piece.part(slice(-1, None))
    if held is not None:
        yield held


class Aligner:
    """Aligns documents under one pair of tokenizers; kept by a Python worker."""

    def __init__(self, path_a: str, path_b: str):
        a, b = ByteEncoder(path_a), PieceEncoder.of_worker(path_b)
        self.a_bytes, self.b_bytes, self.normalize = a.bytes, piece_bytes(b), b.library.normalize
        self.chunks = ChunkIds(a, b, self.b_bytes)
        # Ids as they are written in a group: inside and at the end of its A ids, then of its B ids.
        self.written = [f"{i}{mark}" for count, marks in ((len(self.a_bytes.tokens), ",|"), (len(self.b_bytes.tokens), ",;"))
                        for mark in marks for i in range(count)]

    @classmethod
    def of_worker(cls, path_a: str, path_b: str) -> Aligner:
        return of_worker(f"aligner {path_a} {path_b}", lambda: cls(path_a, path_b))

    def _covered(self, text: str) -> bool:
        """Whether B's normaliser only puts blanks; else its pieces spell something else than blank + text."""
        return bool(text) and self.normalize(text) == BLANK + text.replace(" ", BLANK)

    def _spelt(self, text: str, places: np.ndarray) -> bool:
        chunks = self.chunks
        if chunks.spelt[places].all():
            return True
        raw = (" " + text).encode()
        return self.a_bytes.spell(chunks.a_rows.take(places), raw) and self.b_bytes.spell(chunks.b_rows.take(places), raw)

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A and B ids of all texts, and how many of each a text has; none where they don't spell blank + text."""
        chunks = self.chunks
        chunks.forget()
        places = chunks.of_many([" " + t if self._covered(t) else "" for t in texts])
        places = [p if self._spelt(t, p) else p[:0] for t, p in zip(texts, places)]
        every = np.concatenate(places) if places else np.zeros(0, np.int64)
        chunks.met += np.bincount(every, minlength=len(chunks.met))
        text_of = np.repeat(np.arange(len(places)), [len(p) for p in places])
        counts = [np.bincount(text_of, rows.lengths[every], len(places)).astype(np.int64)
                  for rows in (chunks.a_rows, chunks.b_rows)]
        return chunks.a_rows.take(every).astype(np.int64), chunks.b_rows.take(every).astype(np.int64), *counts

    def align(self, texts: list[str], work: int = PIECE_WORK) -> tuple[list[tuple[int, int, int, str]], np.ndarray, np.ndarray]:
        """Per text ``n_a, n_b, n_groups, groups``; and the links of all texts as sorted keys of text, A id and B id with counts."""
        a, b, n_a, n_b = self.ids(texts)
        ends_a, ends_b = np.cumsum(self.a_bytes.lengths[a]), np.cumsum(self.b_bytes.lengths[b])
        common = [(o.a[o.together], o.b[o.together]) for o in overlaps(ends_a, ends_b, work)]
        last_a, last_b = (np.concatenate(x) for x in zip(*common)) if common else (np.zeros(0, np.int64),) * 2
        text_ends_a = np.cumsum(n_a)
        groups = np.diff(np.searchsorted(last_a, text_ends_a), prepend=0)
        strings = self._groups(a, b, last_a, last_b, text_ends_a + np.cumsum(n_b))
        rows = list(zip(n_a.tolist(), n_b.tolist(), groups.tolist(), strings))
        text_of = np.searchsorted(text_ends_a, last_a, side="right")
        keys, counts = np.unique((text_of << 2 * ID_BITS) | (a[last_a] << ID_BITS) | b[last_b], return_counts=True)
        return rows, keys, counts

    def _groups(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray, text_ends: np.ndarray) -> Iterator[str]:
        """``a1,a2|b1;a3|b2,b3`` per text: the A ids of a group before its B ids."""
        count_a, count_b = len(self.a_bytes.tokens), len(self.b_bytes.tokens)
        ends_group_a, ends_group_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
        ends_group_a[last_a], ends_group_b[last_b] = True, True
        b_before = np.concatenate([[0], last_b + 1])[:-1]
        order = np.empty(len(a) + len(b), np.int32)
        order[np.arange(len(a)) + np.repeat(b_before, np.diff(last_a, prepend=-1))] = a + count_a * ends_group_a
        order[np.arange(len(b)) + np.repeat(last_a + 1, np.diff(last_b, prepend=-1))] = 2 * count_a + b + count_b * ends_group_b
        start = 0
        for end in text_ends.tolist():
            parts = ("".join(map(self.written.__getitem__, order[at:min(at + JOINED_TOKENS, end)].tolist()))
                     for at in range(start, end, JOINED_TOKENS))
            yield "".join(parts)[:-1]
            start = end


def align_documents(docs: DataFrame, tokenizer_a: str | None = None, tokenizer_b: str | None = None) -> DataFrame:
    """``doc_id, row, n_a, n_b, n_groups, groups, links`` of ``doc_id, text``, one pass without a shuffle.

    ``groups`` lists the ids of each group, ``links`` the distinct pairs of ids that
    end together with their number; ``row`` numbers the rows and is the same in every
    reading only once stored.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "row", "n_a", "n_b", "n_groups", "groups", "links"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner.of_worker(tokenizer_a or model_path(TOKENIZER_A), tokenizer_b or model_path(TOKENIZER_B))
        row = TaskContext.get().partitionId() << 40
        mask = (1 << ID_BITS) - 1
        for group in groups_of(batches, GROUP_DOCS):
            found, keys, counts = aligner.align([t or "" for t in group.column("text").to_pylist()])
            n_a, n_b, n_groups, strings = zip(*found)
            struct = pa.StructArray.from_arrays(
                [pa.array((keys >> ID_BITS) & mask, pa.int32()), pa.array(keys & mask, pa.int32()), pa.array(counts, pa.int64())],
                names=["a", "b", "n"])
            bounds = np.searchsorted(keys >> 2 * ID_BITS, np.arange(len(found) + 1))
            yield pa.RecordBatch.from_arrays(
                [group.column("doc_id"), pa.array(range(row, row + len(found)), pa.int64()),
                 *(pa.array(c, pa.int64()) for c in (n_a, n_b, n_groups)), pa.array(strings, pa.string()),
                 pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), struct)], names=names)
            row += len(found)

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, row long, n_a long, n_b long, n_groups long, groups string, links array<{LINK_TYPE}>")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``a, b, count, best``: links of each pair of ids in the corpus, and whether none of the B id has more."""
    counts = (aligned.select(F.inline("links")).groupBy("a", "b").agg(F.sum("n").alias("count")))
    return counts.withColumn("best", F.col("count") == F.max("count").over(W.partitionBy("b")))


def with_link_counts(aligned: DataFrame, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """The stored rows of :func:`align_documents` with ``n_links, n_best, count_sum`` in place of ``links``.

    At most ``broadcast_pairs`` counted pairs are broadcast; more are joined by a
    shuffle on both ids.
    """
    pairs = written(pair_counts(aligned))
    small = pairs.limit(broadcast_pairs + 1).count() <= broadcast_pairs
    links = aligned.select("row", F.inline("links"))
    sums = (links.join(F.broadcast(pairs) if small else pairs.hint("merge"), ["a", "b"]).groupBy("row")
            .agg(F.sum("n").alias("n_links"), F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"),
                 F.sum(F.col("n") * F.col("count")).alias("count_sum")))
    filled = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_links", "n_best", "count_sum")]
    return aligned.join(sums, "row", "left").select(*(c for c in aligned.columns if c != "links"), *filled)
