"""Pack documents into training sequences by harmonic packing.

Each document's token ids (and an end id) are cut greedily into pieces whose
lengths are reciprocals of the capacity: whole sequences first, then a half, a
quarter, and so on down to ``1 / 2**k`` of it, each size once.  Pieces of
``capacity / m`` tokens form class m, whose bins take exactly m pieces and have no
padding.  The rest of a document, shorter than the smallest class, goes to the
last class, whose bins are filled one after the other and cut where they end.
Every worker fills the bins of its own partition; at its end the bins that are
still open are emitted as sequences whose lengths are powers of two, which need
no padding either.  There is no shuffle.

Defined results
* null text is empty: its only token is the end id.
* rows that repeat a doc_id are packed as documents of their own, so their pieces
  repeat too.
* a document of any length is tokenised in slices cut at blanks, which gives the
  ids of the whole text: no token spans a blank.
* an empty table gives an empty result.
"""

from __future__ import annotations

import os
import struct
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegate.llm.common import small_batches
from lakegate.llm.segments import SLICE_CHARS, slices

CAPACITY = 2048
LEAST_PIECE = 32
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
WORD_END = "</w>"
CACHE_CHUNKS = 1 << 18
GROUP = 128
BATCH_ROWS = 4096


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


_MARKS = ".,"
# Kinds of Latin-1 characters: marks, other signs, white space, letters and digits.
_KINDS = bytes(ord("," if c in _MARKS else "a" if c.isalnum() else " " if c.isspace() else "s") for c in map(chr, range(256)))


def chunks_of(text: str) -> list[str]:
    """Blank-free chunks whose ids, one after the other, are those of the text.

    Text of Latin-1 letters is lower-cased here, as the tokenizer would do, and
    unless signs come together a full stop or comma before a blank is split off, as
    the tokenizer does; so a word in its various forms is one chunk.
    """
    text = text.replace("\n", " ")
    try:
        kinds = text.encode("latin-1").translate(_KINDS)
    except UnicodeEncodeError:
        return text.split(" ")
    if "<|" not in text:
        text = text.lower()
    if b"s," not in kinds and b",," not in kinds:
        text = (text + " ").replace(", ", " , ").replace(". ", " . ")
    return text.split(" ")


class TokenIds:
    """Little-endian 32-bit token ids of texts; those of blank-free chunks met of late are kept.

    There are two generations of kept chunks, each of bounded size: when the young
    one is full it becomes the old one, and chunks that are met again move back.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are the parallelism
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    @classmethod
    def of_worker(cls, path: str) -> TokenIds:
        """One for all tasks of a Python worker, which outlives them (task code doesn't)."""
        kept = sys.modules.setdefault("lakegate_worker_state", types.ModuleType("lakegate_worker_state"))
        if getattr(kept, "token_path", None) != path:
            kept.token_path, kept.token_ids = path, cls(path)
        return kept.token_ids

    def learn(self, chunks: set[str]) -> None:
        if len(self.young) + len(chunks) > CACHE_CHUNKS:
            self.old, self.young = self.young, {}
        new = []
        for chunk in chunks:
            ids = self.old.get(chunk)
            if ids is None:
                new.append(chunk)
            else:
                self.young[chunk] = ids
        letters = [c for c in new if c.isalpha()]
        found = self._of_words(letters)
        self.young.update(zip(letters, found))
        rest = new if letters and not found else [c for c in new if not c.isalpha()]
        for chunk, encoded in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)):
            ids = encoded.ids
            self.young[chunk] = struct.pack(f"<{len(ids)}I", *ids)

    def _of_words(self, words: list[str]) -> list[bytes]:
        """The ids of words of letters, encoded as one text and cut behind the ids that end words;
        nothing if the tokenizer sees another number of words in them."""
        if not words:
            return []
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) != len(words) or ends[-1] != len(ids):
            return []
        bounds, raw = [0, *(4 * ends).tolist()], ids.tobytes()
        return [raw[a:b] for a, b in zip(bounds, bounds[1:])]

    def of_many(self, texts: list[str]) -> list[bytes]:
        """The ids of texts of at most a slice each."""
        parts = [chunks_of(t) for t in texts]
        needed = set().union(*parts)
        unknown = needed.difference(self.young)
        if unknown:
            young = self.young
            self.learn(unknown)
            if self.young is not young:
                self.learn(needed.difference(self.young))
        known = self.young.__getitem__
        return [b"".join(map(known, chunks)) for chunks in parts]

    def of(self, text: str) -> bytes:
        return b"".join(self.of_many([part])[0] for part in slices(text))


class Bins:
    """The open bins of one worker; ``done`` collects ``(piece, sequence, offset)``."""

    def __init__(self, capacity: int, least: int, first_sequence: int):
        self.capacity, self.least, self.sequence = capacity, least, first_sequence
        self.open: dict[int, list] = {}
        self.tail, self.tail_size = [], 0
        self.done: list[tuple] = []

    def _close(self, pieces: list) -> None:
        offset = 0
        for piece in pieces:
            self.done.append((piece, self.sequence, offset))
            offset += piece[2]
        self.sequence += 1

    def add(self, doc: int, ids: bytes) -> None:
        """Cut one document; a piece is ``(doc, start, length, ids, document's tokens)``."""
        at, total = 0, len(ids) // 4
        size = self.capacity
        while size >= self.least:
            while total - at >= size:
                waiting = self.open.setdefault(size, [])
                waiting.append((doc, at, size, ids[4 * at:4 * (at + size)], total))
                at += size
                if len(waiting) * size == self.capacity:
                    self._close(self.open.pop(size))
            size //= 2
        while at < total:
            size = min(total - at, self.capacity - self.tail_size)
            self.tail.append((doc, at, size, ids[4 * at:4 * (at + size)], total))
            self.tail_size += size
            at += size
            if self.tail_size == self.capacity:
                self._close(self.tail)
                self.tail, self.tail_size = [], 0

    def finish(self) -> None:
        """Empty the open bins into sequences of power-of-two lengths."""
        for size, pieces in sorted(self.open.items()):
            self._powers(pieces, size * len(pieces))
        self._powers(self.tail, self.tail_size)
        self.open, self.tail, self.tail_size = {}, [], 0

    def _powers(self, pieces: list, total: int) -> None:
        pieces = pieces[::-1]
        while total:
            room = 1 << (total.bit_length() - 1)
            total -= room
            taken = []
            while room:
                doc, start, length, ids, tokens = pieces.pop()
                part = min(length, room)
                taken.append((doc, start, part, ids[:4 * part], tokens))
                if part < length:
                    pieces.append((doc, start + part, length - part, ids[4 * part:], tokens))
                room -= part
            self._close(taken)


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, least_piece: int = LEAST_PIECE,
         end_id: int = END_ID) -> DataFrame:
    """Pieces ``doc_id, start, length, ids, doc_tokens, sequence_id, offset`` of ``doc_id, text``.

    ``ids`` are the piece's token ids as little-endian unsigned 32-bit integers;
    ``capacity`` must be a power of two.  ``tokenizer`` is the path of a tokenizer
    file whose tokens never span a blank.
    """
    small_batches(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    arrow_id = pa.int32() if id_type == "int" else pa.string() if id_type == "string" else pa.int64()
    types = [arrow_id, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    end = np.asarray([end_id], "<u4").tobytes()

    def batches_of(done: list[tuple]) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(done), BATCH_ROWS):
            part = done[at:at + BATCH_ROWS]
            columns = ([p[0] for p, _, _ in part], [p[1] for p, _, _ in part], [p[2] for p, _, _ in part],
                       [p[3] for p, _, _ in part], [p[4] for p, _, _ in part], [s for _, s, _ in part],
                       [o for _, _, o in part])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = TokenIds.of_worker(tokenizer or tokenizer_path())
        bins = Bins(capacity, least_piece, TaskContext.get().partitionId() << 40)
        for batch in batches:
            for at in range(0, batch.num_rows, GROUP):
                group = batch.slice(at, GROUP)
                texts = [t or "" for t in group.column("text").to_pylist()]
                if sum(map(len, texts)) <= SLICE_CHARS:
                    found = iter(tokens.of_many(texts))
                else:
                    found = map(tokens.of, texts)
                for doc, ids in zip(group.column("doc_id").to_pylist(), found):
                    bins.add(doc, ids + end)
                if len(bins.done) >= BATCH_ROWS:
                    yield from batches_of(bins.done)
                    bins.done.clear()
        tokens.old = {}  # what the worker keeps for its next task is one generation
        bins.finish()
        yield from batches_of(bins.done)

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def with_crc(pieces: DataFrame) -> DataFrame:
    """Pieces with the CRC-32 of their ids in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")
