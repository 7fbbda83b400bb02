"""Encoding and decoding with a merge-type SentencePiece model.

The encoder finds the merges' result without merging the text.  A sequence of
pieces is that result exactly when every two neighbours, merged again on their own,
stay as they are: the first merge across a border would show in the pair too.  So a
text is read from the left: at each place the Aho-Corasick automaton of the pieces
gives the longest match, shorter ones follow; the first one that is compatible with
the piece before it is taken.  Where none is, the place goes into a bitfield of
failed places and the piece before it is tried shorter.  A prefix has one encoding
only, so a failed place fails for good, and the work stays linear in practice.

A text is cut beforehand where no piece holds the two characters on both sides, as
no merge can cross there: before a blank behind another character, at line ends, and
between a letter and a mark if no piece holds the mark behind a letter.  Encodings of such short segments are kept, for the frequent ones.

Defined results
* null text is empty; an empty text has the begin and end ids only.
* texts of any length are encoded whole; long ones are passed through in groups of
  segments, and decoded in groups of ids cut before a piece with a leading blank.
* strings of control pieces inside a text (``<s>``) are ordinary text.
* rows that repeat a doc_id, also a null one, are rows of their own; an empty table
  gives an empty result; further columns are not looked at.
"""

from __future__ import annotations

import re
import string
import struct
from collections.abc import Callable, Iterator
from itertools import islice

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from lakegate.llm.segments import SLICE_CHARS, Remembered, groups_of, of_worker

MODEL = "piece_bpe_32k.model"
BLANK = "▁"
LATIN = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]"
MATCH_BLOCK = 1 << 12
MATCH_BLOCKS_KEPT = 8
PAIRS_KEPT = 1 << 20
PAIR_BITS = 22
GROUP_SEGMENTS = 1 << 16
GROUP_IDS = 1 << 18
GROUP_DOCS = 128


def model_path(name: str = MODEL) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class Matches:
    """Ids of the pieces that start at a place of ``text``, the shortest first; found for a block of places at a time."""

    def __init__(self, encoder: PieceEncoder, text: str):
        self.encoder, self.text, self.blocks = encoder, text, {}

    def reader(self) -> Callable[[int], list[int]]:
        """What gives the matches at a place; texts of one block need no more than its list."""
        return self._block(0).__getitem__ if len(self.text) <= MATCH_BLOCK else self.at

    def at(self, place: int) -> list[int]:
        number, offset = divmod(place, MATCH_BLOCK)
        block = self.blocks.get(number)
        if block is None:
            if len(self.blocks) == MATCH_BLOCKS_KEPT:
                self.blocks.clear()
            block = self.blocks[number] = self._block(number * MATCH_BLOCK)
        return block[offset]

    def _block(self, start: int) -> list[list[int]]:
        encoder, lengths = self.encoder, self.encoder.lengths
        text = self.text[start:start + MATCH_BLOCK + encoder.longest - 1]
        found = [[c] for c in map(encoder.characters.__getitem__, text[:MATCH_BLOCK])]
        size = len(found)
        for end, piece in encoder.automaton.iter(text):
            first = end - lengths[piece] + 1
            if first < size:
                found[first].append(piece)
        return found


class Characters(dict):
    """Ids of single characters; those without a piece are numbered behind the pieces."""

    def __init__(self, known: dict[str, int], pieces: int):
        super().__init__(known)
        self.pieces = pieces

    def __missing__(self, character: str) -> int:
        return self.pieces + ord(character)


class FailedPlaces:
    """A bit per place of a text."""

    def __init__(self, places: int):
        self.bits = bytearray((places >> 3) + 1)
        self.any = False

    def add(self, place: int) -> None:
        self.any = True
        self.bits[place >> 3] |= 1 << (place & 7)

    def __contains__(self, place: int) -> bool:
        return self.bits[place >> 3] >> (place & 7) & 1 == 1


class PieceEncoder:
    """Ids of texts under a merge-type model with byte fallback, as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        count = self.library.get_piece_size()
        names = self.library.id_to_piece(list(range(count)))
        kinds = self.library
        ordinary = [i for i in range(count) if not (
            kinds.is_control(i) or kinds.is_unknown(i) or kinds.is_byte(i) or kinds.is_unused(i))]
        self.byte_ids = [self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(map(kinds.is_byte, self.byte_ids)):
            raise ValueError("the model has no byte fallback")
        self.ids = {names[i]: i for i in ordinary}
        self.names, self.lengths = names, [len(n) for n in names]
        self.characters = Characters({n: i for n, i in self.ids.items() if len(n) == 1}, count)
        self.scores = {names[i]: kinds.get_score(i) for i in ordinary}
        self.begin, self.end = (struct.pack("<I", i) for i in (kinds.bos_id(), kinds.eos_id()))
        self.starts_with_blank = np.array([n.startswith(BLANK) for n in names])
        self.automaton = ahocorasick.Automaton()
        self.longest = 1
        for piece in self.ids:
            if len(piece) > 1 and self.merged(list(piece)) == [piece]:  # others never come out of merges
                self.automaton.add_word(piece, self.ids[piece])
                self.longest = max(self.longest, len(piece))
        if len(self.automaton):
            self.automaton.make_automaton()
        self.segments = self._segment_pattern()
        self.pairs: dict[int, bool] = {}
        self.known = Remembered(self._encode_segment)

    @classmethod
    def of_worker(cls, path: str) -> PieceEncoder:
        return of_worker(f"pieces {path}", lambda: cls(path))

    def _segment_pattern(self) -> re.Pattern:
        """Segments no merge can cross: no piece holds the characters on both sides of a cut."""
        if not self.never_joined(f"[^{BLANK}]", BLANK):
            return re.compile(r".+", re.DOTALL)
        alone = "\n" if self.never_joined("\n", ".") and self.never_joined(".", "\n") else ""
        marks = self.marks_behind_letters()
        word = [f"{BLANK}*{LATIN}++(?=[{marks}])"] if marks else []
        return re.compile("|".join([*word, f"{BLANK}*[^{BLANK}{alone}]+", *alone, f"{BLANK}+"]))

    def never_joined(self, left: str, right: str) -> bool:
        """Whether no piece holds a character of class ``left`` before one of class ``right``."""
        pair = re.compile(f"(?={left}{right})", re.DOTALL)
        return not any(map(pair.search, self.ids))

    def marks_behind_letters(self) -> str:
        """The ASCII marks, escaped for a class, that no piece holds behind a Latin letter."""
        return "".join(m for m in map(re.escape, string.punctuation) if self.never_joined(LATIN, m))

    def merged(self, symbols: list[str]) -> list[str]:
        """The symbols after all merges: the best score first, the leftmost of equal ones."""
        score = self.scores.get
        while len(symbols) > 1:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                s = score(symbols[i] + symbols[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def _name(self, piece: int) -> str:
        return self.names[piece] if piece < len(self.names) else chr(piece - len(self.names))

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two pieces, merged again from their characters, stay as they are."""
        a, b = self._name(left), self._name(right)
        return self.merged([*a, *b]) == [a, b]

    def pieces(self, text: str) -> list[int]:
        """The pieces of a normalised text, by backtracking; characters without a piece are numbered behind all pieces."""
        at, failed, pairs, lengths = Matches(self, text).reader(), FailedPlaces(len(text)), self.pairs, self.lengths
        if len(pairs) >= PAIRS_KEPT:
            pairs.clear()
        count, size = len(lengths), len(text)
        taken: list[int] = []
        ranks: list[int] = []  # of the taken pieces among the matches where they start
        place, last = 0, -1
        found = at(0) if size else []
        rank = len(found) - 1
        while place < size:
            while rank >= 0:
                piece = found[rank]
                end = place + (lengths[piece] if piece < count else 1)
                if not failed.any or end not in failed:
                    if last < 0:
                        break
                    pair = last << PAIR_BITS | piece
                    fits = pairs.get(pair)
                    if fits is None:
                        fits = pairs[pair] = self.compatible(last, piece)
                    if fits:
                        break
                rank -= 1
            if rank >= 0:
                taken.append(piece)
                ranks.append(rank)
                place, last = end, piece
                if place < size:
                    found = at(place)
                    rank = len(found) - 1
            else:
                failed.add(place)
                piece, rank = taken.pop(), ranks.pop() - 1
                place -= lengths[piece] if piece < count else 1
                last = taken[-1] if taken else -1
                found = at(place)
        return taken

    def ids_of_segment(self, segment: str) -> list[int]:
        """Ids of a normalised segment; characters without a piece as their bytes."""
        ids = self.pieces(segment)
        if max(ids, default=0) < len(self.names):
            return ids
        return [i for piece in ids for i in ((piece,) if piece < len(self.names) else (
            self.byte_ids[b] for b in chr(piece - len(self.names)).encode()))]

    def _encode_segment(self, segment: str) -> bytes:
        ids = self.ids_of_segment(segment)
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """Ids without begin and end."""
        text = self.library.normalize(text)
        if len(text) <= SLICE_CHARS:
            return b"".join(map(self.known.__getitem__, self.segments.findall(text)))
        found = (m.group() for m in self.segments.finditer(text))
        groups = iter(lambda: list(islice(found, GROUP_SEGMENTS)), [])
        return b"".join(b"".join(map(self.known.__getitem__, group)) for group in groups)

    def decode(self, ids: bytes) -> str:
        """The library's decoding of all ids; long ones in groups that begin with a blank, which is put back."""
        numbers = np.frombuffer(ids, "<u4")
        if len(numbers) <= GROUP_IDS:
            return self.library.decode(numbers.tolist())
        cuts, at = [0], GROUP_IDS
        blanks = np.flatnonzero(self.starts_with_blank[numbers])
        while (next_blank := np.searchsorted(blanks, at)) < len(blanks):
            cuts.append(int(blanks[next_blank]))
            at = cuts[-1] + GROUP_IDS
        parts = [self.library.decode(numbers[a:b].tolist()) for a, b in zip(cuts, [*cuts[1:], len(numbers)])]
        return " ".join(parts)


def encode_documents(docs: DataFrame, model: str | None = None) -> DataFrame:
    """``doc_id, ids, decoded``: all ids with begin and end (binary, little-endian unsigned 32 bit) and the text they decode to.

    One pass over the texts without a shuffle; ``model`` is the path of the model file.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder.of_worker(model or model_path())
        for group in groups_of(batches, GROUP_DOCS):
            ids = [encoder.begin + encoder.encode(text or "") + encoder.end for text in group.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [group.column("doc_id"), pa.array(ids, pa.binary()), pa.array(map(encoder.decode, ids), pa.string())],
                names=["doc_id", "ids", "decoded"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, ids binary, decoded string")
