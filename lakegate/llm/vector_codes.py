"""Product codes of vectors by exact integer k-means over Hilbert-sorted blocks with boxes.

Components become integers ``floor(scale * x)`` and a vector is cut into equal
consecutive parts, each with a codebook of its own.  Every task cuts its rows into
chunks; in a chunk the rows of each part are sorted along a Hilbert curve and laid
out flat in blocks of ``BLOCK_ROWS`` neighbours, which keep the smallest and largest
corner of their box and the sums of their rows.  The chunks are stored once.

A round sends the codebooks (bounded: entries x dimensions) to the chunks.  Box
distances leave a short list of entries per block: those whose least distance to the
box is within the smallest of the greatest ones, and that are somewhere in the box as
near as the entry nearest to its middle.  A block with one such entry is
assigned by its stored sums without a look at its rows; the others are compared
with their list by integer kernels over blocks with lists of like length.  A task
returns sums and counts per entry, never rows, and Spark adds them up.  Rows are
not shuffled at all; every chunk stays in one piece from the first round to the codes.

Defined results
* a vector that is null or holds a null, NaN or infinite component is dropped; a
  null vec_id is kept and sorts behind all others, a null label is a label.
* all vectors are taken to have the length of the longest one, rounded up to a
  multiple of the number of parts; shorter ones (also empty ones) end in zeros.
* rows that repeat a vec_id are rows of their own; where the first codebooks must
  choose between them, the lesser integer vector comes first.
* fewer kept rows than entries make smaller codebooks.
* components must be below 2**17 in size, as squared distances are 64-bit integers;
  a larger one raises ValueError.
* an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegate.llm.common import written
from lakegate.llm.segments import groups_of

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
BLOCK_ROWS = 64
CHUNK_BYTES = 4 << 20
LARGEST = 1 << 25
KERNEL_CELLS = 1 << 20
SMALL_INT = (1 << 31) - 1

CHUNK_BLOBS = ("rows", "order", "low", "high", "sums")


def is_finite(embedding: str) -> Column:
    bad = F.exists(F.col(embedding).cast("array<double>"),
                   lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.col(embedding).isNotNull() & ~bad


def to_integers(vectors: list, width: int, scale: int) -> np.ndarray:
    """Vectors as rows of ``width`` integers, zeros behind the shorter ones."""
    out = np.zeros((len(vectors), width), np.float64)
    for row, vector in zip(out, vectors):
        row[:len(vector)] = vector
    out = np.floor(out * scale)
    if out.size and np.abs(out).max() > LARGEST:
        raise ValueError(f"a vector component is larger than {LARGEST // scale}")
    return out.astype(np.int32)


def hilbert_keys(points: np.ndarray) -> np.ndarray:
    """Places along a Hilbert curve through the points' bounding box, on a grid whose key fits in 62 bits."""
    points = points[:, :62].astype(np.int64)
    dims = points.shape[1]
    bits = max(1, min(8, 62 // dims))
    low = points.min(axis=0)
    span = (points.max(axis=0) - low) + 1
    cell = ((points - low) * (1 << bits) // span).T.copy()
    # Turn and reflect each sub-cube so that the curve enters where the one before it left.
    for bit in range(bits - 1, 0, -1):
        below = (1 << bit) - 1
        for axis in range(dims):
            reflected = (cell[axis] >> bit) & 1
            swapped = np.where(reflected, 0, (cell[0] ^ cell[axis]) & below)
            cell[0] ^= np.where(reflected, below, swapped)
            cell[axis] ^= swapped
    for axis in range(1, dims):
        cell[axis] ^= cell[axis - 1]
    turn = np.zeros_like(cell[0])
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where((cell[-1] >> bit) & 1, (1 << bit) - 1, 0)
    cell ^= turn
    keys = np.zeros_like(turn)
    for bit in range(bits - 1, -1, -1):
        for axis in range(dims):
            keys = (keys << 1) | ((cell[axis] >> bit) & 1)
    return keys


@dataclass
class Blocks:
    """One part of one chunk: rows in curve order, their former places, and per block box corners and sums."""

    rows: np.ndarray
    order: np.ndarray
    low: np.ndarray
    high: np.ndarray
    sums: np.ndarray

    @classmethod
    def build(cls, points: np.ndarray) -> Blocks:
        order = np.argsort(hilbert_keys(points), kind="stable").astype(np.int32)
        rows = points[order]
        starts = np.arange(0, len(rows), BLOCK_ROWS)
        return cls(rows, order, np.minimum.reduceat(rows, starts), np.maximum.reduceat(rows, starts),
                   np.add.reduceat(rows.astype(np.int64), starts))

    def sizes(self) -> np.ndarray:
        return np.diff(np.append(np.arange(0, len(self.rows), BLOCK_ROWS), len(self.rows)))

    def shortlists(self, entries: np.ndarray) -> np.ndarray:
        """Per block the entries that can be nearest to a row inside its box."""
        low, high = self.low[:, None, :].astype(np.int64), self.high[:, None, :].astype(np.int64)
        outside = np.maximum(np.maximum(low - entries, entries - high), 0)
        least = (outside * outside).sum(axis=2)
        across = np.maximum(np.abs(entries - low), np.abs(high - entries))
        listed = least <= (across * across).sum(axis=2).min(axis=1, keepdims=True)
        # Against the entry nearest to the middle of the box: out, if farther from every point of the box.
        middle = np.abs(low + high - 2 * entries)
        rival = entries[(middle * middle).sum(axis=2).argmin(axis=1)][:, None, :]
        apart = entries - rival
        lead = 2 * np.maximum(low * apart, high * apart) + rival * rival - entries * entries
        return listed & (lead.sum(axis=2) >= 0)

    def nearest(self, entries: np.ndarray, lists: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry and squared distance of each row of ``blocks`` (padded to whole blocks)."""
        width = self.rows.shape[1]
        index = np.minimum(blocks[:, None] * BLOCK_ROWS + np.arange(BLOCK_ROWS), len(self.rows) - 1)
        found = np.empty(index.shape, np.int64)
        distance = np.empty(index.shape, np.int64)
        lengths = lists[blocks].sum(axis=1)
        classes = np.ceil(np.log2(lengths)).astype(np.int64)
        reach = max(int(np.abs(self.rows).max()), int(np.abs(entries).max()))
        number = np.int32 if width * (2 * reach) ** 2 <= SMALL_INT else np.int64
        for k in np.unique(classes):
            longest = min(1 << int(k), len(entries))
            chosen = np.flatnonzero(classes == k)
            step = max(1, KERNEL_CELLS // (BLOCK_ROWS * longest))
            for at in range(0, len(chosen), step):
                some = chosen[at:at + step]
                # Listed entries first, in their own order; the last one fills up, and a tie goes to the first.
                listed = np.argsort(~lists[blocks[some]], axis=1, kind="stable")[:, :longest]
                place = np.minimum(np.arange(longest), lengths[some][:, None] - 1)
                listed = np.take_along_axis(listed, place, axis=1)
                rows, near = self.rows[index[some]].astype(number), entries[listed].astype(number)
                cells = np.zeros((len(some), BLOCK_ROWS, longest), number)
                for axis in range(width):
                    gap = rows[:, :, None, axis] - near[:, None, :, axis]
                    cells += gap * gap
                best = cells.argmin(axis=2)
                found[some] = np.take_along_axis(listed, best, axis=1)
                distance[some] = np.take_along_axis(cells, best[:, :, None], axis=2)[:, :, 0]
        return found, distance

    def add_to(self, entries: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> None:
        """Add each row to the sums and counts of its nearest entry, whole blocks at once where one entry is left."""
        lists = self.shortlists(entries)
        alone = lists.sum(axis=1) == 1
        sizes = self.sizes()
        only = lists[alone].argmax(axis=1)
        np.add.at(sums, only, self.sums[alone])
        np.add.at(counts, only, sizes[alone])
        open_blocks = np.flatnonzero(~alone)
        if len(open_blocks):
            found, _ = self.nearest(entries, lists, open_blocks)
            real = np.arange(BLOCK_ROWS) < sizes[open_blocks][:, None]
            at = (open_blocks[:, None] * BLOCK_ROWS + np.arange(BLOCK_ROWS))[real]
            np.add.at(sums, found[real], self.rows[at])
            np.add.at(counts, found[real], 1)

    def assign(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry and squared distance of each row, in the rows' former order."""
        every = np.arange(len(self.low))
        found, distance = self.nearest(entries, self.shortlists(entries), every)
        n = len(self.rows)
        out = np.empty(n, np.int64), np.empty(n, np.int64)
        for values, sorted_values in zip(out, (found, distance)):
            values[self.order] = sorted_values.reshape(-1)[:n]
        return out


def pack_blocks(blocks: list[Blocks]) -> dict[str, bytes]:
    return {name: b"".join(getattr(b, name).tobytes() for b in blocks) for name in CHUNK_BLOBS}


def unpack_blocks(chunk: dict, n: int, parts: int, width: int) -> list[Blocks]:
    shape = {"rows": (n, width), "order": (n,)}
    number = {"sums": np.int64}
    arrays = [np.frombuffer(chunk[name], number.get(name, np.int32)).reshape(
        parts, *shape.get(name, (-(-n // BLOCK_ROWS), width))) for name in CHUNK_BLOBS]
    return [Blocks(*(a[p] for a in arrays)) for p in range(parts)]


class VectorCodes:
    """Chunks of ``vectors`` (columns ``vec_id``, ``embedding`` and ``label``) and the codebooks made from them."""

    def __init__(self, vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, scale: int = SCALE,
                 chunk_bytes: int = CHUNK_BYTES):
        self.parts = parts
        self.id_type = vectors.schema["vec_id"].dataType
        self.label_type = vectors.schema["label"].dataType
        kept = vectors.select("vec_id", "embedding", "label").where(is_finite("embedding"))
        longest = kept.agg(F.max(F.size("embedding")).alias("n")).first()["n"] or 0
        self.width = max(1, -(-longest // parts))
        self.codebooks = self._first_codebooks(kept, entries, scale)
        self.chunks = self._chunks(kept, scale, max(BLOCK_ROWS, chunk_bytes // (4 * parts * self.width)))

    def _first_codebooks(self, kept: DataFrame, entries: int, scale: int) -> np.ndarray:
        """The vectors of the smallest ids, as ``(parts, entries, width)``; one small top-k job."""
        integers = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
        first = (kept.select("vec_id", "embedding", integers.alias("i"))
                 .orderBy(F.col("vec_id").asc_nulls_last(), "i").limit(entries).collect())
        rows = to_integers([r["embedding"] for r in first], self.parts * self.width, scale)
        return rows.reshape(len(rows), self.parts, self.width).transpose(1, 0, 2).astype(np.int64)

    def _chunks(self, kept: DataFrame, scale: int, chunk_rows: int) -> DataFrame:
        parts, width = self.parts, self.width
        schema = (f"ids array<{self.id_type.simpleString()}>, labels array<{self.label_type.simpleString()}>, "
                  + ", ".join(f"`{name}` binary" for name in CHUNK_BLOBS))

        def chunk_of(batch: pa.Table) -> pa.RecordBatch:
            points = to_integers(batch.column("embedding").to_pylist(), parts * width, scale)
            packed = pack_blocks([Blocks.build(points[:, p * width:(p + 1) * width]) for p in range(parts)])
            whole = [pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()),
                                              batch.column(c).combine_chunks()) for c in ("vec_id", "label")]
            return pa.RecordBatch.from_arrays(
                whole + [pa.array([packed[name]], pa.binary()) for name in CHUNK_BLOBS],
                names=["ids", "labels", *CHUNK_BLOBS])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            waiting, n = [], 0
            for batch in batches:
                while batch.num_rows:
                    some = batch.slice(0, chunk_rows - n)
                    batch = batch.slice(some.num_rows)
                    waiting.append(some)
                    n += some.num_rows
                    if n == chunk_rows:
                        yield chunk_of(pa.Table.from_batches(waiting))
                        waiting, n = [], 0
            if n:
                yield chunk_of(pa.Table.from_batches(waiting))

        return written(kept.mapInArrow(run, schema))

    def _per_chunk(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, list[Blocks]]]:
        for row in groups_of(batches, 1):
            n = len(row.column("ids")[0])
            blobs = {name: row.column(name)[0].as_buffer() for name in CHUNK_BLOBS}
            yield row, n, unpack_blocks(blobs, n, self.parts, self.width)

    def _tasks(self) -> VectorCodes:
        """What task code needs of this object."""
        copy = object.__new__(VectorCodes)
        copy.parts, copy.width, copy.codebooks = self.parts, self.width, self.codebooks
        return copy

    def refine(self) -> None:
        """One round: assign every part, then move each used entry to the floor of its rows' mean."""
        if not self.codebooks.size:
            return
        task = self._tasks()
        shape = self.codebooks.shape

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, counts = np.zeros(shape, np.int64), np.zeros(shape[:2], np.int64)
            for _, _, blocks in task._per_chunk(batches):
                for p, block in enumerate(blocks):
                    block.add_to(task.codebooks[p], sums[p], counts[p])
            used = np.flatnonzero(np.repeat(counts.reshape(-1), shape[2]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(used), pa.array(np.repeat(counts.reshape(-1), shape[2])[used]), pa.array(sums.reshape(-1)[used])],
                names=["cell", "n", "total"])

        # at most parts x entries x width rows reach the driver, whatever the table's size
        cells = (self.chunks.mapInArrow(run, "cell long, n long, total long").groupBy("cell")
                 .agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(20,0)")).alias("total")).collect())
        moved = self.codebooks.reshape(-1).copy()
        for cell in cells:
            moved[cell["cell"]] = int(cell["total"]) // cell["n"]
        self.codebooks = moved.reshape(shape)

    def encode(self) -> DataFrame:
        """``vec_id, label, code, error``: two hex digits per part, and the squared distance to the coded vector."""
        task = self._tasks()
        id_type, label_type = self.id_type.simpleString(), self.label_type.simpleString()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row, n, blocks in task._per_chunk(batches):
                found, errors = zip(*(b.assign(task.codebooks[p]) for p, b in enumerate(blocks)))
                digits = np.stack(found, axis=1).astype(np.uint8).tobytes().hex()
                step = 2 * len(blocks)
                yield pa.RecordBatch.from_arrays(
                    [row.column("ids").flatten(), row.column("labels").flatten(),
                     pa.array([digits[i:i + step] for i in range(0, n * step, step)], pa.string()),
                     pa.array(reduce(np.add, errors), pa.int64())],
                    names=["vec_id", "label", "code", "error"])

        return written(self.chunks.mapInArrow(run, f"vec_id {id_type}, label {label_type}, code string, error long"))

    def digest(self) -> str:
        """SHA-256 of all entries' components by part, entry and place, as decimal numbers with commas."""
        return hashlib.sha256(",".join(map(str, self.codebooks.reshape(-1).tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             scale: int = SCALE) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of the vectors with finite components.

    ``entries`` is at most 256 (two hex digits).  Errors are added up per label before
    they meet the rows, so a label of a third of all rows is no single group.
    """
    codes = VectorCodes(vectors, parts, entries, scale)
    for _ in range(rounds):
        codes.refine()
    coded = codes.encode()
    by_label = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return (coded.join(by_label, F.col("label").eqNullSafe(F.col("of")))
            .select("vec_id", "code", "error", "label_error", F.lit(codes.digest()).alias("codebooks_sha256")))
