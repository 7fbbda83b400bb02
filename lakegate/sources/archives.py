"""Archive expansion (SRC-1, H6): zip landings -> lines, entries spread over tasks.

The text source cuts archives at the four bytes that begin every entry, so an
archive is read like any large file: in splits, by ranged reads, by as many tasks
as it has splits.  These pieces are stored once; the places of a piece are prefix
sums of lengths, per split and then over an archive's splits, on rows without the
bytes.  An archive's directory, at its end, names the entries and their places: a
piece that begins where no entry does (the four bytes also occur by chance, or in
archives within archives) belongs to the entry before it.  An entry is then opened
by its own task, as an archive of this entry alone, so that checksums and
compression methods are those of ``zipfile``.

Bounds: an entry of up to 2 GB compressed, whatever the size of its archive; an
archive's directory (about 100 bytes an entry) is read by one task.

Entries starting with ``__MACOSX`` or '.', and folders, are skipped; an archive with
no entry left is reported ``No valid files in ZIP``; an unreadable one ``Invalid
ZIP file``.  Parsing the lines into columns is left to ``from_csv`` and
``from_json`` in the JVM, by the format that the entry would have as a landed file.
Lines come with the number of the record they belong to where quoted fields may
hold line ends; such records are put together by a grouping on that number.
"""

from __future__ import annotations

import io
import re
import struct
import sys
import zipfile
import zlib
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakegate.functions.filenames import base_name, plain_path, table_from_filename
from lakegate.session import scratch_path
from lakegate.sources.landing import list_files

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the package

LINES_SCHEMA = ("archive string, entry string, line_no long, row_no long, record_no long, line string, status string, "
                "error string")
_LINES = pa.schema([(f.split()[0], pa.int64() if f.endswith(" long") else pa.string()) for f in LINES_SCHEMA.split(", ")])
CHUNK = 50_000
LINES_AT_ONCE = 10_000
"""Lines of an entry that a task holds before it hands them on."""
ZIPS = "*.[zZ][iI][pP]"
ENTRY_MARK = "PK\x03\x04"
"""The bytes before every entry."""
END_BYTES = 66_000
"""No less than the end records of an archive and the longest comment behind them."""
_DIRECTORY_SCHEMA = "archive string, at long, name string, valid boolean, record binary, error string"
_BROKEN = (zipfile.BadZipFile, OSError, ValueError, RuntimeError, NotImplementedError, EOFError, zlib.error, struct.error)
_QUOTES = re.compile(r'\\.|"')


def _valid_entry(name: str) -> bool:
    leaf = name.rsplit("/", 1)[-1]
    return not (name.startswith("__MACOSX") or name.endswith("/") or leaf.startswith(".") or name.startswith("."))


def _batch(archive: str, entry: str, rows: list[tuple], status: str, error: str | None = None) -> pa.RecordBatch:
    """Rows ``line_no, row_no, record_no, line`` of an entry as LINES_SCHEMA has them."""
    numbers = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.string()))]
    same = [pa.repeat(pa.scalar(x, pa.string()), len(rows)) for x in (archive, entry, status, error)]
    return pa.RecordBatch.from_arrays([*same[:2], *numbers, *same[2:]], schema=_LINES)


class _Numbers:
    """Numbers of the lines that hold anything, and of the records they belong to: a record goes on
    while a quote is open (a backslash escapes one, a doubled one opens and closes)."""

    def __init__(self):
        self.row, self.record, self.open = 0, 0, False

    def of(self, line: str) -> tuple[int | None, int | None]:
        blank = not line.strip()
        if not blank:
            self.row += 1
        if not self.open and not blank:
            self.record += 1
        numbers = (None if blank else self.row, None if blank and not self.open else self.record)
        if '"' in line:
            self.open ^= sum(m == '"' for m in _QUOTES.findall(line)) % 2 == 1
        return numbers


# ------------------------------------------------------------- pieces and their places
def _pieces(spark: SparkSession, root: str | Sequence[str]) -> DataFrame:
    """``archive, block, rid, n, piece``: archives cut at the entry marks, in the order of ``block, rid``."""
    raw = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", ZIPS)
           .option("lineSep", ENTRY_MARK).text(root if isinstance(root, str) else list(root)))
    piece = F.col("value").cast("binary")
    return raw.select(plain_path("_metadata.file_path").alias("archive"), F.col("_metadata.file_block_start").alias("block"),
                      F.monotonically_increasing_id().alias("rid"), F.octet_length(piece).cast("long").alias("n"),
                      piece.alias("piece"))


def _places(pieces: DataFrame) -> DataFrame:
    """``archive, block, rid, n, at``: where in its archive each piece begins, its mark not counted."""
    taken = F.col("n") + F.lit(len(ENTRY_MARK))
    inside = W.partitionBy("archive", "block").orderBy("rid").rowsBetween(W.unboundedPreceding, -1)
    before = W.partitionBy("archive").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    sums = pieces.groupBy("archive", "block").agg(F.sum(taken).alias("_s"))
    starts = sums.select("archive", "block", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_start"))
    return (pieces.select("archive", "block", "rid", "n", F.coalesce(F.sum(taken).over(inside), F.lit(0)).alias("_in"))
            .join(starts, ["archive", "block"])
            .select("archive", "block", "rid", "n", (F.col("_start") + F.col("_in")).alias("at")))


def _last_bytes(pieces: DataFrame, places: DataFrame, archives: DataFrame) -> DataFrame:
    """``archive, tail``: the last ``wanted`` bytes of ``archives`` (``archive, length, wanted``), in parts."""
    first = F.col("length") - F.col("wanted")
    near = (places.join(archives, "archive").where(F.col("at") + F.col("n") > first)
            .select("archive", "block", "rid", "at", F.greatest(first - F.col("at"), F.lit(0)).cast("int").alias("cut")))
    part = F.expr("substring(piece, cut + 1)")
    return (pieces.join(near, ["archive", "block", "rid"]).groupBy("archive")
            .agg(F.sort_array(F.collect_list(F.struct("at", part.alias("part"))))["part"].alias("tail")))


# ------------------------------------------------------------- directories
def _end_of(tail: bytes) -> tuple[int, int] | None:
    """From an archive's last bytes: how far before its end the directory begins, and the place it is said to have."""
    at = tail.rfind(b"PK\x05\x06")
    if at < 0 or len(tail) - at < 22:
        return None
    size, place = struct.unpack("<LL", tail[at + 12:at + 20])
    wide = at - 76  # the end record and locator of archives with 64-bit places
    if wide >= 0 and tail[at - 20:at - 16] == b"PK\x06\x07" and tail[wide:wide + 4] == b"PK\x06\x06":
        size, place = struct.unpack("<QQ", tail[wide + 40:wide + 56])
        at = wide
    return len(tail) - at + size, place


def _ends(tails: pd.Series) -> pd.DataFrame:
    found = [None if t is None else _end_of(ENTRY_MARK.encode().join(map(bytes, t))) for t in tails]
    return pd.DataFrame([f or (None, None) for f in found], columns=["wanted", "place"]).astype("Int64")


def _alone(record: bytes, pieces: Sequence = ()) -> zipfile.ZipFile:
    """An archive of one entry, from its directory record and its pieces, which are copied once."""
    size = sum(len(p) + len(ENTRY_MARK) for p in pieces)
    end = struct.pack("<4s4H2LH", b"PK\x05\x06", 0, 0, 1, 1, len(record), size, 0)
    marked = (part for p in pieces for part in (ENTRY_MARK.encode(), p))
    return zipfile.ZipFile(io.BytesIO(b"".join((*marked, record, end))))


def _entries(tail: bytes, behind: int, place: int, length: int) -> Iterator[tuple[int, str, bytes]]:
    """Per directory record where the entry's piece begins, the entry's name, and the record."""
    pos = len(tail) - behind
    shift = length - behind - place  # bytes put before the archive
    if pos < 0 or shift < 0:
        raise zipfile.BadZipFile("bad place of the directory")
    while tail[pos:pos + 4] == b"PK\x01\x02":
        record = tail[pos:pos + 46 + sum(struct.unpack("<3H", tail[pos + 28:pos + 34]))]
        info = _alone(record).infolist()[0]
        yield info.header_offset + shift + len(ENTRY_MARK), info.filename, record[:42] + bytes(4) + record[46:]
        pos += len(record)
    if tail[pos:pos + 4] not in (b"PK\x05\x06", b"PK\x06\x06"):
        raise zipfile.BadZipFile("bad magic number in the directory")


def _directory(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = ["archive", "at", "name", "valid", "record", "error"]
    for pdf in batches:
        for archive, tail, behind, place, length in zip(pdf["archive"], pdf["tail"], pdf["wanted"], pdf["place"], pdf["length"]):
            rows, any_valid = [], False
            try:
                for at, name, record in _entries(ENTRY_MARK.encode().join(map(bytes, tail)), behind, place, length):
                    valid = _valid_entry(name)
                    any_valid |= valid
                    rows.append((archive, at, name, valid, record, None))
                    if len(rows) >= CHUNK:
                        yield pd.DataFrame(rows, columns=columns)
                        rows = []
                if not any_valid:
                    rows.append((archive, None, None, False, None, "No valid files in ZIP"))
            except _BROKEN as exc:
                rows.append((archive, None, None, False, None, f"Invalid ZIP file: {exc}"))
            yield pd.DataFrame(rows, columns=columns).astype({"at": "Int64"})


# ------------------------------------------------------------- entries
def _expand(batches: Iterator[pa.RecordBatch], skip_header: bool, encoding: str) -> Iterator[pa.RecordBatch]:
    """Entries are read where Arrow has them: beside a batch a task holds one entry and LINES_AT_ONCE of its lines."""
    for batch in batches:
        for archive, name, record, pieces in zip(*(batch.column(c) for c in ("archive", "name", "record", "pieces"))):
            archive, name = archive.as_py(), name.as_py()
            yield _batch(archive, name, [(0, None, None, None)], "ENTRY")
            try:
                if not len(pieces):
                    raise zipfile.BadZipFile("no entry at the place in the directory")
                with _alone(record.as_py(), [p.as_buffer() for p in pieces]) as zf:
                    yield from _entry_lines(zf, archive, name, skip_header, encoding)
            except _BROKEN as exc:
                yield _batch(archive, name, [(None, None, None, None)], "ERROR", f"Invalid ZIP entry: {exc}")


def _entry_lines(zf: zipfile.ZipFile, archive: str, name: str, skip_header: bool, encoding: str) -> Iterator[pa.RecordBatch]:
    buf: list[tuple] = []
    numbers = _Numbers()
    with zf.open(name) as fh:
        for n, raw in enumerate(io.TextIOWrapper(fh, encoding=encoding, newline="\n"), 1):
            line = raw.rstrip("\r\n")
            row_no, record_no = numbers.of(line)
            if skip_header and n == 1:
                continue
            buf.append((n, row_no, record_no, line))
            if len(buf) >= LINES_AT_ONCE:
                yield _batch(archive, name, buf, "OK")
                buf = []
    if buf:
        yield _batch(archive, name, buf, "OK")


def archive_entries(spark: SparkSession, root: str | Sequence[str], stage: str) -> DataFrame:
    """``archive, name, record, pieces, error``: one row per entry to be read, or per archive that can't be.

    ``stage`` is a folder of the shared store where the pieces are kept.
    """
    _pieces(spark, root).write.mode("overwrite").parquet(f"{stage}/pieces")
    pieces = spark.read.parquet(f"{stage}/pieces")
    _places(pieces).write.mode("overwrite").parquet(f"{stage}/places")
    places = spark.read.parquet(f"{stage}/places")
    ends_of = F.pandas_udf(_ends, "wanted long, place long")
    archives = list_files(spark, root, ZIPS).select(F.col("path").alias("archive"), "length")
    last = _last_bytes(pieces, places, archives.withColumn("wanted", F.lit(END_BYTES)))
    ends = archives.join(last.select("archive", ends_of("tail").alias("_e")), "archive", "left").select(
        "archive", "length", F.col("_e.wanted").alias("wanted"), F.col("_e.place").alias("place"))
    found = ends.where("wanted <= length")
    tails = _last_bytes(pieces, places, found.drop("place")).join(found, "archive")
    (tails.mapInPandas(_directory, _DIRECTORY_SCHEMA)
     .unionByName(ends.where("wanted is null or wanted > length").select(
         "archive", F.lit(None).cast("long").alias("at"), F.lit(None).cast("string").alias("name"),
         F.lit(False).alias("valid"), F.lit(None).cast("binary").alias("record"), F.lit("Invalid ZIP file: no directory at its end").alias("error")))
     .write.mode("overwrite").parquet(f"{stage}/directory"))
    directory = spark.read.parquet(f"{stage}/directory")
    entries = directory.where("error is null")
    # Every piece belongs to the last entry that begins at it or before; mostly an entry is one piece.
    begins = entries.select("archive", "at", F.col("at").alias("_from")).distinct()
    so_far = W.partitionBy("archive").orderBy("at").rowsBetween(W.unboundedPreceding, 0)
    owned = (places.join(begins, ["archive", "at"], "left")
             .withColumn("_from", F.last("_from", ignorenulls=True).over(so_far)).where("_from is not null")
             .withColumn("_pieces", F.count(F.lit(1)).over(W.partitionBy("archive", "_from"))))
    valid = entries.where("valid")
    wanted = owned.join(valid.select("archive", F.col("at").alias("_from")).distinct(), ["archive", "_from"], "left_semi")
    bodies = pieces.join(wanted.select("archive", "block", "rid", "at", "_from", "_pieces"), ["archive", "block", "rid"])
    whole = bodies.where("_pieces = 1").select("archive", "_from", F.array("piece").alias("pieces"))
    parted = (bodies.where("_pieces > 1").groupBy("archive", "_from")
              .agg(F.sort_array(F.collect_list(F.struct("at", "piece")))["piece"].alias("pieces")))
    none = F.array().cast("array<binary>")
    opened = (valid.withColumnRenamed("at", "_from").join(whole.unionByName(parted), ["archive", "_from"], "left")
              .select("archive", "name", "record", F.coalesce("pieces", none).alias("pieces"), "error"))
    return opened.unionByName(directory.where("error is not null").select(
        "archive", "name", "record", none.alias("pieces"), "error"))


def expand_archives(spark: SparkSession, root: str | Sequence[str], skip_header: bool = True,
                    encoding: str = "utf-8", stage: str | None = None) -> DataFrame:
    """Lines of every zip below ``root`` + the entry's file name and table.

    Status ENTRY: one row per entry, also of an empty one; OK: a line; ERROR: an
    archive, or an entry, that can't be read (its other rows don't count).
    ``stage`` is a folder of the shared store for the archives' pieces, below the
    checkpoint folder where it isn't given.
    """
    found = archive_entries(spark, root, stage or scratch_path(spark, "archives"))
    lines = found.where("error is null").select("archive", "name", "record", "pieces").mapInArrow(
        lambda it: _expand(it, skip_header, encoding), LINES_SCHEMA)
    nothing = {c: F.lit(None) for c in ("entry", "line_no", "row_no", "record_no", "line")}
    broken = (found.where("error is not null").withColumns(nothing | {"status": F.lit("ERROR")})
              .select(*[F.col(f.split()[0]).cast(f.split()[1]) for f in LINES_SCHEMA.split(", ")]))
    return lines.unionByName(broken).select("*", base_name(F.col("entry")).alias("entry_name"),
                                            table_from_filename(base_name(F.col("entry"))).alias("table_name"))


def parse_lines(lines: DataFrame, names: Sequence[str], delimiter: str = ",", corrupt: str | None = None) -> DataFrame:
    """Lines -> text columns with Spark's CSV parser (``from_csv``); with ``corrupt`` also the
    text of lines whose cells don't match the columns."""
    wanted = [*names, *([corrupt] if corrupt else [])]
    options = {"sep": delimiter, "quote": '"', "escape": "\\"} | ({"columnNameOfCorruptRecord": corrupt} if corrupt else {})
    parsed = F.from_csv(F.col("line"), ", ".join(f"`{n}` string" for n in wanted), options)
    return lines.select("*", parsed.alias("_p")).select("*", *[F.col("_p")[n].alias(n) for n in wanted]).drop("_p")


def records(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Lines -> records ``keys, record_no, line``: the lines of one record joined by line ends.

    A group is one record, however large its entry is.
    """
    return (lines.filter(F.col("record_no").isNotNull()).groupBy(*keys, "record_no")
            .agg(F.sort_array(F.collect_list(F.struct("line_no", "line"))).alias("_l"))
            .select(*keys, "record_no", F.array_join(F.col("_l.line"), "\n").alias("line")))


def parse_json_lines(lines: DataFrame, names: Sequence[str], corrupt: str) -> DataFrame:
    """JSON lines -> text columns, and the text of lines that aren't JSON."""
    schema = ", ".join(f"`{n}` string" for n in [*names, corrupt])
    parsed = F.from_json("line", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    return lines.select("*", parsed.alias("_p")).select("*", *[F.col("_p")[n].alias(n) for n in [*names, corrupt]]).drop("_p")


def archive_report(lines: DataFrame) -> DataFrame:
    """Per archive: entries, lines, status and error (SRC-1 result dict as a frame)."""
    return lines.groupBy("archive").agg(
        F.count_distinct("entry").alias("file_count"),
        F.count(F.col("line")).alias("lines"),
        F.max(F.when(F.col("status") == "ERROR", F.col("error"))).alias("error"),
    ).withColumn("status", F.when(F.col("error").isNull(), F.lit("SUCCESS")).otherwise(F.lit("ERROR")))
