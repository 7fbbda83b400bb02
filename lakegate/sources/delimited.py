"""Delimited text landings (SRC-4..8, PRJ-1/2/4, H2).

Every cell is read as text (no inference); types come later from the rules.
Header modes:

* ``""`` (default) and ``FIRST_LINE``: configured names by position, the first
  line of each file skipped.
* ``HEADER_USE``: names from each file's own first line.  Files may order their
  columns differently, so a positional read is re-mapped per file: the header
  line of every file is found with one aggregation (the row with the smallest
  row id in the file's first split), joined back on the file path (one row per
  file), and each configured name takes the cell at its position in that file's
  header.  A name missing from a header reads as NULL (PRJ-6).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakegate.constants import HEADER_USE
from lakegate.functions.filenames import base_name, plain_path
from lakegate.functions.text import field_count

CORRUPT = "_corrupt_record"


def _options(delimiter: str, charset: str | None, multiline: bool) -> dict[str, str]:
    return {
        "sep": delimiter or ",",
        "encoding": charset or "UTF-8",
        "quote": '"',
        "escape": "\\",
        "mode": "PERMISSIVE",
        "multiLine": "true" if multiline else "false",
        "columnNameOfCorruptRecord": CORRUPT,
        "inferSchema": "false",
    }


def _file_reader(reader, recursive: bool, glob: str | None):
    """Recursive listing and a file-name glob (a glob implies a recursive walk)."""
    if recursive or glob:
        reader = reader.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader


def text_schema(names: Sequence[str], corrupt: bool = True) -> T.StructType:
    fields = [T.StructField(n, T.StringType(), True) for n in names]
    if corrupt:
        fields.append(T.StructField(CORRUPT, T.StringType(), True))
    return T.StructType(fields)


def _with_file(df: DataFrame) -> DataFrame:
    """File path / name of each line, plus the split start and a row id taken on
    the scan itself (consecutive within a split) for file-order line numbers."""
    path = plain_path("_metadata.file_path")
    return df.select("*", path.alias("_file_path"), base_name(path).alias("_file_name"),
                     F.col("_metadata.file_block_start").alias("_block"),
                     F.monotonically_increasing_id().alias("_rid"))


def read_delimited(spark: SparkSession, paths: str | Sequence[str], names: Sequence[str], *,
                   header_mode: str = "", delimiter: str = ",", charset: str | None = "UTF-8",
                   multiline: bool = False, recursive: bool = False, glob: str | None = None) -> DataFrame:
    """SRC-4..8: a landing of delimited files -> text columns ``names`` (lower case)
    + ``_corrupt_record`` + ``_file_path`` / ``_file_name``."""
    names = [n.lower() for n in names]
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = _file_reader(spark.read.options(**_options(delimiter, charset, multiline)), recursive, glob)
    if (header_mode or "").upper() != HEADER_USE:
        df = reader.option("header", "true").schema(text_schema(names)).csv(paths)
        return _with_file(df)
    width = max(len(names), header_width(spark, paths, delimiter, glob=glob))
    raw, pos = read_positional(spark, paths, width, delimiter=delimiter, charset=charset,
                               multiline=multiline, recursive=recursive, glob=glob)
    return remap_by_header(raw, names, pos, delimiter)


def positional_names(width: int) -> list[str]:
    return [f"_c{i}" for i in range(width)]


def read_positional(spark: SparkSession, paths: str | Sequence[str], width: int, *, delimiter: str = ",",
                    charset: str | None = "UTF-8", multiline: bool = False, recursive: bool = False,
                    glob: str | None = None, skip_header: bool = False) -> tuple[DataFrame, list[str]]:
    """Header-less read: ``_c0.._c{width-1}`` text cells, the text of lines with another number of
    fields, file path / name, split start and scan row id (input of ``remap_by_header``; can be staged first).
    ``skip_header``: without the first line of each file, for a ``remap_by_header`` that is given the header lines."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = _file_reader(spark.read.options(**_options(delimiter, charset, multiline)), recursive, glob)
    pos = positional_names(width)
    raw = reader.option("header", str(skip_header).lower()).schema(text_schema(pos)).csv(paths)
    return _with_file(raw), pos


def header_width(spark: SparkSession, paths: str | Sequence[str], delimiter: str, glob: str | None = None) -> int:
    """The most cells in any file's first line: one value, from an aggregation."""
    return first_width(first_lines(spark, paths, glob=glob), delimiter)


def first_lines(spark: SparkSession, paths: str | Sequence[str], accepted: DataFrame | None = None,
                glob: str | None = None) -> DataFrame:
    """One row per file (of the ``accepted`` paths), from one scan of the text: its first line, and the first one
    that isn't blank, which is the parser's first record of a file whose records are lines."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    lines = _with_file(_file_reader(spark.read, bool(glob), glob).text(paths)).where("_block = 0")
    if accepted is not None:
        lines = lines.join(accepted.select(F.col("path").alias("_file_path")), "_file_path", "left_semi")
    filled = F.col("value").rlike("[^\\x00-\\x20]")
    return lines.groupBy("_file_path", "_file_name").agg(
        F.min_by("value", "_rid").alias("first"), F.min_by("value", F.when(filled, F.col("_rid"))).alias("filled"))


def first_width(first: DataFrame, delimiter: str) -> int:
    """The most cells in any first line of ``first_lines``."""
    return first.agg(F.coalesce(F.max(field_count("first", delimiter)), F.lit(0)).alias("n")).first()["n"]


def parsed_headers(first: DataFrame, pos: Sequence[str], delimiter: str = ",") -> DataFrame:
    """What ``header_lines`` gives, from the text of ``first_lines``."""
    options = _options(delimiter, None, False)
    parsed = first.filter(F.col("filled").isNotNull()).select(
        "_file_path", "_file_name", F.from_csv("filled", ", ".join(f"`{c}` string" for c in [*pos, CORRUPT]), options).alias("_r"))
    zero = F.lit(0).cast("long")
    return header_lines(parsed.select("_file_path", "_file_name", zero.alias("_block"), zero.alias("_rid"), "_r.*"), pos, delimiter)


def remap_by_header(raw: DataFrame, names: Sequence[str], pos: Sequence[str], delimiter: str = ",",
                    store: Callable[[DataFrame], DataFrame] | None = None, headers: DataFrame | None = None) -> DataFrame:
    """H2: per-file header line -> configured names; the header line itself is dropped.

    ``raw`` carries positional text columns ``pos``, the corrupt-record column, ``_file_path``,
    ``_block`` (split start) and ``_rid`` (row id increasing within a split). The parser fills the
    corrupt-record column where a line hasn't as many fields as ``pos``; a line is bad if it hasn't
    as many as its own file's header, blank fields included. ``store`` writes the header lines and reads
    them again: their size is then known before the join, which deals out no lines for a few headers.
    ``headers``: the files' ``header_lines``, if ``raw`` was read without them (``skip_header``).
    """
    places = [(F.array_position("_header", F.lit(n)) - 1).cast("int").alias(f"_at_{i}") for i, n in enumerate(names)]
    hdr = header_lines(raw, pos, delimiter) if headers is None else headers
    hdr = hdr.select("_h_path", "_h_rid", "_h_fields", *places)  # looked up once a file
    hdr = hdr if store is None else store(hdr)
    j = raw.join(hdr, raw["_file_path"] == hdr["_h_path"], "inner")
    j = (j if headers is not None else j.filter(F.col("_rid") != F.col("_h_rid"))) \
        .withColumn("_cells", F.array(*[F.col(c) for c in pos]))
    out = [F.get("_cells", F.col(f"_at_{i}")).alias(n) for i, n in enumerate(names)]
    fields = _fields(pos, delimiter)
    # Of a line that the parser took whole the text is put together again from its cells.
    text = F.coalesce(F.col(CORRUPT), F.to_csv(F.struct(*pos), {"sep": delimiter or ","}))
    return j.select(*out, F.when(fields != F.col("_h_fields"), text).alias(CORRUPT),
                    "_file_path", "_file_name", "_block", "_rid")


def _fields(pos: Sequence[str], delimiter: str) -> F.Column:
    return F.when(F.col(CORRUPT).isNull(), F.lit(len(pos))).otherwise(field_count(CORRUPT, delimiter))


def header_lines(raw: DataFrame, pos: Sequence[str], delimiter: str = ",") -> DataFrame:
    """One row per file: its header line (lower-cased, trimmed cells), its number of fields and its row id.
    A partial aggregation over the first split of each file (``min_by`` row id)."""
    cells = F.array(*[F.col(c) for c in pos])
    first = (raw.filter(F.col("_block") == 0)
             .groupBy("_file_path", "_file_name")
             .agg(F.min_by(F.struct(F.col("_rid").alias("rid"), cells.alias("cells"),
                                    _fields(pos, delimiter).alias("fields")), F.col("_rid")).alias("_h")))
    return first.select(F.col("_file_path").alias("_h_path"), F.col("_file_name").alias("_h_name"),
                        F.col("_h.rid").alias("_h_rid"), F.col("_h.fields").alias("_h_fields"),
                        F.transform(F.col("_h.cells"), lambda x: F.lower(F.trim(x))).alias("_header"))


def missing_by_header(raw: DataFrame, names: Sequence[str], pos: Sequence[str], delimiter: str = ",",
                      headers: DataFrame | None = None) -> DataFrame:
    """QUA-17 for HEADER_USE: per file, configured columns absent from its header (``headers``: see ``remap_by_header``)."""
    hdr = header_lines(raw, pos, delimiter) if headers is None else headers
    wanted = F.array(*[F.lit(n) for n in names])
    # array_contains is NULL (not false) when the value is absent and the header holds NULL cells
    missing = F.filter(wanted, lambda n: ~F.coalesce(F.array_contains(F.col("_header"), n), F.lit(False)))
    return hdr.select(F.col("_h_name").alias("filename"), F.explode(missing).alias("column_name"))


def corrupt_lines(df: DataFrame) -> DataFrame:
    """SRC-8: lines the parser could not map to the schema.

    Keep every schema column in what is computed from the result: with CSV column
    pruning the parser only checks the token count of lines whose columns are all
    required, so a projection down to ``_corrupt_record`` alone finds nothing.
    """
    return df.filter(F.col(CORRUPT).isNotNull())


def as_text_columns(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """SRC-9: a typed source (Parquet / JSON) as text so the same rules apply."""
    cols = names or [c for c in df.columns if not c.startswith("_")]
    keep = [c for c in df.columns if c.startswith("_")]
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c.lower()) for c in cols], *keep)


def read_json(spark: SparkSession, paths: str | Sequence[str], names: Sequence[str],
              glob: str | None = None) -> DataFrame:
    """SRC-9: JSON / JSON-lines with an explicit all-text schema (no inference)."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = _file_reader(spark.read, False, glob)
    df = reader.schema(text_schema([n.lower() for n in names])).option("mode", "PERMISSIVE") \
        .option("columnNameOfCorruptRecord", CORRUPT).json(paths)
    return _with_file(df)


def read_parquet_as_text(spark: SparkSession, paths: str | Sequence[str], names: Sequence[str] | None = None,
                         glob: str | None = None, accepted: DataFrame | None = None) -> DataFrame:
    """SRC-9 / SNK-7: Parquet (schema-merged) cast to text; a column that no file has is NULL.

    Files whose types can't be merged, of one table or of another one that the file-name pattern
    covers too, are read by schema: those of ``accepted`` (column ``path``) only, one footer each.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = _file_reader(spark.read, False, glob)

    def text(df: DataFrame) -> DataFrame:
        here = {c.lower(): c for c in df.columns}
        lacking = [n for n in names or [] if n.lower() not in here]
        df = df.withColumns({n: F.lit(None).cast("string") for n in lacking}) if lacking else df
        return _with_file(as_text_columns(df, names and [here.get(n.lower(), n) for n in names]))
    try:
        return text(reader.option("mergeSchema", "true").parquet(*paths))
    except Exception as exc:  # a Java exception that PySpark gives no class of its own
        if "CANNOT_MERGE" not in str(exc):
            raise
    files = [r["path"] for r in accepted.collect()] if accepted is not None else \
        _file_reader(spark.read, False, glob).option("mergeSchema", "false").parquet(*paths).inputFiles()
    by_schema: dict[tuple, list[str]] = {}
    for file in files:
        by_schema.setdefault(tuple(spark.read.parquet(file).dtypes), []).append(file)
    parts = [text(spark.read.parquet(*same)) for same in by_schema.values()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
