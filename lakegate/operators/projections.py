"""Column-level projections (PRJ-1/2/4/6/8/10, SNK-5/6, QUA-17, SET-3)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegate.constants import PARTITION_SCHEMES, TECHNICAL_COLUMNS
from lakegate.functions.dates import partition_values

_POSITIONAL = re.compile(r"^_c(\d+)$")


def lowercase_names(df: DataFrame) -> DataFrame:
    """PRJ-1: lower-case every column name that does not start with '_'."""
    return df.withColumnsRenamed({c: c.lower() for c in df.columns if not c.startswith("_") and c != c.lower()})


def positional_rename(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """PRJ-2: ``_cN`` columns -> configured names by numeric N (not by string order)."""
    pos = sorted((int(m.group(1)), c) for c in df.columns if (m := _POSITIONAL.match(c)))
    mapping = {c: names[i].lower() for i, (_, c) in enumerate(pos) if i < len(names)}
    return df.withColumnsRenamed(mapping)


def header_line_mask(names: Sequence[str], max_cols: int = 5) -> Column:
    """PRJ-4 (D6): true only for a real header line: the first <= 5 columns equal
    their own names ignoring case and surrounding blanks (NULL never matches)."""
    conds = [F.lower(F.trim(F.col(f"`{c}`"))).eqNullSafe(F.lit(c.lower())) for c in list(names)[:max_cols]]
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def drop_header_lines(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.filter(~header_line_mask(names))


def missing_columns(present: Sequence[str], expected: Sequence[str]) -> list[str]:
    """SET-3: configured columns absent from the input, in configured order."""
    have = {c.lower() for c in present}
    return [c for c in expected if c.lower() not in have]


def missing_column_report(files: DataFrame, present: Sequence[str], expected: Sequence[str], table_name: str,
                          file_col: str = "_file_name") -> DataFrame:
    """QUA-17: one INFO_MISSING_COLUMN row per (file, missing column)."""
    miss = missing_columns(present, expected)
    arr = F.array(*[F.lit(c) for c in miss]) if miss else F.array().cast("array<string>")
    return (files.select(F.col(file_col).alias("filename")).distinct()
            .select("filename", F.explode(arr).alias("column_name"))
            .select("filename", "column_name", F.lit("INFO_MISSING_COLUMN").alias("error_type"),
                    F.lit(table_name).alias("table_name"),
                    F.concat(F.lit("missing column "), F.col("column_name"),
                             F.lit(" added as NULL")).alias("error_message"),
                    F.lit(None).cast("string").alias("raw_value")))


def with_technical_columns(df: DataFrame, business: Sequence[str], *, line_col: str, file_col: str,
                           extraction_date: Column, process_date: Column) -> DataFrame:
    """PRJ-8: FILE_LINE_ID, FILE_NAME_RECEIVED, FILE_EXTRACTION_DATE, FILE_PROCESS_DATE
    first, then the source columns in configured order."""
    line, name, extracted, processed = TECHNICAL_COLUMNS
    return df.select(
        F.col(line_col).cast("long").alias(line),
        F.col(file_col).alias(name),
        extraction_date.cast("timestamp_ntz").alias(extracted),
        process_date.cast("timestamp_ntz").alias(processed),
        *[F.col(f"`{c}`") for c in business],
    )


def with_partitions(df: DataFrame, scheme: str, date_col: str = "FILE_EXTRACTION_DATE") -> DataFrame:
    """SNK-5: yyyy / yyyy,mm / yyyy,mm,dd / yyyy,mm,dd,hhmmss columns (history table only)."""
    parts = PARTITION_SCHEMES[scheme.lower()]
    return df.select("*", *partition_values(F.col(date_col), parts))


def with_comments(df: DataFrame, comments: dict[str, str]) -> DataFrame:
    """SNK-6: column comments from the spec as column metadata (kept by Parquet/Delta writers)."""
    return df.select(*[F.col(f"`{c}`").alias(c, metadata={"comment": comments[c]}) if comments.get(c)
                       else F.col(f"`{c}`") for c in df.columns])
