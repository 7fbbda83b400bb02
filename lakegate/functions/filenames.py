"""File-name expressions (FIL-1/4/5, SCA-3/4, SRC-2, PRJ-3/10)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakegate.constants import FORMAT_BY_EXTENSION
from lakegate.functions.text import col_of

_ALL_DIGITS = "^[0-9]+$"


def base_name(path: Column | str) -> Column:
    """SCA-3: last path element."""
    return F.substring_index(col_of(path), "/", -1)


def plain_path(path: Column | str) -> Column:
    """A ``_metadata.file_path`` as the file is called: percent codes decoded, '+' kept."""
    path = col_of(path)
    return F.when(path.contains("%"), F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).otherwise(path)


def as_literal_path(path: str) -> str:
    """A path for a reader that takes patterns: signs of patterns stand for themselves."""
    return "".join("\\" + c if c in "\\*?[]{}" else c for c in path)


def strip_extension(fname: Column | str) -> Column:
    """Drop the last '.ext' (a leading dot alone is not an extension)."""
    return F.regexp_replace(col_of(fname), r"(?<=.)\.[^.]*$", "")


def extension(fname: Column | str) -> Column:
    """Lower-case extension without the dot ('' when none)."""
    return F.lower(F.regexp_extract(col_of(fname), r"(?<=.)\.([^.]*)$", 1))


def file_format(fname: Column | str) -> Column:
    """SRC-2: csv/parquet/json by extension, 'zip' for archives, NULL = unsupported."""
    ext = extension(fname)
    out = F.when(ext == "zip", F.lit("zip"))
    for e, fmt in FORMAT_BY_EXTENSION.items():
        out = out.when(ext == e, F.lit(fmt))
    return out


def _first_non_digit_part(base: Column) -> Column:
    parts = F.split(base, "_")
    return F.try_element_at(F.filter(parts, lambda p: ~p.rlike(_ALL_DIGITS)), F.lit(1))


def table_from_filename(fname: Column | str) -> Column:
    """FIL-1 (D3): extension dropped; first part that is not all digits, lower-cased."""
    base = strip_extension(fname)
    first = F.coalesce(_first_non_digit_part(base), F.split(base, "_").getItem(0))
    return F.lower(first)


def fix_part_from_pattern(pattern: Column | str) -> Column:
    """FIL-4: placeholders <..> and '.csv' removed, text before the first '_', trimmed."""
    p = F.regexp_replace(col_of(pattern), r"<[^>]+>", "")
    p = F.replace(F.replace(p, F.lit(".csv"), F.lit("")), F.lit(".CSV"), F.lit(""))
    return F.trim(F.substring_index(p, "_", 1))


def fix_part_from_filename(fname: Column | str) -> Column:
    """FIL-5: with '_': first non-digit part (case kept); else trailing digits dropped."""
    base = strip_extension(fname)
    with_sep = F.coalesce(_first_non_digit_part(base), F.split(base, "_").getItem(0))
    without = F.trim(F.regexp_replace(base, r"\d+$", ""))
    return F.when(base.contains("_"), with_sep).otherwise(without)


def ymd_from_name(fname: Column | str) -> tuple[Column, Column, Column]:
    """SCA-4 (D7): yyyy, mm, dd ints from '_yyyymmdd' in the name; NULL when absent."""
    f = col_of(fname)
    pat = r"_(\d{4})(\d{2})(\d{2})"
    return tuple(F.regexp_extract(f, pat, i).try_cast("int") for i in (1, 2, 3))  # type: ignore


def routes_to(fname: Column | str, table: Column | str) -> Column:
    """PRJ-3 (D4): a file belongs to a table when its name starts with '<table>_'
    or equals '<table>.csv', ignoring case."""
    f = F.lower(col_of(fname))
    t = F.lower(col_of(table))
    return f.startswith(F.concat(t, F.lit("_"))) | (f == F.concat(t, F.lit(".csv")))


def enrich_from_name(fname: Column | str, pattern: str) -> Column:
    """PRJ-10 'filename-modified': the regex match of the file name ('' if none)."""
    return F.regexp_extract(col_of(fname), pattern, 0)
