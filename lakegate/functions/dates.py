"""Date expressions (QUA-2/3, FIL-2/3/8, SCA-4/6).

Parsed dates are wall-clock values without a time zone (``timestamp_ntz``):
a date written in a file has no zone, and the standard output is
``yyyy-MM-dd HH:mm:ss``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakegate.constants import FILE_DATE_RULES
from lakegate.functions.text import col_of

OUTPUT_FORMAT = "yyyy-MM-dd HH:mm:ss"


def parse_strict(c: Column | str, pattern: str) -> Column:
    """QUA-2: one pattern only; no match -> NULL (never an error).

    A text without a digit has no year; told apart first, it costs no exception in the parser.
    """
    c = col_of(c)
    parsed = F.try_to_timestamp(c, F.lit(pattern)).cast("timestamp_ntz")
    return F.when(c.rlike("[0-9]"), parsed) if "yy" in pattern and "'" not in pattern else parsed


def parse_multi(c: Column | str, patterns: Sequence[str], default: str | None = None) -> Column:
    """QUA-3: first pattern that parses wins, else the default (if any)."""
    c = col_of(c)
    out = F.coalesce(*[parse_strict(c, p) for p in patterns]) if len(patterns) > 1 \
        else parse_strict(c, patterns[0])
    if default is not None:
        out = F.coalesce(out, F.lit(default).cast("timestamp_ntz"))
    return out


def to_output_text(ts: Column | str) -> Column:
    """SCA-6: standard text form of a parsed date."""
    return F.date_format(col_of(ts), OUTPUT_FORMAT)


# ---------------------------------------------------------------- file names
_YMD = r"(\d{4})(\d{2})(\d{2})"


def filename_ymd(fname: Column | str) -> tuple[Column, Column, Column, Column]:
    """First 8-digit run read as yyyy, mm, dd (ints) plus the matched text ('' if none)."""
    f = col_of(fname)
    text = F.regexp_extract(f, _YMD, 0)
    y = F.regexp_extract(f, _YMD, 1).try_cast("int")
    m = F.regexp_extract(f, _YMD, 2).try_cast("int")
    d = F.regexp_extract(f, _YMD, 3).try_cast("int")
    return text, y, m, d


def filename_date_reason(fname: Column | str, require_date: bool = False) -> Column:
    """FIL-2 / FIL-3: NULL when the name's date is acceptable, else the reason.

    A name without a date passes unless ``require_date`` (strict variant).
    """
    text, y, m, d = filename_ymd(fname)
    real = F.try_to_timestamp(text, F.lit("yyyyMMdd"))
    ymd = F.format_string("%04d-%02d-%02d", y, m, d)
    no_date = F.lit("no date yyyyMMdd in file name") if require_date else F.lit(None).cast("string")
    return (
        F.when(text == "", no_date)
        .when(~y.between(1900, 2100),
              F.format_string("year %d outside 1900 to 2100", y))
        .when(~m.between(1, 12), F.format_string("month %d outside 1 to 12", m))
        .when(~d.between(1, 31), F.format_string("day %d outside 1 to 31", d))
        .when(real.isNull(), F.concat(F.lit("no such day: "), ymd))
    )


def file_date(fname: Column | str) -> Column:
    """FIL-8: date of a file from its name; a matched but impossible date is NULL."""
    f = col_of(fname)
    out = F.lit(None).cast("timestamp_ntz")
    for pattern, how, fmt in reversed(FILE_DATE_RULES):
        if how == "concat":
            txt = F.concat(F.regexp_extract(f, pattern, 1), F.regexp_extract(f, pattern, 2))
        elif how == "one":
            txt = F.regexp_extract(f, pattern, 1)
        else:
            txt = F.concat(*[F.regexp_extract(f, pattern, i) for i in (1, 2, 3)])
        out = F.when(f.rlike(pattern), parse_strict(txt, fmt)).otherwise(out)
    return out


def partition_values(ts: Column | str, parts: Sequence[str]) -> list[Column]:
    """SNK-5: yyyy / mm / dd / hhmmss text columns of a timestamp."""
    fmt = {"yyyy": "yyyy", "mm": "MM", "dd": "dd", "hhmmss": "HHmmss"}
    t = col_of(ts)
    return [F.date_format(t, fmt[p]).alias(p) for p in parts]
