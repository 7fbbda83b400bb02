"""Text expressions: blank tests, null tokens, transformations (SCA-1/2/5, PRJ-5/9, QUA-5)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakegate.constants import NULL_TOKENS


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c: Column | str) -> Column:
    """NULL or only white space."""
    c = col_of(c)
    return c.isNull() | (F.trim(c) == F.lit(""))


def null_token(c: Column | str) -> Column:
    """PRJ-9: a configuration cell holding ''/nan/none/null (any case) is unset -> NULL."""
    c = col_of(c)
    t = F.trim(c.cast("string"))
    return F.when(t.isNull() | F.lower(t).isin(*NULL_TOKENS), F.lit(None).cast("string")).otherwise(t)


def harmonise_decimal(c: Column | str) -> Column:
    """QUA-5: decimal comma -> point (applied to numeric types only, D8)."""
    return F.replace(col_of(c), F.lit(","), F.lit("."))


def may_be_whole(c: Column | str) -> Column:
    """False only for text that no cast to a whole number reads.

    Such a cast throws and catches an exception that costs many times what a good cell costs;
    the grammar of whole numbers tells bad cells apart first.
    """
    return col_of(c).rlike(r"^[\x00-\x20\x7F]*[+-]?[0-9]+[\x00-\x20\x7F]*$")


def transform(c: Column | str, kind: str | None, pattern: str | None = None,
              replacement: str | None = None) -> Column:
    """SCA-1/SCA-2: uppercase / lowercase / regex replace (empty replacement deletes)."""
    c = col_of(c)
    kind = (kind or "").strip().lower()
    if kind == "uppercase":
        return F.upper(c)
    if kind == "lowercase":
        return F.lower(c)
    if kind == "regex" and pattern:
        return F.regexp_replace(c, F.lit(pattern), F.lit(replacement or ""))
    return c


def field_count(text: Column | str, delimiter: str) -> Column:
    """Fields of a line: delimiters outside quotes (with backslash as escape) and one."""
    text = F.col(text) if isinstance(text, str) else text
    unquoted = F.regexp_replace(text, r'(?s)"(?:[^"\\]|\\.|"")*"', "")
    return F.size(F.split(unquoted, "\\Q" + (delimiter or ",") + "\\E"))
