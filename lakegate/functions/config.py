"""Configuration-cell parsing as expressions over spec frames (SCA-8, PRJ-9)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakegate.functions.text import null_token

_TRUE = ("true", "t", "yes", "y", "1", "oui", "o")
_FALSE = ("false", "f", "no", "n", "0", "non")


def parse_bool(c: Column | str, default: bool, clean: bool = False) -> Column:
    """``clean``: the cell already went through ``null_token``."""
    v = F.lower(F.col(c) if isinstance(c, str) else c) if clean else F.lower(null_token(c))
    return (F.when(v.isin(*_TRUE), F.lit(True))
            .when(v.isin(*_FALSE), F.lit(False))
            .otherwise(F.lit(default)))


def parse_percent(c: Column | str, default: float | None, clean: bool = False) -> Column:
    """'10%' / '10' -> 10; '0.1' (a fraction without '%') -> 10; unset -> default."""
    v = (F.col(c) if isinstance(c, str) else c) if clean else null_token(c)
    has_pct = v.endswith("%")
    num = F.regexp_replace(F.replace(v, F.lit("%"), F.lit("")), ",", ".").try_cast("decimal(9,4)")
    pct = F.when(has_pct | (num > 1), num).otherwise(num * 100)
    dflt = F.lit(None).cast("decimal(9,4)") if default is None else F.lit(default).cast("decimal(9,4)")
    return F.coalesce(pct.cast("decimal(9,4)"), dflt)
