"""Configured type names -> Spark types (QUA-4, D21)."""

from __future__ import annotations

import re

from lakegate.constants import TYPE_MAPPING

_DECIMAL = re.compile(r"^DECIMAL\s*\(\s*(\d+)\s*,\s*(\d+)\s*\)$")


def spark_type(name: str | None) -> str:
    """Map a configured type; DECIMAL(p,s) is honoured, unknown names are STRING."""
    key = (name or "STRING").strip().upper()
    m = _DECIMAL.match(key)
    if m:
        return f"decimal({int(m.group(1))},{int(m.group(2))})"
    return TYPE_MAPPING.get(key, "string")


def is_date_type(name: str | None) -> bool:
    return spark_type(name) == "timestamp_ntz"


def is_numeric_type(name: str | None) -> bool:
    t = spark_type(name)
    return t in ("int", "bigint", "float", "double") or t.startswith("decimal")


_WHOLE = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


def wider_type(a: str, b: str) -> str:
    """The type that holds the values of both (SNK-7): whole numbers, then decimals, doubles, and text for anything else.

    Decimals that would need more than 38 digits become doubles; a date beside a
    timestamp becomes a timestamp.
    """
    if a == b:
        return a
    kinds = [t.split("(")[0] for t in (a, b)]
    if all(k in _WHOLE for k in kinds):
        return max(a, b, key=_WHOLE.__getitem__)
    if all(k in _WHOLE or k in ("decimal", "float", "double") for k in kinds):
        if "float" in kinds or "double" in kinds:
            return "double"
        digits, places = zip(*((_WHOLE[t], 0) if t in _WHOLE else map(int, t[8:-1].split(",")) for t in (a, b)))
        places, whole = max(places), max(d - p for d, p in zip(digits, places))
        return f"decimal({whole + places},{places})" if whole + places <= 38 else "double"
    if set(kinds) <= {"date", "timestamp", "timestamp_ntz"}:
        return next(k for k in ("timestamp", "timestamp_ntz") if k in kinds)
    return "string"
