"""Column rules -> one validated projection (QUA-1..8, 13, 14, 18; PRJ-5/6/7/10; SCA-1/2/7).

Every configured column becomes its typed value and two flags (bad text, blank
where none is allowed).  The line decisions (errors, REJECT action present, ICT
share of invalid columns) are sums and disjunctions of the flags; the errors of a
line are one ``array<struct>``, flattened from per-column arrays of none or one.
No lambda is involved, so the projections stay inside whole-stage codegen: no
action, no per-column job.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegate.constants import (ACTION_ICT, ACTION_REJECT, ERR_DATE_PARSE, ERR_NULL_VALUE,
                                ERR_TYPE_MISMATCH)
from lakegate.functions.dates import parse_strict
from lakegate.functions.filenames import enrich_from_name
from lakegate.functions.text import harmonise_decimal, is_blank, may_be_whole, transform
from lakegate.functions.types import is_numeric_type, spark_type
from lakegate.plans.specs import ColumnRule

ERRORS = "_errors"
N_ERRORS = "_n_errors"
N_ICT = "_n_ict"
REJECT = "_reject"
ICT_REJECTED = "_ict_rejected"
LINE_REJECTED = "_line_rejected"
RAW_DATA = "_raw_data"
ERROR_FIELDS = ("column", "code", "action", "message", "raw_value")
ERROR_TYPE = "struct<column:string,code:string,action:string,message:string,raw_value:string>"


def _quote(name: str) -> str:
    return f"`{name}`"


def is_enrichment(rule: ColumnRule) -> bool:
    return (rule.enrich or "") in ("filename-modified", "filename_modified")


def typed_value(raw: Column, rule: ColumnRule) -> tuple[Column, Column, Column]:
    """(value, blank, bad_type) for one rule; value is NULL for blank or unparsable text."""
    txt = raw if rule.is_date else transform(raw, rule.transformation, rule.pattern, rule.replacement)
    blank = is_blank(txt)
    if rule.is_date:
        parsed = parse_strict(txt, rule.date_pattern)
    elif is_numeric_type(rule.field_type):
        kind = spark_type(rule.field_type)
        parsed = F.when(may_be_whole(txt), txt.try_cast(kind)) if kind in ("int", "bigint") else harmonise_decimal(txt).try_cast(kind)
    else:
        parsed = txt.try_cast(spark_type(rule.field_type))
    value = F.when(~blank, parsed)
    bad_type = ~blank & parsed.isNull()
    return value, blank, bad_type


def error_struct(rule: ColumnRule, raw: Column, bad_type: Column) -> Column:
    """QUA-13/14 (D11/D12): TYPE_MISMATCH / DATE_PARSE_ERROR for unparsable text,
    NULL_VALUE for a blank in a not-nullable column (a struct for a cell that has an error)."""
    raw_txt = raw.cast("string")
    shown = F.coalesce(raw_txt, F.lit("NULL"))
    if rule.is_date:
        bad_code = F.lit(ERR_DATE_PARSE)
        bad_msg = F.concat(F.lit(f"DATE_PARSE_ERROR: column {rule.name} pattern '{rule.date_pattern}' "
                                 "does not match value: "), shown)
    else:
        bad_code = F.lit(ERR_TYPE_MISMATCH)
        bad_msg = F.concat(F.lit(f"TYPE MISMATCH: column {rule.name} expected "
                                 f"{rule.field_type} value: "), shown)
    code, msg = bad_code, bad_msg
    if not rule.nullable:
        code = F.when(bad_type, bad_code).otherwise(F.lit(ERR_NULL_VALUE))
        msg = F.when(bad_type, bad_msg).otherwise(F.lit(f"NULL VALUE: column {rule.name} is not nullable"))
    return F.struct(F.lit(rule.name).alias("column"), code.alias("code"), F.lit(rule.action).alias("action"),
                    msg.alias("message"), raw_txt.alias("raw_value"))


def column_expressions(df: DataFrame, rule: ColumnRule, file_col: str | None) -> tuple[Column, Column | None, Column | None]:
    """Value (aliased, with comment metadata), failure flag and error struct of one rule."""
    meta = {"comment": rule.comment} if rule.comment else None
    if is_enrichment(rule):
        src = F.col(file_col) if file_col else F.lit(None).cast("string")
        v = enrich_from_name(src, rule.pattern or ".*")
        return (v.alias(rule.name, metadata=meta) if meta else v.alias(rule.name)), None, None
    # PRJ-6: a configured column absent from the input is read as NULL text.
    raw = F.col(_quote(rule.name)).cast("string") if rule.name in df.columns else F.lit(None).cast("string")
    value, blank, bad_type = typed_value(raw, rule)
    failed = bad_type if rule.nullable else bad_type | blank
    if rule.default is not None:
        dflt = (parse_strict(F.lit(rule.default), "yyyy-MM-dd HH:mm:ss") if rule.is_date
                else F.lit(rule.default).try_cast(spark_type(rule.field_type)))
        if rule.is_date:
            dflt = F.coalesce(dflt, parse_strict(F.lit(rule.default), "yyyy-MM-dd"))
        value = F.when(failed, dflt).otherwise(value)
    value = value.cast(spark_type(rule.field_type))
    return (value.alias(rule.name, metadata=meta) if meta else value.alias(rule.name)), failed, error_struct(rule, raw, bad_type)


def _total(flags: Sequence[Column]) -> Column:
    return sum((f.cast("int") for f in flags), F.lit(0))


def _any(flags: Sequence[Column]) -> Column:
    out = F.lit(False)
    for f in flags:
        out = out | f
    return out


def validate(df: DataFrame, rules: Sequence[ColumnRule], *, ict: Decimal | float | int = 10,
             ict_mode: str = "all", strict: bool = False, keep: Sequence[str] | None = None,
             file_col: str | None = "_file_name", raw_data_sep: str | None = None) -> DataFrame:
    """QUA-1: raw text frame -> typed columns + ``_errors`` + line decisions.

    ``raw_data_sep``: also keep the raw line text (raw cells joined) as ``_raw_data``.
    ``keep``: non-business columns passed through unchanged (default: every input
    column that is not a configured one).  ICT (QUA-10, D9): share of invalid
    ICT_DRIVEN columns over all configured columns (``ict_mode="flagged"``: over
    the ICT_DRIVEN columns), compared with ``>=`` (``strict``: ``>``, D1).
    """
    business = {r.name for r in rules}
    if keep is None:
        keep = [c for c in df.columns if c not in business]
    values, failed, errors, by_action = [], [], [], {}
    none = F.array().cast(f"array<{ERROR_TYPE}>")
    for i, r in enumerate(rules):
        v, f, e = column_expressions(df, r, file_col)
        values.append(v)
        if f is not None:
            failed.append(f.alias(f"_failed_{i}"))
            by_action.setdefault(r.action, []).append(F.col(f"_failed_{i}"))
            errors.append(F.when(f, F.array(e)).otherwise(none))
    err_array = F.flatten(F.array(*errors)) if errors else none
    checked = [r for r in rules if not is_enrichment(r)]
    n_cols = len(checked) if ict_mode == "all" else len([r for r in checked if r.action == ACTION_ICT])
    n_cols = max(n_cols, 1)
    extra = []
    if raw_data_sep is not None:
        raws = [F.col(_quote(r.name)).cast("string") for r in checked if r.name in df.columns]
        extra.append(F.concat_ws(raw_data_sep, *raws).alias(RAW_DATA))
    kept = [F.col(_quote(c)) for c in keep]
    # Counted from the arrays: what occurs twice becomes a method of its own in the generated code. In one
    # method for all columns it would be too long for the JVM to compile, and a line ten times as slow.
    n_errors = sum((F.size(e) for e in errors), F.lit(0))
    out = df.select(*kept, *values, *extra, err_array.alias(ERRORS), n_errors.alias(N_ERRORS), *failed)
    share = F.lit(100) * F.col(N_ICT)
    limit = F.lit(Decimal(str(ict))) * F.lit(n_cols)
    over = share > limit if strict else share >= limit
    return out.select(
        *[_quote(c) for c in out.columns if not c.startswith("_failed_")],
        _total(by_action.get(ACTION_ICT, [])).alias(N_ICT),
        _any(by_action.get(ACTION_REJECT, [])).alias(REJECT),
    ).select(
        "*",
        ((F.col(N_ICT) > 0) & over).alias(ICT_REJECTED),
    ).withColumn(LINE_REJECTED, F.col(REJECT) | F.col(ICT_REJECTED))


def explode_errors(validated: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per recorded error (the error table), keyed by ``keys``."""
    return (validated.select(*keys, F.posexplode(ERRORS).alias("error_pos", "e"))
            .select(*keys, "error_pos", *[F.col("e")[f].alias(f) for f in ERROR_FIELDS]))


def error_codes_text(col: str = ERRORS) -> Column:
    """Compact text of a line's errors: 'column:code' joined by ';' (configured order)."""
    return F.array_join(F.transform(F.col(col), lambda e: F.concat(e["column"], F.lit(":"), e["code"])), ";")


def business_columns(rules: Sequence[ColumnRule]) -> list[str]:
    return [r.name for r in rules]
