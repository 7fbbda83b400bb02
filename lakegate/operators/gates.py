"""File-level tolerance gates over validated lines (QUA-9..12, FIL-15/16, AGG-7).

Per-file statistics are one partial aggregation (map-side combine, one row per
file out of each task) and are joined back to the lines on the file name.  The
decision frame has one row per file; Spark's adaptive execution turns the join
into a broadcast hash join at run time when that frame is small and into a
skew-split sort-merge join otherwise, so a hot file with a third of all rows is
split across tasks instead of landing in one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegate.constants import ACTION_ICT, CODE_FAIL_FAST, FAIL_FAST_STOP
from lakegate.functions.text import field_count
from lakegate.operators.rules import ERRORS, ICT_REJECTED, LINE_REJECTED, N_ERRORS, REJECT, is_enrichment
from lakegate.plans.specs import ColumnRule

FILE_REJECTED = "_file_rejected"
FILE_REASON = "_file_reason"
TO_LAST = "_to_last"
TO_ALL = "_to_all"
ROWS_TO_LAST = "rows_to_last"
ROWS_TO_ALL = "rows_to_all"


@dataclass(frozen=True)
class GateParams:
    rlt: Decimal | float | int = 10
    strict: bool = False                   # D1: '>' instead of '>='
    fail_fast_enabled: bool = False
    fail_fast_threshold: Decimal | float | int = 10
    all_keeps_ict_rejects: bool = True      # D10


def _ge(part: Column, whole: Column, pct, strict: bool) -> Column:
    """100*part >= pct*whole in exact decimal arithmetic (no float percentages)."""
    left = F.lit(100) * part
    right = F.lit(Decimal(str(pct))) * whole
    return left > right if strict else left >= right


def abort_columns(rules: Sequence[ColumnRule]) -> list[ColumnRule]:
    """QUA-9 applies to ICT_DRIVEN columns that carry a column tolerance."""
    return [r for r in rules if r.action == ACTION_ICT and r.tolerance is not None and not is_enrichment(r)]


def file_stats(validated: DataFrame, rules: Sequence[ColumnRule], file_col: str = "_file_name") -> DataFrame:
    """AGG-7 + QUA-11 inputs: per file line counts and per-column invalid counts."""
    per_col = [F.count_if(F.array_contains(F.col(ERRORS)["column"], r.name)).alias(f"invalid_{r.name}")
               for r in abort_columns(rules)]
    return validated.groupBy(file_col).agg(
        F.count(F.lit(1)).alias("total_lines"),
        F.count_if(F.col(REJECT)).alias("reject_lines"),
        F.count_if(F.col(ICT_REJECTED) & ~F.col(REJECT)).alias("ict_lines"),
        F.count_if(F.col(LINE_REJECTED)).alias("rejected_lines"),
        F.count_if(F.col(N_ERRORS) > 0).alias("error_lines"),
        F.sum(F.col(N_ERRORS)).cast("long").alias("errors"),
        *per_col,
    )


def bad_records(validated: DataFrame, corrupt_col: str, file_col: str = "_file_path", name_col: str = "_file_name") -> DataFrame:
    """SRC-8 per file: lines that the parser could not map, and the file's name.

    The least of texts is found by sorting, so lines are counted by path and name, and names
    compared on a row per file.
    """
    counted = validated.groupBy(file_col, name_col).agg(F.count(F.col(corrupt_col)).alias("corrupt_lines"))
    return counted.groupBy(file_col).agg(F.sum("corrupt_lines").alias("corrupt_lines"), F.min(name_col).alias(name_col))


def file_decisions(stats: DataFrame, rules: Sequence[ColumnRule], params: GateParams,
                   file_col: str = "_file_name") -> DataFrame:
    """QUA-9 column abort, QUA-11 RLT, QUA-12 fail-fast -> status + reason per file, and the
    rows that go to `_last` and `_all`, which follow from the counts (lines aren't read again)."""
    total = F.col("total_lines")
    aborts = [F.when(_ge(F.col(f"invalid_{r.name}"), total, r.tolerance, params.strict), F.lit(r.name))
              for r in abort_columns(rules)]
    aborted = F.concat_ws(",", *aborts) if aborts else F.lit("")
    rlt_hit = _ge(F.col("rejected_lines"), total, params.rlt, params.strict)
    ff_hit = (_ge(F.col("error_lines"), total, params.fail_fast_threshold, params.strict)
              if params.fail_fast_enabled else F.lit(False))
    reason = (F.when(ff_hit, F.lit(CODE_FAIL_FAST))
              .when(aborted != "", F.lit("ICT_DRIVEN_ABORT"))
              .when(rlt_hit, F.lit("RLT_EXCEEDED")))
    return stats.select(
        file_col, "total_lines", "reject_lines", "ict_lines", "rejected_lines", "error_lines", "errors",
        F.when(aborted == "", F.lit(None)).otherwise(aborted).alias("aborted_columns"),
        rlt_hit.alias("rlt_exceeded"),
        ff_hit.alias("fail_fast"),
        reason.alias("file_reason"),
        F.when(reason.isNull(), F.lit("ACCEPTED")).otherwise(F.lit("REJECTED")).alias("file_status"),
        F.when(reason.isNull(), total - F.col("rejected_lines")).otherwise(F.lit(0)).cast("long").alias(ROWS_TO_LAST),
        F.when(reason.isNull(), total - F.col("reject_lines" if params.all_keeps_ict_rejects else "rejected_lines"))
         .otherwise(F.lit(0)).cast("long").alias(ROWS_TO_ALL),
    )


def stop_at_fail_fast(decisions: DataFrame, order: Sequence[Column]) -> DataFrame:
    """QUA-12: files behind the first one (by ``order``) that failed fast are NOT_STARTED and reach no sink."""
    place = F.struct(*order)
    first = decisions.filter("fail_fast").agg(F.min(place)).scalar()
    behind = F.coalesce(place > first, F.lit(False))
    return decisions.withColumns({
        "file_status": F.when(behind, F.lit("NOT_STARTED")).otherwise(F.col("file_status")),
        "file_reason": F.when(behind, F.lit(FAIL_FAST_STOP)).otherwise(F.col("file_reason")),
        ROWS_TO_LAST: F.when(behind, F.lit(0)).otherwise(F.col(ROWS_TO_LAST)).cast("long"),
        ROWS_TO_ALL: F.when(behind, F.lit(0)).otherwise(F.col(ROWS_TO_ALL)).cast("long")})


def apply_file_gate(validated: DataFrame, decisions: DataFrame, params: GateParams,
                    file_col: str = "_file_name", carried: Sequence[str] = ()) -> DataFrame:
    """Lines + their file's decision -> routing flags for `_last`, `_all`, invalid lines; and the
    ``carried`` columns of the decision."""
    d = decisions.select(F.col(file_col).alias("_gate_file"),
                         (F.col("file_status") != "ACCEPTED").alias(FILE_REJECTED),
                         F.col("file_reason").alias(FILE_REASON), *carried)
    joined = validated.join(d, validated[file_col] == d["_gate_file"], "left").drop("_gate_file")
    file_ok = ~F.coalesce(F.col(FILE_REJECTED), F.lit(False))
    keep_all = ~F.col(REJECT) if params.all_keeps_ict_rejects else ~F.col(LINE_REJECTED)
    return joined.select(
        "*",
        (file_ok & ~F.col(LINE_REJECTED)).alias(TO_LAST),
        (file_ok & keep_all).alias(TO_ALL),
    )


def gate(validated: DataFrame, rules: Sequence[ColumnRule], params: GateParams,
         file_col: str = "_file_name") -> tuple[DataFrame, DataFrame]:
    """Convenience: (routed lines, per-file decisions)."""
    decisions = file_decisions(file_stats(validated, rules, file_col), rules, params, file_col)
    return apply_file_gate(validated, decisions, params, file_col), decisions


def column_count_gate(lines: DataFrame, text_col: str, delimiter: str, expected: int,
                      file_col: str = "_file_name") -> DataFrame:
    """FIL-15: per file, min/max number of delimited fields vs the configured count.

    Delimiters inside quotes separate nothing.
    """
    n = field_count(text_col, delimiter)
    stats = lines.groupBy(file_col).agg(F.min(n).alias("min_fields"), F.max(n).alias("max_fields"),
                                        F.count(F.lit(1)).alias("total_lines"))
    bad = (F.col("min_fields") != expected) | (F.col("max_fields") != expected)
    return stats.select(
        file_col, "total_lines", "min_fields", "max_fields",
        F.lit(expected).alias("expected_fields"),
        F.when(bad, F.lit("000000006")).alias("error_code"),
        F.when(bad, F.lit("REJECTED")).otherwise(F.lit("ACCEPTED")).alias("file_status"),
    )
