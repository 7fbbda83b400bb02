"""Command line: one ingestion run (batch) or one availableNow stream per table.

    python -m lakegate --tables conf/file_table.csv --columns conf/field_column.csv \
        --landing /landing/2025-10-16 --warehouse /warehouse --run-id 20251016T1011 --env dev

Prints the run status and the execution report; exit code 1 when a table ends in ERROR.
"""

from __future__ import annotations

import argparse
import sys

from lakegate.plans.ingest import Ingestion, RunParams
from lakegate.plans.specs import read_sheet
from lakegate.session import get_spark


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="lakegate")
    ap.add_argument("--tables", required=True, help="File-Table sheet (csv / json / parquet export)")
    ap.add_argument("--columns", required=True, help="Field-Column sheet (csv / json / parquet export)")
    ap.add_argument("--sheet-format", default="csv")
    ap.add_argument("--landing", required=True)
    ap.add_argument("--warehouse", required=True)
    ap.add_argument("--run-id", required=True)
    ap.add_argument("--env", default="dev", help="dev or prd parameter preset")
    ap.add_argument("--stream", action="store_true", help="availableNow stream over the landing")
    ap.add_argument("--checkpoint", help="stream checkpoint root (required with --stream)")
    ap.add_argument("--master", default=None)
    a = ap.parse_args(argv)
    spark = get_spark(a.master)
    ing = Ingestion(spark, read_sheet(spark, a.tables, a.sheet_format), read_sheet(spark, a.columns, a.sheet_format),
                    a.warehouse, RunParams.for_env(a.env))
    if a.stream:
        if not a.checkpoint:
            ap.error("--checkpoint is required with --stream")
        stats = ing.run_stream(a.landing, None, a.checkpoint, a.run_id)
        print(f"{stats.status} rows={stats.rows} batches={stats.batches}")
        return 0
    result = ing.run(a.landing, a.run_id)
    result.run_status.show(truncate=False)
    result.execution_report.show(truncate=False)
    errors = result.run_status.filter("run_status = 'ERROR'").count()
    return 1 if errors else 0


if __name__ == "__main__":
    sys.exit(main())
