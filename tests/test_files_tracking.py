"""File gates and tracking (FIL-*), incl. the duplicate-then-late golden case."""

import datetime as dt

from pyspark.sql import functions as F

from lakegate.operators import files as fl
from lakegate.operators import tracking as tk
from lakegate.plans.specs import normalise_table_sheet, table_sheet


def names(spark, *ns):
    return spark.createDataFrame([(f"/landing/{n}", n) for n in ns], "path string, filename string")


def test_duplicate_then_late_golden(spark):
    """register customers_20251016_101112.csv, then the same again, then an older file."""
    empty = spark.createDataFrame([], tk.TRACKING_SCHEMA)
    first = fl.history_checks(fl.describe_files(names(spark, "customers_20251016_101112.csv")), empty)
    assert first.collect()[0]["valid"]
    reg = tk.registrations(first.select("table_name", "filename", "file_date", F.lit("SUCCESS").alias("status"),
                                        F.lit(10).alias("row_count")),
                           F.lit("2025-10-17 00:00:00").cast("timestamp_ntz"))
    again = fl.history_checks(fl.describe_files(names(spark, "customers_20251016_101112.csv",
                                                      "customers_20251015_101112.csv",
                                                      "customers.csv")), reg)
    got = {r["filename"]: r for r in again.collect()}
    assert got["customers_20251016_101112.csv"]["error_code"] == "000000002"
    assert got["customers_20251015_101112.csv"]["error_code"] == "000000003"
    assert got["customers.csv"]["valid"]  # undated passes the order check


def test_same_name_twice_in_batch(spark):
    empty = spark.createDataFrame([], tk.TRACKING_SCHEMA)
    df = spark.createDataFrame([("/a/x_20250101.csv", "x_20250101.csv"), ("/b/x_20250101.csv", "x_20250101.csv")],
                               "path string, filename string")
    r = fl.history_checks(fl.describe_files(df), empty).orderBy("path").collect()
    assert [x["is_duplicate"] for x in r] == [False, True]


def test_failed_files_are_registered(spark):
    """D17: FAILED and undated outcomes are written with an explicit schema."""
    out = spark.createDataFrame([("t", "t.csv", None, "FAILED", 5), ("t", "t_20250101.csv", dt.datetime(2025, 1, 1),
                                                                      "SUCCESS", 7)],
                                "table_name string, filename string, file_date timestamp_ntz, status string, row_count long")
    reg = tk.registrations(out, F.lit("2025-02-01 00:00:00").cast("timestamp_ntz")).collect()
    assert {(r["status"], r["row_count"]) for r in reg} == {("FAILED", 0), ("SUCCESS", 7)}


def test_fix_part_golden(spark):
    conf = normalise_table_sheet(table_sheet(spark, [{"Delta Table Name": "billing",
                                                     "Filename Pattern": "Billing_<yyyy><mm><dd>.csv"}]))
    files = fl.describe_files(names(spark, "billing_20251028.csv", "Billing_20251028.csv", "other_20251028.csv"))
    r = {x["filename"]: x for x in fl.fix_part_gate(files, conf).collect()}
    assert r["billing_20251028.csv"]["fix_part_error_code"] == "000000001"
    assert "expected 'Billing', got 'billing'" in r["billing_20251028.csv"]["fix_part_reason"]
    assert r["Billing_20251028.csv"]["fix_part_reason"] is None
    assert r["other_20251028.csv"]["fix_part_reason"] is None  # no config -> accept


def test_manifest_skips_hidden_and_unsupported(spark):
    paths = spark.createDataFrame([("/l/a_20250101.csv",), ("/l/.hidden.csv",), ("/l/__MACOSX/x.csv",),
                                   ("/l/b.xlsx",), ("/l/c.zip",), ("/l/d.jsonl",)], "path string")
    m = {r["filename"]: r["file_format"] for r in fl.manifest_from_paths(paths).collect()}
    assert m == {"a_20250101.csv": "csv", "c.zip": "zip", "d.jsonl": "json"}


def test_retention_and_latest(spark):
    rows = [("t", f"f{i}.csv", None, dt.datetime(2025, 1, 1) + dt.timedelta(days=i), "SUCCESS", i) for i in range(30)]
    t = spark.createDataFrame(rows, tk.TRACKING_SCHEMA)
    kept = tk.retain(t, F.lit("2025-01-30 00:00:00").cast("timestamp_ntz"), 10).count()
    assert kept == 11
    assert [r["filename"] for r in tk.latest(t, 3).collect()] == ["f29.csv", "f28.csv", "f27.csv"]
