"""Keyed current tables in buckets: only touched buckets are rewritten, repeats start from the before-image."""

import os
import zipfile

import pytest
from pyspark.sql import functions as F

from lakegate.functions.types import wider_type
from lakegate.operators import modes as md
from lakegate.plans import buckets as bk
from lakegate.plans import tables as tb
from lakegate.plans.ingest import Ingestion, RunParams
from lakegate.plans.specs import column_sheet, table_sheet

LINE = ["FILE_NAME_RECEIVED", "FILE_LINE_ID"]


def files_of(root):
    return {os.path.relpath(os.path.join(d, f), root) for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")}


def rows(spark, items, value="int"):
    return spark.createDataFrame([(k, v, "f.csv", i) for i, (k, v) in enumerate(items)],
                                 f"k long, v {value}, FILE_NAME_RECEIVED string, FILE_LINE_ID long")


def replace_keys(current, batch):
    return md.key_replace(current, batch, ["k", bk.BUCKET])


def merge(root, run, batch, **kw):
    return bk.merge(f"{root}/t", f"{root}/before", run, batch, ["k"], LINE, replace_keys, 16, **kw)


def content(spark, root):
    return sorted((r["k"], r["v"]) for r in tb.read_current(spark, f"{root}/t").select("k", "v").collect()
                  if r["k"] is not None)


def test_only_touched_buckets_are_rewritten(spark, tmp_root):
    assert merge(tmp_root, "r1", rows(spark, [(i, i) for i in range(400)])) == set(range(16))
    before = files_of(f"{tmp_root}/t")
    touched = merge(tmp_root, "r2", rows(spark, [(3, 30), (1000, 1)]))
    assert 1 <= len(touched) <= 2
    after = files_of(f"{tmp_root}/t")
    changed = {f.split(bk.BUCKET + "=")[1].split("/")[0] for f in before ^ after}
    assert changed == {str(b) for b in touched} and before & after
    assert content(spark, tmp_root) == sorted([(i, 30 if i == 3 else i) for i in range(400)] + [(1000, 1)])
    plan = bk.read_buckets(spark, f"{tmp_root}/t").where(F.col(bk.BUCKET).isin(1, 2))
    assert len(plan.inputFiles()) >= 2 and plan.rdd.getNumPartitions() < 16  # pruned before the scan


def test_a_repeat_leaves_no_trace_of_the_first_attempt(spark, tmp_root):
    merge(tmp_root, "r1", rows(spark, [(1, 1), (2, 2)]))
    merge(tmp_root, "r2", rows(spark, [(1, 10), (50, 5), (51, 5)]))
    merge(tmp_root, "r2", rows(spark, [(2, 20), (60, 6)]))  # corrected: other keys, other buckets
    assert content(spark, tmp_root) == [(1, 1), (2, 20), (60, 6)]
    merge(tmp_root, "r2", rows(spark, [(2, 20), (60, 6)]))
    assert content(spark, tmp_root) == [(1, 1), (2, 20), (60, 6)]
    # an attempt that was stopped while it overwrote buckets
    bk._delete(spark, f"{tmp_root}/t/of=16")
    merge(tmp_root, "r1", rows(spark, [(1, 1), (2, 2)]))
    assert content(spark, tmp_root) == [(1, 1), (2, 2)]


def test_an_image_that_was_not_finished_is_not_used(spark, tmp_root):
    merge(tmp_root, "r1", rows(spark, [(1, 1), (2, 2)]))
    rows(spark, [(9, 9)]).withColumn(bk.BUCKET, F.lit(0)).write.parquet(f"{tmp_root}/before/run=r2/try=0/rows")
    merge(tmp_root, "r2", rows(spark, [(1, 10)]))
    assert content(spark, tmp_root) == [(1, 10), (2, 2)]


def test_old_images_are_removed(spark, tmp_root):
    for i in range(4):
        merge(tmp_root, f"r{i}", rows(spark, [(i, i)]), kept_images=2)
    assert len(os.listdir(f"{tmp_root}/before")) == 2


def test_null_keys_are_spread_and_kept(spark, tmp_root):
    merge(tmp_root, "r1", rows(spark, [(None, i) for i in range(200)] + [(1, 1)]))
    table = bk.read_buckets(spark, f"{tmp_root}/t").where("k is null")
    assert table.count() == 200 and table.select(bk.BUCKET).distinct().count() > 8
    merge(tmp_root, "r2", rows(spark, [(1, 2)]))
    assert bk.read_buckets(spark, f"{tmp_root}/t").where("k is null").count() == 200


def test_an_empty_batch_changes_nothing(spark, tmp_root):
    assert merge(tmp_root, "r0", rows(spark, [])) == set()
    merge(tmp_root, "r1", rows(spark, [(1, 1)]))
    assert merge(tmp_root, "r2", rows(spark, [])) == set()
    assert content(spark, tmp_root) == [(1, 1)]


def test_type_change_widens_the_whole_table(spark, tmp_root):
    merge(tmp_root, "r1", rows(spark, [(i, i) for i in range(40)]))
    merge(tmp_root, "r2", rows(spark, [(3, 3.5)], "double"))
    table = tb.read_current(spark, f"{tmp_root}/t")
    assert dict(table.dtypes)["v"] == "double" and table.count() == 40 and (3, 3.5) in content(spark, tmp_root)
    merge(tmp_root, "r3", rows(spark, [(4, 7)]))  # the sheet goes back to INTEGER: the table stays as wide
    assert dict(tb.read_current(spark, f"{tmp_root}/t").dtypes)["v"] == "double" and (4, 7.0) in content(spark, tmp_root)
    merge(tmp_root, "r4", rows(spark, [(5, "x")], "string"))
    assert dict(tb.read_current(spark, f"{tmp_root}/t").dtypes)["v"] == "string"


@pytest.mark.parametrize("a, b, wide", [
    ("int", "bigint", "bigint"), ("int", "double", "double"), ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"),
    ("int", "decimal(5,2)", "decimal(12,2)"), ("bigint", "float", "double"), ("date", "timestamp_ntz", "timestamp_ntz"),
    ("decimal(38,0)", "decimal(10,9)", "double"), ("string", "int", "string"), ("boolean", "int", "string")])
def test_wider_type(a, b, wide):
    assert wider_type(a, b) == wide == wider_type(b, a)


# Whole runs

TABLE = {"Delta Table Name": "sales", "Input delimiter": ";", "Input header": "FIRST_LINE",
         "Ingestion mode": "DELTA_FROM_NON_HISTORIZED", "Rejected line per file tolerance": "40%"}
COLUMNS = [
    {"Delta Table Name": "sales", "Column Name": "id", "Field type": "LONG", "Is Nullable": "false", "Error action": "REJECT",
     "Is Special": "IsMergeKey"},
    {"Delta Table Name": "sales", "Column Name": "note", "Field type": "STRING"},
    {"Delta Table Name": "sales", "Column Name": "day", "Field type": "DATE", "Transformation pattern": "dd/MM/yyyy",
     "Is Special": "IsStartValidity"}]


def ingestion(spark, wh, params=None, **table):
    return Ingestion(spark, table_sheet(spark, [TABLE | table]), column_sheet(spark, COLUMNS), wh, params or RunParams())


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def sales(spark, wh):
    return sorted((r["id"], r["note"]) for r in tb.read_current(spark, f"{wh}/sales_last").collect())


def test_key_replace_of_an_older_run_again(spark, tmp_root):
    wh = f"{tmp_root}/wh"
    write(f"{tmp_root}/l1/sales_20250101.csv", "id;note;day\n1;a;01/01/2025\n2;a;01/01/2025\n")
    write(f"{tmp_root}/l2/sales_20250102.csv", "id;note;day\n2;b;02/01/2025\n3;b;02/01/2025\n")
    run = ingestion(spark, wh, **{"Ingestion mode": "FULL_KEY_REPLACE"})
    run.run(f"{tmp_root}/l1", "r1", run_at="2025-01-03 00:00:00")
    run.run(f"{tmp_root}/l2", "r2", run_at="2025-01-04 00:00:00")
    want = [(1, "a"), (2, "b"), (3, "b")]
    assert sales(spark, wh) == want
    again = run.run(f"{tmp_root}/l1", "r1", run_at="2025-01-09 00:00:00")
    assert [r["status"] for r in again.outcomes.collect()] == ["SUCCESS"] and sales(spark, wh) == want
    tracked = run.tracking().orderBy("filename").collect()
    assert [(r["filename"], r["status"], str(r["processed_date"])[:10]) for r in tracked] == [
        ("sales_20250101.csv", "SUCCESS", "2025-01-03"), ("sales_20250102.csv", "SUCCESS", "2025-01-04")]


def test_snapshots_rejected_empty_and_older(spark, tmp_root):
    wh = f"{tmp_root}/wh"
    run = ingestion(spark, wh, **{"Ingestion mode": "FULL_SNAPSHOT", "Rejected line per file tolerance": "101%"})
    write(f"{tmp_root}/l1/sales_20250101.csv", "id;note;day\n1;a;01/01/2025\n")
    write(f"{tmp_root}/l2/sales_20250102.csv", "id;note;day\n2;b;02/01/2025\n3\n")     # a short line: rejected
    write(f"{tmp_root}/l3/sales_20250103.csv", "id;note;day\n")                         # no line: skipped
    write(f"{tmp_root}/l4/sales_20250104.csv", "id;note;day\nx;b;02/01/2025\n")        # accepted, its only line is not
    for i, want in ((1, [(1, "a")]), (2, [(1, "a")]), (3, [(1, "a")]), (4, []), (1, [])):
        run.run(f"{tmp_root}/l{i}", f"r{i}", run_at=f"2025-01-1{i} 00:00:00")
        assert sales(spark, wh) == want, i


def test_header_use_counts_fields_in_files_and_archives(spark, tmp_root):
    land = f"{tmp_root}/land"
    good = "day;id;note\n01/01/2025;1;\"x;y\"\n01/01/2025;2;\n"
    write(f"{land}/sales_20250101.csv", good)
    write(f"{land}/sales_20250102.csv", "id;note;day;more\n3;a;02/01/2025;m\n")          # a wider header
    write(f"{land}/sales_20250103.csv", "id;note;day\n4;;03/01/2025;EXTRA\n")            # one blank and one more field
    write(f"{land}/sales_20250104.csv", "id;note;day\n5;a\n")                           # short
    write(f"{land}/sales_20250109.csv", "id;note;day\n9;\"a;b\";09/01/2025;z\n9;a;09/01/2025\n")
    with zipfile.ZipFile(f"{land}/more.zip", "w") as zf:
        zf.writestr("sales_20250105.csv", good.replace(";1;", ";6;").replace(";2;", ";7;"))
        zf.writestr("sales_20250106.csv", "id;note;day\n8;a;06/01/2025;EXTRA\n")
    run = ingestion(spark, f"{tmp_root}/wh", **{"Input header": "HEADER_USE"})
    got = {r["filename"][6:14]: (r["status"], r["error_code"]) for r in run.run(land, "r1").outcomes.collect()}
    bad, ok = ("FAILED", "000000006"), ("SUCCESS", None)
    assert got == {"20250101": ok, "20250102": ok, "20250103": bad, "20250104": bad, "20250105": ok, "20250106": bad,
                   "20250109": bad}
    assert sales(spark, f"{tmp_root}/wh") == [(1, "x;y"), (2, None), (3, "a"), (6, "x;y"), (7, None)]
    kept = {r["raw_line"] for r in spark.read.parquet(f"{tmp_root}/wh/sales_bad_records").collect()}
    assert {"4;;03/01/2025;EXTRA", "5;a", "8;a;06/01/2025;EXTRA", "9;\"a;b\";09/01/2025;z"} <= kept


@pytest.mark.parametrize("header", ["FIRST_LINE", "HEADER_USE"])
def test_archive_entries_equal_landed_files(spark, tmp_root, header):
    """Records of several lines and JSON: the same rows, line numbers and bad records as the files themselves."""
    ml = 'id;note;day\n1;"two\nlines; ""q"" ";01/01/2025\n\n2;plain;02/01/2025\n3;"a\n\nb";03/01/2025\n'
    texts = {"sales_20250101.csv": ml, "sales_20250102.csv": "id;note;day\n4;\"x\ny\"\n",
             "sales_20250103.json": '{"id": 5, "note": "n", "day": "03/01/2025"}\n\n{"id": "6", "day": "03/01/2025"}\n',
             "sales_20250104.json": '{"id": 7, "note": \n'}
    results = []
    for kind in ("files", "zip"):
        land, wh = f"{tmp_root}/{kind}", f"{tmp_root}/wh-{kind}"
        if kind == "files":
            for name, text in texts.items():
                write(f"{land}/{name}", text)
        else:
            os.makedirs(land)
            with zipfile.ZipFile(f"{land}/all.zip", "w") as zf:
                for name, text in texts.items():
                    zf.writestr(f"deep/{name}", text)
                zf.writestr("sales_20250109.parquet", b"PAR1")
        run = ingestion(spark, wh, **{"Input Format": "csv_quote_ml", "Input header": header})
        out = run.run(land, "r1", run_at="2025-02-01 00:00:00").outcomes.collect()
        last = tb.read_current(spark, f"{wh}/sales_last").select("id", "note", "FILE_NAME_RECEIVED", "FILE_LINE_ID")
        results.append((sorted(map(str, last.collect())),
                        sorted((r["filename"], r["status"], r["error_code"], r["total_lines"]) for r in out
                               if not r["filename"].endswith("parquet"))))
        if kind == "zip":
            assert [r["reason"] for r in out if r["filename"].endswith("parquet")] == ["Parquet inside an archive is not read"]
    assert results[0] == results[1]
    assert len(results[0][0]) == 5 and "two\nlines" in results[0][0][0].encode().decode("unicode_escape")


def test_fail_fast_stops_the_table(spark, tmp_root):
    wh, land = f"{tmp_root}/wh", f"{tmp_root}/land"
    write(f"{land}/sales_20250101.csv", "id;note;day\n1;a;01/01/2025\nx;a;01/01/2025\n")
    write(f"{land}/sales_20250102.csv", "id;note;day\nx;a;01/01/2025\n")
    write(f"{land}/sales_20250103.csv", "id;note;day\n3;a;01/01/2025\nx;a;01/01/2025\n")
    run = ingestion(spark, wh, RunParams(fail_fast_enabled=True, fail_fast_threshold=90),
                    **{"Rejected line per file tolerance": "60%"})
    got = {r["filename"][6:14]: (r["status"], r["error_code"]) for r in run.run(land, "r1").outcomes.collect()}
    assert got == {"20250101": ("SUCCESS", None), "20250102": ("FAILED", "000000007"), "20250103": ("SKIPPED", "FAIL_FAST_STOP")}
    assert sales(spark, wh) == [(1, "a")]
    assert {r["filename"][6:14] for r in spark.read.parquet(f"{wh}/sales_invalid_lines").collect()} == {"20250101"}
    assert {r["filename"][6:14] for r in spark.read.parquet(f"{wh}/sales_errors").collect()} == {"20250101", "20250102"}


def test_expired_rows_leave_the_storage(spark, tmp_root):
    root = f"{tmp_root}/t"
    frame = spark.createDataFrame([(1, "2025-01-01"), (2, "2025-03-01")], "id int, day string").withColumn(
        "at", F.col("day").cast("timestamp_ntz"))
    for run, where in (("old", "id = 1"), ("mixed", "true"), ("new", "id = 2")):
        tb.write_run(frame.where(where), root, run)
    untouched = files_of(f"{root}/run=new")
    assert tb.expire_runs(spark, root, "at", "2025-02-01") == (1, 1)
    assert sorted(os.listdir(root)) == ["run=mixed", "run=new"] and files_of(f"{root}/run=new") == untouched
    assert sorted((r["run"], r["id"]) for r in tb.read_runs(spark, root).collect()) == [("mixed", 2), ("new", 2)]
    assert tb.expire_runs(spark, root, "at", "2025-02-01") == (0, 0) == tb.expire_runs(spark, f"{root}/none", "at", "2025-02-01")


def test_parquet_beside_another_tables_types(spark, tmp_root):
    land = f"{tmp_root}/land"
    for name, sql in (("sales_20250101", "select 1L id, 'a' note, '01/01/2025' day"),
                      ("sales_20250102", "select '2' id, '02/01/2025' day"),
                      ("bigsales_20250101", "select 1.5D id, 3 note, true day")):
        spark.sql(sql).coalesce(1).write.parquet(f"{tmp_root}/parts/{name}")
        part = next(f for f in os.listdir(f"{tmp_root}/parts/{name}") if f.endswith(".parquet"))
        os.makedirs(land, exist_ok=True)
        os.rename(f"{tmp_root}/parts/{name}/{part}", f"{land}/{name}.parquet")
    out = ingestion(spark, f"{tmp_root}/wh").run(land, "r1").outcomes.collect()
    assert {r["filename"]: r["status"] for r in out} == {
        "sales_20250101.parquet": "SUCCESS", "sales_20250102.parquet": "SUCCESS", "bigsales_20250101.parquet": "FAILED"}
    assert sales(spark, f"{tmp_root}/wh") == [(1, "a"), (2, None)]
