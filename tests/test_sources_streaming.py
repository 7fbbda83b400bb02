"""Readers (SRC-*), archives and streaming (STR-*)."""

import os
import zipfile

from pyspark.sql import functions as F

from lakegate.sources import archives as ar
from lakegate.sources import delimited as dl
from lakegate.streaming import staging as stg

NAMES = ["id", "name", "amount"]


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def test_header_modes(spark, tmp_root):
    write(f"{tmp_root}/a/t_20250101.csv", "ID;Name;Amount\n1;x;1,5\n2;y;2\n")
    write(f"{tmp_root}/a/t_20250102.csv", "amount;id;name\n3,5;3;z\n")
    use = dl.read_delimited(spark, f"{tmp_root}/a", NAMES, header_mode="HEADER_USE", delimiter=";")
    got = sorted((r["id"], r["name"], r["amount"], r["_file_name"]) for r in use.collect())
    assert got == [("1", "x", "1,5", "t_20250101.csv"), ("2", "y", "2", "t_20250101.csv"),
                   ("3", "z", "3,5", "t_20250102.csv")]
    first = dl.read_delimited(spark, f"{tmp_root}/a", NAMES, header_mode="FIRST_LINE", delimiter=";")
    assert first.count() == 3  # header skipped, names by position
    assert sorted(r["id"] for r in first.collect()) == ["1", "2", "3,5"]


def test_header_use_missing_column_is_null(spark, tmp_root):
    write(f"{tmp_root}/b/t.csv", "id;name\n1;x\n")
    r = dl.read_delimited(spark, f"{tmp_root}/b", NAMES, header_mode="HEADER_USE", delimiter=";").collect()
    assert [(x["id"], x["name"], x["amount"]) for x in r] == [("1", "x", None)]


def test_corrupt_records(spark, tmp_root):
    write(f"{tmp_root}/c/t.csv", "id;name;amount\n1;x;1\n2;y\n3;z;3;extra\n")
    r = dl.read_delimited(spark, f"{tmp_root}/c", NAMES, header_mode="", delimiter=";")
    bad = sorted(x[dl.CORRUPT] for x in dl.corrupt_lines(r).collect())
    assert bad == ["2;y", "3;z;3;extra"]


def test_zip_expansion(spark, tmp_root):
    d = f"{tmp_root}/z"
    os.makedirs(d)
    with zipfile.ZipFile(f"{d}/good.zip", "w") as zf:
        zf.writestr("orders_20250101.csv", "id;name;amount\n1;a;1\n2;b;2\n")
        zf.writestr("__MACOSX/._orders_20250101.csv", "junk")
        zf.writestr(".DS_Store", "junk")
        zf.writestr("folder/", "")
    with zipfile.ZipFile(f"{d}/empty.zip", "w") as zf:
        zf.writestr("__MACOSX/x", "junk")
    write(f"{d}/broken.zip", "not a zip")
    lines = ar.expand_archives(spark, d)
    rep = {os.path.basename(r["archive"]): r for r in ar.archive_report(lines).collect()}
    assert rep["good.zip"]["status"] == "SUCCESS" and rep["good.zip"]["lines"] == 2
    assert rep["empty.zip"]["error"] == "No valid files in ZIP"
    assert rep["broken.zip"]["error"].startswith("Invalid ZIP file")
    parsed = ar.parse_lines(lines.filter("status = 'OK'"), NAMES, ";").collect()
    assert sorted((r["table_name"], r["id"], r["amount"]) for r in parsed) == [("orders", "1", "1"), ("orders", "2", "2")]


def test_stream_equals_batch_and_rerun_adds_nothing(spark, tmp_root):
    for i in range(6):
        write(f"{tmp_root}/land/t_2025010{i}.csv", "id,name,amount\n" + "".join(f"{i}{j},n,{j}\n" for j in range(5)))
    ck, out = f"{tmp_root}/ck", f"{tmp_root}/t_staging"
    s = stg.landing_stream(spark, f"{tmp_root}/land", NAMES, "csv", max_files_per_trigger=2)
    r1 = stg.stage(s.drop("_file_path"), out, ck)
    assert r1.rows == 30 and r1.status == "SUCCESS" and r1.batches >= 3
    batch = dl.read_delimited(spark, f"{tmp_root}/land", NAMES)
    staged = spark.read.parquet(out)
    assert sorted(tuple(r) for r in staged.select(*NAMES, "_file_name").collect()) == \
        sorted(tuple(r) for r in batch.select(*NAMES, "_file_name").collect())
    s2 = stg.landing_stream(spark, f"{tmp_root}/land", NAMES, "csv", max_files_per_trigger=2)
    r2 = stg.stage(s2.drop("_file_path"), out, ck)
    assert r2.rows == 0 and r2.status == "NO_DATA"
    assert spark.read.parquet(out).count() == 30
    names = [r[0] for r in stg.list_staging_tables(spark, tmp_root).collect()]
    assert names == ["t_staging"]


def test_staging_counts_more_batches_than_spark_reports_by_default(spark, tmp_root):
    import os

    from lakegate.streaming import staging as stg
    os.makedirs(f"{tmp_root}/many")
    for i in range(120):
        with open(f"{tmp_root}/many/f_{i:03d}.csv", "w") as fh:
            fh.write("a\n1\n")
    stream = stg.landing_stream(spark, f"{tmp_root}/many", ["a"], max_files_per_trigger=1)
    stats = stg.stage(stream, f"{tmp_root}/many_staging", f"{tmp_root}/many_ck")
    assert (stats.rows, stats.batches) == (120, 120)
