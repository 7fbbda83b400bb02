"""What an ingestion run keeps on disk: no copy of raw lines, no shuffle files of ended queries, merges in turns."""

import os
import time

import pytest

from lakegate.plans import buckets as bk
from lakegate.plans import common as cm
from lakegate.plans import fixtures as fx
from lakegate.plans import landings as ld
from lakegate.plans.catalog import LINEITEM_VALUES, ORDER_VALUES
from lakegate.plans.ingest import Ingestion, RunParams
from lakegate.plans.specs import column_sheet, table_sheet
from lakegate.plans.tables import read_current
from lakegate.session import LEAN_CONF, lean_on_disk
from lakegate.sources import delimited as dl

CELLS = dict(zip(LINEITEM_VALUES, ["1", "1", "2", "3", "1,50", "2,50", "0,05", "0,01", "R", "O", "2025-01-02"]))


def _file(folder, name, order, keys, before=""):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write(before + ";".join(order) + "\n")
        for k in keys:
            f.write(";".join(str(k) if c == "orderkey" else CELLS.get(c, "?") for c in order) + "\n")


def _run(spark, root):
    sheet = [r | {"Input delimiter": ";"} for r in fx.LINEITEM_TABLE_ROWS]
    run = Ingestion(spark, table_sheet(spark, sheet), column_sheet(spark, fx.LINEITEM_COLUMN_ROWS), f"{root}/wh", RunParams())
    return run.run(f"{root}/land", "r1", run_at=cm.AS_OF)


def test_lines_are_mapped_to_header_names_without_a_copy(spark, tmp_root):
    land = f"{tmp_root}/land"
    _file(land, "lineitem_20250101.csv", LINEITEM_VALUES, range(1, 6), before="  \n\n")
    _file(land, "lineitem_20250201.csv", ["note", *LINEITEM_VALUES[::-1]], range(6, 9))
    _file(land, "lineitem_20250301.csv", LINEITEM_VALUES, [])
    out = _run(spark, tmp_root)
    assert {r["filename"]: (r["status"], r["rows_ingested"]) for r in out.outcomes.collect()} == {
        "lineitem_20250101.csv": ("SUCCESS", 5), "lineitem_20250201.csv": ("SUCCESS", 3), "lineitem_20250301.csv": ("SKIPPED", 0)}
    last = read_current(spark, f"{tmp_root}/wh/lineitem_last").select("orderkey", "FILE_LINE_ID", "returnflag", "linestatus").collect()
    assert sorted(map(tuple, last)) == [(k, k if k < 6 else k - 5, "r", "O") for k in range(1, 9)]
    staged = spark.read.parquet(f"{tmp_root}/wh/lineitem_validated/run=r1")
    assert staged.count() == 8 and staged.filter("_raw_data is null").isEmpty()
    assert not os.path.exists(f"{tmp_root}/wh/lineitem_staging/run=r1/direct")


@pytest.mark.parametrize("text", ["a;b;c\n1;2;3\n", " A ;\"b;x\";\n1;2;3\n", "\n \na;b\n", "a\n", "a;b;c;d;e\n1;2;3\n", "", "\n", "a;b;c",
                                  "a;\\;b;c\n", "\"a;b;c\n1;2\n", "a;;c\n", "h\u00e9;b;c\n"])
def test_headers_from_first_lines_equal_the_parsed_ones(spark, tmp_root, text):
    with open(f"{tmp_root}/f.csv", "w") as f:
        f.write(text)
    raw, pos = dl.read_positional(spark, tmp_root, 3, delimiter=";")
    first = dl.first_lines(spark, tmp_root)
    columns = ["_h_path", "_h_name", "_h_fields", "_header"]
    got, want = (h.select(*columns).collect() for h in (dl.parsed_headers(first, pos, ";"), dl.header_lines(raw, pos, ";")))
    assert got == want
    lines, _ = dl.read_positional(spark, tmp_root, 3, delimiter=";", skip_header=True)
    mapped = dl.remap_by_header(lines, ["a", "b"], pos, ";", headers=dl.parsed_headers(first, pos, ";"))
    cells = ["a", "b", dl.CORRUPT, "_file_path", "_file_name", "_block"]
    assert mapped.select(*cells).collect() == dl.remap_by_header(raw, ["a", "b"], pos, ";").select(*cells).collect()


def _shuffle_files(spark):
    blocks = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllBlocks().mkString("|")
    return {b for b in blocks.split("|") if b.startswith("shuffle_")}


def test_shuffle_files_go_with_their_query(spark, tmp_root):
    before = _shuffle_files(spark)
    cells = [(i, f"orders_2025010{i % 9 + 1}.csv", str(i), str(i), "1,5", "01/02/2025", "o", "1-x") for i in range(1, 200)]
    df = spark.createDataFrame(cells, ["_line_order", "_file_name", *ORDER_VALUES])
    ld.write_named_csv(df, f"{tmp_root}/land", ORDER_VALUES, ";")
    run = Ingestion(spark, table_sheet(spark, fx.ORDERS_TABLE_ROWS), column_sheet(spark, fx.ORDERS_COLUMN_ROWS),
                    f"{tmp_root}/wh", RunParams())
    out = run.run(f"{tmp_root}/land", "r1", run_at=cm.AS_OF)
    until = time.time() + 10  # files are removed in the background
    while _shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before
    assert sum(r["rows_ingested"] for r in out.outcomes.collect()) == 199


def test_settings_of_the_session_come_back(spark):
    free, codec = LEAN_CONF
    spark.conf.set(codec, "gzip")
    try:
        with lean_on_disk(spark):
            assert (spark.conf.get(free), spark.conf.get(codec)) == ("true", "gzip")
        assert spark.conf.get(free, None) is None and spark.conf.get(codec) == "gzip"
    finally:
        spark.conf.unset(codec)


def test_buckets_are_merged_in_turns(spark, tmp_root, monkeypatch):
    assert bk._slices({}) == []
    monkeypatch.setattr(bk, "ROWS_AT_ONCE", 10)
    assert bk._slices({3: 4, 0: 6, 1: 11, 2: 6}) == [[0], [1], [2, 3]]
    turns = []

    def step(current, batch):
        turns.append((0 if current is None else current.count(), batch.count()))
        kept = None if current is None else current.join(batch.select("k"), "k", "left_anti")
        return batch if kept is None else batch.unionByName(kept)

    def merge(run, pairs):
        rows = spark.createDataFrame([(k, v, "f", i) for i, (k, v) in enumerate(pairs)], "k long, v long, file string, line long")
        return bk.merge(f"{tmp_root}/t", f"{tmp_root}/before", run, rows, ["k"], ["file", "line"], step, 8)
    assert merge("r1", [(k, 0) for k in range(40)] + [(None, 7)]) == set(range(8))
    assert len(turns) > 3 and sum(n for _, n in turns) == 41
    turns.clear()
    touched = merge("r2", [(k, 1) for k in range(30, 50)])
    assert len(turns) > 1 and sum(n for _, n in turns) == 20
    got = sorted(((r["k"], r["v"]) for r in read_current(spark, f"{tmp_root}/t").collect()), key=str)
    assert got == sorted([(None, 7)] + [(k, int(k >= 30)) for k in range(50)], key=str)
    turns.clear()
    assert merge("r2", [(k, 2) for k in range(30, 32)]) == touched  # from the before-image again, buckets without a new row too
    got = sorted(((r["k"], r["v"]) for r in read_current(spark, f"{tmp_root}/t").collect()), key=str)
    assert got == sorted([(None, 7)] + [(k, 2 * int(k in (30, 31))) for k in range(40)], key=str)
