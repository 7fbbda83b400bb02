"""End-to-end ingestion run over a real landing folder (two runs)."""

import os
import zipfile

from pyspark.sql import functions as F

from lakegate.functions.filenames import as_literal_path
from lakegate.plans import tables as tb
from lakegate.plans.ingest import Ingestion, RunParams
from lakegate.plans.specs import column_sheet, table_sheet

TABLES = [
    {"Delta Table Name": "sales", "Filename Pattern": "sales_<yyyy><mm><dd>.csv", "Input delimiter": ";",
     "Input header": "FIRST_LINE", "Ingestion mode": "DELTA_FROM_NON_HISTORIZED",
     "Invalid column per line tolerance": "50%", "Rejected line per file tolerance": "40%", "Partitioning": "yyyy/mm"},
    {"Delta Table Name": "stock", "Input delimiter": ",", "Input header": "HEADER_USE",
     "Ingestion mode": "FULL_SNAPSHOT", "last_table_name_conf": "stock_current"},
]
COLUMNS = [
    {"Delta Table Name": "sales", "Column Name": "id", "Field type": "LONG", "Is Nullable": "false",
     "Is Special": "IsMergeKey"},
    {"Delta Table Name": "sales", "Column Name": "amount", "Field type": "DECIMAL", "Error action": "REJECT",
     "Comment": "sale amount"},
    {"Delta Table Name": "sales", "Column Name": "day", "Field type": "DATE", "Transformation pattern": "dd/MM/yyyy",
     "Is Special": "IsStartValidity"},
    {"Delta Table Name": "stock", "Column Name": "sku", "Field type": "STRING", "Is Nullable": "false"},
    {"Delta Table Name": "stock", "Column Name": "qty", "Field type": "INTEGER"},
]


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def test_two_runs(spark, tmp_root):
    land1 = f"{tmp_root}/land1"
    write(f"{land1}/sales_20250101.csv",
          "id;amount;day\n1;1,50;01/01/2025\n2;x;01/01/2025\nID;Amount;Day\n3;3;02/01/2025\n")  # repeated header
    write(f"{land1}/sales_20251301.csv", "id;amount;day\n9;9;01/01/2025\n")            # bad date in name
    write(f"{land1}/Sales_20250102.csv", "id;amount;day\n8;8;01/01/2025\n")            # fix part case
    write(f"{land1}/unknown_20250101.csv", "a\n1\n")                                    # no config
    write(f"{land1}/stock_20250101.csv", "qty,sku\n5,A\n6,B\n")
    write(f"{land1}/stock_20250102.csv", "sku\nC\n")                                  # no qty column
    write(f"{land1}/sales_20250104.csv", "id;amount;day\n11;1;04/01/2025\n12;1\n")  # short line -> 000000006
    with zipfile.ZipFile(f"{land1}/batch.zip", "w") as zf:
        zf.writestr("sales_20250103.csv", "id;amount;day\n1;2,00;03/01/2025\n4;4;03/01/2025\n")
        zf.writestr("__MACOSX/._x", "junk")
    wh = f"{tmp_root}/wh"
    sheets = (table_sheet(spark, TABLES), column_sheet(spark, COLUMNS))
    ing = Ingestion(spark, *sheets, wh, RunParams())
    r = ing.run(land1, "r1", run_at="2025-01-04 00:00:00")
    st = {row["filename"]: (row["status"], row["error_code"]) for row in r.outcomes.collect()}
    assert st["sales_20250101.csv"] == ("SUCCESS", None)
    assert st["sales_20251301.csv"] == ("FAILED", "000000001")
    assert st["Sales_20250102.csv"] == ("FAILED", "000000001")
    assert st["unknown_20250101.csv"] == ("FAILED", "NO_CONFIG")
    assert st["stock_20250101.csv"] == ("SUCCESS", None)
    assert st["stock_20250102.csv"] == ("SUCCESS", None)
    assert st["sales_20250103.csv"] == ("SUCCESS", None)
    assert st["sales_20250104.csv"] == ("FAILED", "000000006")
    bad = spark.read.parquet(f"{wh}/sales_bad_records").collect()
    assert [(b["filename"], b["line_number"], b["raw_line"]) for b in bad] == [("sales_20250104.csv", 2, "12;1")]
    errs = spark.read.parquet(f"{wh}/sales_errors").filter("code = 'TYPE_MISMATCH'").collect()
    assert [(e["filename"], e["line_number"], e["column"]) for e in errs] == [("sales_20250101.csv", 2, "amount")]
    last = {x["id"]: x for x in tb.read_current(spark, f"{wh}/sales_last").collect()}
    assert sorted(last) == [1, 3, 4]  # 2 rejected (REJECT action); 1 updated by the later file
    assert str(last[1]["amount"]) == "2.00"
    assert [c for c in tb.read_current(spark, f"{wh}/sales_last").columns][:4] == \
        ["FILE_LINE_ID", "FILE_NAME_RECEIVED", "FILE_EXTRACTION_DATE", "FILE_PROCESS_DATE"]
    stock = tb.read_current(spark, f"{wh}/stock_current")
    assert [(x["sku"], x["qty"]) for x in stock.collect()] == [("C", None)]  # the newest file is the snapshot
    assert spark.read.parquet(f"{wh}/stock_all").count() == 3
    info = spark.read.parquet(f"{wh}/stock_errors").filter("code = 'INFO_MISSING_COLUMN'").collect()
    assert [(i["filename"], i["column"]) for i in info] == [("stock_20250102.csv", "qty")]
    allp = spark.read.parquet(f"{wh}/sales_all")
    assert {"yyyy", "mm", "run"} <= set(allp.columns) and allp.count() == 4
    assert allp.schema["amount"].metadata.get("comment") == "sale amount"  # SNK-6
    assert ing.retained_tracking("2025-01-05 00:00:00").count() == 8
    assert ing.retained_invalid_lines("sales", "2025-01-05 00:00:00").count() == 1
    inv = spark.read.parquet(f"{wh}/sales_invalid_lines").collect()
    assert [(x["id"], x["line_number"], x["error_type"]) for x in inv] == [(2, 2, "TYPE_MISMATCH")]
    rs = {x["table_name"]: x["run_status"] for x in r.run_status.collect()}
    assert rs["sales"] == "PARTIAL" and rs["stock"] == "SUCCESS"
    assert all(x["complete"] for x in r.completeness.collect())
    ms = {x["table_name"]: (x["mode"], x["last_written"]) for x in r.mode_stats.collect()}
    assert ms == {"sales": ("DELTA_FROM_NON_HISTORIZED", True), "stock": ("FULL_SNAPSHOT", True)}
    assert "duration_sec" in r.execution_report.columns

    # second run: same files again -> duplicates; an older file -> late
    land2 = f"{tmp_root}/land2"
    write(f"{land2}/sales_20250101.csv", "id;amount;day\n1;1;01/01/2025\n")
    write(f"{land2}/sales_20241231.csv", "id;amount;day\n7;7;31/12/2024\n")
    write(f"{land2}/sales_20250105.csv", "id;amount;day\n5;5;05/01/2025\n")
    r2 = Ingestion(spark, *sheets, wh, RunParams()).run(land2, "r2", run_at="2025-01-05 00:00:00")
    st2 = {row["filename"]: (row["status"], row["error_code"]) for row in r2.outcomes.collect()}
    assert st2 == {"sales_20250101.csv": ("FAILED", "000000002"), "sales_20241231.csv": ("FAILED", "000000003"),
                   "sales_20250105.csv": ("SUCCESS", None)}
    assert sorted(x["id"] for x in tb.read_current(spark, f"{wh}/sales_last").collect()) == [1, 3, 4, 5]
    trk = tb.read_runs(spark, f"{wh}/tracking")
    assert trk.filter(F.col("status") == "FAILED").count() == 6


def test_stream_run_equals_batch(spark, tmp_root):
    land = f"{tmp_root}/sl"
    for d in range(1, 7):
        write(f"{land}/sales_2025010{d}.csv", "id;amount;day\n" +
              "".join(f"{d * 10 + j};{j},5;0{d}/01/2025\n" for j in range(4)) + f"{d};x;0{d}/01/2025\n")
    write(f"{land}/sales_20251399.csv", "id;amount;day\n1;1;01/01/2025\n")
    write(f"{land}/stock_20250101.csv", "qty,sku\n5,A\n")
    # files arrive in date order: the stream takes them by modification time
    for i, name in enumerate(sorted(os.listdir(land))):
        os.utime(f"{land}/{name}", (1_700_000_000 + i * 60, 1_700_000_000 + i * 60))
    sheets = (table_sheet(spark, TABLES), column_sheet(spark, COLUMNS))
    wh_s, wh_b = f"{tmp_root}/whs", f"{tmp_root}/whb"
    stats = Ingestion(spark, *sheets, wh_s).run_stream(land, "sales", f"{tmp_root}/ck", "s",
                                                       max_files_per_trigger=2, run_at="2025-01-10 00:00:00")
    assert stats.rows == 6 * 5 and stats.batches >= 3  # the file that a gate refuses is not read
    Ingestion(spark, *sheets, wh_b).run(land, "b", run_at="2025-01-10 00:00:00")
    cols = ["FILE_NAME_RECEIVED", "FILE_LINE_ID", "id", "amount", "day"]
    s_last = sorted(tuple(r) for r in tb.read_current(spark, f"{wh_s}/sales_last").select(*cols).collect())
    b_last = sorted(tuple(r) for r in tb.read_current(spark, f"{wh_b}/sales_last").select(*cols).collect())
    assert s_last == b_last and len(s_last) == 24
    failed = tb.read_runs(spark, f"{wh_s}/tracking").filter("status = 'FAILED'").collect()
    assert [r["filename"] for r in failed] == ["sales_20251399.csv"]
    again = Ingestion(spark, *sheets, wh_s).run_stream(land, "sales", f"{tmp_root}/ck", "s")
    assert again.rows == 0


def test_stream_of_all_formats_equals_batch(spark, tmp_root):
    """Archives (CSV, JSON, several lines), Parquet, JSON and the three header modes, tables together."""
    land = f"{tmp_root}/[all] {{formats}}"  # signs of patterns in the path
    tables = [
        {"Delta Table Name": "sales", "Input delimiter": ";", "Input header": "FIRST_LINE", "Ingestion mode": "DELTA_FROM_HISTORIZED",
         "Input Format": "csv_quote_ml"},
        {"Delta Table Name": "stock", "Input delimiter": ",", "Input header": "HEADER_USE", "Ingestion mode": "DELTA_FROM_HISTORIZED"},
        {"Delta Table Name": "visits", "Input delimiter": ";", "Ingestion mode": "DELTA_FROM_HISTORIZED"}]
    columns = [
        {"Delta Table Name": "sales", "Column Name": "id", "Field type": "LONG", "Is Nullable": "false"},
        {"Delta Table Name": "sales", "Column Name": "note", "Field type": "STRING"},
        {"Delta Table Name": "stock", "Column Name": "sku", "Field type": "STRING", "Is Nullable": "false"},
        {"Delta Table Name": "stock", "Column Name": "qty", "Field type": "INTEGER"},
        {"Delta Table Name": "visits", "Column Name": "id", "Field type": "LONG", "Is Nullable": "false"},
        {"Delta Table Name": "visits", "Column Name": "page", "Field type": "STRING"}]
    write(f"{land}/sales_20250101.csv", 'id;note\n1;"a;\nb"\n2;c\n')
    write(f"{land}/a/stock_20250101.csv", "qty,sku\n5,A\n")
    write(f"{land}/b/stock_20250102.csv", "sku,other,qty\nB,x,6\nC,y,bad\n")
    write(f"{land}/visits_20250101.csv", "id;page\n1;p\n")
    write(f"{land}/visits_20250102.csv", "id;page\n")  # no lines: SKIPPED
    write(f"{land}/visits_20250103.json", '{"id": 2, "page": "q"}\n{"id": "x", "page": "r"}\n')
    write(f"{land}/broken_20250101.zip", "none")
    spark.createDataFrame([(7, "parquet")], "id long, page string").toPandas().to_parquet(f"{land}/visits_20250104.parquet")
    with zipfile.ZipFile(f"{land}/packed_20250105.zip", "w", zipfile.ZIP_DEFLATED) as zf:
        zf.writestr("sales_20250105.csv", 'id;note\n8;"d\ne"\n')
        zf.writestr("x/stock_20250105.csv", "qty,sku\n9,D\n")
        zf.writestr("visits_20250105.json", '{"id": 10, "page": "z"}\n')
        zf.writestr("visits_20259999.csv", "id;page\n1;p\n")
    sheets = (table_sheet(spark, tables), column_sheet(spark, columns))
    params = RunParams(rlt_default=90, ict_default=90, file_order_check_enabled=False)
    at = "2025-02-01 00:00:00"
    batch = Ingestion(spark, *sheets, f"{tmp_root}/wb", params)
    stream = Ingestion(spark, *sheets, f"{tmp_root}/ws", params)
    batch.run(as_literal_path(land), "b", run_at=at)
    stats = stream.run_stream(as_literal_path(land),
                              None, f"{tmp_root}/ck", "s", max_files_per_trigger=4, run_at=at)
    assert stats.batches == 3 and stats.status == "SUCCESS"

    def rows(df, *cols):
        return sorted(map(str, df.select(*cols).collect()))
    counts = []
    for table, names in (("sales", ["id", "note"]), ("stock", ["sku", "qty"]), ("visits", ["id", "page"])):
        for kept in ("last", "all"):
            cols = ["FILE_NAME_RECEIVED", "FILE_LINE_ID", *names]
            one, other = (tb.read_current(spark, f"{tmp_root}/{w}/{table}_{kept}").select(*cols) for w in ("wb", "ws"))
            assert rows(one, *cols) == rows(other, *cols), (table, kept)
            counts.append(other.count())
    assert counts == [3, 3, 4, 4, 5, 5]
    for name, cols in (("completeness", ["table_name"]), ("quarantine", ["filename"])):
        assert rows(batch.report(name), *cols) and set(rows(stream.report(name), *cols)) == set(rows(batch.report(name), *cols))
    files = ["table_name", "filename", "status", "error_code"]
    assert rows(batch.spark.read.parquet(f"{tmp_root}/wb/outcomes"), *files) == rows(
        spark.read.parquet(f"{tmp_root}/ws/outcomes"), *files)
    skipped = spark.read.parquet(f"{tmp_root}/ws/outcomes").where("status = 'SKIPPED'").collect()
    assert [r["filename"] for r in skipped] == ["visits_20250102.csv"]
    assert stream.run_stream(as_literal_path(land),
                             None, f"{tmp_root}/ck", "s").status == "NO_DATA"


def test_cli_batch_run(spark, tmp_root):
    import csv

    from lakegate.__main__ import main
    from lakegate.plans.specs import COLUMN_SHEET_COLUMNS, TABLE_SHEET_COLUMNS
    for name, cols, rows in (("t.csv", TABLE_SHEET_COLUMNS, TABLES), ("c.csv", COLUMN_SHEET_COLUMNS, COLUMNS)):
        with open(f"{tmp_root}/{name}", "w", newline="") as fh:
            w = csv.DictWriter(fh, fieldnames=list(cols))
            w.writeheader()
            for r in rows:
                w.writerow({k: r.get(k, "") for k in cols})
    write(f"{tmp_root}/cl/sales_20250101.csv", "id;amount;day\n1;1;01/01/2025\n")
    rc = main(["--tables", f"{tmp_root}/t.csv", "--columns", f"{tmp_root}/c.csv", "--landing", f"{tmp_root}/cl",
               "--warehouse", f"{tmp_root}/clw", "--run-id", "r1"])
    assert rc == 0
    assert tb.read_current(spark, f"{tmp_root}/clw/sales_last").count() == 1


def run_of(spark, land, wh, run_id="r1", tables=TABLES, columns=COLUMNS, **params):
    ing = Ingestion(spark, table_sheet(spark, tables), column_sheet(spark, columns), wh, RunParams(**params))
    return ing.run(land, run_id, run_at="2025-01-04 00:00:00")


def statuses(r):
    return {os.path.basename(x["path"]): (x["status"], x["error_code"], x["rows_ingested"]) for x in r.outcomes.collect()}


def test_no_landed_file_is_lost(spark, tmp_root):
    """Names with blanks, '!', '+', '%', a leading date, any case; folders; wide headers; other formats."""
    land, body = f"{tmp_root}/l", "id;amount;day\n{0};1;01/01/2025\n"
    names = ["a/sales_2025 0101 x.csv", "new!/sales_20250102.csv", "20250101_sales_x.csv", "p+c/sales_20250103+1.csv",
             "q%20/sales_20250104%41.csv", "b/sales_20250105.CSV"]
    for i, n in enumerate(names):
        write(f"{land}/{n}", body.format(i))
    write(f"{land}/b/sales_20251399.csv", body.format(9))
    write(f"{land}/b/sales_20250106.csv", "id;amount;day\n")
    write(f"{land}/b/sales_20250102.csv", body.format(8))  # the name again, in another folder
    write(f"{land}/stock_20250101.csv", ",".join(f"x{i}" for i in range(12)) + ",SKU,qty\n" + "0," * 12 + "A,5\n")
    write(f"{land}/stock_20250102.json", '{"sku": "B", "qty": 7}\n')
    r = run_of(spark, land, f"{tmp_root}/w")
    st = {x["path"].split("/l/", 1)[1]: (x["status"], x["rows_ingested"]) for x in r.outcomes.collect()}
    assert len(st) == 11
    twice = [st.pop("new!/sales_20250102.csv"), st.pop("b/sales_20250102.csv")]
    assert sorted(twice) == [("FAILED", 0), ("SUCCESS", 1)]
    assert st.pop("b/sales_20251399.csv") == ("FAILED", 0) and st.pop("b/sales_20250106.csv") == ("SKIPPED", 0)
    assert set(st.values()) == {("SUCCESS", 1)}, st
    stock = spark.read.parquet(f"{tmp_root}/w/stock_all")
    assert sorted((x["sku"], x["qty"]) for x in stock.collect()) == [("A", 5), ("B", 7)]
    assert all(x["complete"] for x in r.completeness.collect())


def test_archives_pass_the_same_gates(spark, tmp_root):
    land = f"{tmp_root}/z"
    os.makedirs(land)
    with zipfile.ZipFile(f"{land}/UP.ZIP", "w") as zf:
        zf.writestr("sales_20250101.csv", "id;amount;day\n1;1;01/01/2025\n")
        zf.writestr("sales_20251399.csv", "id;amount;day\n2;1;01/01/2025\n")
        zf.writestr("sales_20250102.csv", "id;amount;day\n")
        zf.writestr("sales_20250103.csv", "id;amount;day\n5;1\n")
        zf.writestr("stock_20250101.csv", "qty,note,sku\n5,x,\xc9\n".encode("latin-1"))
    with zipfile.ZipFile(f"{land}/sales.zip", "w") as zf:
        zf.writestr("data.csv", "id;amount;day\n7;1;01/01/2025\n")
    with zipfile.ZipFile(f"{land}/none.zip", "w") as zf:
        zf.writestr("__MACOSX/x", "y")
    write(f"{land}/bad.zip", "no archive")
    tables = [TABLES[0], TABLES[1] | {"Input charset": "ISO-8859-1"}]
    r = run_of(spark, land, f"{tmp_root}/w", tables=tables)
    assert statuses(r) == {
        "sales_20250101.csv": ("SUCCESS", None, 1), "sales_20251399.csv": ("FAILED", "000000001", 0),
        "sales_20250102.csv": ("SKIPPED", None, 0), "sales_20250103.csv": ("FAILED", "000000006", 0),
        "stock_20250101.csv": ("SUCCESS", None, 1), "data.csv": ("SUCCESS", None, 1),
        "none.zip": ("FAILED", "INVALID_ARCHIVE", 0), "bad.zip": ("FAILED", "INVALID_ARCHIVE", 0)}
    assert sorted(x["id"] for x in tb.read_current(spark, f"{tmp_root}/w/sales_last").collect()) == [1, 7]
    assert [(x["sku"], x["qty"]) for x in tb.read_current(spark, f"{tmp_root}/w/stock_current").collect()] == [("É", 5)]
    assert all(x["complete"] for x in r.completeness.collect())


def test_a_repeated_run_changes_nothing(spark, tmp_root):
    land, wh = f"{tmp_root}/l", f"{tmp_root}/w"
    write(f"{land}/sales_20250101.csv", "id;amount;day\n1;1;01/01/2025\n")
    write(f"{land}/stock_20250101.csv", "qty,sku\n5,A\n")
    tables = [TABLES[0], TABLES[1] | {"Ingestion mode": "DELTA_FROM_HISTORIZED"}]
    results = []
    for run_id in ("r1", "r1", "r2", "r2"):
        st = statuses(run_of(spark, land, wh, run_id, tables, duplicate_check_enabled=run_id == "r1"))
        last = [sorted(map(str, tb.read_current(spark, f"{wh}/{t}").select("FILE_LINE_ID", c).collect()))
                for t, c in (("sales_last", "id"), ("stock_current", "sku"))]
        results.append((st, last, tb.read_runs(spark, f"{wh}/tracking").filter("status = 'SUCCESS'").count()))
    assert results[0] == results[1] and results[2] == results[3]
    assert set(results[0][0].values()) == {("SUCCESS", None, 1)} and [len(x) for x in results[2][1]] == [1, 2]


def test_a_failing_table_stops_no_other(spark, tmp_root):
    land, wh = f"{tmp_root}/l", f"{tmp_root}/w"
    write(f"{land}/sales_20250101.csv", "id;amount;day\n1;1;01/01/2025\n")
    write(f"{land}/stock_20250101.csv", "qty,sku\n5,A\n")
    tables = [TABLES[0], TABLES[1] | {"Ingestion mode": "DELTA_FROM_NON_HISTORIZED"}]  # no merge key
    r = run_of(spark, land, wh, tables=tables)
    st = statuses(r)
    assert st["sales_20250101.csv"] == ("SUCCESS", None, 1) and st["stock_20250101.csv"][:2] == ("ERROR", "TECHNICAL_ERROR")
    assert {x["table_name"]: x["run_status"] for x in r.run_status.collect()} == {"sales": "SUCCESS", "stock": "ERROR"}
    assert all(x["complete"] for x in r.completeness.collect())
    assert tb.read_runs(spark, f"{wh}/tracking").count() == 2


def test_a_column_added_to_the_sheet_reaches_the_target(spark, tmp_root):
    wh, more = f"{tmp_root}/w", [*COLUMNS, {"Delta Table Name": "sales", "Column Name": "note", "Field type": "STRING"}]
    write(f"{tmp_root}/1/sales_20250101.csv", "id;amount;day\n1;1;01/01/2025\n2;1;01/01/2025\n")
    write(f"{tmp_root}/2/sales_20250102.csv", "id;amount;day;note\n2;1;02/01/2025;n\n")
    run_of(spark, f"{tmp_root}/1", wh)
    run_of(spark, f"{tmp_root}/2", wh, "r2", columns=more)
    last = tb.read_current(spark, f"{wh}/sales_last")
    assert sorted((x["id"], x["note"]) for x in last.collect()) == [(1, None), (2, "n")]


def test_key_replace_takes_each_key_from_its_newest_file(spark, tmp_root):
    write(f"{tmp_root}/l/sales_20250101.csv", "id;amount;day\n1;1;01/01/2025\n2;1;01/01/2025\n")
    write(f"{tmp_root}/l/sales_20250102.csv", "id;amount;day\n2;5;02/01/2025\n2;6;02/01/2025\n")
    run_of(spark, f"{tmp_root}/l", f"{tmp_root}/w", tables=[TABLES[0] | {"Ingestion mode": "FULL_KEY_REPLACE"}])
    last = tb.read_current(spark, f"{tmp_root}/w/sales_last")
    assert sorted((x["id"], int(x["amount"])) for x in last.collect()) == [(1, 1), (2, 5), (2, 6)]
