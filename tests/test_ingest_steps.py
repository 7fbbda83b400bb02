"""Steps of an ingestion run that grow no faster than its input."""

import datetime as dt
import os

from lakegate.operators import modes as md
from lakegate.plans import common as cm
from lakegate.plans import fixtures as fx
from lakegate.plans import landings as ld
from lakegate.plans.catalog import ORDER_VALUES
from lakegate.plans.ingest import Ingestion, RunParams
from lakegate.plans.specs import column_sheet, table_sheet
from lakegate.plans.tables import read_current


def _batch(spark):
    day = dt.datetime(2025, 1, 1)
    rows = [(1, "a", day, 1), (1, "b", day, 2), (2, "a", day, 1), (2, "a", day, 2), (3, "b", day, 1), (None, "a", day, 3),
            (None, "b", day, 3), (4, "a", None, 4), (4, "b", None, 5)]
    return spark.createDataFrame(rows, "k int, FILE_NAME_RECEIVED string, FILE_EXTRACTION_DATE timestamp_ntz, FILE_LINE_ID long")


def test_rows_of_keys_of_one_file_are_not_dealt_out(spark):
    b = _batch(spark)
    repeated = b.groupBy("k").count().filter("count > 1").select("k")
    want = [(None, "b", 3), (1, "b", 2), (2, "a", 1), (2, "a", 2), (3, "b", 1), (4, "b", 5)]
    for known in (None, repeated):
        stored = []

        def store(df):
            stored.extend(df.collect())
            return spark.createDataFrame(stored, df.schema)
        got = md.newest_file_per_key(b, ["k"], repeated=known, store=store)
        rows = sorted(((r["k"], r["FILE_NAME_RECEIVED"], r["FILE_LINE_ID"]) for r in got.collect()), key=lambda r: (r[0] or 0, r[1:]))
        assert rows == want and {r[0] for r in stored} == {None, 1, 4}


def test_upsert_of_known_repeated_keys_equals_upsert(spark):
    b = _batch(spark)
    repeated = b.groupBy("k").count().filter("count > 1").select("k")
    plain = md.upsert(None, b, ["k"], "FILE_EXTRACTION_DATE")
    known = md.upsert(None, b, ["k"], "FILE_EXTRACTION_DATE", repeated=repeated)
    assert sorted(map(str, known.collect())) == sorted(map(str, plain.collect())) and known.columns == plain.columns
    last = b.filter("k = 3")
    assert sorted(map(str, md.upsert(last, b, ["k"], "FILE_LINE_ID", repeated=repeated).collect())) == \
        sorted(map(str, md.upsert(last, b, ["k"], "FILE_LINE_ID").collect()))


def test_lines_are_validated_as_they_are_read_and_numbered_after(spark, tmp_root):
    cells = [(i, "orders_20250101.csv", str(i), str(i), "1,5", "01/02/2025", "o", "1-x") for i in range(1, 6)]
    df = spark.createDataFrame(cells, ["_line_order", "_file_name", *ORDER_VALUES])
    ld.write_named_csv(df, f"{tmp_root}/land", ORDER_VALUES, ";")
    run = Ingestion(spark, table_sheet(spark, fx.ORDERS_TABLE_ROWS), column_sheet(spark, fx.ORDERS_COLUMN_ROWS),
                    f"{tmp_root}/wh", RunParams())
    out = run.run(f"{tmp_root}/land", "r1", run_at=cm.AS_OF)
    assert [r["status"] for r in out.outcomes.collect()] == ["SUCCESS"]
    last = read_current(spark, f"{tmp_root}/wh/orders_last").select("orderkey", "FILE_LINE_ID").collect()
    assert sorted(map(tuple, last)) == [(i, i) for i in range(1, 6)]
    assert not os.path.exists(f"{tmp_root}/wh/orders_staging")  # no copy of the raw lines
    assert "line_number" not in spark.read.parquet(f"{tmp_root}/wh/orders_validated/run=r1").columns
