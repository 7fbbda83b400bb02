"""Expression functions on the golden cases of the reference documents."""

import datetime as dt

from pyspark.sql import functions as F

from lakegate.functions import dates as fd
from lakegate.functions import filenames as fn
from lakegate.functions.config import parse_bool, parse_percent
from lakegate.functions.text import null_token


def one(spark, col):
    return spark.range(1).select(col.alias("x")).collect()[0]["x"]


def test_table_from_filename(spark):
    cases = {
        "billing_20251016_101112.csv": "billing",
        "Billing_20251028.csv": "billing",
        "20251016_orders.csv": "orders",
        "site.csv": "site",
        "customers.csv": "customers",
        "2025_10.csv": "2025",
    }
    for name, expected in cases.items():
        assert one(spark, fn.table_from_filename(F.lit(name))) == expected, name


def test_fix_parts(spark):
    assert one(spark, fn.fix_part_from_pattern(F.lit("Billing_<yyyy><mm><dd>.csv"))) == "Billing"
    assert one(spark, fn.fix_part_from_pattern(F.lit("<yyyy><mm><dd>_data.csv"))) == ""
    assert one(spark, fn.fix_part_from_filename(F.lit("billing_20251028.csv"))) == "billing"
    assert one(spark, fn.fix_part_from_filename(F.lit("Billing_20251028.csv"))) == "Billing"
    assert one(spark, fn.fix_part_from_filename(F.lit("site2025.csv"))) == "site"


def test_filename_date_reasons(spark):
    assert one(spark, fd.filename_date_reason(F.lit("billing_20251016.csv"))) is None
    assert one(spark, fd.filename_date_reason(F.lit("site.csv"))) is None
    assert one(spark, fd.filename_date_reason(F.lit("site.csv"), require_date=True)) is not None
    assert "month" in one(spark, fd.filename_date_reason(F.lit("b_20251332.csv")))
    assert "day" in one(spark, fd.filename_date_reason(F.lit("b_20251232.csv")))
    assert "year" in one(spark, fd.filename_date_reason(F.lit("b_18001201.csv")))
    assert one(spark, fd.filename_date_reason(F.lit("b_20250230.csv"))) == "no such day: 2025-02-30"


def test_file_date_patterns(spark):
    assert one(spark, fd.file_date(F.lit("customers_20251016_101112.csv"))) == dt.datetime(2025, 10, 16, 10, 11, 12)
    assert one(spark, fd.file_date(F.lit("customers_20251016.csv"))) == dt.datetime(2025, 10, 16)
    assert one(spark, fd.file_date(F.lit("customers_2025-10-16.csv"))) == dt.datetime(2025, 10, 16)
    assert one(spark, fd.file_date(F.lit("customers_2025_10_16.csv"))) == dt.datetime(2025, 10, 16)
    assert one(spark, fd.file_date(F.lit("customers.csv"))) is None
    assert one(spark, fd.file_date(F.lit("customers_20251332.csv"))) is None


def test_strict_date_golden(spark):
    p = "dd/MM/yyyy HH:mm:ss"
    assert one(spark, fd.parse_strict(F.lit("15/10/2025 10:77:10"), p)) is None
    assert one(spark, fd.parse_strict(F.lit("15/10/2025 10:10:10"), p)) == dt.datetime(2025, 10, 15, 10, 10, 10)
    out = fd.to_output_text(fd.parse_strict(F.lit("15/10/2025"), "dd/MM/yyyy"))
    assert one(spark, out) == "2025-10-15 00:00:00"


def test_multi_pattern_default(spark):
    pats = ["yyyy-MM-dd", "dd/MM/yyyy"]
    assert one(spark, fd.parse_multi(F.lit("15/10/2025"), pats)) == dt.datetime(2025, 10, 15)
    assert one(spark, fd.parse_multi(F.lit("junk"), pats, "1900-01-01 00:00:00")) == dt.datetime(1900, 1, 1)


def test_config_cells(spark):
    assert one(spark, null_token(F.lit(" NaN "))) is None
    assert one(spark, null_token(F.lit("None"))) is None
    assert one(spark, parse_bool(F.lit("nan"), True)) is True
    assert one(spark, parse_bool(F.lit("False"), True)) is False
    assert float(one(spark, parse_percent(F.lit("10%"), 5))) == 10.0
    assert float(one(spark, parse_percent(F.lit("0.1"), 5))) == 10.0
    assert float(one(spark, parse_percent(F.lit(""), 5))) == 5.0


def test_routing_ignores_case(spark):
    assert one(spark, fn.routes_to(F.lit("Billing_20251028.csv"), F.lit("billing")))
    assert one(spark, fn.routes_to(F.lit("billing.csv"), F.lit("billing")))
    assert not one(spark, fn.routes_to(F.lit("billingx_1.csv"), F.lit("billing")))
