"""Rules engine and tolerance gates (QUA-*), golden cases + properties."""

from decimal import Decimal

from pyspark.sql import functions as F

from lakegate.operators.gates import GateParams, file_decisions, file_stats, gate
from lakegate.operators.rules import explode_errors, validate
from lakegate.plans.specs import ColumnRule


def frame(spark, rows, cols):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))


def test_ict_golden_two_of_twenty(spark):
    cols = [f"c{i}" for i in range(20)]
    rules = [ColumnRule(c, "INT", nullable=False) for c in cols]
    good = ["1"] * 20
    two_bad = ["x", "y"] + ["1"] * 18
    one_bad = ["x"] + ["1"] * 19
    df = frame(spark, [good, two_bad, one_bad], cols).withColumn("_file_name", F.lit("f.csv"))
    v = validate(df, rules, ict=10).select("_n_ict", "_ict_rejected").collect()
    assert [(r[0], r[1]) for r in v] == [(0, False), (2, True), (1, False)]
    strict = validate(df, rules, ict=10, strict=True).select("_ict_rejected").collect()
    assert [r[0] for r in strict] == [False, False, False]


def test_actions_and_messages(spark):
    rules = [ColumnRule("a", "LONG", nullable=False, action="REJECT"),
             ColumnRule("b", "DOUBLE", action="LOG_ONLY"),
             ColumnRule("c", "STRING", nullable=False, action="LOG_ONLY"),
             ColumnRule("d", "DATE", pattern="dd/MM/yyyy", action="ICT_DRIVEN")]
    df = frame(spark, [("1", "1,5", "Smith, John", "15/10/2025"), ("x", "abc", " ", "31/02/2025")],
               ["a", "b", "c", "d"]).withColumn("_file_name", F.lit("f.csv"))
    v = validate(df, rules, ict=50)
    rows = v.orderBy("a").collect()
    ok = [r for r in rows if r["a"] == 1][0]
    assert ok["b"] == 1.5 and ok["c"] == "Smith, John"  # D8: comma kept in text
    bad = [r for r in rows if r["a"] is None][0]
    codes = [(e["column"], e["code"], e["action"]) for e in bad["_errors"]]
    assert codes == [("a", "TYPE_MISMATCH", "REJECT"), ("b", "TYPE_MISMATCH", "LOG_ONLY"),
                     ("c", "NULL_VALUE", "LOG_ONLY"), ("d", "DATE_PARSE_ERROR", "ICT_DRIVEN")]
    assert bad["_reject"] and bad["_line_rejected"]
    e = explode_errors(v, ["a"]).filter("code = 'TYPE_MISMATCH'").select("message").collect()
    assert any("value: x" in r[0] for r in e)


def test_default_missing_and_enrichment(spark):
    rules = [ColumnRule("n", "INT", default="0"),
             ColumnRule("missing", "STRING", nullable=False),
             ColumnRule("suffix", enrich="filename-modified", pattern=".{8}$")]
    df = frame(spark, [("x",), ("7",)], ["n"]).withColumn("_file_name", F.lit("abc_20251016.csv"))
    rows = validate(df, rules).orderBy("n").collect()
    assert [r["n"] for r in rows] == [0, 7]
    assert all(r["missing"] is None and r["suffix"] == "1016.csv" for r in rows)
    assert all(any(e["code"] == "NULL_VALUE" for e in r["_errors"]) for r in rows)


def _lines(spark, n_total, n_bad, name="f.csv"):
    rows = [("x" if i < n_bad else "1",) for i in range(n_total)]
    return frame(spark, rows, ["a"]).withColumn("_file_name", F.lit(name))


def test_rlt_golden_150_of_1000(spark):
    rules = [ColumnRule("a", "INT", action="REJECT")]
    v = validate(_lines(spark, 1000, 150), rules)
    d = file_decisions(file_stats(v, rules), rules, GateParams(rlt=10)).collect()[0]
    assert d["rejected_lines"] == 150 and d["file_status"] == "REJECTED" and d["file_reason"] == "RLT_EXCEEDED"
    d2 = file_decisions(file_stats(v, rules), rules, GateParams(rlt=20)).collect()[0]
    assert d2["file_status"] == "ACCEPTED"


def test_fail_fast_golden_11_of_100(spark):
    rules = [ColumnRule("a", "INT", action="LOG_ONLY")]
    v = validate(_lines(spark, 100, 11), rules)
    p = GateParams(rlt=50, fail_fast_enabled=True, fail_fast_threshold=10)
    d = file_decisions(file_stats(v, rules), rules, p).collect()[0]
    assert d["fail_fast"] and d["file_reason"] == "000000007"


def test_column_abort(spark):
    rules = [ColumnRule("a", "INT", tolerance=Decimal(5))]
    v = validate(_lines(spark, 100, 5), rules, ict=200)
    d = file_decisions(file_stats(v, rules), rules, GateParams(rlt=50)).collect()[0]
    assert d["aborted_columns"] == "a" and d["file_reason"] == "ICT_DRIVEN_ABORT"


def test_routing_partition_property(spark):
    """valid + invalid = total; ICT-rejected lines stay in `_all` (D10)."""
    rules = [ColumnRule("a", "INT", nullable=False), ColumnRule("b", "INT", action="REJECT")]
    rows = [(str(i) if i % 3 else "x", str(i) if i % 5 else "y") for i in range(200)]
    df = frame(spark, rows, ["a", "b"]).withColumn("_file_name", F.lit("f.csv"))
    v = validate(df, rules, ict=50)
    routed, dec = gate(v, rules, GateParams(rlt=100))
    c = routed.agg(F.count(F.lit(1)).alias("n"), F.count_if("_to_last").alias("last"),
                   F.count_if("_line_rejected").alias("rej"), F.count_if("_to_all").alias("all"),
                   F.count_if("_reject").alias("reject")).collect()[0]
    assert c["last"] + c["rej"] == c["n"]
    assert c["all"] == c["n"] - c["reject"]


def test_ict_flagged_denominator(spark):
    """D9: ict_mode='flagged' divides by the ICT_DRIVEN columns only."""
    rules = [ColumnRule("a", "INT"), ColumnRule("b", "INT", action="LOG_ONLY"),
             ColumnRule("c", "INT", action="LOG_ONLY"), ColumnRule("d", "INT", action="LOG_ONLY")]
    df = frame(spark, [("x", "1", "1", "1")], ["a", "b", "c", "d"]).withColumn("_file_name", F.lit("f.csv"))
    assert validate(df, rules, ict=50).collect()[0]["_ict_rejected"] is False          # 1/4 = 25 %
    assert validate(df, rules, ict=50, ict_mode="flagged").collect()[0]["_ict_rejected"] is True  # 1/1


def test_column_count_ignores_delimiters_in_quotes(spark):
    from lakegate.operators.gates import column_count_gate
    lines = spark.createDataFrame([("a.csv", '1;"x;y";2'), ("a.csv", '1;"q\\";";2'), ("b.csv", "1;2"), ("b.csv", "1;2;3")],
                                  "_file_name string, line string")
    got = {r["_file_name"]: (r["min_fields"], r["max_fields"], r["file_status"])
           for r in column_count_gate(lines, "line", ";", 3).collect()}
    assert got == {"a.csv": (3, 3, "ACCEPTED"), "b.csv": (2, 3, "REJECTED")}
