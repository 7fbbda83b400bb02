"""Plan properties the design relies on (guards against re-introducing shuffles)."""

from pyspark.sql import functions as F

from lakegate.operators import modes as md
from lakegate.operators import quality as qa
from lakegate.operators.gates import file_stats
from lakegate.operators.rules import explode_errors, validate
from lakegate.plans import common as cm
from tests.conftest import SF_SMALL


def plan(df) -> str:
    """The executed plan; for an adaptive plan only its final part (the string also
    carries the initial plan)."""
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def dirty(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    return o.select(F.col("o_orderkey").alias("_line_order"), F.lit("f.csv").alias("_file_name"),
                    F.col("o_orderkey").cast("string").alias("orderkey"),
                    F.col("o_custkey").cast("string").alias("custkey"))


def test_validation_is_map_only(spark):
    _, rules = cm.rules_for(spark, "orders")
    v = validate(dirty(spark), rules[:2])
    p = plan(v)
    assert "Exchange" not in p and "Window" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_validation_and_line_decisions_stay_in_codegen(spark):
    _, rules = cm.rules_for(spark, "orders")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(validate(dirty(spark), rules[:2]))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    projects = [line for line in p.splitlines() if " Project [" in line or line.startswith("Project [")]
    assert projects and all("*(" in line for line in projects)


def test_file_stats_combine_map_side(spark):
    _, rules = cm.rules_for(spark, "orders")
    s = file_stats(validate(dirty(spark), rules[:2]), rules[:2])
    s.collect()
    p = plan(s)
    assert "partial_count" in p  # map-side partial aggregation before the shuffle


def test_top_n_has_partial_group_limit(spark):
    _, rules = cm.rules_for(spark, "orders")
    e = explode_errors(validate(dirty(spark), rules[:2]), ["_file_name", "_line_order"])
    t = qa.top_n_per_group(e, ["_file_name", "column"], ["_line_order"], 3)
    t.collect()
    p = plan(t)
    assert p.count("WindowGroupLimit") >= 2  # one before the exchange, one after


def test_upsert_is_one_aggregation(spark):
    a = spark.range(100).select(F.col("id").alias("k"), F.col("id").alias("cmp"),
                                F.lit("f").alias("FILE_NAME_RECEIVED"), F.col("id").alias("FILE_LINE_ID"))
    u = md.upsert(a, a, ["k"], "cmp")
    u.collect()
    p = plan(u)
    assert p.count("Exchange hashpartitioning") == 1 and "Join" not in p


def test_scan_prunes_columns(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey").filter("o_orderkey > 10")
    p = o._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint>" in p and "PushedFilters: [IsNotNull(o_orderkey), GreaterThan(o_orderkey,10)]" in p
