"""Bad cells of a whole number cost no exception."""

from pyspark.sql import functions as F

from lakegate.functions.text import may_be_whole
from lakegate.operators.rules import typed_value
from lakegate.plans import common as cm


def test_text_that_is_no_number_reaches_no_cast(spark):
    texts = ["7", " -7\t", "+7", "7.5", ".5", "1e3", "7d", "bad", "N/A", "", "-", "9223372036854775808", "٣", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for kind in ("int", "bigint"):
        lost = df.filter(F.col("t").try_cast(kind).isNotNull() & ~F.coalesce(may_be_whole("t"), F.lit(False)))
        assert lost.isEmpty()
    assert {r["t"] for r in df.filter(may_be_whole("t")).collect()} == {"7", " -7\t", "+7", "9223372036854775808"}
    _, rules = cm.rules_for(spark, "orders")
    plan = df.select(typed_value(F.col("t"), rules[0])[0].alias("v"))._jdf.queryExecution().executedPlan().toString()
    assert "RLIKE" in plan.upper()
