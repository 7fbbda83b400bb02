"""Dense line numbers, duplicate keys, null profile, versioned tables."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakegate.operators import quality as qa
from lakegate.plans import tables as tb


def test_dense_line_numbers_hot_group(spark):
    df = spark.range(0, 30000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 7).cast("string")).alias("g"),
        (F.col("id") * 7919 % 30011).alias("o"))
    got = qa.dense_line_numbers(df, ["g"], ["o"], "n")
    want = df.withColumn("n2", F.row_number().over(Window.partitionBy("g").orderBy("o")))
    diff = got.join(want, ["g", "o"]).filter(F.col("n") != F.col("n2")).count()
    assert diff == 0 and got.count() == 30000


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 50)), min_size=1, max_size=60,
                unique=True))
def test_dense_line_numbers_property(spark, rows):
    df = spark.createDataFrame(rows, "g string, o int")
    got = sorted((r["g"] or "", r["o"], r["n"]) for r in qa.dense_line_numbers(df, ["g"], ["o"], "n").collect())
    exp = []
    for g in {r[0] for r in rows}:
        for i, o in enumerate(sorted(o for gg, o in rows if gg == g)):
            exp.append((g or "", o, i + 1))
    assert got == sorted(exp)


def test_duplicate_keys_and_null_profile(spark):
    df = spark.createDataFrame([("f", 1, None), ("f", 1, None), ("f", 2, None), ("g", 3, "x")],
                               "_file_name string, k int, v string")
    d = qa.duplicate_keys(df, ["k"], "t").collect()
    assert [(r["k"], r["error_count"]) for r in d] == [(1, 2)]
    p = {r["_file_name"]: r for r in qa.null_profile(df, ["v"]).collect()}
    assert p["f"]["error_type"] == "FILE_EMPTY" and p["g"]["error_type"] is None


def test_top_n_per_group(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("g"), "id")
    r = qa.top_n_per_group(df, ["g"], ["id"], 3).collect()
    assert sorted(x["id"] for x in r) == [0, 1, 2, 3, 4, 5]


def test_versioned_tables(spark, tmp_root):
    root = f"{tmp_root}/t"
    assert tb.read_current(spark, root) is None
    v0 = tb.write_version(spark.range(3), root)
    v1 = tb.write_version(spark.range(5).withColumn("extra", F.lit("x")), root)
    assert (v0, v1) == (0, 1)
    cur = tb.read_current(spark, root)
    assert cur.count() == 5 and "extra" in cur.columns
    assert tb.write_version(spark.range(99), root, version=1) == 1  # replay: untouched
    assert tb.read_current(spark, root).count() == 5


def test_versions_of_runs_are_bound_to_the_run_and_expire(spark, tmp_root):
    root = f"{tmp_root}/rv"
    assert tb.read_before(spark, root, "a") is None
    for i, run in enumerate(("a", "b", "c", "d")):
        tb.write_run_version(spark.range(i + 1), root, run, keep=3)
    assert [run for _, run, _ in tb.run_versions(spark, root)] == ["b", "c", "d"]
    assert tb.read_before(spark, root, "d").count() == 3 and tb.read_before(spark, root, "e").count() == 4
    tb.write_run_version(spark.range(40), root, "d")  # a retry takes its own place again
    assert tb.committed_versions(spark, root) == [1, 2, 3] and tb.read_current(spark, root).count() == 40
