"""Ingestion modes (MOD-*) incl. the reference's smoke cases and idempotence."""

import datetime as dt

from pyspark.sql import functions as F

from lakegate.operators import modes as md

SCHEMA = "k long, k2 long, cmp timestamp_ntz, v string, FILE_NAME_RECEIVED string, FILE_LINE_ID long"


def t(d):
    return None if d is None else dt.datetime(2025, 1, d)


def frame(spark, rows):
    return spark.createDataFrame([(k, k2, t(c), v, "f.csv", i) for i, (k, k2, c, v) in enumerate(rows)], SCHEMA)


def test_snapshot_twice_golden(spark):
    b1 = spark.range(1000).withColumnRenamed("id", "customer_id")
    b2 = spark.range(950).withColumnRenamed("id", "customer_id")
    r1 = md.apply_mode("full_snapshot", None, None, b1)
    r2 = md.apply_mode("FULL_SNAPSHOT", r1.last, r1.all, b2)
    assert r2.last.count() == 950 and r2.all.count() == 1950


def test_flow_writes_all_only(spark):
    b = spark.createDataFrame([(1, "Alice"), (2, "Bob"), (3, "Charlie")], "customer_id int, name string")
    r = md.apply_mode("DELTA_FROM_FLOW", None, None, b)
    assert r.last is None and not r.last_written and r.all.count() == 3
    assert md.apply_mode("unknown", None, None, b).mode == "DELTA_FROM_FLOW"


def test_upsert_rules(spark):
    target = frame(spark, [(1, 0, 5, "t1"), (2, 0, None, "t2"), (3, 0, 5, "t3"), (4, 0, 5, "t4")])
    batch = frame(spark, [(1, 0, 6, "newer"), (2, 0, 1, "vs-null"), (3, 0, 5, "tie"), (4, 0, 4, "older"),
                          (5, 0, 1, "insert-a"), (5, 0, 2, "insert-b")])
    out = {r["k"]: r["v"] for r in md.upsert(target, batch, ["k"], "cmp").collect()}
    assert out == {1: "newer", 2: "vs-null", 3: "t3", 4: "t4", 5: "insert-b"}


def test_upsert_idempotent_and_null_keys(spark):
    target = frame(spark, [(1, 0, 5, "t1")])
    batch = frame(spark, [(1, 0, 6, "b1"), (None, 0, 9, "nk")])
    once = md.upsert(target, batch, ["k"], "cmp")
    twice = md.upsert(once, batch, ["k"], "cmp")
    a = sorted((r["k"] or -1, r["v"]) for r in once.collect())
    b = sorted((r["k"] or -1, r["v"]) for r in twice.collect())
    assert a == [(-1, "nk"), (1, "b1")]
    assert b == [(-1, "nk"), (-1, "nk"), (1, "b1")]  # a NULL key never matches (D15)


def test_key_replace_composite(spark):
    target = frame(spark, [(1, 1, 1, "a"), (1, 2, 1, "b"), (2, 1, 1, "c"), (2, 2, 1, "d")])
    batch = frame(spark, [(1, 2, 2, "B"), (2, 1, 2, "C")])
    out = sorted((r["k"], r["k2"], r["v"]) for r in md.key_replace(target, batch, ["k", "k2"]).collect())
    assert out == [(1, 1, "a"), (1, 2, "B"), (2, 1, "C"), (2, 2, "d")]  # no over-delete
    again = sorted((r["k"], r["k2"], r["v"]) for r in
                   md.key_replace(md.key_replace(target, batch, ["k", "k2"]), batch, ["k", "k2"]).collect())
    assert again == out


def test_historized_appends_both(spark):
    b = frame(spark, [(1, 0, 1, "x")])
    r = md.apply_mode("delta_from_historized", b, b, b)
    assert r.last.count() == 2 and r.all.count() == 2


def test_latest_per_key_hot_key(spark):
    df = spark.range(20000).select((F.col("id") % 2).alias("k"), F.lit(0).cast("long").alias("k2"),
                                   (F.lit("2025-01-01").cast("timestamp_ntz")).alias("cmp"),
                                   F.col("id").cast("string").alias("v"), F.lit("f").alias("FILE_NAME_RECEIVED"),
                                   F.col("id").alias("FILE_LINE_ID"))
    out = {r["k"]: r["v"] for r in md.latest_per_key(df, ["k"], "cmp", ["FILE_LINE_ID"]).collect()}
    assert out == {0: "19998", 1: "19999"}


def test_validity_ranges_hot_key(spark):
    from pyspark.sql import Window
    df = spark.range(0, 20000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).cast("long").alias("k"),
        (F.lit("2025-01-01").cast("timestamp_ntz") + F.make_interval(secs=(F.col("id") * 7919 % 20011).cast("int")))
        .alias("start"),
        F.lit("f").alias("FILE_NAME_RECEIVED"), F.col("id").alias("FILE_LINE_ID"))
    got = md.validity_ranges(df, ["k"], "start")
    want = df.withColumn("vt", F.lead("start").over(
        Window.partitionBy("k").orderBy("start", "FILE_NAME_RECEIVED", "FILE_LINE_ID")))
    bad = got.join(want, ["k", "FILE_LINE_ID"]).filter(~F.col("valid_to").eqNullSafe(F.col("vt"))).count()
    assert bad == 0 and got.count() == 20000
