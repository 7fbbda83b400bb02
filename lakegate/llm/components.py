"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegate.llm.common import stored


def _starred(pairs: DataFrame, centre: DataFrame) -> DataFrame:
    """Join ``x, y`` with the stored least neighbour ``m`` of x (stored, so that a hot x can be split)."""
    return pairs.join(stored(centre), "x")


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (its smallest node) for every node of the links ``a, b``."""
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    links = stored(links.distinct())
    state = _state(links)
    while state[0]:
        both = links.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(
            links.select(F.col("v").alias("x"), F.col("u").alias("y")))
        centre = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = stored(_starred(both, centre).where("y > x").select(F.col("y").alias("u"), F.col("m").alias("v"))
                             .distinct())
        down = large.select(F.col("u").alias("x"), F.col("v").alias("y"))
        small = _starred(down, down.groupBy("x").agg(F.min("y").alias("m")))
        links = stored(small.select(F.explode(F.array(
            F.struct(F.col("x").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("y").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v").where("u <> v").distinct())
        before, state = state, _state(links)
        if state == before:
            break
    nodes = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stored(nodes.unionByName(roots))
