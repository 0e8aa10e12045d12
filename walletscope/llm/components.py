"""Connected components of an edge list by alternating star contractions.

Each round hangs every vertex's larger neighbours on its smallest one, then its smaller
neighbours; both steps are a minimum per vertex, which Spark folds before it shuffles,
and a join that it may split where one vertex has many edges. Rounds are written below the
shared folder, so a lost executor repeats one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from walletscope.plans.settle import settle


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    ways = _both_ways(edges)
    least = ways.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("_m"))
    return ways.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("_m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("_m"))
    hung = down.join(least, "a").select(F.col("b").alias("a"), F.col("_m").alias("b"))
    return hung.unionByName(least.select("a", F.col("_m").alias("b"))).filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(vertex, component) for the vertices of ``edges`` (a, b); a component is named by its least vertex."""
    now = settle(edges.filter("a <> b").select("a", "b"), "components")
    seen = None
    while True:
        now = settle(_small_star(_large_star(now).filter("a <> b").distinct()), "components")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    stars = now.select(F.col("a").alias("vertex"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("vertex"), "component").distinct())
