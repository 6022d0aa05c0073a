"""Connected components of links, without collecting links or components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import materialize, release


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): each linked id with the least id of its component.

    Alternating large-star and small-star steps: each round links every node to the
    least node of its neighbourhood, so the number of rounds grows with the logarithm
    of the longest path, and it ends when a round changes nothing. Each round is written
    to the shared folder and the one before it deleted. The star of a large component is
    one aggregate value per node, never a collected group.
    """
    edges = materialize(links.select(F.col(a).alias("x"), F.col(b).alias("y")).filter("x != y").distinct())
    if edges.isEmpty():
        return edges.select(F.col("x").alias("id"), F.col("y").alias("component"))
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
        least = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        large = both.join(least, "x").filter("y > x").select(F.col("y").alias("x"), F.col("m").alias("y"))
        low = large.filter("x != y").distinct()
        down = low.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y"))
        floor = down.groupBy("x").agg(F.min("y").alias("m"))
        small = down.join(floor, "x").select(F.col("y").alias("x"), F.col("m").alias("y")).filter("x != y").unionByName(floor.select("x", F.col("m").alias("y")))
        old, edges = edges, materialize(small.distinct())
        release(old)
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)")).alias("h")).first()
        if now == before:
            break
        before = now
    tops = edges.select(F.col("y").alias("x")).distinct().select(F.col("x").alias("id"), F.col("x").alias("component"))
    return edges.select(F.col("x").alias("id"), F.col("y").alias("component")).unionByName(tops)
