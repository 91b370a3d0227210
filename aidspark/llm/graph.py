"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aidspark.llm.common import materialize


def components(edges: DataFrame, u: str, v: str, max_rounds: int = 60) -> DataFrame:
    """``node, root`` (smallest node reachable) of every node with an edge to
    another one, by alternating large-star and small-star steps (Kiveris et al.,
    2014). A node's neighbours are only ever reduced to their minimum, so a hub
    is pre-aggregated and no group is collected. Each round is written to the
    shared folder."""
    now = materialize(edges.select(F.greatest(u, v).alias("a"), F.least(u, v).alias("b"))
                      .filter("a > b").distinct(), "edges")
    mark = None
    for _ in range(max_rounds):
        both = now.union(now.select(F.col("b"), F.col("a"))).toDF("n", "m")
        low = both.groupBy("n").agg(F.least(F.min("m"), F.col("n")).alias("low"))
        large = both.join(low, "n").filter("m > n").select(F.col("m").alias("a"), F.col("low").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(least, "a").select(
            F.explode(F.array(F.struct(F.col("a"), F.col("low").alias("b")),
                              F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e")).select("e.*")
        now = materialize(small.filter("a > b").distinct(), "edges")
        new = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == mark:
            break
        mark = new
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
