"""Connected components by alternating large-star and small-star rounds; nothing but two sums reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, remove


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of edges (a, b), root being the smallest node of its component.

    Every round is written to the shared folder. Minima are aggregated before they are joined back, so a hub with very many
    neighbours never has its list gathered; the joins on it can be split by adaptive execution. No edges give no rows.
    """
    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    now = materialize(now, "edges")
    mark = None
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        before, now = now, materialize(small.where("u <> v").distinct(), "edges")
        remove(before)
        new = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if new == mark:
            break
        mark = new
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
