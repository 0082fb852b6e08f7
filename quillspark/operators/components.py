"""Connected components (A26, A27) without a driver-side union-find."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.storage import materialize, release


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """node, root of each node that has an edge to another: root is the component's smallest node.

    Alternating large-star and small-star steps over DataFrames. Each step is a written table, so the lineage stays short; it
    ends when the edges are stars round the roots, after a number of steps that grows with the logarithm of the nodes.
    """
    v, u = F.greatest(a, b), F.least(a, b)
    now, sign = materialize(edges.where(F.col(a) != F.col(b)).select(v.alias("v"), u.alias("u")).distinct()), None
    for _ in range(rounds):
        both = now.unionAll(now.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.min(F.least("u", "v")).alias("m"))
        large = both.join(least, "v").where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u")).distinct()
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        moved = large.join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u"))
        before, now = now, materialize(moved.unionAll(least.select("v", F.col("m").alias("u"))).where("u < v").distinct())
        release(before)
        new = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if new == sign:
            return now.select(F.col("v").alias("node"), F.col("u").alias("root")).unionAll(now.select(F.col("u").alias("node"), F.col("u").alias("root"))).distinct()
        sign = new
    raise RuntimeError(f"components: no end after {rounds} rounds")
