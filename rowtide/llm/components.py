"""Connected components of links by alternating large and small stars; every step is a shuffle, none a driver loop over rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.blocks import written

SALTS = 16


def _to_least(arcs: DataFrame, salts: int) -> DataFrame:
    """``u, v, least`` of each arc u -> v: the smallest of u and all its v. A node of many arcs is dealt over ``salts`` tasks."""
    least = arcs.groupBy("u").agg(F.least("u", F.min("v")).alias("least"))
    least = least.select("u", "least", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    return arcs.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(salts)).cast("int")).join(least, ["u", "salt"])


def components(links: DataFrame, salts: int = SALTS) -> DataFrame:
    """``node, component`` for each node of ``a, b`` links: the smallest node that it reaches.

    The number of rounds grows with the logarithm of the longest path; each round's arcs are written down.
    """
    arcs = written(links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "arcs")
    before = None
    while True:
        both = arcs.union(arcs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _to_least(both, salts).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("least").alias("v"))
        large = large.where(F.col("u") != F.col("v")).distinct()
        small = _to_least(large, salts)
        hung = small.select(F.col("v").alias("u"), F.col("least").alias("v")).union(small.select("u", F.col("least").alias("v")))
        arcs = written(hung.where(F.col("u") != F.col("v")).distinct(), "arcs")
        now = arcs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    stars = arcs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(arcs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
