"""Connected components by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_ROUNDS = 100


def _least(links: DataFrame) -> DataFrame:
    """The smallest of each node's neighbours and itself. Stored, so that the join with it can be split."""
    return links.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")).checkpoint()


def component_roots(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node with a link.

    Each round hangs larger neighbours on a node's smallest one, then smaller ones too;
    it ends when nothing changes, after about log n rounds. Nodes are not collected.
    """
    links = (
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where("u != v")
        .distinct()
        .checkpoint()
    )
    stamp = None
    for _ in range(MOST_ROUNDS):
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == stamp:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        stamp = now
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct().checkpoint()
        nearest = _least(large)
        small = large.join(nearest, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = small.union(nearest.select("u", F.col("m").alias("v"))).where("u != v").distinct().checkpoint()
    raise ValueError(f"components did not settle in {MOST_ROUNDS} rounds")
