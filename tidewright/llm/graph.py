"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.session import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to the smallest node it knows."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hands itself and its smaller neighbours to the smallest of them (``a`` > ``b`` here)."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``links``; root is the smallest node of its component.

    Each round shrinks the distance to the root at least like pointer jumping and leaves at most one
    row per link. The rows of a hub are combined map-side before its minimum is known, and the join
    that hands the minimum out is one whose skewed partitions the runtime plan splits. Rounds are cut
    by a table on shared storage. Null ends and self links are ignored; repeated links count once.
    """
    edges = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    edges = cut_lineage(edges.where("a <> b").distinct())
    seen = None
    while True:
        edges = cut_lineage(_small_star(_large_star(edges)).distinct())
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
