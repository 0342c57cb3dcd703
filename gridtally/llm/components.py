"""Connected components of a stored edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.session import saved


def _stars(edges: DataFrame, small: bool) -> DataFrame:
    """Join every node's neighbours to the least of them and itself; only larger or only smaller ones move."""
    both = edges if small else edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    linked = both.join(least, "u")
    if small:
        moved = linked.select(F.col("v").alias("a"), "m").unionByName(linked.select(F.col("u").alias("a"), "m"))
    else:
        moved = linked.filter("v > u").select(F.col("v").alias("a"), "m")
    return moved.filter("a > m").select(F.col("a").alias("u"), F.col("m").alias("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (u, v): root is the least node that can be reached.

    Alternating large and small stars; every round is written, so lost executors cost one round at most.
    Nodes without an edge do not appear; loops and repeated edges do no harm.
    """
    stars = saved(
        edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "stars"
    )
    before = None
    while True:
        mark = stars.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v").cast("long"))).first()
        if mark == before or mark[0] == 0:
            break
        before = mark
        stars = saved(_stars(_stars(stars, small=False), small=True), "stars")
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
