"""Connected components of a link table by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import attach, written


def _towards_least(links: DataFrame, everywhere: bool) -> DataFrame:
    """Each node's neighbours linked to the least of them and the node.

    ``everywhere`` looks at all neighbours and moves the larger ones (large star); else only the
    smaller neighbours are looked at and moved, with the node itself (small star).
    """
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if everywhere else links
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count("*").alias("n"))
    joined = attach(both, written(least), ["a"])
    if everywhere:
        moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
        moved = moved.unionByName(least.select("a", F.col("m").alias("b")))
    return moved.where("a <> b").distinct()


def _sign(links: DataFrame) -> tuple:
    """Equal for equal sets of links; different sets give different values but for chance."""
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root: for each node with a link, the least node it is connected to.

    Null ends and links of a node with itself are ignored; an empty table gives no rows.
    Each round is written to the shared folder, so no lineage grows.
    """
    ends = [F.col(a).cast("long"), F.col(b).cast("long")]
    links = links.where(ends[0] != ends[1])  # false for nulls too
    links = written(links.select(F.greatest(*ends).alias("a"), F.least(*ends).alias("b")).distinct())
    before = None
    while (now := _sign(links)) != before:
        if not now[0]:
            break
        before = now
        large = written(_towards_least(links, True))
        links = written(_towards_least(large, False))
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
