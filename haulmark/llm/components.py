"""Connected components of a table of links, by alternating star contractions.

Each round replaces links so that every node points to smaller ones: a large star links
the larger neighbours of a node to its least neighbour, a small star the smaller ones.
The links then form one star per component around its least node. A round moves each
link a constant number of times, and a node with very many links is only ever met in a
map-side combined minimum and in a join whose large partitions Spark may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from haulmark.llm.common import discard, stash


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of a link; root is the least node reachable.

    Links with a null end and links of a node to itself say nothing and are left out;
    repeated links count once; no links give no rows.
    """
    links = links.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v"))
    links = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    links, before = stash(links, "links"), None
    while True:
        old, links = links, stash(_small(_large(links)), "links")
        discard(old)
        # the links are a set, so an order-free sum of their hashes tells whether it has changed
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = links.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _large(links: DataFrame) -> DataFrame:
    """Links (larger, smaller) to (larger neighbour, least neighbour or the node itself)."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(links: DataFrame) -> DataFrame:
    """Links of a node to smaller ones become links of those and of itself to the least."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
