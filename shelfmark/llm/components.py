"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import hot_values, kept, lookup


def _star(edges: DataFrame, both_ways: bool) -> DataFrame:
    """Link each node's neighbours (large: the greater ones, small: the lesser ones) to its least."""
    arcs = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    if both_ways:
        arcs = arcs.unionByName(arcs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = kept(arcs.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), "star-least", short=True)
    # A node with a large share of all arcs is dealt to many tasks.
    hot = hot_values(least, "u", "n")
    least = least.select("u", F.least("u", "m").alias("m"))
    joined = lookup(arcs, least, "u", hot=hot)
    if both_ways:
        linked = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        linked = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return kept(linked.where("u != v").distinct(), "star-links", short=True)


def components(edges: DataFrame) -> DataFrame:
    """`id, label` of every node of `edges (u, v)`: label is the least id of its component.

    Each star step keeps components as they are and brings nodes nearer to the least one; steps
    alternate until a pair of them changes nothing, which takes about log(nodes) rounds. Only counts
    and a checksum reach the driver. Loops and repeated edges change nothing; no edges, no rows.
    """

    def print_of(df: DataFrame) -> tuple:
        # A sum of decimals: it neither overflows nor depends on order.
        h = F.xxhash64("u", "v").cast("decimal(20,0)")
        return tuple(df.agg(F.count("*"), F.sum(h)).first())

    links = edges.where("u != v").select("u", "v").distinct()
    links = kept(links, "links", short=True)
    before = None
    while (now := print_of(links)) != before:
        before = now
        links = _star(_star(links, True), False)
    ends = links.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("label"))
    return ends.unionByName(links.select(F.col("v").alias("id"), F.col("v").alias("label")).distinct())
