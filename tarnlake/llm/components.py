"""Connected components of a graph given as a table of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tarnlake.llm.common import staged


def components(links: DataFrame, label: str = "component") -> DataFrame:
    """(node, component) for every node of `links` (a, b: long), the component being its smallest node.

    Each round hooks every node's larger neighbours, then its smaller ones, to its smallest
    neighbour; the rounds needed grow with the logarithm of the longest chain. A minimum per node is
    combined before the shuffle and stored, so a node with very many links is no burden, and the join that
    follows is one Spark can split. Rounds are written to the shared folder: nothing is collected but
    one checksum per round, and a lost executor costs at most one round. Self links and repeated
    links are allowed; nulls link nothing; an empty table gives an empty result.
    """
    edges = staged(
        links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        f"{label}-links")
    seen = None
    while True:
        edges = staged(_small_star(_large_star(edges)), f"{label}-stars")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
    nodes = links.select(F.explode(F.array("a", "b")).alias("node")).filter("node IS NOT NULL").distinct()
    return nodes.join(edges.select(F.col("u").alias("node"), F.col("v").alias("component")), "node", "left").select(
        "node", F.coalesce("component", "node").alias("component"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = staged(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "stars-least")
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = staged(edges.groupBy("u").agg(F.min("v").alias("m")), "stars-least")
    joined = edges.join(least, "u")
    hooked = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hooked.unionAll(least.select("u", F.col("m").alias("v"))).distinct()
