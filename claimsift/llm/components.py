"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from claimsift.llm.common import staged


def _nearest(links: DataFrame) -> DataFrame:
    """The smallest neighbour of each node ``u``; combined before the shuffle, so a hub costs no more than others."""
    return links.groupBy("u").agg(F.min("v").alias("m"))


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root`` for every node of at least one link; the root is the smallest node of its component.

    Alternates two steps until nothing changes: every node's larger neighbours are tied to the smallest node it sees,
    then its smaller ones are. Each round at least halves long chains, and rounds are written to the shared folder.
    Null ends and links of a node to itself are ignored. No links give no rows.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    edges = staged(edges, "links")
    state = None
    while True:
        both = edges.union(edges.select("v", "u"))
        found = _nearest(both).select("u", F.least("u", "m").alias("m"))
        larger = both.filter("v > u").join(found, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        smaller = _nearest(larger)
        pulled = larger.join(smaller, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        edges = staged(pulled.union(smaller.select("u", F.col("m").alias("v"))).distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            break
        state = now
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(edges.select("v", "v").distinct())
