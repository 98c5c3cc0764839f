"""Connected components of a table of links, by alternating large-star and small-star steps.

Both steps keep the components and shorten paths; the number of rounds grows with the logarithm of
the longest path. Rounds end when every component is a star round its smallest node, which one count over the
links' ends tells; links that are stars from the start take no round. Every round is written to the shared folder,
so lineage stays short and nothing but that count reaches the driver. Minima are combined map-side; a node with
very many links is split by adaptive execution in the joins. Further links are taken in between the components that
are known already (``joined``), so the rounds for them meet no link that lies within one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tijara.llm.common import stored

MAX_ROUNDS = 60


def _stars(edges: DataFrame) -> bool:
    """Whether every larger end of ``edges`` (a > b) has one edge and is no edge's smaller end."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not ends.where("up > 1 or up = 1 and down = 1").agg(F.count(F.lit(1))).first()[0]


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b): component is its smallest node."""
    a, b = F.col("a"), F.col("b")
    edges = stored(links.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "links")
    rounds = 0
    while not _stars(edges):
        if rounds == MAX_ROUNDS:
            raise RuntimeError("components did not settle")
        rounds += 1
        # large star: every larger neighbour of a node points to the node's smallest neighbour (or itself)
        both = edges.unionByName(edges.select(b.alias("a"), a.alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where(b > a).join(least, "a").select(b.alias("a"), F.col("m").alias("b")).distinct()
        # small star: a node's smaller neighbours, and the node, point to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").where(b != F.col("m")).select(b.alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        edges = stored(small, "links")
    return edges.select(a.alias("node"), b.alias("component")).unionByName(
        edges.select(b.alias("node"), b.alias("component"))).distinct()


def joined(found: DataFrame, links: DataFrame) -> DataFrame:
    """``found`` (node, component) after further ``links`` (a, b)."""
    for x in "ab":
        of_end = found.select(F.col("node").alias(x), F.col("component").alias("of_end"))
        links = links.join(of_end, x, "left").withColumn(x, F.coalesce("of_end", x)).drop("of_end")
    roots = components(links)  # of components, and of nodes that had none
    moved = found.join(roots.select(F.col("node").alias("component"), F.col("component").alias("root")), "component", "left")
    return stored(moved.select("node", F.coalesce("root", "component").alias("component")).unionByName(roots).distinct(), "found")
