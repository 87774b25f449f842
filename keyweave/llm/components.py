"""Connected components of a table of links, by alternating star steps.

A large-star step ties every larger neighbour of a node to the least node around it, a small-star step does so for the
smaller ones; both keep components, and repeated they leave a star around each component's least node, after
about the logarithm of the longest path. Least neighbours are written tables, so that the joins on them read two plain
exchanges and a node with very many links is split over tasks. Only two numbers a step come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyweave.llm.shared import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
    return both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = stored(edges.groupBy("a").agg(F.min("b").alias("m")), "least")
    moved = edges.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.withColumnRenamed("m", "b")).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row.n, row.x


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b: long, any order, repeats allowed) to node, root: the least node reachable. Nodes that are their
    own root are left out, and so are links of a node with itself or with null."""
    edges = stored(links.where(F.col("a") != F.col("b"))
                   .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = _state(edges)
    while state[0]:
        edges = stored(_large_star(edges), "large-star")
        edges = stored(_small_star(edges), "small-star")
        now = _state(edges)
        if now == state:
            break
        state = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
