"""Connected components of a link table by alternating star contraction, each round a few shuffles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.llm.common import checkpoint


def _star(edges: DataFrame) -> DataFrame:
    """edges (u, v), each in one direction: link every node of a neighbourhood to the smallest node in it."""
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return edges.join(least, "u")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of edges (a, b); component is the smallest node that can be reached.

    Large-star and small-star rounds (both keep components) until no link changes, which takes a number of rounds
    that grows with the logarithm of the longest chain. Minima are combined before each shuffle, so that a node
    with very many links is no hot spot of the aggregate; the join back to its links is one that can be split.
    Links with a null end and loops are left out. An empty table gives an empty table.
    """
    links = checkpoint(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    )
    state = None
    while True:
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            links.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        large = _star(both).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a > b").distinct()
        # each link now points to a smaller node: the small star links those smaller nodes with each other
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        small = _star(down)
        links = checkpoint(
            small.select(F.col("v").alias("a"), F.col("m").alias("b"))
            .union(small.select(F.col("u").alias("a"), F.col("m").alias("b")))
            .where("a > b")
            .distinct()
        )
        now = links.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
        ).first()
        if now == state:
            break
        state = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
