"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.frames import packed, written


def _stars(edges: DataFrame, large: bool, rows: int) -> DataFrame:
    """Of `rows` links, link each node's neighbours above it (large) or at most equal (small) to its least neighbour."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    least = written(packed(least, rows))
    linked = both.join(least, "u")
    if large:
        out = linked.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = linked.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return packed(packed(out.filter("a <> b"), rows).distinct(), rows)


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, component_id) for every node that has a link; the id is the least node reachable.

    Links are undirected, may repeat and may lead from a node to itself. Every round halves long chains
    at least; the rows of a round are written to the shared folder, so a lost executor costs no earlier
    round. A node with very many links is spread over tasks: its least neighbour is combined before the
    shuffle, and the join back may split its rows.
    """
    edges = links.select(
        F.greatest(F.col(left), F.col(right)).alias("a"), F.least(F.col(left), F.col(right)).alias("b")
    ).filter("a <> b").distinct()
    edges = written(edges)
    rows = edges.count()
    edges = packed(edges, rows)
    state = None
    while True:
        edges = written(_stars(_stars(edges, True, rows), False, rows))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component_id")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component_id")).distinct()
    )
