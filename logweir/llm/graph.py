"""Connected components of an edge table by rounds of joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from logweir.llm.tables import cut


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _round(edges: DataFrame) -> DataFrame:
    """Large star then small star: every node is tied to smaller nodes, the number of edges doesn't grow.

    Both joins follow the exchange of their grouping, so a broadcast would only bring the rows to the driver.
    """
    both = _both(edges)
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    large = both.join(least.hint("merge"), "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    large = large.where(F.col("a") != F.col("b"))  # repeats go with the last distinct
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(least.hint("merge"), "a")
    tied = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return tied.where(F.col("a") != F.col("b")).distinct()


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """``edges`` cut, with a mark that two equal tables share, taken while they are written."""
    mark = Observation()
    total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    edges = cut(edges.observe(mark, F.count("*").alias("n"), total.alias("total")), "edges")
    return edges, (mark.get["n"], mark.get["total"])


def components(edges: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``(node, component)`` for every node of ``edges (a, b)``; the component is its smallest node.

    ``known (node, component)`` are the components of earlier edges, which then needn't be given again. The edges are
    rewritten round by round until each node points at its smallest reachable node; a long chain
    takes a number of rounds in the logarithm of its length. Null ends, loops and repeated edges change nothing.
    No edges give no rows.
    """
    a, b = F.col("a"), F.col("b")
    if known is not None:
        edges = edges.select("a", "b").union(known.select("node", "component"))
    edges, now = _written(edges.where(a != b).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    while now != mark and now[0]:
        mark = now
        edges, now = _written(_round(edges))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
