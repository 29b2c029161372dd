"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.storage import stored


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """One star step. Only minima are aggregated, never the neighbours of a vertex."""
    both = edges.union(edges.select("b", "a")) if larger else edges
    least = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    moved = both.join(least, both["a"] == least["u"])
    if larger:
        return moved.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
        least.select(F.col("u").alias("a"), F.col("m").alias("b"))
    )


def _tidy(edges: DataFrame) -> DataFrame:
    turned = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return turned.where("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """The least vertex that each vertex of an edge reaches.

    Takes edges (a, b) of 64-bit vertices, in any direction and with repeats; returns
    (vertex, root) for every vertex that has an edge to another vertex, roots left out.
    Each round is written to the shared folder, so a lost executor costs one round.
    Without edges the result is empty. The hub of a star is joined, not collected:
    Spark can split it.
    """
    edges = stored(_tidy(edges.select("a", "b")), "edges")
    seen = None
    while True:
        size = edges.agg(
            F.count("*").alias("n"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"),
        ).first()
        if size == seen or not size["n"]:
            return edges.select(F.col("a").alias("vertex"), F.col("b").alias("root"))
        seen = size
        edges = stored(_tidy(_stars(_tidy(_stars(edges, True)), False)), "edges")
