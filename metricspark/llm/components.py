"""Connected components of a link table, by alternating star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricspark.session import durable


def connected_components(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b); a component is its smallest node.

    Each round hangs the larger neighbours of a node on its smallest neighbour, then the
    smaller ones, until each node hangs on the smallest of its component. The smallest
    neighbour comes from an aggregation with map-side combine and goes back by an equi join,
    so no neighbour list is ever built, however many links a node has. The edges are
    written to the shared folder after each round. No links give no rows.

    With ``rounds``, the work stops after so many: nodes of one group are then connected,
    though a component may still be several groups.
    """
    edges = durable(_distinct(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))), "edges")
    before, left = None, rounds
    while before != (before := _signature(edges)) and left != 0:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = durable(_distinct(large), "edges")
        small = _star(large).select(F.explode(F.array("v", "u")).alias("u"), F.col("low").alias("v"))
        edges = durable(_distinct(small), "edges")
        left = None if left is None else left - 1
    hung = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    roots = edges.select(F.col("v").alias("node")).distinct().join(hung.select("node"), "node", "left_anti")
    return hung.unionByName(roots.select("node", F.col("node").alias("component")))


def _signature(edges: DataFrame) -> tuple:
    """Number of edges and a sum over their hashes: equal for equal sets of edges."""
    mixed = F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), mixed, F.sum(F.col("v").cast("decimal(20,0)"))).first())


def _distinct(edges: DataFrame) -> DataFrame:
    return edges.where("u <> v").select("u", "v").distinct()


def _star(edges: DataFrame) -> DataFrame:
    """Each edge (u, v) with the smallest of u and its neighbours."""
    low = edges.groupBy(F.col("u").alias("_u")).agg(F.min(F.least("u", "v")).alias("low"))
    return edges.join(low, F.col("u") == F.col("_u")).drop("_u")
