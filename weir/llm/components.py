"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.llm.common import sealed


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least member reachable from each of ``n`` members over links ``(i, j)``."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, label[i], low)
        np.minimum.at(label, label[j], low)
        label = label[label]
        if np.array_equal(label, before):
            return label


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang each node's larger (or smaller) neighbours on the smallest node around it."""
    pairs = _both_ways(edges)
    if not large:
        pairs = pairs.where("v < u")
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.min("u")).alias("m"))
    hung = pairs.join(least, "u")
    if large:
        moved = hung.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        moved = hung.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return moved.where("a <> b")


def _done(edges: DataFrame) -> bool:
    """Whether all edges ``(a, b)`` lead from a node that has no other one to a node that has none."""
    two = edges.groupBy("a").agg(F.min("b").alias("low"), F.max("b").alias("high")).where("low <> high")
    further = edges.join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_semi")
    return two.isEmpty() and further.isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of edges ``(a, b)``: the smallest node reachable, for every node of an edge.

    Each round is two aggregations, combined before their shuffles, and two joins, so a node with very many
    edges is never gathered; rounds grow with the logarithm of the longest path. Edges with a NULL end or from
    a node to itself, and repeated edges, change nothing.
    """
    lower = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = sealed(lower.distinct(), "components")
    while not _done(now):
        now = sealed(_star(_star(now, large=True), large=False).distinct(), "components")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
