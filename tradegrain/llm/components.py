"""Connected components of a graph given as pairs of ids, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradegrain.session import settle


def _stars(edges: DataFrame) -> DataFrame:
    """Both contractions: larger neighbours, then smaller ones, go to the smallest neighbour.

    Each is an aggregate with map-side minima and a join that can split a hot node's rows.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    large = (both.join(least.select("a", F.least("a", "m").alias("m")), "a").where("b > a")
             .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    return (large.join(least, "a").where("b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b"))).distinct())


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
                 .first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest id of its component, for every node of `edges` (a, b).

    Every round writes the edges to the shared folder, so that lineage stays short. Rounds grow
    with the logarithm of a component's width; edges never become more.
    """
    edges = settle(edges.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                                F.least("a", "b").alias("b")).distinct(), "edges")
    mark = _mark(edges)
    while mark[0]:
        edges = settle(_stars(edges), "edges")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    return (edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()))


def forest(pairs) -> list[tuple[int, int]]:
    """Of pairs of ids, those that already join everything that all of them join."""
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    kept = []
    for a, b in pairs:
        x, y = top(a), top(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept.append((a, b))
    return kept
