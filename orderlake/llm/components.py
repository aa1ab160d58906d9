"""Connected components of a graph given as an edge table.

Alternating large-star and small-star steps: each is a minimum per node and a
join back, so that a node with very many edges is pre-aggregated before the
shuffle and its join partition can be split. No list of neighbours is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import land

#: The steps shrink the graph's depth geometrically; more rounds than this mean a defect.
MOST_ROUNDS = 40


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to its smallest neighbour (or itself)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = land(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")), "smallest")
    linked = both.filter("b > a").join(smallest, F.col("a") == F.col("node"))
    return linked.select(F.col("b").alias("a"), F.least("node", "m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node's smaller neighbours and itself to the smallest one. Rows come as a > b."""
    smallest = land(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")), "smallest")
    linked = edges.join(smallest, F.col("a") == F.col("node")).filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.unionByName(smallest.select(F.col("node").alias("a"), F.col("m").alias("b"))).distinct()


def _normal(edges: DataFrame, a: str, b: str) -> DataFrame:
    edges = edges.select(F.greatest(a, b).cast("long").alias("a"), F.least(a, b).cast("long").alias("b"))
    return land(edges.filter("a <> b").distinct(), "edges")


def _members(edges: DataFrame) -> DataFrame:
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))


def provisional_components(edges: DataFrame, rounds: int, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) after some rounds: nodes with one component are connected, but not all connected nodes have one yet."""
    edges = _normal(edges, a, b)
    for _ in range(rounds):
        edges = land(_small_star(_large_star(edges)), "edges")
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    nodes = nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")))
    return nodes.groupBy("node").agg(F.min("component").alias("component"))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for each node of an edge; component is the smallest node reached.

    Edges with a null end or equal ends are ignored; repeats and directions
    don't matter; no edges give no rows.
    """
    edges = _normal(edges, a, b)
    # settled when a round changes no edge, seen from the number of edges and the sum of their hashes
    state = [F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("hashes")]
    before = edges.agg(*state).first()
    for _ in range(MOST_ROUNDS):
        if not before["n"]:
            break
        edges = land(_small_star(_large_star(edges)), "edges")
        after = edges.agg(*state).first()
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    return _members(edges)
