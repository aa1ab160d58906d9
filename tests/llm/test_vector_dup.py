from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlake.llm import vector_dup
from orderlake.llm.small_world import Graph

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute_force(rows):
    """vec_id -> (n_links, component_id), of vectors with distinct ids."""
    good = [(i, np.array(v, dtype=float), y) for i, v, y in rows if i is not None and y is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    parent = {i: i for i, _, _ in rows if i is not None}
    links = dict.fromkeys(parent, 0)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(good)):
        for b in range(a):
            (i, v, y), (j, w, z) = good[a], good[b]
            if y == z and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= 0.98:
                links[i] += 1
                links[j] += 1
                x, r = sorted((root(i), root(j)))
                parent[r] = x
    return {i: (links[i], root(i)) for i in parent}


def found(spark, rows):
    got = vector_dup.vector_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert all(r.kept == (r.vec_id is None or r.vec_id == r.component_id) for r in got)
    return got


def clusters(n, seed=1, dim=12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    rows = [(k * 3 + 1, (centres[rng.integers(6)] + rng.normal(size=dim) * rng.choice([0.05, 0.2, 1.0])).tolist(), int(rng.integers(3))) for k in range(n)]
    return rows + [(10_000 + k, [2 * x for x in rows[0][1]], rows[0][2]) for k in range(5)]


@pytest.mark.parametrize("shard", [8192, 40])
def test_matches_brute_force_in_one_and_many_shards(spark, monkeypatch, shard):
    monkeypatch.setattr(vector_dup, "SHARD_ROWS", shard)
    rows = clusters(420)
    got = found(spark, rows)
    assert len(got) == len(rows)
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == brute_force(rows)


def test_matches_brute_force_on_embeddings(spark, table):
    rows = [(i, [float(x) for x in v], y) for i, v, y in table("embeddings", "vec_id", "embedding", "label")]
    assert {r.vec_id: (r.n_links, r.component_id) for r in found(spark, rows)} == brute_force(rows)


def test_graph_recall_without_exact_help():
    rng = np.random.default_rng(4)
    x = vector_dup.unit(rng.normal(size=(1500, 16)))
    graph = Graph(x, np.arange(1500))
    loaded = Graph.load(x, *graph.dump())
    hits = 0
    for q in range(0, 1500, 50):  # ids divisible by 50 against all rows
        near = set(np.argsort(-(x @ x[q]))[:10].tolist())
        assert graph.search(x[q], 48) == loaded.search(x[q], 48)
        hits += len(near & set(loaded.search(x[q], 48)[:10]))
    assert hits / 300 >= 0.9


def test_widens_the_beam_until_the_audit_passes(monkeypatch):
    x = vector_dup.unit(np.random.default_rng(5).normal(size=(400, 4)))
    shard = vector_dup._Shard.__new__(vector_dup._Shard)
    shard.ids, shard.weights, shard.unit, shard.graph = np.arange(400), np.ones(400, int), x, Graph(x, np.arange(400))
    monkeypatch.setattr(shard.graph, "search", lambda q, ef, start=None: list(range(ef)))  # a graph that finds nothing near
    assert (vector_dup._links(x, shard, True) == (x @ x.T >= 0.98)).all()


def test_edge_cases(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [1.0, inf], 1), (6, [nan, 1.0], 1), (7, [1.0, 1.0], None), (8, [1.0, 1.0], 1), (9, [1e300, 1e300], 1), (10, [1e-300, 1e-300], 1), (11, [1.0, 1.0, 0.0], 1), (12, [-0.0, 2.0], 2), (13, [0.0, 2.0], 2)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in found(spark, rows)}
    assert got == {k: (0, k) for k in (1, 2, 3, 4, 5, 6, 7, 11)} | {8: (2, 8), 9: (2, 8), 10: (2, 8), 12: (1, 12), 13: (1, 12)}
    without = found(spark, [(None, [1.0], 1), (3, [1.0], 1)])
    assert sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in without) == [(0, 0, None, True), (3, 0, 3, True)]
    repeated = found(spark, [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.0, 1.0], 1), (2, [1.0, 0.0], 1), (5, [0.0, 1.0], 1)])
    assert {(r.vec_id, r.component_id) for r in repeated} == {(1, 1), (2, 1), (5, 1)} and len(repeated) == 4
    assert found(spark, []) == []


def test_clashing_columns(spark):
    frame = spark.createDataFrame([(1, [1.0], 1, 5, 6), (2, [2.0], 1, 5, 6)], SCHEMA + ", rep int, n_links int")
    assert sorted(map(tuple, vector_dup.vector_duplicates(frame).collect())) == [(1, 1, 1, True), (2, 1, 1, False)]


def test_shards_of_one_label_are_spread_by_pair(spark):
    """A label that holds all vectors is no hot key: its 40 shards meet in 820 pairs, each of one or two rows."""
    shards = spark.range(40).selectExpr("'x' label", "8 dim", "int(id) shard", "binary('v') vectors")
    pairs = vector_dup._paired(shards, spark.createDataFrame([("x", 8, 40), ("y", 8, 3)], "label string, dim int, n_shards int"))
    by_pair = {(r.shard_a, r.shard_b): r["count"] for r in pairs.groupBy("label", "dim", "shard_a", "shard_b").count().collect()}
    assert by_pair == {(a, b): 1 if a == b else 2 for a in range(40) for b in range(a, 40)}
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # small tables are put into one task otherwise
    try:
        tasks = [r["count"] for r in pairs.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(tasks) == 1600 and max(tasks) < 800


def test_shards_that_got_no_vector(spark, monkeypatch):
    monkeypatch.setattr(vector_dup, "SHARD_ROWS", 1)  # some of the shard numbers stay without a vector
    rows = clusters(40)
    assert {r.vec_id: (r.n_links, r.component_id) for r in found(spark, rows)} == brute_force(rows)
