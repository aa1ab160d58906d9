from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from orderlake.llm import near_dup, shingles
from orderlake.llm.components import connected_components


def plain_set(text):
    words = bytes(text or "", "utf-8").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_force(rows):
    """doc_id -> component by comparing all pairs that share a shingle."""
    sets = [(d, plain_set(t)) for d, t in rows if d is not None]
    parent = {d: d for d, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    having = defaultdict(list)
    common = defaultdict(int)
    for k, (_, s) in enumerate(sets):
        for g in s:
            for other in having[g]:
                common[other, k] += 1
            having[g].append(k)
    for (a, b), n in common.items():
        if 100 * n >= 75 * (len(sets[a][1]) + len(sets[b][1]) - n):
            x, y = sorted((root(sets[a][0]), root(sets[b][0])))
            parent[y] = x
    return {d: root(d) for d in parent}


def near_copies(n, seed=3):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    base = [rng.choice(words) for _ in range(300)]
    rows = []
    for k in range(n):
        text = list(base)
        for _ in range(rng.randint(0, 14)):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((k * 7 + 1, " ".join(text)))
    return rows


def found(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    return [r.asDict() for r in near_dup.near_duplicates(frame).collect()]


def test_shingle_sets_match_plain_sets():
    texts = ["a b c d e f", "A B  c\nd e F", "a b", "", None, "x" * 5000 + " é É b c d e f g", "\x0b\x0c a\x1cb", "a b c d e a b c d e a b"]
    sets = [s for part, _ in shingles.shingle_sets(pa.array(texts)) for s in part]
    assert [len(s) for s in sets] == [len(plain_set(t)) for t in texts]
    assert (sets[0] == sets[1]).all()
    sliced = [s for part, _ in shingles.shingle_sets(pa.array(texts).slice(2, 4)) for s in part]
    assert [s.tolist() for s in sliced] == [s.tolist() for s in sets[2:6]]


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(1)
    a, b = (np.unique(rng.integers(0, 1 << 63, 400, dtype=np.uint64)) for _ in range(2))
    x, y, both = near_dup.registers([a, b, np.union1d(a, b)])
    assert (near_dup.merge_registers(x, y) == both).all()
    c = np.concatenate((a[:390], b[:10]))
    regs = near_dup.registers([a, np.sort(c), b])
    assert near_dup.likely_similar(regs[0], len(a), regs[1:], np.array([len(c), len(b)]), 0.75).tolist() == [True, False]


def test_matches_brute_force_on_documents(spark, table):
    rows = table("documents", "doc_id", "text")
    want = brute_force(rows)
    got = found(spark, rows)
    texts = dict(rows)
    assert len(got) == len(rows)
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert all(r["n_shingles"] == len(plain_set(texts[r["doc_id"]])) and r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


@pytest.mark.parametrize("block", [512, 16])
def test_large_group_of_near_copies_in_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(near_dup, "BLOCK_ROWS", block)
    rows = near_copies(120) + [(10_000 + k, t) for k, t in enumerate(["all the same words here again"] * 60)]
    assert {r["doc_id"]: r["component_id"] for r in found(spark, rows)} == brute_force(rows)


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "two words"), (5, "TWO   words"), (None, "two words"), (6, "other text"), (6, "two words"), (7, "other text"), (9, "x " * 30_000), (8, "x " * 30_001), (8, "x " * 30_001)]
    got = found(spark, rows)
    assert len(got) == len(rows)
    assert {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] in (1, 2, 3)} == {1: 1, 2: 2, 3: 3}
    assert {r["component_id"] for r in got if r["doc_id"] in (4, 5, 6, 7)} == {4}
    assert {r["component_id"] for r in got if r["doc_id"] in (8, 9)} == {8}
    assert [r for r in got if r["doc_id"] is None] == [{"doc_id": None, "n_shingles": 1, "component_id": 4, "kept": True}] or [r["kept"] for r in got if r["doc_id"] is None] == [True]
    assert found(spark, []) == []


def test_clashing_columns(spark):
    frame = spark.createDataFrame([(1, "a b", 2, 3, "q"), (2, "a b", 2, 3, "q")], "doc_id long, text string, rep long, component long, band string")
    assert sorted((r.doc_id, r.component_id, r.kept) for r in near_dup.near_duplicates(frame).collect()) == [(1, 1, True), (2, 1, False)]


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(200, 200), (None, 4), (301, 300), (300, 301)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(41)} | {100 + k: 100 for k in range(30)} | {300: 300, 301: 300}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_stray_in_a_large_band_meets_each_member_once(spark):
    """Members of a band's largest component aren't set against each other again."""
    n = 20_000
    rows = spark.range(n + 1).selectExpr("7L band", "3 band_no", "id doc_id", "100L n_shingles", f"if(id = {n}, {n}L, 0L) component")
    met = near_dup._opposed(rows)
    blocks = -(-n // near_dup.BLOCK_ROWS)
    assert met.count() == n + 1 + blocks
    assert met.groupBy("i", "j").count().agg({"count": "max"}).first()[0] < 2 * near_dup.BLOCK_ROWS
    sides = met.selectExpr("i", "j", "doc_id", f"doc_id = {n} stray")
    together = sides.filter("stray").alias("s").join(sides.filter("not stray").alias("o"), ["i", "j"]).selectExpr("o.doc_id")
    assert together.count() == together.distinct().count() == n


def test_all_pairs_of_different_components_meet_once(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK_ROWS", 4)
    rows = [(band, 0, d, 50, c) for band, parts in ((1, [9, 5, 5, 1]), (2, [3]), (3, [1, 1, 1, 1, 1, 1]), (4, [30, 1])) for d, c in enumerate([c for c, k in enumerate(parts) for _ in range(k)])]
    met = defaultdict(list)
    for r in near_dup._opposed(spark.createDataFrame(rows, "band long, band_no int, doc_id long, n_shingles long, component long")).collect():
        met[r.band, r.i, r.j].append((r.doc_id, r.component, r.block))
    pairs = [(band, *sorted((a[0], b[0]))) for (band, i, j), of in met.items() for k, a in enumerate(of) for b in of[:k] if a[1] != b[1] and (a[2] != b[2] or i == j)]
    want = {(x[0], *sorted((x[2], y[2]))) for x in rows for y in rows if x[0] == y[0] and x[4] != y[4]}
    assert len(pairs) == len(set(pairs)) and set(pairs) == want


def test_shingles_of_many_texts_take_bounded_memory():
    """Eight MB of texts are hashed by segments: the arrays of one are small, however many texts there are."""
    import tracemalloc

    import pyarrow as pa

    from orderlake.llm import shingles

    texts = pa.array([f"text {k} of some words that go on " * 60 for k in range(4000)])
    list(shingles.shingle_sets(texts.slice(0, 10)))
    tracemalloc.start()
    for sets, _ in shingles.shingle_sets(texts):
        del sets
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 12e6
