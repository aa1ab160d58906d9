from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pytest

from orderlake.llm import exact_search

SCHEMA = "vec_id long, embedding array<float>, label int"
ARROW = {"vec_id": pa.int64(), "embedding": pa.list_(pa.float32()), "label": pa.int32()}


def brute(rows, k, every):
    whole = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v, *_ in rows if v and i is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, a in {(i, tuple(v)) for i, v in whole if i % every == 0}:
        scores = sorted((-sum(x * y for x, y in zip(a, v)), i) for i, v in whole if i != q and len(v) == len(a))
        out |= {(q, rank + 1, i, -s, a) for rank, (s, i) in enumerate(scores[:k])}
    return sorted((q, rank, i, s) for q, rank, i, s, _ in out)


def found(df):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect())


def test_segment_bounds_hold_for_any_pair():
    random = np.random.default_rng(1)
    for dim in (1, 5, 16, 64, 67):
        a, b = random.integers(-500, 500, (50, dim)).astype(float), random.integers(-500, 500, (60, dim)).astype(float)
        exact = a @ b.T
        last = None
        for m in exact_search.LEVELS:
            bound = exact_search.segment_statistics(a, m) @ exact_search.segment_statistics(b, m).T
            assert (bound >= exact - 1e-6).all()
            if last is not None and dim % 64 == 0:
                assert (bound <= last + 1e-6).all()  # finer levels bound more tightly
            last = bound


def test_every_row_is_searched_by_every_query(spark):
    random = np.random.default_rng(2)
    centres = random.normal(size=(5, 24))
    rows = [(i, (centres[i % 5] + 0.2 * random.normal(size=24)).astype("float32").tolist(), i % 3) for i in range(-40, 400)]
    assert found(exact_search.top_neighbours(spark.createDataFrame(rows, SCHEMA))) == brute(rows, 20, 20)


def test_many_blocks_and_passes_give_the_same(spark, monkeypatch):
    random = np.random.default_rng(3)
    rows = [(i, random.normal(size=16).astype("float32").tolist(), 0) for i in range(300)]
    for name, value in {"PASS_BYTES": 400, "SEED_ROWS": 30}.items():
        monkeypatch.setattr(exact_search, name, value)
    df = exact_search.top_neighbours(spark.createDataFrame(rows, SCHEMA).repartition(7))
    assert found(df) == brute(rows, 20, 20)


def test_small_blocks_give_the_same_and_bounds_save_scores():
    random = np.random.default_rng(4)
    # smooth vectors: segments tell most of them, so that coarse bounds drop pairs
    ramp = np.repeat(random.normal(size=(2000, 4)), 16, axis=1)
    vectors = np.floor(64 * (ramp + 0.05 * random.normal(size=ramp.shape))).astype("<i4")
    ids = np.arange(2000)
    queries = exact_search.Rows(64, ids[::20].astype("<i8").tobytes(), vectors[::20].tobytes())
    best = exact_search.Best(queries, 5)
    for at in range(0, 2000, 300):
        best.meet(exact_search.Rows(64, ids[at : at + 300].astype("<i8").tobytes(), vectors[at : at + 300].tobytes()))
    for row, q in enumerate(range(0, 2000, 20)):
        order = sorted((-int(vectors[q].astype(int) @ vectors[i].astype(int)), i) for i in range(2000) if i != q)[:5]
        assert [(-int(s), i) for s, i in zip(best.scores[row], best.ids[row])] == order
    assert best.scored < 0.2 * best.pairs


def test_ties_go_to_smaller_ids_and_repeats_are_rows(spark):
    rows = [(i, [1.0, 0.5], 1) for i in range(60)] + [(7, [1.0, 0.5], 1), (20, [1.0, 0.5], 1), (20, [-1.0, 0.5], 1)]
    got = found(exact_search.top_neighbours(spark.createDataFrame(rows, SCHEMA)))
    assert [r[2] for r in got if r[0] == 0] == [1, 2, 3, 4, 5, 6, 7, 7, *range(8, 20)]
    assert got == brute(rows, 20, 20)


@pytest.mark.parametrize("vector", [None, [], [1.0, None], [1.0, math.nan], [1.0, math.inf]])
def test_malformed_vectors_take_no_part(spark, vector):
    rows = [(0, [1.0, 2.0], None), (1, [0.5, 2.0], 3), (20, vector, 4), (21, vector, 4), (None, [1.0, 1.0], 4), (40, [1.0, 2.0, 3.0], 4)]
    got = exact_search.top_neighbours(spark.createDataFrame(rows, SCHEMA))
    assert found(got) == [(0, 1, 1, 64 * 32 + 128 * 128)]


def test_empty_table_and_clashing_columns(spark):
    empty = exact_search.top_neighbours(spark.createDataFrame([], SCHEMA))
    assert empty.columns == ["query_id", "rank", "vec_id", "score"] and empty.count() == 0
    rows = [(0, [1.0], 9, 9, 9), (1, [3.0], 9, 9, 9)]
    clash = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int, ints int, rank int")
    assert found(exact_search.top_neighbours(clash)) == [(0, 1, 1, 64 * 192)]


def test_long_vectors_and_large_components(spark):
    rows = [(0, [1e30] * 3000, 1), (1, [0.5] * 3000, 1)]
    got = found(exact_search.top_neighbours(spark.createDataFrame(rows, SCHEMA)))
    assert got == [(0, 1, 1, 3000 * 32 * exact_search.MOST)]


def test_oracle_equals_query(spark, twin):
    random = np.random.default_rng(5)
    rows = [(i, random.normal(size=8).astype("float32").tolist(), 0) for i in range(120)] + [(500, None, 1), (501, [math.nan] * 8, 1)]
    columns, expected = twin(exact_search.ORACLE, embeddings=pa.table({n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate(ARROW.items())}))
    df = exact_search.top_neighbours(spark.createDataFrame(rows, SCHEMA))
    assert sorted(repr(tuple(r[c] for c in columns)) for r in df.collect()) == expected
