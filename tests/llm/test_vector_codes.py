from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from orderlake.llm import vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, rounds=6):
    """Every part against every entry, in plain Python."""
    kept = [(i, [math.floor(4096 * float(np.float32(x))) for x in v], label) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    width = len(kept[0][1]) // 8
    cut = [[v[p * width : (p + 1) * width] for p in range(8)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:16]] for p in range(8)]

    def nearest(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), n) for n, e in enumerate(books[p]))

    for _ in range(rounds):
        new = []
        for p in range(8):
            groups = {}
            for c in cut:
                groups.setdefault(nearest(p, c[p])[1], []).append(c[p])
            new.append([[sum(x) // len(groups[n]) for x in zip(*groups[n])] if n in groups else e for n, e in enumerate(books[p])])
        books = new
    best = [[nearest(p, c[p]) for p in range(8)] for c in cut]
    errors = [sum(d for d, _ in b) for b in best]
    by_label = {}
    for (_, _, label), e in zip(kept, errors):
        by_label[label] = by_label.get(label, 0) + e
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    return sorted(repr((i, "".join(f"{n:02x}" for _, n in b), e, by_label[label], digest)) for (i, _, label), b, e in zip(kept, best, errors))


def coded(df):
    return sorted(repr((r["vec_id"], r["code"], r["error"], r["label_error"], r["codebooks_sha256"])) for r in df.collect())


def test_codes_equal_the_plain_search(spark):
    random = np.random.default_rng(1)
    rows = [(i, random.normal(scale=0.1, size=16).astype("float32").tolist(), [None, 1, 2][i % 3]) for i in range(200)]
    rows += [(500, None, 1), (501, [1.0] * 15 + [None], 1), (502, [math.nan] * 16, None), (None, [0.1] * 16, 1)]
    rows += [rows[3], rows[3]]
    assert coded(vector_codes.compress(spark.createDataFrame(rows, SCHEMA).repartition(5))) == plain(rows)


@pytest.mark.parametrize("shift", [0, 3, 6, 9, 14])
def test_grid_finds_the_nearest_entry_for_any_cell_size(shift):
    random = np.random.default_rng(2)
    book = random.integers(-300, 300, (16, 4))
    book[5] = book[2]  # equal entries: the lower one wins
    parts = np.r_[random.integers(-400, 400, (500, 4)), book]
    grid = vector_codes.Grid(book, shift)
    codes, least = grid.nearest(parts)
    distances = ((parts[:, None] - book[None]) ** 2).sum(axis=2)
    assert (codes == distances.argmin(axis=1)).all() and (least == distances.min(axis=1)).all()
    if shift == 6:
        assert grid.evaluated < 0.7 * distances.size


def test_cells_are_remembered_within_a_bound(monkeypatch):
    random = np.random.default_rng(3)
    grid = vector_codes.Grid(random.integers(-300, 300, (16, 4)), 6)
    parts = random.integers(-400, 400, (300, 4))
    grid.nearest(parts)
    known = len(grid.cells)
    monkeypatch.setattr(grid, "undominated", None)  # a known cell is not computed again
    grid.nearest(parts[:100])
    monkeypatch.undo()
    monkeypatch.setattr(vector_codes, "MOST_CELLS", 10)
    codes, _ = grid.nearest(parts[:5])
    assert len(grid.cells) <= 10 < known
    assert (codes == ((parts[:5, None] - grid.codebook[None]) ** 2).sum(axis=2).argmin(axis=1)).all()


def test_few_rows_ties_and_unused_entries(spark):
    rows = [(i, [0.25] * 8, 1) for i in range(10)] + [(20 + i, [0.5 + i] * 8, None) for i in range(3)]
    assert coded(vector_codes.compress(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


def test_other_lengths_go_and_short_parts_are_filled(spark):
    rows = [(1, [0.1] * 10, 1), (2, [0.3] * 10, 1), (3, [0.3] * 8, 1), (4, [], 1)]
    got = vector_codes.compress(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [r["vec_id"] for r in sorted(got)] == [1, 2] and all(len(r["code"]) == 16 and r["error"] == 0 for r in got)


def test_empty_table_large_components_and_extra_columns(spark):
    empty = vector_codes.compress(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and empty.columns[:5] == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    rows = [(i, [1e30 * (-1) ** i] * 8, 1, "c", 5, 6) for i in range(20)]
    got = vector_codes.compress(spark.createDataFrame(rows, f"{SCHEMA}, code string, ints int, error int")).collect()
    assert len(got) == 20 and {r["error"] for r in got} == {0}


def test_hot_label_sums_once(spark):
    random = np.random.default_rng(6)
    rows = [(i, random.normal(size=8).astype("float32").tolist(), 1 if i % 3 else None) for i in range(120)]
    assert coded(vector_codes.compress(spark.createDataFrame(rows, SCHEMA))) == plain(rows)
