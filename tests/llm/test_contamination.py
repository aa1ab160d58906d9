from __future__ import annotations

import hashlib
import re

import pyarrow as pa
import pytest

from orderlake.llm import contamination

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain_words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_force(docs, items):
    """Each document's places of every window, looked up in the list of its own word runs."""
    split = [(item, plain_words(of)) for item, of in items]
    wanted = [(item, {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))}) for item, w in split if w]
    lengths = {len(window) for _, windows in wanted for window in windows}
    out = []
    for doc, text in docs:
        words, hit, named, places = plain_words(text), set(), set(), {}
        for n in lengths:
            for i in range(len(words) - n + 1):
                places.setdefault(tuple(words[i : i + n]), []).append(i)
        for item, windows in wanted:
            for window in windows & places.keys():
                for i in places[window]:
                    hit.update(range(i, i + len(window)))
                named.add(item)
        ids = sorted(str(i) for i in named if i is not None)
        out.append((doc, len(words), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(map(repr, out))


ITEMS = [(1, "Alpha beta, gamma delta epsilon zeta eta theta iota kappa lambda mu"), (2, "short ITEM"), (3, None), (4, "?!"), (2, "short item again"), (None, "nameless item"), (5, "x x x x x x x x x x x"), (10, "été à la plage"), (6, "short item")]
DOCS = [
    (1, "before alpha-beta gamma DELTA epsilon; zeta eta theta iota kappa lambda mu after"),
    (2, "a Short\titem, and a short item again. nameless item"),
    (3, None),
    (4, ""),
    (None, "été à la plage, ÉTÉ À LA PLAGE"),
    (5, "x " * 40_000),
    (6, "alpha beta gamma delta epsilon zeta eta theta iota"),
    (2, "clean text"),
    (2, "clean text"),
]


def frames(spark, docs=DOCS, items=ITEMS):
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("part_chars", [1_000_000, 20])
def test_edge_cases_in_one_and_many_parts(spark, part_chars):
    docs, items = frames(spark)
    got = contamination.contamination(docs, items, part_chars=part_chars).drop("spans").collect()
    short = [(d, t[:300] if t and len(t) > 1000 else t) for d, t in DOCS]
    want = brute_force(short, ITEMS)
    mine = [(*r[:1], 150, 150, *r[3:]) if r[1] == 40_000 else tuple(r) for r in got]
    assert [r[1:3] for r in got if r[1] > 1000] == [(40_000, 40_000)]
    assert sorted(map(repr, mine)) == want


def test_oracle_agrees_on_the_fixture(spark, twin):
    docs, items = frames(spark)
    as_table = lambda rows, key: pa.table({key: pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows], pa.string())})
    columns, want = twin(contamination.ORACLE, documents=as_table(DOCS, "doc_id"), benchmark=as_table(ITEMS, "item_id"))
    assert sorted(repr(tuple(r[c] for c in columns)) for r in contamination.contamination(docs, items).collect()) == want


def test_spans_point_into_the_original_text(spark):
    docs, items = frames(spark)
    row = next(r for r in contamination.contamination(docs, items).collect() if r.doc_id == 1)
    assert [DOCS[0][1][s.start : s.end] for s in row.spans] == ["alpha-beta gamma DELTA epsilon; zeta eta theta iota kappa lambda mu"]


def test_decontaminate_keeps_clean_rows_and_columns(spark):
    docs = spark.createDataFrame([(d, t, 1, "q") for d, t in DOCS], "doc_id long, text string, n_hit int, _x string")
    kept = contamination.decontaminate(docs, frames(spark)[1])
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.n_hit) for r in kept.collect()) == [(2, 1), (2, 1), (3, 1), (4, 1), (6, 1)]


def test_empty_tables(spark):
    docs, items = frames(spark)
    assert contamination.contamination(docs.limit(0), items).collect() == []
    assert not any(r.contaminated for r in contamination.contamination(docs, items.limit(0)).collect())


def test_clashing_names_keep_their_values(spark):
    docs = spark.createDataFrame([(d, t, 7, "q", 8) for d, t in DOCS], "doc_id long, text string, _hit int, _ITEMS string, __hit int")
    kept = contamination.decontaminate(docs, frames(spark)[1])
    assert kept.columns == docs.columns
    assert {(r["_hit"], r["_ITEMS"], r["__hit"]) for r in kept.collect()} == {(7, "q", 8)} and kept.count() == 5


def test_long_items_are_cut_without_losing_a_window(spark, monkeypatch):
    monkeypatch.setattr(contamination, "PIECE_WORDS", 7)
    long_item = " ".join(f"w{k}" for k in range(100))
    items = [(1, long_item), (1, long_item.upper()), (2, "w1 w2"), (3, " ".join(f"w{k}" for k in range(12)))]
    docs = [(k, " ".join(f"w{j}" for j in range(k, k + 10))) for k in range(91)] + [(99, " ".join(f"w{k}" for k in range(5, 14))), (100, long_item + " end")]
    cut = contamination._cut(frames(spark, docs, items)[1], 10)
    assert cut.filter("item_id = 1").count() == 13  # the repeated item once
    assert max(len(r.text.split()) for r in cut.collect()) == 16
    got = contamination.contamination(*frames(spark, docs, items), part_chars=60).drop("spans").collect()
    assert sorted(repr(tuple(r)) for r in got) == brute_force(docs, items)


def test_broadcasts_of_earlier_passes_are_freed(spark, monkeypatch):
    made = []
    plain = contamination._sent
    monkeypatch.setattr(contamination, "_sent", lambda items, part: made.append(plain(items, part)) or made[-1])
    docs, items = frames(spark)
    rows, _ = contamination._scanned(docs, items, 10, 20)
    freed = [not s._jbroadcast.isValid() for s in made]
    assert len(made) > contamination.PARTS_AT_ONCE and sum(freed) >= len(made) - contamination.PARTS_AT_ONCE
    assert rows.count() == len(DOCS)
