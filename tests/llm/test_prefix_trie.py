from __future__ import annotations

import hashlib
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orderlake.functions.ranking import numbered, running
from orderlake.llm import prefix_trie
from orderlake.llm.common import land

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    """Prefixes as tuples, node by node."""
    convs = {}
    for c, t, role, text in rows:
        if c is not None:
            key = hashlib.md5(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest()
            convs.setdefault(c, []).append((t is not None, t or 0, role or "", key, text or ""))
    convs = {c: [(r, text) for _, _, r, _, text in sorted(ts)] for c, ts in convs.items()}
    rebuilt = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        rebuilt[c] = tuple(convs.get(base, [])[:h] + own[h:])
    nodes = {}
    for c, ts in rebuilt.items():
        for d in range(len(ts) + 1):
            nodes.setdefault(ts[:d], []).append(c)
    children = {}
    for p in nodes:
        if p:
            children.setdefault(p[:-1], []).append(p)
    leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for p, members in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(members) - 1) * len(p[-1][1]) if p else 0
    out = []
    for p, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if rebuilt[c] == p)
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(children.get(p, [])), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(map(repr, out))


NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def found(df):
    return sorted(repr(tuple(r[c] for c in NAMES)) for r in df.collect())


CASES = {
    "shared heads and copies": [(c, t, "user" if t % 2 else "bot", f"text {t if c % 3 else c} é") for c in range(0, 230) for t in range(c % 9 + 1)],
    "turnless, no first one": [(c, 0, "a", "x") for c in (105, 107, 199, 1203, 55)],
    "nulls and ties": [(1, None, None, None), (1, 1, "b", "z"), (1, 1, "a", None), (None, 1, "a", "b"), (0, None, "a", ""), (0, 1, None, "q"), (-7, 1, "a", "b"), (-100, 2, "", "r")],
    "repeated rows": [(c, 1, "a", "same") for c in (0, 0, 0, 5, 5, 5, 5, 5, 5, 5, 8)],
    "one family of copies": [(c, t, "a", f"t{t}") for c in range(300, 400) for t in range(7)],
    "proper prefixes": [(c, t, "a", f"t{t}") for c in range(600, 640) for t in range(6 + c % 5)],
    "role and text don't mix": [(0, 0, "ab", "c"), (100, 0, "a", "bc"), (200, 0, "", "abc")],
    "empty": [],
}


@pytest.mark.parametrize("case", CASES)
def test_nodes_equal_the_plain_trie(spark, case):
    assert found(prefix_trie.trie(spark.createDataFrame(CASES[case], SCHEMA))) == plain(CASES[case])


def test_very_long_conversation_and_text(spark):
    rows = [(c, t, "a", "y" * 100_000 if t == 3 else f"t{t}") for c in (4, 7) for t in range(9_000)] + [(9, 0, "a", "b")]
    got = prefix_trie.trie(spark.createDataFrame(rows, SCHEMA))
    root = got.filter("depth = 0").first()
    assert (root["n_convs"], root["n_leaves"]) == (3, got.filter("n_children = 0").count())
    tails = {c: tuple(range(zlib.crc32(str(c).encode()) % 6, 9_000)) for c in (4, 7)}
    assert got.count() == 1 + sum(len(t) for t in tails.values()) + max(0, 1 - zlib.crc32(b"9") % 6) - (len(tails[4]) if tails[4] == tails[7] else 0)


def test_extra_columns_are_ignored(spark):
    rows = CASES["shared heads and copies"][:300]
    clash = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], f"{SCHEMA}, depth int, k1 int, r int, _range int")
    assert found(prefix_trie.trie(clash)) == plain(rows)


def test_oracle_equals_query(spark, twin):
    rows = [r for name in ("shared heads and copies", "turnless, no first one", "proper prefixes") for r in CASES[name]]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string()]
    columns, expected = twin(prefix_trie.ORACLE, conversations=pa.table({n: pa.array(c, t) for n, c, t in zip(["conv_id", "turn", "role", "text"], zip(*rows), types)}))
    df = prefix_trie.trie(spark.createDataFrame(rows, SCHEMA))
    assert sorted(repr(tuple(r[c] for c in columns)) for r in df.collect()) == expected


def test_numbers_and_running_totals_of_a_hot_group(spark):
    """One group of 3,000 of 4,000 rows, over several ranges and pieces."""
    df = spark.range(4000).select(F.when(F.col("id") < 3000, 1).otherwise(F.col("id")).alias("g"), (F.col("id") * 7919 % 4001).alias("v"))
    got = numbered(df, ["g"], [F.col("v").desc()], land, "n")
    rows = got.collect()
    order = [r["n"] for r in sorted((r for r in rows if r["g"] == 1), key=lambda r: -r["v"])]
    assert order == list(range(1, 3001)) and {r["n"] for r in rows if r["g"] != 1} == {1} and len(rows) == 4000
    for backwards in (False, True):
        sums = running(got.select("g", "n", "v"), "g", "n", {"v": F.sum}, lambda a, b: a + b, backwards, piece=100)
        values = [r["v"] for r in sorted((r for r in rows if r["g"] == 1), key=lambda r: r["n"])]
        expected = [sum(values[i:]) if backwards else sum(values[: i + 1]) for i in range(3000)]
        assert [r["v"] for r in sorted((r for r in sums.collect() if r["g"] == 1), key=lambda r: r["n"])] == expected
