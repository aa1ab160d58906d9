from __future__ import annotations

import re

import pyarrow as pa

from orderlake.llm import licenses

ROWS = [
    (1, "Released under the MIT License."),
    (2, "x Apache   License, Version 2.0; CC BY-NC 4.0 and cc by nc"),
    (3, None),
    (4, ""),
    (5, "the mit"),
    (6, "This work is licensed under the GNU General Public License, version 3."),
    (7, "permission is hereby granted, free of any charge, to any person obtaining a copy of this software and associated documentation files"),
    (7, "under the mit license under the mit license"),
    (7, "under the mit license under the mit license"),
    (None, "cc by nc"),
    (8, "cc by nc " * 9000),
    (9, "UNDER THE MIT LİCENSE under the mit licenseé under-the\nmit_license"),
    (10, "licensed under the general public license version"),
]


def frame(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string")


def plain(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    places, labels = [], set()
    for phrase, label in licenses.BASE:
        p = phrase.split()
        own = [i for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
        places += own
        labels |= {label} if own else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_base_columns_match_plain_search(spark, table):
    rows = [*table("documents", "doc_id", "text"), *[(-k, t) for k, (_, t) in enumerate(ROWS)]]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(repr, ((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got))) == sorted(map(repr, ((d, *plain(t)) for d, t in rows)))


def test_oracle_agrees_on_the_fixture(spark, twin):
    columns, want = twin(licenses.ORACLE, documents=pa.table({"doc_id": pa.array([r[0] for r in ROWS], pa.int64()), "text": pa.array([r[1] for r in ROWS])}))
    assert sorted(repr(tuple(r[c] for c in columns)) for r in licenses.scan(frame(spark)).collect()) == want


def test_own_labels_and_scores(spark):
    by = {r.doc_id: r for r in licenses.scan(frame(spark)).collect()}
    assert (by[6].base_labels, by[6].labels, by[6].score) == ("", "gpl-3", 1.0)
    assert (by[2].labels, by[2].score) == ("apache-2,cc-by-nc", 1.0)
    assert (by[3].labels, by[3].score, by[4].n_words) == ("", 0.0, 0)
    near = next(r for r in licenses.scan(frame(spark).filter("text like 'permission%'")).collect())
    n = len(licenses.TEMPLATES[0][0].split())
    assert (near.labels, near.n_base, near.score) == ("mit", 0, n / (n + 1))  # a word put in: two diagonals cover the template
    words = licenses.TEMPLATES[0][0].split()
    parts = [(n, "x " + " ".join(words[:n]) + " y") for n in (len(words), 15, 13)]
    cut = {r.doc_id: (r.labels, r.score) for r in licenses.scan(spark.createDataFrame(parts, "doc_id long, text string")).collect()}
    assert cut == {len(words): ("mit", 1.0), 15: ("mit", 15 / len(words)), 13: ("", 0.0)}
    assert by[8].n_base == 9000 and by[8].last_word == 3 * 8999


def test_no_python_and_one_scan_join(spark):
    plan = licenses.scan(frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)


def test_empty_and_clashing(spark):
    assert licenses.scan(frame(spark).limit(0)).collect() == []
    wide = frame(spark).selectExpr("*", "1 as place", "'x' as gram", "2 as words", "3 as text_hash", "4 as labels")
    assert sorted(map(repr, licenses.scan(wide).collect())) == sorted(map(repr, licenses.scan(frame(spark)).collect()))


def labels_of(spark, texts):
    got = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    return [r.labels for r in sorted(got, key=lambda r: r.doc_id)]


def test_one_replaced_word_keeps_the_label_unless_it_is_the_key(spark):
    texts, want = [], []
    for phrase, label, keys in licenses.TEMPLATES:
        words = phrase.split()
        key_places = {i for places in licenses._key_places(phrase, keys) for i in places}
        for at in range(len(words)):
            texts.append("notes " + " ".join([*words[:at], "xyzzy", *words[at + 1 :]]) + " end")
            want.append(None if at in key_places else label)
    for text, label, found in zip(texts, want, labels_of(spark, texts)):
        assert label in found.split(",") if label else text and found == "", (text, found)


def test_look_alike_templates_are_told_apart(spark):
    texts = [p for p, _, _ in licenses.TEMPLATES]
    assert labels_of(spark, texts) == [label for _, label, _ in licenses.TEMPLATES]
    others = {
        "licensed under the Creative Commons Attribution-ShareAlike License": "cc-by-sa",
        "licensed under a Creative Commons Attribution License": "",
        "licensed under a Creative Commons Attribution-NonCommercial-ShareAlike License": "cc-by-nc",  # two words after one put in are no k-gram
        "the license version 2 of this file": "",
        "under the terms of the GNU General Public License": "",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License": "lgpl",
        "licensed under the GNU General Public License, version 2": "",
        "licensed under the GNU Lesser General Public License version 3": "",
        "licensed under a creative commons attribution sharealike license, or licensed under a creative commons attribution noncommercial license": "cc-by-nc,cc-by-sa",
    }
    assert labels_of(spark, list(others)) == list(others.values())


def test_very_long_and_repeated_rows(spark):
    phrase = licenses.TEMPLATES[9][0]
    text = "word " * 300_000 + phrase + " under the mit license " + "other " * 300_000
    rows = spark.createDataFrame([(1, text), (1, text), (2, phrase), (2, phrase)], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_words, r.labels, r.first_word) for r in licenses.scan(rows).collect())
    assert got == [(1, 600_012, "cc-by-sa,mit", 300_008)] * 2 + [(2, 8, "cc-by-sa", None)] * 2


def test_oracle_agrees_on_changed_templates(spark, twin):
    texts = []
    for phrase, _, _ in licenses.TEMPLATES:
        words = phrase.split()
        texts += [" ".join([*words[:at], "of", *words[at + step :]]) for at in range(0, len(words), 2) for step in (0, 1, 2)]
    both = [(i, f"{a} and {b}") for i, (a, b) in enumerate(zip(texts, texts[3:] + texts[:3]))]
    columns, want = twin(licenses.ORACLE, documents=pa.table({"doc_id": pa.array([r[0] for r in both], pa.int64()), "text": pa.array([r[1] for r in both])}))
    got = licenses.scan(spark.createDataFrame(both, "doc_id long, text string"))
    assert sorted(repr(tuple(r[c] for c in columns)) for r in got.collect()) == want
