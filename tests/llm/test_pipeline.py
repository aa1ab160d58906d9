from __future__ import annotations

import random

import pytest

import corpus_pipeline
from orderlake.llm import language_id, mixing, sharding
from tests.llm.test_contamination import brute_force as contaminated
from tests.llm.test_near_dup import brute_force as components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def stages(spark):
    """Each stage's rows over sf0.001, the input first."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rng = random.Random(1)
    extra = [(5_000 + k, t, "en", "s", 1) for k, t in enumerate([None, "", "123 456", "?!"])]
    more = [(6_000, " ".join(rng.choice("alpha beta gamma delta of the and in".split()) for _ in range(200)), None, None, None)]
    docs = docs.unionByName(spark.createDataFrame([*extra, *more, *more], SCHEMA))
    out = [("documents", docs.collect())]
    for name, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, sf).collect(), SCHEMA if name != "sharding" else SCHEMA + ", slot int, shard string")
        out.append((name, docs.collect()))
    return dict(out), list(dict(out))


def test_order_and_columns(stages):
    rows, names = stages
    assert names == ["documents", "language_id", "near_dedup", "decontamination", "mixing", "sharding"]
    for name in names[:-1]:
        assert not rows[name] or list(rows[name][0].asDict()) == corpus_pipeline.COLUMNS


def test_language_stage_rejects_only_rows_without_language(stages):
    rows, _ = stages
    gone = {r.doc_id for r in rows["documents"]} - {r.doc_id for r in rows["language_id"]}
    assert gone == {5_000, 5_001, 5_002, 5_003}


def test_near_dedup_keeps_one_of_each_group(stages):
    rows, _ = stages
    groups = components([(r.doc_id, r.text) for r in rows["language_id"]])
    assert sorted(r.doc_id for r in rows["near_dedup"]) == sorted(set(groups.values()))


def test_decontamination_drops_what_brute_force_finds(stages, spark):
    rows, _ = stages
    items = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text").collect()]
    bad = {int(x.split(",")[0][1:]) for x in contaminated([(r.doc_id, r.text) for r in rows["near_dedup"]], items) if x.endswith("True)")}
    assert {r.doc_id for r in rows["near_dedup"]} - {r.doc_id for r in rows["decontamination"]} == bad


def test_mixing_and_sharding_follow_their_formulas(stages, spark):
    rows, _ = stages
    before = spark.createDataFrame(rows["decontamination"], SCHEMA)
    want = sorted(r.doc_id for r in mixing.mix(before).collect())
    assert sorted(r.doc_id for r in rows["mixing"]) == want
    placed = {r.doc_id: r.shard for r in sharding.place(before).collect()}
    assert sorted((r.doc_id, r.shard) for r in rows["sharding"]) == sorted((d, placed[d]) for d in want)


def test_run_equals_the_stages(stages, spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert rows and set(rows[0].asDict()) == {*corpus_pipeline.COLUMNS, "slot", "shard"}
    assert language_id.LEAST == 0.5 and len({r.doc_id for r in rows}) > 50
