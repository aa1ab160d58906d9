from __future__ import annotations

import math
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orderlake.llm import mixing, sharding

ROWS = [(k, f"text {k}", "en", ("a", "b", None)[k % 3 if k % 7 else 0], 6) for k in range(300)]
ROWS += [(None, "no id", "en", "a", 5), (None, None, None, None, None), (5, "text 5", "en", "c", 6), (5, "text 5", "en", "c", 6), (6, "", "en", "c", 0), (7, "w " * 50_000, "en", "c", 100_000)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, SCHEMA)


def arrow_table():
    columns = list(zip(*ROWS))
    return pa.table({name: pa.array(column, kind) for name, column, kind in zip(("doc_id", "text", "lang", "source", "n_chars"), columns, (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()))})


def rows(df, columns):
    return sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())


def test_mixing_oracle_agrees_on_the_fixture(spark, twin):
    columns, want = twin(mixing.ORACLE, documents=arrow_table())
    assert rows(mixing.mix(frame(spark)), columns) == want and len(want) > 100


def test_placement_oracle_agrees_on_the_fixture(spark, twin):
    columns, want = twin(sharding.ORACLE, documents=arrow_table())
    assert rows(sharding.place(frame(spark)), columns) == want and len(want) == len(ROWS)


def test_copies_follow_the_poisson_distribution(spark):
    docs = spark.range(60_000).selectExpr("id as doc_id", "'t' as text", "if(id % 3 = 0, 'x', 'y') as source")
    mixed = mixing.mix(docs, weights={"x": 3.0, "y": 1.0}, target_rows=80_000)
    counts = {r.source: (r.n, r.two) for r in mixed.groupBy("source").agg(F.count("*").alias("n"), F.sum((F.col("n_copies") == 2).cast("int")).alias("two")).collect()}
    for source, n_docs, want in (("x", 20_000, 60_000), ("y", 40_000, 20_000)):
        rate = want / n_docs
        assert abs(counts[source][0] - want) < 5 * math.sqrt(want)
        assert abs(counts[source][1] / 2 - n_docs * math.exp(-rate) * rate**2 / 2) < 5 * math.sqrt(n_docs * 0.25)


def test_large_rates_and_zero_weights(spark):
    docs = spark.range(40).selectExpr("id as doc_id", "'t' as text", "if(id < 20, 'x', 'y') as source")
    mixed = mixing.mix(docs, weights={"x": 1.0, "y": 0.0}, target_rows=20 * 900)
    counts = [r["count"] for r in mixed.groupBy("doc_id").count().collect()]
    assert len(counts) == 20 and all(abs(c - 900) < 5 * 30 for c in counts)


def test_mixing_is_repeatable_shuffled_and_native(spark):
    mixed = mixing.mix(frame(spark))
    again = mixing.mix(frame(spark).repartition(7, "text"))
    assert rows(mixed, mixed.columns) == rows(again, mixed.columns)
    for part in mixed.select(F.spark_partition_id().alias("p"), "shuffle_key").groupBy("p").agg(F.collect_list("shuffle_key").alias("keys")).collect():
        assert part["keys"] == sorted(part["keys"])
    for df in (mixed, sharding.place(frame(spark))):
        assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", df._jdf.queryExecution().executedPlan().toString())


def test_empty_and_clashing(spark):
    none = frame(spark, [])
    assert mixing.mix(none).collect() == [] and sharding.place(none).collect() == []
    wide = frame(spark).selectExpr("*", "1 as copy", "2 as slot", "3 as shard", "4 as n_copies", "5 as rate")
    assert mixing.mix(wide).count() == mixing.mix(frame(spark)).count()
    assert {r.shard for r in sharding.place(wide).select("shard").distinct().collect()} <= set(sharding.SHARDS)


def plain_table(shards, slots):
    import hashlib

    number = lambda s: int(hashlib.md5(s.encode()).hexdigest()[:13], 16)
    owner, turn = {}, 0
    following = [0] * len(shards)
    while len(owner) < slots:
        i = turn % len(shards)
        while True:
            slot = (number("offset:" + shards[i]) % slots + following[i] * (number("skip:" + shards[i]) % (slots - 1) + 1)) % slots
            following[i] += 1
            if slot not in owner:
                owner[slot] = shards[i]
                break
        turn += 1
    return owner


@pytest.mark.parametrize(("n", "slots"), [(1, 2), (5, 101), (16, 2053)])
def test_lookup_table_is_filled_by_turns(spark, n, slots):
    shards = [f"shard-{i:02d}" for i in range(n)]
    table = {r.slot: r.shard for r in sharding.lookup_table(spark, shards, slots).collect()}
    assert table == plain_table(shards, slots)
    sizes = [list(table.values()).count(s) for s in shards]
    assert max(sizes) - min(sizes) <= 1


def test_losing_a_shard_moves_little(spark):
    before, after = (plain_table([f"shard-{i:02d}" for i in range(16) if i != gone], 2053) for gone in (None, 3))
    moved = sum(before[s] != after[s] for s in before if before[s] != "shard-03")
    assert moved < 0.15 * 2053


def test_bad_parameters_and_written_shards(spark, tmp_path):
    for shards, slots in (([], 101), (["a", "a"], 101), (["a"], 100), (["a"], 1_000_003)):
        with pytest.raises(ValueError):
            sharding.lookup_table(spark, shards, slots)
    placed = sharding.place(frame(spark))
    sharding.write_shards(placed, str(tmp_path / "shards"))
    assert rows(spark.read.parquet(str(tmp_path / "shards")), placed.columns) == rows(placed, placed.columns)


def test_columns_named_like_those_used_inside_are_carried(spark):
    names = ["_key", "_source", "_steps", "_fraction", "__key", "_SOURCE2"]
    plain = frame(spark)
    extra = plain.select("*", *[F.lit(f"own {c}").alias(c) for c in names])
    mixed = mixing.mix(extra)
    assert mixed.columns == [*plain.columns, *names, "n_copies", "copy", "shuffle_key"]
    assert rows(mixed, mixing.mix(plain).columns) == rows(mixing.mix(plain), mixing.mix(plain).columns)
    assert [tuple(r) for r in mixed.select(*names).distinct().collect()] == [tuple(f"own {c}" for c in names)]
