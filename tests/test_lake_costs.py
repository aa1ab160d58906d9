"""Steps of a lake's runs that cost time and disk for each row: what they must not do, and that their results stay the same."""

import re

from pyspark.sql import functions as F

from orderlake.contract import FIXTURE_CONTRACT as C
from orderlake.functions.semantics import clean_text
from orderlake.operators import silver as S
from orderlake.plans import pipeline as PL
from orderlake.sources import bronze as A

EVENTS = ("event_id long, order_id long, event_ts_txt string, state string, center string, dest_city string, carrier string, tracking_no string, "
          "promised_ts_txt string, stage_hours double, ship_cost int, incident string, note string")


def _events(spark, n=300):
    rows = [(None if i % 60 == 0 else i, i // 4 if i % 7 else None, "2024-01-01 00:00:00", "R" if i % 2 else "N", None if i % 3 == 0 else f"DC-{i}", "X", None,
             None if i % 5 else f"T{i}", None, 1.0, 1, None, None) for i in range(n)]
    return spark.createDataFrame(rows, EVENTS).repartition(4)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_recovery_builds_no_lists_of_events(spark):
    """The values of an order are taken from its sorted events."""
    typed = S.prepare_events(_events(spark), C)["typed"]
    sales = spark.range(0, 80, 2).select(F.col("id").alias("order_id"))
    once = S.flag_events(S.recover_and_fill(typed, C, valid_sales=sales), sales, C)
    assert "collect_list" not in _plan(once)
    want = S.flag_events(S.recover_and_fill(typed, C), sales, C).select(*once.columns)
    assert sorted(map(str, once.collect())) == sorted(map(str, want.collect()))


def test_hot_keys_are_counted_in_full_parts_alone(spark, monkeypatch):
    df = spark.range(1000).select(F.when(F.col("id") % 10 < 3, F.lit(-5)).when(F.col("id") % 10 < 5, F.lit(None)).otherwise(F.col("id")).alias("k"))
    for parts in (1, 4, 1 << 16):
        monkeypatch.setattr(S, "KEY_PARTS", parts)
        assert [r["_k"] for r in S.hot_keys(df, "k", 299).collect()] == [-5]
        assert S.hot_keys(df, "k", 300).count() == 0


def test_only_texts_that_it_can_change_meet_the_regular_expression(spark):
    white = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0x1C, 0x1F, 0x200B, 0xFEFF, 0x00]
    texts = [t for w in map(chr, white) for t in (w, f"a{w}b", f"{w}a", f"a{w}", f"a {w} b", f"{w}{w}", f"ñ{w}x")] + ["", " ", "  ", "a b", " a b ", "a  b", None, "São Paulo"]
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    rows = df.select(clean_text("c").alias("got"), F.trim(F.regexp_replace("c", r"(?U)\s+", " ")).alias("want")).collect()
    assert [r["got"] for r in rows] == [r["want"] for r in rows]
    assert re.search(r"CASE WHEN .*contains\(", df.select(clean_text("c").alias("got"))._jdf.queryExecution().analyzed().toString(), re.I)


def test_incidents_are_made_of_rows_that_have_some(spark):
    df = spark.range(10).select(F.col("id"), F.when(F.col("id") > 7, F.lit(None).cast("boolean")).otherwise(F.col("id") % 2 == 0).alias("a"), (F.col("id") == 4).alias("b"))
    found = S.explode_incidents(df, [(F.col(c), S.incident("s", "l", F.col("id"), F.col("id"), c, "act")) for c in ("a", "b")])
    assert sorted((r["key"], r["kind"]) for r in found.collect()) == [("0", "a"), ("2", "a"), ("4", "a"), ("4", "b"), ("6", "a")]
    assert "lambda" not in _plan(found)


def test_fingerprints_are_summed_as_whole_numbers(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("t"))
    plain = F.sum(F.xxhash64("id", "t").cast("decimal(38,0)")).cast("string")
    want = df.agg(plain.alias("h")).first()["h"]
    summed = df.agg(*A.content_fingerprint_expr(df.columns))
    assert tuple(summed.first()) == (5000, want) and int(want) == sum(r[0] for r in df.select(F.xxhash64("id", "t")).collect())
    assert tuple(df.where("id < 0").agg(*A.content_fingerprint_expr(df.columns)).first()) == (0, None)
    assert not re.search(r"cast\(xxhash64[^)]*\) as decimal", _plan(summed))


def test_silver_is_written_without_a_sort_by_outcome(spark, tmpdir_spark):
    from orderlake.session import OPEN_FILES, unsorted_writes
    before = spark.conf.get(OPEN_FILES, "0")
    with unsorted_writes(spark), unsorted_writes(spark):
        assert spark.conf.get(OPEN_FILES) == "4"
    assert spark.conf.get(OPEN_FILES) == before
    flagged = spark.range(100).select("id", F.when(F.col("id") % 3 == 0, F.lit("bad")).otherwise("").alias("reject_reason"),
                                      *[F.lit(None).cast(t).alias(c) for c, t in (("sale_ts", "timestamp"), ("rating", "int"), ("unit_price", "int"), ("gross", "int"), ("discount", "int"), ("net", "int"))])
    facts, seen_conf = {}, []
    plain = type(flagged.write).parquet

    def noted(self, *args, **kwargs):
        seen_conf.append(spark.conf.get(OPEN_FILES, "0"))
        return plain(self, *args, **kwargs)
    type(flagged.write).parquet = noted
    try:
        PL._write_checked(spark, flagged, f"{tmpdir_spark}/silver/t_checked", "r", "l", facts, "sales", ["id"], PL.Timings(), C)
    finally:
        type(flagged.write).parquet = plain
    assert seen_conf == ["4"]
    got = {r["outcome"]: r["count"] for r in spark.read.parquet(f"{tmpdir_spark}/silver/t_checked").groupBy("outcome").count().collect()}
    assert got == {"clean": 66, "rejected": 34} and facts["silver.sales"]["rows"] == 66
