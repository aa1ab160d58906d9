"""Arrival order decides between copies; empty, constant and odd inputs give a defined result."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlake.contract import Contract
from orderlake.functions import quantiles as exact
from orderlake.functions.quantiles import group_quantiles, quantiles
from orderlake.operators import checks as B
from orderlake.operators import gold as G
from orderlake.operators import profile as P
from orderlake.operators import questions as Q
from orderlake.operators import silver as S

SALE = ("sale_id long, order_id long, sale_ts string, customer_id long, city string, channel string, store_id string, category string, "
        "product string, pay_method string, quantity int, unit_price decimal(18,2), discount_rate decimal(5,2), gross decimal(18,2), "
        "discount decimal(18,2), net decimal(18,2), rating int")
EVENT = ("event_id long, order_id long, event_ts_txt string, state string, center string, dest_city string, carrier string, "
         "tracking_no string, promised_ts_txt string, stage_hours double, ship_cost int, incident string, note string")
CONTRACT = Contract(coverage=("Lima",))


def _sale(sale_id, order_id, pay="m", rating=3):
    ten, zero = D("10.00"), D("0.00")
    return (sale_id, order_id, "2024-01-02", 1, "Lima", "BUILDING", None, "c", "p", pay, 1, ten, zero, ten, zero, ten, rating)


def _event(event_id, center="DC", note=None):
    return (event_id, 5, None, "N", center, "Lima", None, None, None, 1.0, 9, None, note)


def test_first_sale_to_arrive_stays(spark):
    rows = [(*_sale(1, 1, "z"), 0), (*_sale(1, 2, "a"), 1), (*_sale(3, 1, "b"), 2)]
    flagged = S.flag_sales(spark.createDataFrame(rows, SALE + ", _arrival long"), CONTRACT)
    assert "_arrival" not in flagged.columns
    got = {r["pay_method"]: r["reject_reason"] for r in flagged.collect()}
    assert got == {"z": "", "a": "id_venta repetido", "b": "pedido_id repetido"}


def test_exact_copies_are_copies_whenever_they_arrive(spark):
    rows = [(*_event(1), 4), (*_event(1), 2), (*_event(2), 3)]
    ev = spark.createDataFrame(rows, EVENT + ", _arrival long")
    assert sorted((r["event_id"], r["_arrival"]) for r in S.dedup_exact(ev).collect()) == [(1, 2), (2, 3)]
    prepared = S.prepared_events(ev).collect()
    assert sorted((r["event_id"], r["_n"], r["_win"]) for r in prepared) == [(1, 2, True), (2, 1, True)]
    assert S.duplicate_row_incidents(ev).count() == 1


def test_of_versions_as_complete_the_first_to_arrive_wins(spark):
    rows = [(*_event(1, "AA"), 9), (*_event(1, "ZZ"), 1), (*_event(1, None, "n"), 0), (*_event(1, None, None), 5)]
    ev = spark.createDataFrame(rows, EVENT + ", _arrival long")
    winner = S.prepared_events(ev).where("_win").first()
    kept, incidents = S.resolve_key_conflicts(ev)
    assert (winner["center"], winner["note"]) == (None, "n") and kept.first()["note"] == "n" and incidents.count() == 3


def test_copies_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(S, "COPIES_AT_ONCE", 4)
    df = spark.createDataFrame([(1, 1), (2, 2), (3, 5), (4, 6), (5, 23)], "event_id long, _n long")
    assert {r["event_id"]: r["count"] for r in S.copies(df, "_n").groupBy("event_id").count().collect()} == {2: 1, 3: 4, 4: 5, 5: 22}


def test_nan_rating_is_no_rating(spark):
    df = S.coerce_rating(spark.createDataFrame([(float("nan"),), (3.0,), (2.5,), (None,)], "rating double"))
    assert [tuple(r) for r in df.select("rating", "_rating_fractional").collect()] == [(None, False), (3, False), (2, True), (None, False)]


@pytest.mark.parametrize("values", [[1.0], [2.0, 2.0, 2.0], [5.0, 1.0, 3.0, 3.0, None], np.random.default_rng(1).exponential(size=3000).tolist(), [-1e9, 0.0, 1.0, 2.0, 3.0, 1e9]])
def test_quantiles_are_exact(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = tuple(quantiles(df, F.col("x"), probs).first())
    assert np.allclose(got, np.quantile([v for v in values if v is not None], probs), rtol=1e-12)


def test_only_values_near_the_ranks_are_ordered(spark, monkeypatch):
    """Also with far outliers, which would put all other values into one bin of equal width."""
    for name, to in (("ACCURACY", 500), ("MARGIN", 3 / 500), ("SMALL_GROUP", 2000)):
        monkeypatch.setattr(exact, name, to)
    values = [*np.random.default_rng(2).normal(size=20_000).round(3).tolist(), 1e300, -1e300, *[0.5] * 3000]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", float(k)) for k in range(7)], "g string, x double").repartition(7)
    probs = [0.0, 0.25, 0.5, 0.6, 0.99, 1.0]
    got = {r["g"]: tuple(r)[1:] for r in group_quantiles(df, ["g"], F.col("x"), probs).collect()}
    assert np.allclose(got["a"], np.quantile(values, probs), rtol=1e-12) and np.allclose(got["b"], np.quantile(range(7), probs), rtol=1e-12)
    near, _ = exact._bracketed(df.where("g = 'a'").selectExpr("g _k0", "x _x"), ["_k0"], probs)
    assert max(r["count"] for r in near.groupBy("_i").count().collect()) < 0.1 * len(set(values))


def test_group_quantiles_keep_null_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), (None, 7.0), ("b", None)], "g string, x double")
    assert {r["g"]: r["q0"] for r in group_quantiles(df, ["g"], F.col("x"), [0.5]).collect()} == {"a": 1.5, None: 7.0}


def test_questions_on_empty_and_zero_totals(spark):
    empty = spark.createDataFrame([], SALE)
    zero = spark.createDataFrame([_sale(1, 1)], SALE).withColumns({"net": F.lit(0).cast("decimal(18,2)"), "gross": F.lit(0).cast("decimal(18,2)")})
    for ask in (Q.net_by_channel, Q.recurrence_kpis, Q.discount_share, Q.concentration_top3, Q.top_products, Q.channel_transaction_share,
                Q.net_skew, Q.rating_high_share, Q.payment_channel):
        ask(empty).collect()
        ask(zero).collect()
    assert Q.net_by_channel(zero).first()["share_pct"] is None


def test_checks_without_numeric_or_residual_columns(spark):
    words = spark.createDataFrame([("a",)], "city string")
    assert tuple(B.negatives(words, words).first()) == (0, 0, 0)
    assert B.residual_columns(words).collect() == [] and B.residual_values(words).collect() == []


def test_histogram_of_a_constant_column(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (None,)], "net double")
    assert [tuple(r) for r in P.histogram(df, "net", 20).collect()] == [(0, 2, 5.0, 5.0)]
    assert P.boxplot(df, "net").first()["outliers"] == 0


def test_payment_channels_come_from_the_data(spark):
    sales = spark.createDataFrame([_sale(1, 1), _sale(2, 2)], SALE).withColumn("channel", F.lit("never seen"))
    assert [tuple(r) for r in Q.payment_channel(sales).collect()] == [("m", "never seen", 2)]


def test_all_values_are_listed(spark):
    sales = spark.range(300).selectExpr("cast(id as string) as city")
    assert P.categorical_values(sales, "sales").count() == 300


def test_out_of_order_across_blocks_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(int(o), int(e), str(dt.datetime(2024, 1, 1) + dt.timedelta(hours=int(h)))) for o in range(40)
            for e, h in zip(rng.choice(60, 6, replace=False), np.sort(rng.integers(0, 50, 6)) if o % 2 else rng.integers(0, 50, 6))]
    bad = 0
    for o in range(40):
        mine = sorted((e, t) for k, e, t in rows if k == o)
        bad += any(b < a for (_, a), (_, b) in zip(mine, mine[1:]))
    ev = spark.createDataFrame(rows, "order_id long, event_id long, event_ts_txt string")
    assert [B.out_of_order(ev, block).first()[0] for block in (1, 7, 4096)] == [bad] * 3


def test_one_order_of_sparse_ids_is_cut_into_blocks(spark, monkeypatch):
    """30,000 events of one order with ids far apart: no block of the comparison holds more than its size."""
    n, block = 30_000, 500
    rows = spark.range(n).selectExpr("1L as order_id", "id * 1000003 as event_id", "cast(timestamp'2024-01-01' + make_interval(0,0,0,0,0,id) as string) as event_ts_txt")
    one_back = rows.withColumn("event_ts_txt", F.when(F.col("event_id") == 1000003 * 20_000, "2023-12-31 00:00:00").otherwise(F.col("event_ts_txt")))
    sizes, compare = [], B.blocks_out_of_order

    def watched(cut):
        sizes.append(cut.groupBy("order_id", "_block").count().agg(F.max("count"), F.count("*")).first())
        return compare(cut)
    monkeypatch.setattr(B, "blocks_out_of_order", watched)
    assert [B.out_of_order(df, block).first()[0] for df in (rows, one_back)] == [0, 1]
    assert sizes == [(block, n // block)] * 2


def test_spelling_variants_fold_accents_if_asked(spark):
    df = spark.createDataFrame([("Bogotá",), ("bogota",), ("BOGOTÁ ",), ("Lima",), (None,)], "city string")
    plain = P.standardize_impact(df, "t", ["city"]).first()
    folded = P.standardize_impact(df, "t", ["city"], fold_accents=True)
    assert (plain["changed_cells"], plain["distinct_raw"], plain["distinct_clean_lower"], plain["has_variants"]) == (1, 4, 3, True)
    assert folded.first()["distinct_clean_lower"] == 2
    assert "Expand" not in folded._jdf.queryExecution().executedPlan().toString()


def _hot(spark, path):
    """Events of which one order has a third, and their order values, both read back from files."""
    ev = spark.range(60_000).selectExpr(
        "id as event_id", "if(id % 3 = 0, 0, id) as order_id", "cast(null as timestamp_ntz) as event_ts", "'N' as state",
        "concat('DC', id % 7) as center", "'Lima' as dest_city", "cast(null as string) as carrier", "cast(null as string) as tracking_no",
        "cast(null as timestamp_ntz) as promised_ts", "1.0D as stage_hours", "9 as ship_cost", "cast(null as string) as incident", "md5(cast(id as string)) as note")
    ev.write.parquet(f"{path}/events")
    ev = spark.read.parquet(f"{path}/events")
    S.recovery_values(ev).write.parquet(f"{path}/firsts")
    ev.select("order_id").distinct().withColumn("city", F.lit("Lima")).write.parquet(f"{path}/sales")
    return ev, spark.read.parquet(f"{path}/firsts"), spark.read.parquet(f"{path}/sales")


def test_joins_split_a_hot_order(spark, tmp_path):
    ev, firsts, sales = _hot(spark, str(tmp_path))
    low = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
           "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in low}
    try:
        for k, v in low.items():
            spark.conf.set(k, v)
        recovered = S.recover_and_fill(ev, CONTRACT, firsts)
        for df, rows in ((recovered, 60_000), (S.flag_events(ev, sales, CONTRACT), 60_000), (G.gold_events(sales, ev), 60_000)):
            assert len(df.collect()) == rows
            assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
