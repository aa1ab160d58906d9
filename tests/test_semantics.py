"""Trap frames: one tiny hand-made frame per semantics row."""

import datetime as dt

from pyspark.sql import functions as F

from orderlake.contract import Contract
from orderlake.functions import semantics as S
from orderlake.operators import silver as SV


def test_first_by_skips_nulls_and_follows_order(spark):  # S1
    df = spark.createDataFrame([(1, 1, None), (1, 2, "b"), (1, 3, "c"), (2, 1, None)], "k int, o int, v string")
    got = {r["k"]: r["f"] for r in df.groupBy("k").agg(S.first_by("v", "o").alias("f")).collect()}
    assert got == {1: "b", 2: None}


def test_null_is_outside_list(spark):  # S5
    df = spark.createDataFrame([("a",), (None,), ("z",)], "c string")
    got = [r[0] for r in df.select(S.not_in_list("c", ["a"])).collect()]
    assert got == [False, True, True]


def test_null_comparison_is_false(spark):  # S6
    df = spark.createDataFrame([(None,), (-1,)], "x int")
    assert [r[0] for r in df.select(S.false_if_null(F.col("x") < 0)).collect()] == [False, True]


def test_sum_of_all_null_group_is_zero(spark):  # S11
    df = spark.createDataFrame([(1, None)], "k int, x double")
    assert df.groupBy("k").agg(S.sum_or_zero("x").alias("s")).collect()[0]["s"] == 0


def test_half_even_rounding(spark):  # S12
    import numpy as np
    vals = [0.125, 2.675, 0.375, -0.125, 1.005, 2.5e-3, 1234.565]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(S.round_half_even("x")).collect()]
    assert got == [float(x) for x in np.round(vals, 2)]


def test_late_flag_is_three_valued(spark):  # S13
    df = spark.createDataFrame([(1.5,), (0.0,), (None,)], "d double")
    assert [r[0] for r in df.select(F.col("d") > 0).collect()] == [True, False, None]


def test_text_dates_with_several_formats(spark):  # S18
    df = spark.createDataFrame([("2026-01-01",), ("2026-01-01 10:00:00",), ("01/02/2026",), ("bad",)], "t string")
    got = [r[0] for r in df.select(S.parse_ts("t", (None, "dd/MM/yyyy"))).collect()]
    assert got == [dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 1, 10), dt.datetime(2026, 2, 1), None]


def test_fractional_rating_is_flagged(spark):  # S20
    df = spark.createDataFrame([(4.5,), (4.0,), (None,)], "rating double")
    rows = SV.coerce_rating(df).collect()
    assert [r["_rating_fractional"] for r in rows] == [True, False, False]
    assert [r["rating"] for r in rows] == [4, 4, None]


def test_whitespace_cleaning_handles_nbsp(spark):  # S23
    df = spark.createDataFrame([("  a  b \t c ",), (None,)], "c string")
    assert [r[0] for r in df.select(S.clean_text("c")).collect()] == ["a b c", None]


def test_duplicate_key_flags_treat_nulls_as_equal(spark):  # S7
    df = spark.createDataFrame([(None, "x"), (None, "y"), (1, "a"), (1, "b"), (2, "c")], "k int, v string")
    got = {(r["k"], r["v"]): r["d"] for r in SV.first_arrival_flags(df, "k", "d").collect()}
    assert got == {(None, "x"): False, (None, "y"): True, (1, "a"): False, (1, "b"): True, (2, "c"): False}


def test_key_conflict_keeps_fewest_nulls_then_arrival(spark):  # S10
    df = spark.createDataFrame([(1, 10, None, "z"), (1, 10, "a", "y"), (2, 20, "b", "x"), (2, 20, "c", "x")],
                               "event_id int, order_id int, a string, b string")
    kept, inc = SV.resolve_key_conflicts(df)
    got = sorted(tuple(r) for r in kept.collect())
    assert got == [(1, 10, "a", "y"), (2, 20, "b", "x")]
    assert inc.count() == 2


def test_rule_reasons_evaluated_before_removal(spark):  # S8
    rows = [(1, 1, dt.datetime(2024, 1, 1), 1, "X", "c", None, "k", "p", "m", 1, 1.0, 0.0, 1.0, 0.0, 1.0, None),
            (1, 1, dt.datetime(2024, 1, 1), 1, "Y", "c", None, "k", "p", "m", 1, 1.0, 0.0, 1.0, 0.0, 1.0, None)]
    schema = ("sale_id long, order_id long, sale_ts timestamp_ntz, customer_id long, city string, channel string, "
              "store_id string, category string, product string, pay_method string, quantity int, "
              "unit_price double, discount_rate double, gross double, discount double, net double, rating int")
    df = spark.createDataFrame(rows, schema)
    flagged = {r["city"]: r["reject_reason"] for r in SV.flag_sales(df, Contract(coverage=("Y",))).collect()}
    # the first row is out of coverage; the second is in coverage but repeats the keys of the first
    assert flagged["X"] == "ciudad fuera de cobertura"
    assert flagged["Y"] == "id_venta repetido; pedido_id repetido"


def test_empty_incident_frame_is_typed(spark):  # S24
    e = SV.empty_incidents(spark)
    assert e.count() == 0 and e.columns == list(SV.INCIDENT_COLS)
