"""A hot key holding a third of all rows: results stay exact and whole, and the
key-based steps are aggregates (partially combined map-side), not windows."""

import re

from pyspark.sql import functions as F

from orderlake.contract import FIXTURE_CONTRACT as C
from orderlake.operators import gold as G
from orderlake.operators import silver as S


def _events(spark, n=3000):
    # order 0 holds a third of all rows; every other order has 2 events
    rows = []
    for i in range(n):
        order = 0 if i < n // 3 else 1 + i // 2
        rows.append((i, order, "2024-01-01 00:00:00", "R" if i % 2 else "N", None if i % 7 == 0 else "DC-1",
                     "X", "CAR-1" if i % 2 else None, f"T{order}" if i % 2 else None, "2024-01-05 00:00:00",
                     float(i % 5), 9900, None, None))
    schema = ("event_id long, order_id long, event_ts_txt string, state string, center string, dest_city string, "
              "carrier string, tracking_no string, promised_ts_txt string, stage_hours double, ship_cost int, "
              "incident string, note string")
    return spark.createDataFrame(rows, schema).repartition(8)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_order_recovery_and_summary_are_exact(spark):
    ev = _events(spark)
    typed = S.prepare_events(ev, C)["typed"]
    rec = S.recover_and_fill(typed, C)
    # every row of the hot order gets the first non-null centre (event 1; event 0 has none)
    hot = rec.where("order_id = 0").agg(F.countDistinct("center"), F.min("center"), F.count(F.lit(1))).first()
    assert tuple(hot) == (1, "DC-1", 1000)
    summary = G.order_summary(rec, C).where("order_id = 0").first()
    assert summary["n_events"] == 1000 and summary["center"] == "DC-1"
    assert summary["total_hours"] == float(sum(i % 5 for i in range(1000)))
    for df in (rec, G.order_summary(rec, C)):
        assert not re.search(r"\bWindow\b", _plan(df))


def test_hot_key_duplicate_flags_are_exact(spark):
    ev = _events(spark).withColumn("k", F.when(F.col("event_id") < 1000, F.lit(0)).otherwise(F.col("event_id")))
    flagged = S.first_arrival_flags(ev, "k", "dup", ["event_id"])
    got = flagged.groupBy("dup").count().orderBy("dup").collect()
    assert [(r["dup"], r["count"]) for r in got] == [(False, 2001), (True, 999)]
    assert not re.search(r"\bWindow\b", _plan(flagged))


def test_hot_tracking_number_is_counted_once_per_order(spark):
    ev = _events(spark).withColumn("tracking_no", F.lit("SAME"))
    shared = S.shared_tracking_numbers(ev).collect()
    assert [(r["tracking_no"], r["orders"]) for r in shared] == [("SAME", 1 + (3000 - 1000) // 2)]


def _spark_order_key(row):
    """Ascending, nulls first, field by field: Spark's struct ordering."""
    return tuple((0,) if v is None else (1, v) for v in row)


def test_hot_event_id_with_many_versions_keeps_exactly_one_winner(spark):
    # event 7 holds a third of all rows as ~330 distinct versions (some repeated
    # exactly); the version kept has the fewest NULLs, ties by arrival (= all
    # columns ascending, nulls first). Checked against a brute force.
    n = 3000
    rows = []
    for i in range(n):
        if i < n // 3:
            v = i % 330
            rows.append((7, 100 + v % 3, None, "N", None if v % 4 == 0 else f"DC-{v % 9}", "X", None, None, None,
                         float(v % 11), 9900, None, None))
        else:
            rows.append((1000 + i, i, None, "N", "DC-1", "X", None, None, None, 1.0, 9900, None, None))
    schema = ("event_id long, order_id long, event_ts_txt string, state string, center string, dest_city string, "
              "carrier string, tracking_no string, promised_ts_txt string, stage_hours double, ship_cost int, "
              "incident string, note string")
    ev = spark.createDataFrame(rows, schema).repartition(8)
    prepared = S.prepared_events(ev)
    got = prepared.where("event_id = 7").collect()
    distinct = sorted(set(r for r in rows if r[0] == 7), key=_spark_order_key)
    assert len(got) == len(distinct)
    assert sum(r["_n"] for r in got) == n // 3
    winner = min(distinct, key=lambda r: (sum(v is None for v in r), _spark_order_key(r)))
    kept = [tuple(r)[:13] for r in got if r["_win"]]
    assert kept == [winner]
    # every other key has one version and wins alone
    assert prepared.where("event_id <> 7 AND NOT _win").count() == 0
    assert not re.search(r"\bWindow\b", _plan(prepared))


def test_hot_order_in_sales_flags_every_later_copy(spark):
    # one order_id carries a third of the sales; only its first sale (arrival =
    # all columns ascending) is not a repeated order.
    from decimal import Decimal as D

    from orderlake.contract import Contract
    n = 900
    rows = [(i, 0 if i < n // 3 else i, "2024-01-02", 1, "Lima", "BUILDING", None, "c", "p", "m", 1,
             D("10.00"), D("0.00"), D("10.00"), D("0.00"), D("10.00"), 3) for i in range(n)]
    schema = ("sale_id long, order_id long, sale_ts string, customer_id long, city string, channel string, "
              "store_id string, category string, product string, pay_method string, quantity int, "
              "unit_price decimal(18,2), discount_rate decimal(5,2), gross decimal(18,2), discount decimal(18,2), "
              "net decimal(18,2), rating int")
    sales = spark.createDataFrame(rows, schema).repartition(8)
    flagged = S.flag_sales(sales, Contract(coverage=("Lima",)))
    bad = {r["sale_id"]: r["reject_reason"] for r in flagged.where("reject_reason <> ''").collect()}
    assert sorted(bad) == list(range(1, n // 3))
    assert set(bad.values()) == {"pedido_id repetido"}
    assert not re.search(r"\bWindow\b", _plan(flagged))


def test_events_are_shuffled_once_by_their_id(spark):
    """Copies and versions share their id: one exchange of whole rows, and equal results where ids are hot, null or repeated."""
    import orderlake.operators.silver as silver
    n = 600
    rows = [(None if i % 50 == 0 else 7 if i % 3 == 0 else i // 2, i % 5, "2024-01-01 00:00:00", "R", None if i % 4 else "DC", "X", None, None, None, 1.0, 1, None, None)
            for i in range(n)]
    schema = ("event_id long, order_id long, event_ts_txt string, state string, center string, dest_city string, carrier string, tracking_no string, "
              "promised_ts_txt string, stage_hours double, ship_cost int, incident string, note string")
    ev = spark.createDataFrame(rows, schema).repartition(8)
    plain = S.prepared_events(ev)
    whole = re.findall(r"Exchange hashpartitioning\(event_id[^)]*\), REPARTITION_BY_COL", _plan(plain))
    assert whole
    before, silver.HOT_ROWS = silver.HOT_ROWS, 20
    try:
        hot = sorted(map(str, S.prepared_events(ev).collect()))
    finally:
        silver.HOT_ROWS = before
    assert hot == sorted(map(str, plain.collect()))
    assert sum(r["_n"] for r in plain.collect()) == n
    keyed = {}
    for r in plain.collect():
        keyed.setdefault(r["event_id"], []).append(r)
    assert set(keyed) == {r[0] for r in rows}
    assert all(sum(r["_win"] for r in same) == 1 for same in keyed.values())


def test_sales_whose_keys_occur_once_are_not_shuffled(spark):
    """Only sales with a repeated key are deduplicated and ranked; too many repeated keys go the whole way with equal results."""
    from decimal import Decimal as D

    import orderlake.operators.silver as silver
    from orderlake.contract import Contract
    rows = [(i // 2 if i % 10 == 0 else None if i % 33 == 0 else i, i if i % 7 else None, "2024-01-02", 1, " Lima", "BUILDING", None, "c", "p", f"m{i % 2}", 1,
             D("10.00"), D("0.00"), D("10.00"), D("0.00"), D("10.00"), 3) for i in [*range(200), *range(0, 200, 20)]]
    schema = ("sale_id long, order_id long, sale_ts string, customer_id long, city string, channel string, store_id string, category string, product string, "
              "pay_method string, quantity int, unit_price decimal(18,2), discount_rate decimal(5,2), gross decimal(18,2), discount decimal(18,2), net decimal(18,2), rating int")
    sales = spark.createDataFrame(rows, schema).repartition(8)
    few = S.flag_sales(sales, Contract(coverage=("Lima",)))
    assert "BroadcastHashJoin" in _plan(few)
    before, silver.KEYS_AT_ONCE = silver.KEYS_AT_ONCE, 0
    try:
        whole = sorted(map(str, S.flag_sales(sales, Contract(coverage=("Lima",))).collect()))
    finally:
        silver.KEYS_AT_ONCE = before
    assert sorted(map(str, few.collect())) == whole and len(whole) == len(set(rows))


def test_monthly_customers_are_counted_apart(spark):
    orders = spark.createDataFrame([("2024-01", 1, None), ("2024-01", 1, 2.0), ("2024-01", None, 3.0), ("2024-02", None, None), (None, 5, 1.0)],
                                   "month string, customer_id long, cycle_days double")
    rest = {"order_id": F.lit(1), "quantity": F.lit(1), **{c: F.lit(1).cast("decimal(18,2)") for c in ("gross", "discount", "net")}, "ship_cost": F.lit(1), "late": F.lit(True),
            "delay_days": F.lit(1.0), "n_incidents": F.lit(0), "rating": F.lit(1)}
    kpi = G.kpi_monthly(orders.withColumns(rest))
    assert {r["month"]: (r["orders"], r["customers"], r["median_cycle_days"]) for r in kpi.collect()} == {"2024-01": (3, 1, 2.5), "2024-02": (1, 0, None)}
    assert not re.search(r"customer_id[^\n]*percentile|percentile[^\n]*keys=\[[^\]]*customer_id", _plan(kpi))


def test_events_are_gathered_once_by_order(spark):
    """Recovery and the look-up of the sale take one exchange of whole events; hot orders and events without order have equal results."""
    import orderlake.operators.silver as silver
    typed = S.prepare_events(_events(spark, 900), C)["typed"].withColumn("order_id", F.when(F.col("event_id") % 40 != 3, F.col("order_id")))
    sales = spark.range(0, 400, 2).select(F.col("id").alias("order_id"))
    want = sorted(map(str, S.flag_events(S.recover_and_fill(typed, C), sales, C).select("event_id", "order_id", "center", "carrier", "tracking_no", "promised_ts",
                                                                                     "_was_null_center", "reject_reason").collect()))
    for most in (10_000, 50):
        before, silver.HOT_ORDER = silver.HOT_ORDER, most
        try:
            once = S.flag_events(S.recover_and_fill(typed, C, valid_sales=sales), sales, C)
            got = sorted(map(str, once.select("event_id", "order_id", "center", "carrier", "tracking_no", "promised_ts", "_was_null_center", "reject_reason").collect()))
            assert got == want and len(got) == 900
        finally:
            silver.HOT_ORDER = before
    assert len(re.findall(r"REPARTITION_BY_COL", _plan(once))) >= 1
