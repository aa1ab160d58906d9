"""Failure path: a broken rule raises, nothing is published, the old pointer stays."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from given_tables import SF_SMALL
from orderlake import registry as R
from orderlake.contract import TOLERANT_CONTRACT, Contract
from orderlake.operators import rules as E
from orderlake.operators.rules import GateError, gate
from orderlake.plans import ledger as L
from orderlake.plans import pipeline
from orderlake.plans.pipeline import Lake, reprocess, retain, run_pipeline
from orderlake.sources import fixtures as FX
from orderlake.sources.bronze import LoadExistsError, UnknownLoadError, apply_retention, list_load_ids
from orderlake.sources.landing import path_exists


def _sources(spark):
    return R.bronze_sales(spark, SF_SMALL), R.bronze_events(spark, SF_SMALL)


def test_gate_raises_on_failed_rule(spark):
    rules = spark.createDataFrame([("gold", "R1", "x", 0, True), ("gold", "R2", "y", 3, False)],
                                  "layer string, rule_id string, rule string, violations bigint, passed boolean")
    with pytest.raises(GateError) as e:
        gate(rules)
    assert e.value.failed == [("gold", "R2", "y")] and str(e.value) == "1 quality rule(s) failed: gold: R2 y"


def test_failed_run_keeps_previous_publication(spark, tmpdir_spark):
    lake = Lake(tmpdir_spark)
    cov = FX.coverage(spark, SF_SMALL)
    s, e = _sources(spark)
    first = run_pipeline(spark, lake, {"sales": s, "events": e}, TOLERANT_CONTRACT, cov, load_id="20240101_000000")
    # every price negative: the rows go to quarantine, beyond the share that the contract admits
    bad_s = s.withColumn("unit_price", F.col("unit_price") * -1)
    with pytest.raises(GateError) as failed:
        run_pipeline(spark, lake, {"sales": bad_s, "events": e}, TOLERANT_CONTRACT, cov, load_id="20240102_000000")
    assert "R20" in {r[1] for r in failed.value.failed}
    details = {r["rule_id"]: r["detail"] for r in L.read(spark, lake.ledger, "run_rule").where(F.col("run_id").startswith("20240102")).collect()}
    rejected = L.read(spark, lake.ledger, "run_table").where("table = 'sales_rejected'").where(F.col("run_id").startswith("20240102")).first()["rows"]
    assert details["R20"] == f"{rejected} rejected" and f"({rejected} rejected)" in str(failed.value) and details["R1"] == "0 repeated"
    runs = L.read(spark, lake.ledger, "run").orderBy("started_at").collect()
    assert [r["status"] for r in runs] == ["PUBLISHED", "FAILED"] and runs[1]["error"] == str(failed.value)
    assert not path_exists(spark, f"{lake.run_dir(runs[1]['run_id'])}/gold")  # Silver failed: Gold was not built
    assert not path_exists(spark, f"{lake.run_dir(first.run_id)}/work")
    assert L.published_run(spark, lake.ledger)[0] == first.run_id
    with pytest.raises(LoadExistsError):
        run_pipeline(spark, lake, {"sales": s, "events": e}, TOLERANT_CONTRACT, cov, load_id="20240101_000000")
    with pytest.raises(UnknownLoadError):
        reprocess(spark, lake, TOLERANT_CONTRACT, cov, load_id="19990101_000000")
    with pytest.raises(ValueError):
        apply_retention(spark, lake.bronze, ["sales"], 0)
    # a load of which one source is missing is not a load
    s.write.parquet(f"{lake.bronze}/sales/load_id=20240103_000000/generation=0")
    assert list_load_ids(spark, lake.bronze, "sales") == ["20240101_000000", "20240102_000000"]
    assert retain(spark, lake, 1) == ["20240101_000000"]
    assert path_exists(spark, lake.run_dir(first.run_id))  # published: stays
    assert list_load_ids(spark, lake.bronze, "events") == ["20240102_000000"]


SALE = ("sale_id long, order_id long, sale_ts timestamp_ntz, city string, unit_price decimal(18,2), gross decimal(18,2), "
        "discount decimal(18,2), net decimal(18,2), rating int")
EVENT = ("event_id long, order_id long, event_ts timestamp_ntz, state string, center string, dest_city string, carrier string, "
         "tracking_no string, promised_ts timestamp_ntz")


def _clean(spark):
    ts = dt.datetime(2024, 1, 1)
    one = D("1.00")
    sales = spark.createDataFrame([(k, k, ts, "Lima", one, one, one, one, 3) for k in (1, 2)], SALE)
    events = spark.createDataFrame([(10 * k + i, k, ts, st, "DC", "Lima", c, c, ts) for k in (1, 2)
                                    for i, (st, c) in enumerate([("N", None), ("A", "C1"), ("R", "C1")])], EVENT)
    return sales, events


def _silver(sales, events, raw=100, rejected=0, rejected_events=0):
    rows = E.silver_rules(sales, events, Contract(coverage=("Lima",)), F.lit(raw), F.lit(rejected), F.lit(raw), F.lit(rejected_events))
    return {r["rule_id"] for r in rows.collect() if not r["passed"]}


def _set(column, value, where="event_id = 11"):
    return lambda df: df.withColumn(column, F.when(F.expr(where), F.expr(value)).otherwise(F.col(column)))


BREAK_SALES = {"R1": _set("sale_id", "1L", "true"), "R2": _set("order_id", "1L", "true"), "R3": _set("sale_ts", "null", "sale_id = 1"),
               "R4": _set("rating", "9", "sale_id = 1"), "R5": _set("net", "-1", "sale_id = 1"), "R6": _set("city", "'Oz'", "sale_id = 1")}
BREAK_EVENTS = {"R7": _set("event_id", "10L"), "R8": lambda df: df.unionByName(df.where("event_id = 10")),
                "R9": lambda df: df.withColumn("unnamed_3", F.lit(None).cast("string")),
                "R10": lambda df: df.withColumn("event_ts", F.col("event_ts").cast("string")),
                "R11": _set("center", "null"), "R12": _set("dest_city", "null"), "R13": _set("promised_ts", "null"),
                "R14": _set("carrier", "null"), "R15": _set("carrier", "'C9'", "event_id = 10"), "R16": _set("tracking_no", "null"),
                "R17": _set("tracking_no", "'T9'", "event_id = 10"), "R18": _set("dest_city", "'Oz'"), "R19": _set("order_id", "99L")}


def test_clean_frames_pass_every_silver_rule(spark):
    assert _silver(*_clean(spark)) == set()


@pytest.mark.parametrize("rule", [*BREAK_SALES, *BREAK_EVENTS])
def test_each_silver_rule_fails_when_broken(spark, rule):
    sales, events = _clean(spark)
    also = {"R2": {"R19"}, "R8": {"R7"}}.get(rule, set())
    broken = _silver(BREAK_SALES[rule](sales), events) if rule in BREAK_SALES else _silver(sales, BREAK_EVENTS[rule](events))
    assert rule in broken and broken - {rule} <= also


def test_quarantine_shares_fail_beyond_the_limit(spark):
    clean = _clean(spark)
    assert _silver(*clean, rejected=5, rejected_events=5) == set()
    assert _silver(*clean, rejected=6) == {"R20"} and _silver(*clean, rejected_events=6) == {"R21"}


def test_tolerated_share_is_a_limit(spark):
    sales, events = _clean(spark)
    bad = _set("center", "null")(events)  # 1 of 6 events

    def passed(pct):
        rules = E.silver_rules(sales, bad, Contract(coverage=("Lima",), tolerated_pct={"R11": pct}), F.lit(9), F.lit(0), F.lit(9), F.lit(0))
        return {r["rule_id"]: r["passed"] for r in rules.collect()}["R11"]
    assert passed(17.0) and not passed(16.0)


def test_each_gold_rule_fails_when_broken(spark):
    sales, events = _clean(spark)
    one = D("1.00")
    orders = spark.createDataFrame([(1, one, 3, 9), (2, one, 3, 9)], "order_id long, net decimal(18,2), n_events long, ship_cost int")
    gold_ev = sales.select("order_id").join(events, "order_id")
    marts = {"kpi_monthly": spark.createDataFrame([("2024-01", 2, D("2.00"))], "month string, orders long, net decimal(38,2)"),
             "carrier_performance": spark.createDataFrame([("C1", 2)], "carrier string, orders long"),
             "city_channel_sales": spark.createDataFrame([("Lima", 2, D("2.00"))], "city string, orders long, net decimal(38,2)")}

    def failed(orders=orders, gold_ev=gold_ev, marts=marts):
        return {r["rule_id"] for r in E.gold_rules(sales, events, gold_ev, orders, marts).collect() if not r["passed"]}
    assert failed() == set()
    assert "R22" in failed(orders=orders.limit(1))
    assert "R23" in failed(orders=orders.withColumn("order_id", F.lit(1).cast("long")))
    assert "R24" in failed(orders=orders.withColumn("net", F.col("net") * 5))
    assert failed(orders=orders.withColumn("n_events", F.when(F.col("order_id") == 1, F.col("n_events")))) == {"R25"}
    assert failed(orders=orders.withColumn("ship_cost", F.when(F.col("order_id") == 1, F.col("ship_cost")))) == {"R26"}
    assert failed(gold_ev=gold_ev.limit(5)) == {"R27"}
    assert failed(gold_ev=gold_ev.withColumn("net", F.lit(1))) == {"R28"}
    for rules, name, column in (({"R29"}, "kpi_monthly", "orders"), ({"R30"}, "kpi_monthly", "net"), ({"R31"}, "carrier_performance", "orders"),
                                ({"R32"}, "city_channel_sales", "orders"), ({"R33"}, "city_channel_sales", "net")):
        assert failed(marts=marts | {name: marts[name].withColumn(column, (F.col(column) * 7).cast(dict(marts[name].dtypes)[column]))}) == rules


MART_KEYS = {"kpi_monthly": ["month"], "carrier_performance": ["carrier"], "city_channel_sales": ["city", "channel"]}


def _forty_orders(spark):
    """40 sales, of which order 1 has events with a carrier, order 2 events without one, the others none."""
    sales = spark.createDataFrame([(k, k, dt.datetime(2024, 1, 1), "Lima", *[D("1.00")] * 4, 3) for k in range(1, 41)], SALE)
    events = _clean(spark)[1].withColumn("carrier", F.when(F.col("order_id") == 1, F.col("carrier")))
    orders = sales.select("order_id", "net", F.lit(3).alias("n_events"), F.lit(9).alias("ship_cost"), F.lit("2024-01").alias("month"),
                          F.when(F.col("order_id") == 1, "C1").alias("carrier"), F.lit("Lima").alias("city"), F.lit("WEB").alias("channel"))
    return sales, events, orders


def _marts(rows):
    made = {n: rows.dropna(subset=k).groupBy(*k).agg(F.count("order_id").alias("orders"), F.sum("net").alias("net")) for n, k in MART_KEYS.items()}
    return made | {"carrier_performance": made["carrier_performance"].drop("net")}


@pytest.mark.parametrize("contract", [None, Contract(), TOLERANT_CONTRACT], ids=["none", "strict", "expected gaps"])
def test_keys_and_rows_lost_in_gold_fail_under_every_contract(spark, contract):
    sales, events, orders = _forty_orders(spark)
    gold_ev = sales.select("order_id").join(events, "order_id", "left")

    def failed(gold_ev=gold_ev, rows=orders, orders=None):
        rules = E.gold_rules(sales, events, gold_ev, rows if orders is None else orders, _marts(rows), contract)
        return {r["rule_id"] for r in rules.collect() if not r["passed"]}
    # 38 sales without events and 39 orders without a carrier are the sources' gaps, if the contract expects them
    assert failed() == (set() if contract is TOLERANT_CONTRACT else {"R27", "R31"})
    assert "R27" in failed(gold_ev=gold_ev.where("order_id <> 40"))
    for column, broken in (("month", {"R29", "R30"}), ("carrier", {"R31"}), ("city", {"R32", "R33"}), ("channel", {"R32", "R33"})):
        assert broken <= failed(rows=orders.withColumn(column, F.lit(None).cast("string")))
        assert broken <= failed(rows=orders.withColumn(column, F.when(F.col("order_id") > 1, F.col(column)))) or column == "carrier"
    assert {"R22", "R24", "R29", "R30", "R31", "R32", "R33"} <= failed(orders=orders, rows=orders.where("false")) | {"R22", "R24"}
    assert {"R22", "R24"} <= failed(rows=orders.where("order_id <> 40")) | failed(rows=orders.where("order_id < 30"))


def test_each_expected_gap_is_counted_from_silver(spark):
    sales, events, orders = _forty_orders(spark)
    gold_ev = sales.select("order_id").join(events, "order_id", "left")
    for gaps, left in ((set(), {"R27", "R31"}), ({"sales_without_events"}, {"R31"}), ({"orders_without_carrier"}, {"R27"})):
        rules = E.gold_rules(sales, events, gold_ev, orders, _marts(orders), Contract(expected_gaps=frozenset(gaps)))
        assert {r["rule_id"] for r in rules.collect() if not r["passed"]} == left


def test_details_name_a_bounded_number_of_values(spark):
    sales, events = _clean(spark)
    many = events.crossJoin(spark.range(100).select(F.col("id").alias("_i"))).withColumn("event_id", F.col("event_id") * 1000 + F.col("_i")).drop("_i")
    bad = _set("center", "null", "event_id % 2 = 0")(_set("dest_city", "concat('Oz', event_id % 3)", "true")(many))
    args = (sales, bad, Contract(coverage=("Lima",)))
    rules = E.rule_details(E.silver_rules(*args, F.lit(100), F.lit(7), F.lit(100), F.lit(0)), E.silver_offenders(*args))
    detail = {r["rule_id"]: r["detail"] for r in rules.collect()}
    assert detail["R11"] == "300 null: 10000, 10002, 10004, 10006, 10008 and 295 more"
    assert detail["R18"] == "3 outside coverage: Oz0, Oz1, Oz2"
    assert detail["R20"] == "7 rejected" and detail["R1"] == "0 repeated"
    assert len(detail) == 21


def test_smallest_values_are_limited_before_the_shuffle(spark):
    """No task and no list holds the rows that break a rule: a window limit of k per rule on both sides of the shuffle."""
    df = spark.range(100_000).select((F.col("id") % 3).cast("string").alias("g"), (F.col("id") % 20_000).cast("string").alias("v"))
    found = E.k_smallest_distinct(df, "g", "v", 5)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.index("Final") < plan.index("Partial")
    rows = {r["g"]: r for r in found.collect()}
    for g in "012":
        values = sorted({str(i % 20_000) for i in range(int(g), 100_000, 3)})
        assert rows[g]["smallest"] == values[:5] and rows[g]["n_distinct"] == len(values)


def test_observed_counters_equal_scanned_ones(spark, tmpdir_spark):
    """What the write of a Silver table counts is what a scan of its clean rows counts, broken rules and rejected rows included."""
    sales, events = _clean(spark)
    for rule in ("R3", "R4", "R5"):
        sales = BREAK_SALES[rule](sales)
    for rule in ("R11", "R12", "R13", "R14", "R15", "R16"):
        events = BREAK_EVENTS[rule](events)
    contract, facts = Contract(coverage=("Lima",)), {}
    for df, table, key in ((sales, "sales", "sale_id"), (events, "events", "event_id")):
        bad = df.withColumn(key, F.col(key) + 1000)  # rejected rows break the same rules and must not count
        flagged = df.withColumn("reject_reason", F.lit("")).unionByName(bad.withColumn("reject_reason", F.lit("why")))
        path = f"{tmpdir_spark}/{table}"
        seen = pipeline._write_checked(spark, flagged, path, "run", "load", facts, table, df.columns, pipeline.Timings(), contract)
        scanned = spark.read.parquet(path).where("outcome = 'clean'").agg(*E.row_counters(table, contract)).first().asDict()
        assert seen == scanned and sum(seen.values()) > seen["_rows"]
        assert facts[f"silver.{table}"]["rows"] == facts[f"silver.{table}_rejected"]["rows"] == df.count()
    for table, df in (("sales", sales), ("events", events)):
        empty = df.where("false").withColumn("reject_reason", F.lit(""))
        seen = pipeline._write_checked(spark, empty, f"{tmpdir_spark}/no_{table}", "run", "load", {}, table, df.columns, pipeline.Timings(), contract)
        assert set(seen.values()) == {0}


def test_rules_with_observed_counters_scan_for_keys_only(spark, tmpdir_spark):
    """Rules of single rows come from the observed counters: no scan reads the columns that only they need."""
    sales, events = _clean(spark)
    sales.write.parquet(f"{tmpdir_spark}/s")
    events.write.parquet(f"{tmpdir_spark}/e")
    sales, events = spark.read.parquet(f"{tmpdir_spark}/s"), spark.read.parquet(f"{tmpdir_spark}/e")
    contract, one = Contract(coverage=("Lima",)), F.lit(9)
    seen = {t: df.agg(*E.row_counters(t, contract)).first().asDict() for t, df in (("sales", sales), ("events", events))}
    args = (sales, events, contract, one, F.lit(0), one, F.lit(0), None)
    with_seen, scanning = E.silver_rules(*args, seen), E.silver_rules(*args)
    assert sorted(with_seen.collect()) == sorted(scanning.collect())

    def scans(df):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        return plan, plan.count("Relation")
    plan, n = scans(with_seen)
    assert n < scans(scanning)[1]
