"""Gold: one row per event, one row per order, and the aggregate marts.

The per-order summary is a single ``groupBy(order_id)`` over the Silver
events (one shuffle, partially aggregated so a hot order collapses map-side);
the delivery timestamp and the delivered flag are folded into it, which saves
the reference's extra join. Marts aggregate the order table, never the event
table, so amounts are never multiplied by the events of an order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake import contract as K
from orderlake.contract import Contract
from orderlake.functions.semantics import (days_between, false_if_null, first_by, last_by, mean_pct,
                                           money_sum, round_half_even, sum_or_zero)
from orderlake.operators.silver import shared_tracking_numbers

SALES_AMOUNTS = ("unit_price", "gross", "discount", "net")


def avg_exact(c) -> "F.Column":
    """Mean of a 2-decimal measure summed exactly (decimal): independent of the
    order in which partitions are combined, so reruns round identically."""
    col = F.col(c) if isinstance(c, str) else c
    return F.avg(col.cast("decimal(18,2)")).cast("double")


FIRST_COLS = ("promised_ts", "center", "dest_city", "carrier", "tracking_no", "ship_cost")


def gold_events(sales: DataFrame, events: DataFrame) -> DataFrame:
    """Every Silver sale (without its amounts, so they cannot be summed once
    per event) left-joined to its events. 1:N; key uniqueness is a gate rule.

    Written as the inner join plus the sales without events: an outer join's
    right side can't be split, and that is where a hot order's events are."""
    parts = sales.drop(*SALES_AMOUNTS)
    columns = [*parts.columns, *[c for c in events.columns if c != "order_id"]]
    joined = events.join(parts, "order_id").select(*columns)
    alone = parts.join(events.select("order_id").distinct(), "order_id", "left_anti")
    nulls = [F.lit(None).cast(t).alias(c) for c, t in events.dtypes if c != "order_id"]
    return joined.unionByName(alone.select("*", *nulls).select(*columns))


def order_summary(events: DataFrame, contract: Contract) -> DataFrame:
    """D2 (+ D5, D7): one row per order, event order = ``event_id``."""
    delivered = F.col("state") == F.lit(contract.delivered_state)
    # States are a handful of labels, so a per-order set stays tiny; unlike
    # count_distinct it needs no Expand, and the whole aggregate runs as one
    # hash-based (ObjectHashAggregate) pass with map-side combine.
    aggs = [F.count("event_id").alias("n_events"),
            F.size(F.collect_set("state")).alias("n_states"),
            last_by("state", "event_id").alias("final_state"),
            F.max("event_ts").alias("last_event_ts")]
    aggs += [first_by(c, "event_id").alias(c) for c in FIRST_COLS]
    aggs += [sum_or_zero("stage_hours").cast("double").alias("total_hours"),
             F.count_if(F.col("incident") != F.lit(K.NO_INCIDENT)).alias("n_incidents"),
             F.max(F.when(delivered, F.col("event_ts"))).alias("delivery_ts"),
             F.max(delivered).alias("has_delivered")]
    return events.where(F.col("order_id").isNotNull()).groupBy("order_id").agg(*aggs)


def order_flags(summary: DataFrame, events: DataFrame) -> DataFrame:
    """D3: trace complete (all states seen anywhere in Silver) and whether the
    order's first tracking number is shared with another order."""
    n_all = events.agg(F.count_distinct("state")).scalar()
    shared = shared_tracking_numbers(events).select(F.col("tracking_no").alias("_shared_trk"),
                                                    F.lit(True).alias("_is_shared"))
    with_number = summary.where(F.col("tracking_no").isNotNull())  # orders without one would meet in one task
    without = summary.where(F.col("tracking_no").isNull()).withColumn("_is_shared", F.lit(None).cast("boolean"))
    return (with_number.join(shared, with_number["tracking_no"] == shared["_shared_trk"], "left").drop("_shared_trk")
            .unionByName(without)
            .withColumn("trace_complete", F.col("n_states") == n_all)
            .withColumn("tracking_shared", F.coalesce(F.col("_is_shared"), F.lit(False)))
            .drop("_is_shared"))


def refreshed_flags(orders: DataFrame, events: DataFrame) -> DataFrame:
    """Order rows with the flags of D3 set anew, as these depend on all of Silver; orders without events have none."""
    seen = order_flags(orders.where(F.col("n_events").isNotNull()).drop("trace_complete", "tracking_shared"), events)
    return seen.select(*orders.columns).unionByName(orders.where(F.col("n_events").isNull()))


def gold_orders(sales: DataFrame, events: DataFrame, contract: Contract) -> DataFrame:
    """The 38-column order table."""
    return order_rows(sales, order_flags(order_summary(events, contract), events))


def order_rows(sales: DataFrame, summary: DataFrame) -> DataFrame:
    """D4, D6-D9 from the sales and the summary of their events."""
    df = sales.join(summary, "order_id", "left")
    delay = round_half_even(days_between("promised_ts", "delivery_ts"))
    return (df.withColumn("delay_days", delay)
            .withColumn("late", F.col("delay_days") > 0)
            .withColumn("delivered", F.coalesce(F.col("has_delivered"), F.lit(False)))
            .withColumn("cycle_days", round_half_even(days_between("sale_ts", "delivery_ts")))
            .withColumn("promised_days", round_half_even(days_between("sale_ts", "promised_ts")))
            .withColumn("month", F.date_format("sale_ts", "yyyy-MM"))
            .drop("has_delivered"))


def _with_incident_flag(orders: DataFrame) -> DataFrame:
    return orders.withColumn("_with_incident", false_if_null(F.col("n_incidents") > 0))


def kpi_monthly(orders: DataFrame, exact: bool = True) -> DataFrame:
    """Monthly KPIs; null months are dropped (pandas groupby, S4).

    Customers are counted apart: beside a distinct count every other aggregate, the median's counters too, would be kept
    and shuffled for each customer of a month."""
    g = _with_incident_flag(orders)
    customers = (orders.where(F.col("month").isNotNull() & F.col("customer_id").isNotNull()).select(F.col("month").alias("_month"), "customer_id")
                 .distinct().groupBy("_month").agg(F.count(F.lit(1)).alias("_customers")))
    med = (F.percentile("cycle_days", 0.5) if exact else F.percentile_approx("cycle_days", 0.5, 10000))
    months = (g.where(F.col("month").isNotNull()).groupBy("month").agg(
        F.count("order_id").alias("orders"),
        F.sum("quantity").cast("bigint").alias("units"),
        money_sum("gross").alias("gross"),
        money_sum("discount").alias("discount"),
        money_sum("net").alias("net"),
        round_half_even(F.avg("net")).alias("avg_ticket"),
        sum_or_zero("ship_cost").cast("bigint").alias("ship_cost_total"),
        round_half_even(mean_pct("late")).alias("pct_late"),
        round_half_even(avg_exact("delay_days")).alias("avg_delay_days"),
        round_half_even(med).alias("median_cycle_days"),
        round_half_even(mean_pct("_with_incident")).alias("pct_orders_with_incident"),
        round_half_even(F.avg("rating")).alias("avg_rating")))
    joined = months.join(customers, F.col("month") == F.col("_month"), "left")
    rest = [c for c in months.columns if c not in ("month", "orders")]
    return joined.select("month", "orders", F.coalesce("_customers", F.lit(0)).alias("customers"), *rest)


def carrier_performance(orders: DataFrame, exact: bool = True) -> DataFrame:
    """Per carrier (nulls dropped, S4), sorted by % late desc."""
    g = _with_incident_flag(orders)

    def med(c):
        return F.percentile(c, 0.5) if exact else F.percentile_approx(c, 0.5, 10000)
    return (g.where(F.col("carrier").isNotNull()).groupBy("carrier").agg(
        F.count("order_id").alias("orders"),
        round_half_even(mean_pct("late")).alias("pct_late"),
        round_half_even(avg_exact(F.when(false_if_null(F.col("late")), F.col("delay_days")))).alias("avg_delay_late"),
        round_half_even(med("cycle_days")).alias("median_cycle_days"),
        round_half_even(med("total_hours")).alias("median_total_hours"),
        round_half_even(F.avg("ship_cost")).alias("avg_ship_cost"),
        round_half_even(mean_pct("_with_incident")).alias("pct_orders_with_incident"),
        round_half_even(F.avg("rating")).alias("avg_rating"))
        .orderBy(F.desc_nulls_last("pct_late"), "carrier"))


def city_channel_sales(orders: DataFrame) -> DataFrame:
    """City x channel; share of the grand total net (all rows, also null keys)."""
    total = orders.agg(F.sum("net").cast("double")).scalar()
    return (orders.where(F.col("city").isNotNull() & F.col("channel").isNotNull())
            .groupBy("city", "channel").agg(
                F.count("order_id").alias("orders"),
                F.sum("quantity").cast("bigint").alias("units"),
                money_sum("net").alias("net"),
                round_half_even(F.avg("net")).alias("avg_ticket"),
                round_half_even(mean_pct("late")).alias("pct_late"))
            .withColumn("pct_of_total_net", round_half_even(F.try_divide(F.col("net").cast("double"), total) * 100.0))
            .orderBy(F.desc("net"), "city", "channel"))


def delivery_kpis(orders: DataFrame, events: DataFrame, contract: Contract) -> DataFrame:
    """Delivery indicators of the report in one aggregate, plus the orders that never
    had the first state (an anti join on the orders that had it)."""
    late = false_if_null(F.col("late"))
    began = events.where(F.col("state") == contract.first_state).select("order_id").distinct()
    without_first = orders.join(began, "order_id", "left_anti").agg(F.count(F.lit(1))).scalar()
    return orders.agg(
        F.count(F.lit(1)).alias("orders"),
        F.count("late").alias("dated_deliveries"),
        F.count_if(late).alias("late_deliveries"),
        F.count_if(F.col("delivery_ts").isNull()).alias("undated"),
        F.count_if(F.col("delivery_ts").isNull() & ~F.col("delivered")).alias("undated_no_delivered_event"),
        F.count_if(F.col("delivery_ts").isNull() & F.col("delivered")).alias("undated_delivered_event"),
        F.count_if(F.col("delivered")).alias("delivered_orders"),
        round_half_even(avg_exact(F.when(late, F.col("delay_days")))).alias("avg_delay_late"),
        F.max("delay_days").alias("max_delay_days"),
        round_half_even(F.percentile("cycle_days", 0.5)).alias("median_cycle_days"),
        round_half_even(F.percentile("promised_days", 0.5)).alias("median_promised_days"),
        F.count_if(~false_if_null(F.col("trace_complete"))).alias("incomplete_traces"),
        F.count_if(F.col("n_events").isNull()).alias("orders_without_events")).withColumn(
        "orders_without_first_state", without_first)


def late_rate_by_month(orders: DataFrame) -> DataFrame:
    """Late rate per sale month."""
    return (orders.where(F.col("month").isNotNull()).groupBy("month").agg(
        F.count("late").alias("dated_deliveries"),
        round_half_even(mean_pct("late")).alias("pct_late")))


def delay_distribution(orders: DataFrame) -> DataFrame:
    """Count, mean, std (n-1), min, quartiles (linear), max of the delay."""
    x = F.col("delay_days")
    return orders.agg(
        F.count(x).alias("count"),
        round_half_even(avg_exact(x)).alias("mean"),
        round_half_even(F.stddev_samp(x)).alias("std"),
        F.min(x).alias("min"),
        round_half_even(F.percentile(x, 0.25)).alias("p25"),
        round_half_even(F.percentile(x, 0.5)).alias("median"),
        round_half_even(F.percentile(x, 0.75)).alias("p75"),
        F.max(x).alias("max"))
