"""Business questions on the raw (uncleaned) sales and events.

Functions are lazy ``DataFrame`` transformations; those that rank write the ranges they number. Grand totals are
scalar subqueries (``DataFrame.scalar()``): computed once, never joined and
never funnelled through a single-partition window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.functions.quantiles import quantiles
from orderlake.functions.ranking import numbered
from orderlake.functions.semantics import (false_if_null, first_by, money_sum, round_half_even)
from orderlake.sources.landing import scratch


def order_first_values(events: DataFrame) -> DataFrame:
    """one row per order with its first destination and shipping cost.

    "First" = first non-null in event order; the value breaks ties between
    conflicting copies of one event id so the answer is deterministic.
    """
    return (events.groupBy("order_id")
            .agg(first_by("dest_city", "event_id", "dest_city").alias("dest_city"),
                 first_by("ship_cost", "event_id", "ship_cost").alias("ship_cost")))


def net_by_channel(sales: DataFrame) -> DataFrame:
    """net per channel and its share of the total."""
    total = sales.agg(F.sum("net").cast("double")).scalar()
    return (sales.groupBy("channel")
            .agg(money_sum("net").alias("net"))
            .withColumn("share_pct", round_half_even(F.try_divide(F.col("net").cast("double"), total) * 100.0))
            .orderBy(F.desc("net"), "channel"))


def city_category(sales: DataFrame, city: str) -> DataFrame:
    """in one city, units and net by category; leaders by units and by value."""
    agg = (sales.where(F.col("city") == F.lit(city))
           .groupBy("category")
           .agg(F.sum("quantity").cast("bigint").alias("units"), money_sum("net").alias("net")))
    return ranked(agg, {"units_rank": "units", "net_rank": "net"}, "category")


def ranked(groups: DataFrame, ranks: dict[str, str], name: str) -> DataFrame:
    """``groups`` with, for each of ``ranks``, the rank by a column, the largest first and ties by ``name``.

    Numbered in ranges (``functions.ranking``), so that no task needs all groups.
    """
    for rank, by in ranks.items():
        groups = numbered(groups, [], [F.desc(by), F.col(name)], scratch, rank)
    return groups


def purchases_per_customer(sales: DataFrame) -> DataFrame:
    return sales.groupBy("customer_id").agg(F.count(F.lit(1)).alias("purchases"))


def recurrence_distribution(sales: DataFrame) -> DataFrame:
    """how many customers bought 1, 2, 3 ... times (count of counts)."""
    return (purchases_per_customer(sales)
            .groupBy("purchases")
            .agg(F.count(F.lit(1)).alias("customers"))
            .withColumnRenamed("purchases", "purchases_per_customer")
            .orderBy("purchases_per_customer"))


def recurrence_kpis(sales: DataFrame) -> DataFrame:
    """repeat customers, their share, the share of sales they made, max purchases."""
    per = purchases_per_customer(sales)
    return (per.agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(F.col("purchases") > 1).alias("repeat_customers"),
        F.max("purchases").alias("max_purchases"),
        F.sum("purchases").alias("sales"),
        F.sum(F.when(F.col("purchases") > 1, F.col("purchases")).otherwise(0)).alias("sales_by_repeat"))
        .select("customers", "repeat_customers", "max_purchases",
                round_half_even(F.try_divide("repeat_customers", "customers") * 100.0).alias("repeat_pct"),
                round_half_even(F.try_divide("sales_by_repeat", "sales") * 100.0).alias("sales_by_repeat_pct")))


def discount_share(sales: DataFrame) -> DataFrame:
    """discount as % of gross; % of sales with a discount."""
    return sales.agg(
        round_half_even(F.try_divide(F.sum("discount").cast("double"), F.sum("gross").cast("double")) * 100.0)
        .alias("discount_pct_of_gross"),
        round_half_even(F.avg(false_if_null(F.col("discount_rate") > 0).cast("double")) * 100.0)
        .alias("pct_sales_with_discount"))


def stage_hours_by_carrier(events: DataFrame) -> DataFrame:
    """mean stage hours per carrier (null carriers dropped) and overall mean."""
    overall = events.agg(F.avg("stage_hours")).scalar()
    return (events.where(F.col("carrier").isNotNull())
            .groupBy("carrier")
            .agg(round_half_even(F.avg("stage_hours")).alias("mean_stage_hours"))
            .withColumn("overall_mean_stage_hours", round_half_even(overall))
            .orderBy("mean_stage_hours", "carrier"))


def top_products(sales: DataFrame, k: int = 5) -> DataFrame:
    """top-k products by net and their weight inside their category."""
    per = sales.groupBy("product", "category").agg(money_sum("net").alias("net"))
    # the k products are chosen first; their categories' totals then come from one pre-aggregated join
    top = per.orderBy(F.desc("net"), "product", "category").limit(k)
    totals = sales.groupBy(F.col("category").alias("_c")).agg(money_sum("net").alias("_category_net"))
    return (top.join(totals, F.col("category").eqNullSafe(F.col("_c")))
            .withColumn("category_share_pct", round_half_even(
                F.try_divide(F.col("net").cast("double"), F.col("_category_net").cast("double")) * 100.0))
            .drop("_c", "_category_net")
            .orderBy(F.desc("net"), "product", "category"))


def _order_costs(sales: DataFrame, events: DataFrame) -> DataFrame:
    """F7 input: per-order first destination/cost joined (inner) to the sale."""
    return order_first_values(events).join(
        sales.select("order_id", "category", "quantity", "net"), "order_id", "inner")


def cost_by_city(sales: DataFrame, events: DataFrame) -> DataFrame:
    """mean cost and number of distinct tariffs per destination city."""
    return (_order_costs(sales, events).where(F.col("dest_city").isNotNull())
            .groupBy("dest_city")
            .agg(round_half_even(F.avg("ship_cost")).alias("mean_cost"),
                 F.count_distinct("ship_cost").alias("tariffs")))


def cost_by_category(sales: DataFrame, events: DataFrame) -> DataFrame:
    """mean cost per product category."""
    return (_order_costs(sales, events).where(F.col("category").isNotNull())
            .groupBy("category")
            .agg(round_half_even(F.avg("ship_cost")).alias("mean_cost")))


def cost_correlations(sales: DataFrame, events: DataFrame) -> DataFrame:
    """Pearson correlation of cost with quantity and with net; tariffs overall."""
    oc = _order_costs(sales, events)
    return oc.agg(
        round_half_even(F.corr(F.col("ship_cost").cast("double"), F.col("quantity").cast("double")), 6)
        .alias("corr_cost_quantity"),
        round_half_even(F.corr(F.col("ship_cost").cast("double"), F.col("net").cast("double")), 6)
        .alias("corr_cost_net"),
        F.count_distinct("ship_cost").alias("tariffs"))


def incident_rate(events: DataFrame) -> DataFrame:
    """F8: % of events with an incident; orders affected and their share."""
    return events.agg(
        F.count(F.lit(1)).alias("events"),
        F.count("incident").alias("events_with_incident"),
        round_half_even(F.avg(F.col("incident").isNotNull().cast("double")) * 100.0).alias("pct_events_with_incident"),
        F.count_distinct(F.when(F.col("incident").isNotNull(), F.col("order_id"))).alias("orders_with_incident"),
        F.count_distinct("order_id").alias("orders")
    ).withColumn("pct_orders_with_incident",
                 round_half_even(F.try_divide("orders_with_incident", "orders") * 100.0))


def payment_channel(sales: DataFrame) -> DataFrame:
    """payment method x channel contingency table in long form (method, channel, n):
    whatever channels the data has, one row per combination that occurs."""
    return sales.groupBy("pay_method", "channel").agg(F.count(F.lit(1)).alias("n"))


def exclusive_methods(sales: DataFrame, physical_channel: str) -> DataFrame:
    """per payment method, in how many channels it appears, the only one if
    exclusive, and how many sales it has outside the physical channel."""
    per = sales.groupBy("pay_method", "channel").agg(F.count(F.lit(1)).alias("n"))
    return (per.groupBy("pay_method").agg(
        F.count(F.lit(1)).alias("n_channels"),
        F.min("channel").alias("_some_channel"),
        F.sum(F.when(F.col("channel") != F.lit(physical_channel), F.col("n")).otherwise(0))
        .cast("bigint").alias("sales_outside_physical"))
        .select("pay_method", "n_channels",
                (F.col("n_channels") == 1).alias("exclusive"),
                F.when(F.col("n_channels") == 1, F.col("_some_channel")).alias("exclusive_channel"),
                "sales_outside_physical"))


def avg_net_by_city(sales: DataFrame) -> DataFrame:
    """mean net per transaction by city, rounded to units (half-even)."""
    return (sales.groupBy("city")
            .agg(round_half_even(F.avg("net"), 0).alias("avg_net"))
            .orderBy(F.desc("avg_net"), "city"))


def concentration_top3(sales: DataFrame) -> DataFrame:
    """share of net of the three cities with most net."""
    total = sales.agg(F.sum("net").cast("double")).scalar()
    per = sales.groupBy("city").agg(money_sum("net").alias("net"))
    top = per.orderBy(F.desc("net"), "city").limit(3)
    return top.agg(money_sum("net").alias("top3_net"),
                   F.count(F.lit(1)).alias("cities")).withColumn(
        "top3_share_pct", round_half_even(F.try_divide(F.col("top3_net").cast("double"), total) * 100.0))


def rating_high_share(sales: DataFrame, high: Sequence[int] = (4, 5)) -> DataFrame:
    """% of ratings in the high band among non-null ratings."""
    return sales.agg(
        F.count("rating").alias("rated"),
        F.count_if(F.col("rating").isin(list(high))).alias("high"),
    ).withColumn("high_pct", round_half_even(F.try_divide(F.col("high") * 100.0, F.col("rated"))))


def best_month(sales: DataFrame) -> DataFrame:
    """month (YYYY-MM of the sale) with the most net."""
    per = (sales.where(F.col("sale_ts").isNotNull())
           .groupBy(F.date_format("sale_ts", "yyyy-MM").alias("month"))
           .agg(money_sum("net").alias("net")))
    return per.orderBy(F.desc("net"), "month").limit(1)


def channel_transaction_share(sales: DataFrame) -> DataFrame:
    """share of transactions per channel (``value_counts(normalize=True)``)."""
    total = sales.agg(F.count(F.lit(1))).scalar()
    return (sales.groupBy("channel").agg(F.count(F.lit(1)).alias("transactions"))
            .withColumn("share_pct", round_half_even(F.try_divide(F.col("transactions"), total) * 100.0)))


def category_value_vs_transactions(sales: DataFrame) -> DataFrame:
    """category rank by net vs by number of transactions."""
    per = sales.groupBy("category").agg(money_sum("net").alias("net"),
                                        F.count(F.lit(1)).alias("transactions"))
    return ranked(per, {"net_rank": "net", "transactions_rank": "transactions"}, "category")


def net_skew(sales: DataFrame) -> DataFrame:
    """single-unit share; mean vs median of net; sample skewness."""
    net = F.col("net").cast("double")
    median = quantiles(sales, net, [0.5]).scalar()
    return sales.agg(
        round_half_even(F.avg(false_if_null(F.col("quantity") == 1).cast("double")) * 100.0).alias("single_unit_pct"),
        round_half_even(F.avg("net")).alias("mean_net"),
        round_half_even(F.skewness(net), 4).alias("skewness_net")).select(
        "single_unit_pct", "mean_net", round_half_even(median).alias("median_net"), "skewness_net")
