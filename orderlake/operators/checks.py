"""Cross-table consistency checks on Bronze.

Each check is one aggregate (or one join + aggregate); set membership is
always a join (semi/anti), never a key list collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderlake.functions.ranking import numbered
from orderlake.functions.semantics import false_if_null, first_by, parse_ts, round_half_even
from orderlake.operators.profile import is_numeric
from orderlake.operators.silver import residual_columns as residual_columns_of
from orderlake.operators.silver import shared_tracking_numbers
from orderlake.sources.landing import scratch


def amount_identities(sales: DataFrame, tolerance: float = 1.0) -> DataFrame:
    """Price x qty = gross; gross x rate = discount; gross - discount = net (± tolerance)."""
    tol = F.lit(tolerance)
    g = false_if_null(F.abs(F.col("unit_price") * F.col("quantity") - F.col("gross")) > tol)
    d = false_if_null(F.abs(F.col("gross") * F.col("discount_rate") - F.col("discount")) > tol)
    n = false_if_null(F.abs(F.col("gross") - F.col("discount") - F.col("net")) > tol)
    return sales.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(g).alias("gross_broken"),
        F.count_if(d).alias("discount_broken"), F.count_if(n).alias("net_broken"),
        round_half_even(F.avg((~(g | d | n)).cast("double")) * 100.0).alias("pct_all_hold"))


def negatives(sales: DataFrame, events: DataFrame) -> DataFrame:
    """Negative numeric cells across both tables."""
    def cnt(df):
        cols = [c for c, t in df.dtypes if is_numeric(t)]
        return sum((F.count_if(false_if_null(F.col(c) < 0)) for c in cols), F.coalesce(F.sum(F.lit(0)), F.lit(0)))
    return sales.agg(cnt(sales).alias("sales_negative_cells")).withColumn(
        "events_negative_cells", events.agg(cnt(events)).scalar()).withColumn(
        "negative_cells", F.col("sales_negative_cells") + F.col("events_negative_cells"))


def referential(sales: DataFrame, events: DataFrame) -> DataFrame:
    """Sales without events; event orders without a sale (anti joins)."""
    ev_orders = events.select("order_id").distinct()
    sa_orders = sales.select("order_id").distinct()
    return sales.join(ev_orders, "order_id", "left_anti").agg(F.count(F.lit(1)).alias("sales_without_events")) \
        .withColumn("event_orders_without_sale",
                    ev_orders.join(sa_orders, "order_id", "left_anti").agg(F.count(F.lit(1))).scalar())


def city_mismatch(sales: DataFrame, events: DataFrame) -> DataFrame:
    """Orders whose first non-null destination differs from the sale city
    (a missing sale counts as a mismatch)."""
    dest = (events.where(F.col("dest_city").isNotNull()).groupBy("order_id")
            .agg(first_by("dest_city", "event_id", "dest_city").alias("dest_city")))
    city = sales.groupBy("order_id").agg(F.min("city").alias("city"))
    return (dest.join(city, "order_id", "left")
            .agg(F.count_if(~F.col("city").eqNullSafe(F.col("dest_city"))).alias("orders_with_other_city")))


def events_per_order(events: DataFrame) -> DataFrame:
    """Min, max and mode (smallest on ties) of events per order."""
    per = events.groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.min("n").alias("min_events"), F.max("n").alias("max_events"),
                   F.mode("n", deterministic=True).alias("mode_events"))


def incomplete_trace(events: DataFrame) -> DataFrame:
    """Orders that miss at least one state seen in the data."""
    n_all = events.agg(F.count_distinct("state")).scalar()
    per = events.groupBy("order_id").agg(F.count_distinct("state").alias("n"))
    return per.agg(F.count_if(F.col("n") < n_all).alias("incomplete_orders"),
                   F.count(F.lit(1)).alias("orders"))


def constant_in_group(events: DataFrame, col: str = "ship_cost") -> DataFrame:
    """Orders where ``col`` is constant (min = max, no distinct needed)."""
    per = events.groupBy("order_id").agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
    return per.agg(F.count_if(F.col("lo") == F.col("hi")).alias("constant_orders"),
                   F.count(F.lit(1)).alias("orders"))


def shared_tracking(events: DataFrame) -> DataFrame:
    """Tracking numbers used by more than one order."""
    return shared_tracking_numbers(events)


def unparseable_dates(events: DataFrame) -> DataFrame:
    """Text dates that do not parse (non-null in, null out)."""
    cols = [c for c in events.columns if c.endswith("_ts_txt")]
    return events.agg(*[F.count_if(F.col(c).isNotNull() & parse_ts(c).isNull()).alias(f"{c}_unparseable")
                        for c in cols])


def residual_values(events: DataFrame) -> DataFrame:
    """Every value of every residual column with its frequency, one row each
    (no rows where the source has no residual column, or nothing in it)."""
    res = residual_columns_of(events)
    if not res:
        return events.sparkSession.createDataFrame([], "column string, value string, n bigint")
    long = events.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in res])).alias("r")
    ).select("r.*")
    return long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def residual_columns(events: DataFrame) -> DataFrame:
    """Every residual column (also when it holds no value) with its number of distinct values."""
    res = residual_columns_of(events)
    if not res:
        return events.sparkSession.createDataFrame([], "column string, distinct_values bigint")
    one = events.agg(*[F.count_distinct(F.col(c)).alias(c) for c in res])
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("distinct_values")) for c in res])).alias("r")
    ).select("r.*")


def _timeline(sales: DataFrame, events: DataFrame) -> DataFrame:
    """Events with parsed dates joined (left) to the sale date, as the reference merges."""
    ev = events.select("order_id", "event_id", "state", "event_ts_txt",
                       parse_ts("event_ts_txt").alias("event_ts"), parse_ts("promised_ts_txt").alias("promised_ts"))
    return ev.join(sales.select("order_id", "sale_ts"), "order_id", "left")


def event_before_sale(sales: DataFrame, events: DataFrame) -> DataFrame:
    """Events dated before their sale."""
    return _timeline(sales, events).agg(
        F.count_if(false_if_null(F.col("event_ts") < F.col("sale_ts"))).alias("events_before_sale"))


def promise_before_sale(sales: DataFrame, events: DataFrame) -> DataFrame:
    """Orders whose promised date <= sale date, judged on the first event row."""
    t = _timeline(sales, events)
    key = F.struct("event_id", "state", "event_ts_txt", "promised_ts", "sale_ts")
    first = t.groupBy("order_id").agg(F.min(F.struct(key.alias("k"), F.col("promised_ts").alias("p"),
                                                     F.col("sale_ts").alias("s"))).alias("f"))
    return first.agg(F.count_if(false_if_null(F.col("f.p") <= F.col("f.s"))).alias("orders_promise_before_sale"))


def out_of_order(events: DataFrame, block: int = 4096) -> DataFrame:
    """Orders whose dated events go back in time in event-id order.

    An order of at most ``block`` events is compared as it is. The events of a larger one are numbered
    (``functions.ranking``, no task needs them all, however sparse their ids are) and cut into blocks of that many.
    A step back lies within a block, or between blocks: then an earlier block's latest time is after a later
    block's earliest.
    """
    ev = (events.select("order_id", "event_id", parse_ts("event_ts_txt").alias("ts"))
          .where(F.col("ts").isNotNull() & F.col("order_id").isNotNull()))
    large = scratch(ev.groupBy("order_id").count().where(F.col("count") > block).select("order_id"))
    if large.isEmpty():
        cut = ev.withColumn("_block", F.lit(0).cast("long"))
    else:
        hot = numbered(ev.join(large, "order_id", "left_semi"), ["order_id"], [F.col("event_id"), F.col("ts")], scratch, "_at")
        cut = (ev.join(large, "order_id", "left_anti").withColumn("_block", F.lit(0).cast("long"))
               .unionByName(hot.withColumn("_block", F.floor((F.col("_at") - 1) / block).cast("long")).drop("_at")))
    return blocks_out_of_order(cut).agg(F.count_distinct("order_id").alias("orders_out_of_order"))


def blocks_out_of_order(cut: DataFrame) -> DataFrame:
    """(order_id, _block) that go back in time, within themselves or against an earlier block."""
    inside = Window.partitionBy("order_id", "_block").orderBy("event_id", "ts")
    per = (cut.withColumn("_back", F.col("ts") < F.lag("ts").over(inside))
           .groupBy("order_id", "_block").agg(F.max("_back").alias("_back"), F.min("ts").alias("_lo"), F.max("ts").alias("_hi")))
    earlier = Window.partitionBy("order_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    steps = per.withColumn("_back", F.coalesce("_back", F.lit(False)) | F.coalesce(F.col("_lo") < F.max("_hi").over(earlier), F.lit(False)))
    return steps.where("_back").select("order_id", "_block")


def first_state_distribution(events: DataFrame) -> DataFrame:
    """Distribution of the first (non-null) state per order."""
    first = events.groupBy("order_id").agg(first_by("state", "event_id", "state").alias("first_state"))
    return first.where(F.col("first_state").isNotNull()).groupBy("first_state").agg(
        F.count(F.lit(1)).alias("orders"))
