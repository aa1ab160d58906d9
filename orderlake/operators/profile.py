"""Profiling of Bronze tables, nothing is modified.

Many-column statistics are computed by unpivoting to (column, value) and
aggregating by column: one shuffle whose width does not grow with the number
of columns, instead of one ``count(distinct)`` per column (which Spark plans
as an ``Expand`` multiplying every row by the number of columns).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.functions.quantiles import group_quantiles, quantiles
from orderlake.functions.semantics import clean_text, false_if_null, in_list, parse_ts, round_half_even
from orderlake.schemas import (AMOUNT, CATEGORICAL, CATEGORY, DATE, DURATION, IDENTIFIER, MEASURE, NUMERIC, RESIDUAL,
                               SCALE, TABLES)

NUMERIC_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double")
INTEGER_TYPES = NUMERIC_TYPES[:4]


def is_numeric(dtype: str) -> bool:
    return dtype in NUMERIC_TYPES or dtype.startswith("decimal")


def _explode_structs(one: DataFrame, structs: list, schema: str) -> DataFrame:
    """One row per struct computed from a one-row frame; an empty typed frame without structs."""
    if not structs:
        return one.sparkSession.createDataFrame([], schema)
    return one.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def _as_ts(df: DataFrame, c: str):
    return F.col(c) if dict(df.dtypes)[c].startswith("timestamp") else parse_ts(c)


def date_range(df: DataFrame, table: str) -> DataFrame:
    """min/max of every date column (text coerced) in one aggregate."""
    cols = TABLES[table].having(df.columns, DATE)
    aggs = []
    for c in cols:
        aggs += [F.min(_as_ts(df, c)).alias(f"{c}__min"), F.max(_as_ts(df, c)).alias(f"{c}__max")]
    one = df.agg(*aggs)
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(table).alias("tbl"), F.lit(c).alias("column"),
                 F.col(f"{c}__min").alias("min_ts"), F.col(f"{c}__max").alias("max_ts")) for c in cols])).alias("r")
    ).select("r.*")


def structure(df: DataFrame, table: str) -> DataFrame:
    """B4 + B5: type, non-null count, nulls, % null and role of every column, one pass."""
    role = TABLES[table].role if table in TABLES else (lambda c: "")
    one = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count(F.col(c)).alias(c) for c in df.columns])
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(table).alias("tbl"), F.lit(c).alias("column"), F.lit(t).alias("type"),
                 F.col(c).alias("non_null"), (F.col("__rows") - F.col(c)).alias("nulls"),
                 round_half_even(F.try_divide((F.col("__rows") - F.col(c)) * 100.0, F.col("__rows")))
                 .alias("pct_null"), F.lit(role(c)).alias("role"))
        for c, t in df.dtypes])).alias("r")).select("r.*")


def _long_strings(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Unpivot ``cols`` to (column, value as string); NULL values are kept."""
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])).alias("r")
    ).select("r.*")


def cardinality(df: DataFrame, table: str) -> DataFrame:
    """Distinct values per column, % of rows and a verdict by role.

    Two-level aggregate over the unpivoted values: (column, value) partial
    counts, then per column — no ``Expand``.
    """
    declared = TABLES[table]
    total = df.agg(F.count(F.lit(1))).scalar()
    per_value = _long_strings(df, df.columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    per_col = per_value.groupBy("column").agg(
        F.count("value").alias("distinct"),
        F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)).alias("non_null"))
    role = F.create_map(*[x for c in df.columns for x in (F.lit(c), F.lit(declared.role(c)))])[F.col("column")]
    d, nn = F.col("distinct"), F.col("non_null")
    return (per_col.withColumn("role", role)
            .withColumn("pct_of_rows", round_half_even(F.try_divide(F.col("distinct") * 100.0, total)))
            .withColumn("verdict", _banded(F.col("role"), {"values": d, "share": F.try_divide(d.cast("double"), nn)}))
            .withColumn("rows_per_value", round_half_even(F.try_divide(nn.cast("double"), d), 1))
            .select(F.lit(table).alias("tbl"), "column", "role", "distinct", "non_null", "pct_of_rows",
                    "rows_per_value", "verdict"))


# Thresholds of the cardinality verdicts. Per role: the measure that is
# banded, the bands (smallest value of the measure, verdict), highest first; the last one is open.
CARDINALITY_BANDS = {
    IDENTIFIER: ("share", ((1.0, "unique identifier"), (0.4, "identifier with repeats (high cardinality)"),
                           (None, "repeating key"))),
    CATEGORY: ("values", ((51, "high cardinality"), (11, "medium cardinality"), (None, "low cardinality"))),
    SCALE: ("values", ((51, "high cardinality"), (11, "medium cardinality"), (None, "low cardinality"))),
    DATE: ("share", ((0.5 + 1e-12, "date (almost unique per row)"), (None, "repeating date"))),
    RESIDUAL: ("values", ((None, "no useful information"),)),
    AMOUNT: ("values", ((13, "continuous numeric"), (None, "discrete numeric"))),
    MEASURE: ("values", ((13, "continuous numeric"), (None, "discrete numeric"))),
    DURATION: ("values", ((13, "continuous numeric"), (None, "discrete numeric"))),
}


def _banded(role: Column, measures: dict[str, Column]) -> Column:
    """The label of the first band, from above, that the role's measure reaches."""
    verdict = F.lit(None).cast("string")
    for name, (measure, bands) in CARDINALITY_BANDS.items():
        label = F.lit(bands[-1][1])
        for least, text in reversed(bands[:-1]):
            label = F.when(measures[measure] >= F.lit(least), F.lit(text)).otherwise(label)
        verdict = F.when(role == F.lit(name), label).otherwise(verdict)
    return verdict


def _long_numbers(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in cols])).alias("r")
    ).select("r.*")


def numeric_summary(df: DataFrame, table: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, std (n-1), min, exact quartiles (linear interpolation), max."""
    cols = list(cols) if cols is not None else TABLES[table].having(df.columns, *NUMERIC)
    long = _long_numbers(df, cols)
    stats = long.groupBy("column").agg(
        F.count("x").alias("count"), round_half_even(F.avg("x")).alias("mean"),
        round_half_even(F.stddev_samp("x")).alias("std"), F.min("x").alias("min"), F.max("x").alias("max"))
    quart = group_quantiles(long, ["column"], F.col("x"), [0.25, 0.5, 0.75])
    return stats.join(quart, "column", "left").select(
        F.lit(table).alias("tbl"), "column", "count", "mean", "std", "min", round_half_even("q0").alias("p25"),
        round_half_even("q1").alias("median"), round_half_even("q2").alias("p75"), "max")


def _frequencies(df: DataFrame, table: str) -> DataFrame:
    cols = TABLES[table].having(df.columns, *CATEGORICAL)
    return (_long_strings(df, cols).where(F.col("value").isNotNull())
            .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))


def categorical_summary(df: DataFrame, table: str) -> DataFrame:
    """Distinct, most frequent value (ties: smallest), its frequency and share of non-nulls."""
    rank_key = F.struct((-F.col("n")).alias("neg_n"), F.col("value").alias("v"))
    return (_frequencies(df, table).groupBy("column").agg(
        F.count(F.lit(1)).alias("distinct"),
        F.min_by("value", rank_key).alias("top_value"),
        F.max("n").alias("top_freq"),
        F.sum("n").alias("non_null"))
        .select(F.lit(table).alias("tbl"), "column", "distinct", "top_value", "top_freq",
                round_half_even(F.try_divide(F.col("top_freq") * 100.0, F.col("non_null"))).alias("top_pct")))


def categorical_values(df: DataFrame, table: str) -> DataFrame:
    """Every value of every categorical column with its frequency, one row each."""
    return _frequencies(df, table).select(F.lit(table).alias("tbl"), "column", "value", "n")


def frequency(df: DataFrame, col: str) -> DataFrame:
    """Value counts with share of all rows (nulls dropped, pandas ``value_counts``)."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return (df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value"))
            .agg(F.count(F.lit(1)).alias("count"))
            .withColumn("share_pct", round_half_even(F.try_divide(F.col("count") * 100.0, total))))


def once_per_order(events: DataFrame, col: str) -> DataFrame:
    """A value repeated on every event, taken once per order (first by event)."""
    from orderlake.functions.semantics import first_by
    per_order = events.groupBy("order_id").agg(first_by(col, "event_id", col).alias(col))
    return numeric_summary(per_order, "orders", [col])


def conditional_nulls(sales: DataFrame, events: DataFrame, physical_channel: str,
                      transport_states: Sequence[str]) -> DataFrame:
    """Nulls of a column inside vs outside a condition (evidence for a verdict)."""
    phys = F.col("channel") == F.lit(physical_channel)
    transport = in_list("state", transport_states)
    s = sales.agg(
        F.count_if(phys & F.col("store_id").isNull()).alias("store_in"), F.count_if(phys).alias("rows_in"),
        F.count_if(~false_if_null(phys) & F.col("store_id").isNull()).alias("store_out"),
        F.count_if(~false_if_null(phys)).alias("rows_out"))
    e = events.agg(
        F.count_if(~transport & F.col("carrier").isNull()).alias("car_pre"),
        F.count_if(~transport & F.col("tracking_no").isNull()).alias("trk_pre"),
        F.count_if(~transport).alias("pre"),
        F.count_if(transport & F.col("carrier").isNull()).alias("car_tr"),
        F.count_if(transport & F.col("tracking_no").isNull()).alias("trk_tr"),
        F.count_if(transport).alias("tr"),
        F.count_if(F.col("note").isNotNull() & F.col("incident").isNull()).alias("note_wo_inc"),
        F.count_if(F.col("note").isNotNull()).alias("notes"))

    def row(check, a, b, c, d, verdict):
        return F.struct(F.lit(check).alias("check"), a.cast("bigint").alias("nulls_inside"),
                        b.cast("bigint").alias("rows_inside"), c.cast("bigint").alias("nulls_outside"),
                        d.cast("bigint").alias("rows_outside"), verdict.alias("verdict"))
    sc = {k: F.col(k) for k in s.columns}
    both = e.select(F.struct(*e.columns).alias("_e")).scalar()
    ec = {k: F.col("_e")[k] for k in e.columns}
    return s.withColumn("_e", both).select(F.explode(F.array(
        row("store_id null by physical channel", sc["store_in"], sc["rows_in"], sc["store_out"], sc["rows_out"],
            F.when(sc["store_in"] == 0, "normal").otherwise("problem")),
        row("carrier null before dispatch / in transport", ec["car_pre"], ec["pre"], ec["car_tr"], ec["tr"],
            F.when(ec["car_tr"] == 0, "normal").otherwise("problem")),
        row("tracking_no null before dispatch / in transport", ec["trk_pre"], ec["pre"], ec["trk_tr"], ec["tr"],
            F.when(ec["trk_tr"] == 0, "normal").otherwise("problem")),
        row("note present without incident", ec["note_wo_inc"], ec["notes"], F.lit(0), F.lit(0), F.lit("normal")),
    )).alias("r")).select("r.*")


def nulls_by_state(events: DataFrame, col: str = "stage_hours") -> DataFrame:
    """Where the nulls of ``col`` are, by state."""
    return (events.where(F.col(col).isNull()).groupBy("state")
            .agg(F.count(F.lit(1)).alias("nulls")))


def standardize_impact(df: DataFrame, table: str, cols: Sequence[str], fold_accents: bool = False) -> DataFrame:
    """Cells changed by whitespace cleaning; columns whose lower-cased clean
    values collapse (spelling variants). With ``fold_accents`` values that differ in accents alone
    collapse too, by Spark's Unicode collation (S32).

    Cells are counted by value, values by clean form, and these by column: three partial
    aggregates, no ``Expand`` for the two distinct counts.
    """
    long = _long_strings(df, cols).where(F.col("value").isNotNull())
    values = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("_cells"))
    clean = F.lower(clean_text(F.col("value")))
    form = F.collate(clean, "UNICODE_CI_AI") if fold_accents else clean
    changed = F.when(clean_text(F.col("value")) != F.col("value"), F.col("_cells")).otherwise(0)
    forms = (values.select("column", form.alias("_form"), changed.alias("_changed"))
             .groupBy("column", "_form").agg(F.sum("_changed").alias("_changed"), F.count(F.lit(1)).alias("_raw")))
    return (forms.groupBy("column").agg(
        F.sum("_changed").alias("changed_cells"), F.sum("_raw").alias("distinct_raw"), F.count(F.lit(1)).alias("distinct_clean_lower"))
        .withColumn("has_variants", F.col("distinct_clean_lower") < F.col("distinct_raw"))
        .select(F.lit(table).alias("tbl"), "*"))


def conflict_diff_columns(events: DataFrame, key: str = "event_id") -> DataFrame:
    """For keys with several distinct versions, the columns that differ."""
    distinct = events.dropDuplicates()
    conflicted = (distinct.groupBy(key).agg(F.count(F.lit(1)).alias("_v")).where("_v > 1").select(key))
    rows = distinct.join(conflicted, key, "left_semi")
    others = [c for c in events.columns if c != key]
    long = rows.select(key, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c).cast("string"), F.lit("\u0000")).alias("value"))
        for c in others])).alias("r")).select(key, "r.*")
    diff = (long.groupBy(key, "column").agg(F.count_distinct("value").alias("_d")).where("_d > 1"))
    return diff.groupBy(key).agg(F.array_join(F.sort_array(F.collect_list("column")), ", ").alias("columns"))


def histogram(df: DataFrame, col: str, bins: int = 20) -> DataFrame:
    """Equal-width histogram between min and max (max falls in the last bin; a constant column has one bin)."""
    x = F.col(col).cast("double")
    ends = df.agg(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi")).alias("e")).scalar()
    lo, width = ends["lo"], (ends["hi"] - ends["lo"])
    b = F.least(F.coalesce(F.floor(F.try_divide(x - lo, width) * bins), F.lit(0)), F.lit(bins - 1)).cast("int")
    return (df.where(F.col(col).isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
            .withColumn("lower", round_half_even(lo + F.col("bin") * width / bins))
            .withColumn("upper", round_half_even(lo + (F.col("bin") + 1) * width / bins)))


def boxplot(df: DataFrame, col: str) -> DataFrame:
    """Exact quartiles, 1.5 x IQR fences and the outlier count."""
    x = F.col(col).cast("double")
    q = quantiles(df, x, [0.25, 0.5, 0.75]).select(F.struct("q0", "q1", "q2").alias("q")).scalar()
    iqr = q["q2"] - q["q0"]
    lo, hi = q["q0"] - iqr * 1.5, q["q2"] + iqr * 1.5
    stats = df.agg(F.count_if((x < lo) | (x > hi)).alias("outliers"), F.count(x).alias("count"))
    return stats.select(
        round_half_even(q["q0"]).alias("q1"), round_half_even(q["q1"]).alias("median"), round_half_even(q["q2"]).alias("q3"),
        round_half_even(lo).alias("lower_fence"), round_half_even(hi).alias("upper_fence"), "outliers", "count")


# What cleaning does about the nulls of a column.
NULL_STRATEGY = {
    **dict.fromkeys(("incident", "note"), "explicit category"),
    **dict.fromkeys(("carrier", "tracking_no"), "value of the order, in transport states only"),
    **dict.fromkeys(("center", "dest_city", "promised_ts"), "value of the order"),
    **dict.fromkeys(("stage_hours", "event_ts", "store_id", "rating"), "kept null"),
}
# What the nulls of a column say.
NULL_VERDICT = {
    **dict.fromkeys(("store_id", "rating", "stage_hours", "incident", "note"), "normal"),
    **dict.fromkeys(("carrier", "tracking_no"), "normal before dispatch, a problem in transport"),
    **dict.fromkeys(("center", "dest_city", "promised_ts_txt", "event_ts_txt"), "problem"),
}


def _lookup(words: dict[str, str], column: str = "column") -> Column:
    return F.create_map(*[F.lit(x) for pair in words.items() for x in pair])[F.col(column)]


def null_findings(df: DataFrame, table: str) -> DataFrame:
    """Every column with nulls, their number, and what they say; nulls of a residual
    column say that it does not belong to the model."""
    found = structure(df, table).where("nulls > 0 OR role = 'residual'")
    verdict = F.when(F.col("role") == RESIDUAL, F.lit("problem (residual column)")).otherwise(
        F.coalesce(_lookup(NULL_VERDICT), F.lit("unexplained")))
    return found.select("tbl", "column", (F.col("non_null") + F.col("nulls")).alias("rows"), "nulls", verdict.alias("verdict"))


def null_before_after(bronze: DataFrame, silver: DataFrame, table: str, rename: dict[str, str] | None = None) -> DataFrame:
    """Nulls per column in Bronze vs Silver, joined on the (Silver) column name, and what
    was done about them."""
    rename = rename or {}
    b = structure(bronze, "bronze").select(
        F.coalesce(_lookup(rename) if rename else F.lit(None), F.col("column")).alias("column"),
        F.col("nulls").alias("nulls_bronze"))
    s = structure(silver, "silver").select("column", F.col("nulls").alias("nulls_silver"))
    return b.join(s, "column", "full").select(
        F.lit(table).alias("tbl"), "column", "nulls_bronze", "nulls_silver",
        F.when(F.col("nulls_silver").isNull(), F.lit("column dropped")).otherwise(_lookup(NULL_STRATEGY)).alias("strategy"))


def conditional_presence(sales: DataFrame, physical_channel: str) -> DataFrame:
    """Store id null exactly when the channel is not physical."""
    phys = false_if_null(F.col("channel") == F.lit(physical_channel))
    return sales.agg(
        F.coalesce(F.bool_and(F.when(~phys, F.col("store_id").isNull())), F.lit(True)).alias("null_outside"),
        F.coalesce(F.bool_and(F.when(phys, F.col("store_id").isNotNull())), F.lit(True)).alias("present_inside")
    ).withColumn("exact", F.col("null_outside") & F.col("present_inside"))


def _extra(counts: DataFrame, name: str) -> DataFrame:
    """Rows beyond the first of each group, from a frame of group sizes ``_n``."""
    return counts.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias(name))


def duplicates(sales: DataFrame, events: DataFrame) -> DataFrame:
    """Identical rows, repeated keys (NULL is one value), and repeated event ids
    split into "identical row" vs "different content" (an id with any identical
    pair counts as identical), plus shared tracking numbers.

    Each fact is one partially aggregated count by its key; what identical rows
    and event ids need comes from one count of whole rows."""
    from orderlake.operators.silver import shared_tracking_numbers

    def sizes(df: DataFrame, *keys: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))

    per_id = sizes(events, *events.columns).groupBy("event_id").agg(
        F.sum("_n").alias("_n"), F.max("_n").alias("_most"), F.sum(F.col("_n") - 1).alias("_same"))
    ids = per_id.agg(
        F.coalesce(F.sum("_same"), F.lit(0)).alias("events_duplicate_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("events_event_id_repeated"),
        F.count_if((F.col("_n") > 1) & (F.col("_most") > 1)).alias("events_event_id_repeated_identical"),
        F.count_if((F.col("_n") > 1) & (F.col("_most") == 1)).alias("events_event_id_repeated_different"))
    names = ["sales_duplicate_rows", "sales_sale_id_repeated", "sales_order_id_repeated", "events_duplicate_rows",
             "events_event_id_repeated", "events_event_id_repeated_identical", "events_event_id_repeated_different",
             "events_order_id_repeated", "shared_tracking_numbers"]
    others = {"sales_duplicate_rows": _extra(sizes(sales, *sales.columns), "v"),
              "sales_sale_id_repeated": _extra(sizes(sales, "sale_id"), "v"),
              "sales_order_id_repeated": _extra(sizes(sales, "order_id"), "v"),
              "events_order_id_repeated": _extra(sizes(events, "order_id"), "v"),
              "shared_tracking_numbers": shared_tracking_numbers(events).agg(F.count(F.lit(1)).alias("v"))}
    return ids.withColumns({k: v.scalar() for k, v in others.items()}).select(*names)


# Per role, the kinds of type that fit it, and the words for a fit and a misfit.
TYPE_FITS = {
    IDENTIFIER: (("number", "integer", "text"), "OK: {kind} key", ""),
    DATE: (("timestamp",), "OK (timestamp)", "REVIEW: date stored as {type}, convert to timestamp"),
    AMOUNT: (("number", "integer"), "OK (numeric amount)", "REVIEW: amount not numeric"),
    MEASURE: (("number", "integer"), "OK (numeric)", "REVIEW: should be numeric"),
    DURATION: (("number", "integer"), "OK: duration in hours", "REVIEW: duration not numeric"),
    SCALE: (("integer",), "OK (integer scale)", "REVIEW: integer scale stored as {type}"),
    CATEGORY: (("text",), "OK (text)", "REVIEW: category stored as {type}"),
    RESIDUAL: ((), "", "REVIEW: drop (not part of the data model)"),
}


def type_kind(dtype: str) -> str:
    kinds = {"integer": dtype in INTEGER_TYPES, "number": is_numeric(dtype), "timestamp": dtype.startswith("timestamp")}
    return next((k for k, holds in kinds.items() if holds), "text")


def type_check(df: DataFrame, table: str) -> DataFrame:
    """Does each column's type fit its declared role, plus evidence: the share of
    non-null text values of date columns that parse as timestamps (one aggregate)."""
    declared = TABLES[table]
    txt_dates = [c for c, t in df.dtypes if declared.role(c) == DATE and t == "string"]
    one = df.agg(F.lit(1).alias("_one"), *[
        round_half_even(F.try_divide(F.count(parse_ts(c)) * 100.0, F.count(F.col(c)))).alias(f"{c}__pct")
        for c in txt_dates])

    def verdict(c: str, t: str) -> str:
        fits, good, bad = TYPE_FITS[declared.role(c)]
        return (good if type_kind(t) in fits else bad).format(kind=type_kind(t), type=t)

    return one.select(F.explode(F.array(*[
        F.struct(F.lit(table).alias("tbl"), F.lit(c).alias("column"), F.lit(t).alias("type"),
                 F.lit(declared.role(c)).alias("role"), F.lit(verdict(c, t)).alias("verdict"),
                 (F.col(f"{c}__pct") if c in txt_dates else F.lit(None).cast("double")).alias("parseable_pct"))
        for c, t in df.dtypes])).alias("r")).select("r.*")
