"""Exact quantiles of any number of groups without a group's values in one task.

A mergeable sketch brackets each wanted rank first; it errs by a stated share of the
ranks, whatever the values are. Values are counted, so repeats cost nothing, and only the distinct
values inside the brackets are ordered: the same small share of a group for an even
distribution and for one with far outliers.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Accuracy of the sketch: it errs by up to 1 / ACCURACY of the ranks (and keeps some values per unit: a few MB a group).
ACCURACY = 65_536
#: Half a bracket's width, as a share of the ranks: the sketch's error, rounding, and as much again for merged sketches.
MARGIN = 3.0 / ACCURACY
#: Groups of up to so many values, whose brackets would be narrower than a few ranks, are ordered whole.
SMALL_GROUP = 4 * ACCURACY


def _same(keys: Sequence[str]) -> Column:
    return functools.reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"{k}b")) for k in keys], F.lit(True))


def _bracketed(values: DataFrame, keys: Sequence[str], probs: Sequence[float]) -> tuple[DataFrame, DataFrame]:
    """The distinct values (_x, _n times) in the bracket of each wanted rank _i, and the number of values below each bracket."""
    counts = values.groupBy(*keys, "_x").agg(F.count(F.lit(1)).alias("_n"))
    marks = sorted({min(max(p + d, 0.0), 1.0) for p in probs for d in (-MARGIN, MARGIN)})
    sketch = values.groupBy(*keys).agg(F.min("_x").alias("_min"), F.max("_x").alias("_max"), F.count(F.lit(1)).alias("_all"),
                                       F.percentile_approx("_x", marks, ACCURACY).alias("_marks"))

    def bracket(p: float) -> Column:
        low, high = p - MARGIN, p + MARGIN
        small = F.col("_all") <= SMALL_GROUP
        return F.struct((F.col("_min") if low <= 0 else F.when(small, F.col("_min")).otherwise(F.col("_marks")[marks.index(low)])).alias("lo"),
                        (F.col("_max") if high >= 1 else F.when(small, F.col("_max")).otherwise(F.col("_marks")[marks.index(high)])).alias("hi"))

    brackets = sketch.select(*[F.col(k).alias(f"{k}b") for k in keys], "_all", F.array(*[bracket(p) for p in probs]).alias("_b"))
    placed = counts.join(brackets, _same(keys)).select(*keys, "_x", "_n", "_all", "_b")
    below = placed.groupBy(*keys).agg(*[F.sum(F.when(F.col("_x") < F.col("_b")[i]["lo"], F.col("_n")).otherwise(0)).alias(f"_below{i}") for i in range(len(probs))])
    below = below.select(*[F.col(k).alias(f"{k}b") for k in keys], F.posexplode(F.array(*[f"_below{i}" for i in range(len(probs))])).alias("_ib", "_below"))

    inside = [F.when(F.col("_x").between(F.col("_b")[i]["lo"], F.col("_b")[i]["hi"]), F.lit(i)) for i in range(len(probs))]
    near = placed.select(*keys, "_x", "_n", "_all", F.explode(F.array_compact(F.array(*inside))).alias("_i"))
    return near, below


def group_quantiles(df: DataFrame, by: Sequence[str], value: Column, probs: Sequence[float]) -> DataFrame:
    """(*by, q0, q1, ...): quantiles with linear interpolation of the non-null values of each group.

    A null key is a group; groups without values have no row.
    """
    by = list(by)
    values = df.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)], value.cast("double").alias("_x")).where("_x IS NOT NULL")
    keys = [f"_k{i}" for i in range(len(by))]
    near, below = _bracketed(values, keys, probs)
    same = _same(keys)
    upto = F.sum("_n").over(Window.partitionBy(*keys, "_i").orderBy("_x"))  # a bracket's distinct values
    place = F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("_i") + 1) * (F.col("_all") - 1)
    ordered = (near.withColumn("_upto", upto).join(below, same & (F.col("_i") == F.col("_ib")))
               .select(*keys, "_i", "_x", place.alias("_place"), (F.col("_below") + F.col("_upto") - F.col("_n")).alias("_from"), (F.col("_below") + F.col("_upto")).alias("_to")))

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("_from")) & (rank < F.col("_to")), F.col("_x")))

    found = ordered.groupBy(*keys, "_i").agg(F.first("_place").alias("_place"), at(F.floor("_place")).alias("_lo"), at(F.ceil("_place")).alias("_hi"))
    part = F.col("_place") - F.floor("_place")
    mixed = F.when(part == 0, F.col("_lo")).otherwise((1 - part) * F.col("_lo") + part * F.col("_hi"))
    outside = F.raise_error(F.lit("a rank lies outside of its bracket: raise MARGIN")).cast("double")
    exact = found.withColumn("_q", F.when(F.col("_lo").isNull() | F.col("_hi").isNull(), outside).otherwise(mixed))
    return exact.groupBy(*keys).agg(*[F.max(F.when(F.col("_i") == i, F.col("_q"))).alias(f"q{i}") for i in range(len(probs))]).select(
        *[F.col(k).alias(c) for k, c in zip(keys, by)], *[f"q{i}" for i in range(len(probs))])


def quantiles(df: DataFrame, value: Column, probs: Sequence[float]) -> DataFrame:
    """One row (q0, q1, ...) over all non-null values; no row without any."""
    return group_quantiles(df.withColumn("_one", F.lit(1)), ["_one"], value, probs).drop("_one")
