"""Row numbers and running totals within groups of which one may hold most of a table.

A plain window puts a whole group into one task. Here a group is cut into pieces
of bounded size, numbered or summed up piece by piece, and the pieces' totals are
added in order; only the totals, one row a piece, pass through one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Writes a frame and reads it back.
Land = Callable[[DataFrame], DataFrame]


def numbered(df: DataFrame, keys: list[str], order: list[Column], land: Land, name: str) -> DataFrame:
    """``df`` with a column ``name``: the row's number (from 1) in its group, by ``order``.

    Rows are cut by ranges of (keys, order), so that a large group lies in many
    ranges. A range holds at most one group that has begun in an earlier one, so
    the offsets have no more rows than there are ranges and are broadcast.
    Keys are not null; rows with equal order values have any order among them.
    """
    ranges = land(df.repartitionByRange(*[F.col(k) for k in keys], *order).withColumn("_range", F.spark_partition_id()))
    counts = ranges.groupBy("_range", *keys).agg(F.count("*").alias("_rows"))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.sum("_rows").over(earlier)).filter("_before > 0").drop("_rows")
    within = F.row_number().over(Window.partitionBy("_range", *keys).orderBy(*order))
    out = ranges.withColumn(name, within).join(F.broadcast(offsets), ["_range", *keys], "left")
    return out.withColumn(name, (F.col(name) + F.coalesce("_before", F.lit(0))).cast("long")).drop("_range", "_before")


def running(df: DataFrame, key: str, position: str, totals: dict[str, Callable[[str], Column]], combine: Callable[[Column, Column], Column],
            backwards: bool = False, piece: int = 4096) -> DataFrame:
    """``df`` with each column of ``totals`` replaced by its running aggregate along ``position`` within ``key``.

    ``totals`` maps a column to its aggregate function and ``combine`` joins two
    of its values (sum: addition). ``position`` is a dense number from 0 or 1, unique
    in its key. ``backwards`` aggregates from the end. Groups of at most one piece need
    no second step.
    """
    sign = -1 if backwards else 1
    pieces = df.withColumn("_piece", F.floor(F.col(position) / piece).cast("long"))
    within = Window.partitionBy(key, "_piece").orderBy(F.col(position) * sign).rowsBetween(Window.unboundedPreceding, 0)
    out = pieces
    for column, total in totals.items():
        out = out.withColumn(f"_run_{column}", total(column).over(within))
    large = df.filter(F.col(position) >= piece).select(key).distinct()
    sums = pieces.join(large, key, "left_semi").groupBy(key, "_piece").agg(*[total(c).alias(f"_all_{c}") for c, total in totals.items()])
    before = Window.partitionBy(key).orderBy(F.col("_piece") * sign).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(key, "_piece", *[total(f"_all_{c}").over(before).alias(f"_add_{c}") for c, total in totals.items()])
    out = out.join(offsets, [key, "_piece"], "left")
    for column in totals:
        run, add = F.col(f"_run_{column}"), F.col(f"_add_{column}")
        out = out.withColumn(column, F.when(add.isNull(), run).otherwise(combine(run, add))).drop(f"_run_{column}", f"_add_{column}")
    return out.drop("_piece")
