"""Mixing sources to target weights by Poisson replication, in DataFrame functions only.

Each source has a mean repetition rate: its share of the target mix times the
target size, divided by its rows. A document's number of copies inverts the
Poisson distribution with that mean at a fraction hashed from seed and doc_id,
so that it is the same at every run, on any partitioning, and after a task is
repeated. Copies are exploded and dealt out over all partitions by a hash, in
hash order.

Defined cases: a null source is a source of its own; rows without doc_id take
their fraction from their text; repeated rows are replicated each for
themselves, with the same number; sources without weight in ``weights`` get
weight 1, weight 0 removes a source; an empty table gives none. Other columns
are carried along; columns named like the added ones are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import land, sized
from orderlake.llm.hashing import hash_fraction, row_key

SEED = "mix-1"
#: A table of up to so many sources (some hundred bytes each) is broadcast.
BROADCAST_SOURCES = 20_000
#: Without explicit weights a source weighs its rows to this power: large sources are damped.
TEMPERATURE = 0.5


def _poisson_steps(rate: Column) -> Column:
    """The distribution function of Poisson(rate) at 0, 1, ... as an array, up to a negligible tail.

    Summed from logarithms of the probabilities, which don't underflow at large rates.
    """
    last = F.ceil(rate + 12 * F.sqrt(rate) + 40).cast("int")
    start = F.struct((-rate).alias("log_p"), F.exp(-rate).alias("total"), F.array(F.exp(-rate)).alias("steps"))

    def step(acc: Column, k: Column) -> Column:
        log_p = acc["log_p"] + F.ln(rate) - F.ln(k)
        total = acc["total"] + F.exp(log_p)
        return F.struct(log_p.alias("log_p"), total.alias("total"), F.concat(acc["steps"], F.array(total)).alias("steps"))

    steps = F.aggregate(F.sequence(F.lit(1), last), start, step, lambda acc: acc["steps"])
    return F.when(rate > 0, steps).otherwise(F.array(F.lit(1.0)))


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, target_rows: int | None = None, source: str = "source") -> DataFrame:
    """(source, n_rows, rate): the mean number of copies of each source's documents."""
    per = docs.groupBy(F.col(source).alias("source")).agg(F.count("*").alias("n_rows"))
    if weights is None:
        weight = F.pow(F.col("n_rows").cast("double"), F.lit(TEMPERATURE))
    else:
        known = F.create_map(*[F.lit(x) for pair in weights.items() for x in (pair[0], float(pair[1]))])
        weight = F.coalesce(known[F.col("source")], F.lit(1.0)) if weights else F.lit(1.0)
    per = per.withColumn("weight", weight)
    all_ = per.agg(F.sum("weight").alias("w"), F.sum("n_rows").alias("n"))
    size = F.lit(target_rows) if target_rows is not None else all_.select("n").scalar()
    return per.select("source", "n_rows", F.coalesce(F.try_divide(F.col("weight") * size, all_.select("w").scalar() * F.col("n_rows")), F.lit(0.0)).alias("rate"))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, target_rows: int | None = None, seed: str = SEED, source: str = "source") -> DataFrame:
    """The rows of ``docs``, each as often as its number of copies says, shuffled globally.

    Adds n_copies, copy (from 1) and shuffle_key. The table of sources is
    written first: if it has few rows it is broadcast, so that the texts are
    shuffled once; else it is joined by source, and since both sides are
    shuffled for that join, a source of very many rows can be split.
    """
    mark = "_"
    while any(c.lower().startswith(mark) for c in docs.columns):
        mark += "_"  # so that no column of docs is named like one used here
    key, of_source, steps, fraction = (f"{mark}{name}" for name in ("key", "source", "steps", "fraction"))
    rates = land(source_rates(docs, weights, target_rows, source).select(F.col("source").alias(of_source), _poisson_steps(F.col("rate")).alias(steps)), "rates")
    rates = sized(rates, BROADCAST_SOURCES)
    keyed = docs.drop("n_copies", "copy", "shuffle_key").withColumn(key, row_key())
    joined = keyed.join(rates, F.col(source).eqNullSafe(F.col(of_source)))
    drawn = hash_fraction(F.concat(F.lit(f"{seed}:"), F.col(key)))
    counted = joined.withColumn(fraction, drawn).withColumn("n_copies", F.size(F.filter(steps, lambda s: s <= F.col(fraction))).cast("long"))
    copies = counted.filter("n_copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_copies"))))
    keyed = copies.withColumn("shuffle_key", F.md5(F.concat(F.lit(f"{seed}:"), F.col(key), F.lit(":"), F.col("copy").cast("string")).cast("binary")))
    return keyed.drop(key, of_source, steps, fraction).repartition("shuffle_key").sortWithinPartitions("shuffle_key")


ORACLE = f"""
WITH rates AS (
  SELECT source, n_rows, weight * sum(n_rows) OVER () / (sum(weight) OVER () * n_rows) AS rate
  FROM (SELECT source, count(*) AS n_rows, pow(count(*)::DOUBLE, {TEMPERATURE}) AS weight FROM documents GROUP BY source)),
steps AS (
  SELECT source, list(p ORDER BY k) AS steps FROM (
    SELECT source, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS p
    FROM (SELECT source, rate, unnest(generate_series(0, ceil(rate + 12 * sqrt(rate) + 40)::BIGINT)) AS k FROM rates))
  GROUP BY source),
keyed AS (
  SELECT *, coalesce(doc_id::VARCHAR, 'text:' || md5(coalesce(text, ''))) AS row_key FROM documents),
counted AS (
  SELECT d.*, len(list_filter(steps, lambda s: s <= (('0x' || substr(md5('{SEED}:' || row_key), 1, 13))::BIGINT) / 4503599627370496.0)) AS n_copies
  FROM keyed d JOIN steps s ON d.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, text, lang, source, n_chars, n_copies, copy, md5('{SEED}:' || row_key || ':' || copy::VARCHAR) AS shuffle_key
FROM (SELECT *, unnest(generate_series(1, n_copies)) AS copy FROM counted WHERE n_copies > 0)
"""
