"""Placement of rows on shards by a permutation-filled lookup table, in DataFrame functions only.

Each shard has a preference order over the slots of a table of prime size:
offset + k * skip modulo the size, both hashed from its name. The shards take
turns; at its turn a shard claims the slot it likes best of those still free,
until all are taken. So all shards get the same number of slots, give or take
one, and when a shard comes or goes few slots change hands. A row goes to the
shard that holds the slot its key hashes to; the table has a fixed number of
rows, so it is broadcast.

Defined cases: rows without key are placed by their text's hash; repeated rows
go to one shard; an empty table gives none. Other columns are carried along;
columns named slot or shard are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.llm.hashing import hash_number, row_key

#: Default shards, and slots: a prime of more than 100 times the shards keeps loads within one per cent.
SHARDS = tuple(f"shard-{i:02d}" for i in range(16))
SLOTS = 2053
#: The table is filled in steps that each pass over it, and broadcast: it may have at most so many slots.
MOST_SLOTS = 16_411


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def _let(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def lookup_table(spark: SparkSession, shards: Sequence[str] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """(slot, shard) for each slot of the table."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct names, one at least")
    if not _is_prime(slots) or not len(shards) <= slots <= MOST_SLOTS:
        raise ValueError(f"slots must be a prime from the number of shards to {MOST_SLOTS}")
    names = F.array(*[F.lit(s) for s in shards])
    places = F.sequence(F.lit(0), F.lit(slots - 1))

    def order(name: Column) -> Column:
        offset = hash_number(F.concat(F.lit("offset:"), name)) % slots
        skip = hash_number(F.concat(F.lit("skip:"), name)) % (slots - 1) + 1
        return F.transform(places, lambda k: ((offset + k * skip) % slots).cast("int"))

    def turn(owner: Column, t: Column) -> Column:
        shard = (t % len(shards)).cast("int")
        best = F.filter(F.col("orders")[shard], lambda s: owner[s] < 0)[0]
        return _let(best, lambda slot: F.transform(owner, lambda x, s: F.when(s == slot, shard).otherwise(x)))

    # the aggregate over the shards keeps the orders from being computed anew at each turn
    orders = spark.range(len(shards)).select(F.struct("id", order(names[F.col("id").cast("int")]).alias("order")).alias("x"))
    orders = orders.agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["order"]).alias("orders"))
    filled = orders.select(F.aggregate(places, F.array_repeat(F.lit(-1), slots), turn).alias("owner"))
    return filled.select(F.posexplode("owner").alias("slot", "at")).select("slot", names[F.col("at")].alias("shard"))


def place(docs: DataFrame, shards: Sequence[str] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """The rows of ``docs`` with slot and shard."""
    table = F.broadcast(lookup_table(docs.sparkSession, shards, slots))
    rows = docs.drop("slot", "shard")
    return rows.withColumn("slot", (hash_number(row_key()) % slots).cast("int")).join(table, "slot").select(*rows.columns, "slot", "shard")


def write_shards(placed: DataFrame, path: str, tasks_per_shard: int = 4) -> None:
    """Write one folder per shard; a shard is written by several tasks."""
    salt = F.pmod(F.xxhash64(row_key()), F.lit(tasks_per_shard))
    placed.repartition("shard", salt).write.partitionBy("shard").parquet(path)


ORACLE = f"""
WITH RECURSIVE shards AS (
  SELECT i, 'shard-' || lpad(i::VARCHAR, 2, '0') AS name FROM range({len(SHARDS)}) r(i)),
orders AS (
  SELECT i, list(((('0x' || substr(md5('offset:' || name), 1, 13))::BIGINT) % {SLOTS}
         + k * ((('0x' || substr(md5('skip:' || name), 1, 13))::BIGINT) % ({SLOTS} - 1) + 1)) % {SLOTS} ORDER BY k) AS slots
  FROM shards, range({SLOTS}) p(k) GROUP BY i),
turns AS (
  SELECT 0 AS t, []::BIGINT[] AS taken
  UNION ALL
  SELECT t + 1, list_append(taken, list_filter(slots, lambda s: NOT list_contains(taken, s))[1])
  FROM turns JOIN orders ON i = t % {len(SHARDS)} WHERE t < {SLOTS}),
claimed AS (SELECT taken FROM turns WHERE t = {SLOTS}),
owned AS (SELECT unnest(taken) AS slot, unnest(range(len(taken))) AS t FROM claimed)
SELECT doc_id, text, lang, source, n_chars, d.slot, name AS shard
FROM (SELECT *, ((('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'text:' || md5(coalesce(text, '')))), 1, 13))::BIGINT) % {SLOTS})::INTEGER AS slot FROM documents) d
JOIN owned o ON d.slot = o.slot JOIN shards ON i = o.t % {len(SHARDS)}
"""
