"""Conversation prefix trie by collapsing whole sequences.

Texts are read once and turned into digests and lengths; no text is shuffled.
Turns are numbered, conversations rebuilt, and each prefix gets a 128-bit key: the
exclusive or of hashes of (position, turn) over its turns, a running aggregate.
Identical rebuilt conversations collapse into one weighted sequence with its list of
ends. Sequences that are proper prefixes of others drop out by an anti-join; the
others are the leaves. Weights, leaves and savings are then sums over the
prefixes of the distinct sequences.

Defined cases: rows without conv_id are no part of any conversation. Turns with
equal (or no) number are ordered by role, then by the digest of role and text; a
repeated row is a turn of its own. An empty table gives no rows. Columns beyond
conv_id, turn, role and text are ignored. A conversation of any length is numbered
and summed up in pieces; SHA-256 of a list of ends is serial, so one node's ends
pass through one task, sorted by Spark and read as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.functions.ranking import numbered, running
from orderlake.llm.common import arrow, land

#: Conversations that share a first one, most turns taken from it (crc32 modulo this).
FAMILY, MOST_SHARED = 100, 6
NO_ENDS = hashlib.sha256(b"").hexdigest()
KEY = ["depth", "k1", "k2"]


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, r, digest, chars): the turns by number, texts replaced by a digest and a length."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), digest.alias("digest"), F.char_length(text).cast("long").alias("chars")
    )
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    return numbered(rows, ["conv_id"], order, lambda df: land(df, "turns"), "r").select("conv_id", "r", "digest", "chars")


def rebuild(ranked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id) of every conversation, and the turns (conv_id, depth, digest, chars) of the rebuilt ones."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_SHARED
    sizes = land(ranked.groupBy("conv_id").agg(F.max("r").alias("n")), "sizes")
    first = sizes.filter(f"conv_id % {FAMILY} = 0").select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    plans = sizes.select("conv_id", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"), h.alias("h"))
    plans = plans.join(first, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0))))
    plans = land(plans.select("conv_id", "base", "h", "taken"), "plans")
    heads = ranked.filter(f"r < {MOST_SHARED} and conv_id % {FAMILY} = 0").withColumnRenamed("conv_id", "base")
    shared = plans.join(heads, "base").filter("r <= h").select("conv_id", F.col("r").alias("depth"), "digest", "chars")
    own = ranked.filter(F.col("r") > h).join(plans.select("conv_id", "h", "taken"), "conv_id")
    own = own.select("conv_id", (F.col("taken") + F.col("r") - F.col("h")).alias("depth"), "digest", "chars")
    return plans.select("conv_id"), land(shared.unionByName(own), "rebuilt")


def prefix_keys(rebuilt: DataFrame) -> DataFrame:
    """The rebuilt turns with the key of the prefix that they end (k1, k2) and of the one before (p1, p2)."""
    z = {f"z{i}": F.xxhash64(F.lit(i), F.col("depth"), F.col("digest")) for i in (1, 2)}
    marked = rebuilt.select("conv_id", "depth", "chars", *[e.alias(n) for n, e in z.items()], *[e.alias(n.replace("z", "k")) for n, e in z.items()])
    keyed = running(marked, "conv_id", "depth", {"k1": F.bit_xor, "k2": F.bit_xor}, lambda a, b: a.bitwiseXOR(b))
    before = [F.col(f"k{i}").bitwiseXOR(F.col(f"z{i}")).alias(f"p{i}") for i in (1, 2)]
    return land(keyed.select("conv_id", *KEY, "chars", *before), "prefixes")


def _digest_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash the lists of ids of a stream sorted by (key, conv_id)."""
    held, state = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in KEY], axis=1)
        ids = batch.column("conv_id").to_pylist()
        starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
        out = []
        for start, end in zip(starts, [*starts[1:], len(ids)]):
            key = tuple(keys[start].tolist())
            if key != held:
                if state is not None:
                    out.append((*held, state.hexdigest()))
                held, state = key, hashlib.sha256()
            else:
                state.update(b",")
            state.update(",".join(map(str, ids[start:end])).encode())
        if out:
            yield _ends_batch(out)
    if state is not None:
        yield _ends_batch([(*held, state.hexdigest())])


def _ends_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=[*KEY, "ends_sha256"])


def sequences(convs: DataFrame, prefixes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The distinct sequences (key, conv_id: the smallest one's, weight), and the digests of their ends (key, ends_sha256)."""
    last = prefixes.groupBy("conv_id").agg(F.max(F.struct(*KEY)).alias("end")).select("conv_id", "end.*")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in KEY]
    ends = land(convs.join(last, "conv_id", "left").select("conv_id", *zero), "ends")
    distinct = land(ends.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("weight")), "sequences")
    ordered = ends.repartition(*KEY).sortWithinPartitions(*KEY, "conv_id")
    return distinct, arrow(_digest_ends, ordered, "depth long, k1 long, k2 long, ends_sha256 string")


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, n_ends."""
    convs, rebuilt = rebuild(turns(conversations))
    prefixes = prefix_keys(rebuilt)
    distinct, ends = sequences(convs, prefixes)
    # prefixes of the distinct sequences, the root's textless one with them
    whole = distinct.select("conv_id", "weight", F.col("depth").alias("length"))
    root = [F.lit(0).cast("long").alias(c) for c in [*KEY, "chars"]] + [F.lit(None).cast("long").alias(c) for c in ("p1", "p2")]
    paths = prefixes.join(whole, "conv_id").select("conv_id", *KEY, "chars", "p1", "p2", "weight", "length")
    paths = land(paths.unionByName(whole.select("conv_id", *root, "weight", "length")), "paths")
    leaves = distinct.join(paths.filter("depth < length").select(*KEY).distinct(), KEY, "left_anti").select(F.col("conv_id"), F.lit(1).alias("leaf"))
    leaves = land(leaves, "leaves")
    marked = land(paths.join(leaves, "conv_id", "left"), "marked")
    nodes = marked.groupBy(*KEY).agg(
        F.min("conv_id").alias("node_conv"), F.sum("weight").alias("n_convs"), F.max("chars").alias("chars"), F.max("p1").alias("p1"), F.max("p2").alias("p2"),
        F.count("leaf").alias("n_leaves"), F.min(F.when(F.col("leaf") == 1, F.col("conv_id"))).alias("counted_by"),
    )
    nodes = land(nodes.withColumn("own", (F.col("n_convs") - 1) * F.col("chars")), "nodes")
    # a node's own saving counts once in the sum of each ancestor: along the path of its first leaf
    steps = marked.filter("leaf = 1").select("conv_id", *KEY).join(nodes.select(*KEY, "own", "counted_by"), KEY)
    steps = steps.select("conv_id", *KEY, F.when(F.col("counted_by") == F.col("conv_id"), F.col("own")).otherwise(F.lit(0)).alias("saved"))
    below = running(land(steps, "steps"), "conv_id", "depth", {"saved": F.sum}, lambda a, b: a + b, backwards=True)
    saved = below.groupBy(*KEY).agg(F.sum("saved").alias("saved_tokens"))
    up: list[Column] = [(F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")]
    children = nodes.filter("depth > 0").select(*up).groupBy(*KEY).agg(F.count("*").alias("n_children"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("node_conv").alias("parent_conv_id"))
    counts = distinct.select(*KEY, F.col("weight").alias("n_ends"))
    out = nodes.join(saved, KEY, "left").join(children, KEY, "left").join(ends, KEY, "left").join(counts, KEY, "left").join(parents, ["depth", "p1", "p2"], "left")
    number = {c: F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_children", "saved_tokens", "n_ends")}
    return out.select(
        F.col("node_conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", number["n_children"], "n_leaves", number["saved_tokens"],
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"), number["n_ends"],
    )


#: crc32 of a decimal number, bit by bit; prefixes as lists, compared as a whole.
ORACLE = """
WITH numbered AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, '')) AS r,
    struct_pack(role := coalesce(role, ''), text := coalesce(text, '')) AS t
  FROM conversations WHERE conv_id IS NOT NULL),
listed AS (SELECT conv_id, list(t ORDER BY r) AS ts FROM numbered GROUP BY conv_id),
bits AS (
  SELECT conv_id, ts, CAST(conv_id AS VARCHAR) AS s FROM listed),
checked AS (
  SELECT conv_id, ts,
    xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(s, ''), lambda c:
        [-1 - ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0]))),
      lambda crc, step: CASE WHEN step < 0 THEN xor(crc, -1 - step) ELSE xor(crc >> 1, 3988292384::BIGINT * (crc & 1)) END), 4294967295::BIGINT) % 6 AS h
  FROM bits),
rebuilt AS (
  SELECT c.conv_id, list_concat(list_slice(coalesce(b.ts, []), 1, c.h), list_slice(c.ts, c.h + 1, len(c.ts))) AS ts
  FROM checked c LEFT JOIN listed b ON b.conv_id = c.conv_id - c.conv_id % 100),
prefixes AS (
  SELECT conv_id, d AS depth, list_slice(ts, 1, d) AS p, len(ts) = d AS ends
  FROM (SELECT conv_id, ts, unnest(range(0, len(ts) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT depth, p, min(conv_id) AS conv_id, count(*) AS n_convs, count(*) FILTER (WHERE ends) AS n_ends,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256,
    (count(*) - 1) * CASE WHEN depth = 0 THEN 0 ELSE length(p[depth].text) END AS own
  FROM prefixes GROUP BY depth, p),
children AS (SELECT depth - 1 AS depth, list_slice(p, 1, depth - 1) AS p, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
numbered_nodes AS (
  SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c ON c.depth = n.depth AND c.p = n.p),
above AS (
  SELECT a AS depth, list_slice(p, 1, a) AS p, own, n_children
  FROM (SELECT p, own, n_children, unnest(range(0, depth + 1)) AS a FROM numbered_nodes)),
below AS (SELECT depth, p, sum(own) AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves FROM above GROUP BY depth, p)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, n.n_convs, n.n_children, b.n_leaves,
  CAST(b.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256, n.n_ends
FROM numbered_nodes n JOIN below b ON b.depth = n.depth AND b.p = n.p
LEFT JOIN nodes u ON u.depth = n.depth - 1 AND u.p = list_slice(n.p, 1, n.depth - 1)
"""
