"""Near-duplicate vectors by hierarchical navigable small-world graphs per shard.

Vectors are compared only within a label (and dimension). Equal vectors form a
class, of which one is searched, with the class's size as weight. A label's
classes are dealt into shards of bounded size, a graph is built for each, and
every vector is searched in every shard of its label: shards are paired, and
each pair searches both ways.

A beam that comes back full of links may have more behind it; such a query is
compared with the whole shard. Apart from these, a sample of each pair's queries
is compared with the whole shard as an audit: while a link is missed there,
the beam is doubled and the pair searched again, in the end over all of the
shard. Found links are confirmed by cosine in double precision. Only numbers of
links and spanning edges leave a task; components are the union of the edges.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components, and those without label or vec_id, link with nothing (without
vec_id: null component, kept). Rows that repeat wholly are one vector; a vec_id
with different vectors gives a row for each and one component. Other columns
are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import arrow, land, runs
from orderlake.llm.components import connected_components
from orderlake.llm.small_world import Graph

COSINE = 0.98
#: Most vectors, and components of vectors, in a shard.
SHARD_ROWS, SHARD_VALUES = 8192, 4_000_000
#: First beam, and queries per pair of shards whose result is audited.
BEAM, AUDITED = 48, 64
#: Rows of a similarity matrix computed at once.
ROWS_AT_ONCE = 512

_KEYS = ["label", "dim", "shard"]
_PAIR = ["label", "dim", "shard_a", "shard_b"]


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision, without overflow or underflow."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in runs(batches, _KEYS, most_rows=1):
        ids, weights = table.column("rep").to_numpy(), table.column("weight").to_numpy()
        vectors = unit(np.array(table.column("embedding").to_pylist(), dtype=np.float64))
        graph = pickle.dumps(Graph(vectors, ids).dump(), protocol=5)
        key = [table.column(k)[0].as_py() for k in _KEYS]
        row = [*key, ids.tobytes(), weights.tobytes(), vectors.tobytes(), graph]
        kinds = [pa.string(), pa.int32(), pa.int32(), *[pa.binary()] * 4]
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], [*_KEYS, "ids", "weights", "vectors", "graph"])


class _Shard:
    def __init__(self, row: dict) -> None:
        self.ids, self.weights = (np.frombuffer(row[c], np.int64) for c in ("ids", "weights"))
        self.unit = np.frombuffer(row["vectors"], np.float64).reshape(len(self.ids), -1)
        self.graph = Graph.load(self.unit, *pickle.loads(row["graph"]))


def _exact(queries: np.ndarray, shard: _Shard) -> np.ndarray:
    return queries @ shard.unit.T >= COSINE


def _links(queries: np.ndarray, shard: _Shard, own: bool) -> np.ndarray:
    """Boolean matrix: queries by the shard's vectors, found and confirmed. own: the queries are the shard's."""
    n = len(shard.ids)
    sample = np.unique(np.linspace(0, len(queries) - 1, min(AUDITED, len(queries))).astype(int))
    truth = _exact(queries[sample], shard)
    ef = BEAM
    while True:
        found = np.zeros((len(queries), n), bool)
        if 2 * ef >= n:
            rest = np.arange(len(queries))
        else:
            full = []
            for k, q in enumerate(queries):
                near = np.array(shard.graph.search(q, ef, k if own else None))
                hit = near[shard.unit[near] @ q >= COSINE]
                found[k, hit] = True
                if len(hit) >= ef:
                    full.append(k)
            rest = np.array(full, dtype=np.int64)
        for at in range(0, len(rest), ROWS_AT_ONCE):
            part = rest[at : at + ROWS_AT_ONCE]
            found[part] = _exact(queries[part], shard)
        if not (truth & ~found[sample]).any():
            return found
        ef *= 2


def _spanning(found: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> set[tuple[int, int]]:
    """Edges between ids that connect whatever the matrix connects, about one for each."""
    group = np.arange(len(columns))  # of each column
    row_of = np.full(len(rows), -1)
    for k in np.flatnonzero(found.any(axis=1)):
        groups = np.unique(group[found[k]])
        if len(groups) > 1:
            group[np.isin(group, groups)] = groups[0]
        row_of[k] = np.flatnonzero(found[k])[0]
    edges = {(int(rows[k]), int(columns[group[row_of[k]]])) for k in np.flatnonzero(row_of >= 0)}
    edges |= {(int(columns[k]), int(columns[group[k]])) for k in np.flatnonzero(group != np.arange(len(group)))}
    return {e for e in edges if e[0] != e[1]}


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in runs(batches, _PAIR, most_rows=1):
        rows = table.to_pylist()
        same = rows[0]["shard_a"] == rows[0]["shard_b"]
        if not same and len(rows) < 2:  # the other shard got no vector
            continue
        a, label = _Shard(rows[0]), rows[0]["label"]
        b = a if same else _Shard(rows[1])
        found = _links(a.unit, b, same)
        found |= found.T.copy() if same else _links(b.unit, a, False).T
        found &= a.ids[:, None] != b.ids[None, :]
        counts = [(i, n) for i, n in zip(a.ids.tolist(), (found @ b.weights).tolist()) if n]
        if not same:
            counts += [(i, n) for i, n in zip(b.ids.tolist(), (a.weights @ found).tolist()) if n]
        edges = sorted(_spanning(found, a.ids, b.ids))
        a_ids = [i for i, _ in counts] + [i for i, _ in edges]
        b_ids = [None] * len(counts) + [j for _, j in edges]
        n_links = [n for _, n in counts] + [0] * len(edges)
        yield pa.RecordBatch.from_arrays([pa.array(a_ids, pa.int64()), pa.array(b_ids, pa.int64()), pa.array(n_links, pa.int64()), pa.array([label] * len(a_ids), pa.string())], ["a", "b", "n_links", "label"])


def _paired(shards: DataFrame, sizes: DataFrame) -> DataFrame:
    """Each shard once for every shard of its label: the two rows of a pair meet by the pair's key, so
    a label's shards are spread over as many tasks as it has pairs. A shard meets itself in one row."""
    other = F.explode(F.sequence(F.lit(0), F.col("n_shards") - 1)).alias("other")
    met = shards.join(sizes, ["label", "dim"]).select(*shards.columns, other)
    met = met.withColumn("shard_a", F.least("shard", "other")).withColumn("shard_b", F.greatest("shard", "other")).drop("other")
    return met.repartition(*_PAIR).sortWithinPartitions(*_PAIR, "shard")


def vector_duplicates(vectors: DataFrame) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per vector of vectors(vec_id, embedding, label)."""
    value = F.col("embedding")
    fine = F.coalesce(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size(value) > 0)
        & ~F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(value, lambda x: x != 0),
        F.lit(False),
    )
    # 0.0 - x + ... keeps values; adding 0.0 turns -0.0 into 0.0, so that equal vectors are equal as keys
    rows = vectors.select(F.col("vec_id").cast("long"), F.transform(F.col("embedding").cast("array<double>"), lambda x: x + 0.0).alias("embedding"), F.col("label").cast("string"))
    rows = land(rows.distinct().withColumn("fine", fine), "vectors")
    good = rows.filter("fine").withColumn("dim", F.size("embedding"))
    classes = land(good.groupBy("label", "dim", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight")), "classes")
    per_shard = F.least(F.lit(SHARD_ROWS), F.greatest(F.lit(1), (F.lit(SHARD_VALUES) / F.col("dim")).cast("int")))
    sizes = land(classes.groupBy("label", "dim").agg(F.ceil(F.count("*") / F.first(per_shard)).cast("int").alias("n_shards")), "sizes")
    dealt = classes.join(sizes, ["label", "dim"]).withColumn("shard", F.pmod(F.xxhash64("rep"), F.col("n_shards")).cast("int"))
    dealt = dealt.select(*_KEYS, "rep", "weight", "embedding").repartition(*_KEYS).sortWithinPartitions(*_KEYS, "rep")
    shards = land(arrow(_build, dealt, "label string, dim int, shard int, ids binary, weights binary, vectors binary, graph binary"), "graphs")

    found = land(arrow(_search, _paired(shards, sizes), "a long, b long, n_links long, label string"), "found")

    counts = land(found.filter("b is null").groupBy(F.col("label").alias("l"), F.col("a").alias("r")).agg(F.sum("n_links").alias("n")), "counts")
    by_class = good.join(classes, ["label", "dim", "embedding"]).select("vec_id", "label", "rep", "weight")
    members = land(by_class, "members")
    # copies hang on their class's first vec_id; a vec_id with several vectors ties their classes
    repeated = members.groupBy("vec_id").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).filter("low <> high").select("vec_id")
    ties = members.join(repeated, "vec_id").select(F.col("vec_id").alias("a"), F.col("rep").alias("b"))
    components = land(connected_components(found.filter("b is not null").select("a", "b").unionByName(ties)), "components")
    linked = members.join(counts, (F.col("label") == F.col("l")) & (F.col("rep") == F.col("r")), "left").withColumn("n_links", F.coalesce("n", F.lit(0).cast("long")) + F.col("weight") - 1)
    linked = linked.select("vec_id", "rep", "n_links").join(components, F.col("rep") == F.col("node"), "left")
    out = linked.select("vec_id", "n_links", F.coalesce("component", "rep").alias("component_id"))
    alone = rows.filter("not fine").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
