"""Exact top-k search by inner product with bounds from segment statistics.

For vectors cut into segments of length L, with mean m and deviation s a segment,
the squared distance of q and x is at least the sum of L((mq - mx)^2 + (sq - sx)^2).
As 2 q.x = |q|^2 + |x|^2 - distance^2, a lower bound of the distance is an upper bound
of the score: the sum of L(mq mx + sq sx), itself an inner product of statistics.
Pairs are bounded at 4, 8, 16 and 32 segments; a pair whose bound lies below the
query's k-th best score so far is out, and exact scores are computed for the rest.

Vectors are packed into blocks by the tasks that read them and are never shuffled.
Queries are packed too and meet the blocks of all rows by a broadcast join, in passes
of PASS_BYTES at most, so that neither the driver nor a task holds all queries. A task
keeps the k best of each query of the pass; these are merged by query. Before, each
query's k-th best score in one sample block (SEED_ROWS rows) is its first bound; this
sample only saves work.

Defined cases: vectors that are null, empty or hold null or non-finite components, and
rows without id, take no part. Rows of one id are no candidates for that id's queries; otherwise a
repeated candidate row counts as often as it occurs. Repeated query rows are answered
once; different vectors under one query id are answered each. Only vectors of equal
length are compared. Integer components are held within +-2^20 (|x| up to 16,384), where
sums of products are exact in doubles. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm.common import arrow, land, scratch_dir

#: Scale of a component, neighbours a query, divisor of the queries' ids.
SCALE, K, EVERY = 64, 20, 20
MOST = 1 << 20
#: A block's most rows and integers, queries bounded together, and segments by level.
BLOCK_ROWS, BLOCK_INTS, TOGETHER, LEVELS = 4096, 1 << 20, 64, (4, 8, 16, 32)
#: Bytes of query vectors that are broadcast together, and rows of the sample block.
PASS_BYTES, SEED_ROWS = 16 << 20, 4096
BLOCK = "dim int, n int, ids binary, ints binary"
QUERY_BLOCK = "dim int, q_n int, q_ids binary, q_keys binary, q_ints binary"


def integer_vectors(vectors: DataFrame, scale: int, keep: list[str], vector: str = "embedding") -> DataFrame:
    """``keep`` and ``ints``: floor(scale * x) of each component, of the vectors that have finite components only."""
    whole = F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    ints = F.transform(vector, lambda x: F.greatest(F.least(F.floor(x.cast("double") * scale), F.lit(MOST)), F.lit(-MOST)).cast("int"))
    return vectors.filter(whole).select(*keep, ints.alias("ints"))


def _blocks(batches: Iterator[pa.RecordBatch], longs: list[str], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Pack rows into blocks of one vector length, ordered by the first long; ``names`` are the output columns."""
    held: dict[int, list[tuple[np.ndarray, ...]]] = {}
    waiting: dict[int, int] = {}

    def block(dim: int) -> pa.RecordBatch:
        parts = [np.concatenate(column) for column in zip(*held.pop(dim))]
        order = np.argsort(parts[0], kind="stable")
        packs = [p[order].astype("<i8").tobytes() for p in parts[:-1]] + [parts[-1][order].astype("<i4").tobytes()]
        del waiting[dim]
        types = [pa.int32(), pa.int32(), *[pa.binary()] * len(packs)]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip([dim, len(order), *packs], types)], names=names)

    for batch in batches:
        columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in longs]
        flat, sizes = batch.column("ints").flatten().to_numpy(zero_copy_only=False), batch.column("ints").value_lengths().to_numpy(zero_copy_only=False)
        starts = np.cumsum(sizes) - sizes
        for dim in np.unique(sizes).tolist():
            rows, room = np.flatnonzero(sizes == dim), max(1, min(BLOCK_ROWS, BLOCK_INTS // dim))
            while len(rows):
                now, rows = np.split(rows, [room - waiting.get(dim, 0)])
                held.setdefault(dim, []).append((*[c[now] for c in columns], flat[starts[now][:, None] + np.arange(dim)]))
                waiting[dim] = waiting.get(dim, 0) + len(now)
                if waiting[dim] == room:
                    yield block(dim)
            while sum(d * n for d, n in waiting.items()) > 4 * BLOCK_INTS:
                yield block(max(waiting, key=lambda d: d * waiting[d]))
    for dim in sorted(held):
        yield block(dim)


def pack_rows(vectors: DataFrame) -> DataFrame:
    """Blocks of (vec_id, ints), packed where they are read."""
    return arrow(lambda batches: _blocks(batches, ["vec_id"], ["dim", "n", "ids", "ints"]), vectors.select("vec_id", "ints"), BLOCK)


def segment_statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of each segment, times the root of its length: the inner product of two rows bounds that of their vectors."""
    n, dim = vectors.shape
    length = -(-dim // segments)
    cut = np.zeros((n, segments * length))
    cut[:, :dim] = vectors  # zeros at the end change no score
    cut = cut.reshape(n, segments, length)
    mean = cut.mean(axis=2)
    deviation = np.sqrt(np.maximum((cut * cut).mean(axis=2) - mean * mean, 0.0))
    return np.concatenate([mean, deviation], axis=1) * np.sqrt(length)


class Rows:
    """A block of vectors with its ids and, by level, its segment statistics."""

    def __init__(self, dim: int, ids: bytes, ints: bytes):
        self.ids = np.frombuffer(ids, "<i8")
        self.vectors = np.frombuffer(ints, "<i4").reshape(-1, dim).astype(np.float64)
        self.longest = float(np.sqrt((self.vectors**2).sum(axis=1).max()))
        self.levels = [segment_statistics(self.vectors, m) for m in LEVELS if m < dim]


class Best:
    """The k best (score, id) of each query of a block so far, and how many pairs were bounded and scored."""

    def __init__(self, rows: Rows, k: int, bounds: np.ndarray | None = None):
        self.rows, self.k = rows, k
        self.scores = np.full((len(rows.ids), k), -np.inf)
        self.ids = np.zeros((len(rows.ids), k), dtype=np.int64)
        self.bounds = np.full(len(rows.ids), -np.inf) if bounds is None else bounds.copy()
        self.pairs = self.scored = 0

    def meet(self, block: Rows) -> None:
        """Search one block: bounds coarse to fine, then exact scores of the pairs that are left."""
        margin = 0.5 + 1e-9 * self.rows.longest * block.longest
        for at in range(0, len(self.rows.ids), TOGETHER):
            part = slice(at, at + TOGETHER)
            least = self.bounds[part, None] - margin
            columns = np.arange(len(block.ids))
            alive = self.rows.ids[part, None] != block.ids[None, :]
            self.pairs += alive.size
            for mine, theirs in zip(self.rows.levels, block.levels):
                alive &= ~(mine[part] @ theirs[columns].T < least)
                some = alive.any(axis=0)
                columns, alive = columns[some], alive[:, some]
            if len(columns):
                self.scored += int(alive.sum())
                scores = np.where(alive, self.rows.vectors[part] @ block.vectors[columns].T, -np.inf)
                self._keep(part, scores, block.ids[columns])

    def _keep(self, part: slice, scores: np.ndarray, ids: np.ndarray) -> None:
        pool = np.concatenate([self.scores[part], scores], axis=1)
        pool_ids = np.concatenate([self.ids[part], np.broadcast_to(ids, scores.shape)], axis=1)
        least = np.maximum(np.partition(pool, -self.k, axis=1)[:, -self.k], self.bounds[part])
        row, column = np.nonzero((pool >= least[:, None]) & (pool > -np.inf))
        score, found = pool[row, column], pool_ids[row, column]
        order = np.lexsort((found, -score, row))
        row, score, found = row[order], score[order], found[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        row, score, found, rank = (v[rank < self.k] for v in (row, score, found, rank))
        kept, kept_ids = np.full((len(pool), self.k), -np.inf), np.zeros((len(pool), self.k), dtype=np.int64)
        kept[row, rank], kept_ids[row, rank] = score, found
        self.scores[part], self.ids[part] = kept, kept_ids
        self.bounds[part] = np.maximum(self.bounds[part], kept[:, -1])


def _seed_bounds(k: int):
    """Query blocks with the k-th best score of each query in the sample block."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["dim", "q_n", "q_ids", "q_keys", "q_ints"]
        for batch in batches:
            bounds = []
            for row in batch.to_pylist():
                best = Best(Rows(row["dim"], row["q_ids"], row["q_ints"]), k)
                if row["ids"] is not None:
                    best.meet(Rows(row["dim"], row["ids"], row["ints"]))
                bounds.append(best.bounds.tobytes())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(bounds, pa.binary())], names=[*names, "q_bounds"])

    return work


def _search(k: int):
    """The k best of each query among the blocks of one task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: dict[tuple[int, bytes, bytes], Best] = {}
        ids = block = None
        for batch in batches:
            for at in range(batch.num_rows):
                row = {c: batch.column(c)[at].as_py() for c in batch.schema.names}
                key = (row["dim"], row["q_ids"], row["q_keys"])
                if key not in queries:
                    queries[key] = Best(Rows(row["dim"], row["q_ids"], row["q_ints"]), k, np.frombuffer(row["q_bounds"]))
                if (row["ids"], row["ints"]) != ids:
                    ids, block = (row["ids"], row["ints"]), Rows(row["dim"], row["ids"], row["ints"])
                queries[key].meet(block)
        for (_, q_ids, q_keys), best in queries.items():
            query, place = np.nonzero(best.scores > -np.inf)
            columns = [np.frombuffer(q_ids, "<i8")[query], np.frombuffer(q_keys, "<i8")[query], best.ids[query, place], best.scores[query, place].astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "query_key", "vec_id", "score"])

    return work


def search(queries: DataFrame, rows: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` the k best of ``rows``; both hold (vec_id, ints)."""
    spark = rows.sparkSession
    queries, rows = queries.filter("vec_id is not null"), rows.filter("vec_id is not null")
    asked = land(queries.withColumn("key", F.xxhash64("ints")).dropDuplicates(["vec_id", "ints"]), "queries")
    total = asked.agg(F.coalesce(F.sum(F.size("ints").cast("long") * 4 + 16), F.lit(0))).first()[0]
    passes = -(-total // PASS_BYTES)
    asked = asked.withColumn("pass", F.pmod(F.xxhash64("vec_id", "key"), F.lit(max(1, passes))).cast("int"))
    blocks = land(pack_rows(rows), "blocks")
    seeds = rows.select("vec_id", "ints").orderBy(F.xxhash64("vec_id"), "vec_id", "ints").limit(SEED_ROWS)
    seeds = land(pack_rows(seeds.coalesce(1)), "seeds").groupBy("dim").agg(F.max_by(F.struct("n", "ids", "ints"), "n").alias("b")).select("dim", "b.*")
    found = f"{scratch_dir(spark)}/found"
    for at in range(passes):
        names = ["dim", "q_n", "q_ids", "q_keys", "q_ints"]
        packed = arrow(lambda batches: _blocks(batches, ["vec_id", "key"], names), asked.filter(F.col("pass") == at).select("vec_id", "key", "ints"), QUERY_BLOCK)
        bounded = land(arrow(_seed_bounds(k), packed.join(F.broadcast(seeds), "dim", "left"), f"{QUERY_BLOCK}, q_bounds binary"), "query_blocks")
        pairs = blocks.join(F.broadcast(bounded), "dim").select(*bounded.columns, "ids", "ints")
        best = arrow(_search(k), pairs, "query_id long, query_key long, vec_id long, score long")
        best.write.parquet(f"{found}/pass={at}")
    if not passes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    merged = spark.read.parquet(found)
    order = Window.partitionBy("query_id", "query_key").orderBy(F.col("score").desc(), "vec_id")
    merged = merged.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return merged.select("query_id", "rank", "vec_id", "score")


def top_neighbours(vectors: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """The k best of each vector whose id is divisible by ``every``, among all others."""
    rows = land(integer_vectors(vectors, SCALE, ["vec_id"]).withColumn("vec_id", F.col("vec_id").cast("long")), "vectors")
    return search(rows.filter(F.col("vec_id") % every == 0), rows, k)


ORACLE = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS ints FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.ints, c.ints) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % {EVERY} = 0 AND c.vec_id <> q.vec_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {K}
"""
