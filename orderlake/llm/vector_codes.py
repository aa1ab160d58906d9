"""Vector codes: each part of a vector becomes the number of its nearest codebook entry.

The nearest entry is found through memoised grid cells. A part lies in a coarse cell
of 2^shift integers a side. For a cell met the first time, the least and greatest distance
of each entry to the cell's box are computed: an entry whose least distance exceeds another's
greatest is dominated and can be nearest to no point of the cell. The entries that are left are
cached under the cell's coordinates, and only these are evaluated exactly. Each round a
task adds up its parts by entry; the sums (parts x entries x positions rows) make the next codebook.

Defined cases: vectors that are null, empty or hold null or non-finite components are
dropped; so are vectors of another length than the one of the smallest vec_id's. A length that
isn't a multiple of the number of parts is filled up with zeros. Rows without vec_id are coded, and come
last in the order of ids; rows of one id are ordered by their integers. Repeated rows count as
often as they occur. With fewer rows than entries the codebooks have as many entries as rows. An empty
table gives no rows. Integer components are held within +-2^20 (|x| up to 256). Columns beyond vec_id,
embedding and label are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import arrow, land, sized
from orderlake.llm.exact_search import integer_vectors

#: Scale of a component, parts of a vector, entries of a codebook, rounds.
SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Cells remembered per part in a task before the memory is emptied, rows coded together, labels to broadcast at most.
MOST_CELLS, TOGETHER, BROADCAST_ROWS = 1 << 16, 4096, 1_000_000


def grid_shift(codebook: np.ndarray) -> int:
    """Logarithm of a cell's side: about the entries' mean deviation in a position."""
    spread = float(codebook.std(axis=0).mean())
    return max(0, int(np.ceil(np.log2(max(spread, 1.0)))))


class Grid:
    """Nearest entries of one part position, with the undominated entries of each cell met so far."""

    def __init__(self, codebook: np.ndarray, shift: int | None = None):
        self.codebook = codebook.astype(np.int64)
        self.shift = grid_shift(codebook) if shift is None else shift
        self.cells: dict[bytes, np.ndarray] = {}
        self.evaluated = 0

    def undominated(self, cells: np.ndarray) -> np.ndarray:
        """For each cell, which entries may be nearest to a point of its box."""
        low = (cells << self.shift)[:, None, :]
        high = low + (1 << self.shift) - 1
        entry = self.codebook[None, :, :]
        least = (np.maximum(np.maximum(low - entry, entry - high), 0) ** 2).sum(axis=2)
        most = (np.maximum(np.abs(low - entry), np.abs(high - entry)) ** 2).sum(axis=2)
        return least <= most.min(axis=1, keepdims=True)

    def _candidates(self, parts: np.ndarray) -> np.ndarray:
        cells = np.ascontiguousarray(parts >> self.shift)
        keys = cells.view([("cell", f"V{cells.itemsize * cells.shape[1]}")]).ravel()
        found, first, which = np.unique(keys, return_index=True, return_inverse=True)
        names = [key.tobytes() for key in found]
        if len(self.cells) + len(names) > MOST_CELLS:
            self.cells = {}
        new = [i for i, name in enumerate(names) if name not in self.cells]
        if new:
            self.cells.update(zip([names[i] for i in new], self.undominated(cells[first[new]])))
        return np.stack([self.cells[name] for name in names])[which.ravel()]

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of each part's nearest entry (the lowest of equals) and its squared distance."""
        row, entry = np.nonzero(self._candidates(parts))
        self.evaluated += len(row)
        distance = ((parts[row] - self.codebook[entry]) ** 2).sum(axis=1)
        starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        least = np.minimum.reduceat(distance, starts)
        hits = np.flatnonzero(distance == least[row])
        return entry[hits[np.searchsorted(row[hits], np.arange(len(parts)))]], least


def _parts(ints: pa.ListArray, codebooks: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(start, end, rows x parts x positions) of a column of vectors, filled up with zeros."""
    parts, _, width = codebooks.shape
    flat = ints.flatten().to_numpy(zero_copy_only=False).reshape(len(ints), -1)
    for start in range(0, len(ints), TOGETHER):
        some = flat[start : start + TOGETHER]
        full = np.zeros((len(some), parts * width), dtype=np.int64)
        full[:, : some.shape[1]] = some
        yield start, start + len(some), full.reshape(len(some), parts, width)


def _sums(codebooks: np.ndarray):
    """Count and sums of the parts assigned to each entry, once a task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, entries, width = codebooks.shape
        grids = [Grid(book) for book in codebooks]
        counts, sums = np.zeros((parts, entries), dtype=np.int64), np.zeros((parts, entries, width), dtype=np.int64)
        for batch in batches:
            for _, _, rows in _parts(batch.column("ints"), codebooks):
                for at, grid in enumerate(grids):
                    codes, _ = grid.nearest(np.ascontiguousarray(rows[:, at]))
                    counts[at] += np.bincount(codes, minlength=entries)
                    np.add.at(sums[at], codes, rows[:, at])
        at, entry, position = (a.ravel() for a in np.indices(sums.shape))
        columns = [at, entry, position, counts[at, entry], sums.ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["part", "entry", "position", "n", "total"])

    return work


def _codes(codebooks: np.ndarray, keep: list[str]):
    """Code and error of each vector, with the columns ``keep`` as they are."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grids = [Grid(book) for book in codebooks]
        for batch in batches:
            for start, end, rows in _parts(batch.column("ints"), codebooks):
                found = [grid.nearest(np.ascontiguousarray(rows[:, at])) for at, grid in enumerate(grids)]
                digits = np.stack([codes for codes, _ in found], axis=1).astype(np.uint8).tobytes().hex()
                width = 2 * len(grids)
                codes = [digits[i : i + width] for i in range(0, len(digits), width)]
                errors = np.sum([error for _, error in found], axis=0)
                kept = [batch.column(c).slice(start, end - start) for c in keep]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(codes), pa.array(errors)], names=[*keep, "code", "error"])

    return work


def of_one_length(vectors: DataFrame) -> DataFrame:
    """The rows of (vec_id, ints) whose length is that of the smallest vec_id's."""
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "ints").select(F.size("ints").alias("dim")).first()
    return vectors.filter(F.size("ints") == (first["dim"] if first else 0))


def train(vectors: DataFrame, rounds: int = ROUNDS, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray | None:
    """Codebooks (parts x entries x positions) over all rows of (vec_id, ints), of one length; None without rows."""
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(entries).collect()
    if not first:
        return None
    dim = len(first[0]["ints"])
    width = -(-dim // parts)
    books = np.zeros((len(first), parts * width), dtype=np.int64)
    books[:, :dim] = [r["ints"] for r in first]
    books = np.ascontiguousarray(books.reshape(len(first), parts, width).transpose(1, 0, 2))
    for _ in range(rounds):
        told = arrow(_sums(books), vectors.select("ints"), "part long, entry long, position long, n long, total long")
        told = told.groupBy("part", "entry", "position").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).filter("n > 0")
        books = books.copy()
        for row in told.collect():  # parts x entries x positions rows
            books[row["part"], row["entry"], row["position"]] = row["total"] // row["n"]
    return books


def compress(table: DataFrame, rounds: int = ROUNDS, parts: int = PARTS, entries: int = ENTRIES) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256, label) of each row that is kept."""
    vectors = land(integer_vectors(table, SCALE, ["vec_id", "label"]), "vectors")
    vectors = of_one_length(vectors)
    books = train(vectors, rounds, parts, entries)
    types = [f"{c} {vectors.schema[c].dataType.simpleString()}" for c in ("vec_id", "label")]
    if books is None:
        return table.sparkSession.createDataFrame([], f"{types[0]}, code string, error long, label_error long, codebooks_sha256 string, {types[1]}")
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    coded = land(arrow(_codes(books, ["vec_id", "label"]), vectors, f"{types[0]}, {types[1]}, code string, error long"), "codes")
    errors = land(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "label_errors")
    out = coded.join(sized(errors, BROADCAST_ROWS), F.col("label").eqNullSafe(F.col("of")))
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"), "label")


def _oracle() -> str:
    width = "(SELECT (min(len(ints)) + 7) // 8 FROM v)"
    steps = [f"""v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * x::DOUBLE) AS BIGINT)) AS ints FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""", f"""p AS MATERIALIZED (
  SELECT vec_id, label, part, list_slice(ints, part * {width} + 1, (part + 1) * {width}) AS xs FROM v, range({PARTS}) r(part))""", f"""b0 AS MATERIALIZED (
  SELECT part, xs, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry
  FROM p WHERE vec_id IN (SELECT vec_id FROM v ORDER BY vec_id LIMIT {ENTRIES}))"""]
    for at in range(ROUNDS + 1):
        steps.append(f"""a{at} AS MATERIALIZED (
  SELECT vec_id, label, part, xs, best.d AS d, best.entry AS entry FROM (
  SELECT vec_id, label, part, px AS xs, min({{'d': d, 'entry': entry}}) AS best FROM (
    SELECT p.vec_id, p.label, p.part, p.xs AS px, b.entry,
      list_sum(list_transform(list_zip(p.xs, b.xs), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
    FROM p JOIN b{at} b ON b.part = p.part)
  GROUP BY vec_id, label, part, px))""")
        if at < ROUNDS:
            steps.append(f"""m{at} AS (
  SELECT part, entry, list(f ORDER BY i) AS xs FROM (
    SELECT part, entry, i, CAST(floor(sum(x) / count(*)) AS BIGINT) AS f
    FROM (SELECT part, entry, unnest(xs) AS x, unnest(range(1, len(xs) + 1)) AS i FROM a{at}) GROUP BY part, entry, i)
  GROUP BY part, entry),
b{at + 1} AS MATERIALIZED (
  SELECT b.part, coalesce(m.xs, b.xs) AS xs, b.entry FROM b{at} b LEFT JOIN m{at} m ON m.part = b.part AND m.entry = b.entry)""")
    return f"""WITH {", ".join(steps)},
coded AS (
  SELECT vec_id, label, string_agg(lpad(to_hex(entry), 2, '0'), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM a{ROUNDS} GROUP BY vec_id, label)
SELECT vec_id, lower(code) AS code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(xs, ','), ',' ORDER BY part, entry)) FROM b{ROUNDS}) AS codebooks_sha256, label
FROM coded"""


ORACLE = _oracle()
