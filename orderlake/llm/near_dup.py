"""Near-duplicate documents by SetSketch registers.

1. Each document's set of 5-word shingles becomes M registers. Register i holds
   floor(1 - log_b(h_i)), clipped, of the least of exponentially distributed
   hashes: it depends on the set alone, and the registers of a union are the
   maxima of the parts' registers (``merge_registers``).
2. Documents with equal sets form classes; one member stands for the class.
3. Bands of registers propose groups. Within a group, pairs whose joint
   likelihood puts the Jaccard similarity above ``CUT`` are kept. A first round
   compares within bounded blocks and keeps a spanning forest; its confirmed
   links give provisional components. A second round compares, block against
   block, what still lies in different components, so no pair is left out and
   none within a component is enumerated.
4. Kept pairs are confirmed on the full sets; connected components follow.

With 40 bands of 5 registers a pair at similarity 0.75 shares a band with
probability 1 - 2e-5; CUT lies four standard errors of the estimate below 0.75.

Defined cases: null or empty texts and texts without words have an empty set
and are linked with nothing. A doc_id that repeats is one document: links of
any of its texts are its own. Rows without doc_id are returned with a null
component and are kept. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm import shingles
from orderlake.llm.common import arrow, land, runs, sized
from orderlake.llm.components import connected_components, provisional_components

BANDS, ROWS = 40, 5
REGISTERS = BANDS * ROWS
#: Base and rate of the registers: with a base so close to 1, equal registers have nearly the similarity as probability.
BASE, RATE, TOP = 1.001, 20.0, (1 << 16) - 2
#: Similarity that the estimate must reach to be verified.
CUT = 0.6275
#: Similarity at which an estimate is nearly always confirmed.
LIKELY = 0.80
#: Links: 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Members, and shingles of members, that a block of a group holds.
BLOCK_ROWS, BLOCK_SHINGLES = 512, 2_000_000
#: Tables of ids of up to so many rows (some tens of MB) are broadcast, so that texts and registers stay where they are.
BROADCAST_ROWS = 1_000_000
#: Rounds of joining before the second comparison; what they leave apart is compared once more than needed.
PROVISIONAL_ROUNDS = 2
#: Sets whose registers are computed together.
TOGETHER = 64

_rng = np.random.default_rng(7001)
_FACTOR = _rng.integers(0, 1 << 31, REGISTERS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SHIFT = _rng.integers(0, 1 << 32, REGISTERS, dtype=np.uint32)


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """SetSketch registers (uint16) of non-empty sets of 64-bit hashes."""
    least = np.empty((len(sets), REGISTERS), np.uint32)
    for at in range(0, len(sets), TOGETHER):
        part = sets[at : at + TOGETHER]
        starts = np.concatenate(([0], np.cumsum([len(s) for s in part])[:-1]))
        x = (np.concatenate(part) >> np.uint64(32)).astype(np.uint32)
        for i in range(REGISTERS):
            least[at : at + len(part), i] = np.minimum.reduceat((x ^ _SHIFT[i]) * _FACTOR[i], starts)
    exponential = -np.log1p(-(least + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)) + (TOP >> 1), 0, TOP + 1).astype("<u2")


def merge_registers(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def _log_share(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """p_b(x) = -log_b(1 - x (b-1)/b) and its derivative."""
    inner = 1 - x * (BASE - 1) / BASE
    return -np.log(inner) / np.log(BASE), (BASE - 1) / BASE / (np.log(BASE) * inner)


def likely_similar(a: np.ndarray, n_a: int, others: np.ndarray, n_others: np.ndarray, at: float) -> np.ndarray:
    """Whether the likelihood estimate of the similarity of a with each of the others is ``at`` or more.

    The joint log-likelihood of greater, equal and smaller registers is concave
    in the similarity, so its slope at ``at`` tells on which side its maximum is.
    """
    greater = np.count_nonzero(a > others, axis=1)
    equal = np.count_nonzero(a == others, axis=1)
    smaller = REGISTERS - greater - equal
    u = n_a / (n_a + n_others)
    v = 1 - u
    fits = np.minimum(u, v) >= at * np.maximum(u, v)
    x, y = np.where(fits, u - v * at, 0.5), np.where(fits, v - u * at, 0.5)
    with np.errstate(divide="ignore", invalid="ignore"):
        px, dx = _log_share(np.maximum(x, 1e-12))
        py, dy = _log_share(np.maximum(y, 1e-12))
        slope = equal * (v * dx + u * dy) / (1 - px - py) - greater * v * dx / px - smaller * u * dy / py
    return fits & (slope >= 0)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        for sets, at in shingles.shingle_sets(texts):
            full = [s for s in sets if len(s)]
            own = iter(registers(full) if full else [])
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(at, len(sets)),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array([next(own).tobytes() if len(s) else None for s in sets], pa.binary()),
                ],
                ["doc_id", "n_shingles", "set_hash", "registers"],
            )


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, set_hash, registers) per row of docs(doc_id, text)."""
    return arrow(_signatures, docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), "doc_id long, n_shingles long, set_hash binary, registers binary")


def _forest(n: int, near: list[np.ndarray]) -> list[tuple[int, int]]:
    """Edges of a spanning forest, from the better connected members outwards."""
    seen, edges = np.zeros(n, bool), []
    for root in sorted(range(n), key=lambda i: -len(near[i])):
        if seen[root]:
            continue
        seen[root] = True
        todo = [root]
        while todo:
            i = todo.pop()
            new = near[i][~seen[near[i]]]
            seen[new] = True
            edges += [(i, int(j)) for j in new]
            todo += new.tolist()
    return edges


def _band_keys(regs: np.ndarray) -> np.ndarray:
    """One number per row and band, equal where the band's registers are."""
    r = regs.reshape(len(regs), BANDS, ROWS).astype(np.uint64)
    out = shingles.mix(r[:, :, 0] | r[:, :, 1] << np.uint64(16) | r[:, :, 2] << np.uint64(32) | r[:, :, 3] << np.uint64(48))
    for k in range(4, ROWS):
        out = shingles.mix(out + r[:, :, k] + np.uint64(1))
    return out


def _estimate(batches: Iterator[pa.RecordBatch], across: bool) -> Iterator[pa.RecordBatch]:
    """For each group, its members that are in a kept pair, and each one's partners to verify.

    across: keep all pairs of the group whose components differ and whose blocks
    are the two of the group; else keep spanning forests. A pair belongs to the
    first band that its documents share.
    """
    for table in runs(batches, ["band", "i", "j"]):
        columns = {c: table.column(c).to_numpy() for c in ("band", "i", "j", "band_no", "block", "doc_id", "n_shingles", "component")}
        regs = np.frombuffer(b"".join(table.column("registers").to_pylist()), "<u2").reshape(-1, REGISTERS)
        bands = _band_keys(regs)
        key = np.stack([columns[c] for c in ("band", "i", "j")])
        cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
        out: list[tuple] = []
        for rows in np.split(np.arange(table.num_rows), cuts):
            if len(rows) < 2:
                continue
            n, ids, comp, own, keys = columns["n_shingles"][rows], columns["doc_id"][rows], columns["component"][rows], regs[rows], bands[rows]
            block, i, j, band_no = columns["block"][rows], int(key[1, rows[0]]), int(key[2, rows[0]]), int(columns["band_no"][rows[0]])
            partners: dict[int, np.ndarray] = {}
            near: dict[float, list[list]] = {at: [[] for _ in rows] for at in (CUT, LIKELY)}
            for k in range(len(rows) - 1):
                rest = np.arange(k + 1, len(rows))
                may = ids[rest] != ids[k]
                if across:
                    may &= (comp[rest] != comp[k]) & ((block[rest] != block[k]) | (i == j))
                rest = rest[may]
                # a pair is looked at in the first band it shares
                rest = rest[(keys[k] == keys[rest]).argmax(axis=1) == band_no]
                rest = rest[likely_similar(own[k], n[k], own[rest], n[rest], CUT)] if len(rest) else rest
                if not len(rest):
                    continue
                if across:
                    if len(rest):
                        partners[k] = rest
                    continue
                for at, edges in near.items():
                    for m in rest[likely_similar(own[k], n[k], own[rest], n[rest], at)].tolist():
                        edges[k].append(m)
                        edges[m].append(k)
            if not across:
                pairs = {(min(e), max(e)) for edges in near.values() for e in _forest(len(rows), [np.array(x, dtype=np.int64) for x in edges])}
                for k in {k for k, _ in pairs}:
                    partners[k] = np.array(sorted(m for i_, m in pairs if i_ == k), dtype=np.int64)
            involved = sorted(partners.keys() | {int(m) for rest in partners.values() for m in rest})
            out += [(int(key[0, rows[0]]), i, j, int(ids[k]), ids[partners[k]] if k in partners else ids[:0]) for k in involved]
        if out:
            band, i_, j_, doc, lists = zip(*out)
            ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
            columns = [pa.array(band, pa.int64()), pa.array(i_, pa.int32()), pa.array(j_, pa.int32()), pa.array(doc, pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(ends, np.concatenate(lists))], ["band", "i", "j", "doc_id", "partners"])


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    if min(len(a), len(b)) * 100 < PERCENT * max(len(a), len(b)):
        return False
    common = shingles.intersection_size(a, b)
    return 100 * common >= PERCENT * (len(a) + len(b) - common)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Confirmed links of each group. A pair that the group's links connect already needs no check."""
    for table in runs(batches, ["band", "i", "j"], most_rows=256):
        sets = [s for part, _ in shingles.shingle_sets(table.column("text").combine_chunks()) for s in part]
        docs = table.column("doc_id").to_numpy()
        key = np.stack([table.column(c).to_numpy() for c in ("band", "i", "j")])
        lists = table.column("partners").combine_chunks()
        ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
        found = []
        for rows in np.split(np.arange(table.num_rows), np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1):
            members: dict[int, list[np.ndarray]] = {}
            for r in rows.tolist():
                members.setdefault(int(docs[r]), []).append(sets[r])
            parent = {doc: doc for doc in members}

            def root(x: int) -> int:
                while parent[x] != x:
                    parent[x] = parent[parent[x]]
                    x = parent[x]
                return x

            for r in rows.tolist():
                a = int(docs[r])
                for b in flat[ends[r] : ends[r + 1]].tolist():
                    if b in parent and root(a) != root(b) and any(linked(x, y) for x in members[a] for y in members[b]):
                        parent[root(a)] = root(b)
                        found.append((a, b))
        yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in found], pa.int64()), pa.array([p[1] for p in found], pa.int64())], ["a", "b"])


def _grouped(members: DataFrame) -> DataFrame:
    return members.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j", "doc_id")


def _round(docs: DataFrame, members: DataFrame, across: bool, name: str) -> DataFrame:
    """Confirmed links (a, b) from the members of groups."""
    schema = "band long, i int, j int, doc_id long, partners array<long>"
    kept = land(arrow(partial(_estimate, across=across), _grouped(members), schema), f"kept_{name}")
    ids = land(kept.select("doc_id").distinct(), f"ids_{name}")
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(sized(ids, BROADCAST_ROWS), "doc_id", "left_semi")
    return land(arrow(_verify, _grouped(kept.join(texts, "doc_id")), "a long, b long"), f"links_{name}")


def _blocks(n_rows: Column, n_shingles: Column) -> Column:
    return F.greatest(F.ceil(n_rows / BLOCK_ROWS), F.ceil(n_shingles / BLOCK_SHINGLES)).cast("int")


def _opposed(members: DataFrame) -> DataFrame:
    """Members of bands that hold several components, once for each group (band, i, j) of two blocks in which they
    meet other components: members outside a band's largest component have blocks of their own and meet
    all blocks; a member of the largest component meets the blocks of the others alone."""
    sizes = members.groupBy("band", "component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("s"))
    bands = sizes.groupBy("band").agg(F.max(F.struct("n", "s", "component")).alias("top"), F.sum("n").alias("n"), F.sum("s").alias("s"))
    n, s, top_n, top_s = F.col("n"), F.col("s"), F.col("top.n"), F.col("top.s")
    mixed = bands.filter(top_n < n).select("band", F.col("top.component").alias("largest"), _blocks(top_n, top_s).alias("n_own"), _blocks(n - top_n, s - top_s).alias("n_others"))
    own, others, inside = F.col("n_own"), F.col("n_others"), F.col("component") == F.col("largest")
    place = F.pmod(F.xxhash64("band", "doc_id"), F.when(inside, own).otherwise(others)).cast("int")
    last = F.when(inside, others).otherwise(others + own) - 1
    placed = members.join(land(mixed, "mixed"), "band").select("band", "band_no", "doc_id", "component", F.when(inside, others + place).otherwise(place).alias("block"), F.explode(F.sequence(F.lit(0), last)).alias("other"))
    return placed.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).drop("other")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of docs(doc_id, text, ...)."""
    sig = land(signatures(docs), "signatures")
    classes = land(sig.filter("doc_id is not null and n_shingles > 0").groupBy("set_hash").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n_rows")).filter("n_rows > 1").drop("n_rows"), "classes")
    stood = sig.join(sized(classes, BROADCAST_ROWS), "set_hash", "left").withColumn("rep", F.coalesce("rep", "doc_id"))
    reps = land(stood.filter("doc_id = rep and n_shingles > 0").select("doc_id", "n_shingles", "registers"), "representatives")
    rows = land(stood.select("doc_id", "n_shingles", "rep"), "rows")

    bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: F.xxhash64(k, F.substring("registers", k * (2 * ROWS) + 1, F.lit(2 * ROWS))))
    banded = reps.select("doc_id", "n_shingles", F.posexplode(bands).alias("band_no", "band"))
    blocks = _blocks(F.col("n_rows"), F.col("n_all"))
    shared = land(banded.groupBy("band").agg(F.count("*").alias("n_rows"), F.sum("n_shingles").alias("n_all")).filter("n_rows > 1").select("band", blocks.alias("blocks")), "bands")
    block = F.pmod(F.xxhash64("band", "doc_id"), F.col("blocks")).cast("int")
    members = land(banded.join(shared, "band").select("band", "band_no", "doc_id", "n_shingles", block.alias("block")), "members")

    within = members.drop("n_shingles").join(reps, "doc_id").select("*", F.col("block").alias("i"), F.col("block").alias("j"), F.lit(0).cast("long").alias("component"))
    first = _round(docs, within, False, "within")
    found = land(provisional_components(first, PROVISIONAL_ROUNDS), "components")

    joined = members.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    joined = land(joined, "member_components")
    second = _round(docs, _opposed(joined).join(reps, "doc_id"), True, "across")

    repeated = rows.filter("doc_id is not null").groupBy("doc_id").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).filter("low <> high").select("doc_id")
    same = rows.join(repeated, "doc_id").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    found = land(connected_components(first.unionByName(second).unionByName(same)), "components")
    out = rows.join(found, F.col("rep") == F.col("node"), "left").withColumn("component_id", F.coalesce("component", "rep"))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
