"""Token ids of documents in grammar-compressed binary shards.

``write_token_files`` sorts the documents by doc_id, encodes each whole text,
appends an end id, and packs runs of documents into shards. A shard's ids are
compressed by Re-Pair: frequent pairs of adjacent symbols get nonterminals, the most frequent
first, many in a round, round after round until no pair occurs LEAST_COUNT times or
the 16 bits of a symbol are used up. No pair reaches across a document's end, so each document is a run of symbols of its own and can be
decoded without its neighbours (``Shard.document``, ``Shard.tokens``).

A shard is a row of a Parquet table: part and shard number (their order is the
order of doc_ids), the doc_ids, and a payload:

    magic "RPG1"; uint32 n_rules, n_symbols, n_docs
    rules           uint16 [n_rules][2]   symbols of each rule's pair
    lengths         uint32 [n_rules]      ids that each rule expands to
    symbols         uint16 [n_symbols]
    document ends   uint32 [n_docs]       in symbols
    document sizes  uint32 [n_docs]       in ids

all little-endian. Symbols below ``TERMINALS`` are ids, rule r is symbol
TERMINALS + r.

Spark writes the table, so a lost task is repeated and a shard appears once.

Defined cases: a null or empty text has the end id alone; null doc_ids come
last; equal doc_ids are ordered by their text's hash; an empty table gives an
empty one. Other columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import partial
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlake.llm.common import arrow

END = 2
#: Ids are below this; rules take the rest of 16 bits.
TERMINALS = 49408
#: A shard is closed when it has so many ids.
SHARD_IDS = 1 << 20
MOST_RULES = (1 << 16) - TERMINALS
#: A rule takes 8 bytes and each of its places saves 2: rarer pairs would make the file larger.
LEAST_COUNT = 4
#: A round takes this share of the rules that are left (later rounds pair the new symbols), and this many at least.
ROUND_SHARE, ROUND_LEAST = 4, 1024
MAGIC = b"RPG1"
#: Distinct words whose ids a worker remembers (some 200 bytes each, and an executor has a worker for each core).
CACHE_WORDS = 400_000
#: ... and keeps when they have become more.
KEPT_WORDS = 200_000
#: A run of these marks at a word's end is a piece of its own after a letter or digit.
MARKS = bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum())
#: ... that nothing behind it can change: of ASCII or U+00C0 to U+00FF, whose second bytes these are without the two signs'.
LATIN_LEAD, LATIN_SECOND = 0xC3, bytes(c for c in range(0x80, 0xC0) if c not in (0x97, 0xB7))
#: A special token of the tokenizer, and how many new words are encoded in one text with it between them.
SEPARATOR, JOINED = "<|endoftext|>", 200
#: Stands after each text; no UTF-8 text has this byte.
MARK = b"\xff"
#: First bytes of U+0300 to U+036F; only these marks compose with A-Z.
MARK_LEADS = (b"\xcc", b"\xcd")
CAPITAL_BEFORE_MARK = re.compile(rb"[A-Z][\x80-\xff]")
#: Documents encoded together.
TOGETHER = 256


def _among(values: bytes) -> np.ndarray:
    """Whether a byte is one of the values, by byte."""
    table = np.zeros(256, bool)
    table[list(values)] = True
    return table


IS_MARK, IS_SPACE, IS_LATIN = _among(MARKS), _among(b" \t\n\r\x0b\x0c"), _among(LATIN_SECOND)
IS_ALNUM = _among(bytes(c for c in range(128) if chr(c).isalnum()))


class WordEncoder:
    """Ids of whole texts by a tokenizer that treats white space as a word break and drops it.

    Such a tokenizer encodes a text as its words one after the other, so a
    worker keeps the ids of the words it has met. Only A-Z may be folded
    beforehand, for a tokenizer that lower-cases, and not before a combining
    mark: the tokenizer composes first, and J with a caron has no composed form.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.separator = self.tokenizer.token_to_id(SEPARATOR)
        # a model that marks a word's end by a suffix splits a word of a-z by itself: the steps before it leave such words as they are
        self.model = self.tokenizer.model if getattr(self.tokenizer.model, "end_of_word_suffix", None) else None
        self._reset()

    def _reset(self) -> None:
        # the first place is that of the mark after each text, which stands for the end id
        self.places: dict[bytes, int] = {MARK: 0}
        self.ids = np.full(1 << 16, END, np.uint16)
        self.starts = np.zeros(1 << 16, np.int64)
        self.starts[1] = self.n_ids = 1

    def _ids_of(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, one after the other, and each word's number of ids."""
        if self.model and all(map(_plain, words)):
            # without a pass over joined words, and without offsets
            each = [[token.id for token in self.model.tokenize(w.decode())] for w in words]
            return np.array([i for ids in each for i in ids], np.int64), np.array([len(ids) for ids in each], np.int64)
        texts = [w.decode("utf-8", "replace") for w in words]
        if self.separator is None or any("<|" in t for t in texts):
            each = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            return np.array([i for ids in each for i in ids], np.int64), np.array([len(ids) for ids in each], np.int64)
        # a special token between words keeps them apart at less cost than a call's result for each word
        joined = [SEPARATOR.join(texts[at : at + JOINED]) + SEPARATOR for at in range(0, len(texts), JOINED)]
        ids = np.concatenate([np.array(e.ids, np.int64) for e in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)])
        ends = np.flatnonzero(ids == self.separator)
        return ids[ids != self.separator], np.diff(ends, prepend=-1) - 1

    def _learn(self, words: list[bytes]) -> None:
        plain, special, other = [], [], []
        for w in words:
            (plain if _plain(w) else special if b"<|" in w else other).append(w)
        for part in (plain, other, special):
            if part:
                self._add(part, *self._ids_of(part))

    def _add(self, words: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        if len(ids) and ids.max() >= TERMINALS:
            raise ValueError(f"token ids must be below {TERMINALS}")
        at = len(self.places)
        if self.n_ids + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros(max(len(ids), len(self.ids)), np.uint16)))
        if at + len(words) + 1 > len(self.starts):
            self.starts = np.concatenate((self.starts, np.zeros(max(len(words) + 1, len(self.starts)), np.int64)))
        self.ids[self.n_ids : self.n_ids + len(ids)] = ids
        self.starts[at + 1 : at + len(words) + 1] = self.n_ids + np.cumsum(sizes)
        self.n_ids += len(ids)
        self.places.update(zip(words, range(at, at + len(words))))

    def _forget(self) -> None:
        """Keep the words met first, which are the frequent ones."""
        self.places = dict(islice(self.places.items(), KEPT_WORDS))
        self.n_ids = int(self.starts[len(self.places)])

    def encode(self, texts: list[str | bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids with an end id after each text, and the number of ids of each."""
        if len(self.places) > CACHE_WORDS:
            self._forget()
        folded = [_folded(t) + b" " + MARK + b" " for t in texts]
        data = b"".join(folded)
        # a special token ends with marks
        words = (b"".join([t if b"<|" in t else _parted(t) for t in folded]) if b"<|" in data else _parted(data)).split()
        at = np.fromiter(map(self.places.get, words, repeat(-1)), np.int64, len(words))
        unknown = np.flatnonzero(at < 0).tolist()
        if unknown:
            self._learn(list(dict.fromkeys([words[k] for k in unknown])))
            at[unknown] = [self.places[words[k]] for k in unknown]
        first = self.starts[at]
        length = self.starts[at + 1] - first
        so_far = np.cumsum(length)
        flat = self.ids[np.repeat(first - so_far + length, length) + np.arange(so_far[-1] if len(so_far) else 0)]
        return flat, np.diff(so_far[at == 0], prepend=0)


def _plain(word: bytes) -> bool:
    """Whether a word is of a-z alone."""
    return word.isalpha() and word.islower()


def _folded(text: str | bytes | None) -> bytes:
    """A text's bytes with A-Z lowered, unless it may hold a special token, which is found as it is written.

    Words with a capital before a byte of 0x80 or more stay as they are if the text has combining marks.
    """
    data = text if isinstance(text, bytes) else (text or "").encode("utf-8", "replace")
    if b"<|" in data:
        return data
    if any(lead in data for lead in MARK_LEADS):
        return b" ".join([w if CAPITAL_BEFORE_MARK.search(w) else w.lower() for w in data.split()])
    return data.lower()


def _parted(data: bytes) -> bytes:
    """Marks at a word's end as a word of their own, so that a word is learned and looked up once, whatever marks follow it."""
    raw = np.frombuffer(b"  " + data + b" ", np.uint8)
    mark = IS_MARK[raw]
    edges = np.flatnonzero(mark[1:] != mark[:-1]) + 1
    first, behind = edges[::2], edges[1::2]
    before = raw[first - 1]
    whole = IS_ALNUM[before] | IS_LATIN[before] & (raw[first - 2] == LATIN_LEAD)
    return np.insert(raw, first[whole & IS_SPACE[raw[behind]]], ord(" ")).tobytes()


def compress(ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rules, symbols, document ends in symbols) of ids whose documents end at ``ends``."""
    symbols = ids.astype(np.uint32)
    last = np.zeros(len(ids), bool)
    last[ends - 1] = True
    rules = np.zeros((0, 2), np.int64)
    while len(rules) < MOST_RULES and len(symbols) > 1:
        inner = ~last[:-1]  # pairs that stay in their document
        pair = symbols[:-1] << np.uint32(16) | symbols[1:]
        ordered = np.sort(pair[inner])
        if not len(ordered):
            break
        heads = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        counts = np.diff(np.append(heads, len(ordered)))
        good = np.flatnonzero(counts >= LEAST_COUNT)
        left_over = MOST_RULES - len(rules)
        most = min(left_over, max(left_over // ROUND_SHARE, ROUND_LEAST))
        if len(good) > most:
            good = np.sort(good[np.argpartition(counts[good], len(good) - most)[len(good) - most :]])
        if not len(good):
            break
        chosen = ordered[heads[good]]
        # rule of a pair: a small table over the chosen pairs' left and right symbols
        left, right = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int32)
        for side, values in ((left, chosen >> np.uint32(16)), (right, chosen & np.uint32(0xFFFF))):
            kinds = np.unique(values)
            side[kinds] = np.arange(1, len(kinds) + 1)
        width = int(right.max()) + 1
        table = np.full((int(left.max()) + 1) * width, -1, np.int16)
        table[left[chosen >> np.uint32(16)] * width + right[chosen & np.uint32(0xFFFF)]] = np.arange(len(chosen))
        rule = table[left[symbols[:-1]] * width + right[symbols[1:]]]
        at = np.flatnonzero((rule >= 0) & inner)
        if not len(at):
            break
        # overlapping places: every second one of a run
        run = np.flatnonzero(np.concatenate(([True], np.diff(at) > 1)))
        order = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
        at = at[order % 2 == 0]
        symbols[at] = (TERMINALS + len(rules) + rule[at].astype(np.int64)).astype(np.uint32)
        last[at] = last[at + 1]
        rules = np.concatenate((rules, np.stack((chosen >> np.uint32(16), chosen & np.uint32(0xFFFF)), axis=1).astype(np.int64)))
        kept = np.ones(len(symbols), bool)
        kept[at + 1] = False
        symbols, last = symbols[kept], last[kept]
    return rules, symbols, np.flatnonzero(last) + 1


def pack(ids: np.ndarray, sizes: np.ndarray) -> bytes:
    rules, symbols, ends = compress(ids, np.cumsum(sizes))
    lengths = np.ones(TERMINALS + len(rules), np.int64)
    for r, (a, b) in enumerate(rules.tolist()):
        lengths[TERMINALS + r] = lengths[a] + lengths[b]
    head = np.array([len(rules), len(symbols), len(sizes)], "<u4")
    return MAGIC + head.tobytes() + rules.astype("<u2").tobytes() + lengths[TERMINALS:].astype("<u4").tobytes() + symbols.astype("<u2").tobytes() + ends.astype("<u4").tobytes() + sizes.astype("<u4").tobytes()


class Shard:
    """A packed shard, decoded wholly or at some place."""

    def __init__(self, payload: bytes) -> None:
        if payload[:4] != MAGIC:
            raise ValueError("not a token shard")
        n_rules, n_symbols, n_docs = (int(x) for x in np.frombuffer(payload, "<u4", 3, 4))
        at = 16
        parts = []
        for kind, n in (("<u2", 2 * n_rules), ("<u4", n_rules), ("<u2", n_symbols), ("<u4", n_docs), ("<u4", n_docs)):
            parts.append(np.frombuffer(payload, kind, n, at))
            at += parts[-1].nbytes
        if at != len(payload):
            raise ValueError("token shard of wrong length")
        rules, self.lengths, self.symbols, self.ends, self.sizes = parts
        self.rules = rules.reshape(-1, 2)
        # every symbol's expansion, one after the other; a rule refers to earlier symbols only,
        # so rules are expanded by depth
        self.size = np.concatenate((np.ones(TERMINALS, np.int64), self.lengths))
        self.first = np.cumsum(self.size) - self.size
        self.flat = np.zeros(int(self.size.sum()), np.uint16)
        self.flat[:TERMINALS] = np.arange(TERMINALS)
        depth = np.zeros(len(self.size), np.int64)
        while n_rules:
            deeper = 1 + depth[self.rules].max(axis=1)
            if (deeper == depth[TERMINALS:]).all():
                break
            depth[TERMINALS:] = deeper
        for d in range(1, int(depth.max()) + 1):
            own = np.flatnonzero(depth == d)
            to = self.first[own] - (np.cumsum(self.size[own]) - self.size[own])
            self.flat[np.repeat(to, self.size[own]) + np.arange(self.size[own].sum())] = self._expand(self.rules[own - TERMINALS].ravel())

    def _expand(self, symbols: np.ndarray) -> np.ndarray:
        length = self.size[symbols]
        before = np.cumsum(length) - length
        return self.flat[np.repeat(self.first[symbols] - before, length) + np.arange(length.sum())]

    def all(self) -> np.ndarray:
        return self._expand(self.symbols)

    def document(self, k: int) -> np.ndarray:
        """Ids of the k-th document, decoded alone."""
        return self._expand(self.symbols[self.ends[k - 1] if k else 0 : self.ends[k]])

    def tokens(self, start: int, stop: int) -> np.ndarray:
        """Ids start to stop of the shard; only the symbols that reach into the range are expanded."""
        ends = np.cumsum(self.size[self.symbols])
        a, b = np.searchsorted(ends, start, side="right"), np.searchsorted(ends, stop)
        part = self._expand(self.symbols[a : b + 1])
        skip = start - (ends[a - 1] if a else 0)
        return part[skip : skip + stop - start]


_encoders: dict[str, WordEncoder] = {}


def _pack_shards(batches: Iterator[pa.RecordBatch], tokenizer: str, shard_ids: int) -> Iterator[pa.RecordBatch]:
    if tokenizer not in _encoders:
        _encoders[tokenizer] = WordEncoder(tokenizer)
    encoder, part = _encoders[tokenizer], TaskContext.get().partitionId()
    held: list[tuple[list, np.ndarray, np.ndarray]] = []
    n_held, shard = 0, 0

    def close() -> pa.RecordBatch:
        docs = [d for ids, _, _ in held for d in ids]
        payload = pack(np.concatenate([x for _, x, _ in held]), np.concatenate([s for _, _, s in held]))
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([n_held], pa.int64()), pa.array([docs], pa.list_(pa.int64())), pa.array([payload], pa.binary())],
            ["part", "shard", "n_ids", "doc_ids", "payload"],
        )

    for batch in batches:
        for at in range(0, batch.num_rows, TOGETHER):
            piece = batch.slice(at, TOGETHER)
            ids, sizes = encoder.encode(piece.column(1).cast(pa.binary()).to_pylist())
            held.append((piece.column(0).to_pylist(), ids, sizes))
            n_held += len(ids)
            if n_held >= shard_ids:
                yield close()
                held, n_held, shard = [], 0, shard + 1
    if held:
        yield close()


def write_token_files(docs: DataFrame, path: str, tokenizer: str, shard_ids: int = SHARD_IDS) -> None:
    """Write docs(doc_id, text) to a new table of shards at ``path``."""
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text").asc()]
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).repartitionByRange(*order).sortWithinPartitions(*order)
    packed = arrow(partial(_pack_shards, tokenizer=tokenizer, shard_ids=shard_ids), rows, "part int, shard int, n_ids long, doc_ids array<long>, payload binary")
    packed.write.parquet(path)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            shard = Shard(row["payload"])
            ids, sizes = shard.all(), shard.sizes.astype(np.int64)
            ends = np.cumsum(sizes)
            data = memoryview(ids.astype("<u4").tobytes())
            crc = [zlib.crc32(data[4 * (e - s) : 4 * e]) for e, s in zip(ends.tolist(), sizes.tolist())]
            n = len(sizes)
            columns = [pa.array([row["part"]] * n, pa.int32()), pa.array([row["shard"]] * n, pa.int32()), pa.array(row["doc_ids"], pa.int64()), pa.array(ends - sizes), pa.array(sizes), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["part", "shard", "doc_id", "start", "n_tokens", "ids_crc32"])


def read_token_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files at ``path``."""
    table = spark.read.parquet(path)
    decoded = arrow(_digests, table.select("part", "shard", "doc_ids", "payload"), "part int, shard int, doc_id long, start long, n_tokens long, ids_crc32 long")
    # ids before a shard: of earlier parts (as many as the sort had partitions), then of earlier shards of its part
    shards = table.select("part", "shard", "n_ids")
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before_part"))
    earlier = F.sum("n_ids").over(Window.partitionBy("part").orderBy("shard")) - F.col("n_ids")
    bases = shards.select("part", "shard", earlier.alias("before")).join(parts, "part").select("part", "shard", (F.col("before") + F.col("before_part")).alias("base"))
    return decoded.join(bases, ["part", "shard"]).select("doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")
