"""Benchmark decontamination: one Aho-Corasick automaton over normalised test items.

Texts are lower-cased in A-Z and cut into words of letters, digits and
characters beyond ASCII. An item's windows are its runs of 10 consecutive words,
or all its words if it has fewer. The automaton's alphabet are the items' words,
so a document is scanned once, word by word, and a hit is a range of words,
which is mapped back to characters of the original text.

The items' words, each item once and long ones in overlapping pieces, are sent
to the tasks in parts of bounded size, one automaton each; usually there is one
part. With more, the parts follow one another over the same rows, and hits add
up; after some parts the rows are written and their broadcasts freed, so the
driver and a worker hold a bounded number of parts however many items there are.

Defined cases: null or empty texts have no words; items without words have no
windows; an item_id that repeats is one item, a null one is a hit without an
item; a window that several items share counts for each. Every row of docs gives
one row, repeated ones as well; an empty table gives none. Columns of docs keep
their names and values, also those named _hit or _items.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import partial

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import arrow, land, lower_ascii

WINDOW = 10
#: Characters of items per automaton, and so per broadcast.
PART_CHARS = 1_000_000
#: Automata that one pass over the rows holds; what they found is written before the next pass.
PARTS_AT_ONCE = 4
#: Words of a piece of a long item.
PIECE_WORDS = 10_000

_NORMAL = bytes(c if chr(c) in "abcdefghijklmnopqrstuvwxyz0123456789" or c >= 0x80 else ord(chr(c).lower()) if chr(c) in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else 0x20 for c in range(256))
_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_NORMAL).split()


def windows(words: list[bytes], width: int) -> list[tuple[bytes, ...]]:
    if not words:
        return []
    return [tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]


class Scanner:
    """An automaton over the windows of some items."""

    def __init__(self, items: list[tuple[int | None, str | None]], width: int) -> None:
        self.vocabulary: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set] = {}
        for item, text in items:
            for window in windows(words_of(text), width):
                ids = tuple(self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in window)
                found.setdefault(ids, set()).add(item)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for ids, of in found.items():
            self.automaton.add_word(ids, (len(ids), tuple(of)))
        if found:
            self.automaton.make_automaton()
        self.empty = not found

    def scan(self, words: list[bytes]) -> tuple[np.ndarray | None, set]:
        """Which words are hit (None: none is), and the items hit."""
        if self.empty or not words:
            return None, set()
        get = self.vocabulary.get
        hit, items = None, set()
        for end, (length, of) in self.automaton.iter(tuple([get(w, 0) for w in words])):
            if hit is None:
                hit = np.zeros(len(words), bool)
            hit[end - length + 1 : end + 1] = True
            items.update(of)
        return hit, items


_scanners: dict[str, Scanner] = {}


def _scanner(sent, width: int) -> Scanner:
    """Built once per worker and part."""
    name, items = sent.value
    if (name, width) not in _scanners:
        _scanners.clear()
        _scanners[name, width] = Scanner(items, width)
    return _scanners[name, width]


def _cut(benchmark: DataFrame, width: int) -> DataFrame:
    """(item_id, text): the distinct items as words with blanks between. Long items are cut into pieces
    that overlap so far that each window stands whole in one of them."""
    words = F.regexp_extract_all(lower_ascii(F.coalesce(F.col("text").cast("string"), F.lit(""))), F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"), F.lit(1))
    items = benchmark.select(F.col("item_id").cast("long"), words.alias("words")).filter(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - width + 1), F.lit(PIECE_WORDS))
    pieces = items.select("item_id", "words", F.explode(starts).alias("at"))
    return pieces.select("item_id", F.array_join(F.slice("words", F.col("at"), F.lit(PIECE_WORDS + width - 1)), " ").alias("text")).distinct()


def _parts(benchmark: DataFrame, width: int, part_chars: int) -> tuple[DataFrame, int]:
    """The items with their part, of about part_chars characters each, and the number of parts."""
    items = land(_cut(benchmark, width), "items")
    size = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"]
    n_parts = max(1, -(-size // part_chars))
    return land(items.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(n_parts)).cast("int")), "parts"), n_parts


def _sent(items: DataFrame, part: int):
    """One part as a broadcast."""
    rows = [(r["item_id"], r["text"]) for r in items.filter(F.col("part") == part).collect()]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    name = hashlib.md5(repr(rows).encode("utf-8", "surrogatepass")).hexdigest()
    return items.sparkSession.sparkContext.broadcast((name, rows))


def _scan(batches: Iterator[pa.RecordBatch], sent, width: int, names: tuple[str, str]) -> Iterator[pa.RecordBatch]:
    """Add one part's hits to the two last columns, named names: packed hits and items."""
    scanner = _scanner(sent, width)
    for batch in batches:
        hits, item_lists = (batch.column(c).to_pylist() for c in names)
        for i, text in enumerate(batch.column("text")):
            words = words_of(text.as_py())
            hit, items = scanner.scan(words)
            if hit is not None:
                if hits[i] is not None:
                    hit |= np.unpackbits(np.frombuffer(hits[i], np.uint8), count=len(words)).astype(bool)
                hits[i] = np.packbits(hit).tobytes()
                item_lists[i] = sorted(set(item_lists[i]) | items, key=lambda x: (x is None, x or 0))
        kept = [c for c in batch.schema.names if c not in names]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(hits, pa.binary()), pa.array(item_lists, pa.list_(pa.int64()))], [*kept, *names])


def _free_names(docs: DataFrame) -> tuple[str, str]:
    """Names of two columns that docs doesn't have."""
    taken = {c.lower() for c in docs.columns}
    mark = "_"
    while {f"{mark}hit", f"{mark}items"} & taken:
        mark += "_"
    return f"{mark}hit", f"{mark}items"


def _scanned(docs: DataFrame, benchmark: DataFrame, width: int, part_chars: int) -> tuple[DataFrame, tuple[str, str]]:
    """docs with its hits and items, and the names of these two columns."""
    names = _free_names(docs)
    rows = docs.withColumn("text", F.col("text").cast("string")).withColumn(names[0], F.lit(None).cast("binary")).withColumn(names[1], F.array().cast("array<bigint>"))
    schema = rows.schema
    items, n_parts = _parts(benchmark, width, part_chars)
    held: list = []
    for part in range(n_parts):
        if len(held) == PARTS_AT_ONCE:
            rows = land(rows, "scanned")
            for sent in held:
                sent.destroy()
            held = []
        held.append(_sent(items, part))
        rows = arrow(partial(_scan, sent=held[-1], width=width, names=names), rows, schema)
    return rows, names


def hit_spans(text: str, hit: np.ndarray) -> list[tuple[int, int]]:
    """Character ranges [start, end) of the original text under runs of hit words."""
    places = [m.span() for m in _WORD.finditer(text)]
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    return [(places[a][0], places[b - 1][1]) for a, b in edges.reshape(-1, 2)]


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc, text, packed, items in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), batch.column("_hit").to_pylist(), batch.column("_items").to_pylist()):
            n = len(words_of(text))
            hit = np.zeros(n, bool) if packed is None else np.unpackbits(np.frombuffer(packed, np.uint8), count=n).astype(bool)
            named = sorted(str(x) for x in items if x is not None)
            spans = [] if packed is None else [{"start": a, "end": b} for a, b in hit_spans(text, hit)]
            rows.append((doc, n, int(hit.sum()), len(named), hashlib.sha256(",".join(named).encode()).hexdigest(), bool(hit.any()), spans))
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)] if rows else [pa.array([], t) for t in types], ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans"])


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, part_chars: int = PART_CHARS) -> DataFrame:
    """Per row of docs(doc_id, text): n_words, n_hit, n_items, items_sha256, contaminated and the hit character spans."""
    rows, _ = _scanned(docs.select(F.col("doc_id").cast("long"), "text"), benchmark, width, part_chars)
    return arrow(_report, rows, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, spans array<struct<start: long, end: long>>")


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, part_chars: int = PART_CHARS) -> DataFrame:
    """The rows of docs without a hit, with all their columns."""
    rows, (hit, _) = _scanned(docs, benchmark, width, part_chars)
    return rows.filter(F.col(hit).isNull()).select(*docs.columns)


ORACLE = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least({WINDOW}, len(w)) AS n, array_to_string(w[i:i + least({WINDOW}, len(w)) - 1], ' ') AS gram
  FROM (SELECT *, unnest(generate_series(1, greatest(1, len(w) - {WINDOW} + 1))) AS i FROM b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM windows),
grams AS (
  SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM (SELECT rid, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, lengths WHERE len(w) >= n)),
found AS (SELECT rid, g.n, i, item_id FROM grams g JOIN windows USING (n, gram)),
hits AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(generate_series(i, i + n - 1)) AS p FROM found) GROUP BY rid),
items AS (
  SELECT rid, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM (SELECT DISTINCT rid, item_id FROM found WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (rid) LEFT JOIN items USING (rid)
"""
