"""Tokens of each line of a document by offset-mapped attribution.

A whole document is encoded once. Each token covers a range of bytes, and so of
characters (a character is covered by every token that has some of its bytes);
the ranges are interval-joined to the document's sections, which follow one
another without gaps. A token that reaches into several sections goes to the one
that has most of its bytes, to the earliest of those that have as many: each
token is counted once, so a document's sections add up to its tokens.

Sections are the lines; a line has its line feed. Any other split that gives
increasing ends can be passed as ``ends_of``.

Defined cases: a null or empty text has one section, without tokens; text that
looks like a special token is ordinary text; repeated rows count each; an empty
table gives none. Other columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import arrow


def line_ends(data: np.ndarray) -> np.ndarray:
    """Ends of the lines in bytes, the last one the text's."""
    ends = np.flatnonzero(data == 0x0A) + 1
    return ends if len(ends) and ends[-1] == len(data) else np.append(ends, len(data))


class SpanEncoder:
    """A byte-level tokenizer whose tokens cover the text without gaps."""

    def __init__(self, path: str, pattern: str) -> None:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.sizes[rank] = len(token)

    def ends(self, text: str) -> np.ndarray:
        """Ends of the tokens in bytes."""
        return np.cumsum(self.sizes[np.array(self.encoding.encode_ordinary(text), dtype=np.int64)])


def owners(token_ends: np.ndarray, section_ends: np.ndarray) -> np.ndarray:
    """The section of each token: the one with most of its bytes, of equals the first."""
    starts = np.concatenate(([0], token_ends))[: len(token_ends)]
    first = np.searchsorted(section_ends, starts, side="right")
    last = np.searchsorted(section_ends, token_ends, side="left")
    owner = first.copy()
    for t in np.flatnonzero(first != last):
        sections = np.arange(first[t], last[t] + 1)
        before = np.concatenate(([0], section_ends))[sections]
        own = np.minimum(section_ends[sections], token_ends[t]) - np.maximum(before, starts[t])
        owner[t] = sections[own.argmax()]
    return owner


_encoders: dict[tuple[str, str], SpanEncoder] = {}

_FIELDS = (("doc_id", pa.int64()), ("section", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("n_tokens", pa.int64()), ("n_crossing", pa.int64()))


def _attribute(batches: Iterator[pa.RecordBatch], ranks: str, pattern: str, ends_of: Callable) -> Iterator[pa.RecordBatch]:
    if (ranks, pattern) not in _encoders:
        _encoders[ranks, pattern] = SpanEncoder(ranks, pattern)
    encoder = _encoders[ranks, pattern]
    for batch in batches:
        docs, columns = [], []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            text = (text or "").encode("utf-8", "replace").decode("utf-8")
            data = np.frombuffer(text.encode(), np.uint8)
            sections, tokens = ends_of(data), encoder.ends(text) if text else np.zeros(0, np.int64)
            if len(tokens) and tokens[-1] != len(data):
                raise ValueError("the tokens do not cover the text")
            # characters before each byte: an offset in bytes maps to one in characters
            chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
            owner = owners(tokens, sections)
            starts = np.concatenate(([0], sections[:-1]))
            token_starts = np.concatenate(([0], tokens))[: len(tokens)]
            crossing = (token_starts < starts[owner]) | (tokens > sections[owner])
            n = len(sections)
            docs += [doc] * n
            columns.append((np.arange(n), chars[starts], chars[sections], np.bincount(owner, minlength=n), np.bincount(owner[crossing], minlength=n)))
        if columns:
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), *[pa.array(np.concatenate(c), pa.int64()) for c in zip(*columns)]], [f[0] for f in _FIELDS])


def section_tokens(docs: DataFrame, ranks: str, pattern: str, ends_of: Callable[[np.ndarray], np.ndarray] = line_ends) -> DataFrame:
    """(doc_id, section, start, end, n_tokens, n_crossing) for each section of docs(doc_id, text).

    start and end are characters; n_crossing counts those of its tokens that
    reach beyond the section.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return arrow(partial(_attribute, ranks=ranks, pattern=pattern, ends_of=ends_of), rows, ", ".join(f"{name} long" for name, _ in _FIELDS))
