"""Word-shingle sets of texts as sorted 64-bit hashes, computed on Arrow buffers.

A text is lower-cased in A-Z and cut into words at ASCII white space. Its set
holds the hashes of its distinct 5-word shingles; a text of fewer words has its
whole sequence as one shingle; a text without words (or a null) has none.

A word's hash is a polynomial over its bytes, taken from one running sum per
segment, so that no Python code runs per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WIDTH = 5
#: Texts are hashed together up to about this many bytes (there are some ten arrays of eight times the size); a longer text alone.
SEGMENT_BYTES = 1 << 18

_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LETTER = np.random.default_rng(20231).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LETTER[ord("A") : ord("Z") + 1] = _LETTER[ord("a") : ord("z") + 1]
_PLACE = np.random.default_rng(20232).integers(1, 1 << 63, WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, for n bytes."""
    size = max(SEGMENT_BYTES * 2, 1 << int(n).bit_length())
    if size not in _powers:
        _powers.clear()
        inverse = pow(_BASE, -1, 1 << 64)
        tables = []
        for factor in (_BASE, inverse):
            t = np.full(size, factor, dtype=np.uint64)
            t[0] = 1
            tables.append(np.multiply.accumulate(t))
        _powers[size] = (tables[0], tables[1])
    return _powers[size]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of the texts data[offsets[i]:offsets[i+1]], and each text's first word.

    ``data`` is uint8; the second result has one entry more than there are texts.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    space = _SPACE[data]
    word = ~space
    starts = word.copy()
    starts[1:] &= space[:-1]
    ends = word.copy()
    ends[:-1] &= space[1:]
    inner = offsets[(offsets > 0) & (offsets < n)]
    starts[inner] = word[inner]
    ends[inner - 1] = word[inner - 1]
    s, e = np.flatnonzero(starts), np.flatnonzero(ends)
    power, inverse = _power_tables(n)
    run = np.cumsum(_LETTER[data] * power[:n])
    before = run[s] - _LETTER[data[s]] * power[s]
    return mix((run[e] - before) * inverse[s]), np.searchsorted(s, offsets)


def shingle_hashes(words: np.ndarray) -> np.ndarray:
    """Hash of each window of WIDTH words (or of the whole sequence, if it is shorter)."""
    if len(words) < WIDTH:
        return mix(np.sum(words * _PLACE[: len(words)], dtype=np.uint64, keepdims=True) + np.uint64(len(words))) if len(words) else words
    total = words[: len(words) - WIDTH + 1] * _PLACE[0]
    for k in range(1, WIDTH):
        total += words[k : len(words) - WIDTH + 1 + k] * _PLACE[k]
    return mix(total)


def distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate(([True], values[1:] != values[:-1]))] if len(values) else values


def shingle_sets(texts: pa.Array) -> Iterator[tuple[list[np.ndarray], int]]:
    """Sorted sets of the texts in order, segment by segment: (sets, index of the first text)."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SEGMENT_BYTES, side="right")) - 1)
        to = min(to, len(texts))
        local = offsets[at : to + 1] - offsets[at]
        words, first = word_hashes(data[offsets[at] : offsets[to]], local)
        yield [distinct(shingle_hashes(words[first[i] : first[i + 1]])) for i in range(to - at)], at
        at = to


def intersection_size(a: np.ndarray, b: np.ndarray) -> int:
    """Common elements of two sorted sets without repeats."""
    if not len(a) or not len(b):
        return 0
    both = np.concatenate((a, b))
    both.sort()
    return int(np.count_nonzero(both[1:] == both[:-1]))
