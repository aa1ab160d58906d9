from __future__ import annotations

from collections import defaultdict

import numpy as np
import public_tokenizers

from orderlake.llm import token_counts

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def plain(text):
    """Counts per line by giving each token, byte by byte, to the line with most of its bytes."""
    encoder = token_counts.SpanEncoder(RANKS, PATTERN).encoding
    text = text or ""
    line_of, line = [], 0
    for byte in text.encode():
        line_of.append(line)
        line += byte == 0x0A
    n = len(text.split("\n")) - (text.endswith("\n") and len(text) > 0)
    counts, at = [0] * n, 0
    for token in encoder.encode_ordinary(text):
        size = len(encoder.decode_single_token_bytes(token))
        lines = line_of[at : at + size]
        counts[max(sorted(set(lines)), key=lines.count)] += 1
        at += size
    return counts


def counted(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    return token_counts.section_tokens(frame, RANKS, PATTERN).collect()


def test_documents_match_plain_counts(spark, table):
    rows = table("documents", "doc_id", "text")[:250]
    got, texts = defaultdict(dict), dict(rows)
    for r in counted(spark, rows):
        got[r.doc_id][r.section] = r
    for doc, text in texts.items():
        sections = [got[doc][k] for k in range(len(got[doc]))]
        assert [s.n_tokens for s in sections] == plain(text)
        assert [text[s.start : s.end] for s in sections] == text.splitlines(keepends=True) or "".join(text[s.start : s.end] for s in sections) == text


def test_crossing_tokens_go_to_the_larger_part():
    ends = np.array([3, 6, 12])
    tokens = np.array([2, 4, 7, 12])  # bytes 0-2, 2-4 (a tie), 4-7 (2 and 1), 7-12
    assert token_counts.owners(tokens, ends).tolist() == [0, 0, 1, 2]
    assert token_counts.owners(np.array([12]), ends).tolist() == [2]


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "\n\n\n"), (4, "é\n😀\nz"), (None, "a\nb"), (5, "<|endoftext|>"), (5, "<|endoftext|>"), (6, "word " * 60_000)]
    by = defaultdict(list)
    for r in counted(spark, rows):
        by[r.doc_id].append(r)
    assert [(r.section, r.n_tokens) for r in by[1]] == [(0, 0)] and [(r.section, r.n_tokens) for r in by[2]] == [(0, 0)]
    assert sum(r.n_tokens for r in by[3]) == sum(plain("\n\n\n")) and len(by[3]) == 3
    assert [(r.start, r.end) for r in sorted(by[4], key=lambda r: r.section)] == [(0, 2), (2, 4), (4, 5)]
    assert len(by[None]) == 2 and len(by[5]) == 2 and by[5][0].n_tokens > 1
    assert by[6][0].n_tokens == plain("word " * 60_000)[0]
    assert counted(spark, []) == []
