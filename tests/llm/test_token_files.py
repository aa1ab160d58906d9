from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from orderlake.llm import token_files
from orderlake.llm.common import scratch_dir

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def whole(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


HARD = ["", None, "It's  a\ttest's  we'll\x0bgo", "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|>", "Ünïcode Σίσυφος ΣΑΣ İstanbul K", "é ́e a b c　d \x1c\x85", "日本語 テキスト 123 4567", "a" * 3000, "!!! ?!,. -- ... 's", "😀 😀😀"]


def test_encoder_equals_tokenizer(tokenizer, table):
    texts = [t for t, in table("documents", "text")][:300] + HARD[:-1] + ["😀😀 x😀"]
    ids, sizes = token_files.WordEncoder(PATH).encode(texts)
    at = 0
    for text, n in zip(texts, sizes):
        assert ids[at : at + n].tolist() == whole(tokenizer, text)
        at += n
    assert at == len(ids)


def test_encoder_forgets_and_learns_again(monkeypatch, tokenizer):
    monkeypatch.setattr(token_files, "CACHE_WORDS", 2)
    monkeypatch.setattr(token_files, "KEPT_WORDS", 2)
    encoder = token_files.WordEncoder(PATH)
    for text in ("one two three", "four one, one. 4. é. %%, a.b. ..", "three three, two"):
        assert encoder.encode([text])[0].tolist() == whole(tokenizer, text)


def test_shard_round_trip_and_random_access():
    rng = np.random.default_rng(2)
    docs = [np.append(np.tile(rng.integers(3, 40, rng.integers(1, 30)), rng.integers(1, 60)), 2).astype(np.uint16) for _ in range(80)] + [np.array([2], np.uint16), np.array([7] * 5001 + [2], np.uint16)]
    ids, sizes = np.concatenate(docs), np.array([len(d) for d in docs])
    payload = token_files.pack(ids, sizes)
    shard = token_files.Shard(payload)
    assert len(shard.rules) > 10 and len(shard.symbols) < len(ids) / 3
    assert (shard.all() == ids).all() and (shard.sizes == sizes).all()
    for k in (0, 5, 40, 80, 81):
        assert (shard.document(k) == docs[k]).all()
    for a, b in ((0, 1), (17, 900), (len(ids) - 3, len(ids)), (400, 400)):
        assert (shard.tokens(a, b) == ids[a:b]).all()
    size = {s: 1 for s in range(token_files.TERMINALS)}
    for r, (a, b) in enumerate(shard.rules.tolist()):
        size[token_files.TERMINALS + r] = size[a] + size[b]
        assert size[token_files.TERMINALS + r] == shard.lengths[r]
    with pytest.raises(ValueError):
        token_files.Shard(payload[:-1])


def digests(spark, rows, **options):
    path = f"{scratch_dir(spark)}/files"
    token_files.write_token_files(spark.createDataFrame(rows, "doc_id long, text string"), path, PATH, **options)
    return sorted(map(tuple, token_files.read_token_digests(spark, path).collect()), key=lambda r: r[1])


def expected(tokenizer, rows):
    start, out = 0, []
    for doc, text in rows:
        ids = whole(tokenizer, text)
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files_of_documents(spark, tokenizer, table):
    rows = table("documents", "doc_id", "text")
    assert digests(spark, rows, shard_ids=20_000) == expected(tokenizer, sorted(rows))


def test_edge_cases(spark, tokenizer):
    rows = [(3, None), (1, ""), (2, "a b c"), (None, "last words"), (7, "x y " * 40_000)]
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    assert digests(spark, rows) == expected(tokenizer, order)
    repeated = digests(spark, [(5, "same"), (5, "same"), (5, "other words")])
    assert [r[0] for r in repeated] == [5, 5, 5] and sorted(r[2] for r in repeated) == sorted(len(whole(tokenizer, t)) for t in ("same", "same", "other words"))
    assert digests(spark, []) == []


def test_capitals_before_marks_are_encoded_as_they_are(spark, tokenizer):
    # only the small letter has a composed form; U+05B0 does not keep a mark after it from composing
    pairs = ["J\u030c", "H\u0331", "T\u0308", "W\u030a", "Y\u030a"]
    assert all(whole(tokenizer, p) != whole(tokenizer, p.lower()) for p in pairs)
    texts = [*pairs, *[f"Some words, aX{p.lower()} {p}A x{p}. {p}," for p in pairs], " ".join(pairs), "T\u05b0\u0308 E\u0301 JOHN \u00c9T\u00c9 e\u0301", "JOHN john"]
    ids, sizes = token_files.WordEncoder(PATH).encode(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [whole(tokenizer, t) for t in texts]
    rows = list(enumerate(texts))
    assert digests(spark, rows) == expected(tokenizer, rows)


def test_rounds_go_on_until_no_pair_is_frequent():
    """A passage of 4,000 ids that repeats 50 times becomes a few symbols, and no frequent pair is left."""
    random = np.random.default_rng(1)
    passage = random.integers(3, 49_000, 4000)
    ids = np.concatenate([np.r_[passage, token_files.END] for _ in range(50)])
    sizes = np.full(50, 4001)
    rules, symbols, ends = token_files.compress(ids, np.cumsum(sizes))
    pairs = np.stack([symbols[:-1], symbols[1:]], axis=1)[~np.isin(np.arange(1, len(symbols)), ends)]
    counts = np.unique(pairs, axis=0, return_counts=True)[1] if len(pairs) else np.zeros(0)
    assert not len(counts) or counts.max() < token_files.LEAST_COUNT or len(rules) == token_files.MOST_RULES
    payload = token_files.pack(ids, sizes)
    shard = token_files.Shard(payload)
    assert (shard.all() == ids).all() and shard.lengths.max() > 1000 and len(symbols) <= 500
    assert (shard.document(7) == ids[7 * 4001 : 8 * 4001]).all() and (shard.tokens(4100, 12_345) == ids[4100:12_345]).all()


def test_words_with_marks_at_the_end_are_put_together(tokenizer):
    """Stems are learned once, runs of marks behind them as well; words of a-z take the model alone."""
    stems = ["word", "naïve", "caffè", "É", "ß", "x9", "it's", "3", "×", "÷", "Ā", "日本", "á", "a.b", "-", "ẞ", "don't"]
    ends = ["", ",", ".", "&&&", ",***", "'", "''", "'.", "…", ".×", "|>", "<", "<|", "≠", "%%%", "_", "´"]
    texts = [a + b for a in stems for b in ends] + [" ".join(a + b for a in stems) for b in ends]
    for encoder, part in ((token_files.WordEncoder(PATH), texts), (token_files.WordEncoder(PATH), texts[::-1])):
        ids, sizes = encoder.encode(part)
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [whole(tokenizer, t) for t in part]


def test_marks_at_the_end_take_no_word_of_their_own(tokenizer):
    """Before, a word was remembered once for each run of marks behind it. Long runs that end no word take linear time."""
    stems, ends = [f"w{a}x{b}" for a in range(20) for b in range(20)], [",", ".", "!!", "&&&", "'.", ")"]
    encoder = token_files.WordEncoder(PATH)
    texts = [" ".join(s + e for s in stems) for e in ends] + ["a" + "!" * 200_000 + "b", "café" + "?." * 100_000]
    ids, sizes = encoder.encode(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [whole(tokenizer, t) for t in texts]
    assert len(encoder.places) <= len(stems) + len(ends) + 4


def test_a_worker_remembers_a_bounded_number_of_words(tokenizer):
    """A million distinct words; before, a worker kept 1.5 million of them, some 250 MB."""
    encoder, letters = token_files.WordEncoder(PATH), "abcdefghijklmnopqrstuvwxyz"
    words = [a + b + c + d + e for a in letters[:14] for b in letters[:16] for c in letters[:16] for d in letters[:16] for e in letters[:16]]
    most = 0
    for at in range(0, len(words), 1 << 16):
        encoder.encode([" ".join(words[at : at + (1 << 16)])])
        most = max(most, len(encoder.places))
    assert most <= 500_000 and len(encoder.ids) <= 1 << 22
    assert encoder.encode([words[0], words[-1]])[0].tolist() == whole(tokenizer, words[0]) + whole(tokenizer, words[-1])
