from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from orderlake.llm import language_id as li

LANGS = list(li.LANGUAGES)


def plain_scores(text, model):
    """Text posterior, trigram by trigram."""
    data = [c if 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in (text or "").encode()]
    data, logs, n = [32, *data, 32], np.zeros(4), 0
    for a, b, c in zip(data, data[1:], data[2:]):
        if b != 32:
            bucket = (((a << 16 | b << 8 | c) * 2654435761) & 0xFFFFFFFF) >> 17
            logs += model[bucket].astype(float)
            n += 1
    share = np.exp(logs / 3 - (logs / 3).max())
    return share / share.sum(), n


def brute_force(rows, model):
    """rows: (id, text, host, suffix, declared) -> (language, posterior, accepted) by the formulas of the module, row by row."""
    scored = [plain_scores(r[1], model) for r in rows]
    used = [k for k, (_, n) in enumerate(scored) if n]
    out = []
    part = lambda host: ".".join(host.split(".")[-2:])
    corpus = (sum((scored[k][0] for k in used), np.zeros(4)) + 1) / (len(used) + 4)
    everyone = sum((scored[k][0] for k in used), np.zeros(4))
    for k, (share, n) in enumerate(scored):
        if not n:
            out.append((rows[k][0], None, None, False))
            continue
        prior, host = corpus.copy(), rows[k][2]
        for key in (part, lambda h: h):
            same = [j for j in used if j != k and host is not None and rows[j][2] is not None and key(rows[j][2]) == key(host)]
            prior = (sum((scored[j][0] for j in same), np.zeros(4)) + li.KAPPA * prior) / (len(same) + li.KAPPA)
        log = np.log(np.maximum(share, 1e-300)) + np.log(prior)
        for column in (3, 4):
            if rows[k][column] is not None:
                values = {rows[j][column] for j in used if rows[j][column] is not None}
                same = [j for j in used if j != k and rows[j][column] == rows[k][column]]
                log += np.log((sum((scored[j][0] for j in same), np.zeros(4)) + 1) / (everyone - share + len(values)))
        chance = np.exp(log - log.max())
        chance /= chance.sum()
        out.append((rows[k][0], LANGS[int(log.argmax())], chance.max(), bool(chance.max() >= li.LEAST)))
    return out


def model_of(spark, table):
    return li.train(spark.createDataFrame(table("documents", "doc_id", "text", "lang"), "doc_id long, text string, label string"))


def identified(spark, rows, model):
    docs = spark.createDataFrame(rows, "id long, text string, host string, suf string, decl string")
    return li.identify(docs, model, "text", F.col("host"), F.col("suf"), F.col("decl"), ["id"])


def test_fusion_matches_brute_force(spark, table):
    texts = [t for t, in table("documents", "text")]
    rows = [(k, t[: 12 + 5 * k % 40], f"h{k % 5}.d{k % 3}.example", ("fr", "org", None)[k % 3], ("fr", "en", None, "de")[k % 4]) for k, t in enumerate(texts[:90])]
    rows += [(900, None, None, None, None), (901, "", "h1.d1.example", "fr", "fr"), (902, "123 $$$", "h1.d1.example", "fr", "fr"), (903, "e", None, None, None), (903, "e", None, None, None), (904, texts[0] * 40, "alone", None, "xx")]
    model = model_of(spark, table)
    got = {}
    for r in identified(spark, rows, model).collect():
        got.setdefault(r.id, []).append(r)
    want = {}
    for doc, language, chance, good in brute_force(rows, model):
        want.setdefault(doc, []).append((language, chance, good))
    assert got.keys() == want.keys()
    for doc, expected in want.items():
        for r, (language, chance, good) in zip(got[doc], expected):
            assert (r.language, r.accepted) == (language, good)
            assert chance is None or math.isclose(r.posterior, chance, rel_tol=1e-9)


def test_evidence_decides_short_texts(spark, table):
    model = model_of(spark, table)
    french = [t for t, lang in table("documents", "text", "lang") if lang == "fr"][:60]
    rows = [(k, t, "x.fr.example", "fr", "fr") for k, t in enumerate(french)] + [(1000, "a", "x.fr.example", "fr", "fr"), (1001, "a", None, None, None)]
    by = {r.id: r for r in identified(spark, rows, model).collect()}
    assert by[1000].language == "fr" and by[1000].posterior > by[1001].posterior * 0.9


def test_held_out_accuracy(spark, table):
    rows = table("documents", "doc_id", "text", "lang")
    frame = spark.createDataFrame(rows, "doc_id long, text string, label string")
    model = li.train(frame.filter("doc_id % 5 <> 0"), train_rows=300)
    held = [r for r in rows if r[0] % 5 == 0]
    share, _ = li.text_scores(pa.array([t for _, t, _ in held]), model)
    right = sum(LANGS[k] == lang for k, (_, _, lang) in zip(share.argmax(axis=1), held))
    assert right / len(held) > 0.98


def test_documents_keep_clean_rows(spark, table):
    rows = table("documents", "doc_id", "text", "lang", "source")
    got = li.document_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), ["doc_id", "lang"]).collect()
    assert len(got) == len(rows) and sum(r.accepted for r in got) == len(rows)
    assert sum(r.language == r.lang for r in got) / len(got) > 0.99


def test_empty_table_and_clashing_columns(spark):
    schema = "doc_id long, text string, lang string, source string, language string, n_grams int, _host string"
    empty = spark.createDataFrame([], schema)
    assert li.document_languages(empty, ["doc_id", "source"]).collect() == []
    one = spark.createDataFrame([(1, "the only text there is", "en", "s", "zz", 9, "q")], schema)
    row = li.document_languages(one, ["doc_id", "text", "language", "n_grams"]).collect()[0]
    assert row.language == "en" and row.text.startswith("the only") and row.n_grams > 9


def test_carried_columns_keep_their_values_whatever_their_names(spark):
    names = ["_host", "_suffix", "_declared", "_t0", "_fits", "_text", "_c0", "_domain", "a.b"]
    schema = "doc_id long, text string, lang string, source string, " + ", ".join(f"`{c}` string" for c in names)
    docs = spark.createDataFrame([(1, "the only text there is", "en", "s", *[f"own {c}" for c in names])], schema)
    got = li.document_languages(docs, ["doc_id", *names])
    assert got.columns == ["doc_id", *names, "language", "posterior", "text_language", "n_grams", "accepted"]
    row = got.collect()[0]
    assert [row[c] for c in names] == [f"own {c}" for c in names] and row.language == "en"


def test_a_very_long_text(spark, table):
    model = model_of(spark, table)
    text = " ".join(t for t, lang in table("documents", "text", "lang") if lang == "de")
    long = text * (4_000_000 // len(text) + 1)  # several segments
    short, whole = (r for r in sorted(identified(spark, [(1, text, None, None, None), (2, long, None, None, None)], model).collect(), key=lambda r: r.id))
    assert whole.language == short.language == "de" and whole.accepted and whole.n_grams > 4 * li.SEGMENT_BYTES // 2


def test_character_references_of_pages_are_decoded(spark, table):
    labelled = spark.createDataFrame(table("documents", "doc_id", "text", "lang"), "doc_id long, text string, label string")
    plain = "<p>Où est la forêt ? Été à l'école &lt;b&gt; é</p>"
    coded = "<p>O&ugrave; est la for&#234;t ? &Eacute;t&#xE9; &agrave; l&#39;&eacute;cole &lt;b&gt; &eacute</p>"
    pages = spark.createDataFrame([(1, None, plain), (2, None, coded), (3, None, "&nbsp;&amp;"), (4, None, "&#0;&#xD800; &#99999999;")], "page_id long, url string, html string")
    got = {r.page_id: r for r in li.page_languages(pages, labelled, ["page_id"]).collect()}
    assert (got[2].text_language, got[2].n_grams) == (got[1].text_language, got[1].n_grams) and len(got) == 4


def test_pages_by_markup_and_address(spark, table):
    pages = spark.createDataFrame(table("pages", "page_id", "url", "html")[:80] + [(-1, None, None), (-2, "nonsense", "<html lang=fr>")], "page_id long, url string, html string")
    labelled = spark.createDataFrame(table("documents", "doc_id", "text", "lang"), "doc_id long, text string, label string")
    got = {r.page_id: r for r in li.page_languages(pages, labelled, ["page_id", "url"]).collect()}
    assert len(got) == 82 and got[-1].language is None and got[-2].language is None
    assert sum(f"/{r.language}/" in (r.url or "") for r in got.values()) > 70


UNKNOWN = {
    "Russian": "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью.",
    "Polish": "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem.",
    "Japanese": "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。",
    "Italian": "Tutti gli esseri umani nascono liberi ed eguali in dignità e diritti. Essi sono dotati di ragione e di coscienza.",
    "random letters": "qzvk wxjb pfgh ykqd zzrw mbxv jqpt fkgz vwhx cqdk xjyb zkqv wpfj gxhq bvzk dqwx",
    "base64": "VGhpcyBpc0EgdGVzdCBvZiBhIGxvbmcgc3RyaW5n/kJ8Zq0xYw9TbUvRfHdLqPzX7cNgM2eA5iOoKtWyBhVxQj3sDl6G==",
    "code": "def f(self, x):\n    for i in range(len(x)):\n        if x[i] is None: return self.buf[i + 1]\n    raise ValueError('bad index')\n",
}


def test_unknown_texts_have_no_language(spark, table):
    clean = table("documents", "doc_id", "text", "lang", "source")
    foreign = [(-k, text * times, "en", "src0") for k, (text, times) in enumerate(((t, n) for t in UNKNOWN.values() for n in (1, 30)), 1)]
    schema = "doc_id long, text string, label string, lang string, source string"
    docs = spark.createDataFrame([(d, t, lang, lang, s) for d, t, lang, s in clean + foreign], schema)
    model = li.train(docs.filter("doc_id >= 0").select("doc_id", "text", "label"))
    by = {}
    for r in li.identify(docs, model, "text", F.col("source"), F.lit(None), F.lit(None), ["doc_id"]).collect():
        by.setdefault(r.doc_id, r)
    assert all(by[d].accepted for d, *_ in clean)
    assert [(name, by[-2 * k - j]) for k, name in enumerate(UNKNOWN) for j in (1, 2) if by[-2 * k - j].accepted or by[-2 * k - j].language] == []
    assert all(by[d].text_language in LANGS and by[d].posterior is None for d, *_ in foreign)


def test_texts_that_do_not_fit_are_no_evidence(spark, table):
    model = model_of(spark, table)
    french = [t for t, lang in table("documents", "text", "lang") if lang == "fr"][:8]
    rows = [(k, t, "x.example", "fr", "fr") for k, t in enumerate(french)]
    alone = {r.id: r for r in identified(spark, rows, model).collect()}
    mixed = {r.id: r for r in identified(spark, rows + [(100 + k, UNKNOWN["Russian"], "x.example", "ru", "de") for k in range(40)], model).collect()}
    for k in alone:
        assert mixed[k].language == "fr" and math.isclose(mixed[k].posterior, alone[k].posterior, rel_tol=1e-6)


def test_unseen_trigrams_favour_no_language(spark, table):
    rows = [(k, t, lang) for k, (t, lang) in enumerate(table("documents", "text", "lang")) if lang != "es" or k % 20 == 0]
    model = li.train(spark.createDataFrame(rows, "doc_id long, text string, label string"))
    assert np.allclose(model.min(axis=0), model.min())
