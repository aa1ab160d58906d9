"""License scan by diagonal voting, in DataFrame functions only.

Texts are lower-cased in A-Z and cut into words. The hashes of all rolling
k-grams of words are joined to the template library; each match votes for a
diagonal, the place where the template's first word would stand, and the whole
template is laid on that diagonal: its *aligned* words are those that are equal, also
single ones between k-grams. Neighbouring diagonals of a row and template are merged (words
may be put in or left out), and a merged span is verified. Its share is the number of aligned words
over the template's words plus the words put in or left out; it must be ``LEAST_SHARE``, on a
stretch of at most twice the template. A template's key phrases, without which it would be
another license, must each stand whole on one diagonal. Of verified spans of several labels
that share words the best covered stay. The hash only finds matches, words are compared.

Base places are diagonals on which the whole of a base phrase matches; they always stay, and nothing less counts. ``labels``
has the base labels and those of verified spans; ``score`` is the best verified
share (1 for a base place, 0 without any label).

The library has a fixed number of templates, so its grams are broadcast. A span is at most
twice as long as its template, so a bucket of LONGEST words holds a bounded number of them.

Defined cases: null and empty texts, and texts of fewer than k words, match
nothing and have empty labels; repeated rows give one row each; an empty table
gives none. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlake.llm.common import lower_ascii

K = 3
#: Diagonals of one template so close together are merged.
NEAR = 2
LEAST_SHARE = 0.7

# Base phrases with their labels, then templates of the method's own labels with their key phrases.
BASE = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
TEMPLATES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit", ()),
    ("licensed under the apache license version 2 0", "apache-2", ("apache", "2")),
    ("you may not use this file except in compliance with the license", "apache-2", ()),
    ("licensed under a creative commons attribution noncommercial license", "cc-by-nc", ("noncommercial",)),
    ("licensed under the gnu general public license version 3", "gpl-3", ("gnu general", "3")),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl", ("gnu general",)),
    ("under the terms of the gnu lesser general public license", "lgpl", ("gnu lesser general",)),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd", ()),
    ("this source code form is subject to the terms of the mozilla public license", "mpl-2", ("mozilla",)),
    ("licensed under a creative commons attribution sharealike license", "cc-by-sa", ("sharealike",)),
)
#: Words of a bucket: more than any span has.
LONGEST = 64

_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(text), _BREAK), "")


def _gram(array: Column, at: Column) -> Column:
    return F.xxhash64(*[array[at + k] for k in range(K)])


def _grams(array: Column) -> Column:
    places = F.when(F.size(array) >= K, F.sequence(F.lit(0), F.size(array) - K)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: _gram(array, i))


def _key_places(phrase: str, keys: tuple[str, ...]) -> list[list[int]]:
    """Places in the template of each key phrase's words."""
    tw = phrase.split()
    found = [[i for i in range(len(tw)) if tw[i : i + len(k.split())] == k.split()] for k in keys]
    return [list(range(at[-1], at[-1] + len(k.split()))) for k, at in zip(keys, found)]


def _listed() -> list[tuple[int, str, str, bool, list[list[int]]]]:
    listed = [(text, label, True, ()) for text, label in BASE] + [(text, label, False, keys) for text, label, keys in TEMPLATES]
    return [(i, text, label, base, _key_places(text, keys)) for i, (text, label, base, keys) in enumerate(listed)]


def library(spark: SparkSession) -> DataFrame:
    """One row per template: template, label, is_base, its words tw, keys."""
    none = F.array().cast("array<array<int>>")
    rows = F.array(*[
        F.struct(F.lit(i).alias("template"), F.lit(label).alias("label"), F.lit(base).alias("is_base"), F.split(F.lit(text), " ").alias("tw"),
                 (F.array(*[F.array(*[F.lit(x) for x in k]) for k in keys]) if keys else none).alias("keys"))
        for i, text, label, base, keys in _listed()])
    return spark.range(1).select(F.inline(rows))


def template_grams(spark: SparkSession) -> DataFrame:
    """One row per k-gram of the library: template, n_template, at, gram, its words."""
    out = library(spark).select("template", "tw", F.size("tw").alias("n_template"), F.posexplode(_grams(F.col("tw"))).alias("at", "gram"))
    return out.select("template", "n_template", "at", "gram", *[F.col("tw")[F.col("at") + k].alias(f"t{k}") for k in range(K)])


def votes(docs: DataFrame) -> DataFrame:
    """Diagonals with a matching k-gram: doc_id, text_hash, template, diagonal, and the words there (``window``, without
    those that would stand before the text's first)."""
    split = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.coalesce("text", F.lit(""))).alias("words"))
    # the grams are a column of their own: a generator of an expression that isn't compiled would copy the words for each
    # gram; words that are never null and an outer generator keep Spark from filtering, hence splitting, the texts twice
    rolled = split.withColumn("grams", _grams(F.col("words"))).select("doc_id", "text_hash", "words", F.posexplode_outer("grams").alias("place", "gram"))
    found = rolled.join(F.broadcast(template_grams(docs.sparkSession)), "gram")
    for k in range(K):
        found = found.filter(F.col("words")[F.col("place") + k] == F.col(f"t{k}"))
    diagonal = F.col("place") - F.col("at")
    window = F.slice("words", F.greatest(diagonal, F.lit(0)) + 1, F.col("n_template") + F.least(diagonal, F.lit(0)))
    seen = found.select("doc_id", "text_hash", "template", diagonal.alias("diagonal"), window.alias("window"))
    # repeated rows vote alike, and all votes for a diagonal see the same words
    return seen.groupBy("doc_id", "text_hash", "template", "diagonal").agg(F.first("window").alias("window"))


def aligned_diagonals(voted: DataFrame) -> DataFrame:
    """The diagonals with their template, the places in it whose words stand there (``aligned``) and the numbers of
    the key phrases that stand whole (``whole_keys``)."""
    laid = voted.join(F.broadcast(library(voted.sparkSession)), "template")
    before = F.greatest(-F.col("diagonal"), F.lit(0))
    here = F.transform(F.sequence(F.lit(0), F.size("tw") - 1), lambda i: F.when((i >= before) & (F.get("window", i - before) == F.get("tw", i)), i))
    laid = laid.withColumn("aligned", F.array_compact(here)).withColumn("n_template", F.size("tw"))
    whole = F.array_compact(F.transform("keys", lambda key, n: F.when(F.size(F.array_except(key, F.col("aligned"))) == 0, n)))
    return laid.select("doc_id", "text_hash", "template", "label", "is_base", "n_template", F.size("keys").alias("n_keys"), "diagonal", "aligned", whole.alias("whole_keys"))


def _spans(docs: DataFrame, row: list[str]) -> DataFrame:
    """Merged diagonals: row, label, low and high word, share, verified, n_base, first_word, last_word."""
    template = ["template", "label", "is_base", "n_template", "n_keys"]
    diagonals = aligned_diagonals(votes(docs))
    along = Window.partitionBy(*row, "template").orderBy("diagonal")
    apart = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(along) > NEAR).cast("int"), F.lit(0))
    merged = diagonals.withColumn("apart", apart).withColumn("span", F.sum("apart").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    whole = F.col("is_base") & (F.size("aligned") == F.col("n_template"))
    spans = merged.groupBy(*row, *template, "span").agg(
        F.size(F.array_distinct(F.flatten(F.collect_set("aligned")))).alias("covered"), F.size(F.array_distinct(F.flatten(F.collect_set("whole_keys")))).alias("n_whole"),
        F.min(F.col("diagonal") + F.array_min("aligned")).alias("low"), F.max(F.col("diagonal") + F.array_max("aligned")).alias("high"),
        (F.max("diagonal") - F.min("diagonal")).alias("shift"),
        F.sum(whole.cast("long")).alias("n_base"), F.min(F.when(whole, F.col("diagonal"))).alias("first_word"), F.max(F.when(whole, F.col("diagonal"))).alias("last_word"),
    )
    share = F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.col("covered") / (F.col("n_template") + F.col("shift")))
    fits = ~F.col("is_base") & (F.col("high") + 1 - F.col("low") <= 2 * F.col("n_template")) & (F.col("n_whole") == F.col("n_keys")) & (F.col("share") >= LEAST_SHARE)
    return spans.withColumn("share", share).withColumn("verified", (F.col("n_base") > 0) | fits)


def _without_beaten(spans: DataFrame, row: list[str]) -> DataFrame:
    """Verified spans but those that share words with a better covered span of another label; base places stay.

    Spans that share words meet in a bucket of text, which holds a bounded number of them; base places of a
    span are counted apart, so a long run of them is one competitor in each bucket.
    """
    good = spans.filter("verified")
    buckets = F.when(F.col("n_base") > 0, F.array(F.floor(F.col("low") / LONGEST))).otherwise(
        F.sequence(F.floor(F.col("low") / LONGEST), F.floor(F.col("high") / LONGEST)))
    placed = good.withColumn("bucket", F.explode(buckets))
    rivals = F.collect_list(F.struct("label", "low", "high", "share")).over(Window.partitionBy(*row, "bucket"))
    beaten = F.exists("rivals", lambda r: (r["label"] != F.col("label")) & (r["low"] <= F.col("high")) & (r["high"] >= F.col("low")) & (r["share"] > F.col("share")))
    judged = placed.withColumn("rivals", rivals).withColumn("beaten", beaten & (F.col("n_base") == 0)).drop("rivals")
    one = judged.groupBy(*row, "template", "label", "span").agg(F.max("beaten").alias("beaten"), *[F.max(c).alias(c) for c in ("share", "n_base", "first_word", "last_word")])
    return one.filter("not beaten")


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) per row of docs(doc_id, text)."""
    row = ["doc_id", "text_hash"]
    by_row = _without_beaten(_spans(docs, row), row).groupBy(*row).agg(
        F.sum("n_base").alias("n_base"), F.min("first_word").alias("first_word"), F.max("last_word").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("n_base") > 0, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"), F.max("share").alias("score"),
    )
    by_row = by_row.select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash"), *by_row.columns[2:])
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.coalesce(F.regexp_count("text", F.lit(_WORD)), F.lit(0)).cast("long").alias("n_words"))
    out = rows.join(by_row, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_hash") == F.col("_hash")), "left")
    return out.select(
        F.col("doc_id").cast("long").alias("doc_id"), "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def _values() -> str:
    return ", ".join(f"({i}, '{text}', '{label}', {str(base).lower()}, {keys}::INTEGER[][])" for i, text, label, base, keys in _listed())


ORACLE = f"""
WITH templates AS (
  SELECT id, string_split(phrase, ' ') AS tw, label, is_base, keys FROM (VALUES {_values()}) v(id, phrase, label, is_base, keys)),
tgrams AS (
  SELECT id, a - 1 AS tpos, array_to_string(tw[a:a + {K - 1}], ' ') AS gram
  FROM (SELECT *, unnest(generate_series(1, len(tw) - {K - 1})) AS a FROM templates)),
d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
voted AS (
  SELECT DISTINCT rid, id, place - 1 - tpos AS diagonal
  FROM (SELECT rid, place, array_to_string(w[place:place + {K - 1}], ' ') AS gram
        FROM (SELECT rid, w, unnest(generate_series(1, len(w) - {K - 1})) AS place FROM d WHERE len(w) >= {K})) g
  JOIN tgrams USING (gram)),
laid AS (
  SELECT rid, id, label, is_base, len(tw) AS n, keys, diagonal,
    list_filter(range(0, len(tw)), lambda a: diagonal + a >= 0 AND coalesce(w[diagonal + a + 1] = tw[a + 1], false)) AS aligned
  FROM voted JOIN d USING (rid) JOIN templates USING (id)),
diagonals AS (
  SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY rid, id ORDER BY diagonal) > {NEAR} THEN 1 ELSE 0 END AS apart,
    list_filter(range(1, len(keys) + 1), lambda k: list_has_all(aligned, keys[k])) AS whole
  FROM laid),
merged AS (SELECT *, sum(apart) OVER (PARTITION BY rid, id ORDER BY diagonal) AS span FROM diagonals),
spans AS (
  SELECT rid, id, label, is_base, n, span, any_value(len(keys)) AS n_keys,
    len(list_distinct(flatten(list(aligned)))) AS covered, len(list_distinct(flatten(list(whole)))) AS n_whole,
    min(diagonal + list_min(aligned)) AS low, max(diagonal + list_max(aligned)) AS high, max(diagonal) - min(diagonal) AS shift,
    count(*) FILTER (is_base AND len(aligned) = n) AS n_base,
    min(diagonal) FILTER (is_base AND len(aligned) = n) AS first_word, max(diagonal) FILTER (is_base AND len(aligned) = n) AS last_word
  FROM merged GROUP BY rid, id, label, is_base, n, span),
shares AS (SELECT *, CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE covered / (n + shift) END AS share FROM spans),
good AS (
  SELECT * FROM shares WHERE n_base > 0 OR (NOT is_base AND high + 1 - low <= 2 * n AND n_whole = n_keys AND share >= {LEAST_SHARE})),
kept AS (
  SELECT * FROM good g WHERE n_base > 0 OR NOT EXISTS (
    SELECT 1 FROM good r WHERE r.rid = g.rid AND r.label <> g.label AND r.low <= g.high AND r.high >= g.low AND r.share > g.share
      AND (r.n_base = 0 OR r.low // {LONGEST} BETWEEN g.low // {LONGEST} AND g.high // {LONGEST}))),
by_row AS (
  SELECT rid, sum(n_base) AS n_base, min(first_word) AS first_word, max(last_word) AS last_word,
         array_to_string(list_sort(list(DISTINCT label) FILTER (n_base > 0)), ',') AS base_labels,
         array_to_string(list_sort(list(DISTINCT label)), ',') AS labels, max(share) AS score
  FROM kept GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN by_row USING (rid)
"""
