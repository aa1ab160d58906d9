"""Language of each document by fusing evidence in Bayes' way.

posterior(l) ~ text likelihood * P(declared markup language | l)
               * P(address suffix | l) * prior of the host(l)

* Text: a multinomial over hashed byte trigrams of the whole text, lower-cased
  in A-Z, non-letters as blanks, trained on a bounded sample of labelled rows
  (``TRAIN_ROWS``), mixed with a uniform share (``UNSEEN``), so that a trigram
  that no labelled row holds is as likely in each language. Trigrams overlap, so
  the logarithm is divided by 3.
* Everything else is estimated over all rows, by grouped sums of the rows' text
  posteriors: the two likelihoods with add-one smoothing, and the priors along
  corpus -> domain -> host, each level shrunk towards the one above with the
  weight of ``KAPPA`` rows and without the row's own part.

Besides the languages there is the unknown text, whose trigrams are uniform over
all buckets. A text fits if it is no more likely to be unknown than to be in its
likeliest language, that is if the mean logarithm of its trigrams there is
``UNKNOWN`` = -10.4 or more. The shares are among the languages only, so they
can't tell this. Texts that don't fit are no evidence for other rows.

A row is accepted if its text fits and the best language's posterior is
``LEAST`` or more.

Defined cases: null or empty texts, texts without letters, and texts that don't
fit have no language and are not accepted; ``text_language`` is then the nearest
language, if there are letters. A null host, suffix or declaration is a missing value: no
evidence, and no prior but the corpus's. Ties go to the language listed first.
Repeated rows count each. An empty table gives none. ``carry`` columns are
returned unchanged, whatever their names; those named like an added column are
replaced. In pages, character references are decoded after the markup is taken out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import arrow, land
from orderlake.llm.hashing import hash_fraction, row_key

LANGUAGES = ("en", "fr", "de", "es")
#: Labelled rows that the text model is fitted on, about.
TRAIN_ROWS = 4000
BUCKETS = 1 << 15
OVERLAP = 3
KAPPA = 20.0
LEAST = 0.5
#: Share of each language's trigrams that is dealt evenly over all buckets.
UNSEEN = 0.01
#: Logarithm of a trigram's probability in an unknown text.
UNKNOWN = -float(np.log(BUCKETS))
#: Bytes of text that are scored together.
SEGMENT_BYTES = 1 << 18

_LETTERS = np.array([c if 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256)], dtype=np.uint8)


def _segments(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(buckets of the trigrams, their rows, bounds of rows) by segments; blanks and crossings are left out."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = min(len(texts), max(at + 1, int(np.searchsorted(offsets, offsets[at] + SEGMENT_BYTES, side="right")) - 1))
        local = offsets[at : to + 1] - offsets[at]
        part = _LETTERS[data[offsets[at] : offsets[to]]]
        # a blank before and after each text, so that short words have trigrams
        padded = np.insert(part, local[:-1], 0x20)
        padded = np.append(padded, [0x20, 0x20]).astype(np.uint32)
        starts = local[:-1] + np.arange(to - at)
        gram = padded[:-2] << 16 | padded[1:-1] << 8 | padded[2:]
        bounds = np.append(starts, len(gram))
        good = padded[1:-1] != 0x20  # its middle is a letter: the trigram then lies in one text
        kept = np.concatenate(([0], np.cumsum(good)))[bounds]
        yield (gram[good] * np.uint32(2654435761)) >> np.uint32(32 - 15), kept, np.arange(at, to)
        at = to


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        labels = batch.column("label").to_pylist()
        total: dict[str, np.ndarray] = {}
        for buckets, bounds, rows in _segments(batch.column("text")):
            for k, row in enumerate(rows):
                part = buckets[bounds[k] : bounds[k + 1]]
                own = total.setdefault(labels[row], np.zeros(BUCKETS, np.int64))
                own += np.bincount(part, minlength=BUCKETS)
        for label, counts in total.items():
            where = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([label] * len(where), pa.string()), pa.array(where, pa.int64()), pa.array(counts[where], pa.int64())], ["label", "bucket", "n"])


def train(labelled: DataFrame, languages: Sequence[str] = LANGUAGES, train_rows: int = TRAIN_ROWS) -> np.ndarray:
    """Log-probabilities (bucket, language) from about train_rows rows of labelled(doc_id, text, label).

    The rows are chosen by hash; only counts by bucket reach the driver.
    """
    rows = labelled.filter(F.col("label").isin(*languages))
    n = max(1, rows.count())
    sample = rows.filter(hash_fraction(F.concat(F.lit("train:"), row_key())) < min(1.0, train_rows / n))
    counted = arrow(_count, sample.select(F.col("label").cast("string"), F.col("text").cast("string")), "label string, bucket long, n long")
    counts = np.zeros((BUCKETS, len(languages)))
    for row in counted.groupBy("label", "bucket").agg(F.sum("n").alias("n")).collect():
        counts[row["bucket"], languages.index(row["label"])] += row["n"]
    return np.log((1 - UNSEEN) * counts / np.maximum(counts.sum(axis=0), 1) + UNSEEN / BUCKETS).astype(np.float32)


def text_logs(texts: pa.Array, model: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The logarithm of each text's likelihood by language, and its number of trigrams."""
    logs, n = np.zeros((len(texts), model.shape[1])), np.zeros(len(texts), np.int64)
    for buckets, bounds, rows in _segments(texts):
        n[rows] = np.diff(bounds)
        full = np.flatnonzero(n[rows])
        if len(full):
            logs[rows[full]] = np.add.reduceat(model[buckets], bounds[full], axis=0, dtype=np.float64)
    return logs, n


def shares(logs: np.ndarray) -> np.ndarray:
    """Posteriors of likelihoods, without other evidence."""
    logs = logs / OVERLAP
    logs -= logs.max(axis=1, keepdims=True, initial=-np.inf) if len(logs) else 0
    share = np.exp(logs)
    return share / share.sum(axis=1, keepdims=True)


def text_scores(texts: pa.Array, model: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's posterior by its text alone, and its number of trigrams."""
    logs, n = text_logs(texts, model)
    return shares(logs), n


def _decoded(texts: pa.Array) -> pa.Array:
    """Texts with their character references decoded."""
    return pa.array([unescape(t) if t and "&" in t else t for t in texts.to_pylist()], pa.large_string())


def _score(batches: Iterator[pa.RecordBatch], sent, text: str, carried: list[str], references: bool) -> Iterator[pa.RecordBatch]:
    model = sent.value
    for batch in batches:
        texts = batch.column(text)
        logs, n = text_logs(_decoded(texts) if references else texts, model)
        share, fits = shares(logs), (n > 0) & (logs.max(axis=1, initial=-np.inf) >= n * UNKNOWN)
        names = [f"_t{k}" for k in range(model.shape[1])]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in carried], pa.array(n), pa.array(fits), *[pa.array(share[:, k]) for k in range(len(names))]], [*carried, "n_grams", "_fits", *names])


def domain(host: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(host, ".", -2)


def suffix(host: Column) -> Column:
    """The last label of a host that has several."""
    return F.when(F.instr(host, ".") > 0, F.substring_index(host, ".", -1))


def identify(
    docs: DataFrame, model: np.ndarray, text: Column | str, host: Column, address_suffix: Column, declared: Column, carry: Sequence[str], languages: Sequence[str] = LANGUAGES, references: bool = False
) -> DataFrame:
    """The carried columns of docs with language, posterior, text_language, n_grams and accepted.

    With ``references``, character references of the texts are decoded. The carried columns travel under numbers, so that
    none clashes with a column used here. A text given by its column's name is sent once, also if it is carried.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)
    size = range(len(languages))
    carried = [c for c in carry if c not in ("language", "posterior", "text_language", "n_grams", "accepted")]
    numbers = [f"_c{k}" for k in range(len(carried))]

    def scored(keep: list[str]) -> DataFrame:
        known_of = [host.cast("string").alias("_host"), address_suffix.cast("string").alias("_suffix"), declared.cast("string").alias("_declared")]
        fields = [*keep, "_host", "_suffix", "_declared"]
        sent_as = keep[carried.index(text)] if keep and isinstance(text, str) and text in carried else "_text"
        own = [] if sent_as in keep else [(F.col(text) if isinstance(text, str) else text).cast("string").alias("_text")]
        rows = docs.select(*[F.col(f"`{c}`").alias(k) for k, c in zip(keep, carried)], *known_of, *own)
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*[F.col(f"`{c}`") for c in fields]).schema)
        return arrow(partial(_score, sent=sent, text=sent_as, carried=fields, references=references), rows, f"{kinds}, n_grams long, _fits boolean, " + ", ".join(f"_t{k} double" for k in size))

    sums = [F.sum(f"_t{k}").alias(f"s{k}") for k in size]
    again = [F.sum(f"s{k}").alias(f"s{k}") for k in size]
    # sums over all rows whose text fits, by all that is known of a row besides it
    known = land(scored([]).filter("_fits").groupBy("_host", "_suffix", "_declared").agg(F.count("*").alias("n"), *sums), "evidence")
    total = known.agg(F.sum("n").alias("n"), *again).first()
    corpus = [((total[f"s{k}"] or 0.0) + 1.0) / ((total["n"] or 0) + len(languages)) for k in size]

    def level(name: str, key: Column) -> DataFrame:
        grouped = known.filter(key.isNotNull()).groupBy(key.alias(name)).agg(F.sum("n").alias("n"), *again)
        return land(grouped.select(name, F.struct("n", *[f"s{k}" for k in size]).alias(f"{name}_sums")), name)

    rows = scored(numbers).withColumn("_domain", domain(F.col("_host")))
    for name, key in (("_host", F.col("_host")), ("_domain", domain(F.col("_host"))), ("_suffix", F.col("_suffix")), ("_declared", F.col("_declared"))):
        rows = rows.join(level(name, key), name, "left")
    values = {name: known.filter(F.col(name).isNotNull()).select(name).distinct().count() for name in ("_suffix", "_declared")}

    def without_own(name: str, field: str, own: Column) -> Column:
        return F.greatest(F.coalesce(F.col(f"{name}_sums.{field}"), F.lit(0.0)) - own, F.lit(0.0))

    logs = []
    counted = F.col("_fits").cast("double")
    for k in size:
        own = F.col(f"_t{k}") * counted
        prior: Column = F.lit(corpus[k])
        for name in ("_domain", "_host"):
            prior = (without_own(name, f"s{k}", own) + KAPPA * prior) / (without_own(name, "n", counted) + KAPPA)
        log = F.ln(F.greatest(F.col(f"_t{k}"), F.lit(1e-300))) + F.ln(prior)
        for name, n_values in values.items():
            all_ = F.lit(float(total[f"s{k}"] or 0.0)) - own
            log = log + F.when(F.col(name).isNotNull(), F.ln((without_own(name, f"s{k}", own) + 1) / (F.greatest(all_, F.lit(0.0)) + max(1, n_values)))).otherwise(F.lit(0.0))
        logs.append(log)
    rows = rows.withColumn("_logs", F.array(*logs)).withColumn("_best", F.array_max("_logs"))
    rows = rows.withColumn("_at", (F.array_position("_logs", F.col("_best")) - 1).cast("int"))
    rows = rows.withColumn("posterior", 1 / F.aggregate("_logs", F.lit(0.0), lambda acc, x: acc + F.exp(x - F.col("_best"))))
    names, texts = F.array(*[F.lit(x) for x in languages]), F.array(*[F.col(f"_t{k}") for k in size])
    with_text = F.col("n_grams") > 0
    return rows.select(
        *[F.col(k).alias(c) for k, c in zip(numbers, carried)],
        F.when(F.col("_fits"), names[F.col("_at")]).alias("language"),
        F.when(F.col("_fits"), F.col("posterior")).alias("posterior"),
        F.when(with_text, names[(F.array_position(texts, F.array_max(texts)) - 1).cast("int")]).alias("text_language"),
        "n_grams",
        (F.col("_fits") & (F.col("posterior") >= LEAST)).alias("accepted"),
    )


def document_languages(docs: DataFrame, carry: Sequence[str]) -> DataFrame:
    """Languages of ``documents``: the source stands for the host; there is neither address nor markup."""
    model = train(docs.select("doc_id", "text", F.col("lang").alias("label")))
    return identify(docs.withColumn("text", F.col("text").cast("string")), model, "text", F.col("source"), F.lit(None), F.lit(None), carry)


def page_languages(pages: DataFrame, labelled: DataFrame, carry: Sequence[str]) -> DataFrame:
    """Languages of ``pages`` by text, host, address suffix and the html element's lang."""
    model = train(labelled)
    host = F.lower(F.nullif(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)", 1), F.lit("")))
    declared = F.lower(F.nullif(F.regexp_extract("html", r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]+)", 1), F.lit("")))
    text = F.regexp_replace("html", r"(?is)<(script|style)\b.*?(</\1\s*>|$)|<!--.*?-->|<[^>]*>", " ")
    return identify(pages, model, text, host, suffix(host), declared, carry, references=True)
