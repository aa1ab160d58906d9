"""Main text of HTML pages by a linear-chain conditional random field over DOM leaf blocks.

Each block is text of the article or not. Its features are the tags, classes,
ids and roles of its ancestors, and its text's length, links and punctuation; the
chain ties neighbouring blocks. The field is trained by maximising the labels'
conditional likelihood (forward-backward, Adam) on labelled pages: generated
layouts with known labels (``layouts``), and a bounded sample of the given pages
whose markup itself names the article. Pages are decoded by Viterbi.

Defined cases: a null or empty page, and one without article blocks, has an
empty text. Repeated rows give one row each; null ids and urls are returned; an
empty table gives none. Other columns are ignored.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import arrow
from orderlake.llm.hashing import hash_fraction
from orderlake.llm.html_blocks import Block, blocks

#: Pages of the table that the field is trained on, about, and generated ones.
SAMPLE_PAGES, LAYOUT_PAGES = 200, 400
#: Longer pages are not trained on (they are extracted like all others).
SAMPLE_BLOCKS = 300
ROUNDS, RATE, DECAY = 150, 0.1, 0.0005

# Names by which markup tells what a part of a page is.
ARTICLE = "article content main post story entry body text".split()
ASIDE = (
    "ad ads advert advertisement banner sponsor sponsored promo sidebar side aside related share social menu nav navigation navbar breadcrumb breadcrumbs "
    "header masthead topbar footer copyright cookie cookies consent notice alert popup modal subscribe newsletter signup login search form widget "
    "comment comments reply replies discussion disqus pagination pager tags toolbar skip legal"
).split()
TAGS_ASIDE = "nav aside footer header form button menu dialog".split()


def features(page: list[Block]) -> list[list[str]]:
    """Names of the features that each block has."""
    out = []
    for block in page:
        words = block.text.count(" ") + 1
        ends = block.text.rstrip("\"')»”")[-1:] in ".!?…:;"
        out.append([
            *{f"in:{x}" for x in block.path},
            f"leaf:{next((x for x in reversed(block.path) if x[0] != '.'), '')}",
            f"words:{min(6, int(math.log2(words)))}",
            f"links:{min(3, 4 * block.linked // max(1, len(block.text)))}",
            f"ends:{ends}",
            "always",
        ])
    return out


def markup_labels(page: list[Block]) -> list[bool] | None:
    """Labels of a page whose markup names its article; None if it doesn't."""
    aside = {*TAGS_ASIDE, *(f".{w}" for w in ASIDE), "head", "title"}
    if not any("article" in b.path for b in page):
        return None
    return ["article" in b.path and not aside & set(b.path[b.path.index("article") :]) for b in page]


def layouts(n: int, seed: int = 5) -> list[tuple[list[Block], list[bool]]]:
    """Generated pages of many layouts with the labels of their blocks.

    Words of article text start with "x", all others with "y"; features don't
    see words, so the letters only carry the label.
    """
    rng = random.Random(seed)

    def prose(mark: str, low: int, high: int) -> str:
        return " ".join(mark + "w" * rng.randint(1, 8) for _ in range(rng.randint(low, high))) + rng.choice(["." * 1, ".", "", "!"])

    def wrap(name: str, inner: str, tag: str = "") -> str:
        tag = tag or rng.choice(["div", "div", "section", "ul" if "<li>" in inner else "div"])
        named = rng.choice([f'class="{name}"', f'id="{name}"', f'class="{name}-{rng.choice(["box", "wrap", "area", "top"])} c{rng.randint(1, 9)}"'])
        return f"<{tag} {named}>{inner}</{tag}>"

    def clutter() -> str:
        kind = rng.random()
        links = "".join(f'<li><a href="/{k}">{prose("y", 1, 4)}</a></li>' for k in range(rng.randint(1, 6)))
        text = rng.choice([links, f"<p>{prose('y', 2, 30)}</p>", prose("y", 2, 30), f"<h3>{prose('y', 1, 4)}</h3>{links}"])
        if kind < 0.35:
            return f"<{(tag := rng.choice(TAGS_ASIDE))}>{text}</{tag}>"
        return wrap(rng.choice(ASIDE), text, rng.choice(["", "", "aside", "section"]))

    def article() -> str:
        parts = [f"<h1>{prose('x', 2, 9)}</h1>"] if rng.random() < 0.8 else []
        for _ in range(rng.randint(1, 9)):
            shape = rng.random()
            if shape < 0.7:
                parts.append(f"<p>{rng.choice(['', '<b>'])}{prose('x', 1, 60)}{rng.choice(['</p>', '', '<br>'])}")
            elif shape < 0.8:
                parts.append(f"<{(h := rng.choice(['h2', 'h3']))}>{prose('x', 1, 7)}</{h}>")
            elif shape < 0.87:
                parts.append("<ul>" + "".join(f"<li>{prose('x', 1, 15)}</li>" for _ in range(rng.randint(1, 4))) + "</ul>")
            elif shape < 0.92:
                parts.append(f"<blockquote><p>{prose('x', 3, 40)}</p></blockquote>")
            elif shape < 0.95:
                parts.append(f"<table><tr><td>{prose('x', 1, 4)}</td><td>{prose('x', 1, 4)}</td></tr></table>")
            else:
                parts.append(clutter())
        if rng.random() < 0.3:
            parts.append(wrap(rng.choice(["comments", "comment", "replies", "discussion"]), "".join(f"<p>{prose('y', 2, 40)}</p>" for _ in range(rng.randint(1, 5)))))
        inner = "".join(parts)
        return rng.choice([f"<article>{inner}</article>", f"<article>{inner}</article>", f"<main>{inner}</main>", wrap(rng.choice(ARTICLE), inner, "div"), f"<main><article>{inner}</article></main>"])

    out = []
    for _ in range(n):
        before, after = "".join(clutter() for _ in range(rng.randint(0, 4))), "".join(clutter() for _ in range(rng.randint(0, 4)))
        comments = wrap("comments", "".join(f"<p>{prose('y', 2, 40)}</p>" for _ in range(rng.randint(1, 4))), rng.choice(["div", "section"])) if rng.random() < 0.4 else ""
        page = blocks(f"<html><head><title>{prose('y', 1, 8)}</title></head><body>{before}{article()}{comments}{after}</body></html>")
        out.append((page, [b.text[0] == "x" for b in page]))
    return out


class Field:
    """Binary linear-chain conditional random field over named features."""

    def __init__(self, weights: dict[str, float], turn: list[list[float]]) -> None:
        self.weights, self.turn = weights, turn  # weight of the article label; score of label i before label j

    @classmethod
    def fit(cls, pages: list[tuple[list[list[str]], list[bool]]]) -> "Field":
        pages = [p for p in pages if p[0]]
        names = {f: k for k, f in enumerate(sorted({f for page, _ in pages for block in page for f in block}))}
        n, steps = len(pages), max((len(p) for p, _ in pages), default=1)
        at = [(i, t, names[f]) for i, (page, _) in enumerate(pages) for t, block in enumerate(page) for f in block]
        cell = np.array([i * steps + t for i, t, _ in at], dtype=np.int64)
        feature = np.array([f for _, _, f in at], dtype=np.int64)
        there = np.zeros((n, steps), bool)
        gold = np.zeros((n, steps), np.int64)
        for i, (page, labels) in enumerate(pages):
            there[i, : len(page)] = True
            gold[i, : len(page)] = labels
        both = there[:, 1:] & there[:, :-1]
        seen = np.zeros((2, 2))
        np.add.at(seen, (gold[:, :-1][both], gold[:, 1:][both]), 1)
        x = np.zeros(len(names) + 4)
        m, v = np.zeros_like(x), np.zeros_like(x)
        for step in range(1, ROUNDS + 1):
            score = np.zeros((n, steps, 2))
            score[:, :, 1] = np.bincount(cell, x[feature], n * steps).reshape(n, steps)
            turn = x[-4:].reshape(2, 2)
            ahead, behind = score.copy(), np.zeros((n, steps, 2))
            for t in range(1, steps):
                came = np.logaddexp.reduce(ahead[:, t - 1, :, None] + turn, axis=1)
                ahead[:, t] = np.where(there[:, t, None], came + score[:, t], ahead[:, t - 1])
            for t in range(steps - 2, -1, -1):
                comes = np.logaddexp.reduce(turn + (score[:, t + 1] + behind[:, t + 1])[:, None, :], axis=2)
                behind[:, t] = np.where(there[:, t + 1, None], comes, 0.0)
            total = np.logaddexp.reduce(ahead[:, -1], axis=1)
            chance = np.exp(ahead + behind - total[:, None, None])[:, :, 1] * there
            wrong = (gold - chance) * there
            pair = np.exp(ahead[:, :-1, :, None] + turn + (score + behind)[:, 1:, None, :] - total[:, None, None, None]) * both[:, :, None, None]
            slope = np.concatenate((np.bincount(feature, wrong.ravel()[cell], len(names)), (seen - pair.sum(axis=(0, 1))).ravel())) / n - DECAY * x
            m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
            x += RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        return cls({f: float(x[k]) for f, k in names.items()}, x[-4:].reshape(2, 2).tolist())

    def decode(self, page: list[list[str]]) -> list[bool]:
        """The likeliest labels of a page's blocks."""
        if not page:
            return []
        get, turn = self.weights.get, self.turn
        best, back = (0.0, sum(get(f, 0.0) for f in page[0])), []
        for block in page[1:]:
            own = sum(get(f, 0.0) for f in block)
            from_no = best[0] + turn[0][0] >= best[1] + turn[1][0]
            from_no_yes = best[0] + turn[0][1] >= best[1] + turn[1][1]
            back.append((0 if from_no else 1, 0 if from_no_yes else 1))
            best = (max(best[0] + turn[0][0], best[1] + turn[1][0]), max(best[0] + turn[0][1], best[1] + turn[1][1]) + own)
        label = int(best[1] > best[0])
        labels = [label]
        for choice in reversed(back):
            label = choice[label]
            labels.append(label)
        return [x == 1 for x in reversed(labels)]

    def text(self, html: str | None) -> str:
        page = blocks(html)
        return " ".join(b.text for b, good in zip(page, self.decode(features(page))) if good)


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for html in batch.column(0).to_pylist():
            page = blocks(html)
            labels = markup_labels(page) if len(page) <= SAMPLE_BLOCKS else None
            if labels:
                rows.append((features(page), labels))
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.list_(pa.list_(pa.string()))), pa.array([r[1] for r in rows], pa.list_(pa.bool_()))], ["features", "labels"])


def train(pages: DataFrame, sample_pages: int = SAMPLE_PAGES, layout_pages: int = LAYOUT_PAGES) -> Field:
    """A field from generated layouts and about sample_pages pages, chosen by hash, whose markup labels them."""
    n = max(1, pages.count())
    sample = pages.filter(hash_fraction(F.concat(F.lit("train:"), F.coalesce(F.col("page_id").cast("string"), F.col("url"), F.lit("")))) < min(1.0, sample_pages / n))
    found = arrow(_labelled, sample.select(F.col("html").cast("string")), "features array<array<string>>, labels array<boolean>").collect()
    made = [(features(page), labels) for page, labels in layouts(layout_pages)]
    # the sample in a fixed order: sums of floats depend on it
    return Field.fit(made + sorted([(r["features"], r["labels"]) for r in found]))


def _extract(batches: Iterator[pa.RecordBatch], field: Field) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [field.text(html) for html in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def main_texts(pages: DataFrame, field: Field | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) per row of pages(page_id, url, html)."""
    field = field or train(pages)
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return arrow(partial(_extract, field=field), rows, "page_id long, url string, text string, n_chars long")
