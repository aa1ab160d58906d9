from __future__ import annotations

import html
import itertools
import re

from orderlake.llm import main_text
from orderlake.llm.html_blocks import blocks


def article_of(page):
    """The text of a page's article element, for pages without clutter inside it."""
    inner = re.search(r"<article>(.*?)(</article>|$)", page, re.S).group(1)
    return " ".join(html.unescape(re.sub(r"<[^>]*(>|$)", " ", inner)).split())


def extracted(spark, rows):
    return main_text.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()


def test_articles_of_held_out_pages(spark, table):
    rows = table("pages", "page_id", "url", "html")
    field = main_text.train(spark.createDataFrame(rows[:100], "page_id long, url string, html string"))
    assert all(field.text(page) == article_of(page) for _, _, page in rows[100:])
    got = {r.page_id: r for r in extracted(spark, rows)}
    assert all(got[i].text == article_of(page) and got[i].n_chars == len(got[i].text) and got[i].url == url for i, url, page in rows)


def test_held_out_layouts():
    field = main_text.Field.fit([(main_text.features(p), labels) for p, labels in main_text.layouts(400)])
    wrong = total = 0
    for page, labels in main_text.layouts(300, seed=99):
        wrong += sum(a != b for a, b in zip(field.decode(main_text.features(page)), labels))
        total += len(labels)
    assert wrong / total < 0.01


def test_viterbi_finds_the_best_labelling():
    field = main_text.Field({"a": 1.5, "b": -0.7, "c": 0.2, "d": -2.5}, [[0.9, -0.6], [-1.1, 0.8]])
    for names in itertools.product(["a", "b", "c", "d"], repeat=6):
        page = [[x] for x in names]

        def score(labels):
            return sum(field.weights[x[0]] * y for x, y in zip(page, labels)) + sum(field.turn[p][q] for p, q in zip(labels, labels[1:]))

        best = max(itertools.product([0, 1], repeat=6), key=score)
        assert abs(score([int(x) for x in field.decode(page)]) - score(best)) < 1e-9


def test_blocks_of_broken_markup():
    texts = lambda page: [b.text for b in blocks(page)]
    assert texts("<p>a<p>b<b>c</p>d<br>e") == ["a", "bc", "d e"]
    assert texts("<ul><li>a<li>b<ul><li>c</ul>d</ul>") == ["a", "b", "c", "d"]
    assert texts('<p title="1>0">x &amp y &lt;b&gt; &am &#233;&nbsp; z</p') == ["x & y <b> &am é z"]
    assert texts("<script>var t='</p>';</script><style>p{}</style><!-- x --><p>a<!-- <p>b</p> -->c") == ["ac"]
    assert texts("<div>a<span>b</span> <i>c</i></span></div>") == ["ab c"]
    assert texts("a<!-- never closed <p>b") == ["a"] and texts("<p>a<") == ["a<"] and texts("1 < 2") == ["1 < 2"]
    assert texts("<title>a <b> c</title><textarea><p>x</textarea>") == ["a <b> c", "<p>x"]


def test_clutter_of_many_kinds_goes(spark, table):
    field = main_text.train(spark.createDataFrame(table("pages", "page_id", "url", "html"), "page_id long, url string, html string"))
    clutter = ["<nav><a href=/>y one</a></nav>", "<header><h2>y two</h2></header>", "<aside><p>y three words here</p></aside>", '<div class="sidebar"><p>y four.</p></div>', '<div id="cookie-notice">y five</div>', '<div class="advert">y six</div>', "<form><label>y seven</label><input></form>", "<footer>y eight</footer>", '<section class="comments"><div class="comment"><p>y nine thinks this is a long comment. It goes on.</p></div></section>', '<ul class="menu"><li>y ten</li></ul>']
    page = "<html><head><title>y title</title></head><body>" + "".join(clutter[:8]) + "<article><h1>x Title</h1><p>x some words of the article.</p><p>x</p>" + clutter[8] + "</article>" + clutter[9] + "</body></html>"
    assert field.text(page) == "x Title x some words of the article. x"


def test_edge_cases(spark, table):
    page = table("pages", "html")[0][0]
    long = "<article>" + "<p>many words</p>" * 20_000 + "</article>"
    got = extracted(spark, [(1, None, None), (2, "u", ""), (3, "u", "no markup"), (None, "u", page), (4, "u", page), (4, "u", page), (5, "u", long)])
    by = {}
    for r in got:
        by.setdefault(r.page_id, []).append(r)
    assert (by[1][0].text, by[1][0].n_chars, by[2][0].text) == ("", 0, "") and len(by[4]) == 2
    assert by[None][0].text == by[4][0].text == article_of(page)
    assert by[5][0].n_chars == 20_000 * 11 - 1
    assert extracted(spark, []) == []
