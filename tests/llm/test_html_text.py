import html
import re
import time

import numpy as np
import pytest

from parcelspark.llm import html_text
from tests.llm.data import plain

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def trees(spark):
    return html_text.train(plain(spark, "/root/testdata/sf0.1", "pages"))


def article(source):
    """The article's blocks, for pages of the sample, which mark it."""
    inside = source[source.index("<article>") + 9 : source.index("</article>")]
    blocks = re.split(r"<(?:/?p|/?h\d|br)>", inside)
    return " ".join(b for b in (" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in blocks) if b)


def test_sample_pages_give_their_articles(spark, trees):
    pages = {r.page_id: r for r in plain(spark, SF_DIR, "pages").collect()}
    found = html_text.extract(plain(spark, SF_DIR, "pages"), trees).collect()
    assert {r.page_id for r in found} == set(pages)
    right = [r.text == article(pages[r.page_id].html) for r in found if "<article>" in pages[r.page_id].html]
    assert np.mean(right) > 0.95
    assert all(r.n_chars == len(r.text) and r.url == pages[r.page_id].url for r in found)


def test_other_layouts_of_unseen_pages(spark, trees):
    precision, recall = [], []
    for i, row in enumerate(plain(spark, SF_DIR, "pages").limit(60).collect()):
        page = html_text.Page(row.html)
        page.split_runs()
        main = html_text._main_nodes(page)
        if main is None:
            continue
        runs = [(" ".join(t.split()), main[n]) for n, t in page.runs if t.strip()]
        other = html_text.Page(html_text._layout(
            np.random.default_rng([77, i]), [t for t, m in runs if m], [t for t, m in runs if not m]))
        other.split_runs()
        keep = other.decode(trees.probability(trees.features(other)))
        sizes = [(len(t), html_text._MARK in t, keep[n]) for n, t in other.runs if t.strip()]
        both = sum(n for n, m, k in sizes if m and k)
        precision.append(both / max(1, sum(n for n, _, k in sizes if k)))
        recall.append(both / max(1, sum(n for n, m, _ in sizes if m)))
    assert np.mean(precision) > 0.9 and np.mean(recall) > 0.9


def test_choices_of_ancestors_and_descendants_agree(trees):
    page = html_text.Page("<div><section><p>a b c</p><ul><li>d</li></ul></section><p>e</p></div>" * 3)
    page.split_runs()
    draw = np.random.default_rng(3)
    for _ in range(50):
        keep = page.decode(draw.random(len(page.nodes)))
        for i, node in enumerate(page.nodes):
            if keep[i] and i and node.parent is not None and node.parent >= 0:
                assert keep[node.parent]


BODY = "".join(f"<p>Sentence number {i} tells a good deal about rivers &amp; towns\n in the  north.</p>" for i in range(12))
WANT = " ".join(f"Sentence number {i} tells a good deal about rivers & towns in the north." for i in range(12))


@pytest.mark.parametrize("page", [
    f"<html><body><nav><a href=/>Home</a></nav><article>{BODY}</article><footer>Copyright</footer></body></html>",
    f"<body><article>{BODY}<script>var x = '<p>no</p>';</script><style>p {{}}</style></article>",
])
def test_hand_written_pages(trees, page):
    assert html_text.extract_page(page, trees) == WANT


INNER = {
    "<figure><img src=a><figcaption>The river, seen from a hill.</figcaption></figure>": "The river, seen from a hill.",
    '<p class="byline">By Anna Noor, in the north.</p>': "By Anna Noor, in the north.",
    "<address>Mill Road 4, the old town.</address>": "Mill Road 4, the old town.",
    '<div class="reviews"><p>Visitors say the river is worth a trip.</p></div>': "Visitors say the river is worth a trip.",
    "<p>So <math><mi>x</mi></math> holds, and <label>this</label> too.</p>": "So x holds, and this too.",
    '<p title="a > b" data-x=\'<p>\'>Quoted <i title=it\'s>marks</i> end nothing.</p>': "Quoted marks end nothing.",
    '<div class="ad">Buy now, buy cheap.</div>': "",
    "<aside><p>More on this site.</p></aside>": "",
    '<div class="comments"><div class="comment"><p>I do not agree with this at all.</p></div></div>': "",
}


@pytest.mark.parametrize("inner", INNER)
def test_what_belongs_to_an_article_stays_and_what_does_not_goes(trees, inner):
    page = f"<html><body><nav><a href=/>Home</a></nav><article>{BODY}{inner}{BODY}</article><footer>Copyright</footer></body></html>"
    assert html_text.extract_page(page, trees) == " ".join(x for x in (WANT, INNER[inner], WANT) if x)


def divs(i):
    body = "".join(f"<div>Page {i} and sentence {k} tell a good deal about rivers, towns and hills in the far north.</div>" for k in range(9))
    return f"<html><body><div><a href=/a>Home</a> <a href=/b>News</a></div><div><div>{body}</div></div><div><a href=/c>Imprint</a></div></body></html>"


def test_pages_without_marks_keep_their_text(spark):
    pages = spark.createDataFrame([(i, "u", divs(i)) for i in range(60)], "page_id long, url string, html string")
    found = html_text.extract(pages, html_text.train(pages)).collect()
    assert all(f"Page {r.page_id} and sentence {k} tell" in r.text for r in found for k in range(9))
    # nothing to learn from: nothing is lost
    nothing = html_text.train(pages.where("page_id < 0"))
    assert "sentence 8 tell" in html_text.extract_page(divs(1), nothing)


@pytest.mark.parametrize("n_nodes", [1, 2, 5, 9, 12])
def test_the_choice_is_the_most_likely_consistent_one(n_nodes):
    draw = np.random.default_rng(n_nodes)
    for _ in range(20):
        page = html_text.Page("")
        for i in range(1, n_nodes):
            page._add("div", int(draw.integers(i)), frozenset(), 1)
        p = np.clip(draw.random(n_nodes), 1e-4, 1 - 1e-4)
        value = lambda keep: sum(np.log(p[i] if keep[i] else 1 - p[i]) for i in range(1, n_nodes))
        consistent = lambda keep: all(not keep[i] or keep[page.nodes[i].parent] for i in range(1, n_nodes))
        choices = ([True, *(bool(m >> i & 1) for i in range(n_nodes - 1))] for m in range(1 << (n_nodes - 1)))
        found = page.decode(p)
        assert consistent(found) and value(found) == pytest.approx(max(value(k) for k in choices if consistent(k)))


def test_siblings_are_counted_whole():
    page = html_text.Page("<div>" + "<p>a b c</p>" * 500 + "</div>")
    x = page.features()
    place, same = (x[:, html_text.FEATURES.index(f)] for f in ("sibling_place", "same_tags"))
    assert place[2:] == pytest.approx(np.arange(500) / 500) and same[2:] == pytest.approx(np.log(501))


HARD = {"open quotes": "<a \"", "open values": "<p title='", "closed values": "<p a='>", "inline": "<i>", "inline and blocks": "<i><p>",
        "declarations": "<!", "less than": "<", "list": "<li>", "ends": "<b></i>", "cells": "<table><tr><td>"}


@pytest.mark.parametrize("unit", HARD)
def test_time_grows_in_line_with_broken_pages(unit):
    def seconds(size):
        source = HARD[unit] * (size // len(HARD[unit]))
        begin = time.process_time()
        page = html_text.Page(source)
        page.split_runs()
        page.features()
        return time.process_time() - begin

    assert seconds(800_000) < 12 * seconds(200_000) + 0.5


def test_bounds_leave_out_pages_and_cut_none(spark):
    pages = plain(spark, SF_DIR, "pages")
    seen = []
    fit, html_text.fit = html_text.fit, lambda examples: seen.append(examples) or fit(examples[:5])
    try:
        html_text.train(pages, rows=20, nodes=1500)
    finally:
        html_text.fit = fit
    (found,) = seen
    assert 0 < len(found) < 100 and sum(len(e.y) for e in found) <= 1500
    sizes = {len(e.y) for r in pages.collect() for e in html_text.examples(r.html, 0)[:1]}
    assert all(len(e.y) in sizes for e in found[:: 1 + html_text.LAYOUTS])


@pytest.mark.parametrize("page", [None, "", "   ", "<", "<script>only()</script>", "<!-- c", "&amp", "<p", "</div></p>", "\x00<b>", "<div>" * 5000])
def test_broken_pages_do_not_fail(trees, page):
    assert isinstance(html_text.extract_page(page, trees), str)


def test_awkward_rows_and_empty_tables(spark, trees):
    schema = "page_id long, url string, html string, text string, n_chars string, h string"
    rows = [(None, None, None, "x", "y", "z"), (1, "u", "", "x", "y", "z"), (1, "u", f"<article>{BODY}</article>", "x", "y", "z")] * 2
    found = html_text.extract(spark.createDataFrame(rows, schema), trees).collect()
    assert sorted((str(r.page_id), r.text) for r in found) == sorted([("None", ""), ("1", ""), ("1", WANT)] * 2)
    none = spark.createDataFrame([], schema)
    assert html_text.extract(none, html_text.train(none)).count() == 0
    assert html_text.extract(spark.createDataFrame(rows, schema), html_text.train(none)).count() == 6
