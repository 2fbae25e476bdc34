"""Main text of pages: the given table, pages of other make, and the parts of the method."""

import os
import random
import re
import time
from html import unescape

import numpy as np
import pyarrow as pa
import pytest

from shardlog.llm import pages
from shardlog.llm.common import lowest
from shardlog.llm.dom import Page

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


def slow_text(html):
    """What stands between the article's tags; the given pages have one article of headings and paragraphs."""
    article = re.search("<article>(.*)</article>", html, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", article)
    texts = [" ".join(unescape(re.sub(r"<[^>]*>", lambda m: " " * (m[0] == "<br>"), b)).split()) for b in blocks]
    return "\n\n".join(t for t in texts if t)


@pytest.mark.parametrize("icon,whole", [
    ("<svg/>", True), ('<svg class="i" />', True), ("<MATH a='='/>", True), ("<svg><path d='M0'/></svg>", True), ("<svg a=b/>", False), ("<svg>", False),
])
def test_self_closed_icons_drop_no_text(icon, whole):
    texts = [t for _, t, _ in Page(f"<p>Before {icon} after.</p><p>More.</p>").texts]
    assert texts == (["Before after.", "More."] if whole else ["Before"])


def test_share_of_siblings_with_the_same_tag_at_any_number():
    for n in (9, 198, 199, 250, 1000):
        page = Page("<section>" + "<p>Some words.</p>" * n + "<div>Buy it now.</div></section>")
        share = {page.tag[i]: x for i, x in enumerate(page.features()[:, 10])}
        assert share["div"] == 1 / (n + 1) and share["p"] == n / (n + 1)


def test_whole_table(spark):
    table = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r for r in pages.extracted(table).collect()}
    want = {r.page_id: (r.url, slow_text(r.html)) for r in table.collect()}
    assert len(got) == len(want)
    right = sum((got[i].url, got[i].text) == want[i] for i in want)
    assert right >= 0.99 * len(want)
    assert all(r.n_chars == len(r.text) for r in got.values())


OTHER = """<!doctype html><title>no</title><body class=x><div id="top-nav"><a href=/>Start here</a> <a href=/b>Offers of today</a></div>
<div class="cookie-consent"><p>We store things on your machine. Do you accept that?</p><button>Yes</button></div>
<div class="page"><div class="post-content"><h1>The title &amp; more</h1>
<p>First   paragraph of some length, with <i>in</i>line markup<br>and &#233;t&eacute;. It goes on for a while, so that it reads as prose.
<p>Second paragraph, whose end tag is missing too. It has several sentences. They are of usual length, as prose has.
<div class="advert-box">Buy now and save a lot of money today!</div>
<script>if (a < b) document.write("<p>never</p>")</script>
<p>Third paragraph &lt;b&gt; with references. It closes the story with some more words and ends here.</p></div>
<section id="comments"><h3>2 replies</h3><div class="comment"><p>I do not agree with the author at all.</p></div></section></div>
<aside><h4>Related</h4><ul><li><a href=1>Another story</a><li><a href=2>One more</a></ul></aside>
<form action=/s><label>Search</label><input name=q></form><footer>&copy; someone, all rights</footer>"""


@pytest.fixture(scope="module")
def model(spark):
    rows = spark.read.parquet(f"{SF}/pages.parquet").orderBy("page_id").limit(200).collect()
    material = [p for p in (pages.paragraphs(r.html) for r in rows) if p]
    return pages.fitted(material), material


def test_page_of_another_make(model):
    page = Page(OTHER)
    assert pages.main_text(page, model[0](page.features())) == (
        "The title & more\n\nFirst paragraph of some length, with inline markup and été. It goes on for a while, so that it reads as prose."
        "\n\nSecond paragraph, whose end tag is missing too. It has several sentences. They are of usual length, as prose has."
        "\n\nThird paragraph <b> with references. It closes the story with some more words and ends here."
    )


def test_held_out_made_pages(model):
    rng, wrong, all_ = random.Random(1234), 0, 0
    for _ in range(150):
        page = Page(pages.made_page(rng, model[1]))
        main, kept = page.labels(), pages.decoded(page, model[0](page.features()))
        wrong += sum((main[n] == 1) != kept[n] for n, _, _ in page.texts)
        all_ += len(page.texts)
    assert wrong < 0.02 * all_


def test_choices_never_contradict(model):
    rng = np.random.default_rng(5)
    for seed in range(60):
        page = Page(pages.made_page(random.Random(seed), model[1]))
        kept = pages.decoded(page, rng.normal(0, 2, len(page.tag)))
        assert all(kept[page.parent[i]] for i in range(1, len(kept)) if kept[i])
        with_text = {n for n, _, _ in page.texts}
        inner = set(page.parent)
        assert all(any(kept[c] for c in range(len(kept)) if page.parent[c] == i) for i in inner if i >= 0 and kept[i] and i not in with_text)


def test_awkward(spark):
    deep = "<div>" * 3000 + "deep" + "</div>" * 10
    rows = [
        (1, "u", None), (2, None, ""), (3, "u", "no markup at all"), (4, "u", "<p>a<p>b</p></p></div>"), (None, None, None),
        (5, "u", "<article><p>" + "long text. " * 50_000 + "</p></article>"), (6, "u", "<<a <b='x>\"<!-- never closed"),
        (5, "u", "<article><p>again</p></article>"), (5, "u", "<article><p>again</p></article>"), (7, "u", deep), (8, "u", "<script>x"),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as text", "2 as n_chars", "3 as x")
    got = pages.extracted(df).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert [r.text for r in got if r.page_id in (1, 2, 8, None)] == [""] * 4
    assert max(r.n_chars for r in got) == len("long text. " * 50_000) - 1


def test_empty(spark):
    assert pages.extracted(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_blocks_in_order():
    page = Page("<div>one<p>two<br>2 <b>x</b>y</p>three&nbsp;3<ul><li>four<li>five</ul></div>six<hr>seven")
    assert [t for _, t, _ in page.texts] == ["one", "two 2 xy", "three 3", "four", "five", "six", "seven"]


N = 1 << 18


@pytest.mark.parametrize("html", [
    "<a " * N, "<!x " * N, "</a " * N, "<!--" * N, "<head>" * N, "<script>x</script " * N, "<div>" * N, "<p><table><tr><td>" + "<div>" * N,
    "<span>" * N + "</span>" * N, '<a "' * N, "<a \"<a '<a '\"" * N, "<" * N, "</div>" * N, "&amp" * N, "<b" + " x='<" * N,
], ids=lambda h: h[:12])
def test_hostile_pages_take_time_in_proportion(html):
    began = time.process_time()
    Page(html)
    assert time.process_time() - began < 10  # megabytes that took minutes when the rest of the page was searched at each tag


def test_deep_elements_keep_their_text():
    page = Page("<div>" * 600 + "deep" + "</div>" * 600 + "<p>after</p>")
    assert [t for _, t, _ in page.texts] == ["deep", "after"]
    assert page.tag[page.texts[1][0]] == "p" and page.parent[page.texts[1][0]] == 0


def test_tags_that_never_end_are_text():
    assert [t for _, t, _ in Page("<p>one <b two</p><p>three <a href='x>y'>four</a> < five").texts] == ["one <b two", "three four < five"]


def test_stretches_are_bounded(monkeypatch):
    monkeypatch.setattr(pages, "BYTES_AT_ONCE", 10)
    monkeypatch.setattr(pages, "PAGES_AT_ONCE", 3)
    column = pa.array(["a" * 4, "b" * 7, "", "c" * 30, "d", "e", "f", "g", ""])
    assert list(pages._stretches(column)) == [(0, 1), (1, 2), (3, 1), (4, 3), (7, 2)]
    assert list(pages._stretches(column.slice(4, 0))) == []


def test_only_hashes_are_ordered(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(pages, "lowest", lambda df, *more: asked.append(df.columns) or lowest(df, *more))
    rows = [(1, "u", "<p>one</p>")] * 50 + [(2, "u", None)]
    assert pages.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).count() == 51
    assert asked == [["h"]]
