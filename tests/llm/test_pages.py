"""Pages that were extracted wrongly once, time, and the consensus against plain Python."""

import time
from collections import Counter

import pytest

from sporeline.llm import pages
from sporeline.llm.common import table

BODY = " ".join(f"sentence {i} of the story tells more about it." for i in range(12))


@pytest.mark.parametrize("name", ["hidden-gem", "story-related", "social-story", "text-menu", "page-notice", "story-foot", "alert-story"])
def test_paragraphs_of_an_article_stay(name):
    page = pages.Page(f'<body><article><p>{BODY}</p><p class="{name}">The gem of the page.</p><p>End.</p></article></body>')
    assert page.text(page.vote()) == f"{BODY}\n\nThe gem of the page.\n\nEnd."


@pytest.mark.parametrize("name", ["ad", "newsletter-signup", "share", "cookie-notice"])
def test_other_paragraphs_go(name):
    page = pages.Page(f'<body><article><p>{BODY}</p><p class="{name}">Buy this.</p></article></body>')
    assert page.text(page.vote()) == BODY


@pytest.mark.parametrize("name", ["sidebar", "notice", "promo", "banner", "ads", "newsletter", "menu"])
@pytest.mark.parametrize("main", ["<article><p>{}</p></article>", '<div class="content"><p>{}</p></div>'])
def test_large_boxes_are_no_wrappers(name, main):
    short = "A short story. It ends here, after two sentences and some words more."
    page = pages.Page(f'<body>{main.format(short)}<div class="{name}"><p>{BODY}</p><p>{BODY}</p></div></body>')
    assert page.text(page.vote()) == short


@pytest.mark.parametrize("inner", ["<article><p>{}</p></article>", '<div class="content"><p>{}</p></div>', "<div><p>{}</p></div>"])
def test_wrappers_around_the_page_stay(inner):
    page = pages.Page(f'<body><div class="has-x sidebar layout">{inner.format(BODY)}</div><div class="menu"><a href="/">Home</a></div></body>')
    assert page.text(page.vote()) == BODY


@pytest.mark.parametrize("source", ["<p>" + "<b>" * 60_000 + "</i>" * 60_000, "<i><p>" + "<b>" * 60_000 + "</i>" * 60_000, "<div>" + "<b>" * 60_000 + "<h2>x" * 60_000, "<div>" + "<b>" * 60_000 + "</div>" * 60_000, "<ul>" + "<li>a<b>" * 60_000, "<div>" * 60_000 + "</section>" * 60_000])
def test_hostile_pages_take_linear_time(source):
    begun = time.process_time()
    pages.Page(source)
    assert time.process_time() - begun < 5


def test_consensus_against_plain_python(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in table(spark, sf, "pages").select("page_id", "url", "html").collect()]
    rows += [(-1, None, None), (-2, None, f"<p>{BODY}</p>"), (-3, "http://h/", ""), (-3, "http://h/", "")]
    votes = {}
    for _, url, source in rows:
        path = pages.Page(source or "").vote()
        if path is not None:
            votes.setdefault(pages.host_of(url), Counter())[path] += 1
    won = {h: max(c, key=lambda p: (c[p], p.count("/"), p)) for h, c in votes.items()}
    want = sorted(((i, u, pages.Page(s or "").text(won.get(pages.host_of(u)))) for i, u, s in rows), key=repr)
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    got = [(r.page_id, r.url, r.text) for r in pages.extract(df).collect()]
    assert sorted(got, key=repr) == want
