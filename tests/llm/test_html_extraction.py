import html
import random
import re
from collections import defaultdict
from math import isclose, log

import pytest

from rillstone.llm import html_extraction as he
from rillstone.llm.common import table


def test_every_article_of_the_table(spark):
    folder = "/root/testdata/sf0.01"
    pages = {r.page_id: r.html for r in table(spark, folder, "pages").collect()}
    rows = he.op6_site_style_tree(spark, folder).collect()
    assert {r.page_id for r in rows} == set(pages)
    for r in rows:
        article = re.search("<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        blocks = (html.unescape(re.sub("<[^>]*>", " ", p)) for p in re.split("</?(?:p|h1)>", article))
        assert r.text == "\n\n".join(filter(None, (" ".join(b.split()) for b in blocks)))
        assert r.n_chars == len(r.text)


def slow_tree(pages):
    """(host, path) to (pages, importance), straight from the definition."""
    seen = defaultdict(lambda: defaultdict(set))
    for host, page in pages:
        for h, path, kind, feature, own in he.page_features(host, page):
            if path:
                seen[h, path][kind, feature].add(own)
    out = {}
    for (host, path), features in seen.items():
        m = len(features["page", 0])
        if m == 1:
            look = 1.0
        else:
            look = -sum(len(v) / m * log(len(v) / m, m) for (k, _), v in features.items() if k == "style")
        shares = []
        for (h, p), fs in seen.items():
            if h == host and (p == path or p.startswith(path + ">")):
                k = len(fs["page", 0])
                # a text on n of k pages, on each as likely: its entropy to the base of k
                shares += [0.0 if k == 1 else -sum(log(1 / len(v), k) / len(v) for _ in v) for (kind, _), v in fs.items() if kind == "text"]
        content = 1 - sum(shares) / len(shares) if shares else None
        out[host, path] = (m, 1.0 if content is None else 0.9 * content + 0.1 * look)
    return out


def site(n, seed=0):
    r = random.Random(seed)
    word = lambda k: " ".join(r.choice("ab cd ef gh ij".split()) + str(r.randrange(99)) for _ in range(k))
    pages = []
    for k in range(n):
        extra = "<div class='extra'><p>same</p><p>again</p></div>" * (k % 2)
        pages.append(
            f"<html><body><div class=top><ul><li><a href=/>Home</a><li>About</ul></div><div id=c{k}><h1>{word(3)}</h1><p>{word(20)}<p>{word(9)}"
            f"{extra}</div><div class=box><p>All rights kept</p><p>{word(2)}</p></div><span class='ad-slot'>{word(2)}</span></body></html>"
        )
    return pages


def test_importance_against_the_definition(spark):
    pages = [("http://a.example/x", p) for p in site(9)] + [("https://u@B.example:8/y", p) for p in site(3, 1) + site(3, 1)]
    df = spark.createDataFrame([(i, u, p) for i, (u, p) in enumerate(pages)], "page_id long, url string, html string")
    want = slow_tree([("a.example" if "a.ex" in u else "b.example", p) for u, p in pages])
    got = {(r.host, r.path): (r.pages, r.importance) for r in he.style_tree(df).collect()}
    assert got.keys() == want.keys()
    for k, (m, importance) in want.items():
        assert got[k][0] == m and isclose(got[k][1], importance, abs_tol=1e-9), k


def test_branches_that_repeat_are_removed_from_every_page(spark):
    rows = [(i, "http://a.example/" + str(i), p) for i, p in enumerate(site(20))]
    out = he.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    for r in out:
        assert "Home" not in r.text and "About" not in r.text and "same" not in r.text
        assert len(r.text.split("\n\n")) >= 3


def test_articles_stay_even_where_all_pages_are_alike(spark):
    page = "<html><body><div class=m>Site</div><article class=post><h1>T</h1><p>One</p><div class=share-bar>x</div><div class=tagline>y</div><p>{}</p></article></body></html>"
    rows = [(i, "http://h.example", page.format(f"<b>n{i % 5}")) for i in range(50)]
    out = he.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.text for r in out} == {f"T\n\nOne\n\nn{k}" for k in range(5)}


PAGES = {
    None: "", "": "", "just text &amp; more": "just text & more", "<p>a<br>b  \n c<p>d": "a b c\n\nd", "a < b <3 <p>x": "a < b <3\n\nx",
    "<script>var a='</p>';</script><p>x</p><style>p{}</style>": "x", "<!-- <p>no</p> --><p>yes<!-- open": "yes",
    "<article><header><h1>T</h1></header><p>x</p><section id='comments'><article class='comment'><p>c</p></article></section></article><p>out</p>": "T\n\nx",
    "<main><p>in</p><aside>a</aside></main><p>out</p>": "in", "<p>a <a href='x>y'>link</a> b</p><form><p>f</p></form>": "a link b",
    "<div class='cookie-notice'>c</div><ul><li>1<li>2</ul><p hidden>h</p><div role=navigation>n</div>": "1\n\n2",
    "<table><tr><td>1<td>2<tr><td>3</table>": "1\n\n2\n\n3", "<p title=\"open>x</p><p>y</p>": "x\n\ny", "<p>a</p><div": "a",
    "<p>&lt;b&gt; &nbsp; &eacute;&#233;&#x1F642;</p>": "<b> éé🙂", "<DIV><P>A</DIV>B": "A\n\nB", "</p></b>x<p></p>": "x",
    "<div>" * 3000 + "deep" + "</div>" * 2999 + "<p>tail": "deep\n\ntail", "<p>x <span class=ad>buy</span> y</p>": "x\n\ny",
    "<textarea>t</textarea><svg><text>s</text></svg><p>z</p>": "z",
}


@pytest.mark.parametrize("page", PAGES)
def test_markup(page):
    assert he.main_text(page) == PAGES[page]


MORE = {
    '<div class="content-sidebar-wrap"><main><p>in</p></main></div>': "in", '<div class="has-sidebar"><article><p>in</p></article></div>': "in",
    '<div class="sidebar"><main><p>in</p></main><p>out</p></div>': "in", '<article><h2 id="related-work">Related</h2><p>x</p></article>': "Related\n\nx",
    '<article><section id="social-impact"><p>x</p></section><section id="comments-on-the-proof">y</section></article>': "x\n\ny",
    "<main><h1>Title</h1><p>Intro of some length</p><article>Teaser</article></main>": "Title\n\nIntro of some length\n\nTeaser",
    "<main><p>by me</p><article><p>The longer text</p></article></main>": "The longer text", "<button><div>Menu</div></button><p>x</p>": "x",
    '<p>x</p><span class="ad"><div>Buy now</div></span><p>y</p>': "x\n\ny", '<a class="promo"><div>Buy</div></a><p>y</p>': "y",
    '<div class="ad-slot">a</div><div class="share-bar">b</div><p>x</p>': "x", "<article>where <math><mi>x</mi></math> is</article>": "where x is",
    "<article><p>see <svg><text>label</text></svg></p><noscript><p>still</p></noscript></article>": "see label\n\nstill",
    '<article><p>x</p></article><div class="comments"><article><p>I agree</p></article></div>': "x", "<aside><article>Teaser</article></aside><p>x</p>": "x",
}


@pytest.mark.parametrize("page", MORE)
def test_markup_around_the_main_text(page):
    assert he.main_text(page) == MORE[page]


NOTICE = "<p>Sign up for our newsletter today.</p>"


def noticed(n):
    word = random.Random(4).randrange
    return [f"<html><body><article><h1>T{k}</h1><p>Text {word(9999)} of page {k}</p>{NOTICE}<p>End {word(9999)}</p></article></body></html>" for k in range(n)]


def test_a_notice_without_a_name_goes_out_of_articles(spark, monkeypatch):
    """Only the tree can tell: the same page alone keeps it, and so does a host whose tree is empty."""
    rows = [(k, "http://h.example/" + str(k), p) for k, p in enumerate(noticed(30))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    texts = [r.text for r in he.extract(df).collect()]
    assert len(texts) == 30 and all("Sign up" not in t and t.count("\n\n") == 2 for t in texts)
    assert "Sign up" in he.main_text(rows[0][2])
    few = [r.text for r in he.extract(df.limit(5)).collect()]
    assert all("Sign up" in t for t in few)
    monkeypatch.setattr(he, "common_texts", lambda counted: counted.limit(0).selectExpr("host", "feature AS hash"))
    assert all("Sign up" in r.text for r in he.extract(df).collect())


def test_a_text_of_few_pages_stays(spark):
    rows = [(k, "http://h.example", p if k % 2 else p.replace(NOTICE, "")) for k, p in enumerate(noticed(30))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert sum("Sign up" in r.text for r in he.extract(df).collect()) == 15


def test_names_of_columns(spark):
    df = spark.createDataFrame([(1, "u", "<p>x", 5, 6, 7)], "page_id long, url string, html string, dropped int, _host int, hash int")
    assert [tuple(r) for r in he.extract(df).collect()] == [(1, "u", 5, 6, 7, "x", 1)]


def test_odd_rows(spark):
    rows = [(i, None if i % 2 else "no address", p, 1) for i, p in enumerate(PAGES)] + [(0, None, None, 2), (None, "http://[", "<p>a", 3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, TEXT int")
    out = he.extract(df)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(r.text for r in out.collect()) == sorted([*PAGES.values(), "", "a"])
    assert he.extract(df.limit(0)).count() == 0


def test_broken_markup_takes_linear_time():
    for bad in ('<a "' * 50_000, "<!--" * 50_000, "<" * 100_000, "<p>" * 50_000, "</p>" * 50_000, "<x" * 50_000, "<p a='" * 50_000, "<script>" * 50_000):
        he.main_text(bad)
