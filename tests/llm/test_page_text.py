

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom.llm import page_text
from feedloom.llm.page_text import ARTICLE, FURNITURE, OPEN, common_lines, lines_of, site_of


@pytest.fixture
def pages(spark):
    def of(rows):
        df = spark.createDataFrame(rows, "page_id long, url string, html string")
        return df.withColumns({c: F.lit(-1) for c in ("host", "path", "lines", "text", "shared", "me", "_block")})

    return of


def kept(html):
    lines = lines_of(html)
    return [t for t, s in lines if s == ARTICLE]


def test_article_text():
    html = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head>
    <body><nav><a href="/">Home</a></nav><!-- ad --><div class="ad">Buy</div><article><header><h1>Big &amp; small</h1><p>by X</p></header>
    <p>One <b>two</b>three<br>four<p>five &copy &#233; &lt;x&gt;
      six<aside>Side</aside><form>Mail <input name=a></form><div id="comments"><p>first!</p></div><script>x()</script>
    <div class="share-buttons">Tweet</div><p hidden>no<p>last 3 < 4</article><footer>&copy; host</footer></body></html>"""
    assert kept(html) == ["Big & small", "One twothree", "four", "five © é <x> six", "last 3 < 4"]


def test_broken_markup():
    assert kept("<article><p>a<p>b<b>c</article><p>d") == ["a", "bc"]
    assert kept("<article><p>cut &am") == ["cut &am"]
    assert kept("<article>a<script>never closed <p>b") == ["a"]
    assert kept("<article>a<p title='x>y'>b<p title=\"open>c</article>")[:2] == ["a", "b"]
    assert kept("<ARTICLE>a<!-- open <p>b") == ["a"]
    assert lines_of(None) == lines_of("") == lines_of("<p> &nbsp; </p>") == []
    assert lines_of("plain") == [("plain", OPEN)]
    assert [s for _, s in lines_of("<div class='site-footer'>x</div><main>y</main>")] == [FURNITURE, ARTICLE]
    assert kept("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "<p>x</article>") == ["deep", "x"]
    assert len(kept("<article>" + "<p>word " * 50_000)) == 50_000


def test_longest_common_lines():
    rng = np.random.default_rng(0)

    def length(a, b):
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        return best[-1][-1]

    for _ in range(60):
        a, b = rng.integers(0, 6, rng.integers(0, 15)), rng.integers(0, 6, rng.integers(0, 15))
        got = common_lines(a, b)
        assert len(got) == length(a.tolist(), b.tolist()) and got == sorted(set(got))
        at = 0
        for i in got:  # a common subsequence: found in b in the same order
            at = b.tolist().index(a[i], at) + 1


def test_sites():
    assert site_of("https://A.example/x/y?q=1#top") == ("a.example", "/x/y?q=1")
    assert site_of("A.example") == ("a.example", "/") and site_of(None) == (None, None)
    assert page_text.nearer("/a/b", "/a/c", "/b") == -1 and page_text.nearer("/b/b", "/a/c", "/b") == 1
    assert page_text.nearer("/b", None, None) == 0


def template(own, extra=""):
    return f"<html><body><p>Welcome to our site</p><div>{own}</div>{extra}<p>All rights kept</p></body></html>"


def test_differencing_decides_without_an_article(pages):
    rows = [(i, f"http://h.example/n/{i:03d}", template(f"Story number {i}", "<nav>go</nav>")) for i in range(30)]
    rows += [(100, "http://alone.example/", template("Only page")), (101, None, template("No address")), (102, "http://h.example/x", None),
             (103, "http://h.example/y", ""), (104, "http://twin.example/1", template("Same")), (105, "http://twin.example/2", template("Same")),
             (106, "http://rep.example/1", template("Repeated")), (106, "http://rep.example/1", template("Repeated")),
             (107, "http://art.example/1", "<article><p>Common</p><p>A</p></article>"), (108, "http://art.example/2", "<article><p>Common</p><p>B</p></article>")]
    got = page_text.extract(pages(rows)).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: r for r in got}
    for i in range(30):
        assert by[i]["text"] == f"Story number {i}" and by[i]["lines"] == [by[i]["text"]] and by[i]["n_shared"] == 3
    whole = "Welcome to our site {} All rights kept".format
    assert by[100]["text"] == whole("Only page") and by[101]["text"] == whole("No address")
    assert by[102]["text"] == by[103]["text"] == ""
    assert by[104]["text"] == whole("Same") and by[106]["text"] == whole("Repeated")
    assert by[107]["text"] == "Common A" and by[107]["n_shared"] == 0


def test_empty_table(pages):
    assert page_text.extract(pages([])).count() == 0


def test_differencing_decides_in_main(pages):
    also = "<p>Read also</p><ul><li>Old story</li></ul>"
    page = "<html><body><p>Top</p><main>{}</main></body></html>".format
    rows = [(i, f"http://m.example/{i:02d}", page(f"<p>Story {i}</p>{also}")) for i in range(6)]
    nested = "<header><h1>Title {0}</h1></header><h2>Latest</h2><article><p>Shared words</p><p>Body {0}</p></article>{1}".format
    rows += [(10 + i, f"http://n.example/{i:02d}", page(nested(i, also))) for i in range(6)]
    got = {r["page_id"]: r for r in page_text.extract(pages(rows)).collect()}
    for i in range(6):
        assert got[i]["lines"] == [f"Story {i}"] and got[i]["n_shared"] == 3
        assert got[10 + i]["lines"] == [f"Title {i}", "Shared words", f"Body {i}"]


def test_class_words_of_wrappers_do_not_reach_the_article(pages):
    assert kept("<div class='layout has-sidebar'><article>a<div class='sidebar'>x</div></article><p>y</div>") == ["a"]
    assert kept("<div id='page' class='header-fixed'><div><main><p>a</main></div><p>x</div>") == ["a"]
    assert kept("<article class='post comments-open'>a</article><article class='comment-body'>x</article>") == ["a"]
    assert kept("<div class='comments'><article>x</article></div><nav><article>y</article></nav>") == []
    assert kept("<article>a<div class='related'><article>x</article></div></article>") == ["a"]
    assert kept("<article class='social-news' hidden>x</article><div role='main' class='widget'>a</div>") == ["a"]
    got = page_text.extract(pages([(1, None, "<div id='page' class='header-fixed'><nav>x</nav><p>a</div>")])).first()
    assert got["text"] == "a"


def test_closed_svg_hides_nothing():
    assert kept("<article>a<svg viewBox='0 0 1 1'/>b<p><math/>c<svg><path d='x'/>no</svg>d</article>") == ["ab", "cd"]
    assert kept("<article>a<svg>no<p>c</svg>d<script src=x />no</script></article>") == ["ad"]
