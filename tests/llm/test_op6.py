import html
import re
import time

import pytest

import __spark_entry__ as E
from llm_fixtures import SF_MID
from pixelframe.llm import html_main as H

NAV = '<nav><ul><li><a href="/a">Menu one</a></li><li><a href="/b">Menu two</a></li></ul></nav>'
PAGE = ("<!DOCTYPE html><html><head><title>T</title><style>p{margin:0}</style><script>var t='</p><article>x';</script></head>"
        f"<body class='no-sidebar'><header><a href='/'>Site name</a></header>{NAV}<div class='cookie-notice'>We use cookies.</div>"
        "<div class='wrap sidebar-left'><ARTICLE><header><h1>A &amp; B</h1></header><p>First   para\n with <b>bold</b>"
        "<i>ness</i> &eacute;&#x41;.<br>Next line<p>Unclosed one<form><input value='>'>Sign up</form>"
        "<aside>Beside</aside><div class=\"ad\">Buy!</div><p>Last.</p><section class='comments'><p>I agree</p></section>"
        "</ARTICLE></div><footer>&copy; Foot</footer></body></html>")
TEXT = "A & B\nFirst para with boldness éA.\nNext line\nUnclosed one\nLast."


def brute(page):
    """The article of the test tables' pages, cut at every tag that ends a block."""
    body = page[page.find("<article>"):].split("</article>")[0]
    blocks = (html.unescape(re.sub(r"<[^>]*>", "", b)) for b in re.split(r"</?(?:article|h1|p|br)[^>]*>", body))
    return "\n".join(b for b in (re.sub(r"\s+", " ", b).strip() for b in blocks) if b)


@pytest.fixture(scope="module")
def weights(spark):
    return H.learn(spark.read.parquet(f"{SF_MID}/pages.parquet"))


def test_query(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF_MID}/pages.parquet").collect()}
    got = E.queries()["op6_main_text"](spark, SF_MID).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r["text"] == brute(pages[r["page_id"]]["html"])
        assert r["url"] == pages[r["page_id"]]["url"] and r["n_chars"] == len(r["text"])


def test_without_the_pages_own_label(spark, weights):
    pages = spark.read.parquet(f"{SF_MID}/pages.parquet").limit(150).collect()
    for w in (weights, H.PRIOR):
        same = [H.extract(re.sub("(</?)article", r"\1div", r["html"]), w) == brute(r["html"]) for r in pages]
        assert sum(same) == len(same)


def test_a_page_with_everything(weights):
    assert H.extract(PAGE, weights) == H.extract(PAGE, H.PRIOR) == TEXT


def test_run_is_the_best_of_all_runs():
    import random
    rnd = random.Random(6)
    for _ in range(300):
        s = [rnd.choice([-3, -1, 0, 1, 2]) for _ in range(rnd.randint(0, 12))]
        a, b = H.best_run(s)
        assert sum(s[a:b]) == max([0] + [sum(s[i:j]) for i in range(len(s)) for j in range(i, len(s) + 1)])


def test_odd_pages(spark):
    odd = [None, "", "   ", "plain words only", "<p", "<p>open <b", "a < b and c > d", "<script>never closed <p>x", "<!-- open",
           "<div " + "\"" * 3000, "<script " + "'x\"" * 3000, "<p>" * 3000 + "deep" + "</p>" * 10, PAGE, PAGE, "<p>&#0; &bogus; &lt;b&gt;</p>",
           "<p>" + "word " * 50_000 + "</p>"]
    df = spark.createDataFrame([(i, None if i % 2 else f"u{i}", h, "clash", 3) for i, h in enumerate(odd)],
                               "page_id long, url string, html string, text string, n_chars int")
    t = time.time()
    got = {r["page_id"]: r["text"] for r in H.extract_pages(df, H.PRIOR).collect()}
    assert time.time() - t < 30
    assert got[0] == got[1] == got[2] == got[7] == got[8] == ""
    assert got[3] == "plain words only" and got[5] == "open" and got[11] == "deep"
    assert got[12] == got[13] == TEXT and got[15] == ("word " * 50_000).strip()
    assert H.extract_pages(df.limit(0), H.PRIOR).count() == 0
    assert H.learn(df.where("page_id < 4")) == H.PRIOR


@pytest.mark.parametrize("learnt", [False, True])
def test_class_words_of_ordinary_templates(weights, learnt):
    """Words that tell a state hide nothing; articles inside something beside are teasers."""
    w = weights if learnt else H.PRIOR
    body = "<h1>Title here</h1><p>First paragraph of this article, long enough.</p><p>Second one of it, as long as that.</p>"
    want = "Title here\nFirst paragraph of this article, long enough.\nSecond one of it, as long as that."
    teaser = "<article><p>Another story, told elsewhere at some length today.</p></article>"
    for page in (f'<body>{NAV}<article class="post comments-open hentry">{body}</article></body>',
                 f'<body>{NAV}<div class="layout no-sidebar"><article>{body}</article></div></body>',
                 f'<body>{NAV}<div class="layout no-sidebar">{body}</div></body>',
                 f"<body>{NAV}<article>{body}</article><aside>{teaser}</aside></body>",
                 f'<body>{NAV}<article>{body}</article><section class="related">{teaser}</section></body>'):
        assert H.extract(page, w) == want
