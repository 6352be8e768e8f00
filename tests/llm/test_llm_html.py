import html
import re
import time

import pytest
from pyspark.sql import functions as F

from vectrine.llm.html_extract import LEAST_PAGES, NOISE, Page, host_of, importance, main_text

FOLDER = "/root/testdata/sf0.001"


def article(source):
    """The article of the driver's simple pages."""
    m = re.search("<article>(.*?)(</article>|$)", source or "", re.S)
    parts = re.split(r"</?(?:p|h1|br)>", m[1]) if m else []
    texts = [" ".join(html.unescape(re.sub("<[^>]*>", "", p)).split()) for p in parts]
    return "\n".join(t for t in texts if t)


def test_query_matches_the_articles(run, spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    rows = run("op9_html_extraction")
    assert len(rows) == len(pages)
    for r in rows:
        p = pages[r["page_id"]]
        assert (r["url"], r["text"], r["n_chars"]) == (p["url"], article(p["html"]), len(article(p["html"])))


def extract(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as text", "'y' as host", "'z' as page", "1 as blocks")
    return {r["page_id"]: r["text"] for r in main_text(df).collect()}


FULL = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style></head><body class="home page">
<header class="top"><h1>Site</h1></header><div id="cookie-notice">We use cookies</div><nav><ul><li>Menu</ul></nav>
<main><article><header><h1>Head&nbsp;line</h1></header><p>One <b>bold</b>\n\t word&#33;<p>Two &lt;tags&gt; &copy
<ul><li>a<li>b</ul><table><tr><td>c<td>d</table><div class="ad">Buy</div><script>if (a<b) "</p>"</script>
<form><input value="q"><label>Name</label></form><blockquote>Quote<br>next</blockquote><!-- <p>no</p> -->
<section class="comments"><p>First!</p></section><aside>Side</aside></article></main>
<footer>Foot</footer></body></html>"""


def test_page_parts(spark):
    want = "Head line\nOne bold word!\nTwo <tags> ©\na\nb\nc\nd\nQuote\nnext"
    assert extract(spark, [(1, "http://a.example/x", FULL)]) == {1: want}


AWKWARD = [
    (1, None, None),
    (2, "", ""),
    (3, "no url", "plain text only"),
    (4, "http://a.example/", "<"),
    (5, "http://a.example/", "<p>a < b and <3 <p title='x>y'>c</p"),
    (6, "http://a.example/", "<article></article><p>outside</p>"),
    (7, "http://a.example/", "<p>x" * 3000),
    (8, "http://a.example/", "<div>" * 3000 + "deep"),
    (9, "http://a.example/", "<script>never closed <p>x</p>"),
    (10, "http://a.example/", '<p class="unclosed>a</p><p>b</p>'),
    (11, "http://a.example/", "<!-- open <p>x</p>"),
    (12, "http://a.example/", "</p></div>stray<br/>ends</b>"),
    (None, "http://a.example/", "<p>no key"),
]


def test_awkward_pages(spark):
    found = extract(spark, AWKWARD)
    assert len(found) == len(AWKWARD)
    assert found[1] == found[2] == found[9] == found[11] == ""
    assert found[3] == "plain text only"
    assert found[5] == "a < b and <3\nc"
    assert found[6] == "outside"
    assert found[7] == "\n".join(["x"] * 3000)
    assert found[8] == "deep"
    assert found[12] == "stray\nends"
    assert found[None] == "no key"
    assert extract(spark, []) == {}


def test_repeated_rows_stay(spark):
    df = spark.createDataFrame([AWKWARD[2]] * 3, "page_id long, url string, html string")
    assert main_text(df).count() == 3


def site(i):
    return f"<html><body><div class='x1'><div class='y'>All rights kept by us</div></div><div class='x2'><h2>Title {i}</h2><p>Body number {i} is here.</p></div></body></html>"


@pytest.mark.parametrize("most", [1_000_000, 0])
def test_templates_go_by_their_entropy(spark, monkeypatch, most):
    monkeypatch.setattr("vectrine.llm.html_extract.BROADCAST_PATHS", most)
    pages = [(i, "https://h.example/p", site(i)) for i in range(40)]
    assert extract(spark, pages) == {i: f"Title {i}\nBody number {i} is here." for i in range(40)}
    few = [(i, "https://h.example/p", site(i)) for i in range(LEAST_PAGES - 1)]
    assert all("rights" in t for t in extract(spark, few).values())


def test_a_host_of_copies_keeps_its_text(spark):
    pages = [(i, "https://h.example/p", "<body><p>Same text</p></body>") for i in range(40)]
    assert set(extract(spark, pages).values()) == {"Same text"}


def test_importance_of_paths(spark):
    pages = [Page(site(i)) for i in range(20)]
    parsed = spark.createDataFrame(
        [("h", [(a % 2**62, b % 2**62, t) for a, b, t in p.candidates()], [(a % 2**62, hash(t) % 2**60) for a, _, t in p.candidates()], [(k % 2**62, hash(tuple(v)) % 2**60) for k, v in p.styles.items()]) for p in pages],
        "host string, blocks array<struct<path:long,parent:long,text:string>>, texts array<struct<path:long,value:long>>, styles array<struct<path:long,value:long>>",
    )
    values = sorted(r["importance"] for r in importance(parsed).collect())
    assert values[0] == pytest.approx(0.0, abs=1e-9) and all(v == pytest.approx(0.9) for v in values[1:])


def test_hosts(spark):
    urls = ["HTTP://User@Www.A.example:80/x?y", "https://b.example", "mailto:x", "", None]
    rows = spark.createDataFrame([(u,) for u in urls], "u string").select(host_of(F.col("u")).alias("h")).collect()
    assert [r["h"] for r in rows] == ["www.a.example", "b.example", "", "", ""]


@pytest.mark.parametrize("source", ["<b><br>x", "<b><hr>x", "<b></i>x", "<div><b>x</p>"])
def test_open_tags_take_linear_time(source):
    """Elements that are never closed are not walked over again for every block."""
    started = time.process_time()
    page = Page(source * 40_000)
    assert time.process_time() - started < 20
    assert "".join(text for *_, text in page.blocks) == "x" * 40_000


def test_noise_covers_what_lies_in_it():
    page = Page("<p>one<nav><b>two<p>three</b></nav><i>four</i> <b>five<br>six")
    assert [(kind == NOISE, text) for *_, kind, text in page.blocks] == [(False, "one"), (True, "two"), (True, "three"), (False, "four five"), (False, "six")]
