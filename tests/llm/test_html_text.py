import html
import re

import pytest
from pyspark.sql import functions as F

from lakepipe.llm import html_text, queries

SMALL = "/root/testdata/sf0.01"
LONG = "A sentence of the article that is long enough to be one. " * 3


def article_of(page):
    inside = page.split("<article>", 1)[1].split("</article>", 1)[0]
    blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", inside)]
    return "\n".join(b for b in blocks if b)


def test_query_against_the_pages_articles(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    rows = queries.op10_main_text(spark, SMALL).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r["text"] == article_of(pages[r["page_id"]]["html"])
        assert r["url"] == pages[r["page_id"]]["url"] and r["n_chars"] == len(r["text"])


def text(*body):
    return html_text.main_text("<html><head><title>T</title></head><body>" + "".join(body) + "</body></html>")


@pytest.mark.parametrize(
    "noise",
    [
        "<nav><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></nav>",
        f"<div class='ad'>{LONG}</div>",
        f"<aside><p>{LONG}</aside>",
        f"<div id=sidebar><div>{LONG}</div><div>{LONG}</div></div>",
        f"<footer>{LONG}</footer>",
        f"<header><h2>{LONG}</h2></header>",
        f"<form><label>{LONG}</label><input></form>",
        f"<div class='cookie-notice'>{LONG}</div>",
        f"<section class=\"comments\"><div class=comment>{LONG}</div></section>",
        f"<!-- {LONG} --><script>var x = '<p>{LONG}</p>';</script><style>p {{ }}</style>",
        f"<p class=advert>{LONG}",
        f"<div hidden>{LONG}</div>",
        f"<ul><li><a href=/x>{LONG}</a></li></ul>",
    ],
)
@pytest.mark.parametrize("wrapped", ["<article>{}</article>", "<main>{}</main>", "<div><div>{}</div></div>"])
def test_noise_goes_and_the_article_stays(noise, wrapped):
    article = f"<h1>Title</h1><p>{LONG}</p><p>Short.</p><p>{LONG}<br>{LONG}</p>"
    want = "\n".join(["Title", LONG.strip(), "Short.", f"{LONG.strip()} {LONG.strip()}"])
    assert text(noise, wrapped.format(article)) == want
    assert text(wrapped.format(article), "<div></div>", noise) == want


def test_spaces_references_and_blocks():
    assert text("<article><p>a &amp;&amp; b\n\t c&nbsp;d &lt;p&gt;</p>x<b>y</b>z</article>") == "a && b c d <p>\nxyz"
    assert text("<article><p>one<!-- x -->two</p><table><tr><td>c</td><td>d</td></tr></table></article>") == "onetwo\nc\nd"


def test_broken_markup():
    assert text("<div class=ad>never closed <article><p>kept</p></article>") == "kept"
    assert html_text.main_text("<article><p>cut off in the mid") == "cut off in the mid"
    assert html_text.main_text("1 < 2 and 3 > 2") == "1 < 2 and 3 > 2"
    assert html_text.main_text("<script>never closed <p>x</p>") == ""


def test_odd_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<p></p>"), (None, "u", "plain"), (5, "u", "<p>" + "w " * 100_000), (5, "u", "<p>x")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    out = html_text.extract(frame).collect()
    assert [(r["page_id"], r["n_chars"]) for r in out] == [(1, 0), (2, 0), (3, 0), (None, 5), (5, 199_999), (5, 1)]
    assert html_text.extract(frame.where("false")).count() == 0
