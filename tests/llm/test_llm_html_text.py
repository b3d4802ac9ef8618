import html
import re

import pytest
from llm_cases import CLASHING
from pyspark.sql import functions as F

from wellgauge.llm import html_text, queries

ARTICLE = "<h1>On rivers</h1><p>Water runs down a hill, and on to the sea it goes.</p><p>So it is.</p>"
TEXT = "On rivers Water runs down a hill, and on to the sea it goes. So it is."


@pytest.mark.parametrize(
    "source, want",
    [
        ("", ""),
        ("   ", ""),
        ("plain words\n only", "plain words only"),
        ("<p>a<b>b</b>c<br>d&nbsp;e &lt;x&gt; &copy &#8212;&#x41;</p>", "abc d e <x> © —A"),
        ("<p>one<p>two<ul><li>three<li>four</ul>", "one two three four"),
        ("<p><b>one<br><p>two</p></b>three", "one two three"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"),
        ("<p>a < b and c > d</p>", "a < b and c > d"),
        ("<p title='a > b'>kept</p>", "kept"),
        ("x<!-- no --><!-- > -->y<script>var a='<p>no</p>';</script>z", "xyz"),
        ("<style>p{}</style><p>kept</p><noscript>no</noscript><template>no</template>", "kept"),
        ("<div hidden>no</div><div style='display: none'>no</div><p>kept</p>", "kept"),
        ("<script>never closed <p>no</p>", ""),
        ("<div " * 3 + "x", ""),
        ("<div>" * 5000 + "deep" + "</div>" * 5000, "deep"),
        ("<p>ÀÉ漢字 😀</p>", "ÀÉ漢字 😀"),
        ("</p></div>odd<p>ends</b>", "odd ends"),
    ],
)
def test_text_of_markup(source, want):
    assert html_text.main_text(source) == want


MENU = "".join(f'<li><a href="/{i}">Go to part {i}</a></li>' for i in range(8))
FURNITURE = [
    f"<nav><ul>{MENU}</ul></nav>",
    f'<div class="main-menu"><ul>{MENU}</ul></div>',
    f"<ul>{MENU}</ul>",
    "<header><h1>The Daily River</h1><p>All the news of water that we could find</p></header>",
    "<footer><p>All rights kept, by those who wrote the words you read above this.</p></footer>",
    '<aside><p>Another story that you may like to read some day when you have time.</p></aside>',
    '<div id="sidebar"><p>Another story that you may like to read some day soon.</p></div>',
    '<div class="cookie-notice"><p>We keep a note of you so that we may know you again.</p></div>',
    '<div class="ad">Buy this water now, it is the best of all waters there are.</div>',
    '<form action="/go"><label>Your name, please</label><input><button>Send it</button></form>',
    '<div role="alert">The water is rising, leave your houses and go up the hill.</div>',
    '<section id="comments"><div class="comment"><p>I have read this twice, and I liked what '
    "it says about the hill. My own river does the same every day.</p></div></section>",
    "<script>if (1 < 2) { write('<p>no</p>') }</script>",
]


@pytest.mark.parametrize("piece", FURNITURE)
@pytest.mark.parametrize("frame", ["<article>{}</article>", '<div class="post has-sidebar">{}</div>'])
def test_furniture_goes(piece, frame):
    article = frame.format(ARTICLE)
    placed = [piece + article, article + piece]
    if not piece.startswith("<header"):  # an article's own holds its title
        placed.append(frame.format(ARTICLE + piece))
    for page in placed:
        page = f"<!DOCTYPE html><html><head><title>no</title></head><body class='with-menu'>{page}"
        assert html_text.main_text(page) == TEXT


def test_an_article_has_its_own_header():
    header = "<header><h1>On rivers</h1></header>"
    page = f"<header>Site</header><article>{header}<p>Water runs.</p></article>"
    assert html_text.main_text(page) == "On rivers Water runs."


def test_an_article_in_several_parts_is_whole():
    part = "<div><p>{0} water runs down a hill for a long while.</p><p>{0} it rests.</p></div>"
    parts = [part.format(w) for w in ("First", "Then", "Last")]
    page = f"<body><ul>{MENU}</ul><div><h2>Rivers</h2>{''.join(parts)}</div><div>(c)</div></body>"
    text = html_text.main_text(page)
    assert text.startswith("Rivers First water") and text.endswith("Last it rests.")
    assert "Go to" not in text and "(c)" not in text


def test_the_densest_of_several_articles():
    teaser = "<article><h2>Read this</h2><p>Soon.</p></article>"
    page = f"<main>{teaser}<article>{ARTICLE}</article>{teaser}</main>"
    assert html_text.main_text(page) == TEXT


def test_density_of_a_small_tree():
    """Characters per element, less for links, by hand."""
    page = html_text.Page("<body><p>abcdefghij</p><div><a>abcde</a>fghij</div></body>")
    sizes = [0, 0, 10, 5, 5]
    measures = html_text._Measures(page, sizes, [False] * 5)
    assert measures.characters == [20, 20, 10, 10, 5]
    assert measures.elements == [4, 3, 0, 1, 0]
    assert (measures.link_characters, measures.links) == ([5, 5, 0, 5, 5], [1, 1, 0, 1, 0])
    densities = measures.densities(1)
    assert densities[2] > densities[3] > densities[4]


def test_an_id_that_is_about_furniture_is_not_furniture():
    for label in ("no-sidebar", "withMenu", "has_header", "adventure", "heading"):
        assert not html_text._names_furniture(label)
    for label in ("site-header", "topNav", "AD", "x comment_list"):
        assert html_text._names_furniture(label)


def pages(spark, rows):
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    return table.withColumns({n: F.lit(f"own {n}") for n in (*CLASHING, "text", "n_chars")})


AWKWARD = [
    (None, "u", "<p>no id</p>"),
    (1, None, None),
    (2, "u", ""),
    (3, "u", "<article>" + ARTICLE * 2000 + "</article>"),
    (4, "u", ARTICLE),
    (4, "u", ARTICLE),
]


def test_query_on_awkward_pages(spark, tmp_path):
    pages(spark, AWKWARD).write.parquet(f"{tmp_path}/pages.parquet")
    got = queries.op12_page_text(spark, str(tmp_path))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    rows = sorted(map(tuple, got.collect()), key=str)
    long = " ".join([TEXT] * 2000)
    want = [(None, "u", "no id", 5), (1, None, "", 0), (2, "u", "", 0), (3, "u", long, len(long)),
            (4, "u", TEXT, len(TEXT)), (4, "u", TEXT, len(TEXT))]
    assert rows == sorted(want, key=str)


def test_no_pages(spark):
    assert html_text.extract(pages(spark, AWKWARD).limit(0)).collect() == []


def test_invalid_bytes_stay_in_their_row(spark):
    bad = spark.sql("select 1L as page_id, 'u' as url, cast(X'61FF80' as string) as html")
    both = bad.unionAll(spark.createDataFrame([(2, "u", "<p>good</p>")], bad.schema))
    assert {r.page_id: r.text for r in html_text.extract(both).collect()}[2] == "good"


def test_given_pages_as_by_their_article(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in queries.op12_page_text(spark, sf_dir).collect():
        inside = re.search("<article>(.*)</article>", rows[r.page_id], re.S)[1]
        want = " ".join(html.unescape(re.sub("<[^>]*>", " ", inside)).split())
        assert (r.text, r.n_chars) == (want, len(want))
