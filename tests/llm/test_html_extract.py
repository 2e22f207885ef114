"""HTML extraction: what stays and goes on pages unlike the labelled ones."""

import numpy as np
import pytest

from tests.llm.helpers import frame, rows_of
from tracemill.llm import html_extract as H


@pytest.fixture(scope="module")
def tree():
    return H.train()


def text(tree, page):
    return H.main_text(page, tree)


ARTICLE = "<article><h1>Head  line</h1><p>One &amp; two&nbsp;three.</p><p>End.</p></article>"
KEPT = "Head line\n\nOne & two three.\n\nEnd."


@pytest.mark.parametrize(
    "page",
    [
        ARTICLE,
        f"<html><head><title>T</title><style>p{{}}</style><script>var t='<p>no</p>';</script></head><body>{ARTICLE}</body></html>",
        f"<header><h1>Site</h1><a href=/>x</a></header><nav><a href='/a'>A</a> <a href='/b'>B</a></nav>{ARTICLE}<footer>&copy; 2020 Some words of the owners here</footer>",
        f"<div class='cookie-notice'><p>We use cookies, and this notice is quite long to read for all of us.</p></div>{ARTICLE}",
        f"<aside><p>A side note that has many words in it and goes on and on for a while.</p></aside>{ARTICLE}<div id=comments><p>I think this is right.</p></div>",
        ARTICLE.replace("<p>End.", "<aside>Note</aside><form><label>Name</label><input value=x><button>Go</button></form><script>x</script><p>End."),
        ARTICLE.replace("<p>End.", '<div class="advert"><p>Buy this</p></div><p>End.'),
        ARTICLE.replace("<p>End.", "<!-- <p>hidden</p> --><style>.a{}</style><p>End."),
        ARTICLE.replace("</article>", '<section class="comments"><article class="comment"><p>Nice one</p></article></section></article>'),
        ARTICLE.upper().replace("HEAD  LINE", "Head  line").replace("ONE &AMP; TWO&NBSP;THREE", "One &amp; two&nbsp;three").replace("END", "End"),
        f"<div class=ad>Unclosed advert {ARTICLE}",
        ARTICLE.replace("</p>", "").replace("</article>", ""),
        ARTICLE.replace("<p>End.</p>", "<p><b>E</b><i>nd</i>.</p>"),
        ARTICLE + "<footer>cut off in the mid",
        ARTICLE + "<script>never closed <p>x</p>",
        "<body class='has-sidebar with-ads'>" + ARTICLE,
        ARTICLE.replace("<article>", "<article data-x='>' class=\"a\nb\">"),
        "<title>a </title><noscript><p>Turn it on</p></noscript><iframe><p>f</p></iframe>" + ARTICLE,
        ARTICLE.replace("<article>", "<main>").replace("</article>", "</main>") + "<div role=complementary>More</div>",
    ],
)
def test_article_only(tree, page):
    assert text(tree, page) == KEPT


@pytest.mark.parametrize("around", [
    "<aside>{}</aside>", "<footer>{}</footer>", "<header>{}</header>", "<nav>{}</nav>", "<form>{}</form>", "<div class='comments'>{}</div>",
    "<div class='sidebar'><div>{}</div></div>", "<section id='cookie-consent'>{}</section>", "<div class='ad'>{}</div>", "<div class='site-notice'>{}</div>",
])
def test_long_texts_of_furniture_go(tree, around):
    furniture = around.format("".join(f"<p>{'Word after word in a long run of text. ' * n}</p>" for n in (1, 5, 20)))
    assert text(tree, furniture + ARTICLE + furniture) == KEPT
    assert text(tree, ARTICLE.replace("<p>End.", furniture + "<p>End.")) == KEPT


def test_lists_tables_and_links_inside_the_article_stay(tree):
    page = "<nav>x</nav><article><ul><li>First<li>Second</ul><table><tr><td>1<td>2</table><p><a href=/x>All linked</a></p><blockquote>Q</blockquote><pre>a\n  b</pre></article>"
    assert text(tree, page) == "First\n\nSecond\n\n1\n\n2\n\nAll linked\n\nQ\n\na b"


def test_pages_without_named_containers(tree):
    long = "This paragraph has a good number of words in it, and they run on without any link at all to the very end of it. " * 3
    page = f"<ul><li><a href=/>Home</a></li><li><a href=/a>About us</a></li></ul><p>{long}</p><p>{long}</p><p><a href=/n>Next</a></p>"
    assert text(tree, page) == f"{long.strip()}\n\n{long.strip()}"


@pytest.mark.parametrize("page", ["", "   ", "<", "<>", "</", "<!--", "<p", "<nav>only</nav>", "&amp", "<script>", "</p></div>", "<a><b", "<p a='"])
def test_broken_pages_do_not_crash(tree, page):
    assert isinstance(text(tree, page), str)


def test_decoding_is_done_once(tree):
    assert text(tree, "<article><p>&amp;lt;b&amp;gt; &#233;&#x41; &unknown; 1 < 2 &lt;p&gt;</p></article>") == "&lt;b&gt; éA &unknown; 1 < 2 <p>"


def test_tree_learns_its_table():
    x, y = H.labelled_blocks()
    assert ((H.train().predict(x) >= 0.5) == y).mean() > 0.9
    easy = H.DecisionTree.grow(np.array([[0.0], [1.0], [2.0], [3.0]]), np.array([0, 0, 1, 1]))
    assert easy.predict(np.array([[1.4], [1.6]])).tolist() == [0.0, 1.0]


@pytest.mark.parametrize("page", [
    "<article><header><h1>Real title</h1><p>By a writer</p></header><p>Body of it.</p></article>",
    "<article><div class='post-header'><h1>Real title</h1><p>By a writer</p></div><p>Body of it.</p></article>",
    "<div class='entry-header'><h1>Real title</h1><p>By a writer</p></div><div class='entry-content'><p>Body of it.</p></div>",
    "<article><h1>Real title</h1><p class='search-tags'>By a writer</p><p>Body of it.</p></article>",
    "<article><h2 id='related-work'>Real title</h2><p>By a writer</p><p>Body of it.</p></article>",
    "<main><h2 id='search'>Real title</h2><p>By a writer</p><p>Body of it.</p></main><div class='reader-opinions'><p>I see it in another way.</p></div>",
    "<article><h2>Real title</h2><section id='related-work'><p>By a writer</p></section><p>Body of it.</p></article><section class='voices'><p>Not so.</p></section>",
    "<article><h2 id='comments'>Real title</h2><p>By a writer</p><p>Body of it.</p><div class='related'><a href=/x>See also</a></div></article>",
])
def test_names_inside_an_article_decide_nothing_alone(tree, page):
    assert text(tree, f"<nav><a href=/>Home</a></nav>{page}<footer>Imprint of the site</footer>") == "Real title\n\nBy a writer\n\nBody of it."


@pytest.mark.parametrize("piece", ["<div>word", "<div></p>word", "<li><ul>word", "<div></section>", "<section><h1>word"])
def test_deep_pages_take_linear_time(tree, piece):
    import time

    begun = time.perf_counter()
    H.blocks(piece * 50_000)
    assert time.perf_counter() - begun < 4


def test_rows(spark, tree):
    rows = [(1, None, "u", "old"), (2, "", "v", "old"), (3, ARTICLE, "w", "old"), (3, ARTICLE, "w", "old"), (None, "<article>" + "<p>x y</p>" * 20_000, None, None)]
    df = frame(spark, rows, "page_id long, html string, url string, text string")
    got = {r["page_id"]: r["text"] for r in H.extract(df, tree).collect()}
    assert got[1] == got[2] == "" and got[3] == KEPT and len(got[None]) == 20_000 * 5 - 2
    assert H.extract(df, tree).columns == ["page_id", "url", "text"]
    assert H.extract(df.limit(0), tree).count() == 0


def test_pages_of_the_table(spark, sf):
    from html import unescape
    import re

    from tracemill.llm.queries import op9_html_extract

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = rows_of(op9_html_extract(spark, sf), "page_id", "text", "n_chars")
    assert len(got) == len(pages)
    for page, found, n in got:
        inside = re.search(r"<article>(.*?)(?:</article>|$)", pages[page], re.S)[1]
        parts = [" ".join(unescape(re.sub(r"<[^>]+>", "", p.replace("<br>", " "))).split()) for p in re.split(r"</?(?:p|h1)>", inside)]
        assert found == "\n\n".join(p for p in parts if p) and n == len(found)
