"""Main text extraction on written pages and on the table."""

from __future__ import annotations

import html
import re

import pytest

from visitflow.llm import html_mss
from visitflow.llm.common import table
from visitflow.llm.queries import QUERIES

MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def weights(spark):
    rows = table(spark, MEDIUM, "pages").select("html").collect()
    return html_mss.fit([r["html"] for r in rows])


def test_articles_of_the_table(spark):
    """Brute force for this table's pages: the one article element, split at its block tags."""
    got = {r["page_id"]: r for r in QUERIES["op7_html_mss"](spark, MEDIUM).collect()}
    pages = table(spark, MEDIUM, "pages").collect()
    assert len(got) == len(pages)
    for page in pages:
        article = re.search(r"<article>(.*?)</article>", page["html"], re.S)[1].replace("<br>", " ")
        blocks = (html.unescape(re.sub(r"<[^>]*>", "", b)) for b in re.split(r"</?(?:p|h1)>", article))
        want = "\n".join(b for b in (" ".join(x.split()) for x in blocks) if b)
        row = got[page["page_id"]]
        assert row["text"] == want and row["n_chars"] == len(want) and row["url"] == page["url"]


CASES = [
    ("", ""),
    ("just words, no tags", "just words, no tags"),
    ("<p>one &amp; two&nbsp;three &#x41;&lt;</p><p>four\n\t five</p>", "one & two three A<\nfour five"),
    ("<nav><a>Home</a><a>News</a></nav><p>The text of it is here.</p><footer>All rights reserved by us</footer>", "The text of it is here."),
    ("<p>Cut off in the mid", "Cut off in the mid"),
    ("<article><p>First part of the text.</p><div class='ad'>Buy this now for less</div><p>Second.</p></article>", "First part of the text.\nSecond."),
    ("<article><header><h1>A title</h1></header><p>Words of the article</p><section class='comments'>I like it</section></article>", "A title\nWords of the article"),
    ("<script>var a = '<p>no</p>';</script><style>p{}</style><p>yes</p><!-- <p>no</p> -->", "yes"),
    ("<p>a <b>bold</b>er <i>word</i><br>next line</p>", "a bolder word next line"),
    ("<p attr='>'>quoted mark</p></div></p>", "quoted mark"),
]


@pytest.mark.parametrize("source,want", CASES)
def test_cases(weights, source, want):
    assert html_mss.extract(source, weights) == want


WRAPPED = "<h1>A title</h1><p>The words of the article stand here.</p>"
WRAPPERS = [
    f"<body class='right-sidebar'><nav>Home</nav><article>{WRAPPED}</article></body>",
    f"<body class='sidebar'><nav>Home</nav><main>{WRAPPED}</main></body>",
    f"<div id='page' class='site'><nav>Home</nav><article>{WRAPPED}</article></div>",
    f"<div class='banner notice'><div class='sidebar'><main>{WRAPPED}</main></div><footer>All rights</footer></div>",
    f"<article class='post has-comments'>{WRAPPED}</article>",
    f"<article class='comments'>{WRAPPED}<div class='comments'>Nice one</div></article>",
    f"<article><div class='share'>{WRAPPED}</div><div class='ad'>Buy it</div></article>",
    f"<div class='header'><div class='content-with-sidebar'>{WRAPPED}</div></div>",
    f"<form class='social'><nav>Home</nav><div class='sidebar'>{WRAPPED}</div></form>",
    f"<body class='sidebar'><div class='right-sidebar'>{WRAPPED}</div><div class='sidebar'>Most read story</div></body>",
]


@pytest.mark.parametrize("source", WRAPPERS)
def test_wrappers_of_the_content_stay(weights, source):
    assert html_mss.extract(source, weights) == "A title\nThe words of the article stand here."


COMMENT = "<article><p>Nice one, I liked it</p></article>"
ARTICLES = [
    f"<article>{WRAPPED}</article><section><h2>Comments</h2>{COMMENT}{COMMENT}</section>",
    f"<main><article>{WRAPPED}</article>{COMMENT}</main>",
    f"<article>{WRAPPED}<div class='replies'>{COMMENT}{COMMENT}{COMMENT}</div></article>",
    f"<article class='wrapper'><article>{WRAPPED}</article></article>",
    f"<article>{COMMENT}{WRAPPED}</article>",
]


@pytest.mark.parametrize("source", ARTICLES)
def test_articles_that_are_comments_go(weights, source):
    assert html_mss.extract(source, weights) == "A title\nThe words of the article stand here."


def test_a_list_of_articles_stays(weights):
    words = "Some words of the post " * 12
    posts = [f"<article><h2>Post {i}</h2><p>{words}number {i}.</p></article>" for i in range(4)]
    want = "\n".join(f"Post {i}\n{words}number {i}." for i in range(4))
    assert html_mss.extract("".join(posts), weights) == want


def test_labelled_pages_give_their_content(weights):
    for source in html_mss.LABELLED:
        inside = re.search(r"<content>(.*)</content>", source)[1]
        words = re.sub(r"<[^>]*>", " ", inside).split()
        assert html_mss.extract(source, weights).replace("\n", " ").split() == [w for w in words if w != "."] or (
            html_mss.extract(source, weights).replace(" ", "").replace("\n", "") == "".join(words)
        )


def test_hostile_sizes(weights):
    long = "<p>" + "word " * 200_000 + "</p>"
    assert len(html_mss.extract(long, weights)) == 5 * 200_000 - 1
    html_mss.extract("<a " * 50_000, weights)
    html_mss.extract("<div>" * 5_000 + "deep words" + "</div>" * 5_000, weights)
    html_mss.extract("<p a='" * 2_000, weights)


def test_odd_rows(spark):
    rows = [(1, "u", None, "t"), (None, None, "<p>x y z</p>", "t"), (1, "u", "", "t"), (1, "u", "", "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((str(r["page_id"]), r["text"], r["n_chars"]) for r in html_mss.extract_pages(pages).collect())
    assert got == [("1", "", 0)] * 3 + [("None", "x y z", 5)]
    assert html_mss.extract_pages(pages.limit(0)).count() == 0
