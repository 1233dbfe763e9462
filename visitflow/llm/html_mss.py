"""Main text of HTML pages: the maximum-scoring run of words and tags.

A page is scanned once into words and tags. A word scores positive, a tag negative; the
best contiguous run of the page (a linear scan) is its content region, and the
blocks of text inside it are the result.

Weights are learned from labelled pages: a fixed set written out below, and pages of
the table that mark their article themselves (``<article>`` or ``<main>``), at most
``SAMPLE_PAGES`` of them. Tags are counted by kind inside and outside the labelled
content; a tag's cost is the log odds of standing outside. Elements whose words
are hardly ever content (menus, adverts, comments ...) are learned as well: such an
element scores nothing, neither its words nor its tags, and is left out of the result.
Classes, ids and roles count as whole tokens (``right-sidebar`` is not ``sidebar``), and an
element that may hold the content itself stays: body, main and article, whatever contains
one of these two, and a wrapper of more than ``WRAPPER_SHARE`` of the page's words.

Of several articles, the one with the most words of its own (not in articles inside it) is the
page's; those inside it are left out, whatever their class (comments are marked up
so), and so are those beside it if it has over half of all articles' words. A page whose
articles are of like size is a list, which stays whole.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitflow.llm.common import bounded_sample

#: Pages of the table that are learned from: those of smallest xxhash64(page_id).
SAMPLE_PAGES = 400
#: An element kind is left out if less than this share of its words is content.
CONTENT_SHARE = 0.05
#: A form, or an element known by its class, id or role, is not left out if it holds more than this
#: share of the words (of those in closed article and main elements, if any are there).
WRAPPER_SHARE = 0.5
#: Score of a word; tags cost at least MIN_COST and at most MAX_COST words.
WORD_SCORE = 1.0
MIN_COST, MAX_COST = 0.2, 12.0

# Labelled pages. <content> marks what a reader would keep.
LABELLED = (
    "<body><header class='site-header'><a>Home</a><p>Site name and motto</p></header><nav class='menu'><ul><li><a>One"
    "</a></li><li><a>Two</a></li></ul></nav><content><h1>Title of it</h1><p>First paragraph of the article with an "
    "<a>inline link</a> and <em>stress</em>.</p><h2>Part</h2><p>Second paragraph, longer than the first one was.</p>"
    "<ul><li>a point made</li><li>another point made</li></ul></content><aside class='sidebar'><h3>Most read</h3><ul>"
    "<li><a>Some other story</a></li></ul></aside><footer><p>Copyright notice, all rights reserved</p></footer></body>",
    "<body><div class='cookie-notice'><p>We use cookies to make this site better for you</p><button>Accept</button></div>"
    "<div class='banner advert'><p>Buy one, get one free, only today</p></div><div class='post'><content><h1>A post</h1>"
    "<p>Text of the post goes here and on.</p><blockquote>Quoted words stand here</blockquote><p>The end of the post is "
    "here.</p></content></div><section class='comments'><h3>Comments</h3><div class='comment'><p>Nice post, I liked it a "
    "lot</p></div><form><label>Your comment</label><textarea></textarea></form></section></body>",
    "<body><div class='breadcrumbs'><a>Home</a> / <a>News</a></div><table><tr><td><content><p>An old page lays out its "
    "text in a table cell.</p><p>Two paragraphs are in it.</p></content></td></tr></table><div id='related'><a>Read this "
    "next</a></div><div class='newsletter subscribe'><form><p>Sign up for our letter</p></form></div><div class='share "
    "social'><a>Share</a></div><div class='ad'>Paid message from a sponsor</div></body>",
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|textarea|title|svg|iframe)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?/][^>]*>",
    re.S | re.I,
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

# Elements by their part in a page's flow.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code content data del dfn em font i ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr br img".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
IMPLIED_END = {"p": "p", "li": "li", "dt": "dt", "dd": "dt", "tr": "tr", "td": "td", "th": "td", "option": "option"}
SECTIONS = frozenset("article main".split())
#: Elements that may be left out as wholes, if learned to be; others need a class, id or role.
STRUCTURE = frozenset("nav header footer aside form button select dialog menu".split())
#: Never left out; of STRUCTURE, only these may wrap a page's content.
KEPT = SECTIONS | {"html", "body"}
WRAPPERS = frozenset({"form"})


def kinds(name: str, attributes: str) -> list[str]:
    """Kinds of an element that carry weights: its name and, of its class, id and role, the tokens."""
    found = [name]
    if attributes and name not in INLINE:
        for groups in _NAMES.findall(attributes):
            found += ["." + part for part in "".join(groups).lower().split()]
    return found


class Page:
    """Tokens of a page: ("text", raw) and ("tag", index of the element, closing?)."""

    def __init__(self, source: str):
        self.tokens: list[tuple] = []
        self.names: list[str] = []
        self.kinds: list[list[str]] = []
        self.closed: list[bool] = []
        stack: list[int] = []
        at = 0
        for m in _TOKEN.finditer(source):
            if m.start() > at:
                self.tokens.append(("text", source[at : m.start()]))
            at = m.end()
            name = m[3].lower() if m[3] else None
            if name is None:
                continue  # comments, scripts, styles, titles, declarations
            if m[2]:
                self._close(stack, name)
                continue
            if name in IMPLIED_END and stack:
                self._end_implied(stack, name)
            element = len(self.names)
            self.names.append(name)
            self.kinds.append(kinds(name, m[4]))
            self.closed.append(False)
            self.tokens.append(("tag", element, False))
            if name not in VOID and not m[4].endswith("/"):
                stack.append(element)
        if at < len(source):
            self.tokens.append(("text", source[at:]))
        self._measure()

    def _measure(self) -> None:
        """Set ``holds`` (closed sections in an element) and ``share`` of closed elements.

        The share is of the words inside closed sections, or of all if there are none.
        """
        n = len(self.names)
        section = [name in SECTIONS and closed for name, closed in zip(self.names, self.closed)]
        sofar = [0, 0, 0]  # words, words in sections, sections
        at_open: list[tuple[int, ...]] = [(0, 0, 0)] * n
        inside: list[tuple[int, ...]] = [(0, 0, 0)] * n
        depth = 0
        for token in self.tokens:
            if token[0] == "text":
                words = len(token[1].split())
                sofar[0] += words
                sofar[1] += words if depth else 0
                continue
            _, element, closing = token
            if closing:
                inside[element] = tuple(b - a for a, b in zip(at_open[element], sofar))
                depth -= section[element]
            else:
                depth += section[element]
                sofar[2] += section[element]
                at_open[element] = tuple(sofar)
        self._choose(section)
        base = 1 if sofar[1] else 0
        self.holds = [found[2] for found in inside]
        self.share = [found[base] / (sofar[base] or 1) for found in inside]

    def _choose(self, section: list[bool]) -> None:
        """Set ``other``: the articles that aren't the page's own."""
        own, above, open_ = Counter(), {}, []
        for token in self.tokens:
            if token[0] == "text":
                if open_:
                    own[open_[-1]] += len(token[1].split())
            elif section[token[1]]:
                if token[2]:
                    open_.remove(token[1])
                else:
                    above[token[1]] = tuple(open_)
                    open_.append(token[1])
        self.other: set[int] = set()
        articles = [e for e in above if self.names[e] == "article"]
        if len(articles) < 2:
            return
        best = max(articles, key=lambda e: (own[e], -e))
        alone = 2 * own[best] > sum(own[e] for e in articles)
        for e in articles:
            if e != best and e not in above[best] and (alone or best in above[e]):
                self.other.add(e)

    def _end_implied(self, stack: list[int], name: str) -> None:
        group = IMPLIED_END[name]
        for i in range(len(stack) - 1, -1, -1):
            open_name = self.names[stack[i]]
            if IMPLIED_END.get(open_name) == group:
                for element in reversed(stack[i:]):
                    self.closed[element] = True
                    self.tokens.append(("tag", element, True))
                del stack[i:]
                return
            if open_name not in INLINE:
                return

    def _close(self, stack: list[int], name: str) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if self.names[stack[i]] == name:
                for element in reversed(stack[i:]):
                    self.closed[element] = True
                    self.tokens.append(("tag", element, True))
                del stack[i:]
                return


def _walk(page: Page, marks: frozenset) -> Iterator[tuple[tuple, bool, list[int]]]:
    """Tokens with whether they stand inside marked content, and the open elements around them."""
    open_: list[int] = []
    depth = 0
    for token in page.tokens:
        if token[0] == "text":
            yield token, depth > 0, open_
            continue
        _, element, closing = token
        marked = page.names[element] in marks and page.closed[element]
        if closing:
            open_.remove(element)
            depth -= marked
        yield token, depth > 0, open_
        if not closing and page.closed[element]:
            open_.append(element)
            depth += marked


class Weights:
    """Learned costs of tag kinds, and the kinds whose elements are left out."""

    def __init__(self, pages: list[Page], marks: frozenset = SECTIONS | {"content"}):
        """Learn from pages whose content is marked by elements named in ``marks``."""
        content, other = Counter(), Counter()
        for page in pages:
            for token, marked, open_ in _walk(page, marks):
                if token[0] == "text":
                    n = len(token[1].split())
                    for kind in {k for e in open_ for k in page.kinds[e]}:
                        (content if marked else other)[kind] += n
        named = {k for k in content | other if k[0] == "." or k in STRUCTURE}
        self.dropped = frozenset(k for k in named if content[k] <= CONTENT_SHARE * (content[k] + other[k]))
        inside, outside = Counter(), Counter()
        for page in pages:
            for token, marked, open_ in _walk(page, marks):
                if token[0] == "tag" and not any(self.drops(page, e, False) for e in (*open_, token[1])):
                    (inside if marked else outside).update(page.kinds[token[1]])
        self.costs = {
            kind: min(MAX_COST, max(MIN_COST, 2 * math.log2((outside[kind] + 0.5) / (inside[kind] + 0.5))))
            for kind in inside | outside
        } | dict.fromkeys(SECTIONS, MAX_COST)  # the edge of a marked article is its region's edge

    def cost(self, kinds_: list[str]) -> float:
        return max([MIN_COST, *(self.costs.get(k, MIN_COST) for k in kinds_)])

    def drops(self, page: Page, element: int, in_article: bool) -> bool:
        """Whether an element's words are left out.

        An article's own header is kept, and so is what may hold the content: see the module's text.
        """
        name = page.names[element]
        if element in page.other:
            return True
        if not page.closed[element] or name in KEPT or page.holds[element] or (in_article and name == "header"):
            return False
        found = self.dropped.intersection(page.kinds[element])
        if not found or not found.isdisjoint(STRUCTURE - WRAPPERS):
            return bool(found)
        return page.share[element] <= WRAPPER_SHARE


def extract(source: str, weights: Weights) -> str:
    """The main text of one page: blocks of the best region joined by newlines."""
    page = Page(source)
    drops: dict[int, bool] = {}
    best = total = 0.0
    start, region, dropped, article = 0, (0, 0), 0, 0
    keep = [False] * len(page.tokens)
    for at, token in enumerate(page.tokens):
        if token[0] == "text":
            if dropped:
                continue
            keep[at] = True
            total += WORD_SCORE * len(token[1].split())
        else:
            _, element, closing = token
            section = page.names[element] in SECTIONS and page.closed[element]
            if closing:
                article -= section
                dropped -= drops[element]
            else:
                drops[element] = weights.drops(page, element, article > 0)
            if not dropped and not drops[element]:
                total -= weights.cost(page.kinds[element])
            if not closing:
                article += section
                dropped += drops[element]
        if total <= 0:
            total, start = 0.0, at + 1
        elif total > best:
            best, region = total, (start, at + 1)
    blocks: list[list[str]] = [[]]
    for at in range(*region):
        token = page.tokens[at]
        if token[0] == "text":
            if keep[at]:
                blocks[-1].append(token[1])
        elif page.names[token[1]] == "br" or page.names[token[1]] == "img":
            blocks[-1].append(" ")
        elif page.names[token[1]] not in INLINE and blocks[-1]:
            blocks.append([])
    lines = (" ".join(html.unescape("".join(block)).split()) for block in blocks)
    return "\n".join(line for line in lines if line)


def fit(pages: list[str]) -> Weights:
    """Weights from the fixed labelled pages and those of ``pages`` that mark an article."""
    marked = [p for p in map(Page, pages) if any(n in SECTIONS and c for n, c in zip(p.names, p.closed))]
    return Weights([*map(Page, LABELLED), *marked])


def extract_pages(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> DataFrame:
    """Main text of every row of ``pages`` (page_id, url, html).

    Returns page_id, url, text ("" if none) and n_chars (code points). The weights
    are fitted on the fixed pages and a sample of at most ``sample_pages`` rows.

    A null or empty html gives "". Unclosed tags, stray end tags and pages cut off
    anywhere are read as far as they go; an element that is never closed is not left
    out. A page of any length is read whole, in one piece. Repeated rows and null ids are kept. Other columns are not read.
    """
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    drawn = bounded_sample(rows.where("html is not null"), sample_pages, "page_id", "html")
    weights = fit([r["html"] for r in drawn.select("html").collect()])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            text = [extract(source or "", weights) for source in batch["html"]]
            yield batch[["page_id", "url"]].assign(text=text, n_chars=[len(t) for t in text])

    return rows.mapInPandas(run, rows.select("page_id", "url", F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema)
