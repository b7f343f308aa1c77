"""Landed result pages: one pass over the markup gives blocks, headings, visible text and links, from which results, outcomes and the pages that a run takes are derived."""

from __future__ import annotations

import re
from html.parser import HTMLParser

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfind.functions.urls import unwrap
from wayfind.operators import results
from wayfind.sources.scratch import materialise

# Where a result page keeps its blocks, snippets, next link and challenges.
BLOCK_CLASS, BLOCK_ATTRIBUTES, AD_ATTRIBUTE = "tF2Cxc", {"data-hveid", "data-ved"}, "data-text-ad"
SNIPPET_PARENT, SNIPPET_CLASS = ("data-sncf", "1"), "VwiC3b"
NEXT_ID, NEXT_LABELS = "pnnext", {"Next", "Tiếp"}
CHALLENGE_ATTRIBUTE, CHALLENGE_FORM, CHALLENGE_FRAME = "data-sitekey", "captcha-form", "recaptcha"
#: Elements without an end tag; elements whose text isn't shown; elements inside a line.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
UNSEEN = {"head", "title", "script", "style", "noscript", "template"}
INLINE = {"a", "abbr", "b", "bdi", "cite", "code", "em", "font", "i", "kbd", "mark", "s", "small", "span", "strong", "sub", "sup", "u", "wbr"}

SPACES = re.compile(r"\s+")
PARSED = "h3 int, has_next boolean, challenge boolean, body string, blocks array<struct<title string, href string, snippet string>>"


class _Element:
    __slots__ = ("a", "block", "hidden", "number", "start", "tag")

    def __init__(self, tag, a, number, start, hidden):
        self.tag, self.a, self.number, self.start, self.hidden, self.block = tag, a, number, start, hidden, None


class _Block:
    """A result block: what its first heading, its links and its snippets say."""

    def __init__(self, main, ad, depth):
        self.main, self.ad, self.depth, self.nested = main, ad, depth, False
        self.heading = self.title = self.link = None  # the first h3, what it says, the link around it
        self.other: _Element | None = None  # the first link around any h3
        self.snippets: list[_Element | None] = [None, None]
        self.said = ["", ""]

    def row(self):
        link = self.link or self.other
        return self.title, link.a.get("href") if link else None, self.said[0] or self.said[1]


class _Page(HTMLParser):
    """One pass over a page. Text is kept once, and an element's text is what was added while it was open."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[_Element] = []
        self.inside: list[_Element] = []  # of the open ones, those that are blocks
        self.blocks: list[_Block] = []
        self.text: list[str] = []
        self.count = self.h3 = 0
        self.has_next = self.challenge = False

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        self.count += 1
        hidden = bool(self.open and self.open[-1].hidden) or tag in UNSEEN or "hidden" in a or "display:none" in (a.get("style") or "").replace(" ", "").lower()
        if tag not in INLINE:
            self.text.append("\n")
        node = _Element(tag, a, self.count, len(self.text), hidden)
        classes = (a.get("class") or "").split()
        self.has_next |= a.get("id") == NEXT_ID or (tag == "a" and a.get("aria-label") in NEXT_LABELS)
        self.challenge |= (tag == "div" and CHALLENGE_ATTRIBUTE in a) or (tag == "form" and a.get("id") == CHALLENGE_FORM) or (tag == "iframe" and CHALLENGE_FRAME in (a.get("src") or ""))
        for outer in self.inside:
            outer.block.ad |= AD_ATTRIBUTE in a
        main = tag == "div" and BLOCK_CLASS in classes
        if main or (tag == "div" and BLOCK_ATTRIBUTES <= a.keys()):
            for outer in self.inside:
                outer.block.nested |= main
            node.block = _Block(main, AD_ATTRIBUTE in a, len(self.open))
            self.blocks.append(node.block)
        if tag == "h3":
            self.h3 += 1
            self._heading(node)
        elif tag == "div" and self.inside:
            self._snippet(node, SNIPPET_CLASS in classes)
        if tag not in VOID:
            self.open.append(node)
            if node.block:
                self.inside.append(node)

    def _heading(self, node):
        links = [x for x in self.open if x.tag == "a"]
        for outer in self.inside:
            block = outer.block
            own = next((x for x in links if x.number > outer.number), None)
            if own and (block.other is None or own.number < block.other.number):
                block.other = own
            if block.heading is None:
                block.heading, block.link = node, links[-1] if links else None

    def _snippet(self, node, marked):
        for outer in self.inside:
            block = outer.block
            if block.snippets[0] is None and any(x.a.get(SNIPPET_PARENT[0]) == SNIPPET_PARENT[1] and x.tag == "div" for x in self.open[block.depth + 1 :]):
                block.snippets[0] = node
            if block.snippets[1] is None and marked:
                block.snippets[1] = node

    def handle_data(self, data):
        if not (self.open and self.open[-1].hidden):
            self.text.append(SPACES.sub(" ", data))  # only elements make lines

    def handle_endtag(self, tag):
        at = next((k for k in range(len(self.open) - 1, -1, -1) if self.open[k].tag == tag), None)
        if at is not None:
            self._close(at)
        if tag not in INLINE:
            self.text.append("\n")

    def _close(self, at):
        """Close all elements from a place in the stack on."""
        for node in reversed(self.open[at:]):
            for outer in self.inside:
                block = outer.block
                if block.heading is node:
                    block.title = self._said(node)
                block.said = [self._said(node) if x is node else said for x, said in zip(block.snippets, block.said, strict=True)]
            if node.block:
                self.inside.pop()
        del self.open[at:]

    def _said(self, node):
        return " ".join("".join(self.text[node.start :]).split())

    def row(self):
        self.close()
        self._close(0)
        usual = [b for b in self.blocks if b.main and not b.nested]
        kept = [b.row() for b in usual or self.blocks if not b.ad and b.title]
        lines = (" ".join(x.split()) for x in "".join(self.text).split("\n"))
        return self.h3, self.has_next, self.challenge, "\n".join(x for x in lines if x), kept


def _parsed(html: str | None) -> tuple:
    parser = _Page()
    parser.feed(html or "")
    return parser.row()


def parsed_pages(pages: DataFrame) -> DataFrame:
    """pages(html, ...) with `page`: the number of h3, whether there is a next link and a challenge, the visible text, and title, href and snippet of each result block that is no advertisement, has a heading and stands in no other one. A null page is an empty one.

    Pages go to Python a hundred at a time, not in Arrow's batches of 10,000 rows, all of which, and what they say, a worker would hold at once.
    """
    return pages.withColumn("page_parts", F.udf(_parsed, PARSED, useArrow=False)("html")).select(*(c for c in pages.columns if c != "html"), "page_parts.*")


def result_blocks(pages: DataFrame) -> DataFrame:
    """page_id, pos, title, url, snippet of pages(page_id, html): links unwrapped, each URL once per page. Only the parse runs in Python."""
    rows = parsed_pages(pages.select("page_id", "html")).select("page_id", F.posexplode("blocks").alias("pos", "b")).select("page_id", "pos", "b.*")
    rows = rows.withColumn("url", unwrap(F.col("href"))).filter("url is not null").withColumn("__key", F.struct("page_id", "url"))
    return results.first_wins(rows, "__key", ["pos"]).select("page_id", "pos", "title", "url", "snippet")


def landed(pages: DataFrame) -> DataFrame:
    """query_id, page, outcome, extracted, fresh, has_next, error, taken of pages(query_id, page, url, html), one row per page.

    extracted counts a page's different result URLs, fresh those that no page before of the query had.
    outcome is results.page_outcome(). A run reads pages in order until one ends it: one with a
    challenge or drifting layout, whose kind (captcha, parse) is then the error of the query, and none
    of its pages is taken; one that has nothing fresh; or the last one, without a next link or with
    fewer than a full page of results. Pages after that one aren't taken.
    """
    parts = parsed_pages(pages.select("query_id", "page", "url", "html"))
    marks = results.page_marks(F.col("url"), F.col("body"), F.col("challenge"))
    found = F.array_distinct(F.filter(F.transform("blocks", lambda b: unwrap(b["href"])), lambda u: u.isNotNull()))
    rows = parts.select("query_id", "page", "h3", "has_next", marks.alias("mark"), found.alias("urls")).withColumn("extracted", F.size("urls"))
    each = rows.select("query_id", "page", "h3", "has_next", "mark", "extracted", F.explode_outer("urls").alias("link"))
    first = F.min("page").over(Window.partitionBy("query_id", "link"))  # the pages of one query that have one link
    counted = each.withColumn("new", F.col("link").isNotNull() & (first == F.col("page"))).groupBy("query_id", "page", "h3", "has_next", "mark", "extracted").agg(F.count_if("new").cast("int").alias("fresh"))
    counted, _ = materialise(counted.withColumn("outcome", results.page_outcome(F.col("mark"), F.col("page"), F.col("h3"), F.col("fresh"))), "landed")  # else every page is parsed once more for the limits of its query
    return results.pages_read(counted).select("query_id", "page", "outcome", "extracted", "fresh", "has_next", "error", "taken")
