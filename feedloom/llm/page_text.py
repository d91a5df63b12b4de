"""Main text of web pages by differencing pages with nearest URLs.

A page is cut into lines, one per block element, in page order. Pages are sorted by host and URL path,
and each is compared with the neighbour in that order whose path shares the longer start with its own
(the earlier one on a tie). The two lists of lines are aligned by a longest common subsequence, and
lines that both pages have are template, not text: they are deleted. Protected lines, as said below,
cannot be deleted and are left out of the comparison.

Differencing alone can't give exact articles. It keeps what a template fills in anew on every page, it
has nothing to compare where a host has one page, and it would delete sentences that two articles of a
host really share. So elements that say what they are settle their lines: those inside ``article`` are protected from
deletion; navigation, headers, footers, asides, forms, notices, adverts and comments, by element, role
or class word, go in any case; and where a page has an article, lines outside of it go too, except the
``h1`` of the ``main`` around it. ``main`` without an article only says where the text is: lines outside
of it go, and differencing decides on those inside. On pages without either it decides on all lines.
Class words of wrappers ("has-sidebar") do not reach into the article or main they hold, unless they mean
comments, and where nothing but furniture by class word is left, differencing decides on that.

Neighbours are found in range blocks of the sorted paths, with the ends of each block handed to the
next, so no host is gathered in one task. Only hashes of lines are sorted; texts move once.

Defined results: a null or empty html has the empty text; a null url is compared with nothing; pages
with the same host and path count as one page when neighbours are sought; a page of which every line
would be deleted as shared is a copy of its neighbour and keeps its lines; repeated rows are extracted
alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedloom.llm.common import ordered_blocks

OPEN, ARTICLE, FURNITURE = 0, 1, 2  # what is known of a line: nothing, text of an article, none of it
MAIN, HEADLINE = 3, 4  # a line of main outside of articles, and its h1
NAMED = 5  # furniture by a class word alone, which an article or main inside takes back

# Elements by what they mean.
HIDDEN = "script style noscript template iframe object svg math canvas textarea title select audio video"
FURNITURE_TAGS = set("nav header footer aside form dialog menu head button".split())
ARTICLE_TAGS = {"article": ARTICLE, "main": MAIN}
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
BLOCKS = set(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section "
    "summary table tbody td tfoot th thead tr ul".split()
)
TRACKED = FURNITURE_TAGS | set(ARTICLE_TAGS) | set("div section ul ol dl table p span figure details body html".split()) | HEADINGS
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
FURNITURE_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
FURNITURE_WORDS = set(
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside notice notices banner cookie "
    "cookies consent gdpr ad ads advert adverts advertisement sponsor sponsored promo promotion comment comments disqus "
    "reply replies respond share sharing social related newsletter subscribe signup popup modal overlay login search widget "
    "toolbar pagination pager alert".split()
)
COMMENT_WORDS = set("comment comments disqus reply replies".split())
STATE_WORDS = set("open opened closed enabled disabled allowed on off no has with without count".split())  # of a page

_HIDDEN_NAMES = "|".join(HIDDEN.split())
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?:svg|math)\b[^>]*+(?<=/)>|<({_HIDDEN_NAMES})\b[^>]*+>.*?(?:</\1\b[^>]*>|\Z)"
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)[^>]*+>|<[/!?a-zA-Z][^>]*+(?:>|\Z)""",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
_WORDS = re.compile(r"[^a-z0-9]+")


def meaning(tag: str, attributes: str) -> int:
    """What an element says about its lines."""
    known = FURNITURE if tag in FURNITURE_TAGS else ARTICLE_TAGS.get(tag, OPEN)
    gone = named = comments = False
    for name, *values in _ATTRIBUTE.findall(attributes) if attributes else ():
        name, value = name.lower(), next((v for v in values if v), "").lower()
        if name == "role":
            known = FURNITURE if value in FURNITURE_ROLES else ARTICLE_TAGS.get(value, known)
        elif name == "hidden" or name == "aria-hidden" and value == "true":
            gone = True
        elif name == "style" and "display:none" in value.replace(" ", ""):
            gone = True
        elif name in ("class", "id") and tag not in ("body", "html"):
            for words in map(set, map(_WORDS.split, value.split())):
                named = named or bool(words & FURNITURE_WORDS)
                comments = comments or bool(words & COMMENT_WORDS) and not words & STATE_WORDS
    if gone or comments and known != MAIN:
        return FURNITURE
    return NAMED if named and known == OPEN else known


def within(stack: list[tuple[str, int]], own: int) -> int:
    """What holds inside an element, by what it says itself and the elements around it."""
    above = stack[-1][1] if stack else OPEN
    if FURNITURE in (above, own):
        return FURNITURE
    if above == NAMED and own in (ARTICLE, MAIN):
        # A wrapper of the page's article, and not a box with others inside it.
        return NAMED if any(s == ARTICLE for _, s in stack) else own
    if NAMED in (above, own):
        return NAMED
    return ARTICLE if ARTICLE in (above, own) else own or above


def lines_of(html: str | None) -> list[tuple[str, int]]:
    """Lines of a page in order, with what their elements say about them in three words: the lines of
    main count as those of an article, and class words like other furniture."""
    coarse = {MAIN: ARTICLE, HEADLINE: ARTICLE, NAMED: FURNITURE}
    return [(t, coarse.get(s, s)) for t, s in marked_lines(html)]


def marked_lines(html: str | None) -> list[tuple[str, int]]:
    """Lines of a page in order, with all that their elements say about them."""
    out: list[tuple[str, int]] = []
    text: list[str] = []
    stack: list[tuple[str, int]] = []  # tracked open elements with what holds inside them

    def flush() -> None:
        if text:
            line = " ".join(unescape("".join(text)).split())
            text.clear()
            if line:
                state = stack[-1][1] if stack else OPEN
                if state in (FURNITURE, NAMED):
                    state = heading_of(stack)
                if state == MAIN and any(name == "h1" for name, _ in stack):
                    state = HEADLINE
                out.append((line, state))

    at, source = 0, html or ""
    for m in _TOKEN.finditer(source):
        if m.start() > at:
            text.append(source[at : m.start()])
        at = m.end()
        tag, attributes = (m[3] or m[6] or "").lower(), m[4] or ""
        if not tag:
            continue
        if tag in BLOCKS:
            flush()
        if m[2] or m[5]:
            if any(name == tag for name, _ in stack):
                while stack.pop()[0] != tag:
                    pass
        elif tag in TRACKED and tag not in VOID and not attributes.endswith("/"):
            if tag == "body":
                stack = [s for s in stack if s[0] != "head"]
            if tag in ("p", *HEADINGS) and stack and stack[-1][0] in ("p", "span"):
                stack.pop()  # a paragraph ends where the next one begins
            stack.append((tag, within(stack, meaning(tag, attributes))))
    if at < len(source):
        text.append(source[at:])
    flush()
    return out


def heading_of(stack: list[tuple[str, int]]) -> int:
    """What a line of furniture is after all: a heading in the header of an article is its title."""
    names = [name for name, _ in stack]
    if names[-1] not in HEADINGS or "header" not in names:
        return stack[-1][1]
    at = names.index("header")
    title = at > 0 and stack[at - 1][1] in (ARTICLE, MAIN) and all(n in ("header", *HEADINGS, "div") for n in names[at:])
    return stack[at - 1][1] if title else stack[-1][1]


def site_of(url: str | None) -> tuple[str | None, str | None]:
    """Host and path of a URL; the path includes the query, the fragment does not count."""
    if url is None:
        return None, None
    rest = url.split("#", 1)[0].split("://", 1)[-1]
    host, _, path = rest.partition("/")
    return host.lower(), "/" + path


def common_lines(one: np.ndarray, two: np.ndarray) -> list[int]:
    """Places in ``one`` of a longest common subsequence with ``two``.

    Equal lines are chained by their places in ``two``, which must rise; the last element of the best
    chain of each length is kept sorted, so the cost follows the number of equal pairs.
    """
    where: dict[int, list[int]] = {}
    for j, line in enumerate(two.tolist()):
        where.setdefault(line, []).append(j)
    ends: list[int] = []
    chains: list[tuple[int, tuple | None]] = []
    for i, line in enumerate(one.tolist()):
        for j in reversed(where.get(line, ())):
            k = bisect_left(ends, j)
            chain = (i, chains[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                chains.append(chain)
            else:
                ends[k], chains[k] = j, chain
    found, chain = [], chains[-1] if chains else None
    while chain:
        found.append(chain[0])
        chain = chain[1]
    return found[::-1]


def nearer(path: str, before: str | None, after: str | None) -> int:
    """-1 or 1 for the neighbour whose path shares the longer start, 0 without a neighbour."""

    def start(other: str | None) -> int:
        if other is None:
            return -1
        n = next((i for i, (a, b) in enumerate(zip(path, other, strict=False)) if a != b), min(len(path), len(other)))
        return n

    left, right = start(before), start(after)
    return 0 if left < 0 and right < 0 else -1 if left >= right else 1


# ``places``: where the lines stand among those that are compared; null for the protected ones of an article.
PARSED = "page_id long, url string, host string, path string, lines array<string>, places array<int>"
HASHED = "page_id long, host string, path string, hashes array<long>"


def candidates(lines: list[tuple[str, int]]) -> tuple[list[str], list[int | None]]:
    """Lines that may be text, with their places among the lines that are compared: those of the
    article, or else of main, or else the undecided ones, or else what class words alone call furniture."""
    states = {s for _, s in lines}
    may = {ARTICLE, HEADLINE} if ARTICLE in states else {MAIN, HEADLINE} if states & {MAIN, HEADLINE} else {OPEN} & states or {NAMED}
    texts, places, compared = [], [], 0
    for t, s in lines:
        if s in may:
            texts.append(t)
            places.append(None if s == ARTICLE else compared)
        compared += s != ARTICLE
    return texts, places


def _parse(hashed: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                urls = part.column(1).to_pylist()
                sites = [site_of(u) for u in urls]
                pages = [marked_lines(h) for h in part.column(2).to_pylist()]
                host, path = pa.array([s[0] for s in sites], pa.string()), pa.array([s[1] for s in sites], pa.string())
                if hashed:
                    codes = [
                        np.array([xxhash.xxh3_64_intdigest(t) for t, s in p if s != ARTICLE], dtype=np.uint64).view(np.int64)
                        for p in pages
                    ]
                    arrays = [part.column(0), host, path, pa.array(codes, pa.list_(pa.int64()))]
                    yield pa.RecordBatch.from_arrays(arrays, names=["page_id", "host", "path", "hashes"])
                else:
                    chosen = [candidates(p) for p in pages]
                    lines = pa.array([c[0] for c in chosen], pa.list_(pa.string()))
                    places = pa.array([c[1] for c in chosen], pa.list_(pa.int32()))
                    names = ["page_id", "url", "host", "path", "lines", "places"]
                    yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), host, path, lines, places], names=names)

    return run


def _difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        host, path, hashes, before, after = (batch.column(i).to_pylist() for i in range(5))
        shared = []
        for h, p, own, one, two in zip(host, path, hashes, before, after, strict=True):
            sides = [s if s and s["host"] == h else None for s in (one, two)]
            side = nearer(p, *[s and s["path"] for s in sides])
            other = sides[0] if side < 0 else sides[1] if side > 0 else None
            shared.append(common_lines(np.array(own, dtype=np.int64), np.array(other["hashes"], dtype=np.int64)) if other else [])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(shared, pa.list_(pa.int32()))], names=["host", "path", "shared"]
        )


def shared_lines(pages: DataFrame, label: str) -> DataFrame:
    """``host, path, shared``: per page the places of the lines it has in common with its neighbour."""
    hashed = pages.mapInArrow(_parse(True), HASHED).where("host IS NOT NULL")
    one = hashed.groupBy("host", "path").agg(F.min(F.struct("page_id", "hashes")).alias("p"))
    sites = one.select("host", "path", F.col("p.hashes").alias("hashes"))
    blocks = ordered_blocks(sites, ["host", "path"], f"{label}-sites").withColumn("me", F.struct("host", "path", "hashes"))
    # The last page of a block and the first of the next are neighbours too.
    ends = blocks.groupBy("_block").agg(F.min("me").alias("first"), F.max("me").alias("last"))
    by_block = W.orderBy("_block")
    ends = ends.select("_block", F.lag("last").over(by_block).alias("earlier"), F.lead("first").over(by_block).alias("later"))
    order = W.partitionBy("_block").orderBy("host", "path")
    beside = blocks.withColumns({"before": F.lag("me").over(order), "after": F.lead("me").over(order)}).join(ends, "_block")
    compared = beside.select(
        "host", "path", "hashes", F.coalesce("before", "earlier").alias("before"), F.coalesce("after", "later").alias("after")
    )
    return compared.mapInArrow(_difference, "host string, path string, shared array<int>")


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", label: str = "pages") -> DataFrame:
    """``page_id, url, text, lines, n_shared``: the main text, the lines it is made of, and how many of
    the lines that are not protected its neighbour has too."""
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html")
    )
    parsed = rows.mapInArrow(_parse(False), PARSED)
    known = parsed.join(shared_lines(rows, label), ["host", "path"], "left")
    shared = F.coalesce("shared", F.array().cast("array<int>"))
    own = F.filter("lines", lambda x, i: F.coalesce(~F.array_contains(F.col("shared"), F.col("places")[i]), F.lit(True)))
    text = F.when(F.size(own) == 0, F.col("lines")).otherwise(own)
    chosen = known.withColumn("shared", shared).select("page_id", "url", text.alias("lines"), F.size("shared").alias("n_shared"))
    return chosen.select("page_id", "url", F.array_join("lines", " ").alias("text"), "lines", "n_shared")
