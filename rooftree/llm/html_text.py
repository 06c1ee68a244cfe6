"""Main text of web pages, with the templates of their sites removed.

One pass over the markup gives the text blocks of the page; whole elements go by what they are (navigation, forms, adverts,
...).  What such rules cannot know is the site's own template: every container of text is hashed as a subtree, inside a
marked article as well, Spark counts the pages of a host that have it, and blocks inside subtrees that recur on many pages
of the host are deleted.  Of what is left, a page that marks its article is read inside that mark: an article first, then a
main part, then the whole page.  Pages are parsed twice, for hashes and for texts, so that no text is written in between; only
block texts and hashes are shuffled, texts only if the list of templates by page is too large for a broadcast.
"""
from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rooftree.llm.common import staged
from rooftree.llm.url_filter import split_url

LEAST_PAGES = 5

# Which elements are no main text, by name or by a word of their class, id or role.
DROPPED = set("head script style noscript template nav aside form footer menu button select textarea iframe object svg canvas dialog audio "
              "video map".split())
DROPPED_WORDS = set("ad ads advert advertisement adverts sponsor sponsored promo banner sidebar side menu nav navbar navigation footer "
                    "masthead cookie cookies consent notice alert comments comment respond reply replies disqus share sharing social "
                    "related recommended newsletter subscribe signup login popup modal breadcrumb breadcrumbs widget pagination pager "
                    "toolbar search".split())
SITE_HEADERS = {"header"}  # dropped outside an article
RAW = set("script style textarea title iframe noscript xmp".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 "
             "h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split())
CONTAINERS = set("div section ul ol dl table header footer nav aside form figure fieldset menu details".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ENDS_P = BLOCKS - {"title", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "html", "body"}

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>""", re.S)
_NAMES = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z0-9]+")
_MAIN_ROLE = re.compile(r"role\s*=\s*[\"']?main\b", re.I)
ARTICLE, MAIN, PAGE = 1, 2, 4  # views of a page: inside an article, inside a main part, all of it


def _unwanted(name: str, attributes: str, in_main: bool) -> bool:
    if name in DROPPED or (name in SITE_HEADERS and not in_main):
        return True
    if not attributes or name in ("body", "html"):
        return False
    for m in _NAMES.finditer(attributes):
        if DROPPED_WORDS.intersection(_WORD.findall((m[1] or m[2] or m[3] or "").lower())):
            return True
    return False


def _marks(name: str, attributes: str) -> int:
    if name == "article":
        return ARTICLE
    return MAIN if name == "main" or (attributes and _MAIN_ROLE.search(attributes)) else 0


def blocks_of(page: str) -> list[tuple[str, int, list[int]]]:
    """[(text, views that show it, hashes of the containers around it)]; an article may be a main part, too."""
    out: list[tuple[str, int, list[int]]] = []  # with places of containers in the plain markup
    spans: dict[int, tuple[int, int]] = {}
    plain, length = [], 0  # the markup without attributes and comments, which is what is hashed
    stack: list[tuple[str, int, int, tuple[int, int]]] = []  # name, place, views that drop it, open marks before
    text: list[tuple[str, int]] = []
    dropped = {ARTICLE: 0, MAIN: 0, PAGE: 0}
    marked = (0, 0)
    shown = PAGE
    at, size = 0, len(page)

    def put(piece: str) -> None:
        nonlocal length
        plain.append(piece)
        length += len(piece)

    def look() -> None:
        nonlocal shown
        shown = ((ARTICLE if marked[0] and not dropped[ARTICLE] else 0) | (MAIN if marked[1] and not dropped[MAIN] else 0)
                 | (PAGE if not dropped[PAGE] else 0))

    def flush() -> None:
        if not text:
            return
        bodies: dict[str, int] = {}
        if len({views for _, views in text}) == 1:
            bodies[" ".join("".join(t for t, _ in text).split())] = text[0][1]
        else:
            for view in (ARTICLE, MAIN, PAGE):
                body = " ".join("".join(t for t, views in text if views & view).split())
                bodies[body] = bodies.get(body, 0) | view
        text.clear()
        places = [s[1] for s in stack if s[0] in CONTAINERS]
        out.extend((body, views, places) for body, views in bodies.items() if body)

    def close(index: int) -> None:
        nonlocal marked
        while len(stack) > index:
            name, place, gone, marked = stack.pop()
            for view in dropped:
                dropped[view] -= bool(gone & view)
            if name in CONTAINERS:
                spans[place] = place, length
        look()

    while at < size:
        m = _TOKEN.search(page, at)
        stop = m.start() if m else size
        if stop > at:
            piece = page[at:stop]
            put(piece)
            if shown:
                text.append((html.unescape(piece) if "&" in piece else piece, shown))
        if m is None:
            break
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        attributes = (m[3] if m[2] else m[6]) or ""
        if m[1] or m[4]:  # an end tag
            put(f"</{name}>")
            if name in BLOCKS:
                flush()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    close(i)
                    break
            continue
        if name in VOID:
            put(f"<{name}>")
            if (name == "br" or name == "hr") and shown:
                text.append((" ", shown))
                if name == "hr":
                    flush()
            continue
        if name in RAW:
            tail = re.compile(rf"</{name}\b[^>]*>?", re.I).search(page, at)
            put(f"<{name}>" + page[at:tail.start() if tail else size])
            at = tail.end() if tail else size
            continue
        if name in BLOCKS:
            flush()
            ends = CLOSES.get(name, set()) | ({"p"} if name in ENDS_P else set())
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in ends:
                    close(i)
                    break
                if stack[i][0] in CONTAINERS or stack[i][0] in ("article", "main", "body"):
                    break
        if attributes.endswith("/") and name not in BLOCKS:
            put(f"<{name}>")
            continue
        gone = 0
        if _unwanted(name, attributes, True):
            gone = ARTICLE | MAIN | PAGE
        elif name in SITE_HEADERS:
            gone = (0 if marked[0] else ARTICLE) | (0 if marked[1] else MAIN) | PAGE
        stack.append((name, length, gone, marked))
        put(f"<{name}>")
        for view in dropped:
            dropped[view] += bool(gone & view)
        mark = _marks(name, attributes)
        if mark:
            marked = (marked[0] + (mark == ARTICLE and not dropped[ARTICLE]),
                      marked[1] + (not dropped[MAIN] and (mark == MAIN or bool(_MAIN_ROLE.search(attributes)))))
        if gone or mark:
            look()
    flush()
    close(0)
    whole = "".join(plain)
    hashes: dict[int, int] = {}
    for _, _, places in out:
        for p in places:
            if p not in hashes:
                hashes[p] = xxhash.xxh3_64_intdigest(whole[slice(*spans[p])].encode("utf-8", "replace")) - (1 << 63)
    return [(body, views, [hashes[p] for p in places]) for body, views, places in out]


_SEEN = pa.schema([("row", pa.int64()), ("host", pa.string()), ("whole", pa.int64()), ("seen", pa.list_(pa.int64()))])
_SEEN_DDL = "row long, host string, whole long, seen array<long>"
_PAGE = pa.schema([("row", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()),
                   ("blocks", pa.list_(pa.struct([("text", pa.string()), ("views", pa.int8()), ("up", pa.list_(pa.int64()))])))])
_PAGE_DDL = "row long, page_id long, url string, blocks array<struct<text: string, views: byte, up: array<long>>>"


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[list[tuple[str, int, list[int]]]]]]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 500):
            part = batch.slice(lo, 500)
            yield part, [blocks_of(h or "") for h in part.column("html").to_pylist()]


def _containers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, parsed in _parsed(batches):
        yield pa.RecordBatch.from_arrays(
            [part.column("row"), part.column("host"),
             pa.array([xxhash.xxh3_64_intdigest("\n".join(t for t, _, _ in p)) - (1 << 63) for p in parsed], pa.int64()),
             pa.array([sorted({u for _, _, up in p for u in up}) for p in parsed], _SEEN.field("seen").type)], schema=_SEEN)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, parsed in _parsed(batches):
        yield pa.RecordBatch.from_arrays(
            [part.column("row"), part.column("page_id"), part.column("url"),
             pa.array([[{"text": t, "views": v, "up": u} for t, v, u in p] for p in parsed], _PAGE.field("blocks").type)], schema=_PAGE)


def extract(pages: DataFrame, least_pages: int = LEAST_PAGES) -> DataFrame:
    """page_id, url, text and n_chars of every page.

    A subtree is a template if at least ``least_pages`` pages of its host have it, however many pages the host has; pages with
    the same text count as one, so a page is no template of its own copies.  Null or empty markup gives an empty text; a page
    without host is on the host ''; repeated rows stay; null ids and urls are kept; an empty table gives an empty result; other
    columns are ignored.
    """
    rows = split_url(pages.select("page_id", "url", "html")).select(F.xxhash64("page_id", "url", "html").alias("row"), "page_id", "url", "host", "html")
    parsed = staged(rows.select("row", "host", "html").mapInArrow(_containers, _SEEN_DDL))
    templates = (parsed.select("host", "whole", F.explode("seen").alias("subtree")).distinct()
                 .groupBy("host", "subtree").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_pages).select("host", "subtree"))
    hits = staged(parsed.select("row", "host", F.explode("seen").alias("subtree")).join(templates, ["host", "subtree"], "left_semi")
                  .groupBy("row").agg(F.collect_set("subtree").alias("gone")))  # bounded by the page's own subtrees
    cleaned = rows.select("row", "page_id", "url", "html").mapInArrow(_blocks, _PAGE_DDL).join(hits, "row", "left").withColumn("gone", F.coalesce("gone", F.array().cast("array<long>")))
    cleaned = cleaned.withColumn("blocks", F.filter("blocks", lambda b: ~F.arrays_overlap(b["up"], F.col("gone"))))
    shows = lambda view: F.exists("blocks", lambda b: b["views"].bitwiseAND(F.lit(view)) > 0)
    view = F.when(shows(ARTICLE), ARTICLE).when(shows(MAIN), MAIN).otherwise(PAGE)
    both = cleaned.withColumn("view", view).withColumn("blocks", F.filter("blocks", lambda b: b["views"].bitwiseAND(F.col("view")) > 0))
    text = F.array_join("blocks.text", "\n\n")
    return both.select("page_id", "url", text.alias("text"), F.length(text).cast("long").alias("n_chars"))
