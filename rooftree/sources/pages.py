"""Raw pages: scan, flat fields by a rules table, links, and nested blocks.

Only nested markup needs a parser; it runs over Arrow batches that hold the key and the page, and its small
result is all that later stages see.  Page text itself is never shuffled.
"""
from __future__ import annotations

import re
from html import unescape as decoded
from html.parser import HTMLParser
from typing import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rooftree import defaults as D
from rooftree.functions.facts import detect_by_tokens, extract_street
from rooftree.functions.text import as_col, clean_text, has, rx, some, unescape


def scan_raw(df: DataFrame, min_len: int = 500, html: str = "html") -> DataFrame:
    """Pages usable for extraction: long enough, and parsed with HTTP 200 where those columns exist."""
    out = df.where(F.length(html) >= min_len)
    if "http_status" in df.columns:
        out = out.where(F.col("http_status") == 200)
    return out.where(F.col("parse_status") == "parsed") if "parse_status" in df.columns else out


_ATTR = r"""[^>]*?\b{attr}\s*=\s*["']{value}["'][^>]*?\bcontent\s*=\s*["']([^"']*)["']"""
FLAT_RULES = {  # field -> (pattern, group); first match of the page
    "title": (r"<title[^>]*>(.*?)</title>", 1),
    "h1": (r"<h1[^>]*>(.*?)</h1>", 1),
    "meta_description": (r"<meta\b" + _ATTR.format(attr="name", value="description"), 1),
    "og_title": (r"<meta\b" + _ATTR.format(attr="property", value="og:title"), 1),
    "og_image": (r"<meta\b" + _ATTR.format(attr="property", value="og:image"), 1),
    "og_description": (r"<meta\b" + _ATTR.format(attr="property", value="og:description"), 1),
}
PRODUCT_SCHEMA = ("`@type` string, name string, description string, offers struct<price: string>, image array<string>")


def page_text(c) -> Column:
    """Inner text of a matched fragment."""
    return clean_text(unescape(F.regexp_replace(as_col(c), "<[^>]+>", "")))


def extract_page_fields(pages: DataFrame, rules: dict | None = None, html: str = "html", keep=("page_id", "url")) -> DataFrame:
    """Flat page fields by rule; each is NULL when its pattern does not occur."""
    rules = rules or FLAT_RULES
    picked = [page_text(rx(html, pattern, group, "(?isuU)")).alias(name) for name, (pattern, group) in rules.items()]
    out = pages.select(*keep, *picked)
    return out.withColumns({n: some(F.col(n)) for n in rules})


def product_json(html) -> Column:
    """First JSON-LD product of a page as a struct (NULL when there is none)."""
    blocks = F.regexp_extract_all(as_col(html), F.lit(r"(?isu)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"), 1)
    items = F.transform(blocks, lambda b: F.from_json(b, PRODUCT_SCHEMA))
    return F.try_element_at(F.filter(items, lambda i: i["@type"] == "Product"), F.lit(1))


def _without_dots(url: str) -> Column:
    """A url whose ``.`` and ``..`` path segments are resolved."""
    root, tail = F.regexp_extract(url, r"^(https?://[^/?#]+)", 1), F.regexp_extract(url, r"([?#].*)$", 1)
    parts = F.split(F.regexp_extract(url, r"^https?://[^/?#]+/?([^?#]*)", 1), "/")
    start = F.array().cast("array<string>")
    walked = F.aggregate(parts, start, lambda done, part: F.when(part == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
                         .when(part == ".", done).otherwise(F.concat(done, F.array(part))))
    return F.concat(root, F.lit("/"), F.array_join(walked, "/"), tail)


def extract_links(pages: DataFrame, pattern: str = r"<a\b[^>]*\bhref\s*=\s*[\"']([^\"']+)[\"']", base: Column | None = None,
                  scope: str | None = None, html: str = "html", key: str = "page_id", sites: list | None = None) -> DataFrame:
    """Distinct absolute links of each page, optionally only those that match ``scope``.

    With ``sites`` (marker, id pattern, prefix) each link has the ``external_id`` that its site's rule finds; links of other
    sites and links without an id are left out.

    Every relative form is resolved against the page's address (or ``base``); links to other schemes and to places in the
    page itself are left out.
    """
    links = F.array_distinct(F.regexp_extract_all(html, F.lit("(?iu)" + pattern), 1))
    address = base if base is not None else F.col("url")
    out = pages.select(key, F.explode(links).alias("href"), F.regexp_extract(address, r"^([^?#]*)", 1).alias("address"))
    out = out.withColumn("root", F.regexp_extract("address", r"^(https?://[^/]+)", 1)).where(~F.col("href").startswith("#"))
    folder = F.when(F.col("address") == F.col("root"), F.concat("root", F.lit("/"))).otherwise(F.regexp_extract("address", r"^(.*/)", 1))
    href = F.col("href")
    full = (F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), href).when(href.startswith("//"), F.concat(F.regexp_extract("root", "^(https?:)", 1), href))
            .when(href.startswith("/"), F.concat("root", href)).when(href.startswith("?"), F.concat("address", href)).otherwise(F.concat(folder, href)))
    out = out.withColumn("full", full)
    out = out.withColumn("href", F.when(F.col("full").rlike(r"/\.{1,2}(/|$|[?#])"), _without_dots("full")).otherwise(F.col("full")))
    out = out.where(F.col("href").startswith("http")).select(key, "href")
    out = (out if scope is None else out.where(has("href", scope, ""))).distinct()
    return out if sites is None else out.withColumn("external_id", link_id("href", sites)).where(F.col("external_id").isNotNull())


def link_id(href, sites=tuple(D.SITE_RULES)) -> Column:
    """Prefixed id of a listing's link by the rule of the first site whose marker is in it; NULL without one."""
    found = [F.when(F.lower(as_col(href)).contains(marker), F.concat(F.lit(prefix), some(F.regexp_extract(as_col(href), pattern, 1)))) for marker, pattern, prefix in sites]
    return F.coalesce(*found)


def ad_id(html) -> Column:
    return F.coalesce(*[rx(html, p, 1, "") for p in D.AD_ID_PATTERNS])


# ---- nested blocks ---------------------------------------------------------------------------

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_MATCH = {"=": lambda have, want: have == want, "*=": lambda have, want: want in have, "~=": lambda have, want: want in have.split()}


_TOKEN = re.compile(r"""([^<]+)|<([a-zA-Z][a-zA-Z0-9]*)((?:[ \t\n]+[a-zA-Z][a-zA-Z0-9_:.-]*="[^"<>&]*")*)[ \t\n]*>|</([a-zA-Z][a-zA-Z0-9]*)[ \t\n]*>""")
_PAIR = re.compile(r"""([a-zA-Z][a-zA-Z0-9_:.-]*)="([^"]*)\"""")
_RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript", "plaintext"}


def _rules_by_tag(wanted: dict) -> dict[str, list[tuple]]:
    """The rules that may fit each tag; those of "*" fit all of them."""
    rules = [(name, want, attribute, _MATCH[how], value, inner[0] if inner else None)
             for name, its in wanted.items() for want, attribute, how, value, *inner in its]
    return {tag: [r for r in rules if r[1] in (tag, "*")] for tag in {"*", *(r[1] for r in rules)}}


class _Blocks(HTMLParser):
    """Text and image sources of wanted blocks; nesting is followed, unclosed tags are tolerated.

    A rule is (tag, attribute, comparison, value[, inner tag]); with an inner tag its elements inside the match are the blocks.
    """

    def __init__(self, wanted, rules=None):
        super().__init__(convert_charrefs=True)
        self.rules, self.depth, self.open, self.around = rules or _rules_by_tag(wanted), 0, [], []
        self.text = {name: [] for name in wanted}
        self.images = {name: [] for name in wanted}
        self.page_images = []

    def handle_starttag(self, tag, attrs):
        attrs = dict(attrs)
        if tag == "img":
            src = attrs.get("data-src") or attrs.get("src") or ""
            self.page_images.append(src)
            for name, _, _ in self.open:
                self.images[name].append(src)
        if tag in _VOID:
            return
        self.depth += 1
        starts = {name for name, inner, _ in self.around if inner == tag}
        for name, _, attribute, fits, value, inner in self.rules.get(tag) or self.rules["*"]:
            if fits(attrs.get(attribute) or "", value):
                if inner:
                    self.around.append((name, inner, self.depth))
                else:
                    starts.add(name)
        self.open += [(name, self.depth, []) for name in starts]

    def handle_endtag(self, tag):
        if tag in _VOID:
            return
        for item in [o for o in self.open if o[1] >= self.depth]:
            self._take(item)
            self.open.remove(item)
        self.around = [x for x in self.around if x[2] < self.depth]
        self.depth = max(0, self.depth - 1)

    def _take(self, item):
        self.text[item[0]].append(" ".join("".join(item[2]).split()))

    def handle_data(self, data):
        for _, _, parts in self.open:
            parts.append(data)

    def read_plain(self, page: str) -> bool:
        """Read a page of tags, quoted attributes and text by one pattern; False where it has anything else, as comments."""
        at, raw = 0, None
        if "\0" in page:
            return False
        for m in _TOKEN.finditer(page):
            if m.start() != at:
                return False
            at = m.end()
            if m[1] is not None:
                if raw and "&" in m[1]:
                    return False
                if self.open:
                    self.handle_data(decoded(m[1]) if "&" in m[1] else m[1])
            elif m[2] is not None:
                tag = m[2].lower()
                if raw:
                    return False
                raw = tag if tag in _RAW else None
                self.handle_starttag(tag, [(k.lower(), v) for k, v in _PAIR.findall(m[3])] if m[3] else ())
            else:
                tag = m[4].lower()
                if raw and tag != raw:
                    return False
                raw = None
                self.handle_endtag(tag)
        return at == len(page) and raw is None

    def finish(self):
        self.close()
        for item in self.open:
            self._take(item)
        return self


def _read(page: str, wanted: dict, rules: dict) -> _Blocks:
    """A page read by pattern, or, where it is not plain, by the parser; both give the same."""
    blocks = _Blocks(wanted, rules)
    if not blocks.read_plain(page):
        blocks = _Blocks(wanted, rules)
        blocks.feed(page)
    return blocks.finish()


def extract_blocks(pages: DataFrame, blocks: dict, key: str = "page_id", html: str = "html", keep=()) -> DataFrame:
    """(key, kept columns, <block>: array<string> ..., images, page_images) per page, parsed in Arrow batches, in one pass.

    ``images`` are those of the block named photos, ``page_images`` all of the page.
    """
    names = [*blocks, "images", "page_images"]
    passed = pages.select(key, *keep, html)
    schema = T.StructType([*passed.schema.fields[:-1], *[T.StructField(n, T.ArrayType(T.StringType())) for n in names]])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = _rules_by_tag(blocks)
        for batch in batches:
            found = {n: [] for n in names}
            for page in batch.column(batch.num_columns - 1).to_pylist():
                p = _read(page or "", blocks, rules)
                for n in blocks:
                    found[n].append(p.text[n])
                found["images"].append(p.images.get("photos", []))
                found["page_images"].append(p.page_images)
            arrays = [pa.array(found[n], pa.list_(pa.string())) for n in names]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *arrays], names=schema.fieldNames())

    return passed.mapInArrow(parse, schema)


def _read_once(pages: DataFrame, blocks: dict, key: str, html: str, rules: dict) -> DataFrame:
    """Flat fields, the JSON-LD product and the blocks of every page from one reading of its markup."""
    flat = [some(page_text(rx(html, pattern, group, "(?isuU)"))).alias(name) for name, (pattern, group) in rules.items()]
    rows = pages.select(key, *flat, product_json(html).alias("ld"), html)
    return extract_blocks(rows, blocks, key, html, [*rules, "ld"])


def _first(name: str) -> Column:
    return some(F.try_element_at(F.col(name), F.lit(1)))


def _param(marker: str, pattern: str, group: int = 1, unless: str | None = None) -> Column:
    """Number of the first parameter line that carries a marker word."""
    hit = lambda v: has(v, marker) if unless is None else has(v, marker) & ~has(v, unless)
    return rx(F.try_element_at(F.filter("params", hit), F.lit(1)), pattern, group)


def board_fields(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Listing fields of a classified-board page: JSON-LD first, then meta tags, then labelled blocks."""
    j = _read_once(pages, D.BOARD_BLOCKS, key, html, FLAT_RULES)
    long_text = F.when(F.length(_first("description")) > F.length(F.coalesce("ld.description", "meta_description", F.lit(""))),
                       _first("description"))
    pair = r"(\d+)\s*/\s*(\d+)"
    level, height = r"поверх|этаж", r"поверховість|этажность"
    title = F.coalesce("ld.name", "og_title", "h1")
    place = F.concat_ws(" ", title, _first("location"))
    context = F.concat_ws(" ", place, F.coalesce(long_text, "ld.description", "meta_description"))
    photos = F.coalesce(F.when(F.size("ld.image") > 0, F.col("ld.image")), F.filter("images", lambda u: u.startswith("http")))
    return j.select(
        key, title.alias("title"), F.coalesce(long_text, "ld.description", "meta_description").alias("description"),
        F.coalesce("ld.offers.price", _first("price")).alias("price_raw"),
        _param(r"кімнат|комнат", r"(\d+)").alias("rooms"), _param(r"загальна площа|площа:|м²", r"([\d.,]+)").alias("area"),
        F.coalesce(_param(level, pair, 1, height), _param(level, r"(\d+)", 1, height)).alias("floor"),
        F.coalesce(_param(height, r"(\d+)"), _param(level, pair, 2, height)).alias("floors_total"),
        _first("location").alias("address"), detect_by_tokens(context, D.DISTRICT_TOKENS).alias("district"),
        extract_street(place).alias("street"),
        detect_by_tokens(context, [(s, [s.lower()]) for s in D.METRO_STATIONS]).alias("metro_station"),
        _first("seller").alias("contact_name"), photos.alias("photos"), F.col("og_image").alias("photo_url"))


def agency_fields(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Listing fields of an agency page from its labelled blocks, with preview-tag fallbacks."""
    j = _read_once(pages, D.AGENCY_BLOCKS, key, html, FLAT_RULES)
    region = F.split(_first("region"), ",")
    og = F.col("og_description")
    pos = F.lower(_first("position"))
    labels = _first("labels")
    fee = rx(labels, r"Комісія\s*([\d]+%?)")
    photos = F.array_distinct(F.filter("images", lambda u: u.startswith("http")))
    comma = lambda c: F.replace(c, F.lit(","), F.lit("."))
    return j.select(
        key, F.col("h1").alias("title"), _first("description").alias("description"),
        F.coalesce(_first("price"), F.trim(rx(og, r"^([\d\s]+\s*(?:\$|грн|€|USD|EUR)[^\-]*)"))).alias("price_raw"),
        F.coalesce(_param("кімнат", r"(\d+)"), rx(og, r"(\d+)\s*кімнат")).alias("rooms"),
        comma(F.coalesce(_param("м²|м2", r"([\d.,]+)\s*/"), _param("м²|м2", r"([\d.,]+)\s*м"), rx(og, r"([\d.,]+)\s*м²"))).alias("area"),
        F.coalesce(_param("поверх", r"(\d+)\s*(?:з|із)\s*(\d+)"), _param("поверх", r"(\d+)"), rx(og, r"(\d+)\s*поверх\s*(\d+)")).alias("floor"),
        F.coalesce(_param("поверх", r"(\d+)\s*(?:з|із)\s*(\d+)", 2), rx(og, r"(\d+)\s*поверх\s*(\d+)", 2)).alias("floors_total"),
        _first("street").alias("street"), _first("location").alias("address"), F.trim(F.get(region, 0)).alias("city"),
        F.trim(F.regexp_replace(F.get(region, 1), "р-н|район", "")).alias("district"), _first("seller").alias("contact_name"),
        F.when(pos.contains("власник"), "owner").when(pos.isNotNull(), "agent").when(_first("agency").isNotNull(), "agency").alias("agent_type"),
        F.trim(rx(_first("phones"), r"(\+?\d[\d\s\(\)\-]{8,})")).alias("contact_phone"),
        F.when(fee.isNotNull(), F.concat(F.lit("Комісія "), fee)).when(has(labels, "без комісі"), D.COMMISSION_NONE).alias("commission"),
        photos.alias("photos"), F.coalesce("og_image", F.try_element_at(photos, F.lit(1))).alias("photo_url"))


def _street(c) -> Column:
    return some(F.regexp_replace(clean_text(rx(c, D.COMMERCIAL_STREET)), r"\.$", ""))


def commercial_board_fields(pages: DataFrame, key: str = "page_id", html: str = "html", max_photos: int | None = None) -> DataFrame:
    """Fields of a classified board's commercial page: labelled blocks first, then JSON-LD, then the heading."""
    j = _read_once(pages, D.COMMERCIAL_BOARD_BLOCKS, key, html, {"h1": FLAT_RULES["h1"]})
    title = F.coalesce(some(F.col("ld.name")), F.col("h1"))
    about = F.coalesce(_first("description"), some(F.col("ld.description")))
    place = _first("location")
    sized = lambda v: F.lower(v).rlike("площа|м²|м2")
    floors = F.filter("params", lambda v: ~sized(v) & F.lower(v).rlike("поверх|этаж"))
    pair = r"(\d+)\s*/\s*(\d+)"
    level = F.try_element_at(F.filter(floors, lambda v: v.rlike(pair)), F.lit(-1))  # the last one counts
    pictures = F.filter("ld.image", lambda u: u.startswith("http"))
    shown = F.array_distinct(F.filter(F.when(F.size(pictures) > 0, pictures).otherwise(F.col("page_images")), lambda u: u.startswith("http")))
    shown = shown if max_photos is None else F.slice(shown, 1, max_photos)
    return j.select(
        key, title.alias("title"), about.alias("description"), F.coalesce(_first("price"), some(F.col("ld.offers.price"))).alias("price_raw"), place.alias("address"),
        detect_by_tokens(F.concat_ws(" ", title, about, place), D.DISTRICT_TOKENS).alias("district"), F.coalesce(_street(place), _street(title)).alias("street"),
        rx(F.try_element_at(F.filter("params", lambda v: sized(v) & v.rlike(r"\d")), F.lit(1)), r"(\d[\d.,]*)").alias("area"),
        rx(level, pair).alias("floor"), rx(level, pair, 2).alias("floors_total"),
        F.try_element_at(F.filter(floors, lambda v: ~v.rlike(pair)), F.lit(-1)).alias("floor_label"),
        _first("seller").alias("contact_name"), shown.alias("photos"), F.try_element_at(shown, F.lit(1)).alias("photo_url"))


def commercial_agency_fields(pages: DataFrame, key: str = "page_id", html: str = "html", max_photos: int | None = None) -> DataFrame:
    """Fields of an agency's commercial page from its labelled blocks."""
    j = extract_blocks(pages, D.COMMERCIAL_AGENCY_BLOCKS, key, html)
    title, about, region = _first("title"), _first("description"), _first("region")
    place = some(F.concat_ws(" ", _first("address"), region))
    details = F.array_join("details", " ")
    floor = r"(\d+)\s*(?:з|из|/)\s*(\d+)\s*(?:поверх|этаж)?"
    shown = F.array_distinct(F.filter("page_images", lambda u: u.startswith("http")))
    shown = shown if max_photos is None else F.slice(shown, 1, max_photos)
    position = F.lower(_first("position"))
    whole = F.concat_ws(" ", title, about, place, details)
    return j.select(
        key, title.alias("title"), about.alias("description"), _first("price").alias("price_raw"), place.alias("address"),
        F.when(region.isNotNull(), detect_by_tokens(region, D.DISTRICT_TOKENS)).otherwise(detect_by_tokens(whole, D.DISTRICT_TOKENS)).alias("district"),
        F.coalesce(_street(place), _street(title)).alias("street"), rx(details, r"(\d[\d.,]*)\s*(?:м²|м2|m2)").alias("area"),
        rx(details, floor).alias("floor"), rx(details, floor, 2).alias("floors_total"), _first("name").alias("contact_name"),
        F.when(_first("agency").isNotNull(), "agency").when(position.contains("власник"), "owner").when(position.isNotNull(), "agent").alias("advertiser_type"),
        _first("agency").alias("agency_name"), F.transform(F.regexp_extract_all(F.coalesce(F.array_join("phones", " "), F.lit("")), F.lit(r"(\+?\d[\d\s()\-]{8,})"), 1), lambda p: F.trim(p)).alias("phones"),
        shown.alias("photos"), F.try_element_at(shown, F.lit(1)).alias("photo_url"))
