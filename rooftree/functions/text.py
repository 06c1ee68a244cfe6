"""Text expressions: cleaning, numbers, phones, redaction, chunking, identifiers (Column -> Column)."""
from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from rooftree import defaults as D

UNICODE = "(?iuU)"  # ignore case, also for non-Latin letters; \w, \b, \s cover Unicode
_SPACES = r"\s\x1c-\x1f\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def regex(pattern: str, flags: str = UNICODE) -> str:
    """Java pattern text.  Unicode classes are slow, so a pattern without word classes gets an explicit space class."""
    if flags == UNICODE and r"\w" not in pattern and r"\b" not in pattern and r"\W" not in pattern:
        return "(?iu)" + pattern.replace(r"\s", f"[{_SPACES}]").replace(r"\S", f"[^{_SPACES}]")
    return flags + pattern


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """Bind ``value`` once and use it many times: keeps expression trees (and generated code) linear in size."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def some(c) -> Column:
    """The text, or NULL when it is empty."""
    return let(as_col(c), lambda v: F.when(v != "", v))


def rx(c, pattern: str, group: int = 1, flags: str = UNICODE) -> Column:
    """Regex group as a value, NULL when there is no match (or the group is empty)."""
    return some(F.regexp_extract(as_col(c), regex(pattern, flags), group))


def has(c, pattern: str, flags: str = UNICODE) -> Column:
    return F.coalesce(as_col(c).rlike(regex(pattern, flags)), F.lit(False))


def drop(c, pattern: str, by: str = "", flags: str = UNICODE) -> Column:
    return F.regexp_replace(as_col(c), regex(pattern, flags), by)


def words_array(words) -> Column:
    """Constant string array (folded to one literal by the optimizer)."""
    return F.split(F.lit("\u0001".join(words)), "\u0001")


def contains_any(c, tokens) -> Column:
    """True when any literal token occurs (byte search per token: cheaper than a regex alternation)."""
    tokens = list(tokens)
    if len(tokens) <= 3:
        c = as_col(c)
        return F.coalesce(reduce(lambda a, b: a | b, [c.contains(t) for t in tokens]), F.lit(False))
    return F.coalesce(let(as_col(c), lambda v: F.exists(words_array(tokens), lambda t: v.contains(t))), F.lit(False))


def is_blank(c) -> Column:
    s = as_col(c).cast("string")
    return s.isNull() | (F.trim(drop(s, r"\s+", " ")) == "")


def blank_to_null(c) -> Column:
    c = as_col(c)
    return F.when(~is_blank(c), c)


def first_non_blank(*cols) -> Column:
    return F.coalesce(*[blank_to_null(c) for c in cols])


def clean_text(c) -> Column:
    return F.trim(drop(F.coalesce(as_col(c).cast("string"), F.lit("")), r"\s+", " "))


def extract_number(c) -> Column:
    bare = F.translate(as_col(c), "\u00a0 ", "")
    return F.replace(rx(bare, r"\d+[.,]?\d*", 0), F.lit(","), F.lit(".")).try_cast("double")


def extract_int(c) -> Column:
    return extract_number(c).try_cast("bigint")


def content_hash(c, algorithm: str = "md5") -> Column:
    return F.md5(as_col(c)) if algorithm == "md5" else F.sha2(as_col(c), 256)


def digits(c) -> Column:
    return drop(F.coalesce(as_col(c), F.lit("")), r"\D")


def normalize_phone(c, on_invalid: str = "raw") -> Column:
    """National number to +380...; anything else stays raw, becomes blank, or keeps its digits."""
    def build(d):
        rest = {"raw": F.trim(F.coalesce(as_col(c), F.lit(""))), "blank": F.lit(""), "digits": d}[on_invalid]
        return (F.when((F.length(d) == 10) & d.startswith("0"), F.concat(F.lit("+38"), d))
                .when((F.length(d) == 12) & d.startswith("380"), F.concat(F.lit("+"), d)).otherwise(rest))

    return let(digits(c), build)


def extract_phones(c, pattern: str = D.PHONE_IN_TEXT, min_digits: int = 10, max_digits: int = 12) -> Column:
    """Distinct phone-shaped values in order of first occurrence."""
    found = F.regexp_extract_all(F.coalesce(as_col(c), F.lit("")), F.lit(regex("(" + pattern + ")")), 1)
    phones = F.transform(found, lambda p: normalize_phone(p))
    ok = lambda p: F.length(digits(p)).between(min_digits, max_digits)
    return F.array_distinct(F.filter(phones, ok))


def phone_values(c) -> Column:
    """Phones of a delimited contact field: national and international digit forms only."""
    tokens = F.split(F.coalesce(as_col(c), F.lit("")), r"[,;/|\n]+")
    valid = F.filter(F.transform(tokens, lambda t: normalize_phone(t, "blank")), lambda p: p != "")
    return F.array_distinct(valid)


def tel_links(html) -> Column:
    """Phones published as tel: links of a page."""
    found = F.regexp_extract_all(as_col(html), F.lit(UNICODE + D.TEL_HREF), 1)
    phones = F.transform(found, lambda p: normalize_phone(p))
    return F.array_distinct(F.filter(phones, lambda p: F.length(digits(p)).between(10, 15)))


ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#x27;", "'"), ("&apos;", "'"),
            ("&nbsp;", " "), ("&laquo;", "«"), ("&raquo;", "»"), ("&ndash;", "–"), ("&mdash;", "—"),
            ("&hellip;", "…"), ("&amp;", "&")]


def unescape(c) -> Column:
    return reduce(lambda acc, e: F.replace(acc, F.lit(e[0]), F.lit(e[1])), ENTITIES, as_col(c))


def strip_html(c) -> Column:
    """Text without entities and tags; a text that has none is passed on as it is."""
    plain = let(F.coalesce(as_col(c), F.lit("")), lambda v: F.when(v.contains("&"), unescape(v)).otherwise(v))
    return let(plain, lambda v: F.when(v.contains("<"), F.regexp_replace(v, "<[^>]+>", " ")).otherwise(v))


def _rejoin(paragraphs: Column, keep_sentence, splitter: str = regex(r"(?<=[.!?])\s+")) -> Column:
    """Clean sentence by sentence inside paragraphs and put what is left together again."""
    def one(paragraph):
        return F.array_join(F.transform(F.split(paragraph, splitter), keep_sentence), " ")  # NULLs are left out
    return F.array_join(F.filter(F.transform(paragraphs, one), lambda p: p != ""), "\n\n")


def cut(c: Column, limit: int | None) -> Column:
    """The whole text, or its first ``limit`` characters where the caller asks for a cut."""
    return c if limit is None else F.substring(c, 1, limit)


def redact_text(c, banned: str = D.BANNED, redactions=tuple(D.REDACTIONS), phone: str = D.PHONE_SHAPE,
                url: str = D.URL_SHAPE, min_len: int = D.MIN_SENTENCE, limit: int | None = None, full_head: int = D.FULL_HEAD) -> Column:
    """Drop phones, links, foreign-language tail and contact phrases; keep clean sentences only.

    The tail begins at a marker.  Where over ``full_head`` characters stand before it, the text before it is complete and the
    tail goes; a marker nearer to the start is a mere heading, of which only its line goes.
    """
    def before_marker(text):
        head = F.element_at(F.split(text, regex(D.ENGLISH_MARKER), 2), 1)  # whole text when there is no marker
        return let(head, lambda h: F.when((F.length(h) > full_head) | (F.length(h) == F.length(text)), h)
                   .otherwise(drop(text, D.ENGLISH_MARKER + r"[^\n]*")))

    text = let(drop(drop(F.coalesce(as_col(c), F.lit("")), phone), url), before_marker)
    for pattern in redactions:
        text = drop(text, pattern, " ")

    def keep(sentence):
        def judge(before):  # an unchanged sentence holds nothing banned: no second search
            return let(drop(before, banned), lambda tidy: F.when(
                (F.length(tidy) >= min_len) & ((tidy == before) | ~has(tidy, banned)), tidy))

        return let(drop(clean_text(sentence), D.LEADING_LABEL), judge)

    return cut(_rejoin(F.split(text, regex(r"\n\s*\n+")), keep), limit)


def redact_plain(c, banned: str = D.COMMERCIAL_BANNED, phone: str = D.PHONE_SHAPE, url: str = D.URL_SHAPE,
                 min_len: int = D.MIN_SENTENCE, limit: int | None = None) -> Column:
    """Sentence filter on one line: no phones, no links, no banned or very short sentences."""
    text = drop(drop(F.coalesce(as_col(c), F.lit("")), phone), url)
    parts = F.transform(F.split(text, regex(r"(?<=[.!?])\s+|\n+")), clean_text)
    kept = F.filter(parts, lambda s: (F.length(s) >= min_len) & ~has(s, banned))
    return cut(F.array_join(kept, " "), limit)


def redact_phrases(c, phrases: str = D.FEED_CONTACT, phone: str = D.PHONE_SHAPE,
                   limit: int | None = None) -> Column:
    """Cut phones and contact phrases out of the text, keep the rest."""
    return cut(clean_text(drop(drop(F.coalesce(as_col(c), F.lit("")), phone), phrases)), limit)


# what may match in a sentence, but not at the same place of its paragraph: anchors, look-around, possessive and atomic parts
_EDGE_BOUND = re.compile(r"\^|\$|\\[AZzGBX]|\\b\{|\(\?<?[=!>]|[*+?}]\+")


def publishable_text(c, sensitive: str = D.SENSITIVE_SENTENCE, limit: int | None = None) -> Column:
    """Plain text for a public page: no markup, no sentence that names a site, an agent or a phone.

    Sentences are looked at only in a paragraph that holds something sensitive; any other stays as it is.
    """
    def found(p):
        if sensitive != D.SENSITIVE_SENTENCE:
            return has(p, sensitive)
        return contains_any(F.lower(p), D.SENSITIVE_PARTS) & has(p, sensitive)

    def tidy(p):
        return F.trim(F.when(p.contains("  ") | p.rlike(f"[{_SPACES}&&[^ ]]"), drop(p, r"\s+", " ")).otherwise(p))

    def publishable(p):
        kept = F.transform(F.split(p, regex(r"(?<=[.!?])\s+")), lambda s: F.when((s != "") & ~has(s, sensitive), s))
        kept = F.array_join(kept, " ")  # NULLs are left out
        return kept if _EDGE_BOUND.search(sensitive) else F.when(found(p), kept).otherwise(p)

    paragraphs = let(strip_html(c), lambda v: F.when(v.contains("\n\n"), F.split(v, r"\n{2,}")).otherwise(F.array(v)))
    paragraphs = F.transform(F.transform(paragraphs, tidy), publishable)
    return cut(F.array_join(F.filter(paragraphs, lambda p: p != ""), "\n\n"), limit)


def numbers_in(c) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.coalesce(as_col(c), F.lit("")), F.lit(r"(\d+(?:[.,]\d+)?)"), 1))


def number_text(c) -> Column:
    """Whole numbers without decimals, others with a decimal comma, '' for NULL."""
    def shown(v):
        return (F.when(v == F.floor(v), v.try_cast("bigint").cast("string"))
                .otherwise(F.replace(v.cast("string"), F.lit("."), F.lit(","))))

    return F.coalesce(let(as_col(c).try_cast("double"), shown), F.lit(""))


def numbers_supported(text, source, fields, min_len: int = D.DETAILED_MIN, max_len: int | None = None,
                      banned: str = D.BANNED, phone: str = D.PHONE_SHAPE, url: str = D.URL_SHAPE) -> Column:
    """Generated text may only hold numbers that the source or the record's fields hold."""
    shown = [number_text(f) for f in fields]
    variants = [v for s in shown for v in (F.replace(s, F.lit(","), F.lit(".")), F.replace(s, F.lit("."), F.lit(",")))]
    allowed = F.array_union(numbers_in(source), F.array(*variants))
    long_enough = lambda n: (n >= min_len) if max_len is None else n.between(min_len, max_len)
    return let(clean_text(text), lambda value: (
        long_enough(F.length(value)) & ~has(value, banned) & ~has(value, phone) & ~has(value, url)
        & (F.size(F.array_except(numbers_in(value), allowed)) == 0)))


def chunk_text(c, n: int = 900) -> Column:
    """Word-bounded chunks of at most ``n`` characters, paragraph by paragraph."""
    lines = F.split(drop(as_col(c), r"(\r\n|\n|\r)$"), r"\r\n|\n|\r")

    def pack(line):
        words = F.filter(F.split(F.trim(drop(line, r"\s+", " ")), " "), lambda w: w != "")
        seed = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("cur"))

        def step(acc, word):
            full = (acc["cur"] != "") & (F.length(acc["cur"]) + 1 + F.length(word) > n)
            return F.struct(
                F.when(full, F.array_append(acc["done"], acc["cur"])).otherwise(acc["done"]).alias("done"),
                F.when(full | (acc["cur"] == ""), word).otherwise(F.concat(acc["cur"], F.lit(" "), word)).alias("cur"))

        return F.aggregate(words, seed, step, lambda acc: F.array_append(acc["done"], acc["cur"]))

    return F.flatten(F.transform(lines, pack))


def external_id(url, rules=tuple(D.SITE_RULES), fallback: str = "web_") -> Column:
    """Identifier from a URL by site rule; a content hash where no rule applies (same in every run)."""
    found = [F.concat(F.lit(prefix), rx(url, pattern, 1, "")) for _, pattern, prefix in rules]
    return F.coalesce(*found, F.concat(F.lit(fallback), F.substring(F.sha2(as_col(url), 256), 1, 16)))


def display_id(source, url, ext, rules=tuple(D.DISPLAY_RULES)) -> Column:
    src = F.lower(F.trim(F.coalesce(as_col(source), F.lit(""))))
    cases = [F.when(src == name, F.concat(F.lit(prefix), rx(url, pattern, 1, ""))) for name, pattern, prefix in rules]
    return F.coalesce(*cases, as_col(ext), F.lit(""))


def normalize_url(c) -> Column:
    return F.regexp_replace(F.regexp_replace(F.trim(as_col(c)), r"[#?].*$", ""), "/+$", "")


def cell_equal(a, b) -> Column:
    """Display cells are equal as text (quote prefix aside) or as exact numbers."""
    left, right = [F.regexp_replace(F.trim(F.coalesce(as_col(x), F.lit(""))), "^'+", "") for x in (a, b)]
    num = lambda s: F.replace(s, F.lit(","), F.lit(".")).try_cast("decimal(38,12)")
    return let(F.struct(left.alias("l"), right.alias("r")),
               lambda p: (p["l"] == p["r"]) | F.coalesce(num(p["l"]) == num(p["r"]), F.lit(False)))
