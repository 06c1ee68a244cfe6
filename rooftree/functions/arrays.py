"""Array expressions over photo and value lists (order matters: the first photo is the primary one)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rooftree import defaults as D
from rooftree.functions.text import as_col, has, let, rx
from rooftree.operators.skew import attach_lookup

EMPTY = lambda: F.array().cast("array<string>")


def distinct_ordered(*arrays) -> Column:
    """Union of arrays, first occurrence wins."""
    return F.array_distinct(F.concat(*[F.coalesce(as_col(a), EMPTY()) for a in arrays]))


def https_photos(photos, primary=None) -> Column:
    """Secure photo URLs of a row, trimmed, distinct, list first and the single photo last."""
    last = EMPTY() if primary is None else F.array(as_col(primary))
    urls = F.transform(F.concat(F.coalesce(as_col(photos), EMPTY()), last), lambda u: F.trim(u))
    return F.array_distinct(F.filter(urls, lambda u: u.startswith("https://")))


def clean_photo_url(c) -> Column:
    """The first URL of an attribute value (srcset lists, trailing punctuation)."""
    return F.regexp_replace(rx(c, r"(https?://[^\s,]+)"), r"[.,;)]+$", "")


def rank_photos(photos, preferred=None, prefer: str = D.PHOTO_PREFER, reject: str = D.PHOTO_REJECT) -> Column:
    """Property photos first, others after, avatars and logos out; order inside both classes is kept."""
    first = EMPTY() if preferred is None else F.array(as_col(preferred))
    urls = F.transform(F.concat(first, F.coalesce(as_col(photos), EMPTY())), clean_photo_url)
    good = F.array_distinct(F.filter(urls, lambda u: u.isNotNull() & u.startswith("http") & ~has(u, reject)))
    return let(good, lambda g: F.concat(F.filter(g, lambda u: has(u, prefer)), F.filter(g, lambda u: ~has(u, prefer))))


def first_photo(ranked) -> Column:
    return F.coalesce(F.try_element_at(as_col(ranked), F.lit(1)), F.lit(""))


def prune_array(df: DataFrame, key: str, arr: str, gone: DataFrame, url: str = "url") -> DataFrame:
    """Remove known-dead URLs from an array column; order and repeats of the rest stay.

    Only (key, position, url) is shuffled; a URL that many rows share is handled by ``attach_lookup``.
    """
    items = df.select(key, F.posexplode(arr).alias("pos", "item"))
    dead = gone.select(F.col(url).alias("item")).distinct().withColumn("dead", F.lit(True))
    kept = attach_lookup(items, dead, "item").where(F.col("dead").isNull())
    rebuilt = kept.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "item"))).alias("__kept"))
    out = df.join(rebuilt.withColumnRenamed(key, "__key"), F.col(key) == F.col("__key"), "left")
    values = F.coalesce(F.transform("__kept", lambda s: s["item"]), EMPTY())
    return out.select(*[F.when(F.col(arr).isNotNull(), values).alias(arr) if c == arr else F.col(c)
                        for c in df.columns])
