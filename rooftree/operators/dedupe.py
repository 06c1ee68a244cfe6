"""Duplicate handling inside and across sources, without a window over whole key groups."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rooftree import defaults as D
from rooftree.functions.text import digits
from rooftree.operators.quality import source_filter
from rooftree.operators.skew import age_code, attach_group, attach_lookup, code_id, per_group_top


def _mark_losers(df: DataFrame, eligible: Column, keys: dict[str, Column], note: str) -> DataFrame:
    """Rows that are not their group's newest become inactive with the keeper in the comment.

    Only keys that occur more than once are joined back; few duplicates therefore mean a broadcast at run time
    and no shuffle of the rows at all.
    """
    keyed = df.withColumn("__ok", F.coalesce(eligible, F.lit(False))).withColumns(keys)
    keyed = keyed.withColumn("__code", age_code(df))
    groups = keyed.where("__ok").groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"), F.max("__code").alias("newest"))
    out = attach_lookup(keyed, groups.where(F.col("__rows") > 1), list(keys), F.col("__ok"))
    lost = F.col("__ok") & F.coalesce(F.col("newest") > F.col("__code"), F.lit(False))
    return out.withColumns({
        "status": F.when(lost, "inactive").otherwise(F.col("status")),
        "comments": F.when(lost, F.concat(F.lit(note), code_id("newest").cast("string"))).otherwise(F.col("comments")),
    }).select(*df.columns)


def _open(df: DataFrame) -> Column:
    return (F.col("status") == "active") & ~F.col("source").startswith(D.AGGREGATOR_PREFIX)


def dedupe_by_url(df: DataFrame) -> DataFrame:
    filled = F.coalesce(F.trim("url") != "", F.lit(False))
    return _mark_losers(df, _open(df) & filled, {"__url": F.col("url")}, D.COMMENT_DUPLICATE_URL)


def listing_print() -> dict[str, Column]:
    return {"__op": F.col("operation"),
            "__title": F.lower(F.regexp_replace(F.trim("title"), r"\s+", " ")),
            "__area": F.coalesce(F.col("area"), F.lit(0.0)), "__price": F.coalesce(F.col("price_uah"), F.lit(0.0)),
            "__phone": digits("agent_phone")}


def dedupe_by_fingerprint(df: DataFrame, keys: dict[str, Column] | None = None, min_title: int = 30,
                          min_phone: int = 10) -> DataFrame:
    """Same advert under another URL: equal operation, title, area, price and phone, all of them present."""
    guard = ((F.length(F.trim("title")) >= min_title) & (F.coalesce(F.col("area"), F.lit(0)) > 0)
             & (F.coalesce(F.col("price_uah"), F.lit(0)) > 0) & (F.length(digits("agent_phone")) >= min_phone))
    return _mark_losers(df, _open(df) & guard, keys or listing_print(), D.COMMENT_DUPLICATE_PRINT)


def cross_source_duplicates(df: DataFrame, min_title: int = 20, min_phone: int = 10) -> DataFrame:
    """Ids of rows for which a smaller id of *another* source has the same advert.

    Linear form of the self-join: per key only the smallest id and the smallest id of a second source
    matter.  Both come from (key, source) minima, so neither a pair list nor a whole group is built.
    """
    keys = {"k_title": F.col("title"), "k_area": F.coalesce(F.col("area"), F.lit(0.0)),
            "k_district": F.coalesce(F.col("district"), F.lit("")),
            "k_price": F.coalesce(F.col("price_uah"), F.lit(0.0)), "k_phone": digits("agent_phone"),
            "k_op": F.col("operation")}
    rows = (source_filter(df).where((F.col("status") == "active") & (F.length("title") > min_title)
                                    & (F.length(digits("agent_phone")) >= min_phone))
            .select("id", "source", *[e.alias(k) for k, e in keys.items()]))
    per_source = rows.groupBy(*keys, "source").agg(F.min("id").alias("m"), F.count(F.lit(1)).alias("n"))
    two = per_group_top(per_source, list(keys), [F.col("m").asc()], 2, "r")
    firsts = two.groupBy(*keys).agg(
        F.max(F.when(F.col("r") == 1, F.col("source"))).alias("first_source"),
        F.max(F.when(F.col("r") == 2, F.col("m"))).alias("second_id")).where(F.col("second_id").isNotNull())
    marked = attach_lookup(rows, firsts, list(keys)).where(F.col("first_source").isNotNull())
    dup = (F.col("source") != F.col("first_source")) | (F.col("id") > F.col("second_id"))
    return marked.where(dup).select("id")


def mark_cross_source(df: DataFrame) -> DataFrame:
    dup = cross_source_duplicates(df).select(F.col("id").alias("__dup"))
    out = df.join(dup, df["id"] == dup["__dup"], "left")
    hit = F.col("__dup").isNotNull()
    return out.withColumns({"status": F.when(hit, "quarantine").otherwise(F.col("status")),
                            "comments": F.when(hit, "cross_source_duplicate").otherwise(F.col("comments"))}
                           ).drop("__dup")


def first_occurrence(df: DataFrame, key: str | list[str], pos: str) -> DataFrame:
    """Add ``is_first``: the row with the smallest position of its key; the others are repeats."""
    keys = [key] if isinstance(key, str) else key
    out = attach_group(df, keys, {"__first": F.min(pos)})
    return out.withColumn("is_first", F.col(pos) == F.col("__first")).drop("__first")
