"""Reports: counts, coverage, freshness, audits.  Each is one conditional aggregation over one scan."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rooftree.functions.text import is_blank

N = lambda: F.count(F.lit(1))


def status_counts(df: DataFrame) -> DataFrame:
    return counts_by(df, "status")


def counts_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(N().alias("n"))


def filled(name: str, kind: str = "value") -> Column:
    """Filled predicate per field kind: value (not NULL), text (not blank), list (not empty), long (over 30)."""
    c = F.col(name)
    return {"value": c.isNotNull(), "text": ~is_blank(c), "list": F.coalesce(F.size(c) > 0, F.lit(False)),
            "long": F.coalesce(F.length(c) > 30, F.lit(False)),
            "positive": F.coalesce(c > 0, F.lit(False))}[kind]


def percent(part: Column, total: Column, digits: int = 2) -> Column:
    return F.round(F.lit(100.0) * part.cast("double") / F.nullif(total, F.lit(0)), digits)


def coverage_report(df: DataFrame, fields: dict[str, str], by: list[str], digits: int = 2) -> DataFrame:
    """Percent filled per field and group; ``fields`` maps a column to its filled kind."""
    parts = [percent(F.count_if(filled(f, kind)), N(), digits).alias(f"{f}_pct") for f, kind in fields.items()]
    return df.groupBy(*by).agg(N().alias("total"), *parts)


def gap_report(df: DataFrame, fields: dict[str, str], by: list[str]) -> DataFrame:
    parts = [F.count_if(~filled(f, kind)).alias(f"no_{f}") for f, kind in fields.items()]
    return df.groupBy(*by).agg(N().alias("total"), *parts)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Number of keys that occur more than once and of rows beyond the first."""
    per_key = df.groupBy(*keys).agg(N().alias("c")).where(F.col("c") > 1)
    return per_key.agg(N().alias("duplicate_keys"), F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("excess_rows"))


def freshness(df: DataFrame, checks: DataFrame, asof: str, hours: int = 72, by: str = "source",
              on: str = "listing_id") -> DataFrame:
    """Oldest and newest check, never checked, not checked within ``hours`` before ``asof``."""
    last = checks.groupBy(on).agg(F.max("checked_at").alias("checked_at"))
    joined = df.join(last, df["id"] == last[on], "left")
    limit = F.expr(f"{asof} - INTERVAL {int(hours)} HOURS")
    at = F.col("checked_at")
    return joined.groupBy(by).agg(
        N().alias("active"), F.min(at).alias("oldest_checked_at"), F.max(at).alias("newest_checked_at"),
        F.count_if(at.isNull()).alias("never_checked"),
        F.count_if(at.isNull() | (at < limit)).alias("not_checked_within"))


def stale_count(df: DataFrame, asof: str, days: int = 7) -> DataFrame:
    old = F.col("updated_at") < F.expr(f"{asof} - INTERVAL {int(days)} DAYS")
    return df.agg(F.count_if((F.col("status") == "active") & old).alias("stale"))


def completeness_stats(df: DataFrame, hi: int = 90, lo: int = 50, score: str = "data_completeness") -> DataFrame:
    s = F.col(score)
    return df.agg(N().alias("total"), F.round(F.avg(s), 1).alias("avg_score"),
                  F.count_if(s >= hi).alias("premium"), F.count_if(s < lo).alias("weak"))


def top_reasons(df: DataFrame, k: int = 10) -> DataFrame:
    held = df.where(F.col("status") == "quarantine")
    return (held.groupBy(F.col("comments").alias("reason")).agg(N().alias("n"))
            .orderBy(F.col("n").desc(), F.col("reason").asc_nulls_last()).limit(k))


def queue_report(jobs: DataFrame, results: DataFrame) -> DataFrame:
    """One row: job states, and results with a phone as share of all results."""
    state = lambda s: F.count_if(F.col("status") == s)
    j = jobs.select("status", F.lit(None).cast("bigint").alias("phones"), F.lit(1).alias("is_job"))
    r = results.select(F.lit(None).cast("string").alias("status"), F.col("phone_count").cast("bigint").alias("phones"),
                       F.lit(0).alias("is_job"))
    rows = F.count_if(F.col("is_job") == 0)
    found = F.count_if((F.col("is_job") == 0) & (F.col("phones") > 0))
    return j.unionByName(r).agg(F.count_if(F.col("is_job") == 1).alias("total_jobs"), state("done").alias("done_jobs"),
                                state("retry").alias("retry_jobs"), state("failed").alias("failed_jobs"),
                                rows.alias("results"), found.alias("with_phone"),
                                percent(found, rows).alias("coverage_percent"))


def distinct_counts(df: DataFrame, cols: list[str], universe: DataFrame, ratio_of: str) -> DataFrame:
    """Distinct counts and their share of another table's row count.

    Each column is de-duplicated by its own grouped aggregate and the small results are summed, so no task
    holds a set of all values.
    """
    parts = None
    for c in cols:
        one = df.where(F.col(c).isNotNull()).select(F.col(c).cast("string").alias("v")).distinct()
        one = one.agg(N().alias("k")).select(F.lit(c).alias("name"), "k")
        parts = one if parts is None else parts.unionByName(one)
    parts = parts.unionByName(df.agg(N().alias("k")).select(F.lit("__rows").alias("name"), "k"))
    parts = parts.unionByName(universe.agg(N().alias("k")).select(F.lit("__all").alias("name"), "k"))
    get = lambda name: F.max(F.when(F.col("name") == name, F.col("k")))
    return parts.agg(get("__rows").alias("row_count"), *[get(c).alias(f"distinct_{c}") for c in cols],
                     get("__all").alias("universe_rows"),
                     percent(get(ratio_of), get("__all")).alias("coverage_pct"))


def media_states(df: DataFrame) -> DataFrame:
    return df.groupBy("status").agg(N().alias("n"), F.coalesce(F.sum("byte_size"), F.lit(0)).alias("bytes"))


def contact_report(df: DataFrame) -> DataFrame:
    method = lambda m: F.count_if(F.col("contact_method") == m).alias(m)
    return df.groupBy("source").agg(N().alias("records"), method("public_phone"), method("source_link"),
                                    F.count_if("needs_review").alias("needs_review"))


def policy_summary(df: DataFrame, reason: str = "policy_reason") -> DataFrame:
    """Candidates by operation with counts of price and location reasons."""
    r = F.col(reason)
    held = df.where(r.isNotNull())
    return held.groupBy("operation").agg(N().alias("candidates"), F.count_if(r.contains("usd_")).alias("price"),
                                         F.count_if(r.contains("outside_kyiv_region")).alias("location"))


def catalog_audit(df: DataFrame, checks: dict[str, str], expected_zero: bool = True) -> DataFrame:
    """Named conditions counted in one pass, as rows (check_name, value, failed)."""
    counted = df.agg(*[F.count_if(F.expr(cond)).alias(name) for name, cond in checks.items()])
    rows = F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(n).alias("value")) for n in checks])
    return counted.select(F.inline(rows)).withColumn("failed", (F.col("value") > 0) == F.lit(expected_zero))


def fill_rate_issues(coverage: DataFrame, thresholds: dict[str, float]) -> DataFrame:
    """Groups and fields below their threshold percent."""
    by = [c for c in coverage.columns if not c.endswith("_pct") and c != "total"]
    rows = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"{f}_pct").alias("pct"), F.lit(float(t)).alias("minimum"))
                     for f, t in thresholds.items()])
    return coverage.select(*by, F.inline(rows)).where(F.col("pct") < F.col("minimum"))


def photo_work_queue(df: DataFrame, pubs: DataFrame, photos: str = "photos") -> DataFrame:
    """Per secure photo URL: best priority (waiting publication first) and newest listing update."""
    states = pubs.groupBy("listing_id").agg(
        F.max(F.col("status").isin("pending", "retry").cast("int")).alias("waiting"))
    rows = df.where(F.col("status") == "active").select("id", "updated_at", photos)
    rows = rows.join(states, rows["id"] == states["listing_id"], "left")
    priority = (F.when(F.col("waiting") == 1, 0).when(F.col("listing_id").isNull(), 1).otherwise(2))
    items = rows.select(F.explode(photos).alias("url"), priority.alias("priority"), "updated_at")
    return items.where(F.col("url").startswith("https://")).groupBy("url").agg(
        F.min("priority").alias("priority"), F.max("updated_at").alias("source_updated_at"))


def repair_report(df: DataFrame, before: str, after: str, uninformative) -> DataFrame:
    changed = F.col(after) != F.trim(F.coalesce(F.col(before), F.lit("")))
    return df.agg(N().alias("scanned"), F.count_if(changed).alias("changed"),
                  F.count_if(changed & ~F.col(after).isin(*uninformative)).alias("explicitly_extracted"))


def cross_catalog_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys present in more than one catalog (min/max instead of a set per key)."""
    per_key = df.groupBy(key).agg(F.min("catalog").alias("lo"), F.max("catalog").alias("hi"), N().alias("n"))
    return per_key.where(F.col("lo") != F.col("hi")).select(key, "n")


def run_completeness(pages: DataFrame, by=("run_id", "operation")) -> DataFrame:
    """A run is complete when every expected page succeeded and there was at least one."""
    per = pages.groupBy(*by).agg(F.max("expected_pages").alias("expected_pages"),
                                 F.count_if("ok").alias("successful_pages"), F.min("started_at").alias("started_at"))
    done = (F.col("expected_pages") > 0) & (F.col("successful_pages") == F.col("expected_pages"))
    return per.withColumn("complete", done)


def intake_stats(df: DataFrame, by=("source", "operation"), outcomes=("parsed", "failed", "filtered", "price_skip"),
                 col: str = "outcome") -> DataFrame:
    return df.groupBy(*by).agg(*[F.count_if(F.col(col) == o).alias(o) for o in outcomes])


def shortfall(df: DataFrame, pages: DataFrame, on: str = "page_id", expected: str = "expected",
              html: str = "html") -> DataFrame:
    """Published pages that show fewer images than expected; markup is counted before the join."""
    shown = pages.select(on, (F.size(F.split(F.col(html), "<img", -1)) - 1).alias("actual"))
    return df.join(shown, on, "inner").where(F.col("actual") < F.col(expected)).select(on, expected, "actual")
