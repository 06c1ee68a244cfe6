"""Availability, absence, job and retry state as batch folds (the streaming forms are in rooftree.streaming)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rooftree import defaults as D
from rooftree.functions.text import contains_any, has, rx
from rooftree.operators.skew import age_code, attach_lookup, code_id, code_time, first_run, ordinal

MISS = lambda: F.col("http_status").isin(404, 410)
SEEN = lambda: F.col("http_status").between(200, 399)


def availability_state(checks: DataFrame, threshold: int = 2, key: str = "listing_id") -> DataFrame:
    """Per listing: misses (404/410) since the last success; other outcomes leave the counter alone.

    Two map-side-combined aggregates: last success per key, then misses after it.
    """
    checks = checks.withColumn("at", age_code(checks, "checked_at", "event_id"))
    base = checks.groupBy(key).agg(F.max("checked_at").alias("last_checked_at"), F.max(F.when(SEEN(), F.col("at"))).alias("last_ok"),
                                   F.max(F.when(SEEN(), F.col("checked_at"))).alias("last_seen_at"))
    misses = checks.where(MISS()).select(key, "event_id", "at")
    dim = base.where(F.col("last_ok").isNotNull()).select(key, "last_ok")
    late = attach_lookup(misses, dim, key)
    late = late.where(F.col("last_ok").isNull() | (F.col("at") > F.col("last_ok")))
    counts = late.groupBy(key).agg(F.count(F.lit(1)).alias("missing"))
    out = base.join(counts, key, "left")
    missing = F.coalesce("missing", F.lit(0)).cast("bigint")
    return out.select(key, "last_checked_at", "last_seen_at", missing.alias("missing"),
                      F.when(missing >= threshold, "inactive").otherwise("active").alias("status"))


def confirmed_once(checks: DataFrame, threshold: int = 2, key: str = "listing_id", slice_seconds: int = 3_600) -> DataFrame:
    """The one check per listing that first completes ``threshold`` misses in a row (successes reset, others do not)."""
    decisive = checks.where(MISS() | SEEN())
    hits = first_run(decisive, [key], age_code(decisive, "checked_at", "event_id"), MISS(), threshold,
                     F.floor(F.unix_timestamp("checked_at") / F.lit(slice_seconds)), F.col("http_status"))
    return hits.select(key, code_id("run_code").alias("event_id"), code_time("run_code", checks.schema["checked_at"].dataType).alias("confirmed_at"),
                       F.concat(F.lit("http_"), F.col("run_value").cast("string"), F.lit("_confirmed")).alias("reason"))


def absence_by_run(runs: DataFrame, sightings: DataFrame, threshold: int = 2, key: str = "listing_id",
                   scope: str = "operation") -> DataFrame:
    """Complete runs since a listing was last seen; only listings seen in a complete run are counted.

    Runs are numbered once, day by day; a listing then needs only its last seen run number.
    """
    done = runs.where("complete").select(scope, "run_id", "started_at")
    day = F.floor(F.unix_timestamp("started_at") / F.lit(86_400))
    numbered = ordinal(done, [scope], [F.col("started_at").asc(), F.col("run_id").asc()], day, "run_no")
    totals = numbered.groupBy(scope).agg(F.max("run_no").alias("total_runs"))
    seen = sightings.join(numbered.select(scope, "run_id", "run_no"), [scope, "run_id"], "inner")
    last = seen.groupBy(scope, key).agg(F.max("run_no").alias("last_run"))
    out = last.join(totals, scope)
    missing = (F.col("total_runs") - F.col("last_run")).cast("bigint")
    return out.select(scope, key, missing.alias("missing_complete_runs"),
                      F.when(missing >= threshold, "inactive").otherwise("active").alias("status"),
                      F.when(missing >= threshold, D.ABSENCE_NOTE).when(missing > 0, "absent from complete collection")
                      .otherwise("seen in complete collection").alias("note"))


def job_transition(jobs: DataFrame, outcomes: DataFrame, asof: str, max_attempts: int = D.MAX_ATTEMPTS,
                   on: str = "job_id") -> DataFrame:
    """Next job state from one outcome per job (listing_status, ad_id, phone_status, phone_count, failed)."""
    j = jobs.join(outcomes, on, "inner").withColumn("attempt_no", F.col("attempt_count") + 1)
    again = F.col("attempt_no") < max_attempts
    ls, ps = F.col("listing_status"), F.col("phone_status")
    failed = F.coalesce(F.col("failed"), F.lit(False))
    page_bad = F.coalesce(ls != 200, F.lit(True))
    page_retry = again & ls.isin(*D.LISTING_RETRY_CODES)
    phone_retry = again & (ps.isNull() | ps.isin(*D.PHONE_RETRY_CODES))
    found = F.col("phone_count") > 0
    no_id = F.col("ad_id").isNull()
    case = lambda exc, page, ident, hit, miss: (F.when(failed, exc).when(page_bad, page).when(no_id, ident)
                                                .when(found, hit).otherwise(miss))
    retry_else = lambda cond, no="failed": F.when(F.coalesce(cond, F.lit(False)), "retry").otherwise(no)
    label = lambda cond, no="not_found": F.when(F.coalesce(cond, F.lit(False)), "blocked").otherwise(no)
    status = case(retry_else(again), retry_else(page_retry), F.lit("failed"), F.lit("done"), retry_else(phone_retry))
    coverage = case(label(again, "failed"), label(page_retry), F.lit("needs_review"), F.lit("found"), label(phone_retry))
    minutes = case(F.lit(D.RETRY_MINUTES["exception"]), F.lit(D.RETRY_MINUTES["listing"]), F.lit(None), F.lit(None),
                   F.lit(D.RETRY_MINUTES["phone"]))
    later = F.when(status == "retry", F.expr(asof) + F.make_interval(mins=minutes))
    return j.select(on, F.col("attempt_no").alias("attempt_count"), status.alias("status"),
                    coverage.alias("coverage_status"), later.alias("next_attempt_at"))


def attempt_ledger(events: DataFrame, key: str = "listing_id", ts_col: str = "attempted_at") -> DataFrame:
    return events.groupBy(key).agg(F.max(ts_col).alias("attempted_at"))


def seen_range(events: DataFrame, key: str, ts_col: str) -> DataFrame:
    return events.groupBy(key).agg(F.min(ts_col).alias("first_seen_at"), F.max(ts_col).alias("last_seen_at"))


def media_error_state(error: Column) -> Column:
    """gone / invalid / retry for a failed download message."""
    return (F.when(error.contains("404 Client Error") | error.contains("410 Client Error"), "gone")
            .when(error.contains("422 Client Error") | error.contains("unsupported image response"), "invalid")
            .otherwise("retry"))


def publish_error(error: Column, asof: str) -> Column:
    """struct(status, retry_after, flood_seconds) for a failed publication message."""
    flood = rx(error, r"FLOOD_WAIT_(\d+)").try_cast("int")
    terminal = error.contains("Resource not found") | error.contains("Listing has no usable HTTPS photos")
    now = F.expr(asof)
    retry_after = (F.when(flood.isNotNull(), now + F.make_interval(secs=flood + 15))
                   .when(error.contains("Media archive pending"), now + F.expr("INTERVAL 10 MINUTES")))
    return F.struct(F.when(terminal, "failed").otherwise("retry").alias("status"), retry_after.alias("retry_after"),
                    flood.alias("flood_seconds"))


def is_transient(error: Column, markers=tuple(D.TRANSIENT_MARKERS)) -> Column:
    """A marker occurs in the message; a status code counts only as a number of its own, not inside an id or a waiting time."""
    codes = [m for m in markers if m.isdigit()]
    found = contains_any(F.lower(error), [m for m in markers if not m.isdigit()])
    return found | has(error, rf"(?<!\w)({'|'.join(codes)})(?!\w)", "") if codes else found


def reclassify_gone(df: DataFrame) -> DataFrame:
    """Failed pages whose error is a plain 404/410 leave the retry queue."""
    gone = (F.col("parse_status") == "failed") & has("error_message", r"^HTTP (404|410)$")
    return df.withColumn("parse_status", F.when(gone, "gone").otherwise(F.col("parse_status")))


def classify_error(error: Column, asof: str, retry_hours: int = 6) -> Column:
    """struct(state, retry_after) of a media failure."""
    state = media_error_state(error)
    later = F.when(state == "retry", F.expr(f"{asof} + INTERVAL {int(retry_hours)} HOURS"))
    return F.struct(state.alias("state"), later.alias("retry_after"))


def retry_state(failures: DataFrame, state: DataFrame, key: str = "url", retry_hours: int = 6) -> DataFrame:
    """Attempts added up, status and retry time of the newest failure; finished entries stay finished."""
    latest = failures.groupBy(key).agg(F.count(F.lit(1)).alias("new_attempts"),
                                       F.max_by("error", F.struct("failed_at", "event_id")).alias("error"),
                                       F.max("failed_at").alias("failed_at"))
    j = state.select(key, F.col("status").alias("__s"), F.col("attempts").alias("__a"),
                     F.col("retry_after").alias("__r")).join(latest, key, "full_outer")
    fresh = media_error_state(F.col("error"))
    closed = F.coalesce(F.col("__s").isin("gone", "invalid"), F.lit(False)) | F.col("error").isNull()
    return j.select(
        key, F.when(closed, F.col("__s")).otherwise(fresh).alias("status"),
        (F.coalesce("__a", F.lit(0)) + F.when(closed, 0).otherwise(F.coalesce("new_attempts", F.lit(0)))).cast("bigint").alias("attempts"),
        F.when(closed, F.col("__r")).otherwise(F.when(
            fresh == "retry", F.col("failed_at") + F.expr(f"INTERVAL {int(retry_hours)} HOURS"))).alias("retry_after"))


def resume_cursor(log: DataFrame, by=("source", "operation")) -> DataFrame:
    """Next page, pages done, saved, failed and done flag per scope from a page log (page, found, saved, failed)."""
    return log.groupBy(*by).agg(
        F.coalesce(F.max(F.when(F.col("found") > 0, F.col("page") + 1)), F.lit(1)).cast("bigint").alias("next_page"),
        F.count_if(F.col("found") > 0).alias("pages_done"), F.sum("saved").cast("bigint").alias("saved"),
        F.sum("failed").cast("bigint").alias("failed"), F.max(F.col("found") == 0).alias("done"))
