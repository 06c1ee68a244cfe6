"""Work selection: rotating batches, fair interleaving, queues, position ranges, throttling."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rooftree.functions.text import is_blank
from rooftree.operators.skew import SLICE, attach_lookup, first_run, islands, ordinal, per_group_top

__all__ = ["balanced_batch", "round_robin", "oldest_first", "newest_first", "priority_queue", "inactive_backlog",
           "due_jobs", "islands", "chunk", "throttle_cut", "empty_rows"]


def balanced_batch(df: DataFrame, limit: int, by=("source", "operation"), order=("retry_count", "updated_at"),
                   buckets: int = 4, key: str = "id") -> DataFrame:
    """At most ``ceil(limit / buckets)`` rows per bucket, fewest retries and oldest first, then a global limit."""
    per_bucket = max(1, -(-limit // buckets))
    ranks = [F.col(o).asc_nulls_last() for o in order] + [F.col(key).asc()]
    top = per_group_top(df, list(by), ranks, per_bucket, "bucket_rank")
    return top.orderBy(F.col(order[0]).asc_nulls_last(), F.col(key).asc()).limit(limit)


def round_robin(df: DataFrame, group: str, groups: list[str], limit: int, order=("updated_at", "id")) -> DataFrame:
    """Interleave groups fairly: every group's first row, then every second row, and so on."""
    per_group = max(1, -(-limit // len(groups)))
    top = per_group_top(df.where(F.col(group).isin(*groups)), [group], [F.col(o).asc_nulls_last() for o in order],
                        per_group, "turn")
    seat = reduce(lambda acc, g: acc.when(F.col(group) == g[1], g[0]), list(enumerate(groups))[1:],
                  F.when(F.col(group) == groups[0], 0))
    return top.withColumn("seat", seat).orderBy("turn", "seat").limit(limit)


def oldest_first(df: DataFrame, ledger: DataFrame, by: list[str], n: int, on: str = "id",
                 ts_col: str = "checked_at") -> DataFrame:
    """Rotating selection per scope: never checked first, then the longest unchecked, id as tiebreak."""
    last = ledger.groupBy(on).agg(F.max(ts_col).alias(ts_col))
    joined = df.join(last, on, "left")
    return per_group_top(joined, by, [F.col(ts_col).asc_nulls_first(), F.col(on).asc()], n, "queue_rank")


def newest_first(df: DataFrame, key: str = "id") -> DataFrame:
    """Export order (a total order: newest first, then the larger id)."""
    return df.orderBy(F.col("updated_at").desc_nulls_last(), F.col(key).desc())


def priority_queue(df: DataFrame, state: DataFrame, asof: str, n: int, key: str = "url") -> DataFrame:
    """Ready URLs by priority: not finished, and not waiting for a later retry time."""
    waiting = state.where(F.col("status").isin("archived", "gone", "invalid")
                          | (F.col("retry_after") > F.expr(asof))).select(key)
    ready = df.join(waiting, key, "left_anti")
    return ready.orderBy(F.col("priority").asc(), F.col("source_updated_at").asc_nulls_last(), F.col(key).asc()).limit(n)


def inactive_backlog(df: DataFrame, n: int, key: str = "id") -> DataFrame:
    """Resumable batch of inactive rows, oldest first."""
    held = df.where(F.col("status").isin("inactive", "archived"))
    return held.orderBy(F.col("updated_at").asc_nulls_last(), F.col(key).asc()).limit(n)


def due_jobs(jobs: DataFrame, asof: str, n: int, key: str = "job_id") -> DataFrame:
    """Pending or retry jobs whose next attempt is due, by id."""
    now = F.expr(asof)
    due = F.col("status").isin("pending", "retry") & (F.coalesce(F.col("next_attempt_at"), now) <= now)
    return jobs.where(due).orderBy(F.col(key).asc()).limit(n)


def chunk(df: DataFrame, n: int, pos: str, by: list[str] | None = None, width: int = SLICE) -> DataFrame:
    """Number rows into batches of ``n`` along an integer position column."""
    by = by or []
    slice_by = F.floor(F.col(pos) / F.lit(width))
    out = ordinal(df, by, [F.col(pos).asc()], slice_by, "__rn")
    return out.withColumn("chunk_no", F.floor((F.col("__rn") - 1) / F.lit(n)).cast("bigint")).drop("__rn")


def throttle_cut(log: DataFrame, scope: list[str], pos: str, k: int = 3, code: int = 429, width: int = SLICE) -> DataFrame:
    """Per scope, everything after ``k`` throttled outcomes in a row is deferred."""
    along = F.floor(F.col(pos) / F.lit(width))
    ranked = ordinal(log, scope, [F.col(pos).asc()], along, "rn")
    cuts = first_run(log, scope, F.col(pos).cast("bigint"), F.col("http_status") == code, k, along).drop("run_value")
    out = attach_lookup(ranked, cuts, scope)
    return out.withColumn("deferred", F.coalesce(F.col(pos) > F.col("run_code"), F.lit(False))).drop("run_code")


def empty_rows(df: DataFrame, pos: str) -> DataFrame:
    """Positions of rows whose other cells are all blank."""
    cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns if c != pos]
    return df.where(is_blank(F.concat(*cells))).select(pos)
