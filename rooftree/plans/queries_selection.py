"""Queries for ranking, work selection, position ranges and throttling."""
from pyspark.sql import functions as F

from rooftree.operators import selection as W
from rooftree.operators.dedupe import first_occurrence
from rooftree.operators.quality import source_filter
from rooftree.plans.bindings import cte
from rooftree.plans.registry import query

L = cte("listings")


@query("first_occurrence", """SELECT conv_id, turn, role, turn = min(turn) OVER (PARTITION BY conv_id, role) AS is_first FROM conversations""")
def _(t):
    rows = t.conversations.select("conv_id", "turn", "role")
    return first_occurrence(rows, ["conv_id", "role"], "turn")


@query("balanced_batch", cte("jobs", "listings") + """, r AS (SELECT j.job_id AS id, l.source, l.operation, j.attempt_count AS retry_count, l.updated_at
 FROM jobs j JOIN listings l ON l.id = j.job_id WHERE j.status = 'failed' AND j.attempt_count < 5), k AS (
SELECT *, row_number() OVER (PARTITION BY source, operation ORDER BY retry_count, updated_at, id) AS bucket_rank FROM r)
SELECT id, source, operation, CAST(bucket_rank AS INT) AS bucket_rank FROM k WHERE bucket_rank <= 25 ORDER BY retry_count, id LIMIT 100""")
def _(t):
    rows = t.jobs.where((F.col("status") == "failed") & (F.col("attempt_count") < 5)).select(
        F.col("job_id").alias("id"), F.col("attempt_count").alias("retry_count"))
    rows = rows.join(t.listings.select("id", "source", "operation", "updated_at"), "id")
    return W.balanced_batch(rows, 100).select("id", "source", "operation", "bucket_rank")


@query("round_robin", L + """, k AS (SELECT id, catalog, row_number() OVER (PARTITION BY catalog ORDER BY updated_at NULLS LAST, id) AS turn,
 CASE catalog WHEN 'apartments' THEN 0 WHEN 'houses' THEN 1 ELSE 2 END AS seat FROM listings WHERE status = 'active')
SELECT id, catalog, CAST(turn AS INT) AS turn, seat FROM k WHERE turn <= 34 ORDER BY turn, seat LIMIT 100""")
def _(t):
    rows = t.listings.where(F.col("status") == "active").select("id", "catalog", "updated_at")
    return W.round_robin(rows, "catalog", ["apartments", "houses", "commercial"], 100).select("id", "catalog", "turn", "seat")


@query("islands", cte("checks") + """SELECT source, min(event_id) AS range_start, max(event_id) AS range_end FROM (
 SELECT source, event_id, event_id - row_number() OVER (PARTITION BY source ORDER BY event_id) AS grp FROM checks WHERE http_status = 404)
GROUP BY source, grp""")
def _(t):
    misses = t.checks.where(F.col("http_status") == 404)
    return W.islands(misses, "event_id", ["source"], width=512)


@query("islands_empty_blocks", """SELECT min(event_id) AS range_start, max(event_id) AS range_end FROM (
 SELECT event_id, event_id - row_number() OVER (ORDER BY event_id) AS grp FROM events WHERE event_type <> 'click') GROUP BY grp""")
def _(t):
    return W.islands(t.events.where(F.col("event_type") != "click"), "event_id", width=64)


@query("chunk_rows", cte("checks") + """SELECT event_id, source, CAST(floor((row_number() OVER (PARTITION BY source ORDER BY event_id) - 1) / 250) AS BIGINT) AS chunk_no FROM checks""")
def _(t):
    return W.chunk(t.checks.select("event_id", "source"), 250, "event_id", ["source"], width=1000)


@query("throttle_cut", cte("checks") + """, n AS (SELECT *, row_number() OVER (PARTITION BY source, operation ORDER BY event_id) AS rn FROM checks),
 f AS (SELECT source, operation, rn, rn - row_number() OVER (PARTITION BY source, operation ORDER BY rn) AS grp FROM n WHERE http_status = 429),
 cut AS (SELECT source, operation, min(s) + 2 AS pos FROM (SELECT source, operation, min(rn) AS s FROM f GROUP BY source, operation, grp HAVING count(*) >= 3) GROUP BY ALL)
SELECT n.event_id, n.source, n.operation, CAST(n.rn AS BIGINT) AS rn, COALESCE(n.rn > cut.pos, FALSE) AS deferred FROM n LEFT JOIN cut USING (source, operation)""")
def _(t):
    log = t.checks.select("event_id", "source", "operation", "http_status")
    return W.throttle_cut(log, ["source", "operation"], "event_id", width=2048).select("event_id", "source", "operation", "rn", "deferred")


@query("empty_rows", L + """SELECT id FROM listings WHERE COALESCE(title, '') = '' AND COALESCE(trim(description), '') = '' AND COALESCE(street, '') = ''""")
def _(t):
    return W.empty_rows(t.listings.select("id", "title", "description", "street"), "id")


@query("oldest_first", cte("listings", "checks", led="SELECT listing_id AS id, max(checked_at) AS checked_at FROM checks GROUP BY 1") + """
SELECT id, source, operation, CAST(queue_rank AS INT) AS queue_rank FROM (SELECT l.id, l.source, l.operation,
 row_number() OVER (PARTITION BY l.source, l.operation ORDER BY led.checked_at NULLS FIRST, l.id) AS queue_rank
 FROM listings l LEFT JOIN led USING (id) WHERE l.status = 'active') WHERE queue_rank <= 40""")
def _(t):
    rows = t.listings.where(F.col("status") == "active").select("id", "source", "operation")
    led = t.checks.select(F.col("listing_id").alias("id"), "checked_at")
    return W.oldest_first(rows, led, ["source", "operation"], 40).select("id", "source", "operation", "queue_rank")


@query("newest_first", L + "SELECT id, operation, updated_at FROM listings WHERE status = 'active' AND source NOT LIKE 'feed%' ORDER BY updated_at DESC NULLS LAST, id DESC")
def _(t):
    rows = source_filter(t.listings).where(F.col("status") == "active")
    return W.newest_first(rows.select("id", "operation", "updated_at"))


@query("priority_queue", cte("photos", "media") + """, q AS (SELECT url, min(pos) AS priority, max(shipped) AS source_updated_at FROM photos WHERE url LIKE 'https://%' GROUP BY url)
SELECT q.url, q.priority, q.source_updated_at FROM q LEFT JOIN media m USING (url)
WHERE m.url IS NULL OR (m.status NOT IN ('archived', 'gone', 'invalid') AND (m.retry_after IS NULL OR m.retry_after <= TIMESTAMP '2024-02-01 00:00:00'))
ORDER BY q.priority, q.source_updated_at NULLS LAST, q.url LIMIT 200""")
def _(t):
    q = t.photos.where(F.col("url").startswith("https://")).groupBy("url").agg(
        F.min("pos").alias("priority"), F.max("shipped").alias("source_updated_at"))
    return W.priority_queue(q, t.media, "TIMESTAMP '2024-02-01 00:00:00'", 200)


@query("inactive_backlog", L + "SELECT id, status, updated_at FROM listings WHERE status IN ('inactive', 'archived') ORDER BY updated_at NULLS LAST, id LIMIT 250")
def _(t):
    return W.inactive_backlog(t.listings.select("id", "status", "updated_at"), 250)


@query("due_jobs", cte("jobs") + """SELECT job_id, status, attempt_count FROM jobs WHERE status IN ('pending', 'retry')
 AND COALESCE(next_attempt_at, TIMESTAMP '1998-01-01 00:00:00') <= TIMESTAMP '1998-01-01 00:00:00' ORDER BY job_id LIMIT 500""")
def _(t):
    return W.due_jobs(t.jobs, "TIMESTAMP '1998-01-01 00:00:00'", 500).select("job_id", "status", "attempt_count")
