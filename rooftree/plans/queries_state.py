"""Queries for availability, absence, jobs, retries and cursors (batch folds and the streaming form)."""
import uuid

from pyspark.sql import functions as F

from rooftree.operators import state as S
from rooftree.operators.reports import run_completeness
from rooftree.plans.bindings import cte
from rooftree.plans.queries_reports import RUNS
from rooftree.plans.registry import query
from rooftree.session import ROCKSDB, scratch_dir
from rooftree.streaming.availability import availability_stream

ASOF = "TIMESTAMP '2024-02-01 00:00:00'"
STATE = cte("checks") + """, b AS (SELECT listing_id, max(checked_at) AS last_checked_at, max((checked_at, event_id)) FILTER (http_status BETWEEN 200 AND 399) AS ok FROM checks GROUP BY 1),
 m AS (SELECT c.listing_id, count(*) AS missing FROM checks c JOIN b USING (listing_id) WHERE c.http_status IN (404, 410) AND (b.ok IS NULL OR (c.checked_at, c.event_id) > b.ok) GROUP BY 1)
SELECT b.listing_id, {checked} AS last_checked, {seen} AS last_seen, COALESCE(m.missing, 0) AS missing,
 CASE WHEN COALESCE(m.missing, 0) >= 2 THEN 'inactive' ELSE 'active' END AS status FROM b LEFT JOIN m USING (listing_id)"""
OK_TS = "(SELECT max(checked_at) FROM checks c WHERE c.listing_id = b.listing_id AND c.http_status BETWEEN 200 AND 399)"


@query("availability_state", STATE.format(checked="b.last_checked_at", seen=OK_TS))
def _(t):
    out = S.availability_state(t.checks)
    return out.select("listing_id", F.col("last_checked_at").alias("last_checked"), F.col("last_seen_at").alias("last_seen"), "missing", "status")


@query("availability_stream", STATE.format(checked="epoch_us(b.last_checked_at)", seen=f"epoch_us({OK_TS})"))
def _(t):
    spark = t.spark
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    try:
        work = f"{scratch_dir(spark)}/availability-{uuid.uuid4().hex}"
        sink = lambda batch, n: batch.withColumn("batch_no", F.lit(n)).write.mode("overwrite").parquet(f"{work}/out/b={n}")
        run = (availability_stream(t.stream_view("checks")).writeStream.outputMode("update").foreachBatch(sink)
               .option("checkpointLocation", f"{work}/checkpoint").trigger(availableNow=True).start())
        run.awaitTermination()
    finally:
        if before is None:
            spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
        else:
            spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    updates = spark.read.parquet(f"{work}/out")
    last = updates.groupBy("listing_id").agg(F.max_by(F.struct("last_checked_us", "last_seen_us", "missing", "status"), "batch_no").alias("s"))
    return last.select("listing_id", F.col("s.last_checked_us").alias("last_checked"), F.col("s.last_seen_us").alias("last_seen"), "s.missing", "s.status")


@query("confirmed_once", cte("checks") + """, n AS (SELECT *, row_number() OVER (PARTITION BY listing_id ORDER BY checked_at, event_id) AS rn FROM checks
  WHERE http_status IN (404, 410) OR http_status BETWEEN 200 AND 399),
 p AS (SELECT *, lag(http_status) OVER (PARTITION BY listing_id ORDER BY rn) AS prev FROM n), hit AS (SELECT listing_id, min(rn) AS rn FROM p
  WHERE http_status IN (404, 410) AND prev IN (404, 410) GROUP BY 1)
SELECT n.listing_id, n.event_id, n.checked_at AS confirmed_at, 'http_' || CAST(n.http_status AS VARCHAR) || '_confirmed' AS reason FROM n JOIN hit USING (listing_id, rn)""")
def _(t):
    return S.confirmed_once(t.checks)


@query("absence_by_run", cte("run_pages", runs=RUNS) + """, done AS (SELECT *, row_number() OVER (PARTITION BY operation ORDER BY started_at, run_id) AS run_no FROM runs WHERE complete),
 tot AS (SELECT operation, max(run_no) AS total FROM done GROUP BY 1),
 seen AS (SELECT p.operation, p.listing_id, max(d.run_no) AS last_run FROM run_pages p JOIN done d ON d.run_id = p.run_id AND d.operation = p.operation WHERE p.ok GROUP BY ALL)
SELECT operation, listing_id, total - last_run AS missing_complete_runs, CASE WHEN total - last_run >= 2 THEN 'inactive' ELSE 'active' END AS status,
 CASE WHEN total - last_run >= 2 THEN 'inactive after two complete collections' WHEN total > last_run THEN 'absent from complete collection' ELSE 'seen in complete collection' END AS note
FROM seen JOIN tot USING (operation)""")
def _(t):
    runs = run_completeness(t.run_pages)
    return S.absence_by_run(runs, t.run_pages.where("ok").select("operation", "run_id", "listing_id"))


@query("job_transition", cte("jobs", "outcomes") + """, x AS (SELECT j.job_id, j.attempt_count + 1 AS n, o.* EXCLUDE (job_id) FROM jobs j JOIN outcomes o USING (job_id)),
 y AS (SELECT *, n < 6 AS again, COALESCE(listing_status <> 200, TRUE) AS page_bad, n < 6 AND COALESCE(listing_status IN (403, 429, 500, 502, 503, 504), FALSE) AS page_retry,
  n < 6 AND (phone_status IS NULL OR phone_status IN (401, 403, 429, 500, 502, 503, 504)) AS phone_retry FROM x),
 z AS (SELECT *, CASE WHEN failed THEN CASE WHEN again THEN 'retry' ELSE 'failed' END WHEN page_bad THEN CASE WHEN page_retry THEN 'retry' ELSE 'failed' END
  WHEN ad_id IS NULL THEN 'failed' WHEN phone_count > 0 THEN 'done' WHEN phone_retry THEN 'retry' ELSE 'failed' END AS status FROM y)
SELECT job_id, n AS attempt_count, status, CASE WHEN failed THEN CASE WHEN again THEN 'blocked' ELSE 'failed' END WHEN page_bad THEN CASE WHEN page_retry THEN 'blocked' ELSE 'not_found' END
  WHEN ad_id IS NULL THEN 'needs_review' WHEN phone_count > 0 THEN 'found' WHEN phone_retry THEN 'blocked' ELSE 'not_found' END AS coverage_status,
 CASE WHEN status = 'retry' THEN TIMESTAMP '2024-02-01 00:00:00' + to_minutes(CASE WHEN failed THEN 60 WHEN page_bad THEN 30 ELSE 45 END) END AS next_attempt_at FROM z""")
def _(t):
    return S.job_transition(t.jobs, t.outcomes, ASOF).withColumn("next_attempt_at", F.col("next_attempt_at").cast("timestamp_ntz"))


@query("attempt_ledger", cte("checks") + "SELECT listing_id, max(checked_at) AS attempted_at FROM checks GROUP BY 1")
def _(t):
    return S.attempt_ledger(t.checks, "listing_id", "checked_at")


@query("seen_range", cte("checks") + "SELECT listing_id, min(checked_at) AS first_seen_at, max(checked_at) AS last_seen_at FROM checks WHERE http_status = 200 GROUP BY 1")
def _(t):
    return S.seen_range(t.checks.where(F.col("http_status") == 200), "listing_id", "checked_at")


ERROR = """CASE event_type WHEN 'error' THEN '404 Client Error: not found' WHEN 'signup' THEN 'FLOOD_WAIT_' || CAST(user_id AS STRING)
 WHEN 'purchase' THEN 'unsupported image response: text/html' WHEN 'view' THEN 'Media archive pending for 3 photo(s)' ELSE 'Connection reset by peer, timeout' END"""


@query("classify_media_error", f"""SELECT event_id, CASE WHEN contains(e, '404 Client') THEN 'gone' WHEN contains(e, 'unsupported image') THEN 'invalid' ELSE 'retry' END AS state,
 CASE WHEN NOT contains(e, '404 Client') AND NOT contains(e, 'unsupported image') THEN TIMESTAMP '2024-02-01 06:00:00' END AS retry_after,
 contains(e, 'Connection reset') AS transient FROM (SELECT event_id, {ERROR} AS e FROM events)""")
def _(t):
    rows = t.events.selectExpr("event_id", f"{ERROR} AS e")
    c = S.classify_error(F.col("e"), ASOF)
    return rows.select("event_id", c["state"].alias("state"), c["retry_after"].cast("timestamp_ntz").alias("retry_after"), S.is_transient(F.col("e")).alias("transient"))


@query("classify_publish_error", f"""SELECT event_id, 'retry' AS status, CASE WHEN e LIKE 'FLOOD%' THEN TIMESTAMP '2024-02-01 00:00:00' + to_seconds(user_id + 15)
 WHEN e LIKE 'Media archive%' THEN TIMESTAMP '2024-02-01 00:10:00' END AS retry_after FROM (SELECT event_id, user_id, {ERROR} AS e FROM events)""")
def _(t):
    rows = t.events.selectExpr("event_id", f"{ERROR} AS e")
    c = S.publish_error(F.col("e"), ASOF)
    return rows.select("event_id", c["status"].alias("status"), c["retry_after"].cast("timestamp_ntz").alias("retry_after"))


@query("retry_state", cte("media") + f""", f AS (SELECT 'https://cdn.example/' || CAST(user_id AS VARCHAR) || '.jpg' AS url, event_id, ts, {ERROR} AS e FROM events),
 g AS (SELECT url, count(*) AS n, max_by(e, (ts, event_id)) AS e, max(ts) AS ts FROM f GROUP BY url),
 h AS (SELECT url, m.status AS s, m.attempts AS a, m.retry_after AS r, g.n, g.e, g.ts, COALESCE(m.status IN ('gone', 'invalid'), FALSE) OR g.e IS NULL AS closed,
  CASE WHEN contains(g.e, '404 Client') THEN 'gone' WHEN contains(g.e, 'unsupported image') THEN 'invalid' ELSE 'retry' END AS fresh FROM media m FULL JOIN g USING (url))
SELECT url, CASE WHEN closed THEN s ELSE fresh END AS status, CAST(COALESCE(a, 0) + CASE WHEN closed THEN 0 ELSE COALESCE(n, 0) END AS BIGINT) AS attempts,
 CASE WHEN closed THEN r WHEN fresh = 'retry' THEN ts + INTERVAL 6 HOURS END AS retry_after FROM h""")
def _(t):
    fails = t.events.selectExpr("'https://cdn.example/' || CAST(user_id AS STRING) || '.jpg' AS url", "event_id", "ts AS failed_at", f"{ERROR} AS error")
    out = S.retry_state(fails, t.media)
    return out.withColumn("retry_after", F.col("retry_after").cast("timestamp_ntz"))


@query("reclassify_gone", cte("jobs") + """SELECT job_id, CASE WHEN status = 'failed' AND attempt_count IN (1, 2) THEN 'gone' ELSE status END AS parse_status FROM jobs""")
def _(t):
    msg = F.when(F.col("attempt_count") == 1, "HTTP 404").when(F.col("attempt_count") == 2, "http 410").otherwise("HTTP 404 then HTTP 500")
    rows = t.jobs.select("job_id", F.col("status").alias("parse_status"), msg.alias("error_message"))
    return S.reclassify_gone(rows).select("job_id", "parse_status")


PAGE_LOG = """SELECT CASE WHEN user_id % 3 = 0 THEN 'rieltor' ELSE 'olx' END AS source, CASE WHEN user_id % 2 = 0 THEN 'rent' ELSE 'buy' END AS operation,
 event_id AS page, CASE WHEN event_type = 'signup' THEN 0 ELSE user_id END AS found, user_id % 7 AS saved, user_id % 2 AS failed FROM events"""


@query("resume_cursor", f"""SELECT source, operation, COALESCE(max(page + 1) FILTER (found > 0), 1) AS next_page, count(*) FILTER (found > 0) AS pages_done,
 CAST(sum(saved) AS BIGINT) AS saved, CAST(sum(failed) AS BIGINT) AS failed, bool_or(found = 0) AS done FROM ({PAGE_LOG}) GROUP BY ALL""")
def _(t):
    log = t.checks.select("event_id", "source", "operation").join(t.events.select("event_id", "user_id", "event_type"), "event_id")
    found = F.when(F.col("event_type") == "signup", 0).otherwise(F.col("user_id"))
    return S.resume_cursor(log.select("source", "operation", F.col("event_id").alias("page"), found.alias("found"),
                                      (F.col("user_id") % 7).alias("saved"), (F.col("user_id") % 2).alias("failed")))
