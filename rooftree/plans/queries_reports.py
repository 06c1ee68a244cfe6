"""Queries for counts, coverage, audits and the flagship flow."""
from pyspark.sql import functions as F

from rooftree.functions.facts import normalize_commission
from rooftree.operators import quality as Q
from rooftree.operators import reports as R
from rooftree.operators import sets as S
from rooftree.operators.dedupe import dedupe_by_fingerprint, dedupe_by_url
from rooftree.operators.values import merge_values_by_key
from rooftree.plans.bindings import MID, cte
from rooftree.plans.queries_filters import GATE, INTAKE, _towns
from rooftree.plans.queries_joins import PROJECT
from rooftree.plans.registry import query

L = cte("listings")
LIVE = "source NOT LIKE 'feed%'"


@query("status_counts", L + "SELECT status, count(*) AS n FROM listings GROUP BY status")
def _(t):
    return R.status_counts(t.listings)


@query("counts_by", L + "SELECT source, operation, status, count(*) AS n FROM listings GROUP BY ALL")
def _(t):
    return R.counts_by(t.listings, "source", "operation", "status")


FIELDS = {"rooms": "value", "area": "value", "floor": "value", "district": "text", "street": "text",
          "residential_complex": "text", "agent_type": "text", "commission": "text", "description": "long"}


def filled_sql(f, kind):
    return {"value": f"{f} IS NOT NULL", "text": f"COALESCE(trim({f}), '') <> ''", "long": f"COALESCE(length({f}), 0) > 30"}[kind]


PCTS = ", ".join(f"round(100.0 * count(*) FILTER ({filled_sql(f, k)}) / count(*), 2) AS {f}_pct" for f, k in FIELDS.items())
COVERAGE = f"SELECT source, operation, count(*) AS total, {PCTS} FROM {{src}} WHERE status = 'active' AND {LIVE} GROUP BY source, operation"


def _live(t):
    return Q.source_filter(t.listings).where(F.col("status") == "active")


@query("coverage_report", L + COVERAGE.format(src="listings"))
def _(t):
    return R.coverage_report(_live(t), FIELDS, ["source", "operation"])


@query("gap_report", L + "SELECT source, operation, count(*) AS total, " + ", ".join(
    f"count(*) FILTER (NOT ({filled_sql(f, k)})) AS no_{f}" for f, k in FIELDS.items())
    + f" FROM listings WHERE status = 'active' AND {LIVE} GROUP BY source, operation")
def _(t):
    return R.gap_report(_live(t), FIELDS, ["source", "operation"])


@query("duplicate_keys", L + """SELECT count(*) AS duplicate_keys, CAST(COALESCE(sum(c - 1), 0) AS BIGINT) AS excess_rows
FROM (SELECT url, count(*) AS c FROM listings GROUP BY url HAVING count(*) > 1)""")
def _(t):
    return R.duplicate_keys(t.listings, ["url"])


ASOF = "TIMESTAMP '2024-01-31 00:00:00'"


@query("freshness", cte("listings", "checks", led="SELECT listing_id, max(checked_at) AS checked_at FROM checks GROUP BY 1") + f"""
SELECT source, count(*) AS active, min(checked_at) AS oldest_checked_at, max(checked_at) AS newest_checked_at,
 count(*) FILTER (checked_at IS NULL) AS never_checked,
 count(*) FILTER (checked_at IS NULL OR checked_at < {ASOF} - INTERVAL 30 HOURS) AS not_checked_within
FROM listings l LEFT JOIN led ON led.listing_id = l.id WHERE status = 'active' AND {LIVE} GROUP BY source""")
def _(t):
    return R.freshness(_live(t), t.checks, ASOF, 30)


@query("stale_count", L + f"SELECT count(*) FILTER (status = 'active' AND updated_at < {MID} - INTERVAL 7 DAYS) AS stale FROM listings")
def _(t):
    return R.stale_count(t.listings, MID, 7)


@query("completeness_stats", L + """SELECT count(*) AS total, round(avg(data_completeness), 1) AS avg_score,
 count(*) FILTER (data_completeness >= 90) AS premium, count(*) FILTER (data_completeness < 50) AS weak FROM listings""")
def _(t):
    return R.completeness_stats(t.listings)


@query("top_reasons", cte("listings", g=f"SELECT CASE WHEN status = 'active' AND {LIVE} THEN {GATE} END AS r, status, comments FROM listings") + """
SELECT COALESCE(r, comments) AS reason, count(*) AS n FROM g WHERE r IS NOT NULL OR status = 'quarantine'
GROUP BY 1 ORDER BY n DESC, reason LIMIT 10""")
def _(t):
    return R.top_reasons(Q.quality_gate(t.listings))


@query("queue_report", cte("jobs", "results") + """
SELECT (SELECT count(*) FROM jobs) AS total_jobs, (SELECT count(*) FROM jobs WHERE status = 'done') AS done_jobs,
 (SELECT count(*) FROM jobs WHERE status = 'retry') AS retry_jobs, (SELECT count(*) FROM jobs WHERE status = 'failed') AS failed_jobs,
 count(*) AS results, count(*) FILTER (phone_count > 0) AS with_phone,
 round(100.0 * count(*) FILTER (phone_count > 0) / NULLIF(count(*), 0), 2) AS coverage_percent FROM results""")
def _(t):
    return R.queue_report(t.jobs, t.results)


@query("distinct_counts", """
SELECT count(*) AS row_count, count(DISTINCT l_partkey) AS distinct_l_partkey, count(DISTINCT l_orderkey) AS distinct_l_orderkey,
 (SELECT count(*) FROM orders) AS universe_rows, round(100.0 * count(DISTINCT l_orderkey) / NULLIF((SELECT count(*) FROM orders), 0), 2) AS coverage_pct FROM lineitem""")
def _(t):
    return R.distinct_counts(t.lineitem, ["l_partkey", "l_orderkey"], t.orders, "l_orderkey")


@query("media_states", cte("media") + "SELECT status, count(*) AS n, CAST(sum(byte_size) AS BIGINT) AS bytes FROM media GROUP BY status")
def _(t):
    return R.media_states(t.media)


@query("contact_report", f"SELECT source, count(*) AS records, count(*) FILTER (contact_method = 'public_phone') AS public_phone, "
       f"count(*) FILTER (contact_method = 'source_link') AS source_link, count(*) FILTER (needs_review) AS needs_review FROM ({PROJECT}) GROUP BY source")
def _(t):
    return R.contact_report(S.contact_projection(S.union_catalogs(t.catalogs())))


@query("mismatch_counts_by_status", cte("listings", "listings_in") + """
SELECT l.status, count(*) FILTER (l.title IS DISTINCT FROM i.title) AS title_differs, count(*) FILTER (l.price_uah IS DISTINCT FROM i.price_uah) AS price_differs
FROM listings l JOIN listings_in i USING (source, external_id) GROUP BY l.status""")
def _(t):
    new = t.listings_in.select("source", "external_id", F.col("title").alias("t2"), F.col("price_uah").alias("p2"))
    j = t.listings.join(new, ["source", "external_id"])
    return j.groupBy("status").agg(F.count_if(~F.col("title").eqNullSafe(F.col("t2"))).alias("title_differs"),
                                   F.count_if(~F.col("price_uah").eqNullSafe(F.col("p2"))).alias("price_differs"))


def _value_rows(t):
    """Part keys bought per supplier, in order sequence; odd suppliers of a key stay apart by position."""
    return t.lineitem.select(F.col("l_suppkey").cast("string").alias("k"), F.struct("l_orderkey", "l_linenumber", "l_partkey").alias("pos"),
                             F.when(F.col("l_returnflag") == "R", F.array()).otherwise(F.array(
                                 (F.col("l_partkey") % 20).cast("string"), F.col("l_linestatus"))).cast("array<string>").alias("vals"))


ROWS = """rows AS (SELECT CAST(l_suppkey AS VARCHAR) AS k, (l_orderkey, l_linenumber, l_partkey) AS pos, CAST(l_partkey % 20 AS VARCHAR) AS v0, l_linestatus AS v1
 FROM lineitem WHERE l_returnflag <> 'R'), items AS (SELECT k, v0 AS v, (pos, 0) AS ord FROM rows UNION ALL SELECT k, v1, (pos, 1) FROM rows),
 firsts AS (SELECT k, v, min(ord) AS ord FROM items GROUP BY k, v)"""


@query("merge_values_by_key", f"""WITH {ROWS}
SELECT f.k, f.merged, r.n_rows, r.conflict FROM (SELECT k, string_agg(v, ',' ORDER BY ord) AS merged FROM firsts GROUP BY k) f
JOIN (SELECT k, count(*) AS n_rows, count(DISTINCT v0 || '|' || v1) > 1 AS conflict FROM rows GROUP BY k) r USING (k)""")
def _(t):
    merged, _stats = merge_values_by_key(_value_rows(t), "k", "vals", "pos")
    return merged.select("k", F.array_join("merged", ",").alias("merged"), F.col("rows").alias("n_rows"), "conflict")


@query("merge_values_stats", f"""WITH {ROWS}, c AS (SELECT k, count(DISTINCT v0 || '|' || v1) > 1 AS conflict FROM rows GROUP BY k)
SELECT (SELECT count(*) FROM lineitem) AS source_rows, CAST(0 AS BIGINT) AS invalid_key_rows,
 (SELECT count(*) FROM lineitem WHERE l_returnflag = 'R') AS invalid_value_rows, (SELECT count(*) FROM c) AS unique_keys,
 (SELECT count(*) FROM c WHERE conflict) AS conflicting_keys,
 (SELECT count(*) FROM lineitem WHERE l_returnflag <> 'R') - (SELECT count(*) FROM c) AS duplicate_rows""")
def _(t):
    return merge_values_by_key(_value_rows(t), "k", "vals", "pos")[1]


@query("policy_summary", L + f"""SELECT operation, count(*) AS candidates, count(*) FILTER (contains(policy_reason, 'usd_')) AS price,
 count(*) FILTER (contains(policy_reason, 'outside_kyiv_region')) AS location FROM ({INTAKE}) WHERE policy_reason IS NOT NULL GROUP BY operation""")
def _(t):
    return R.policy_summary(Q.intake_policy(t.listings, region=_towns))


CHECKS = {"not_a_flat": "property_type <> 'Квартира'", "active_without_price": "status = 'active' AND (price_uah IS NULL OR price_uah <= 0)",
          "invalid_floor": "floor > floors_total", "negative_prices": "price_uah < 0 OR price_usd < 0",
          "bad_operation": "operation NOT IN ('rent', 'buy')", "no_url": "url IS NULL OR url = ''"}


@query("catalog_audit", L + " UNION ALL ".join(
    f"SELECT '{n}' AS check_name, count(*) AS value, count(*) > 0 AS failed FROM listings WHERE {c}" for n, c in CHECKS.items()))
def _(t):
    return R.catalog_audit(t.listings, CHECKS)


@query("fill_rate_issues", cte("listings", cov=COVERAGE.format(src="listings")) + """
SELECT source, operation, 'rooms' AS field, rooms_pct AS pct, CAST(90 AS DOUBLE) AS minimum FROM cov WHERE rooms_pct < 90
UNION ALL SELECT source, operation, 'area', area_pct, CAST(88 AS DOUBLE) FROM cov WHERE area_pct < 88""")
def _(t):
    return R.fill_rate_issues(R.coverage_report(_live(t), FIELDS, ["source", "operation"]), {"rooms": 90, "area": 88})


@query("photo_work_queue", cte("listings", "photos", "publications") + """
SELECT p.url, min(CASE WHEN b.status IN ('pending', 'retry') THEN 0 WHEN b.listing_id IS NULL THEN 1 ELSE 2 END) AS priority,
 max(l.updated_at) AS source_updated_at FROM listings l JOIN photos p ON p.listing_id = l.id LEFT JOIN publications b ON b.listing_id = l.id
WHERE l.status = 'active' AND p.url LIKE 'https://%' GROUP BY p.url""")
def _(t):
    rows = t.listings.join(t.photo_lists(), "id")
    return R.photo_work_queue(rows, t.publications)


FEE = ("CASE WHEN commission = 'Комісія 50' THEN 'Комісія 50%' WHEN commission = 'Без комісії!' THEN 'Без комісії' "
       "WHEN contains(description, 'без комісії') THEN 'Без комісії' WHEN contains(description, 'комісія 50%') THEN 'Комісія 50%' ELSE 'Не вказано' END")


@query("repair_report", L + f"""SELECT count(*) AS scanned, count(*) FILTER (v <> trim(COALESCE(commission, ''))) AS changed,
 count(*) FILTER (v <> trim(COALESCE(commission, '')) AND v NOT IN ('Не вказано', 'Комісія: умови уточнюються')) AS explicitly_extracted
FROM (SELECT commission, {FEE} AS v FROM listings)""")
def _(t):
    text = F.concat_ws(" ", "title", "description")
    fixed = t.listings.withColumn("fixed", normalize_commission("commission", text))
    return R.repair_report(fixed, "commission", "fixed", ["Не вказано", "Комісія: умови уточнюються"])


@query("cross_catalog_keys", L + "SELECT url, count(*) AS n FROM listings GROUP BY url HAVING count(DISTINCT catalog) > 1")
def _(t):
    return R.cross_catalog_keys(t.listings, "url")


RUNS = """SELECT run_id, operation, max(expected_pages) AS expected_pages, count(*) FILTER (ok) AS successful_pages, min(started_at) AS started_at,
 max(expected_pages) > 0 AND max(expected_pages) = count(*) FILTER (ok) AS complete FROM run_pages GROUP BY run_id, operation"""


@query("run_completeness", cte("run_pages") + RUNS)
def _(t):
    return R.run_completeness(t.run_pages)


@query("intake_stats", L + """SELECT source, operation, count(*) FILTER (o = 'parsed') AS parsed, count(*) FILTER (o = 'failed') AS failed,
 count(*) FILTER (o = 'filtered') AS filtered, count(*) FILTER (o = 'price_skip') AS price_skip FROM (SELECT source, operation,
 CASE WHEN title IS NULL THEN 'failed' WHEN property_type <> 'Квартира' THEN 'filtered'
  WHEN (operation = 'rent' AND price_uah >= 20000) OR (operation = 'buy' AND price_usd >= 60000) THEN 'parsed' ELSE 'price_skip' END AS o FROM listings) GROUP BY ALL""")
def _(t):
    ok = F.expr("(operation = 'rent' AND price_uah >= 20000) OR (operation = 'buy' AND price_usd >= 60000)")
    outcome = (F.when(F.col("title").isNull(), "failed").when(F.col("property_type") != "Квартира", "filtered")
               .when(ok, "parsed").otherwise("price_skip"))
    return R.intake_stats(t.listings.withColumn("outcome", outcome))


@query("image_shortfall", cte("photos") + """SELECT listing_id AS page_id, CAST(count(*) AS INTEGER) AS expected, CAST(count(*) FILTER (url LIKE 'https%') AS INTEGER) AS actual FROM photos
 GROUP BY 1 HAVING count(*) FILTER (url LIKE 'https%') < count(*)""")
def _(t):
    """Every listing's page shows its secure photos; all of its photos are expected."""
    want = t.photos.groupBy(F.col("listing_id").alias("page_id")).agg(F.count(F.lit(1)).cast("int").alias("expected"))
    image = F.when(F.col("url").startswith("https"), F.concat(F.lit('<p><img src="'), F.col("url"), F.lit('"></p>')))
    pages = t.photos.groupBy(F.col("listing_id").alias("page_id")).agg(F.array_join(F.collect_list(image), "").alias("html"))
    return R.shortfall(want, pages)


@query("document_label_coverage", """SELECT lang, count(*) AS total, round(100.0 * count(l.quality) / count(*), 2) AS quality_pct
FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY lang""")
def _(t):
    docs = t.documents.select("doc_id", "lang").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    return R.coverage_report(docs, {"quality": "value"}, ["lang"])


# ---- minimum slice: gate -> duplicates by URL -> duplicates by content -> coverage --------------
GATED = f"""SELECT * REPLACE (CASE WHEN r IS NOT NULL THEN 'quarantine' ELSE status END AS status) FROM
 (SELECT *, CASE WHEN status = 'active' AND {LIVE} THEN {GATE} END AS r FROM listings)"""
BY_URL = f"""SELECT g.* REPLACE (CASE WHEN k.keeper IS NOT NULL AND k.keeper <> g.id THEN 'inactive' ELSE g.status END AS status) FROM gated g LEFT JOIN
 (SELECT id, first_value(id) OVER (PARTITION BY url ORDER BY updated_at DESC NULLS LAST, id DESC) AS keeper FROM gated
  WHERE status = 'active' AND {LIVE} AND NULLIF(trim(url), '') IS NOT NULL) k USING (id)"""
BY_PRINT = rf"""SELECT g.* REPLACE (CASE WHEN k.keeper IS NOT NULL AND k.keeper <> g.id THEN 'inactive' ELSE g.status END AS status) FROM by_url g LEFT JOIN
 (SELECT id, first_value(id) OVER (PARTITION BY operation, lower(regexp_replace(trim(title), '\s+', ' ', 'g')), COALESCE(area, 0), COALESCE(price_uah, 0),
   regexp_replace(COALESCE(agent_phone, ''), '\D', '', 'g') ORDER BY updated_at DESC NULLS LAST, id DESC) AS keeper FROM by_url
  WHERE status = 'active' AND {LIVE} AND length(trim(title)) >= 30 AND COALESCE(area, 0) > 0 AND COALESCE(price_uah, 0) > 0
   AND length(regexp_replace(COALESCE(agent_phone, ''), '\D', '', 'g')) >= 10) k USING (id)"""


@query("flow_gate_dedupe_coverage", cte("listings", gated=GATED, by_url=BY_URL, by_print=BY_PRINT) + COVERAGE.format(src="by_print"))
def _(t):
    clean = dedupe_by_fingerprint(dedupe_by_url(Q.quality_gate(t.listings)))
    return R.coverage_report(Q.source_filter(clean).where(F.col("status") == "active"), FIELDS, ["source", "operation"])


@query("dedupe_by_url", cte("listings", gated="SELECT * FROM listings") + f"""
SELECT g.id, CASE WHEN k.keeper <> g.id THEN 'inactive' ELSE g.status END AS status,
 CASE WHEN k.keeper <> g.id THEN 'duplicate_url:' || CAST(k.keeper AS VARCHAR) ELSE g.comments END AS comments FROM gated g LEFT JOIN
 (SELECT id, first_value(id) OVER (PARTITION BY url ORDER BY updated_at DESC NULLS LAST, id DESC) AS keeper FROM gated
  WHERE status = 'active' AND {LIVE} AND NULLIF(trim(url), '') IS NOT NULL) k USING (id)""")
def _(t):
    return dedupe_by_url(t.listings).select("id", "status", "comments")


@query("dedupe_by_fingerprint", cte("listings", gated="SELECT * FROM listings", by_url=BY_URL, by_print=BY_PRINT) + "SELECT id, status FROM by_print")
def _(t):
    return dedupe_by_fingerprint(dedupe_by_url(t.listings)).select("id", "status")
