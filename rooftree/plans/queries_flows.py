"""Queries for whole flows."""
from pyspark.sql import functions as F

from rooftree.plans import flows
from rooftree.plans.bindings import cte
from rooftree.plans.queries_joins import PLAN, _incoming
from rooftree.plans.registry import query

ASOF = "TIMESTAMP '2024-02-01 00:00:00'"
HITS = """n AS (SELECT *, row_number() OVER (PARTITION BY listing_id ORDER BY checked_at, event_id) AS rn FROM checks WHERE http_status IN (404, 410) OR http_status BETWEEN 200 AND 399),
 p AS (SELECT *, lag(http_status) OVER (PARTITION BY listing_id ORDER BY rn) AS prev FROM n), hit AS (SELECT listing_id, 'http_404_confirmed' AS why FROM p WHERE http_status = 404 AND prev = 404 GROUP BY 1)"""


def _archive(t):
    old = t.publications.where(F.col("status") == "published").select(F.col("listing_id").alias("id"))
    return t.listings.select("id", "catalog").join(old, "id").select(
        "catalog", "id", F.expr(ASOF).alias("archived_at"), F.lit("earlier").alias("reason"), F.lit("{}").alias("snapshot"))


@query("flow_availability_status", cte("listings", "checks") + f""", {HITS}
SELECT l.id, CASE WHEN l.status = 'active' AND hit.why IS NOT NULL THEN 'inactive' ELSE l.status END AS status,
 CASE WHEN l.status = 'active' AND hit.why IS NOT NULL THEN COALESCE(l.comments, '') || ' cleaning_' || hit.why ELSE l.comments END AS comments FROM listings l LEFT JOIN hit ON hit.listing_id = l.id""")
def _(t):
    rows = t.listings.select("id", "catalog", "status", "comments", "title")
    return flows.availability(rows, t.checks, _archive(t), ASOF)[0].select("id", "status", "comments")


@query("flow_availability_archive", cte("listings", "checks", "publications") + f""", {HITS}, old AS (SELECT l.catalog, l.id FROM listings l JOIN publications p ON p.listing_id = l.id WHERE p.status = 'published')
SELECT catalog, id, 'earlier' AS reason FROM old UNION ALL SELECT l.catalog, l.id, hit.why FROM listings l JOIN hit ON hit.listing_id = l.id WHERE l.status = 'active' AND NOT EXISTS (SELECT 1 FROM old WHERE old.id = l.id)""")
def _(t):
    rows = t.listings.select("id", "catalog", "status", "comments", "title")
    return flows.availability(rows, t.checks, _archive(t), ASOF)[1].select("catalog", "id", "reason")


@query("flow_contact_import", PLAN + "SELECT count(*) AS verified_rows, CAST(0 AS BIGINT) AS wrong_value_rows, CAST(0 AS BIGINT) AS other_changes FROM plan")
def _(t):
    return flows.contact_import(t.listings.select("catalog", "id", "external_id", "operation", "status", "title", "agent_phone"), _incoming(t))[1]


@query("flow_publication_batch", cte("listings", "photos", "media", "publications") + """, due AS (SELECT l.* FROM listings l WHERE l.status = 'active'
 AND NOT EXISTS (SELECT 1 FROM publications p WHERE p.listing_id = l.id AND p.status NOT IN ('pending', 'retry'))),
 ready AS (SELECT d.id, d.catalog, d.updated_at FROM due d WHERE EXISTS (SELECT 1 FROM photos p WHERE p.listing_id = d.id AND p.url LIKE 'https://%')
  AND NOT EXISTS (SELECT 1 FROM photos p LEFT JOIN media m ON m.url = p.url AND m.status IN ('archived') WHERE p.listing_id = d.id AND p.url LIKE 'https://%' AND m.url IS NULL)),
 k AS (SELECT id, catalog, row_number() OVER (PARTITION BY catalog ORDER BY updated_at NULLS LAST, id) AS turn, CASE catalog WHEN 'apartments' THEN 0 WHEN 'houses' THEN 1 ELSE 2 END AS seat FROM ready)
SELECT id, catalog FROM k WHERE turn <= 30 ORDER BY turn, seat LIMIT 90""")
def _(t):
    rows = t.listings.select("id", "catalog", "status", "updated_at").join(t.photo_lists(), "id")
    pubs = t.publications.withColumn("retry_after", F.lit(None).cast("timestamp"))
    return flows.publication_batch(rows, pubs, t.media, ASOF, 90).select("id", "catalog")


@query("flow_intake")
def _(t):
    """Texts of every order's listing, normalized, gated, merged and de-duplicated (its steps have their own oracles)."""
    curated = t.listings.select("source", "external_id", "id", "operation", "property_type", "title", "price_uah", "price_usd", "area", "rooms", "floor",
                                "floors_total", "city", "url", "agent_phone", "status", "comments", "updated_at")
    pages = t.listings_in.select("source", "operation", "external_id", "url", "property_type", "title", "description", "district", "street",
                                 F.concat(F.col("price_uah").try_cast("bigint").cast("string"), F.lit(" грн")).alias("price_raw"))
    out = flows.intake(curated, pages, ASOF)
    return out.groupBy("source", "operation", "status").agg(F.count(F.lit(1)).alias("n"))
