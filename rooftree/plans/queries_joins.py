"""Queries for joins, set operations and import plans."""
from pyspark.sql import functions as F

from rooftree.operators import lookups as J
from rooftree.operators import sets as S
from rooftree.operators.dedupe import cross_source_duplicates
from rooftree.operators.state import attempt_ledger
from rooftree.plans.bindings import ASOF, cte
from rooftree.plans.registry import query

L = cte("listings")
LI = cte("listings", "listings_in")


@query("join_raw", cte("listings", "publications") + """SELECT l.id AS listing_id, l.url, p.status, p.n FROM listings l JOIN publications p ON p.listing_id = l.id""")
def _(t):
    return J.join_raw(t.listings.select(F.col("id").alias("listing_id"), "url"), t.publications.select("listing_id", "status", "n"), ("listing_id",), ("status", "n"))


LEDGER = cte("listings", "checks", led="SELECT listing_id AS id, max(checked_at) AS attempted_at FROM checks GROUP BY listing_id")


@query("due_for_attempt", LEDGER + f"""
SELECT l.id, l.status FROM listings l LEFT JOIN led ON led.id = l.id
WHERE led.attempted_at IS NULL OR led.attempted_at < {ASOF} - INTERVAL 3 DAYS""")
def _(t):
    led = attempt_ledger(t.checks, "listing_id", "checked_at").withColumnRenamed("listing_id", "id")
    return J.due_for_attempt(t.listings, led, ASOF, 3).select("id", "status")


@query("below_version", cte("listings", "results") + """
SELECT l.id FROM listings l LEFT JOIN results r ON r.job_id = l.id WHERE r.phone_count IS NULL OR r.phone_count < 2""")
def _(t):
    led = t.results.select(F.col("job_id").alias("id"), F.col("phone_count").alias("version"))
    return J.below_version(t.listings, led, 2).select("id")


@query("not_archived", cte("listings", "publications") + """
SELECT l.id, l.catalog FROM listings l LEFT JOIN publications p ON p.listing_id = l.id AND p.status = 'published'
WHERE l.status IN ('inactive', 'archived') AND p.listing_id IS NULL""")
def _(t):
    gone = t.listings.where(F.col("status").isin("inactive", "archived")).select("id", "catalog")
    done = t.publications.where(F.col("status") == "published").select(F.col("listing_id").alias("id"))
    return J.not_archived(gone, done, ("id",))


@query("new_ids", LI + """, q AS (
SELECT i.source, i.operation, i.external_id, k.external_id IS NOT NULL AS is_known, i.id AS pos FROM listings_in i
LEFT JOIN listings k ON k.source = i.source AND k.operation = i.operation AND k.external_id = i.external_id),
r AS (SELECT *, row_number() OVER (PARTITION BY source, operation, is_known ORDER BY pos) AS n FROM q),
c AS (SELECT *, row_number() OVER (PARTITION BY source, operation ORDER BY is_known, pos) AS queue_rank FROM r WHERE NOT is_known OR n <= 50)
SELECT source, operation, external_id, is_known, CAST(queue_rank AS INT) AS queue_rank FROM c WHERE queue_rank <= 600""")
def _(t):
    seen = t.listings_in.select("source", "operation", "external_id", F.col("id").alias("pos"))
    return J.new_ids(seen, t.listings, 50, 600).drop("pos")


PL = cte("photos", lists="SELECT listing_id AS id, url FROM photos")


@query("exists_filter", PL + "SELECT DISTINCT id FROM lists WHERE url LIKE 'https://%'")
def _(t):
    return J.exists_filter(t.photo_lists(), "photos", lambda u: u.startswith("https://")).select("id")


@query("not_exists_filter", cte("photos", "media", lists="SELECT listing_id AS id, url FROM photos") + """
SELECT DISTINCT id FROM lists l WHERE NOT EXISTS (SELECT 1 FROM lists x LEFT JOIN media m ON m.url = x.url AND m.status IN ('archived', 'gone', 'retry')
 WHERE x.id = l.id AND x.url LIKE 'https://%' AND m.url IS NULL)""")
def _(t):
    stored = t.media.where(F.col("status").isin("archived", "gone", "retry"))
    return J.not_exists_filter(t.photo_lists(), "photos", lambda u: u.startswith("https://"), stored, "url").select("id")


@query("cross_source_duplicates", L + r""", x AS (SELECT id, source, title, COALESCE(area, 0) AS area, COALESCE(district, '') AS district,
 COALESCE(price_uah, 0) AS price, regexp_replace(COALESCE(agent_phone, ''), '\D', '', 'g') AS phone, operation FROM listings
 WHERE status = 'active' AND source NOT LIKE 'feed%')
SELECT DISTINCT a.id FROM x a JOIN x b ON a.title = b.title AND a.area = b.area AND a.district = b.district AND a.price = b.price
 AND a.phone = b.phone AND a.operation = b.operation AND a.id > b.id AND a.source <> b.source
WHERE length(a.title) > 20 AND length(a.phone) >= 10""")
def _(t):
    return cross_source_duplicates(t.listings)


@query("identity_overlap", LI + "SELECT DISTINCT source, external_id FROM listings WHERE (source, external_id) IN (SELECT source, external_id FROM listings_in)")
def _(t):
    return J.identity_overlap(t.listings, t.listings_in)


@query("orphans", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT c_custkey FROM customer)")
def _(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return J.orphans(lines, t.customer, "l_partkey", "c_custkey").select("l_orderkey", "l_linenumber", "l_partkey")


@query("attach_notes", cte("listings", "notes", last="SELECT catalog, listing_id, max_by(note, pos) AS note FROM notes WHERE note <> '' GROUP BY ALL") + """
SELECT l.id, l.catalog, COALESCE(n.note, l.comments) AS comments FROM listings l LEFT JOIN last n ON n.catalog = l.catalog AND n.listing_id = CAST(l.id AS VARCHAR)""")
def _(t):
    last = t.notes.where(F.col("note") != "").groupBy("catalog", "listing_id").agg(F.max_by("note", "pos").alias("note"))
    return J.attach_notes(t.listings.select("id", "catalog", "comments"), last)


PHONES = """SELECT external_id, list(DISTINCT agent_phone ORDER BY agent_phone) AS phones FROM listings_in
 WHERE agent_phone <> '' GROUP BY external_id"""


def _incoming(t):
    rows = t.listings_in.where(F.col("agent_phone") != "").select("external_id", "agent_phone").distinct()
    return rows.groupBy("external_id").agg(F.array_sort(F.collect_list("agent_phone")).alias("phones"))


PLAN = cte("listings", "listings_in", ph=PHONES, plan=r"""SELECT l.catalog, l.id, l.external_id, l.operation, l.status, COALESCE(l.agent_phone, '') AS old_value,
 CASE WHEN l.agent_phone LIKE '+380%' AND NOT list_contains(p.phones, l.agent_phone) THEN l.agent_phone || ' ' || array_to_string(p.phones, ' ')
      ELSE array_to_string(p.phones, ' ') END AS new_value FROM listings l JOIN ph p ON p.external_id = l.external_id""")


@query("import_plan", PLAN + "SELECT *, old_value <> new_value AS needs_update FROM plan")
def _(t):
    return J.plan_import(t.listings, _incoming(t))[0]


@query("import_plan_stats", PLAN + """
SELECT count(DISTINCT external_id) AS matched_keys, count(*) AS matched_rows, count(*) FILTER (status = 'active') AS matched_active_rows,
 count(*) FILTER (old_value <> new_value) AS rows_to_update,
 (SELECT count(*) FROM (SELECT external_id FROM plan GROUP BY 1 HAVING count(DISTINCT catalog) > 1)) AS cross_catalog_keys,
 count(*) FILTER (old_value = new_value) AS rows_current,
 (SELECT count(*) FROM ph WHERE external_id NOT IN (SELECT external_id FROM listings)) AS unmatched_keys FROM plan""")
def _(t):
    return J.plan_import(t.listings, _incoming(t))[1]


MEDIA = cte("photos", "media", u="""SELECT listing_id AS id, url, min((pos, tie)) AS ord FROM photos WHERE url LIKE 'https://%' GROUP BY 1, 2""",
            j="""SELECT u.id, u.url, u.ord, 'https://media.example/' || m.storage_key AS shown FROM u LEFT JOIN media m ON m.url = u.url AND m.status = 'archived'""")


@query("resolve_media_hold", MEDIA + """SELECT p.id, CASE WHEN count(*) FILTER (url IS NOT NULL AND shown IS NULL) = 0 THEN string_agg(shown, ',' ORDER BY ord) END AS media
 FROM (SELECT DISTINCT listing_id AS id FROM photos) p LEFT JOIN j ON j.id = p.id GROUP BY p.id""")
def _(t):
    archive = t.media.withColumn("source_sha256", F.sha2("url", 256))
    out = J.resolve_media(t.photo_lists(), archive, "https://media.example")
    return out.select("id", F.array_join("media", ",").alias("media"))


@query("resolve_media_source", MEDIA + """SELECT p.id, string_agg(COALESCE(shown, url), ',' ORDER BY ord) AS media
 FROM (SELECT DISTINCT listing_id AS id FROM photos) p LEFT JOIN j ON j.id = p.id GROUP BY p.id""")
def _(t):
    archive = t.media.withColumn("source_sha256", F.sha2("url", 256))
    out = J.resolve_media(t.photo_lists(), archive, "https://media.example", "source")
    return out.select("id", F.array_join("media", ",").alias("media"))


TARGET = LI + """, a AS (SELECT source, external_id, operation, min(id) AS listing_id FROM listings WHERE status = 'active' GROUP BY ALL)
SELECT i.id, a.listing_id, a.listing_id IS NULL AS rejected FROM listings_in i LEFT JOIN a USING (source, external_id, operation)"""


@query("publication_targets", TARGET)
def _(t):
    pubs = t.listings_in.select("id", "source", "external_id", "operation")
    ok, rejected = J.publication_targets(pubs, t.listings)
    out = ok.withColumn("rejected", F.lit(False)).unionByName(rejected.withColumn("rejected", F.lit(True)))
    return out.select("id", "listing_id", "rejected")


@query("catalog_columns", cte("listings", "publications") + """
SELECT p.listing_id, l.catalog, p.status AS publication, l.area, l.district FROM publications p JOIN listings l ON l.id = p.listing_id""")
def _(t):
    pubs = t.publications.join(t.listings.select(F.col("id").alias("listing_id"), "catalog"), "listing_id")
    out = J.with_catalog_columns(pubs, t.catalogs(), ["area", "district"])
    return out.select("listing_id", "catalog", F.col("status").alias("publication"), "area", "district")


@query("classify_ids", LI + """
SELECT i.source, i.operation, CASE WHEN l.status IS NULL THEN 'missing' WHEN l.status = 'active' THEN 'active' ELSE 'other' END AS state, count(*) AS n
FROM listings_in i LEFT JOIN listings l USING (source, operation, external_id) GROUP BY ALL""")
def _(t):
    return J.classify_ids(t.listings_in, t.listings)


@query("lifecycle_join", cte("listings", "jobs") + """
SELECT l.id, j.job_id IS NOT NULL AND l.status <> j.status AS status_changed,
 j.job_id IS NOT NULL AND l.updated_at IS DISTINCT FROM j.next_attempt_at AS updated_at_changed,
 CASE WHEN j.job_id IS NULL THEN 'append' WHEN l.status <> j.status OR l.updated_at IS DISTINCT FROM j.next_attempt_at THEN 'update' ELSE 'unchanged' END AS action
FROM listings l LEFT JOIN jobs j ON j.job_id = l.id AND j.status <> 'pending'""")
def _(t):
    mirror = t.jobs.where(F.col("status") != "pending").select(F.col("job_id").alias("id"), "status", F.col("next_attempt_at").alias("updated_at"))
    out = J.lifecycle_join(t.listings.select("id", "status", "updated_at"), mirror)
    return out.select("id", "status_changed", "updated_at_changed", "action")


@query("orphan_migration", """SELECT l_partkey AS id, min_by(l_orderkey, (l_orderkey, l_linenumber, l_suppkey)) AS first_order, 'inactive' AS status
FROM lineitem WHERE l_partkey NOT IN (SELECT c_custkey FROM customer) AND l_partkey NOT IN (SELECT user_id FROM events) GROUP BY 1""")
def _(t):
    copy = t.lineitem.select(F.col("l_partkey").alias("id"), F.struct("l_orderkey", "l_linenumber", "l_suppkey").alias("pos"),
                             F.col("l_orderkey").alias("first_order"))
    known = t.customer.select(F.col("c_custkey").alias("id"))
    life = t.events.select(F.col("user_id").alias("id"))
    return J.orphan_migration(copy, known, life).select("id", "first_order", "status")


@query("remove_inactive", cte("listings", "results") + """
SELECT r.job_id AS id FROM results r LEFT JOIN listings l ON l.id = r.job_id WHERE l.status <> 'active' OR l.status IS NULL""")
def _(t):
    copy = t.results.select(F.col("job_id").alias("id"))
    lost = J.orphans(copy, t.listings.select("id"), "id", "id")
    return J.remove_inactive(copy, t.listings, lost)


RATES = "SELECT 40.0 + max(n_regionkey) / 8.0 AS usd, 44.0 + max(n_nationkey) / 32.0 AS eur FROM nation"


@query("convert_with_rates", cte("listings", rates=RATES) + """
SELECT id, CAST(round_even(price_usd * usd, 0) AS DOUBLE) AS price_usd_uah, CAST(round_even(price_usd, 0) AS DOUBLE) AS price_usd_usd,
 CAST(round_even(price_usd * usd / eur, 0) AS DOUBLE) AS price_usd_eur FROM listings, rates""")
def _(t):
    rates = t.nation.agg((F.lit(40.0) + F.max("n_regionkey") / 8.0).alias("usd"), (F.lit(44.0) + F.max("n_nationkey") / 32.0).alias("eur"))
    out = J.convert_with_rates(t.listings.select("id", "price_usd", F.lit("USD").alias("cur")), rates, "price_usd", "cur")
    return out.drop("price_usd", "cur")


@query("result_by_job", cte("jobs", "results") + "SELECT j.status, r.coverage_status, count(*) AS cnt FROM jobs j LEFT JOIN results r USING (job_id) GROUP BY ALL")
def _(t):
    return J.result_by_job(t.jobs, t.results)


CONTACT = r"""SELECT catalog, id AS listing_id, lower(source) AS source, external_id, COALESCE(agent_phone, '') AS contact_phone,
 regexp_matches(COALESCE(title, '') || ' ' || COALESCE(description, ''), '\+?38[\s()\-]*0\d(?:[\s()\-]*\d){8}|0\d(?:[\s()\-]*\d){8}') AS cand FROM listings"""
PROJECT = cte("listings", c=CONTACT) + """SELECT catalog, listing_id, source, external_id, CASE WHEN trim(contact_phone) <> '' THEN contact_phone ELSE '' END AS contact_phone,
 CASE WHEN trim(contact_phone) <> '' THEN 'public_phone' ELSE 'source_link' END AS contact_method,
 CASE WHEN trim(contact_phone) <> '' THEN 'public_listing_field' WHEN source = 'olx' AND cand THEN 'public_text_candidate' ELSE '' END AS phone_origin,
 trim(contact_phone) = '' AND source = 'olx' AND cand AS needs_review FROM c"""


@query("union_catalogs", cte("listings", c=CONTACT) + "SELECT catalog, listing_id, source, external_id, contact_phone, cand AS text_phone_candidate FROM c")
def _(t):
    return S.union_catalogs(t.catalogs()).select("catalog", "listing_id", "source", "external_id", "contact_phone", "text_phone_candidate")


@query("contact_projection", PROJECT)
def _(t):
    return S.contact_projection(S.union_catalogs(t.catalogs())).select(
        "catalog", "listing_id", "source", "external_id", "contact_phone", "contact_method", "phone_origin", "needs_review")


@query("with_manual", cte("listings", "notes") + """
SELECT CAST(id AS VARCHAR) AS id, source, title, price_uah FROM listings UNION ALL
SELECT 'manual:' || listing_id || ':' || CAST(pos AS VARCHAR), 'manual', note, NULL FROM notes""")
def _(t):
    rows = t.listings.select(F.col("id").cast("string").alias("id"), "source", "title", "price_uah")
    manual = t.notes.select(F.concat(F.lit("manual:"), "listing_id", F.lit(":"), F.col("pos").cast("string")).alias("id"),
                            F.lit("manual").alias("source"), F.col("note").alias("title"))
    return S.with_manual(rows, manual)


@query("ids_minus", LI + "SELECT external_id FROM listings EXCEPT SELECT external_id FROM listings_in")
def _(t):
    return S.ids_minus(t.listings, t.listings_in, "external_id")


@query("ids_intersect", LI + "SELECT external_id FROM listings INTERSECT SELECT external_id FROM listings_in")
def _(t):
    return S.ids_intersect(t.listings, t.listings_in, "external_id")
