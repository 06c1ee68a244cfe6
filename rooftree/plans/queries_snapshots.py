"""Queries for snapshot mutations, change detection and reconciliation."""
from pyspark.sql import functions as F

from rooftree import defaults as D
from rooftree.functions import copygen
from rooftree.functions.facts import normalize_commission
from rooftree.operators import reconcile as RC
from rooftree.operators import sets as ST
from rooftree.operators import snapshots as S
from rooftree.plans.bindings import cte
from rooftree.plans.queries_filters import COPY_BAD, LIVE
from rooftree.plans.queries_joins import PROJECT
from rooftree.plans.registry import query
from rooftree.session import staged

ASOF = "TIMESTAMP '2024-02-01 00:00:00'"
L, LI = cte("listings"), cte("listings", "listings_in")
CORE = ["source", "external_id", "id", "title", "price_uah", "district", "agent_type", "agent_phone", "status", "operation", "property_type", "updated_at"]


def _core(df):
    return df.select(*CORE)


def _ntz(df, *cols):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


FEED = "c.source LIKE 'feed%'"


def merge_sql(where, cols, insert_extra=""):
    """Full outer join form of the merge: cols maps a column to its expression for a key known on both sides."""
    picks = ", ".join(f"CASE WHEN c.external_id IS NOT NULL AND i.external_id IS NOT NULL AND NOT ({FEED}) THEN {e} WHEN c.external_id IS NOT NULL THEN c.{n} "
                      f"ELSE {'NULL' if n == 'id' else ASOF if n == 'updated_at' else 'i.' + n} END AS {n}" for n, e in cols.items())
    return f"SELECT COALESCE(c.source, i.source) AS source, COALESCE(c.external_id, i.external_id) AS external_id, {picks} FROM listings c FULL JOIN (SELECT * FROM listings_in WHERE {where}) i ON i.source = c.source AND i.external_id = c.external_id"


APART = {"id": "c.id", "title": "COALESCE(NULLIF(i.title, ''), c.title)", "price_uah": "COALESCE(i.price_uah, c.price_uah)", "district": "COALESCE(NULLIF(i.district, ''), c.district)",
         "agent_type": "COALESCE(NULLIF(i.agent_type, 'unknown'), c.agent_type)", "agent_phone": "COALESCE(NULLIF(i.agent_phone, ''), c.agent_phone)",
         "status": "CASE WHEN c.status IN ('quarantine', 'archived') THEN c.status ELSE 'active' END", "operation": "i.operation",
         "property_type": "COALESCE(NULLIF(i.property_type, ''), c.property_type)", "updated_at": ASOF}
VALID = "is_valid AND property_type = 'Квартира' AND source IN ('olx', 'rieltor')"


def _incoming(t):
    return t.listings_in.select(*[c for c in CORE if c != "id"], "is_valid")


@query("merge_apartments", LI + merge_sql(VALID, APART))
def _(t):
    return S.merge_apartments(_core(t.listings), _incoming(t), ASOF)


SINCE = "TIMESTAMP '1999-06-01 00:00:00'"


@query("merge_since", LI + merge_sql(VALID + f" AND updated_at >= {SINCE}", APART))
def _(t):
    return S.merge_since(_core(t.listings), _incoming(t), SINCE, ASOF)


HOUSE = {"id": "i.id", "title": "i.title", "price_uah": "i.price_uah", "district": "i.district", "agent_type": "i.agent_type", "agent_phone": "COALESCE(NULLIF(i.agent_phone, ''), c.agent_phone)",
         "status": "CASE WHEN c.status IN ('quarantine', 'archived') THEN c.status ELSE 'active' END", "operation": "i.operation", "property_type": "i.property_type", "updated_at": ASOF}


@query("overwrite_upsert", LI + merge_sql("TRUE", HOUSE).replace(f"NOT ({FEED})", "TRUE").replace("ELSE NULL END AS id", "ELSE i.id END AS id"))
def _(t):
    return S.overwrite_upsert(_core(t.listings), t.listings_in.select(*CORE), ASOF)


COMMERCIAL = {"id": "COALESCE(i.id, c.id)", "title": "COALESCE(NULLIF(i.title, ''), c.title)", "price_uah": "COALESCE(i.price_uah, c.price_uah)", "district": "COALESCE(NULLIF(i.district, ''), c.district)",
              "agent_type": "COALESCE(NULLIF(i.agent_type, ''), c.agent_type)", "agent_phone": "COALESCE(NULLIF(i.agent_phone, ''), c.agent_phone)",
              "status": "CASE WHEN c.status IN ('quarantine', 'archived') THEN c.status ELSE 'active' END", "operation": "i.operation",
              "property_type": "COALESCE(NULLIF(i.property_type, ''), c.property_type)", "updated_at": ASOF}


@query("merge_commercial", LI + merge_sql("TRUE", COMMERCIAL).replace(f"NOT ({FEED})", "TRUE").replace("ELSE NULL END AS id", "ELSE i.id END AS id"))
def _(t):
    return S.merge_commercial(_core(t.listings), t.listings_in.select(*CORE), ASOF)


@query("upsert_raw", LI + f"""SELECT COALESCE(c.source, i.source) AS source, COALESCE(c.external_id, i.external_id) AS external_id, COALESCE(i.url, c.url) AS url, COALESCE(CASE WHEN i.url IS NULL THEN c.price_uah ELSE i.price_uah END) AS price_uah,
 CASE WHEN c.url IS NOT NULL AND i.url IS NOT NULL THEN c.rooms_n + 1 WHEN c.url IS NOT NULL THEN c.rooms_n ELSE 0 END AS retry_count,
 CASE WHEN c.url IS NOT NULL THEN c.created_at ELSE i.created_at END AS created_at FROM (SELECT *, COALESCE(rooms, 0) AS rooms_n FROM listings) c FULL JOIN listings_in i ON i.source = c.source AND i.external_id = c.external_id""")
def _(t):
    cur = t.listings.select("source", "external_id", "url", "price_uah", F.coalesce("rooms", F.lit(0)).alias("retry_count"), "created_at")
    inc = t.listings_in.select("source", "external_id", "url", "price_uah", F.lit(0).cast("bigint").alias("retry_count"), "created_at")
    return S.upsert_raw(cur, inc, ASOF)


@query("insert_if_absent", LI + """SELECT source, external_id, title FROM listings UNION ALL SELECT source, external_id, title FROM listings_in i
WHERE NOT EXISTS (SELECT 1 FROM listings c WHERE c.source = i.source AND c.external_id = i.external_id)""")
def _(t):
    cols = ["source", "external_id", "title"]
    return S.insert_if_absent(t.listings.select(*cols), t.listings_in.select(*cols))


def blank(c):
    return f"COALESCE(trim(CAST({c} AS VARCHAR)), '') = ''"


TAKE = {"title": f"{blank('c.title')} AND NOT {blank('i.title')}", "district": f"{blank('c.district')} AND NOT {blank('i.district')}",
        "agent_phone": f"{blank('c.agent_phone')} AND NOT {blank('i.agent_phone')}",
        "agent_type": f"({blank('c.agent_type')} OR c.agent_type IN ('unknown', 'Не вказано')) AND COALESCE(i.agent_type IN ('owner', 'agent', 'agency'), FALSE)",
        "floor": "c.property_type = 'Квартира' AND c.floor IS NULL AND i.rooms IS NOT NULL"}


@query("fill_missing", LI + "SELECT c.id, " + ", ".join(f"CASE WHEN {cond} THEN i.{'rooms' if f == 'floor' else f} ELSE c.{f} END AS {f}" for f, cond in TAKE.items()) + ", " +
       " + ".join(f"CASE WHEN {cond} THEN 1 ELSE 0 END" for cond in TAKE.values()) + " AS changed_fields FROM listings c LEFT JOIN listings_in i ON i.id = c.id")
def _(t):
    cand = t.listings_in.select("id", "title", "district", "agent_phone", "agent_type", F.col("rooms").alias("floor"))
    cur = t.listings.select("id", "property_type", "title", "district", "agent_phone", "agent_type", "floor")
    return S.fill_missing(cur, cand).drop("property_type")


@query("archive_inactive", cte("listings", "publications") + """SELECT l.catalog, l.id, 'historical_inactive' AS reason FROM listings l WHERE l.status IN ('inactive', 'archived')
 AND NOT EXISTS (SELECT 1 FROM publications p WHERE p.listing_id = l.id AND p.status = 'published')
UNION ALL SELECT l.catalog, l.id, 'earlier' FROM listings l JOIN publications p ON p.listing_id = l.id WHERE p.status = 'published'""")
def _(t):
    rows = t.listings.select("catalog", "id", "status", "title", "price_uah", "updated_at")
    done = t.publications.where(F.col("status") == "published").select(F.col("listing_id").alias("id"))
    old = rows.join(done, "id").select("catalog", "id", F.expr(ASOF).alias("archived_at"), F.lit("earlier").alias("reason"), F.lit("{}").alias("snapshot"))
    archive, _rest = S.archive_inactive(rows, old, "historical_inactive", ASOF)
    return archive.select("catalog", "id", "reason")


@query("split_catalog", cte("listings", "checks") + """SELECT 'listing' AS part, id, CASE WHEN property_type = 'Будинок' THEN 'moved' ELSE 'kept' END AS side FROM listings
UNION ALL SELECT 'check', c.event_id, CASE WHEN EXISTS (SELECT 1 FROM listings l WHERE l.id = c.listing_id AND l.property_type = 'Будинок') THEN 'moved' ELSE 'kept' END FROM checks c""")
def _(t):
    ledger = t.checks.select(F.col("listing_id").alias("id"), "event_id")
    kept, moved, parts = S.split_catalog(t.listings.select("id", "property_type"), F.col("property_type") == D.HOUSE, {"checks": ledger}, D.HOUSE)
    tag = lambda df, part, key, side: df.select(F.lit(part).alias("part"), F.col(key).alias("id"), F.lit(side).alias("side"))
    stay, go = parts["checks"]
    return (tag(kept, "listing", "id", "kept").unionByName(tag(moved, "listing", "id", "moved"))
            .unionByName(tag(stay, "check", "event_id", "kept")).unionByName(tag(go, "check", "event_id", "moved")))


@query("clear_invalid_pairs", L + """SELECT id, CASE WHEN COALESCE(floor > floors_total, FALSE) THEN NULL ELSE floor END AS floor, CASE WHEN COALESCE(floor > floors_total, FALSE) THEN NULL ELSE floors_total END AS floors_total,
 CASE WHEN COALESCE(floor > floors_total, FALSE) THEN CASE WHEN COALESCE(comments, '') = '' THEN '' ELSE comments || '; ' END || 'quality: invalid floor values cleared' ELSE comments END AS comments FROM listings""")
def _(t):
    return S.clear_invalid_pairs(t.listings.select("id", "floor", "floors_total", "comments"))


@query("upsert_notes", cte("notes", last="SELECT catalog, listing_id, max_by(note, pos) AS note FROM notes WHERE note <> '' GROUP BY ALL", old="""SELECT catalog, listing_id, CASE WHEN min(pos) % 2 = 0 THEN 'old note' ELSE max_by(note, pos) END AS note,
 TIMESTAMP '2020-01-01 00:00:00' AS edited_at FROM notes WHERE catalog <> 'houses' AND note <> '' GROUP BY ALL""") + f"""
SELECT COALESCE(o.catalog, l.catalog) AS catalog, COALESCE(o.listing_id, l.listing_id) AS listing_id, COALESCE(l.note, o.note) AS note,
 CASE WHEN l.note IS NULL OR o.note = l.note THEN o.edited_at ELSE {ASOF} END AS edited_at FROM old o FULL JOIN last l ON l.catalog = o.catalog AND l.listing_id = o.listing_id""")
def _(t):
    n = t.notes.where(F.col("note") != "")
    old = n.where(F.col("catalog") != "houses").groupBy("catalog", "listing_id").agg(F.min("pos").alias("p"), F.max_by("note", "pos").alias("x"))
    old = old.select("catalog", "listing_id", F.when(F.col("p") % 2 == 0, "old note").otherwise(F.col("x")).alias("note"),
                     F.expr("TIMESTAMP '2020-01-01 00:00:00'").alias("edited_at"))
    return _ntz(S.upsert_notes(old, t.notes, ASOF), "edited_at")


@query("page_registry", cte("listings", "publications", reg="""SELECT l.catalog, p.listing_id, 'old' AS url, p.updated_at AS source_updated_at, p.status <> 'retry' AS active, p.updated_at AS created_at, p.updated_at FROM publications p JOIN listings l ON l.id = p.listing_id""",
                            live="SELECT * FROM listings WHERE status = 'active'") + f"""
SELECT COALESCE(r.catalog, l.catalog) AS catalog, COALESCE(r.listing_id, l.id) AS listing_id, CASE WHEN l.id IS NOT NULL THEN 'https://pages.example/listing/' || l.catalog || '/' || CAST(l.id AS VARCHAR) ELSE r.url END AS url,
 l.id IS NOT NULL AS active, COALESCE(r.created_at, {ASOF}) AS created_at, CASE WHEN l.id IS NOT NULL OR r.active THEN {ASOF} ELSE r.updated_at END AS updated_at
FROM reg r FULL JOIN live l ON l.id = r.listing_id""")
def _(t):
    reg = t.publications.join(t.listings.select(F.col("id").alias("listing_id"), "catalog"), "listing_id").select(
        "catalog", "listing_id", F.lit("old").alias("url"), F.col("updated_at").alias("source_updated_at"), (F.col("status") != "retry").alias("active"),
        F.col("updated_at").alias("created_at"), "updated_at")
    out = S.page_registry(reg, t.listings, "https://pages.example", ASOF).drop("source_updated_at")
    return _ntz(out, "created_at", "updated_at")


@query("detect_changes", LI + """SELECT i.source, i.external_id, CASE WHEN c.external_id IS NULL THEN 'new' WHEN i.title IS DISTINCT FROM c.title OR i.price_uah IS DISTINCT FROM c.price_uah OR i.area IS DISTINCT FROM c.area THEN 'changed' ELSE 'unchanged' END AS change
FROM listings_in i LEFT JOIN listings c ON c.source = i.source AND c.external_id = i.external_id""")
def _(t):
    cols = ("title", "price_uah", "area")
    mark = lambda df: df.select("source", "external_id", S.row_fingerprint(df, cols).alias("fingerprint"))
    return S.detect_changes(mark(t.listings_in), mark(t.listings), ["source", "external_id"]).drop("fingerprint")


@query("verify_only_changed", LI + """SELECT count(*) FILTER (a.district = i.district AND COALESCE(i.title, '') = COALESCE(a.title, '')) AS verified_rows, count(*) FILTER (a.district IS DISTINCT FROM i.district) AS wrong_value_rows,
 count(*) FILTER (a.district = i.district AND COALESCE(i.title, '') <> COALESCE(a.title, '')) AS other_changes FROM listings a JOIN listings_in i USING (id)""")
def _(t):
    norm = lambda df: df.select("id", "district", F.coalesce("title", F.lit("")).alias("title"))
    plan = t.listings.select("id", F.col("district").alias("new_value"))
    return S.verify_only_changed(norm(t.listings), norm(t.listings_in), "id", "district", plan)


@query("repair_column", L + """SELECT id, commission AS old_value, v AS new_value FROM (SELECT id, commission, CASE WHEN commission = 'Комісія 50' THEN 'Комісія 50%' WHEN commission = 'Без комісії!' THEN 'Без комісії'
 WHEN contains(description, 'без комісії') THEN 'Без комісії' WHEN contains(description, 'комісія 50%') THEN 'Комісія 50%' ELSE 'Не вказано' END AS v FROM listings) WHERE v IS DISTINCT FROM commission""")
def _(t):
    text = F.concat_ws(" ", "title", "description")
    return S.repair_column(t.listings, "commission", normalize_commission("commission", text))[1]


@query("project_contacts_upsert", cte("listings", rows=PROJECT.split("AS (", 1)[0] and "SELECT catalog, id, source, external_id, agent_phone, created_at FROM listings") + f"""
SELECT catalog, source, external_id, COALESCE(agent_phone, '') AS contact_phone, created_at AS first_seen_at, {ASOF} AS last_seen_at FROM rows""")
def _(t):
    new = ST.contact_projection(ST.union_catalogs(t.catalogs()))
    old = t.listings.select("catalog", "source", "external_id", F.lit("old").alias("contact_phone"), F.col("created_at").alias("first_seen_at"),
                            F.col("created_at").alias("last_seen_at"), F.col("created_at").alias("updated_at"))
    out = S.project_contacts_upsert(old, new.select("catalog", "source", "external_id", "contact_phone"), ASOF)
    return out.drop("updated_at")


OPEN = f"status = 'active' AND {LIVE}"


@query("apply_defaults", L + f"""SELECT id, CASE WHEN {OPEN} AND COALESCE(commission, '') = '' THEN 'Не вказано' ELSE commission END AS commission,
 CASE WHEN {OPEN} AND COALESCE(agent_type, '') = '' THEN 'Не вказано' ELSE agent_type END AS agent_type, CASE WHEN {OPEN} AND COALESCE(city, '') = '' THEN 'Київ' ELSE city END AS city FROM listings""")
def _(t):
    return S.apply_defaults(t.listings, {"commission": "Не вказано", "agent_type": "Не вказано", "city": "Київ"}).select("id", "commission", "agent_type", "city")


@query("pending_publications", cte("publications") + "SELECT listing_id, status FROM publications WHERE synced_at IS NULL OR updated_at > synced_at")
def _(t):
    return S.pending(t.publications).select("listing_id", "status")


@query("mark_synced", cte("publications") + f"""SELECT listing_id, CASE WHEN status = 'published' THEN {ASOF} WHEN status = 'pending' THEN NULL ELSE synced_at END AS synced_at,
 CASE WHEN status = 'pending' THEN 'no row' END AS sync_error FROM publications""")
def _(t):
    pubs = t.publications.withColumn("sync_error", F.lit(None).cast("string"))
    res = t.publications.where(F.col("status") != "retry").select("listing_id", (F.col("status") == "published").alias("ok"), F.lit("no row").alias("error"))
    out = S.mark_synced(pubs, res, ASOF, ("listing_id",))
    return _ntz(out.select("listing_id", "synced_at", "sync_error"), "synced_at")


@query("cooldown_merge", cte("checks") + """SELECT source AS name, max(checked_at) + INTERVAL 1 HOUR AS cooldown_until, max(checked_at) + INTERVAL 1 HOUR > TIMESTAMP '2024-01-30 23:59:00' AS blocked FROM checks WHERE http_status = 429 OR http_status = 404 GROUP BY 1""")
def _(t):
    at = F.col("checked_at") + F.expr("INTERVAL 1 HOUR")
    rows = lambda code: t.checks.where(F.col("http_status") == code).select(F.col("source").alias("name"), at.alias("cooldown_until"))
    return S.cooldown_merge(rows(429), rows(404), "TIMESTAMP '2024-01-30 23:59:00'")


@query("fill_blank_contacts", LI + """SELECT l.id, CASE WHEN COALESCE(trim(l.agent_phone), '') = '' THEN COALESCE(CASE WHEN i.status = 'active' AND i.agent_phone <> '' THEN i.agent_phone END, l.agent_phone) ELSE l.agent_phone END AS agent_phone
FROM listings l LEFT JOIN listings_in i ON i.id = l.id AND i.catalog = l.catalog""")
def _(t):
    contacts = t.listings_in.select("catalog", F.col("id").alias("listing_id"), "status", F.col("agent_phone").alias("contact_phone"),
                                    F.when(F.col("agent_phone") != "", "public_phone").otherwise("source_link").alias("contact_method"))
    return S.fill_blank_contacts(t.listings.select("catalog", "id", "agent_phone"), contacts).select("id", "agent_phone")


@query("fill_phones_from_text", L + r"""SELECT id, CASE WHEN hit THEN '+38' || replace(regexp_extract(description, 'Телефон ([0-9 ]+),', 1), ' ', '') ELSE agent_phone END AS agent_phone,
 CASE WHEN hit THEN CASE WHEN COALESCE(comments, '') = '' THEN '' ELSE comments || '; ' END || 'contact: public phone extracted from text' ELSE comments END AS comments
FROM (SELECT *, COALESCE(source = 'olx' AND status = 'active' AND COALESCE(trim(agent_phone), '') = '' AND contains(description, 'Телефон 067'), FALSE) AS hit FROM listings)""")
def _(t):
    return S.fill_phones_from_text(t.listings).select("id", "agent_phone", "comments")


NUM = lambda c: f"CAST({c} AS BIGINT)"
TITLE = """CASE WHEN operation = 'rent' THEN 'Оренда ' ELSE 'Продаж ' END || CASE WHEN rooms IS NOT NULL THEN CAST(rooms AS VARCHAR) || CASE WHEN property_type = 'Будинок' THEN '-кімнатного будинку' ELSE '-кімнатної квартири' END
 WHEN property_type = 'Будинок' THEN 'будинку' ELSE 'квартири' END || CASE WHEN area IS NOT NULL THEN ' ' || CAST(CAST(area AS BIGINT) AS VARCHAR) || ' м²' ELSE '' END
 || CASE WHEN residential_complex = 'ЖК Сонячний' THEN ' у ЖК «Сонячний»' WHEN district <> '' THEN ' у ' || district || ' районі' ELSE ' у Києві' END"""


@query("refresh_copy", L + f"SELECT id, CASE WHEN {LIVE} AND {COPY_BAD} THEN {TITLE} ELSE ai_title END AS ai_title FROM listings")
def _(t):
    row = copygen.fields_of(t.listings)
    return S.refresh_copy(t.listings, copygen.build_title(row), copygen.build_summary(row)).select("id", "ai_title")


# ---- reconcile -------------------------------------------------------------------------------
COPY_ROWS = "SELECT CASE WHEN l_returnflag = 'R' THEN NULL ELSE CAST(l_partkey AS VARCHAR) END AS id, (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate) AS pos FROM lineitem"


ACTIONS = f"""WITH c AS ({COPY_ROWS}), n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY pos) AS rn FROM c WHERE id IS NOT NULL), w AS (SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer),
a AS (SELECT id, pos, CASE WHEN n.id IS NULL THEN 'append' WHEN w.id IS NULL THEN 'stale' ELSE 'keep' END AS action FROM (SELECT * FROM n WHERE rn = 1) n FULL JOIN w USING (id)
 UNION ALL SELECT id, pos, 'duplicate' FROM n WHERE rn > 1 UNION ALL SELECT id, pos, 'orphan' FROM c WHERE id IS NULL)
"""


def _actions(t):
    copy = t.read("lineitem").select(F.when(F.col("l_returnflag") != "R", F.col("l_partkey").cast("string")).alias("id"),
                                     F.expr("(((CAST(l_orderkey AS DECIMAL(12, 0)) * 10 + l_linenumber) * 100000000 + l_partkey) * 100000000 + l_suppkey) * 100000 + datediff(l_shipdate, DATE '1970-01-01')").alias("pos"), "l_quantity")
    return RC.reconcile(t.customer.select(F.col("c_custkey").alias("id")), copy, "id", "pos")


@query("reconcile", ACTIONS + "SELECT action, count(*) AS n FROM a GROUP BY 1")
def _(t):
    return _actions(t).groupBy("action").agg(F.count(F.lit(1)).alias("n"))


@query("reconcile_rows", ACTIONS + """SELECT id, action, CAST((((CAST(pos[1] AS HUGEINT) * 10 + pos[2]) * 100000000 + pos[3]) * 100000000 + pos[4]) * 100000 + date_diff('day', DATE '1970-01-01', pos[5]) AS VARCHAR) AS pos FROM a""")
def _(t):
    return _actions(t).select("id", "action", F.col("pos").cast("string").alias("pos"))


CELLS = {"title": "COALESCE(trim(a.title), '') = COALESCE(trim(b.title), '')", "price": "COALESCE(CAST(a.price_uah AS BIGINT), -1) = COALESCE(CAST(b.price_uah AS BIGINT), -1)",
         "district": "COALESCE(a.district, '') = COALESCE(b.district, '')"}


def _grid(df, key="external_id", decimal=False):
    price = F.col("price_uah").try_cast("bigint").cast("string")
    return df.select(key, "title", F.coalesce(F.concat(F.lit("'"), price, F.lit(",0")) if decimal else price, F.lit("")).alias("price"), "district", F.col("updated_at").cast("string").alias("seen"))


@query("diff_rows", LI + f"""SELECT a.external_id, CASE WHEN b.external_id IS NULL THEN 'insert' WHEN {' AND '.join(CELLS.values())} THEN 'unchanged' ELSE 'update' END AS action
FROM listings a LEFT JOIN listings_in b ON b.external_id = a.external_id""")
def _(t):
    return RC.diff_rows(_grid(t.listings), _grid(t.listings_in, decimal=True), "external_id", ("seen",))


ISSUES = LI + f""", j AS (SELECT COALESCE(a.external_id, b.external_id) AS k, a.external_id IS NOT NULL AS w, b.external_id IS NOT NULL AS f, {', '.join(f'{e} AS same_{n}' for n, e in CELLS.items())}
 FROM listings a FULL JOIN listings_in b ON b.external_id = a.external_id), i AS (SELECT 'missing' AS kind, '' AS field, k FROM j WHERE w AND NOT f UNION ALL SELECT 'stale', '', k FROM j WHERE f AND NOT w
 """ + " ".join(f"UNION ALL SELECT 'mismatch', '{n}', k FROM j WHERE w AND f AND NOT same_{n}" for n in CELLS) + """)
"""


def _mismatches(t):
    return RC.mismatch_rows(_grid(t.listings), _grid(t.listings_in, decimal=True), "external_id", ("seen",))


@query("mismatch_rows", ISSUES + "SELECT kind, field, k FROM i")
def _(t):
    return _mismatches(t)


@query("mismatch_report", ISSUES + """SELECT kind, field, count(*) AS n, array_to_string(list_sort(list(k ORDER BY k))[1:CASE WHEN kind = 'mismatch' THEN 10 ELSE 100 END], ',') AS sample FROM i GROUP BY kind, field""")
def _(t):
    return RC.mismatch_report(staged(_mismatches(t))).select("kind", "field", "n", F.array_join("sample", ",").alias("sample"))


@query("upsert_repeated_keys", """
WITH inc AS (SELECT l_orderkey AS k, l_linenumber AS step, l_extendedprice AS price,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_extendedprice DESC) AS rn FROM lineitem),
cur AS (SELECT o_orderkey AS k, o_totalprice AS price FROM orders WHERE o_orderstatus = 'F')
SELECT k, CAST(coalesce(i.step, 0) AS BIGINT) AS step, coalesce(i.price, c.price) AS price
FROM cur c FULL JOIN (SELECT * FROM inc WHERE rn = 1) i USING (k)""")
def upsert_repeated_keys(t):
    """Every line updates its order's row, one after the other; the last line wins."""
    known = t.orders.where("o_orderstatus = 'F'").selectExpr("o_orderkey AS k", "CAST(0 AS BIGINT) AS step", "o_totalprice AS price")
    incoming = t.lineitem.selectExpr("l_orderkey AS k", "CAST(l_linenumber AS BIGINT) AS step", "l_extendedprice AS price")
    return S.upsert(known, incoming, ["k"], order=["step", "price"])
