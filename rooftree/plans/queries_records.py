"""Queries for generated copy, whole-record normalization, payloads, grids and pages."""
import re
import uuid

from pyspark.sql import functions as F

from rooftree import defaults as D
from rooftree.functions import copygen as C
from rooftree.operators import normalize as N
from rooftree.operators import values as V
from rooftree.plans.bindings import cte
from rooftree.plans.queries_snapshots import TITLE
from rooftree.plans.queries_text import CLEANED, SENTENCES, _paragraphs, _unescaped
from rooftree.plans.registry import query
from rooftree.session import scratch_dir
from rooftree.sources import grids, pages as P, payloads

L = cte("listings")
INT = lambda c: f"CAST(CAST({c} AS BIGINT) AS VARCHAR)"

# ---- generated copy --------------------------------------------------------------------------


@query("build_title", L + f"SELECT id, {TITLE} AS title FROM listings")
def _(t):
    rows = t.listings
    return rows.select("id", C.build_title(C.fields_of(rows)).alias("title"))


PLACES = """array_to_string(list_filter([CASE WHEN district <> '' THEN district || ' район' END, CASE WHEN residential_complex <> '' THEN 'ЖК «Сонячний»' END, street,
 CASE WHEN metro_station <> '' THEN 'метро ' || metro_station END], lambda x: x IS NOT NULL), ', ')"""
SUMMARY = f"""CASE WHEN operation = 'rent' THEN 'Пропонується в оренду ' ELSE 'Пропонується до продажу ' END || CASE WHEN rooms IS NOT NULL THEN CAST(rooms AS VARCHAR) || CASE WHEN property_type = 'Будинок' THEN '-кімнатний будинок' ELSE '-кімнатна квартира' END
 WHEN property_type = 'Будинок' THEN 'будинок' ELSE 'квартира' END || CASE WHEN area IS NOT NULL THEN ' площею ' || {INT('area')} || ' м²' ELSE '' END || '.'
 || CASE WHEN {PLACES} <> '' THEN ' Розташування: ' || {PLACES} || '.' ELSE '' END
 || CASE WHEN floor IS NOT NULL AND floors_total IS NOT NULL THEN ' Поверх ' || CAST(floor AS VARCHAR) || ' із ' || CAST(floors_total AS VARCHAR) || '.' WHEN floor IS NOT NULL THEN ' Поверх ' || CAST(floor AS VARCHAR) || '.'
   WHEN property_type = 'Будинок' AND floors_total IS NOT NULL THEN ' Будинок має ' || CAST(floors_total AS VARCHAR) || ' поверхи.' ELSE '' END"""


@query("build_summary", L + f"SELECT id, {SUMMARY} AS summary FROM listings")
def _(t):
    rows = t.listings
    return rows.select("id", C.build_summary(C.fields_of(rows)).alias("summary"))


ROOMS = """CASE WHEN rooms = 1 THEN '1 кімнату' WHEN rooms % 10 IN (2, 3, 4) AND rooms % 100 NOT IN (12, 13, 14) THEN CAST(rooms AS VARCHAR) || ' кімнати' ELSE CAST(rooms AS VARCHAR) || ' кімнат' END"""


@query("factual_recap", L + f"""SELECT id, trim(concat_ws(' ', CASE WHEN rooms IS NOT NULL AND area IS NOT NULL THEN 'Планування передбачає ' || {ROOMS} || ', а загальна площа становить ' || {INT('area')} || ' м².'
 WHEN area IS NOT NULL THEN 'Загальна площа об''єкта становить ' || {INT('area')} || ' м².' END, CASE WHEN {PLACES} <> '' THEN 'Локація, зазначена в оголошенні: ' || {PLACES} || '.' END,
 CASE WHEN floor IS NOT NULL AND floors_total IS NOT NULL THEN 'Розташування на ' || CAST(floor AS VARCHAR) || ' поверсі у ' || CAST(floors_total AS VARCHAR) || '-поверховому будинку.' END)) AS recap FROM listings""")
def _(t):
    rows = t.listings
    return rows.select("id", C.factual_recap(C.fields_of(rows)).alias("recap"))


@query("fallback_detailed")
def _(t):
    """Summary, redacted source text and recap (lookbehind splitting: no SQL form)."""
    rows = t.listings
    return rows.select("id", C.fallback_detailed(C.fields_of(rows), "description").alias("description"))


KIND = "CASE WHEN rooms = 1 THEN 'office' WHEN rooms = 2 THEN 'warehouse' WHEN rooms = 3 THEN 'retail' ELSE 'other' END"


def _commercial(t):
    kind = F.when(F.col("rooms") == 1, "office").when(F.col("rooms") == 2, "warehouse").when(F.col("rooms") == 3, "retail").otherwise("other")
    return t.listings.select("id", "operation", kind.alias("commercial_type"), F.col("area").alias("area_total_m2"),
                             F.when(F.col("district") == "District 1", "Печерський").otherwise(F.col("district")).alias("district"), "street",
                             "floor", "floors_total", F.lit("").alias("floor_label"), F.lit("").alias("full_address"), F.col("city").alias("condition"))


@query("commercial_title", L + f"""SELECT id, concat_ws(' ', CASE WHEN operation = 'rent' THEN 'Оренда' ELSE 'Продаж' END, CASE {KIND} WHEN 'office' THEN 'офісного приміщення' WHEN 'warehouse' THEN 'складського приміщення'
 WHEN 'retail' THEN 'торгового приміщення' ELSE 'комерційного приміщення' END, {INT('area')} || ' м²', CASE WHEN district = 'District 1' THEN 'у Печерському районі' WHEN district <> '' THEN 'у ' || district || ' районі' END) AS title FROM listings""")
def _(t):
    rows = _commercial(t)
    return rows.select("id", C.commercial_title(C.fields_of(rows)).alias("title"))


@query("commercial_description", L + f"""SELECT id, concat_ws(chr(10) || chr(10), 'Пропонується ' || CASE WHEN operation = 'rent' THEN 'в оренду ' ELSE 'до продажу ' END || CASE {KIND} WHEN 'office' THEN 'офісне приміщення' WHEN 'warehouse' THEN 'складське приміщення'
 WHEN 'retail' THEN 'торгове приміщення' ELSE 'комерційне приміщення' END || COALESCE(' загальною площею ' || {INT('area')} || ' м²', '') || '.',
 CASE WHEN COALESCE(district, '') <> '' OR street IS NOT NULL THEN 'Розташування, зазначене в оголошенні: ' || concat_ws(', ', CASE WHEN district = 'District 1' THEN 'Печерський' ELSE NULLIF(district, '') END, street) || '.' END,
 CASE WHEN floor IS NOT NULL AND floors_total IS NOT NULL THEN 'Поверх: ' || CAST(floor AS VARCHAR) || ' з ' || CAST(floors_total AS VARCHAR) || '.' WHEN floor IS NOT NULL THEN 'Поверх: ' || CAST(floor AS VARCHAR) || '.' END,
 CASE WHEN city <> '' THEN 'Характеристики: Стан: ' || city || '.' END) AS description FROM listings""")
def _(t):
    rows = _commercial(t)
    return rows.select("id", C.commercial_description(C.fields_of(rows)).alias("description"))


FEED_TITLE = """concat_ws(' ', CASE WHEN operation = 'rent' THEN 'Оренда' ELSE 'Продаж' END, property_type, CASE WHEN area <> 0 THEN CAST(area AS VARCHAR) || ' м²' END, CASE WHEN district <> '' THEN 'у ' || district || ' районі' END)"""


@query("feed_copy", L + f"""SELECT id, {FEED_TITLE} AS title, CASE WHEN length({FEED_TITLE} || '.' || CASE WHEN COALESCE(street, '') <> '' THEN chr(10) || chr(10) || 'Деталі об’єкта:' || chr(10) || street ELSE '' END) >= 100 THEN 100 ELSE 60 END AS score,
 {FEED_TITLE} || '.' || CASE WHEN COALESCE(street, '') <> '' THEN chr(10) || chr(10) || 'Деталі об’єкта:' || chr(10) || street ELSE '' END AS description FROM listings""")
def _(t):
    rows = t.listings.select("id", "operation", "property_type", "area", "district", F.col("street").alias("description"))
    row = C.fields_of(rows)
    out = rows.select("id", C.feed_title(row).alias("title"), C.feed_description(row).alias("description"))
    return out.withColumn("score", C.feed_score(F.col("description")))


@query("fact_rows", L + """SELECT id, * EXCLUDE (id) FROM (
SELECT id, 0 AS pos, 'Price' AS label, replace(format('{:,}', CAST(price_uah AS BIGINT)), ',', ' ') || ' UAH' AS value FROM listings WHERE price_uah IS NOT NULL
UNION ALL SELECT id, 1, 'Price', replace(format('{:,}', CAST(price_usd AS BIGINT)), ',', ' ') || ' USD' FROM listings WHERE price_usd IS NOT NULL
UNION ALL SELECT id, 3, 'Total area', CAST(area AS VARCHAR) || ' m²' FROM listings WHERE area IS NOT NULL
UNION ALL SELECT id, 4, 'Floor', CAST(floor AS VARCHAR) FROM listings WHERE floor IS NOT NULL
UNION ALL SELECT id, 7, 'District', district FROM listings WHERE district <> '')""")
def _(t):
    return C.fact_rows(t.listings.select("id", "price_uah", "price_usd", "area", "floor", "district"), ["id"], "en")


@query("publication_title", L + """SELECT id, CASE WHEN COALESCE(title, '') = '' THEN 'Agency' ELSE title END || ' · #' || CAST(id AS VARCHAR) AS shown FROM listings""")
def _(t):
    title = F.concat("title", F.when(F.col("rooms") == 2, " - оголошення №77 тест").otherwise(""))
    return t.listings.select("id", C.clean_title(F.when(F.col("rooms").isNull(), F.col("title")).otherwise(title), "id", "Agency").alias("shown"))


# word edges next to letters of any script
SENSITIVE = re.sub(r"(?<=[a-z])\\b", r"(?:$|[^\\p{L}\\p{N}_])", re.sub(r"\\b(?=\w)", r"(?:^|[^\\p{L}\\p{N}_])", D.SENSITIVE_SENTENCE)).replace("\\w", "[\\p{L}\\p{N}_]")
SOURCE_TEXT = "COALESCE(NULLIF(ai_description, ''), description, '')"
PUBLISHED = _paragraphs("string_split_regex(regexp_replace(" + _unescaped(SOURCE_TEXT) + r", '<[^>]+>', ' ', 'g'), '\n{2,}')",
                        "list_filter(" + SENTENCES(CLEANED("p")) + f", lambda s: s <> '' AND NOT regexp_matches(s, '(?i){SENSITIVE}'))")
ORDINARY = lambda e: f"NULLIF(trim({e}), '')"


@query("agency_description", L + f"""SELECT id, concat_ws(chr(10) || chr(10), 'Представляємо ретельно відібрану пропозицію Agency — ' || CASE catalog WHEN 'commercial' THEN 'об’єкт' WHEN 'houses' THEN 'будинок' ELSE 'квартира' END ||
 ' у локації ' || COALESCE({ORDINARY('street')}, {ORDINARY('district')}, {ORDINARY('city')}, 'Києві') || '.' || CASE WHEN area IS NOT NULL THEN ' Площа — ' || CAST(area AS VARCHAR) || ' м².' ELSE '' END, NULLIF({PUBLISHED}, ''),
 'Зверніть увагу на деталі нижче: ми залишили тільки підтверджені характеристики, щоб ви могли об’єктивно оцінити простір і його потенціал.') AS text FROM listings""")
def _(t):
    """Opening, publishable source text and closing per listing."""
    rows = t.listings.select("id", "catalog", "street", "district", "city", "area", F.col("area").alias("area_total_m2"), "ai_description", "description")
    return rows.select("id", C.agency_description(C.fields_of(rows), "Agency").alias("text"))


# ---- normalization ---------------------------------------------------------------------------


@query("normalize_listing", L + r"""SELECT id, property_type, CAST(price_uah AS DOUBLE) AS price_uah, rooms, area, CASE WHEN floor > floors_total THEN NULL ELSE floor END AS floor, CASE WHEN floor > floors_total THEN NULL ELSE floors_total END AS floors_total,
 agent_type, array_to_string(list_filter([CASE WHEN title = '' AND descr = '' THEN 'no_content' END, CASE WHEN COALESCE(price_uah, 0) = 0 THEN 'no_price' END], lambda x: x IS NOT NULL), ',') AS errors,
 CASE WHEN price_raw IS NOT NULL THEN 'structured' ELSE 'missing' END AS price_confidence
FROM (SELECT l.id, CASE WHEN l.property_type = '' THEN 'Квартира' ELSE l.property_type END AS property_type, l.price_uah AS price_raw, CASE WHEN l.price_uah IS NOT NULL THEN round_even(l.price_uah, 0) END AS price_uah,
  l.rooms, l.area, COALESCE(l.floor, f) AS floor, COALESCE(l.floors_total, ft) AS floors_total, CASE WHEN l.agent_type IN ('owner', 'agent', 'agency') THEN l.agent_type WHEN contains(x, 'власник') OR contains(x, 'без комісі') THEN 'owner'
  WHEN contains(x, 'агент') THEN 'agent' ELSE 'unknown' END AS agent_type, COALESCE(title, '') AS title, COALESCE(description, '') AS descr FROM
  (SELECT *, lower(COALESCE(description, '')) AS x, TRY_CAST(NULLIF(regexp_extract(description, '(\d{1,2})\s*/\s*(\d{1,2})\s*поверх', 1), '') AS BIGINT) AS f0,
   TRY_CAST(NULLIF(regexp_extract(description, '(\d{1,2})\s*/\s*(\d{1,2})\s*поверх', 2), '') AS BIGINT) AS ft0, NULL AS f, NULL AS ft FROM listings) l)""")
def _(t):
    rows = t.listings.select(
        "id", "source", "operation", "external_id", "url", "property_type", "title", F.regexp_replace("description", r"\d+/\d+ поверх|\d+-кімнатна|\d+ м²", "").alias("description"),
        F.concat(F.col("price_uah").try_cast("bigint").cast("string"), F.lit(" грн/міс")).alias("price_raw"), F.col("rooms").cast("string").alias("rooms"),
        F.col("area").cast("string").alias("area"), F.col("floor").cast("string").alias("floor"), F.col("floors_total").cast("string").alias("floors_total"),
        "agent_type", "district", "street", "agent_phone")
    out = N.normalize_listing(rows)
    return out.join(t.listings.select("source", "external_id", "id"), ["source", "external_id"]).select(
        "id", "property_type", "price_uah", "rooms", "area", "floor", "floors_total", "agent_type", F.array_join("validation_errors", ",").alias("errors"),
        F.col("extraction_confidence")["price"].alias("price_confidence"))


@query("normalize_commercial")
def _(t):
    """The wide commercial record over listing texts (its parts have their own oracles)."""
    rows = t.listings.select("source", "operation", "external_id", "url", "title", "description", "district", "street",
                             F.concat(F.col("price_usd").try_cast("bigint").cast("string"), F.lit(" $/міс")).alias("price_raw"), F.col("area").cast("string").alias("area"),
                             F.col("floor").cast("string").alias("floor"), F.col("floors_total").cast("string").alias("floors_total"), F.col("agent_phone").alias("contact_phone"))
    out = N.normalize_commercial(rows)
    return out.select("external_id", "commercial_type", "price_amount", "price_currency", "price_period", "price_per_m2", "area_total_m2", "floor", "floors_total",
                      "city", "advertiser_type", F.array_join("phones", ",").alias("phones"), F.array_join("validation_errors", ",").alias("errors"), "ai_title")


JS = lambda path: f"json_extract_string(payload, '$.{path}')"
ITEM = cte("payloads", i=f"""SELECT event_id, operation, {JS('id')} AS id, trim(regexp_replace({JS('title')}, '\\s+', ' ', 'g')) AS title, TRY_CAST({JS('price')} AS DOUBLE) AS price, upper({JS('currency')}) AS cur,
 CAST({JS('rooms')} AS BIGINT) AS rooms, CAST({JS('floor')} AS BIGINT) AS floor, CAST({JS('total_floors')} AS BIGINT) AS total, {JS('city.name')} AS city, {JS('district')} AS district, {JS('photos[0].src')} AS p0, {JS('photos[1].url')} AS p1, {JS('props.k')} AS k FROM payloads""")


@query("read_payloads", ITEM + "SELECT event_id, id, title, price, rooms FROM (SELECT event_id, id, json_extract_string(payload, '$.title') AS title, CAST(price AS VARCHAR) AS price, CAST(rooms AS VARCHAR) AS rooms FROM (SELECT p.event_id, p.payload, i.id, json_extract_string(p.payload, '$.price') AS price, i.rooms FROM payloads p JOIN i USING (event_id)))")
def _(t):
    return payloads.read_payloads(t.payloads).select("event_id", "id", "title", "price", "rooms")


@query("normalize_payload", ITEM + """SELECT event_id, id AS external_id, 'feed_olx' AS origin_source, title, CASE WHEN cur = 'UAH' THEN price END AS price_uah, CASE WHEN cur = 'USD' THEN price END AS price_usd, rooms,
 CASE WHEN floor > total THEN NULL ELSE floor END AS floor, CASE WHEN floor > total THEN NULL ELSE total END AS floors_total, city, district, p0 || ',' || p1 AS photos,
 array_to_string(list_filter([CASE WHEN COALESCE(price, 0) = 0 THEN 'missing or invalid price' END, CASE WHEN floor > total THEN 'invalid floor pair cleared' END], lambda x: x IS NOT NULL), ',') AS errors,
 CAST(round_even((1 + CASE WHEN COALESCE(price, 0) <> 0 THEN 1 ELSE 0 END + 3) * 100.0 / 9, 0) AS INT) AS completeness FROM i""")
def _(t):
    out = N.normalize_payload(payloads.read_payloads(t.payloads))
    d = lambda c: F.col(c).cast("double").alias(c)
    return out.select(F.col("external_id").cast("bigint").alias("event_id"), "external_id", "origin_source", "title", d("price_uah"), d("price_usd"), "rooms", "floor", "floors_total",
                      "city", "district", F.array_join("photos", ",").alias("photos"), F.array_join("validation_errors", ",").alias("errors"), F.col("data_completeness").alias("completeness"))


@query("completeness", L + "SELECT id, CAST(round_even((" + " + ".join(
    f"CASE WHEN {c} IS NOT NULL AND {c} <> {v} THEN 1 ELSE 0 END" for c, v in (("title", "''"), ("description", "''"), ("price_uah", "0"), ("price_usd", "0"), ("price_eur", "0"), ("area", "0"), ("district", "''"), ("city", "''"), ("photo_url", "''")))
    + ") * 100.0 / 9, 0) AS INT) AS score FROM listings")
def _(t):
    rows = t.listings
    return rows.select("id", N.completeness(rows).alias("score"))


@query("manual_rows", cte("listings") + """SELECT 'manual:' || CAST(id AS VARCHAR) AS id, operation, COALESCE(title, '') AS title, area, CASE WHEN source = 'olx' THEN price_uah END AS price_uah, CASE WHEN source <> 'olx' THEN price_uah END AS price_usd
FROM listings WHERE status <> 'archived' OR status IS NULL""")
def _(t):
    op = F.when(F.col("status") == "archived", "?").when(F.col("operation") == "rent", "Оренда").otherwise("Продаж")
    rows = t.listings.select(F.col("id").cast("string").alias("id"), op.alias("operation"), F.lit("офіс").alias("kind"), "title", "url", F.col("price_uah").cast("string").alias("price"),
                             F.when(F.col("source") == "olx", "uah").otherwise("$").alias("currency"), "district", "street", F.col("area").cast("string").alias("area"), F.lit("").alias("description"),
                             F.lit("").alias("comment"))
    return N.manual_rows(rows, "apartments").select("id", "operation", "title", "area", "price_uah", "price_usd")


# ---- sources and sinks -----------------------------------------------------------------------


@query("scan_raw", "SELECT page_id, url FROM pages WHERE length(html) >= 2000")
def _(t):
    return P.scan_raw(t.pages, 2000).select("page_id", "url")


EXPORT = """WITH e AS (SELECT CASE WHEN event_type = 'signup' THEN NULL ELSE 'olx_' || CAST(user_id AS VARCHAR) END AS k, event_id, CASE WHEN event_type = 'error' THEN NULL ELSE '+38067' || CAST(1000000 + event_id % 3 AS VARCHAR) END AS ph FROM events)
"""


def _export(t):
    phone = F.when(F.col("event_type") != "error", F.concat(F.lit("067 "), (F.lit(1000000) + F.col("event_id") % 3).cast("string")))
    return t.events.select(F.lit("").alias("external_token"), F.when(F.col("event_type") == "signup", "no id here").otherwise(
        F.concat(F.lit("https://board.example/x-ID"), F.col("user_id").cast("string"), F.lit(".html"))).alias("url"), phone.alias("phone"), F.col("event_id").alias("pos"))


@query("merge_export", EXPORT + """SELECT k AS external_id, string_agg(ph, ',' ORDER BY o) AS phones FROM (SELECT k, ph, min(event_id) AS o FROM e WHERE k IS NOT NULL AND ph IS NOT NULL GROUP BY k, ph) GROUP BY k""")
def _(t):
    return payloads.merge_export(_export(t))[0].select("external_id", F.array_join("merged", ",").alias("phones"))


@query("merge_values_long", EXPORT + """SELECT k AS external_id, row_number() OVER (PARTITION BY k ORDER BY o, ph) AS value_no, ph AS value
 FROM (SELECT k, ph, min(event_id) AS o FROM e WHERE k IS NOT NULL AND ph IS NOT NULL GROUP BY k, ph)""")
def _(t):
    keyed = payloads.keyed_export(_export(t))
    return V.ordered_values(keyed, "external_id", "phones", "pos", width=512)


@query("grid_roundtrip", L + """SELECT operation AS tab, count(*) AS n_rows FROM listings GROUP BY 1""")
def _(t):
    path = f"{scratch_dir(t.spark)}/grid-{uuid.uuid4().hex}"
    rows = t.listings.select(F.col("operation").alias("tab"), "id", "title", "description", "comments")
    return grids.write_grid(rows, path)


@query("grid_aliases", L + "SELECT id, COALESCE(url, '') AS url, title, '' AS notes FROM listings")
def _(t):
    rows = t.listings.select(F.col("id").alias("ID "), F.col("url").alias("Посилання"), F.col("title").alias("Title"), "district")
    named = grids.rename_aliases(rows, {"id": ["id"], "url": ["url", "link", "посилання"], "title": ["title"]})
    return grids.assert_header(grids.conform(named, ["id", "url", "title", "notes"]), ["id", "url", "title", "notes"])


@query("snapshot_json", L + """SELECT id, json_object('id', id, 'title', title, 'rooms', rooms) AS snapshot FROM listings""")
def _(t):
    return grids.with_snapshot(t.listings.select("id", "title", "rooms")).select("id", "snapshot")


INNER = lambda tag: f"regexp_extract(html, '(?s)<{tag}[^>]*>(.*?)</{tag}>', 1)"
TEXT = lambda e: f"NULLIF(trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace({e}, '<[^>]+>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&'), '[\\s\\p{{Z}}]+', ' ', 'g')), '')"


@query("page_fields", f"SELECT page_id, url, {TEXT(INNER('title'))} AS title, {TEXT(INNER('h1'))} AS h1 FROM pages")
def _(t):
    return P.extract_page_fields(t.pages).select("page_id", "url", "title", "h1")


@query("page_blocks", f"""SELECT page_id, (SELECT coalesce(string_agg({TEXT("x")}, '|'), '') FROM (SELECT unnest(regexp_extract_all(html, '(?s)<div [^>]*class="[^"]*ad[^"]*"[^>]*>.*?</div>')) AS x) b) AS ads,
 CAST(len(regexp_extract_all(html, '<h1[ >]')) AS INTEGER) AS n_headings FROM pages""")
def _(t):
    """Text of adverts and the number of headings of every page, parsed in Arrow batches."""
    out = P.extract_blocks(t.pages, {"heading": [("h1", "class", "*=", "")], "ad": [("div", "class", "*=", "ad")]})
    return out.select("page_id", F.array_join("ad", "|").alias("ads"), F.size("heading").alias("n_headings"))


@query("page_links", r"""SELECT DISTINCT page_id, CASE WHEN h LIKE '/%' THEN root || h ELSE h END AS href FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a\b[^>]*\bhref\s*=\s*["'']([^"'']+)["'']', 1)) AS h,
 regexp_extract(url, '^(https?://[^/]+)', 1) AS root FROM pages) WHERE h LIKE '/%' OR h LIKE 'http%'""")
def _(t):
    return P.extract_links(t.pages)


@query("board_page_fields", f"SELECT page_id, {TEXT(INNER('h1'))} AS title, CAST(0 AS INTEGER) AS n_photos FROM pages")
def _(t):
    """Listing fields of every page by the board rules; these pages have a heading and no labelled block."""
    return P.board_fields(t.pages).select("page_id", "title", F.size("photos").alias("n_photos"))


# ---- pages of listings: the markup of each site around the listings' own values ----------------------------------------------------

PAGE = """id, '<html><head><title>x</title><meta property="og:image" content="' || COALESCE(photo_url, '') || '"></head><body class="page">' ||
 '{body}' || '<ul class="more"><li><a href="/x">other</a><li>unclosed</ul></body></html>' AS html"""
V_ = lambda e: f"' || COALESCE(CAST({e} AS STRING), '') || '"
BOARD = PAGE.format(body=f"""<script type="application/ld+json">{{"@type": "Product", "name": "{V_('title')}", "description": "ld", "offers": {{"price": "{V_('CAST(price_uah AS BIGINT)')}"}}}}</script>
<h1>Heading</h1><div data-cy="ad_description"><div>{V_('description')}</div></div><ul class="css params"><li><p>Загальна площа: {V_('CAST(area AS BIGINT)')},5 м²</p></li>
<li>Поверх: {V_('floor')} / {V_('floors_total')}</li><li>Поверх окремий</li></ul><p class="css-location">Київ, {V_('street')}</p><h4 class="seller-name"> {V_('agent_name')} </h4>
<img src="https://cdn.example/{V_('id')}.jpg"><div><img data-src="https://cdn.example/b.jpg" src="x"></div>""")
AGENCY = PAGE.format(body=f"""<h1>{V_('title')}</h1><div class="offer-view-price-title">{V_('CAST(price_usd AS BIGINT)')} $</div><div class="offer-view-region">Київ, {V_('district')} р-н</div>
<div class="offer-view-address">{V_('street')}</div><div class="offer-view-details-row">{V_('rooms')} кімнати</div><div class="offer-view-details-row">{V_('CAST(area AS BIGINT)')},5 / 1 / 2 м²</div>
<div class="offer-view-details-row">{V_('floor')} з {V_('floors_total')} поверх</div><div class="offer-view-section-text"><p>{V_('description')}</p></div><a class="offer-view-rieltor-name">{V_('agent_name')}</a>
<div class="offer-view-rieltor-position">{V_("CASE agent_type WHEN 'owner' THEN 'Власник' ELSE 'Рієлтор' END")}</div><div class="offer-view-rieltor-phones">тел {V_('agent_phone')}</div>
<div class="offer-view-gallery"><img src="https://cdn.example/{V_('id')}.jpg"></div>""")
SPACED = lambda c: f"NULLIF(trim(regexp_replace({c}, '\\s+', ' ', 'g')), '')"
WHOLE = lambda c: f"CAST(CAST({c} AS BIGINT) AS VARCHAR)"


def _listing_pages(t, markup):
    return t.listings.selectExpr(*markup.split(", ", 1)[:1], markup.split(", ", 1)[1])


@query("agency_pages", L + f"""SELECT id, {SPACED('title')} AS title, {SPACED('description')} AS description, COALESCE({WHOLE('price_usd')}, '') || CASE WHEN price_usd IS NULL THEN '$' ELSE ' $' END AS price_raw,
 CAST(rooms AS VARCHAR) AS rooms, CASE WHEN area IS NULL THEN '.5' ELSE {WHOLE('area')} || '.5' END AS area, 'Київ' AS city, COALESCE(NULLIF(trim(district), ''), '') AS district, {SPACED('agent_name')} AS contact_name,
 CASE WHEN agent_type = 'owner' THEN 'owner' ELSE 'agent' END AS agent_type, NULLIF(agent_phone, '') AS contact_phone, 'https://cdn.example/' || CAST(id AS VARCHAR) || '.jpg' AS photos FROM listings""")
def _(t):
    out = P.agency_fields(_listing_pages(t, AGENCY), "id")
    return out.select("id", "title", "description", "price_raw", "rooms", "area", "city", "district", "contact_name", "agent_type", "contact_phone", F.array_join("photos", ",").alias("photos"))


@query("commercial_board_pages", L + f"""SELECT id, COALESCE({SPACED('title')}, 'Heading') AS title, COALESCE({SPACED('description')}, 'ld') AS description, {WHOLE('price_uah')} AS price_raw,
 CASE WHEN area IS NULL THEN '5' ELSE {WHOLE('area')} || ',5' END AS area, CASE WHEN floor IS NOT NULL AND floors_total IS NOT NULL THEN CAST(floor AS VARCHAR) END AS floor,
 CASE WHEN floor IS NOT NULL AND floors_total IS NOT NULL THEN CAST(floors_total AS VARCHAR) END AS floors_total, 'Поверх окремий' AS floor_label, {SPACED('agent_name')} AS contact_name,
 'https://cdn.example/' || CAST(id AS VARCHAR) || '.jpg,https://cdn.example/b.jpg' AS photos FROM listings""")
def _(t):
    out = P.commercial_board_fields(_listing_pages(t, BOARD), "id")
    return out.select("id", "title", "description", "price_raw", "area", "floor", "floors_total", "floor_label", "contact_name", F.array_join("photos", ",").alias("photos"))


@query("commercial_agency_pages", L + f"""SELECT id, {SPACED('title')} AS title, {SPACED('description')} AS description, '2' AS area, {SPACED('agent_name')} AS contact_name,
 CASE WHEN agent_type = 'owner' THEN 'owner' ELSE 'agent' END AS advertiser_type, COALESCE(agent_phone, '') AS phones, {SPACED("COALESCE(street, '') || ' Київ, ' || COALESCE(district, '') || ' р-н'")} AS address FROM listings""")
def _(t):
    out = P.commercial_agency_fields(_listing_pages(t, AGENCY), "id")
    return out.select("id", "title", "description", "area", "contact_name", "advertiser_type", F.array_join("phones", ",").alias("phones"), "address")


@query("listing_links", L + """SELECT CAST(floor(id / 25) AS BIGINT) AS page_id, CASE WHEN source = 'rieltor' THEN 'https://rieltor.example/flats-rent/view/' || CAST(id AS VARCHAR) || '/'
 ELSE 'https://olx.example/d/uk/x-ID' || CAST(id AS VARCHAR) || '.html' END AS href, CASE WHEN source = 'rieltor' THEN 'rieltor_' ELSE 'olx_' END || CAST(id AS VARCHAR) AS external_id FROM listings""")
def _(t):
    """Index pages of 25 listings each, and the ids of the listings that they link to."""
    link = F.when(F.col("source") == "rieltor", F.format_string("https://rieltor.example/flats-rent/view/%d/", "id")).otherwise(F.format_string("/d/uk/x-ID%d.html", "id"))
    anchor = F.concat(F.lit('<a class="card" href="'), link, F.lit('">x</a> <a href="/help">?</a>'))
    index = t.listings.groupBy(F.floor(F.col("id") / 25).alias("page_id")).agg(F.array_join(F.collect_list(anchor), "\n").alias("html"))
    return P.extract_links(index.withColumn("url", F.lit("https://olx.example/list/")), sites=D.SITE_RULES)
