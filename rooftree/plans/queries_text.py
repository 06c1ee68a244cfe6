"""Queries for text, number, phone, identifier, redaction and array functions."""
from pyspark.sql import functions as F

from rooftree import defaults as D
from rooftree.functions import arrays as A
from rooftree.functions import copygen as C
from rooftree.functions import facts as X
from rooftree.functions import money as M
from rooftree.functions import text as T
from rooftree.operators import snapshots as SN
from rooftree.plans.bindings import cte
from rooftree.plans.registry import query

L = cte("listings")
WS = r"'[\s\p{Z}]+'"


@query("clean_text", f"SELECT doc_id, trim(regexp_replace(text, {WS}, ' ', 'g')) AS clean FROM documents")
def _(t):
    return t.read("documents").select("doc_id", T.clean_text("text").alias("clean"))


@query("extract_numbers", r"""SELECT doc_id, TRY_CAST(replace(n, ',', '.') AS DOUBLE) AS number, TRY_CAST(trunc(TRY_CAST(replace(n, ',', '.') AS DOUBLE)) AS BIGINT) AS whole
FROM (SELECT doc_id, NULLIF(regexp_extract(replace(replace(text, chr(160), ''), ' ', ''), '\d+[.,]?\d*'), '') AS n FROM documents)""")
def _(t):
    return t.read("documents").select("doc_id", T.extract_number("text").alias("number"), T.extract_int("text").alias("whole"))


PRICE_TEXT = "CASE o_custkey % 5 WHEN 0 THEN '$ ' WHEN 1 THEN 'EUR' WHEN 2 THEN '' ELSE '' END || CAST(o_orderkey AS STRING) || CASE o_custkey % 7 WHEN 0 THEN ' 500' WHEN 1 THEN ',50' WHEN 2 THEN '.000.000' ELSE '' END || CASE o_custkey % 3 WHEN 0 THEN ' грн/міс' ELSE '' END"


@query("parse_price", rf"""WITH p AS (SELECT o_orderkey, {PRICE_TEXT} AS raw FROM orders), k AS (SELECT *, trim(regexp_replace(raw, '[^0-9.,]', '', 'g'), '.,') AS kept FROM p),
 v AS (SELECT *, TRY_CAST(replace(CASE WHEN length(kept) - length(replace(kept, '.', '')) > 1 THEN replace(kept, '.', '') ELSE kept END, ',', '.') AS DOUBLE) AS direct FROM k)
SELECT o_orderkey, CASE WHEN direct > 0 THEN direct ELSE CASE WHEN TRY_CAST(regexp_replace(raw, '\D', '', 'g') AS DOUBLE) > 0 THEN TRY_CAST(regexp_replace(raw, '\D', '', 'g') AS DOUBLE) END END AS amount,
 CASE WHEN contains(raw, '$') THEN 'USD' WHEN contains(raw, 'EUR') THEN 'EUR' WHEN contains(raw, 'грн') THEN 'UAH' ELSE '' END AS currency FROM v""")
def _(t):
    rows = t.read("orders").selectExpr("o_orderkey", f"{PRICE_TEXT} AS raw")
    return rows.select("o_orderkey", M.parse_price("raw").alias("p")).select("o_orderkey", "p.amount", "p.currency")


@query("content_hash", "SELECT doc_id, md5(text) AS md5, sha256(text) AS sha FROM documents")
def _(t):
    return t.documents.select("doc_id", T.content_hash("text").alias("md5"), T.content_hash("text", "sha256").alias("sha"))


PHONE_TEXT = "CASE o_custkey % 4 WHEN 0 THEN '067 ' WHEN 1 THEN '+38 (050) ' WHEN 2 THEN '44-' ELSE ' 8 067 ' END || lpad(CAST(o_orderkey AS STRING), 7, '3')"


@query("normalize_phone", rf"""SELECT o_orderkey, CASE WHEN length(d) = 10 AND d LIKE '0%' THEN '+38' || d WHEN length(d) = 12 AND d LIKE '380%' THEN '+' || d ELSE trim(raw) END AS phone,
 CASE WHEN length(d) = 10 AND d LIKE '0%' THEN '+38' || d WHEN length(d) = 12 AND d LIKE '380%' THEN '+' || d ELSE '' END AS feed_phone,
 CASE WHEN length(d) = 10 AND d LIKE '0%' THEN '+38' || d WHEN length(d) = 12 AND d LIKE '380%' THEN '+' || d ELSE d END AS digit_phone
FROM (SELECT o_orderkey, {PHONE_TEXT} AS raw, regexp_replace({PHONE_TEXT}, '\D', '', 'g') AS d FROM orders)""")
def _(t):
    rows = t.read("orders").selectExpr("o_orderkey", f"{PHONE_TEXT} AS raw")
    return rows.select("o_orderkey", T.normalize_phone("raw").alias("phone"), T.normalize_phone("raw", "blank").alias("feed_phone"),
                       T.normalize_phone("raw", "digits").alias("digit_phone"))


@query("extract_phones", r"""SELECT doc_id, array_to_string(list_filter(x, lambda v, i: list_position(x, v) = i), '|') AS raw_phones FROM (SELECT doc_id,
 list_transform(list_filter(regexp_extract_all(text, '\+?\d[\d\s()\-]{8,}', 0), lambda p: length(regexp_replace(p, '\D', '', 'g')) = 11), lambda p: trim(p)) AS x FROM documents)""")
def _(t):
    found = T.extract_phones("text", D.PHONE_LOOSE, 11, 11)
    return t.read("documents").select("doc_id", F.array_join(found, "|").alias("raw_phones"))


@query("detect_tokens", """SELECT doc_id, CASE WHEN contains(x, 'nicht') THEN 'german' WHEN contains(x, ' les ') OR contains(x, ' des ') THEN 'french' WHEN contains(x, ' los ') THEN 'spanish'
 WHEN contains(x, ' the ') THEN 'english' ELSE 'unknown' END AS kind, CASE WHEN contains(x, 'license') OR contains(x, 'copyright') THEN TRUE END AS licensed FROM (SELECT doc_id, lower(text) AS x FROM documents)""")
def _(t):
    kinds = [("german", ["nicht"]), ("french", [" les ", " des "]), ("spanish", [" los "]), ("english", [" the "])]
    return t.read("documents").select("doc_id", X.detect_by_tokens("text", kinds, "unknown").alias("kind"), X.flag("text", ["license", "copyright"]).alias("licensed"))


@query("normalize_district", L + """SELECT id, CASE WHEN d = '' THEN '' WHEN d IN ('District 1', 'District 2') THEN d WHEN d = 'District 3' THEN 'Third' WHEN contains(lower(d), 'ict 4') THEN 'ict 4'
 WHEN contains('district 50', lower(d)) THEN 'District 50' WHEN contains(lower(d), '9') THEN 'Ninth' ELSE d END AS district FROM (SELECT id, trim(district) AS d FROM listings)""")
def _(t):
    return t.listings.select("id", X.normalize_district("district", ["District 1", "District 2", "ict 4", "District 50"],
                                                        {"District 3": "Third", "9": "Ninth"}).alias("district"))


@query("parse_address", L + r"""SELECT id, district, street, CASE WHEN contains(full_address, 'ЖК') THEN trim(regexp_extract(full_address, 'ЖК\s*[«"'']?([^»"'',]+)', 1)) ELSE '' END AS complex, full_address FROM (
 SELECT id, CASE WHEN COALESCE(district, '') <> '' THEN district WHEN contains(description, 'Печерський') THEN 'Печерський' ELSE '' END AS district,
 COALESCE(trim(street), CASE WHEN contains(description, 'вул.') THEN trim(regexp_extract(description, 'вул\.\s*([^,]+)', 1)) END, '') AS street, COALESCE(trim(description), '') AS full_address FROM listings)""")
def _(t):
    names = ["Печерський"] + [f"District {i}" for i in range(10)]
    a = t.listings.select("id", X.parse_address("description", "district", "street", F.lit(""), names=names, aliases={"zzz": "zzz"}).alias("a"))
    return a.select("id", "a.district", "a.street", F.col("a.residential_complex").alias("complex"), "a.full_address")


@query("extract_street", L + r"""SELECT id, CASE WHEN contains(description, 'вул.') THEN trim(regexp_extract(description, 'вул\.\s*([^,\n|/]{3,80})', 1)) END AS street FROM listings""")
def _(t):
    return t.listings.select("id", X.extract_street("description").alias("street"))


@query("facts_from_text", L + r"""SELECT id, TRY_CAST(NULLIF(regexp_extract(description, '(\d)\s*-?\s*(?:кімн|комн)', 1), '') AS BIGINT) AS rooms,
 TRY_CAST(replace(NULLIF(regexp_extract(description, '(\d+(?:[.,]\d+)?)\s*(?:м²|кв\.?\s*м)', 1), ''), ',', '.') AS DOUBLE) AS area,
 TRY_CAST(NULLIF(regexp_extract(description, '(\d{1,2})\s*/\s*(\d{1,2})\s*поверх', 1), '') AS BIGINT) AS floor,
 TRY_CAST(NULLIF(regexp_extract(description, '(\d{1,2})\s*/\s*(\d{1,2})\s*поверх', 2), '') AS BIGINT) AS floors_total FROM listings""")
def _(t):
    f = X.floor_from_text("description")
    return t.listings.select("id", X.rooms_from_text("description").alias("rooms"), X.area_from_text("description").alias("area"),
                             f["floor"].alias("floor"), f["floors_total"].alias("floors_total"))


@query("detect_agent", L + """SELECT id, CASE WHEN contains(d, 'власник') OR contains(d, 'без комісі') THEN 'owner' WHEN contains(d, 'агент') THEN 'agent' ELSE 'unknown' END AS agent,
 CASE WHEN contains(d, 'власник') THEN 'owner' WHEN contains(d, 'агентств') THEN 'agency' END AS agency_first FROM (SELECT id, lower(COALESCE(description, '')) AS d FROM listings)""")
def _(t):
    return t.listings.select("id", X.detect_agent("description").alias("agent"), X.detect_agent("description", D.AGENT_AGENCY_FIRST, None).alias("agency_first"))


FEE_TEXT = "CASE o_custkey % 8 WHEN 0 THEN 'Оренда без комісії' WHEN 1 THEN 'комісія: ' || CAST(o_orderkey % 120 AS STRING) || '%' WHEN 2 THEN CAST(o_orderkey % 90 + 1 AS STRING) || ' % комісія агентства' WHEN 3 THEN 'Комиссионные ' || CAST(o_orderkey + 1 AS STRING) || ' грн' WHEN 4 THEN 'Комісія обговорюється' WHEN 5 THEN 'послуги агенції 2,5%' WHEN 6 THEN 'комісія ' || CAST(o_orderkey + 1 AS STRING) || ' $' ELSE 'нічого про оплату' END"


@query("normalize_commission", f"""SELECT o_orderkey, CASE k WHEN 0 THEN 'Без комісії' WHEN 1 THEN CASE WHEN p = 0 THEN 'Без комісії' WHEN p <= 100 THEN 'Комісія ' || p || '%' ELSE 'Комісія: умови уточнюються' END
 WHEN 2 THEN 'Комісія ' || (o_orderkey % 90 + 1) || '%' WHEN 3 THEN 'Комісія ' || (o_orderkey + 1) || ' грн' WHEN 4 THEN 'Комісія: умови уточнюються' WHEN 5 THEN 'Комісія 2,5%'
 WHEN 6 THEN 'Комісія ' || (o_orderkey + 1) || ' $' ELSE 'Не вказано' END AS commission FROM (SELECT o_orderkey, o_custkey % 8 AS k, o_orderkey % 120 AS p FROM orders)""")
def _(t):
    rows = t.read("orders").selectExpr("o_orderkey", f"{FEE_TEXT} AS raw")
    return rows.select("o_orderkey", X.normalize_commission(F.lit(""), "raw").alias("commission"))


@query("reconcile_floor", cte("listings", "listings_in") + """SELECT id, CASE WHEN floor > floors_total THEN CASE WHEN rooms <= floor THEN rooms END ELSE floor END AS floor,
 CASE WHEN floor > floors_total THEN CASE WHEN rooms <= floor THEN floor END ELSE floors_total END AS floors_total,
 CASE WHEN floor > floors_total THEN CASE WHEN rooms <= floor THEN 'regex_override' ELSE 'invalid' END END AS state FROM listings""")
def _(t):
    r = X.reconcile_floor("floor", "floors_total", "rooms", "floor")
    return t.listings.select("id", r["floor"].alias("floor"), r["floors_total"].alias("floors_total"), r["state"].alias("state"))


@query("range_clean", L + """, c AS (SELECT id, CASE WHEN rooms BETWEEN 1 AND 30 THEN rooms END AS rooms, CASE WHEN floor BETWEEN 1 AND 120 THEN floor END AS floor,
 CASE WHEN floors_total BETWEEN 1 AND 120 THEN floors_total END AS floors_total, CASE WHEN area BETWEEN 10 AND 1000 THEN area END AS area FROM listings)
SELECT id, rooms, area, CASE WHEN COALESCE(floor > floors_total, FALSE) THEN NULL ELSE floor END AS floor, CASE WHEN COALESCE(floor > floors_total, FALSE) THEN NULL ELSE floors_total END AS floors_total FROM c""")
def _(t):
    return X.range_clean(t.listings.select("id", "rooms", "area", "floor", "floors_total"))


@query("enrich_from_text", L + r"""SELECT id, COALESCE(rooms, r) AS rooms, COALESCE(area, CASE WHEN a > 5 AND a < 1000 THEN a END) AS area,
 COALESCE(floor, CASE WHEN f BETWEEN 1 AND 79 THEN f END) AS floor, COALESCE(floors_total, CASE WHEN floor IS NULL AND ft BETWEEN 1 AND 79 THEN ft END) AS floors_total,
 CASE WHEN district <> '' THEN district WHEN contains(d, 'дарниц') THEN 'Дарницький' WHEN contains(d, 'оболон') THEN 'Оболонський' WHEN contains(d, 'печер') THEN 'Печерський' ELSE district END AS district,
 COALESCE(NULLIF(street, ''), CASE WHEN contains(d, 'вул.') THEN trim(regexp_extract(description, 'вул\.\s*([^,\n\d]{3,50})', 1)) END, street) AS street,
 CASE WHEN COALESCE(commission, '') <> '' THEN commission WHEN contains(d, 'без комісі') THEN 'Без комісії' WHEN contains(d, 'комісія 50%') THEN 'Комісія 50%' ELSE commission END AS commission,
 CASE WHEN COALESCE(agent_type, '') <> '' THEN agent_type WHEN contains(d, 'власник') THEN 'owner' WHEN contains(d, 'агентств') THEN 'agency' ELSE agent_type END AS agent_type
FROM (SELECT *, lower(COALESCE(description, '')) AS d, TRY_CAST(NULLIF(regexp_extract(description, '(\d)\s*[-]?\s*кімнат', 1), '') AS BIGINT) AS r,
 TRY_CAST(NULLIF(regexp_extract(description, '(\d+)\s*м²', 1), '') AS DOUBLE) AS a, TRY_CAST(NULLIF(regexp_extract(description, '(\d{1,2})\s*/\s*(\d{1,2})', 1), '') AS BIGINT) AS f,
 TRY_CAST(NULLIF(regexp_extract(description, '(\d{1,2})\s*/\s*(\d{1,2})', 2), '') AS BIGINT) AS ft FROM listings)""")
def _(t):
    return X.enrich_from_text(t.listings).select("id", "rooms", "area", "floor", "floors_total", "district", "street", "commission", "agent_type")


@query("convert_currency", L + """SELECT id, CAST(round_even(CASE c WHEN 'UAH' THEN a WHEN 'USD' THEN a * 41.5 WHEN 'EUR' THEN a * 45.0 ELSE a END, 0) AS DOUBLE) AS uah,
 CAST(round_even(CASE c WHEN 'UAH' THEN a / 41.5 WHEN 'USD' THEN a WHEN 'EUR' THEN a * 45.0 / 41.5 ELSE a END, 0) AS DOUBLE) AS usd,
 CAST(round_even(CASE c WHEN 'UAH' THEN a / 45.0 WHEN 'USD' THEN a * 41.5 / 45.0 WHEN 'EUR' THEN a ELSE a END, 0) AS DOUBLE) AS eur
FROM (SELECT id, price_uah AS a, CASE WHEN source = 'olx' THEN 'UAH' WHEN source = 'rieltor' THEN 'USD' WHEN operation = 'rent' THEN 'EUR' ELSE 'GBP' END AS c FROM listings)""")
def _(t):
    cur = (F.when(F.col("source") == "olx", "UAH").when(F.col("source") == "rieltor", "USD").when(F.col("operation") == "rent", "EUR").otherwise("GBP"))
    return t.listings.select("id", M.convert_currency("price_uah", cur).alias("c")).select("id", "c.uah", "c.usd", "c.eur")


BOARD = """SELECT CASE n_nationkey % 4 WHEN 0 THEN 840 WHEN 1 THEN 978 ELSE 985 END AS code_a, 980 AS code_b, CASE WHEN n_nationkey < 4 THEN 0 ELSE 40.0 + n_nationkey / 8.0 END AS rate_sell,
 39.0 + n_nationkey / 16.0 AS rate_buy, CAST(NULL AS DOUBLE) AS rate_cross FROM nation"""


@query("pick_rates", f"""SELECT max(CASE WHEN code_a = 840 THEN COALESCE(NULLIF(rate_sell, 0), NULLIF(rate_buy, 0)) END) AS usd,
 max(CASE WHEN code_a = 978 THEN COALESCE(NULLIF(rate_sell, 0), NULLIF(rate_buy, 0)) END) AS eur FROM ({BOARD.replace('40.0', 'CAST(40 AS DOUBLE)').replace('39.0', 'CAST(39 AS DOUBLE)')})""")
def _(t):
    k = F.col("n_nationkey")
    items = t.nation.select(F.when(k % 4 == 0, 840).when(k % 4 == 1, 978).otherwise(985).alias("code_a"), F.lit(980).alias("code_b"),
                            F.when(k < 4, 0.0).otherwise(40.0 + k / 8.0).alias("rate_sell"), (39.0 + k / 16.0).alias("rate_buy"),
                            F.lit(None).cast("double").alias("rate_cross"))
    return M.pick_rates(items)


@query("fill_prices", L + """, a AS (SELECT id, price_uah, price_usd, COALESCE(price_eur, round(CASE WHEN price_uah > 0 THEN price_uah END / CAST(51.52 AS DOUBLE)),
 round(CASE WHEN price_usd > 0 THEN price_usd END * CAST(45.03 AS DOUBLE) / CAST(51.52 AS DOUBLE))) AS price_eur FROM listings),
 b AS (SELECT id, price_uah, price_eur, COALESCE(price_usd, round(CASE WHEN price_uah > 0 THEN price_uah END / CAST(45.03 AS DOUBLE))) AS price_usd FROM a)
SELECT id, price_eur, price_usd, COALESCE(price_uah, round(CASE WHEN price_usd > 0 THEN price_usd END * CAST(45.03 AS DOUBLE))) AS price_uah FROM b""")
def _(t):
    return M.fill_prices(t.listings.select("id", "price_uah", "price_usd", "price_eur"))


OFFER = "CASE o_custkey % 4 WHEN 0 THEN CAST(10 + o_orderkey % 90 AS STRING) || ' $/м²' WHEN 1 THEN CAST(500 + o_orderkey AS STRING) || ' грн/міс' WHEN 2 THEN '€ ' || CAST(1000 + o_orderkey AS STRING) || ', $ 12 за м2' ELSE 'договірна' END"


@query("commercial_price", f"""SELECT o_orderkey, CASE k WHEN 0 THEN (10 + o_orderkey % 90) * CAST(50 AS DOUBLE) WHEN 1 THEN 500 + o_orderkey WHEN 2 THEN 1000 + o_orderkey END AS total,
 CASE k WHEN 0 THEN 'USD' WHEN 1 THEN 'UAH' WHEN 2 THEN 'EUR' ELSE 'UNKNOWN' END AS currency, CASE k WHEN 1 THEN 'month' ELSE 'unknown' END AS period,
 CASE k WHEN 0 THEN 10 + o_orderkey % 90 WHEN 1 THEN (500 + o_orderkey) / CAST(50 AS DOUBLE) WHEN 2 THEN 12 END AS rate, CASE k WHEN 0 THEN 'USD' WHEN 1 THEN 'UAH' WHEN 2 THEN 'USD' ELSE 'UNKNOWN' END AS rate_currency,
 CASE k WHEN 1 THEN 'month' ELSE 'unknown' END AS rate_period FROM (SELECT o_orderkey, o_custkey % 4 AS k FROM orders)""")
def _(t):
    rows = t.read("orders").selectExpr("o_orderkey", f"{OFFER} AS raw")
    p = M.parse_commercial_price("raw", F.lit("rent"), F.lit(50.0))
    return rows.select("o_orderkey", p.alias("p")).select("o_orderkey", "p.*")


@query("listing_price", f"""SELECT o_orderkey, CASE k WHEN 0 THEN (10 + o_orderkey % 90) * CAST(60 AS DOUBLE) WHEN 1 THEN CASE WHEN o_orderkey = 0 THEN CAST(500 * 60 AS DOUBLE) ELSE 500 + o_orderkey END WHEN 2 THEN 1000 + o_orderkey END AS total,
 CASE k WHEN 0 THEN 'USD' WHEN 1 THEN 'UAH' WHEN 2 THEN 'EUR' ELSE 'UNKNOWN' END AS currency FROM (SELECT o_orderkey, o_custkey % 4 AS k FROM orders)""")
def _(t):
    rows = t.read("orders").selectExpr("o_orderkey", f"{OFFER} AS raw")
    p = M.price_from_listing("raw", F.lit("Офіс у центрі"), F.lit("без торгу"), F.lit("rent"), F.lit(60.0))
    return rows.select("o_orderkey", p.alias("p")).select("o_orderkey", "p.total", "p.currency")


AREA_TEXT = "CASE o_custkey % 4 WHEN 0 THEN 'Загальна площа: ' || CAST(3 + o_orderkey % 400 AS STRING) || ' м², корисна площа ' || CAST(1 + o_orderkey % 90 AS STRING) || ' м2' WHEN 1 THEN 'склад ' || CAST(o_orderkey % 900 AS STRING) || ',5 кв. м' WHEN 2 THEN '4 м², зал ' || CAST(60 + o_orderkey % 50 AS STRING) || ' м²' ELSE 'офіс' END"


@query("extract_areas", f"""SELECT o_orderkey, CASE k WHEN 0 THEN CASE WHEN 3 + o_orderkey % 400 >= 5 THEN 3 + o_orderkey % 400 WHEN 1 + o_orderkey % 90 >= 5 THEN 1 + o_orderkey % 90 END
 WHEN 1 THEN CASE WHEN o_orderkey % 900 + 0.5 >= 5 THEN CAST(o_orderkey % 900 + 0.5 AS DOUBLE) END WHEN 2 THEN 60 + o_orderkey % 50 END AS total,
 CASE WHEN k = 0 AND 1 + o_orderkey % 90 >= 5 THEN CAST(1 + o_orderkey % 90 AS DOUBLE) END AS usable FROM (SELECT o_orderkey, o_custkey % 4 AS k FROM orders)""")
def _(t):
    rows = t.read("orders").selectExpr("o_orderkey", f"{AREA_TEXT} AS raw")
    return rows.select("o_orderkey", X.extract_areas("raw").alias("a")).select("o_orderkey", "a.total", "a.usable")


SP = r"'[\s\p{Z}]+'"


@query("score_description", rf"""WITH d AS (SELECT doc_id, trim(text) AS d FROM documents), s AS (SELECT *, len(list_filter(regexp_split_to_array(d, '[.!?]'), lambda x: length(trim(regexp_replace(x, {SP}, ' ', 'g'))) > 5)) AS n FROM d)
SELECT doc_id, CASE WHEN length(d) < 40 THEN 0 WHEN contains(lower(d), 'broker') OR contains(lower(d), 'call now') THEN 20 WHEN regexp_matches(d, '[{{}}\[\]<>]') THEN 10
 ELSE least(40 + CASE WHEN n >= 2 THEN 20 ELSE 0 END + CASE WHEN n >= 3 THEN 15 ELSE 0 END + CASE WHEN length(d) > 100 THEN 10 ELSE 0 END + CASE WHEN length(d) > 200 THEN 10 ELSE 0 END, 100) END AS score,
 CASE WHEN length(d) < 40 THEN 'too_short' WHEN contains(lower(d), 'broker') OR contains(lower(d), 'call now') THEN 'spam' WHEN regexp_matches(d, '[{{}}\[\]<>]') THEN 'technical_junk' ELSE 'ok' END AS reason FROM s""")
def _(t):
    return t.read("documents").select("doc_id", C.score_description("text").alias("s")).select("doc_id", "s.score", "s.reason")


@query("score_title", L + """, x AS (SELECT *, lower(trim(COALESCE(title, ''))) AS t FROM listings)
SELECT id, CASE WHEN length(t) < 6 THEN 0 ELSE 50 + CASE WHEN rooms <> 0 AND contains(title, CAST(rooms AS VARCHAR)) THEN 10 ELSE 0 END
 + CASE WHEN area <> 0 AND contains(title, CAST(area AS VARCHAR)) THEN 10 ELSE 0 END + CASE WHEN district <> '' AND contains(t, lower(district)) THEN 15 ELSE 0 END + 5 END AS score,
 CASE WHEN length(t) < 6 THEN 'too_short' ELSE 'ok' END AS reason FROM x""")
def _(t):
    return t.listings.select("id", C.score_title("title", "rooms", "area", "district").alias("s")).select("id", "s.score", "s.reason")


@query("passes_quality", L + """SELECT id, title IS NOT NULL AND title <> '' AND COALESCE(length(trim(description)) >= 40 AND NOT contains(lower(description), 'комісія'), FALSE) AS passed FROM listings""")
def _(t):
    return t.listings.select("id", C.passes_quality("title", "description").alias("q")).select("id", "q.passed")


# ---- sentences in SQL: a mark behind the sentence's end, then a split there --------------------------------------------------------

CLEANED = lambda e: f"trim(regexp_replace({e}, {SP}, ' ', 'g'))"
SENTENCES = lambda e: f"string_split(regexp_replace({e}, '([.!?])[\\s\\p{{Z}}]+', '\\1' || chr(1), 'g'), chr(1))"


def _unescaped(e):
    for entity, char in T.ENTITIES:
        e = f"replace({e}, '{entity}', '{char.replace(chr(39), chr(39) * 2)}')"
    return e


def _paragraphs(paragraphs, kept):
    """Paragraphs of the sentences that ``kept`` (over the list of a paragraph ``p``) leaves."""
    return f"array_to_string(list_filter(list_transform({paragraphs}, lambda p: array_to_string({kept}, ' ')), lambda x: x <> ''), chr(10) || chr(10))"


HIDDEN = r"(?i)\b(?:email|phone|password|private|secret)[\p{L}\p{N}_]*|@"
NO_LABEL = "regexp_replace(" + CLEANED("s") + r", '(?i)^(?:опис|описание|description)\s*[:\-–—]*\s*', '')"
TIDY = f"regexp_replace(s, '{HIDDEN}', '', 'g')"
REDACTED = rf"""WITH a AS (SELECT doc_id, regexp_replace(regexp_replace(COALESCE(text, ''), '\+?\d[\d\s()\-]{{8,}}', '', 'g'), '(?i)https?://\S+|www\.\S+', '', 'g') AS t FROM documents),
b AS (SELECT doc_id, t, string_split_regex(t, '(?i)\*?\s*english\s+text')[1] AS head FROM a),
c AS (SELECT doc_id, regexp_replace(CASE WHEN length(head) > 500 OR length(head) = length(t) THEN head ELSE regexp_replace(t, '(?i)\*?\s*english\s+text[^\n]*', '', 'g') END,
 '(?i)\b(?:call|mail)[\p{{L}}\p{{N}}_]*\b[^.!?\n]*', ' ', 'g') AS t FROM b)
SELECT doc_id, {_paragraphs("string_split_regex(t, '" + chr(92) + "n" + chr(92) + "s*" + chr(92) + "n+')", "list_transform(list_filter(list_transform(" + SENTENCES("p") + ", lambda s: " + NO_LABEL + "), lambda s: length(" + TIDY + ") >= 12 AND (" + TIDY + " = s OR NOT regexp_matches(" + TIDY + ", '" + HIDDEN + "'))), lambda s: " + TIDY + ")")} AS clean FROM c"""
PUBLIC = "SELECT doc_id, " + _paragraphs("string_split_regex(regexp_replace(" + _unescaped("COALESCE(text, '')") + r", '<[^>]+>', ' ', 'g'), '\n{2,}')",
                                         "list_filter(" + SENTENCES(CLEANED("p")) + r", lambda s: s <> '' AND NOT regexp_matches(s, '(?i)\b(?:private|secret|password)[\p{L}\p{N}_]*|@'))") + " AS clean FROM documents"
CHUNKS = rf"""WITH RECURSIVE l AS (SELECT doc_id, unnest(string_split_regex(regexp_replace(text, '(\r\n|\n|\r)$', ''), '\r\n|\n|\r')) AS line, generate_subscripts(string_split_regex(regexp_replace(text, '(\r\n|\n|\r)$', ''), '\r\n|\n|\r'), 1) AS line_no
 FROM documents WHERE text IS NOT NULL),
w AS (SELECT doc_id, line_no, {CLEANED("line")} AS line FROM l),
first AS (SELECT doc_id, line_no, line, CASE WHEN length(line) <= 900 THEN line WHEN regexp_matches(line, '^.{{1,900}} ') THEN regexp_extract(line, '^(.{{1,900}}) ', 1) ELSE regexp_extract(line, '^[^ ]+') END AS chunk FROM w),
c AS (SELECT doc_id, line_no, 1 AS k, chunk, substr(line, length(chunk) + 2) AS rest FROM first
 UNION ALL SELECT doc_id, line_no, k + 1, piece, substr(rest, length(piece) + 2) FROM (SELECT *, CASE WHEN length(rest) <= 900 THEN rest WHEN regexp_matches(rest, '^.{{1,900}} ') THEN regexp_extract(rest, '^(.{{1,900}}) ', 1)
  ELSE regexp_extract(rest, '^[^ ]+') END AS piece FROM c WHERE rest <> '') x)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY line_no, k) - 1 AS INTEGER) AS pos, chunk FROM c"""


@query("redact_documents", REDACTED)
def _(t):
    """Whole texts without phones, links or sentences that name contact data."""
    banned = r"\b(?:email|phone|password|private|secret)\w*|@"
    return t.read("documents").select("doc_id", T.redact_text("text", banned, (r"\b(?:call|mail)\w*\b[^.!?\n]*",), D.PHONE_LOOSE, limit=None).alias("clean"))


@query("redact_phrases", rf"""SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(text, '\+?\d[\d\s()\-]{{8,}}', '', 'g'), '(?i)(?:^|\b)(?:license|licensed)[^.!?\n]*', '', 'g'), {SP}, ' ', 'g')) AS clean FROM documents""")
def _(t):
    return t.read("documents").select("doc_id", T.redact_phrases("text", r"\b(?:license|licensed)[^.!?\n]*", r"\+?\d[\d\s()\-]{8,}", None).alias("clean"))


@query("strip_html", r"""SELECT page_id, trim(regexp_replace(regexp_replace(replace(replace(replace(replace(html, '&lt;', '<'), '&gt;', '>'), '&nbsp;', ' '), '&amp;', '&'), '<[^>]+>', ' ', 'g'), '[\s\p{Z}]+', ' ', 'g')) AS body FROM pages
""".replace("replace(html, '&lt;', '<')", "replace(replace(replace(html, '&lt;', '<'), '&quot;', '\"'), '&#39;', '''')"))
def _(t):
    return t.pages.select("page_id", T.clean_text(T.strip_html("html")).alias("body"))


@query("publishable_text", PUBLIC)
def _(t):
    """Whole texts without markup and without sentences that name something private."""
    return t.read("documents").select("doc_id", T.publishable_text("text", r"\b(?:private|secret|password)\w*|@", None).alias("clean"))


@query("numbers_supported", r"""SELECT a.doc_id, len(list_filter(regexp_extract_all(a.text, '\d+(?:[.,]\d+)?'), lambda n: NOT list_contains(regexp_extract_all(COALESCE(b.html, ''), '\d+(?:[.,]\d+)?'), n)
 AND n <> CAST(a.doc_id AS VARCHAR))) = 0 AND length(trim(regexp_replace(a.text, '[\s\p{Z}]+', ' ', 'g'))) >= 180 AS supported FROM documents a LEFT JOIN pages b ON b.page_id = a.doc_id""")
def _(t):
    src = t.pages.select(F.col("page_id").alias("doc_id"), F.col("html").alias("source_text"))
    rows = t.documents.join(src, "doc_id", "left")  # a document without a page has no source but its own fields
    none = "(?!)"
    return rows.select("doc_id", T.numbers_supported("text", "source_text", ["doc_id"], 180, None, none, none, none).alias("supported"))


@query("chunk_text", CHUNKS)
def _(t):
    """Word-bounded chunks of whole texts, packed greedily."""
    return t.read("documents").select("doc_id", F.posexplode(T.chunk_text("text", 900)).alias("pos", "chunk"))


@query("external_ids", r"""SELECT page_id, url, CASE WHEN regexp_matches(url, '/(\d+)') THEN 'page_' || regexp_extract(url, '/(\d+)', 1) ELSE 'web_' || left(sha256(url), 16) END AS external_id,
 rtrim(regexp_replace(trim(url), '[#?].*$', ''), '/') AS normal_url FROM pages""")
def _(t):
    return t.pages.select("page_id", "url", T.external_id("url", [("any", r"/(\d+)", "page_")]).alias("external_id"), T.normalize_url("url").alias("normal_url"))


@query("cell_equal", cte("listings", "listings_in") + r"""SELECT a.id, COALESCE(a.title, '') = COALESCE(b.title, '') AS same_title,
 COALESCE(CAST(a.rooms AS VARCHAR), '') = COALESCE(CAST(a.rooms AS VARCHAR) || ',00', '') OR a.rooms IS NOT NULL AS same_rooms FROM listings a JOIN listings_in b USING (id)""")
def _(t):
    b = t.listings_in.select("id", F.col("title").alias("t2"))
    text = F.concat(F.lit("'"), F.col("rooms").cast("string"), F.lit(",00"))
    return t.listings.join(b, "id").select("id", T.cell_equal("title", "t2").alias("same_title"), T.cell_equal(F.col("rooms").cast("string"), text).alias("same_rooms"))


@query("row_fingerprint", L + """SELECT count(DISTINCT (title, price_uah, area, rooms, floor, floors_total)) AS prints, count(*) AS n FROM listings""")
def _(t):
    rows = t.listings
    prints = rows.select(SN.row_fingerprint(rows, ("title", "price_uah", "area", "rooms", "floor", "floors_total")).alias("p"))
    per = prints.groupBy("p").agg(F.count(F.lit(1)).alias("c"))
    return per.agg(F.count(F.lit(1)).alias("prints"), F.sum("c").alias("n"))


P = cte("photos")


@query("https_photos", P + """SELECT listing_id AS id, string_agg(url, ',' ORDER BY ord) AS urls FROM (SELECT listing_id, url, min((pos, tie)) AS ord FROM photos WHERE url LIKE 'https://%' GROUP BY ALL) GROUP BY 1""")
def _(t):
    out = t.photo_lists().select("id", F.array_join(A.https_photos("photos"), ",").alias("urls"))
    return out.where(F.col("urls") != "")


@query("rank_photos", P + """SELECT listing_id AS id, string_agg(url, ',' ORDER BY NOT regexp_matches(url, '/1\\d*\\.jpg'), ord) AS urls FROM (SELECT listing_id, url, min((pos, tie)) AS ord FROM photos GROUP BY ALL)
 WHERE NOT regexp_matches(url, '/9') GROUP BY 1""")
def _(t):
    out = t.photo_lists().select("id", F.array_join(A.rank_photos("photos", None, r"/1\d*\.jpg", "/9"), ",").alias("urls"))
    return out.where(F.col("urls") != "")


@query("prune_array", cte("photos", "media") + """SELECT p.listing_id AS id, COALESCE(string_agg(p.url, ',' ORDER BY pos, tie) FILTER (m.url IS NULL), '') AS urls
FROM photos p LEFT JOIN media m ON m.url = p.url AND m.status = 'gone' GROUP BY 1""")
def _(t):
    out = A.prune_array(t.photo_lists(), "id", "photos", t.media.where(F.col("status") == "gone"))
    return out.select("id", F.array_join("photos", ",").alias("urls"))


@query("distinct_ordered", P + """, x AS (SELECT listing_id AS id, url, (0, pos, tie) AS ord FROM photos WHERE url LIKE 'http://%' UNION ALL SELECT listing_id, url, (1, pos, tie) FROM photos)
SELECT id, string_agg(url, ',' ORDER BY o) AS urls FROM (SELECT id, url, min(ord) AS o FROM x GROUP BY ALL) GROUP BY id""")
def _(t):
    lists = t.photo_lists()
    plain = F.filter("photos", lambda u: u.startswith("http://"))
    return lists.select("id", F.array_join(A.distinct_ordered(plain, "photos"), ",").alias("urls"))
