"""Queries for filters, gates, display and validation."""
from pyspark.sql import functions as F

from rooftree import defaults as D
from rooftree.functions import display
from rooftree.functions.facts import in_city, in_region, region_label
from rooftree.functions.text import contains_any, first_non_blank, is_blank
from rooftree.operators import quality as Q
from rooftree.plans.bindings import cte
from rooftree.plans.registry import query

L = cte("listings")
KEEP = "id, source, operation"
LIVE = "source NOT LIKE 'feed%'"
GATE = ("CASE " + " ".join(f"WHEN {c} THEN '{n}'" for n, c in D.QUALITY_RULES) + " END")


@query("blank_and_first_non_blank", L + """
SELECT id, title IS NULL OR trim(title) = '' AS title_blank,
       COALESCE(NULLIF(trim(title), ''), NULLIF(trim(street), ''), NULLIF(district, '')) AS shown FROM listings""")
def _(t):
    return t.listings.select("id", is_blank("title").alias("title_blank"),
                             first_non_blank("title", "street", "district").alias("shown"))


@query("price_gate", L + f"""
SELECT {KEEP} FROM listings WHERE (operation = 'rent' AND price_uah >= 20000) OR (operation = 'buy' AND price_usd >= 60000)""")
def _(t):
    return Q.price_gate(t.listings).select("id", "source", "operation")


def _towns(c):
    return contains_any(F.lower(c), ["district 1", "district 2", "київ"])


INTAKE = """
SELECT id, operation, CASE WHEN p || s = '' THEN NULL ELSE 'policy_houses_' || p || CASE WHEN p <> '' AND s <> '' THEN '_' ELSE '' END || s END AS policy_reason
FROM (SELECT id, operation, CASE WHEN price_usd IS NULL THEN 'usd_missing'
        WHEN price_usd < CASE WHEN operation = 'rent' THEN 2000 ELSE 100000 END
        THEN 'usd_below_' || CASE WHEN operation = 'rent' THEN '2000' ELSE '100000' END ELSE '' END AS p,
      CASE WHEN contains(txt, 'district 1') OR contains(txt, 'district 2') OR contains(txt, 'київ') THEN '' ELSE 'outside_kyiv_region' END AS s
      FROM (SELECT *, lower(concat_ws(' ', coalesce(city, ''), coalesce(district, ''), coalesce(street, ''), coalesce(title, ''), coalesce(description, ''))) AS txt FROM listings))"""


@query("intake_policy", L + INTAKE)
def _(t):
    return Q.intake_policy(t.listings, region=_towns).select("id", "operation", "policy_reason")


@query("quality_gate", L + f"""
SELECT id, CASE WHEN r IS NOT NULL THEN 'quarantine' ELSE status END AS status, COALESCE(r, comments) AS comments
FROM (SELECT *, CASE WHEN status = 'active' AND {LIVE} THEN {GATE} END AS r FROM listings)""")
def _(t):
    return Q.quality_gate(t.listings).select("id", "status", "comments")


@query("quality_restore", L + f"""
SELECT id, CASE WHEN b THEN 'active' ELSE status END AS status, CASE WHEN b THEN NULL ELSE comments END AS comments FROM (
SELECT *, COALESCE(status = 'quarantine' AND {LIVE} AND ((comments IN ('rent_price_too_high', 'buy_price_too_low', 'no_price',
 'price_anomaly_rent_high', 'price_below_filter', 'price_anomaly_buy_high') AND price_uah IS NOT NULL
 AND ((operation = 'rent' AND price_uah BETWEEN 20000 AND 500000) OR (operation = 'buy' AND price_usd BETWEEN 60000 AND 5000000)))
 OR (comments = 'not_apartment' AND property_type IN ('Будинок', 'house', 'будинок'))), FALSE) AS b FROM listings)""")
def _(t):
    return Q.quality_restore(t.listings).select("id", "status", "comments")


@query("needs_backfill", L + """
SELECT id FROM listings WHERE rooms IS NULL OR area IS NULL OR COALESCE(trim(district), '') = '' OR COALESCE(trim(street), '') = ''
 OR COALESCE(trim(metro_station), '') = '' OR COALESCE(trim(photo_url), '') = '' OR COALESCE(trim(description), '') = ''
 OR (property_type = 'Квартира' AND (floor IS NULL OR floors_total IS NULL)) OR (property_type = 'Будинок' AND floors_total IS NULL)
 OR (source = 'rieltor' AND (COALESCE(trim(agent_name), '') = '' OR COALESCE(trim(agent_phone), '') = ''))""")
def _(t):
    return Q.needs_backfill(t.listings).select("id")


@query("region_filter", """
SELECT doc_id, NOT contains(x, 'private') AND (contains(x, 'nicht') OR contains(x, ' und ')) AS in_city,
 (NOT contains(x, 'private') AND (contains(x, 'nicht') OR contains(x, ' und '))) OR contains(x, ' the ') AS in_region,
 CASE WHEN NOT contains(x, 'private') AND (contains(x, 'nicht') OR contains(x, ' und ')) THEN 'Town' ELSE 'Land' END AS label
FROM (SELECT doc_id, trim(regexp_replace(lower(text), '[\\s\\p{Z}]+', ' ', 'g')) AS x FROM documents)""")
def _(t):
    city, veto = ["nicht", " und "], ["private"]
    return t.documents.select("doc_id", in_city("text", city, veto).alias("in_city"),
                              in_region("text", city, [" the "], veto).alias("in_region"),
                              region_label("text", "Town", "Land", city, veto).alias("label"))


@query("null_junk_text", L + """
SELECT id, CASE WHEN length(trim(description)) < 10 OR lower(trim(description)) IN ('опис', 'описание', 'description') THEN NULL ELSE description END AS description,
 CASE WHEN operation = 'rent' THEN replace(a, 'Продається', 'Здається в оренду') ELSE a END AS ai_description,
 CASE WHEN regexp_matches(ai_title, 'комісі|брокер|ріелтор|агент') THEN NULL ELSE ai_title END AS ai_title,
 CASE WHEN lower(commission) IN ('false', 'none', '0', 'no', 'ні', 'без', '') THEN NULL WHEN contains(lower(commission), 'без комісі') THEN 'Без комісії' ELSE commission END AS commission,
 CASE WHEN agent_type IN ('unknown', '', 'none', 'None') THEN NULL ELSE agent_type END AS agent_type
FROM (SELECT *, CASE WHEN length(trim(ai_description)) < 20 OR contains(ai_description, '[Назва') THEN NULL ELSE ai_description END AS a FROM listings)""")
def _(t):
    return Q.null_junk_text(t.listings).select("id", "description", "ai_description", "ai_title", "commission", "agent_type")


COPY_BAD = r"""(status = 'active' AND length(trim(description)) > 40 AND (
 ai_title IS NULL OR length(trim(ai_title)) < 18 OR lower(trim(ai_title)) IN ('опис', 'добре', 'ок', 'none', 'null', 'title', 'назва') OR regexp_matches(ai_title, '^#?[0-9]+')
 OR ai_description IS NULL OR length(trim(ai_description)) < 100 OR lower(trim(ai_description)) IN ('опис', 'добре', 'ок', 'none', 'null', 'description')
 OR regexp_matches(ai_description, '^#?[0-9]+')
 OR regexp_matches(lower(ai_description), 'комісі|ріелтор|риелтор|брокер|агент|власник|контакт|телефон|дзвон|звон|пишіть|звертайтеся|не турбувати')))"""


@query("needs_copy", L + f"SELECT id FROM listings WHERE {LIVE} AND {COPY_BAD}")
def _(t):
    return Q.needs_copy(t.listings).select("id")


def _safe(c, n):
    return (f"COALESCE(CASE WHEN lower(trim(CAST({c} AS VARCHAR))) IN ('none', 'null', 'false') THEN '' "
            f"WHEN regexp_matches(trim(CAST({c} AS VARCHAR)), '^[=+\\-@]') THEN '''' || left(trim(CAST({c} AS VARCHAR)), {n}) "
            f"ELSE left(trim(CAST({c} AS VARCHAR)), {n}) END, '')")


def _int(c):
    return f"COALESCE(CAST(CAST(trunc({c}) AS BIGINT) AS VARCHAR), '')"


SHOWN_ID = "(CASE WHEN source = 'rieltor' THEN 'rieltor_' || regexp_extract(url, '/(\\d+)/?$', 1) ELSE external_id END)"
GRID_SQL = L + f"""SELECT {_safe('id', 12)} AS "ID", {_safe(SHOWN_ID, 40)} AS "Ext ID",
 CASE WHEN photo_url LIKE 'http%' THEN '=IMAGE("' || photo_url || '")' ELSE '' END AS "Фото", {_safe('source', 20)} AS "Source",
 {_safe('operation', 10)} AS "Operation", COALESCE(NULLIF({_safe('property_type', 500)}, ''), 'Квартира') AS "Property Type", {_safe('url', 500)} AS "URL",
 {_safe('title', 300)} AS "Title", {_safe('ai_title', 200)} AS "AI Title", {_safe('description', 49000)} AS "Description",
 {_safe('ai_description', 49000)} AS "AI Description", {_int('price_uah')} AS "UAH", {_int('price_usd')} AS "USD", {_int('price_eur')} AS "EUR",
 {_safe('rooms', 5)} AS "Rooms", {_safe('area', 10)} AS "Area", {_safe('floor', 5)} AS "Floor", {_safe('floors_total', 5)} AS "Floors Total",
 {_safe('district', 50)} AS "District", COALESCE(NULLIF({_safe('city', 500)}, ''), 'Київ') AS "City", {_safe('street', 100)} AS "Street",
 {_safe('residential_complex', 80)} AS "Residential Complex", {_safe('metro_station', 50)} AS "Metro",
 CASE WHEN lower({_safe('agent_type', 30)}) IN ('unknown', 'none') THEN '' ELSE {_safe('agent_type', 30)} END AS "Agent Type",
 {_safe('agent_name', 80)} AS "Agent Name", {_safe('agent_phone', 50)} AS "Agent Phone",
 CASE WHEN lower({_safe('commission', 50)}) IN ('false', 'none', '0') THEN '' ELSE {_safe('commission', 50)} END AS "Commission",
 {_safe('created_at', 19)} AS "Created At", {_safe('updated_at', 19)} AS "Updated At", {_safe('comments', 100)} AS "Коментарі",
 '' AS "Telegraph UA", '' AS "Telegraph EN" FROM listings"""


@query("display_projection", GRID_SQL)
def _(t):
    return display.display_projection(t.listings, display.listing_grid_spec(D.GRID_WIDTHS))


def _plain(c, n):
    text = f"left(trim(CAST({c} AS VARCHAR)), {n})"
    return f"COALESCE(CASE WHEN regexp_matches({text}, '^[=+\\-@]') THEN '\'\'' || {text} ELSE {text} END, '')".replace("\\'\\'", "\'\'\'")


def _image(c):
    return f"CASE WHEN {c} LIKE 'http%' THEN '=IMAGE(\"' || {c} || '\")' ELSE '' END"


@query("house_display", L + "SELECT " + ", ".join(f"{_image(c) if c == 'photo_url' else _plain(c, D.HOUSE_WIDTHS[c])} AS {c}" for c in D.HOUSE_COLUMNS if not c.startswith("price") and c != "area")
       + " FROM listings")
def _(t):
    shown = display.display_projection(t.listings, display.house_grid_spec(D.HOUSE_WIDTHS))
    return shown.drop("price_uah", "price_usd", "price_eur", "area")


COMMERCIAL = {"ID": _safe("id", 30), "Ext ID": _safe("external_id", 60), "Фото": _image("photo_url"), "Джерело": _safe("source", 30),
              "Операція": "CASE operation WHEN 'rent' THEN 'Оренда' ELSE 'Продаж' END", "Тип комерції": _safe("property_type", 80), "URL": _safe("url", 1000), "Заголовок": _safe("title", 500),
              "AI заголовок": _safe("ai_title", 500), "Опис": _safe("description", 49000), "AI опис": _safe("ai_description", 49000), "Ціна за приміщення, грн": _int("price_uah"),
              "Ціна за приміщення, $": _int("price_usd"), "Ціна за приміщення, €": _int("price_eur"), "Площа, м²": _int("area"), "Район": _safe("district", 100), "Місто": _safe("city", 50),
              "Вулиця": _safe("street", 160), "Генератор": "CASE WHEN rooms > 2 THEN 'Так' ELSE '' END", "Ім'я": _safe("agent_name", 100), "Телефони": _safe("agent_phone", 300),
              "Створено": _safe("created_at", 40), "Коментарі": _safe("comments", 1000)}


@query("commercial_display", L + "SELECT " + ", ".join(f'{e} AS "{n}"' for n, e in COMMERCIAL.items()) + " FROM listings")
def _(t):
    rows = t.listings.withColumns({"commercial_type": F.col("property_type"), "area_total_m2": F.col("area"), "generator": F.col("rooms") > 2, "contact_name": F.col("agent_name"),
                                   "phones": F.array_compact(F.array("agent_phone"))})
    return display.display_projection(rows, display.commercial_grid_spec(rows, D.COMMERCIAL_WIDTHS)).select(*[F.col(f"`{n}`") for n in COMMERCIAL])


LABEL = "CASE status WHEN 'active' THEN 'Актуальне' WHEN 'inactive' THEN 'Неактуальне' WHEN 'archived' THEN 'Архів' ELSE 'На перевірці' END"


@query("label_status", L + f"SELECT id, {LABEL} AS status_label FROM listings")
def _(t):
    return t.listings.select("id", display.label_status("status").alias("status_label"))


@query("floor_display", L + """
SELECT id, CASE WHEN floor IS NOT NULL AND floors_total IS NOT NULL THEN
   CASE WHEN lab <> '' AND lab <> CAST(floor AS VARCHAR) THEN lab || '; ' ELSE '' END || CAST(floor AS VARCHAR) || ' з ' || CAST(floors_total AS VARCHAR)
   WHEN lab <> '' THEN lab ELSE COALESCE(CAST(floor AS VARCHAR), '') END AS floor_text
FROM (SELECT *, COALESCE(trim(residential_complex), '') AS lab FROM listings)""")
def _(t):
    return t.listings.select("id", display.floor_display("floor", "floors_total", "residential_complex").alias("floor_text"))


@query("address_display", L + """
SELECT id, CASE WHEN COALESCE(city, '') <> '' AND street IS NOT NULL THEN city || ', ' || street ELSE COALESCE(NULLIF(city, ''), street, '') END AS address FROM listings""")
def _(t):
    return t.listings.select("id", display.address_display("city", "street").alias("address"))


@query("source_filter", L + f"SELECT {KEEP} FROM listings WHERE {LIVE}")
def _(t):
    return Q.source_filter(t.listings).select("id", "source", "operation")


@query("resolve_catalog", cte("listings", heads="SELECT id, property_type, CASE WHEN rooms >= 4 THEN 'Продаж будинку: ' ELSE '' END || COALESCE(title, '') AS title FROM listings") + """
SELECT id, CASE WHEN property_type = 'Квартира' AND title LIKE 'Продаж будинку%' THEN 'Будинок' ELSE property_type END AS property_type FROM heads""")
def _(t):
    lead = F.when(F.col("rooms") >= 4, "Продаж будинку: ").otherwise("")
    heads = t.listings.select("id", "property_type", F.concat(lead, F.coalesce("title", F.lit(""))).alias("title"))
    return Q.resolve_catalog(heads).select("id", "property_type")


@query("url_scope", "SELECT page_id, url FROM pages WHERE contains(lower(url), 'example.com')")
def _(t):
    return Q.url_scope(t.pages, "example.com").select("page_id", "url")


@query("validate_constraints", cte("listings_in") + """
SELECT id, array_to_string(list_filter([CASE WHEN source IS NULL THEN 'null:source' END, CASE WHEN price_uah < 0 THEN 'check:price_not_negative' END,
  CASE WHEN floor > floors_total THEN 'check:floor_not_above_total' END, CASE WHEN title NOT IN ('', 'Fresh title 1') THEN 'enum:title' END,
  CASE WHEN count(*) OVER (PARTITION BY title, district) > 1 THEN 'unique:title+district' END], lambda x: x IS NOT NULL), ',') AS errors FROM listings_in""")
def _(t):
    rules = Q.Constraints(["source"], {}, {"price_not_negative": "price_uah >= 0", "floor_not_above_total": "floor <= floors_total"}, [])
    both = Q.validate(t.listings_in, rules)
    extra = Q.validate(t.listings_in.select("id", "title", "district"), Q.Constraints([], {"title": ["", "Fresh title 1"]}, {}, ["title", "district"]))
    out = both.join(extra.select("id", F.col("constraint_errors").alias("more")), "id")
    return out.select("id", F.array_join(F.concat("constraint_errors", "more"), ",").alias("errors"))
