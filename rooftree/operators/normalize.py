"""Whole-record normalization: residential, commercial, feed payload and human-entered rows (one select each)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rooftree import defaults as D
from rooftree.functions import copygen
from rooftree.functions.arrays import first_photo, rank_photos
from rooftree.functions.facts import (area_from_text, commercial_type, detect_agent, extract_areas, flag,
                                      floor_from_text, in_region, label_for, normalize_commission, parse_address,
                                      property_type_from, reconcile_floor, region_label, rooms_from_text)
from rooftree.functions.money import convert_currency, loose_number, parse_price, price_from_listing
from rooftree.functions.text import (clean_text, extract_int, extract_phones, is_blank, let, normalize_phone,
                                     rx, some as filled)


def _get(df: DataFrame, name: str, default="") -> Column:
    return F.col(name) if name in df.columns else F.lit(default).cast("string")


def normalize_listing(df: DataFrame, rates=None) -> DataFrame:
    """Extracted page fields to a typed listing with per-field confidence and validation errors.

    Input: source, operation, external_id, url and any of title, description, price_raw, price_text, rooms, area,
    floor, floors_total, agent_type, address, district, street, residential_complex, photos, photo_url,
    contact_name, contact_phone, commission, metro_station, property_type, fetched_at.
    """
    g = lambda name: _get(df, name)
    some = lambda c: ~is_blank(c)
    df = df.withColumns({"__title": clean_text(g("title")), "__desc": clean_text(g("description"))})
    df = df.withColumn("__text", F.concat_ws(" ", "__title", "__desc"))
    first, second = parse_price(g("price_raw")), parse_price(g("price_text"))
    df = df.withColumn("__price", F.when(first["amount"].isNotNull(), first).otherwise(second))
    currency = F.coalesce(filled(F.col("__price.currency")),
                          F.when(F.col("operation") == "rent", "UAH").otherwise("USD"))
    area_own = F.trim(F.replace(F.replace(g("area").cast("string"), F.lit(","), F.lit(".")), F.lit("м²"), F.lit(""))
                      ).try_cast("double")
    pair = floor_from_text("__text")
    df = df.withColumns({
        "__cur": currency, "__money": convert_currency(F.col("__price.amount"), currency, rates),
        "__rooms_t": let(rooms_from_text("__text"), lambda n: F.when(n != 0, n)), "__area_t": area_from_text("__text"),
        "__pair": pair, "__addr": parse_address(g("address"), g("district"), g("street"), g("residential_complex")),
        "__area_own": area_own,
        "__floor0": F.when(some(g("floor")), extract_int(g("floor").cast("string"))).otherwise(pair["floor"]),
        "__total0": F.when(some(g("floors_total")), extract_int(g("floors_total").cast("string"))).otherwise(
            pair["floors_total"])})
    photos = F.col("photos") if "photos" in df.columns else F.array().cast("array<string>")
    df = df.withColumns({"__fl": reconcile_floor("__floor0", "__total0", F.col("__pair.floor"),
                                                 F.col("__pair.floors_total")),
                         "__photos": rank_photos(photos, g("photo_url"))})
    seen = lambda own, text: F.when(own, "structured").when(text, "regex").otherwise("missing")
    floor_text = F.coalesce(F.col("__pair.floor") != 0, F.lit(False))
    confidence = F.create_map(
        F.lit("price"), F.when(F.col("__price.amount").isNotNull(), "structured").otherwise("missing"),
        F.lit("rooms"), seen(some(g("rooms")), F.col("__rooms_t").isNotNull()),
        F.lit("area"), seen(F.col("__area_own").isNotNull(), F.coalesce(F.col("__area_t") != 0, F.lit(False))),
        F.lit("floor"), F.coalesce(F.col("__fl.state"), seen(some(g("floor")), floor_text)))
    errors = F.filter(F.array(F.when((F.col("__title") == "") & (F.col("__desc") == ""), "no_content"),
                              F.when(F.coalesce(F.col("__money.uah"), F.lit(0)) == 0, "no_price")),
                      lambda e: e.isNotNull())
    out = df.select(
        "source", "operation", "external_id", "url", property_type_from(g("property_type"), "__title").alias("property_type"),
        F.col("__title").alias("title"), F.col("__desc").alias("description"),
        F.col("__money.uah").alias("price_uah"), F.col("__money.usd").alias("price_usd"),
        F.col("__money.eur").alias("price_eur"), g("price_raw").alias("source_price_raw"),
        F.col("__cur").alias("source_currency"),
        F.when(some(g("rooms")), extract_int(g("rooms").cast("string"))).otherwise(F.col("__rooms_t")).alias("rooms"),
        F.coalesce("__area_own", "__area_t").alias("area"), F.col("__fl.floor").alias("floor"),
        F.col("__fl.floors_total").alias("floors_total"),
        F.when(g("agent_type").isin("owner", "agent", "agency"), g("agent_type")).otherwise(detect_agent("__text")
                                                                                            ).alias("agent_type"),
        clean_text(g("contact_name")).alias("agent_name"), normalize_phone(g("contact_phone")).alias("agent_phone"),
        normalize_commission(g("commission"), "__text").alias("commission"),
        F.col("__addr.residential_complex").alias("residential_complex"), F.col("__addr.city").alias("city"),
        F.col("__addr.district").alias("district"), F.col("__addr.street").alias("street"),
        clean_text(g("metro_station")).alias("metro_station"), F.col("__addr.full_address").alias("full_address"),
        first_photo("__photos").alias("photo_url"), F.col("__photos").alias("photos"),
        confidence.alias("extraction_confidence"), errors.alias("validation_errors"),
        *([F.col("fetched_at").alias("parsed_at")] if "fetched_at" in df.columns else []))
    return out.withColumn("is_valid", F.size("validation_errors") == 0)


_TEXT_FIELDS = ("commercial_subtype", "layout_type", "condition", "fitout", "heating_type", "permitted_use",
                "contact_name", "agency_name")


def normalize_commercial(df: DataFrame, rates=None, region=in_region, max_photos: int | None = None) -> DataFrame:
    """Extracted page fields to the wide commercial record: prices and rates, areas, 17 text flags, copy, errors."""
    g = lambda name: _get(df, name)
    c = {n: clean_text(g(n)) for n in ("title", "description", "address", "district", "street", "price_raw")}
    df = df.withColumns({f"__{n}": e for n, e in c.items()})
    df = df.withColumn("__text", F.concat_ws(" ", "__title", "__description", "__address", "__district", "__street"))
    df = df.withColumn("__area", extract_areas("__text", g("area"), g("area_usable")))
    area = F.col("__area.total")
    df = df.withColumn("__p1", price_from_listing("__price_raw", "__title", "__description", "operation", area))
    both = F.concat_ws(" ", "__title", "__description")
    retry = F.col("__p1.currency") == "UNKNOWN"  # only then is the prose searched for a price
    again = price_from_listing(both, "__title", "__description", "operation", area)
    df = df.withColumns({"__p": F.when(retry, again).otherwise(F.col("__p1")), "__low": F.lower("__text"),
                         "__in": region("__text")})
    known = lambda cur: F.col(cur).isin("UAH", "USD", "EUR")
    money = lambda amount, cur: F.when(F.col(amount).isNotNull() & known(cur), convert_currency(amount, cur, rates))
    floor_pat = r"(?:поверх|этаж)\s*([\-\d]+)\s*(?:з|из|/)?\s*(\d+)?"
    own_floor, own_total = loose_number(g("floor")), loose_number(g("floors_total"))
    label_t, total_t = rx("__text", floor_pat), rx("__text", floor_pat, 2)
    floor0 = F.coalesce(own_floor, F.when(label_t.rlike(r"^\d+$"), label_t.try_cast("double")))
    total0 = F.when(own_floor.isNull(), F.coalesce(total_t.try_cast("double"), own_total)).otherwise(own_total)
    bad = F.coalesce(floor0 > total0, F.lit(False))
    label0 = F.when(own_floor.isNull(), F.coalesce(label_t, clean_text(g("floor_label")))).otherwise(
        clean_text(g("floor_label")))
    advertiser = F.lower(clean_text(g("advertiser_type")))
    nonzero = lambda v: F.when(v != 0, v)
    in_place = (g("source_catalog") == "kyiv_region") | F.col("__in")
    place = (F.when(g("source_catalog") == "kyiv_region", "kyiv_or_oblast_catalog")
             .when(F.col("__in"), "kyiv_or_oblast").otherwise("outside_kyiv_region"))
    photos = F.col("photos") if "photos" in df.columns else F.array().cast("array<string>")
    raw_phone = F.coalesce(filled(g("phones").cast("string")), g("contact_phone"), F.lit(""))
    ranked = rank_photos(photos, g("photo_url"))
    df = df.withColumns({
        "__m": money("__p.total", "__p.currency"), "__r": money("__p.rate", "__p.rate_currency"),
        "__floor": F.when(~bad & (floor0 >= 0), floor0).try_cast("bigint"),
        "__floors": F.when(~bad & (total0 > 0), total0).try_cast("bigint"),
        "__label": F.when(bad, "").otherwise(label0), "__photos": ranked if max_photos is None else F.slice(ranked, 1, max_photos)})
    kind = clean_text(g("commercial_type"))
    out = df.select(
        "source", "operation", "external_id", "url",
        F.when(kind != "", kind).otherwise(commercial_type("__text")).alias("commercial_type"),
        *[clean_text(g(f)).alias(f) for f in _TEXT_FIELDS],
        F.col("__title").alias("title"), F.col("__description").alias("description"),
        F.col("__p.total").alias("price_amount"), F.col("__p.currency").alias("price_currency"),
        F.col("__p.period").alias("price_period"), *[F.col(f"__m.{k}").alias(f"price_{k}") for k in ("uah", "usd", "eur")],
        F.col("__p.rate").alias("price_per_m2"), F.col("__p.rate_currency").alias("price_per_m2_currency"),
        *[F.col(f"__r.{k}").alias(f"price_per_m2_{k}") for k in ("uah", "usd", "eur")],
        F.col("__p.rate_period").alias("price_per_m2_period"),
        F.when(retry, both).otherwise(F.col("__price_raw")).alias("source_price_raw"),
        *[flag("__low", terms, True).alias(name) for name, terms in D.COMMERCIAL_FLAGS.items()],
        area.alias("area_total_m2"), F.col("__area.usable").alias("area_usable_m2"),
        F.col("__floor").alias("floor"), F.col("__floors").alias("floors_total"), F.col("__label").alias("floor_label"),
        F.coalesce(nonzero(loose_number(g("ceiling_height_m"))), loose_number(
            rx("__text", r"(?:стел[яі]|h)\s*[:\-]?\s*(\d+(?:[.,]\d+)?)\s*(?:м|m)"))).alias("ceiling_height_m"),
        F.coalesce(nonzero(loose_number(g("electric_power_kw"))), loose_number(
            rx("__text", r"(\d+(?:[.,]\d+)?)\s*(?:квт|kw)"))).alias("electric_power_kw"),
        region_label("__text").alias("city"), F.col("__district").alias("district"), F.col("__street").alias("street"),
        F.when(F.col("__address") != "", F.col("__address")).otherwise(F.col("__street")).alias("full_address"),
        place.alias("address_confidence"),
        F.when(advertiser.isin("owner", "agent", "agency", "developer"), advertiser).otherwise(
            detect_agent("__text", D.AGENT_COMMERCIAL)).alias("advertiser_type"),
        extract_phones(raw_phone, D.PHONE_LOOSE, 0, 99).alias("phones"),
        normalize_commission(g("commission"), "__text").alias("commission_text"),
        F.when(raw_phone != "", "public").otherwise("unknown").alias("contact_visibility"),
        first_photo("__photos").alias("photo_url"), F.col("__photos").alias("photos"),
        F.filter(F.array(F.when(~in_place, "outside_kyiv_region"),
                         F.when((F.col("__title") == "") & (F.col("__description") == ""), "no_content"),
                         F.when(area.isNull(), "missing_area")), lambda e: e.isNotNull()).alias("validation_errors"))
    row = copygen.fields_of(out)
    return out.withColumns({"ai_title": copygen.commercial_title(row), "ai_description": copygen.commercial_description(row)})


PAYLOAD_SCHEMA = (
    "id string, title string, description string, price string, currency string, rooms string, area string, "
    "floor string, total_floors string, floors_total string, lat string, lng string, latitude string, longitude string, "
    "street string, address string, commission string, contact_name string, owner_name string, city string, "
    "district string, property_type string, type string, category string, photos array<struct<src: string, url: string>>")


def nested_name(c) -> Column:
    """A value that may be plain text or an object with a name."""
    c = F.col(c) if isinstance(c, str) else c
    return clean_text(F.when(F.trim(c).startswith("{"), F.get_json_object(c, "$.name")).otherwise(c))


def strict_number(c) -> Column:
    bare = F.replace(F.translate(F.col(c) if isinstance(c, str) else c, "  ", ""), F.lit(","), F.lit("."))
    v = bare.try_cast("decimal(18,4)")
    return F.when(v >= 0, v)


def strict_integer(c) -> Column:
    v = strict_number(c)
    return F.when(v == F.floor(v), v.try_cast("bigint"))


def normalize_payload(items: DataFrame, source: str = "feed", url_base: str = "") -> DataFrame:
    """Typed JSON items (see PAYLOAD_SCHEMA, plus operation) to feed records with errors and completeness."""
    photos = F.filter(F.transform(F.coalesce("photos", F.array().cast("array<struct<src:string,url:string>>")),
                                  lambda p: clean_text(F.coalesce(filled(p["src"]), p["url"]))),
                      lambda u: u != "")
    some = lambda *cols: F.coalesce(*[filled(F.col(c)) for c in cols])
    df = items.withColumns({
        "__id": clean_text("id"), "__price": strict_number("price"), "__cur": F.upper(clean_text("currency")), "__ph": photos,
        "__fl": strict_integer("floor"), "__ft": strict_integer(some("total_floors", "floors_total"))})
    bad = F.coalesce(F.col("__fl") > F.col("__ft"), F.lit(False))
    errors = F.filter(F.array(F.when(F.col("__id") == "", "missing external id"),
                              F.when(F.coalesce(F.col("__price"), F.lit(0)) == 0, "missing or invalid price"),
                              F.when(bad, "invalid floor pair cleared")), lambda e: e.isNotNull())
    urls = F.lower(F.array_join("__ph", " "))
    price = lambda cur: F.when(F.col("__cur") == cur, F.col("__price"))
    out = df.select(
        F.lit(source).alias("source"), "operation", F.col("__id").alias("external_id"),
        F.when(urls.contains("olx"), source + "_olx").when(urls.contains("rieltor"), source + "_rieltor").otherwise(
            source).alias("origin_source"),
        F.concat(F.lit(url_base), "__id").alias("url"), clean_text("title").alias("title"),
        clean_text("description").alias("description"),
        nested_name(some("property_type", "type", "category")).alias("property_type"),
        clean_text("price").alias("source_price_raw"), F.col("__cur").alias("source_currency"),
        price("UAH").alias("price_uah"), price("USD").alias("price_usd"), price("EUR").alias("price_eur"),
        strict_integer("rooms").alias("rooms"), strict_number("area").alias("area"),
        F.when(~bad, F.col("__fl")).alias("floor"), F.when(~bad, F.col("__ft")).alias("floors_total"),
        nested_name("district").alias("district"), nested_name("city").alias("city"), clean_text("street").alias("street"),
        clean_text("address").alias("full_address"), strict_number(some("lat", "latitude")).alias("latitude"),
        strict_number(some("lng", "longitude")).alias("longitude"), F.col("__ph").alias("photos"),
        first_photo("__ph").alias("photo_url"), clean_text(some("contact_name", "owner_name")).alias("contact_name"),
        F.lit("").alias("contact_phone"), clean_text("commission").alias("commission"), errors.alias("validation_errors"))
    return out.withColumns({"is_valid": F.size("validation_errors") == 0, "data_completeness": completeness(out)})


def completeness(df: DataFrame, fields=tuple(D.COMPLETENESS_FIELDS)) -> Column:
    """Whole percent of filled fields; zero counts as missing."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    def full(f):
        text = kinds.get(f, "void") == "string"
        return F.col(f).isNotNull() & ((F.col(f) != "") if text else (F.col(f) != 0))
    have = [F.when(F.coalesce(full(f), F.lit(False)), 1).otherwise(0) for f in fields if f in kinds]
    total = sum(have[1:], have[0])
    return F.bround(total * F.lit(100.0) / F.lit(float(len(fields))), 0).cast("int")


def manual_rows(df: DataFrame, catalog: str) -> DataFrame:
    """Validated human-entered rows (id, operation, kind, title, url, price, currency, district, street, area,
    description, comment) in the catalog's record shape; the id is derived from the content when missing."""
    cols = ("id", "operation", "kind", "title", "url", "price", "currency", "district", "street", "area", "description",
            "comment")
    df = df.select(*[F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c) for c in cols])
    op = label_for("operation", {"Оренда": "rent", "Продаж": "buy", "rent": "rent", "buy": "buy"})
    df = df.where((F.col("title") != "") | (F.col("url") != "")).withColumn("operation", op).where(op.isNotNull())
    own = F.concat(F.lit("manual:"), F.when(F.col("id") != "", F.col("id")).otherwise(
        F.substring(F.sha2(F.concat_ws("\u0001", *cols), 256), 1, 32)))
    cur = F.upper("currency")
    price = F.replace(F.replace(F.col("price"), F.lit(" "), F.lit("")), F.lit(","), F.lit(".")).try_cast("double")
    kind = (label_for(F.lower("kind"), D.COMMERCIAL_ALIASES, "multifunctional") if catalog == "commercial"
            else F.lit(D.HOUSE if catalog == "houses" else D.FLAT))
    out = df.select(
        own.alias("id"), own.alias("external_id"), F.lit("manual").alias("source"), "operation", kind.alias("property_type"),
        "title", "description", "url", "district", "street", F.replace(F.col("area"), F.lit(","), F.lit(".")).try_cast("double").alias("area"),
        F.when(cur == "UAH", price).alias("price_uah"), F.when(cur.isin("USD", "$"), price).alias("price_usd"),
        F.when(cur.isin("EUR", "€"), price).alias("price_eur"), F.col("comment").alias("comments"),
        F.lit("active").alias("status"))
    row = copygen.fields_of(out)
    if catalog == "commercial":
        row = {**row, "commercial_type": "property_type", "area_total_m2": "area"}
        return out.withColumns({"ai_title": copygen.commercial_title(row), "ai_description": copygen.commercial_description(row)})
    text = F.when(F.col("description") != "", copygen.fallback_detailed(row, "description")).otherwise(copygen.build_summary(row))
    return out.withColumns({"ai_title": copygen.build_title(row), "ai_description": text})
