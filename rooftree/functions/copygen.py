"""Generated titles and descriptions (residential, commercial, feed), quality scores and fact rows."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rooftree import defaults as D
from rooftree.functions.facts import label_for
from rooftree.functions.text import (as_col, clean_text, contains_any, cut, drop, has, let, number_text,
                                     publishable_text, redact_phrases, redact_plain, redact_text, regex, rx, some)

NONE = lambda: F.lit(None).cast("string")


def _field(row, name) -> Column:
    """Row accessor: a column name per field, missing fields are NULL."""
    return F.col(row[name]) if name in row else NONE()


def fields_of(df: DataFrame) -> dict[str, str]:
    return {c: c for c in df.columns}


def _sentence(*parts) -> Column:
    """Concatenate, NULL as soon as one part is missing (drops the sentence)."""
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _strip(c: Column, chars: str) -> Column:
    return F.btrim(c, F.lit(chars))


# ---- residential -----------------------------------------------------------------------------
def is_house(row) -> Column:
    return F.lower(clean_text(_field(row, "property_type"))).isin("будинок", "house")


def object_name(row, genitive: bool = False) -> Column:
    rooms, house = some(number_text(_field(row, "rooms"))), is_house(row)
    if genitive:
        named = F.when(house, _sentence(rooms, "-кімнатного будинку")).otherwise(_sentence(rooms, "-кімнатної квартири"))
        plain = F.when(house, "будинку").otherwise("квартири")
    else:
        named = F.when(house, _sentence(rooms, "-кімнатний будинок")).otherwise(_sentence(rooms, "-кімнатна квартира"))
        plain = F.when(house, "будинок").otherwise("квартира")
    return F.coalesce(named, plain)


def complex_name(row) -> Column:
    value = _strip(drop(clean_text(_field(row, "residential_complex")), r"^жк\s*"), " «»\"")
    value = _strip(F.element_at(F.split(value, regex(D.BANNED), 2), 1), " ,.-–—")
    value = drop(value, r"\s+(?:від|з|у|на)$")
    bad = r"зда[єе]ть|оренд|продаж|квартир|будинок|метро|поверх"
    return let(value, lambda v: F.when(F.length(v).between(1, 100) & ~has(v, bad), v))


def street_name(row) -> Column:
    value = _strip(drop(clean_text(_field(row, "street")), D.BANNED), " ,.-–—()!")
    bad = r"знаход|квартир|будинок|поверх|безкоштов|адреса|метро"
    return let(value, lambda v: F.when(F.length(v).between(4, 100) & ~has(v, bad), v))


def metro_name(row) -> Column:
    value = _strip(drop(clean_text(_field(row, "metro_station")), D.BANNED), " ,.-–—()!")
    bad = r"знаход|квартир|будинок|поверх|вул"
    return let(value, lambda v: F.when(F.length(v).between(1, 80) & ~has(v, bad)
                                       & ~F.lower(v).isin("метро", "станція", "станция"), v))


def _typed_street(row) -> Column:
    return let(street_name(row), lambda s: F.when(has(s, r"^(?:вул|просп|бульв|пров)"), s).otherwise(_sentence("вул. ", s)))


def _places(row) -> Column:
    district = some(clean_text(_field(row, "district")))
    return some(F.concat_ws(", ", _sentence(district, " район"), _sentence("ЖК «", complex_name(row), "»"),
                             _typed_street(row), _sentence("метро ", metro_name(row))))


def action_label(row) -> Column:
    return F.when(_field(row, "operation") == "rent", "Оренда").otherwise("Продаж")


def build_title(row, limit: int | None = None) -> Column:
    district = some(clean_text(_field(row, "district")))
    place = F.coalesce(_sentence("у ЖК «", complex_name(row), "»"), _sentence("у ", district, " районі"),
                       F.lit("у Києві"))
    area = _sentence(some(number_text(_field(row, "area"))), " м²")
    return cut(F.concat_ws(" ", action_label(row), object_name(row, True), area, place), limit)


def build_summary(row, limit: int | None = None) -> Column:
    verb = F.when(_field(row, "operation") == "rent", "Пропонується в оренду").otherwise("Пропонується до продажу")
    area = some(number_text(_field(row, "area")))
    first = F.concat(verb, F.lit(" "), object_name(row), F.coalesce(_sentence(" площею ", area, " м²"), F.lit("")),
                     F.lit("."))
    floor, floors = [some(number_text(_field(row, f))) for f in ("floor", "floors_total")]
    level = F.coalesce(_sentence("Поверх ", floor, " із ", floors, "."), _sentence("Поверх ", floor, "."),
                       F.when(is_house(row), _sentence("Будинок має ", floors, " поверхи.")))
    return cut(F.concat_ws(" ", first, _sentence("Розташування: ", _places(row), "."), level), limit)


def rooms_phrase(c) -> Column:
    n = F.floor(as_col(c).try_cast("double")).try_cast("bigint")
    few = (n % 10).isin(2, 3, 4) & ~(n % 100).isin(12, 13, 14)
    return (F.when(n == 1, "1 кімнату").when(few, _sentence(n.cast("string"), " кімнати"))
            .otherwise(_sentence(n.cast("string"), " кімнат")))


def factual_recap(row) -> Column:
    rooms, area = [some(number_text(_field(row, f))) for f in ("rooms", "area")]
    size = F.coalesce(
        _sentence("Планування передбачає ", F.when(rooms.isNotNull(), rooms_phrase(_field(row, "rooms"))),
                  ", а загальна площа становить ", area, " м²."),
        _sentence("Загальна площа об'єкта становить ", area, " м²."))
    floor, floors = [some(number_text(_field(row, f))) for f in ("floor", "floors_total")]
    return F.concat_ws(" ", size, _sentence("Локація, зазначена в оголошенні: ", _places(row), "."),
                       _sentence("Розташування на ", floor, " поверсі у ", floors, "-поверховому будинку."))


def word_count(c) -> Column:
    return F.size(F.filter(F.split(clean_text(c), " "), lambda w: w != ""))


def fallback_detailed(row, source, limit: int | None = None) -> Column:
    """Summary, then the redacted source text; facts are repeated only below 100 words."""
    details = some(redact_text(source, limit=limit))
    body = F.concat(build_summary(row), F.coalesce(
        _sentence("\n\nДеталі об'єкта:\n", details),
        F.lit("\n\nУ першоджерелі немає розгорнутого опису. Наведено лише підтверджені характеристики об'єкта.")))
    recap = some(factual_recap(row))
    return cut(let(body, lambda b: F.when(word_count(b) < 100, F.concat(b, F.coalesce(_sentence("\n\n", recap), F.lit(""))))
                   .otherwise(b)), limit)


# ---- commercial ------------------------------------------------------------------------------
def commercial_name(row, genitive: bool = False) -> Column:
    form = {k: v[1 if genitive else 0] for k, v in D.COMMERCIAL_NAMES.items()}
    return label_for(F.lower(clean_text(_field(row, "commercial_type"))), form, form["multifunctional"])


def clean_fact(c) -> Column:
    text = drop(drop(F.coalesce(as_col(c).cast("string"), F.lit("")), D.PHONE_SHAPE), D.URL_SHAPE)
    return _strip(clean_text(drop(drop(text, D.FACT_COMMISSION), D.COMMERCIAL_BANNED)), " ,.;:-")


def locative(c: Column) -> Column:
    return F.regexp_replace(c, "ий$", "ому")


def commercial_title(row, limit: int | None = None) -> Column:
    area = _sentence(some(number_text(_field(row, "area_total_m2"))), " м²")
    district = _sentence("у ", locative(some(clean_fact(_field(row, "district")))), " районі")
    return cut(F.concat_ws(" ", action_label(row), commercial_name(row, True), area, district), limit)


def commercial_description(row, limit: int | None = None) -> Column:
    action = F.when(_field(row, "operation") == "rent", "в оренду").otherwise("до продажу")
    area = _sentence(" загальною площею ", some(number_text(_field(row, "area_total_m2"))), " м²")
    first = F.concat(F.lit("Пропонується "), action, F.lit(" "), commercial_name(row), F.coalesce(area, F.lit("")),
                     F.lit("."))
    facts = F.array(*[some(clean_fact(_field(row, f))) for f in ("district", "street", "full_address")])
    places = some(F.array_join(F.array_distinct(F.filter(facts, lambda v: v.isNotNull())), ", "))
    floor = F.coalesce(some(number_text(_field(row, "floor"))), rx(clean_fact(_field(row, "floor_label")), r"\d+", 0))
    total = some(number_text(_field(row, "floors_total")))
    level = F.coalesce(_sentence("Поверх: ", floor, " з ", total, "."), _sentence("Поверх: ", floor, "."))
    traits = some(F.concat_ws("; ", *[_sentence(label, some(clean_text(_field(row, f)))) for label, f in (
        ("Призначення: ", "permitted_use"), ("Стан: ", "condition"), ("Планування: ", "layout_type"))]))
    details = some(redact_plain(_field(row, "description"), limit=limit))
    return cut(F.concat_ws("\n\n", first, _sentence("Розташування, зазначене в оголошенні: ", places, "."), level,
                           _sentence("Характеристики: ", traits, "."), _sentence("Деталі об’єкта: ", details)), limit)


# ---- feed ------------------------------------------------------------------------------------
def feed_title(row, limit: int | None = None) -> Column:
    shown = F.coalesce(some(_field(row, "property_type")), some(_field(row, "title")))
    area = _field(row, "area").cast("string")
    return cut(F.concat_ws(" ", action_label(row), shown, _sentence(F.when(_field(row, "area") != 0, area), " м²"),
                           _sentence("у ", some(_field(row, "district")), " районі")), limit)


def feed_description(row, limit: int | None = None) -> Column:
    details = some(redact_phrases(_field(row, "description"), limit=limit))
    return cut(F.concat(feed_title(row), F.lit("."), F.coalesce(_sentence("\n\nДеталі об’єкта:\n", details),
                                                                F.lit(""))), limit)


def feed_score(description: Column) -> Column:
    return F.when(F.length(description) >= 100, 100).otherwise(60)


# ---- quality scores --------------------------------------------------------------------------
def score_title(title, rooms=None, area=None, district=None) -> Column:
    """struct(score, reason) of a generated title."""
    raw = F.coalesce(as_col(title), F.lit(""))
    low = F.lower(F.trim(raw))
    words = word_count(low)
    shown = lambda c: F.coalesce(raw.contains(as_col(c).cast("string")), F.lit(False)) if c is not None else F.lit(
        False)
    filled = lambda c: F.coalesce(as_col(c).cast("double") != 0, F.lit(False)) if c is not None else F.lit(False)
    near = F.lit(False) if district is None else F.coalesce(
        (as_col(district) != "") & low.contains(F.lower(as_col(district))), F.lit(False))
    points = lambda cond, n: F.when(cond, n).otherwise(0)
    score = (F.lit(50) + points(filled(rooms) & shown(rooms), 10) + points(filled(area) & shown(area), 10)
             + points(near, 15) + points(low.contains("жк"), 10) + points(words >= 4, 5))
    reason = (F.when(F.length(low) < 6, "too_short").when(low.isin(*D.BAD_TITLES), "generic")
              .when(words < 2, "single_word").otherwise("ok"))
    value = lambda why: F.when(why == "single_word", 20).when(why != "ok", 0).otherwise(F.least(score, F.lit(100)))
    return let(reason, lambda why: F.struct(value(why).alias("score"), why.alias("reason")))


def score_description(c) -> Column:
    """struct(score, reason) of a generated description."""
    return let(F.trim(F.coalesce(as_col(c), F.lit(""))), _description_score)


def _description_score(d: Column) -> Column:
    sentences = F.size(F.filter(F.split(d, "[.!?]"), lambda s: F.length(F.trim(drop(s, r"\s+", " "))) > 5))
    points = lambda cond, n: F.when(cond, n).otherwise(0)
    score = (F.lit(40) + points(sentences >= 2, 20) + points(sentences >= 3, 15) + points(F.length(d) > 100, 10)
             + points(F.length(d) > 200, 10))
    reason = (F.when(F.length(d) < 40, "too_short").when(contains_any(F.lower(d), D.SPAM_WORDS), "spam")
              .when(d.rlike(r"[{}\[\]<>]"), "technical_junk").otherwise("ok"))
    value = (F.when(reason == "too_short", 0).when(reason == "spam", 20).when(reason == "technical_junk", 10)
             .otherwise(F.least(score, F.lit(100))))
    return F.struct(value.alias("score"), reason.alias("reason"))


def passes_quality(title, description, rooms=None, area=None, district=None, min_title: int = 30,
                   min_desc: int = 30) -> Column:
    both = F.struct(score_title(title, rooms, area, district).alias("t"), score_description(description).alias("d"))
    return let(both, lambda p: _pass(p["t"], p["d"], min_title, min_desc))


def _pass(t: Column, d: Column, min_title: int, min_desc: int) -> Column:
    return F.struct(((t["score"] >= min_title) & (d["score"] >= min_desc)).alias("passed"),
                    t["score"].alias("title_score"), t["reason"].alias("title_reason"),
                    d["score"].alias("desc_score"), d["reason"].alias("desc_reason"))


# ---- publication -----------------------------------------------------------------------------
def agency_description(row, agency: str, catalog="catalog") -> Column:
    """Opening line with place and area, the publishable source text, a closing line."""
    catalog = as_col(catalog)
    kind = F.when(catalog == "commercial", "об’єкт").when(catalog == "houses", "будинок").otherwise("квартира")
    place = F.coalesce(*[some(F.trim(_field(row, f))) for f in ("full_address", "street", "district", "city")],
                       F.lit("Києві"))
    size = F.when(catalog == "commercial", _field(row, "area_total_m2").cast("string")).otherwise(
        _field(row, "area").cast("string"))
    opening = F.concat(F.lit(f"Представляємо ретельно відібрану пропозицію {agency} — "), kind,
                       F.lit(" у локації "), place, F.lit("."),
                       F.coalesce(_sentence(" Площа — ", some(size), " м²."), F.lit("")))
    source = some(publishable_text(F.coalesce(some(_field(row, "ai_description")), _field(row, "description"))))
    closing = ("Зверніть увагу на деталі нижче: ми залишили тільки підтверджені характеристики, щоб ви могли "
               "об’єктивно оцінити простір і його потенціал.")
    return F.concat_ws("\n\n", opening, source, F.lit(closing))


def clean_title(title, listing_id, agency: str, limit: int | None = None) -> Column:
    """Publishable title without a listing-number tail, plus the listing id."""
    text = drop(F.replace(publishable_text(title), F.lit("\n"), F.lit(" ")), D.TITLE_SUFFIX)
    text = cut(clean_text(text), limit)
    return F.concat(F.coalesce(some(text), F.lit(agency)), F.lit(" · #"), as_col(listing_id).cast("string"))


def money_text(c, currency: str) -> Column:
    grouped = F.replace(F.format_number(F.bround(as_col(c).try_cast("double"), 0), 0), F.lit(","), F.lit(" "))
    return F.concat(F.coalesce(grouped, as_col(c).cast("string")), F.lit(" " + currency))


def fact_rows(df: DataFrame, key: list[str], language: str = "ua", commercial: bool = False) -> DataFrame:
    """Wide row to (position, label, value) rows; blanks dropped, money grouped by thousands."""
    spec = D.FACT_LABELS + (D.FACT_LABELS_COMMERCIAL if commercial else [])
    have = set(df.columns)
    items = []
    for pos, (field, suffix, local, english) in enumerate(spec):
        if field not in have:
            continue
        c = F.col(field).cast("string")
        shown = (money_text(field, suffix) if suffix in ("UAH", "USD", "EUR")
                 else F.trim(F.concat(c, F.lit(" " + suffix))))
        items.append(F.when(c.isNotNull() & (c != ""), F.struct(
            F.lit(pos).alias("pos"), F.lit(local if language == "ua" else english).alias("label"),
            shown.alias("value"))))
    facts = F.filter(F.array(*items), lambda s: s.isNotNull())
    return df.select(*key, F.inline(facts))
