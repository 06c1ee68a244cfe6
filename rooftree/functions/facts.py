"""Facts from text: districts, addresses, rooms, area, floors, agent type, commission, commercial areas."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rooftree import defaults as D
from rooftree.functions.money import loose_number
from rooftree.functions.text import as_col, clean_text, contains_any, drop, has, let, regex, rx, words_array


def literal_map(mapping: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])


def label_for(c, mapping: dict, default=None) -> Column:
    out = F.try_element_at(literal_map(mapping), as_col(c))
    return F.coalesce(out, F.lit(default)) if default is not None else out


def first_match(cases) -> Column:
    """cases: (condition, value) pairs; the first true condition wins, else NULL."""
    return F.coalesce(*[F.when(cond, value) for cond, value in cases])


def detect_by_tokens(c, dictionary, default=None) -> Column:
    """First dictionary entry with a token inside the lower-cased text; dict or ordered pairs."""
    pairs = [(token, name) for name, tokens in (dictionary.items() if isinstance(dictionary, dict) else dictionary)
             for token in tokens]
    table = F.arrays_zip(words_array([p[0] for p in pairs]).alias("token"), words_array([p[1] for p in pairs]).alias("name"))
    out = let(F.lower(as_col(c)), lambda low: F.get(F.filter(table, lambda e: low.contains(e["token"])), F.lit(0))["name"])
    return F.coalesce(out, F.lit(default)) if default is not None else out


def normalize_district(c, names=tuple(D.DISTRICTS), aliases=None) -> Column:
    """Exact name, alias, containment either way, alias inside, else the raw value."""
    aliases = aliases or D.DISTRICT_ALIASES

    def resolve(raw):
        low = F.lower(raw)
        exact = F.when(raw.isin(*names), raw)
        either = first_match([(low.contains(n.lower()) | F.lit(n.lower()).contains(low), F.lit(n)) for n in names])
        inside = first_match([(low.contains(a.lower()), F.lit(v)) for a, v in aliases.items()])
        return F.when(raw == "", "").otherwise(F.coalesce(exact, label_for(raw, aliases), either, inside, raw))

    return let(F.trim(F.coalesce(as_col(c), F.lit(""))), resolve)


def parse_address(address, district, street, complex_name, city: str = D.CITY, names=tuple(D.DISTRICTS),
                  aliases=None) -> Column:
    """struct(city, district, street, residential_complex, full_address) with fallbacks from the address."""
    aliases = aliases or D.DISTRICT_ALIASES
    tidy = lambda c: F.trim(F.coalesce(as_col(c), F.lit("")))
    full = tidy(address)
    low = F.lower(full)
    own = normalize_district(district, names, aliases)
    found = F.coalesce(first_match([(low.contains(n.lower()), F.lit(n)) for n in names]),
                       first_match([(low.contains(a.lower()), F.lit(v)) for a, v in aliases.items()]), F.lit(""))
    road = F.trim(F.coalesce(rx(full, r"(?:вул\.|вулиця|ул\.)\s*([^,]+)"), F.lit("")))
    block = F.trim(F.coalesce(rx(full, r"(?:ЖК|жк)\s*[«\"']?([^»\"',]+)", 1, "(?U)"), F.lit("")))
    either = lambda a, b: let(a, lambda v: F.when(v != "", v).otherwise(b))
    return F.struct(F.lit(city).alias("city"), either(own, found).alias("district"),
                    either(tidy(street), road).alias("street"),
                    either(tidy(complex_name), block).alias("residential_complex"), full.alias("full_address"))


def in_city(c, tokens=tuple(D.CITY_TOKENS), veto=tuple(D.CITY_VETO)) -> Column:
    return let(_place_text(c), lambda text: ~contains_any(text, veto) & contains_any(text, tokens))


def in_region(c, city_tokens=tuple(D.CITY_TOKENS), region_tokens=tuple(D.REGION_TOKENS),
              veto=tuple(D.CITY_VETO)) -> Column:
    return let(_place_text(c), lambda text: (~contains_any(text, veto) & contains_any(text, city_tokens))
               | contains_any(text, region_tokens))


def region_label(c, city: str = D.CITY, region: str = D.REGION, tokens=tuple(D.CITY_TOKENS),
                 veto=tuple(D.CITY_VETO)) -> Column:
    return F.when(in_city(c, tokens, veto), city).otherwise(region)


def _place_text(c) -> Column:
    return F.replace(F.lower(clean_text(c)), F.lit("’"), F.lit("'"))


STREET_TYPES = r"(?:вул(?:иця)?\.?|ул\.?|просп(?:ект)?\.?|бульв(?:ар)?\.?|пров(?:улок)?\.?)"
STREET_REJECT = r"знаход|безкоштов|квартир|будинок|поверх|адреса"


def extract_street(c, min_len: int = 4, max_len: int = 160, reject: str = STREET_REJECT) -> Column:
    """Street after a type word, cut at a separator; NULL when the piece does not look like a street."""
    value = F.regexp_replace(clean_text(rx(c, STREET_TYPES + r"\s*([^,\n|/]{3,80})")), r"\.+$", "")
    return let(value, lambda v: F.when(F.length(v).between(min_len, max_len) & ~has(v, reject), v))


def rooms_from_text(c) -> Column:
    return rx(c, r"(\d)\s*-?\s*(?:кімн|комн|к\.?\s)").try_cast("bigint")


def area_from_text(c, unit: str = D.AREA_UNIT) -> Column:
    return F.replace(rx(c, rf"(\d+(?:[.,]\d+)?)\s*{unit}"), F.lit(","), F.lit(".")).try_cast("double")


def floor_from_text(c) -> Column:
    """struct(floor, floors_total) from a pair with a floor word, else a single floor."""
    pair = rf"(\d{{1,2}})\s*{D.FLOOR_WORD}?\s*/\s*(\d{{1,2}})\s*{D.FLOOR_WORD}"
    num = lambda p, g: rx(c, p, g).try_cast("bigint")
    single = r"(\d{1,2})\s*(?:поверх|этаж|пов\.)"
    return F.struct(F.coalesce(num(pair, 1), num(single, 1)).alias("floor"), num(pair, 2).alias("floors_total"))


def detect_agent(c, order=tuple(D.AGENT_OWNER_FIRST), default: str | None = "unknown") -> Column:
    return detect_by_tokens(c, order, default)


def property_type_from(declared, title, flat: str = D.FLAT, house: str = D.HOUSE,
                       signal: str = D.TYPE_SIGNAL) -> Column:
    """Declared type, unless an explicit title signal contradicts the default type."""
    value = let(clean_text(declared), lambda v: F.when(v == "", flat).otherwise(v))
    return let(value, lambda v: F.when((v == flat) & has(title, signal), house).otherwise(v))


# ---- commission ------------------------------------------------------------------------------
def _plain_number(c: Column) -> Column:
    return F.replace(drop(c, r"\s", ""), F.lit(","), F.lit(".")).try_cast("double")


def _short_number(c: Column) -> Column:
    """Whole numbers as such, others with six significant digits and a decimal comma."""
    def shown(v):
        six = (F.when(v >= 10_000, F.round(v, 1)).when(v >= 1_000, F.round(v, 2)).when(v >= 100, F.round(v, 3))
               .when(v >= 10, F.round(v, 4)).otherwise(F.round(v, 5)))
        return (F.when(v == F.floor(v), v.try_cast("bigint").cast("string"))
                .otherwise(F.replace(six.cast("string"), F.lit("."), F.lit(","))))

    return let(_plain_number(c), shown)


def _money_sign(c: Column) -> Column:
    return let(F.lower(c), lambda low: F.when(low.isin("грн", "₴", "uah"), "грн")
               .when(low.isin("$", "usd") | low.startswith("дол"), "$").otherwise("€"))


def commission_from(c) -> Column:
    """Commission stated in one text: none, percent (both word orders), money, bare number, pending; else NULL."""
    return let(clean_text(c), _commission_in)


def _commission_in(text: Column) -> Column:
    term, pct = D.COMMISSION_TERM, D.PERCENT_UNIT
    percent = [rx(text, rf"{term}.{{0,42}}?(\d{{1,3}}(?:[.,]\d+)?)\s*{pct}"),
               rx(text, rf"(\d{{1,3}}(?:[.,]\d+)?)\s*{pct}.{{0,42}}?{term}")]
    bare = rx(text, rf"^\s*{term}\s*[:=\-]?\s*(\d{{1,3}}(?:[.,]\d+)?)\s*$")
    money = rf"{term}.{{0,42}}?(\d[\d\s]{{0,12}}(?:[.,]\d{{1,2}})?)\s*{D.MONEY_UNIT}"
    amount, sign = rx(text, money), rx(text, money, 2)

    def as_percent(found):
        return let(found, lambda f: F.when(_plain_number(f) == 0, D.COMMISSION_NONE)
                   .when((_plain_number(f) > 0) & (_plain_number(f) <= 100),
                         F.concat(F.lit("Комісія "), _short_number(f), F.lit("%"))))

    as_money = let(amount, lambda a: F.when(_plain_number(a) > 0, F.concat(
        F.lit("Комісія "), _short_number(a), F.lit(" "), _money_sign(sign))))
    stated = F.coalesce(F.when(has(text, D.COMMISSION_FREE), D.COMMISSION_NONE), as_percent(percent[0]),
                        as_percent(percent[1]), as_money, as_percent(bare), F.lit(D.COMMISSION_PENDING))
    return F.when(has(text, term) | has(text, D.COMMISSION_FREE), stated)  # cheap test first: most texts say nothing


def normalize_commission(value, text) -> Column:
    """Structured value first, then prose; never guessed."""
    return F.coalesce(commission_from(value), commission_from(text), F.lit(D.COMMISSION_UNKNOWN))


# ---- plausibility ----------------------------------------------------------------------------
def reconcile_floor(floor, total, text_floor=None, text_total=None) -> Column:
    """struct(floor, floors_total, state): a contradictory pair is replaced by a sane text pair or cleared."""
    f, t = as_col(floor), as_col(total)
    null = F.lit(None).cast("bigint")
    tf = null if text_floor is None else as_col(text_floor)
    tt = null if text_total is None else as_col(text_total)
    bad = F.coalesce(f > t, F.lit(False))
    sane = F.coalesce(tf <= tt, F.lit(False))
    pick = lambda own, alt: F.when(~bad, own).when(sane, alt)
    return F.struct(pick(f, tf).alias("floor"), pick(t, tt).alias("floors_total"),
                    F.when(bad & sane, "regex_override").when(bad, "invalid").alias("state"))


def range_clean(df: DataFrame, rooms_max: int = 30, floors_max: int = 120, area=(10, 1000)) -> DataFrame:
    """NULL candidate values outside their range; a floor above the total removes both."""
    df = df.withColumns({
        "rooms": F.when(F.col("rooms").between(1, rooms_max), F.col("rooms")),
        "floor": F.when(F.col("floor").between(1, floors_max), F.col("floor")),
        "floors_total": F.when(F.col("floors_total").between(1, floors_max), F.col("floors_total")),
        "area": F.when(F.col("area").between(*area), F.col("area"))})
    bad = F.coalesce(F.col("floor") > F.col("floors_total"), F.lit(False))
    return df.withColumns({c: F.when(~bad, F.col(c)) for c in ("floor", "floors_total")})


# ---- commercial ------------------------------------------------------------------------------
def _first_area(text: Column, patterns) -> Column:
    tries = []
    for p in patterns:
        found = F.transform(F.regexp_extract_all(text, F.lit(regex(p)), 1), loose_number)
        tries.append(F.try_element_at(F.filter(found, lambda v: v.between(5, 100_000)), F.lit(1)))
    return F.coalesce(*tries)


def extract_areas(text, area=None, area_usable=None) -> Column:
    """struct(total, usable): structured value of at least 5, then labelled, then generic mentions."""
    t = F.coalesce(as_col(text), F.lit(""))
    number, unit = r"(\d[\d\s.,]*)", D.SQUARE_UNIT
    labelled = lambda words: rf"(?:{'|'.join(words)})\s*[:=\-]?\s*{number}\s*{unit}"
    own = lambda c: (let(loose_number(c), lambda v: F.when(v >= 5, v)) if c is not None
                     else F.lit(None).cast("double"))
    total = F.coalesce(own(area), _first_area(t, [labelled(D.TOTAL_AREA_LABELS)]),
                       _first_area(t, [labelled(["площа", "area", "s"]), rf"{number}\s*{unit}"]))
    usable = F.coalesce(own(area_usable), _first_area(t, [labelled(D.USABLE_AREA_LABELS)]))
    return F.struct(total.alias("total"), usable.alias("usable"))


def flag(c, terms, lowered: bool = False) -> Column:
    """True when a term occurs, otherwise NULL (text never proves absence)."""
    return F.when(contains_any(as_col(c) if lowered else F.lower(as_col(c)), terms), F.lit(True))


def commercial_type(c) -> Column:
    return detect_by_tokens(c, D.COMMERCIAL_TYPES, "multifunctional")


# ---- enrichment of rows with gaps ------------------------------------------------------------
def enrich_from_text(df: DataFrame, title: str = "title", description: str = "description") -> DataFrame:
    """Fill-only update of rooms, area, floors, district, street, complex, commission, agent type from prose."""
    text = F.concat_ws(" ", F.coalesce(F.col(title), F.lit("")), F.coalesce(F.col(description), F.lit("")))
    df = df.withColumns({"__text": text, "__low": F.lower(text)})
    text, low = F.col("__text"), F.col("__low")
    num = lambda p, g=1: rx(text, p, g).try_cast("bigint")
    words = first_match([(has(text, p), F.lit(v).cast("bigint")) for p, v in D.ROOM_WORDS])
    rooms = F.coalesce(num(r"(\d)\s*[-]?\s*(?:кімнат|комнат|к\.?\s*кв|room)"), words)
    pair = r"(\d{1,2})\s*/\s*(\d{1,2})"
    within = lambda c, lo, hi: let(c, lambda v: F.when(v.between(lo, hi), v))
    floor = F.when(has(text, pair), within(num(pair), 1, 79)).otherwise(num(r"(?:поверх|этаж)\s*[:=]?\s*(\d{1,2})"))
    area = let(area_from_text(text), lambda v: F.when((v > 5) & (v < 1000), v))
    street = F.regexp_replace(F.trim(rx(text, r"(?:вул(?:иця)?\.?|ул\.?|просп\.?|бульв\.?)\s*([^,\n\d]{3,50})")),
                              r"\.+$", "")
    block = F.regexp_replace(F.trim(rx(text, r"(?:ЖК|жк)\s*[«\"'\s]*([^»\"'\n,.;]{2,40})", 1, "(?U)")), "[\"'»]+$", "")
    percent = F.concat(F.lit("Комісія "), rx(low, r"комісі[яі]?\s*[:=]?\s*(\d+)\s*%"), F.lit("%"))
    commission = (F.when(low.contains("без комісі") | low.contains("без комис"), D.COMMISSION_NONE)
                  .when(low.contains("комісі"), F.coalesce(percent, F.lit("Комісія є"))))
    fill = lambda c, new: F.coalesce(F.col(c), new)
    fill_text = lambda c, new: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.col(c)).otherwise(
        F.coalesce(new, F.col(c)))
    return df.withColumns({
        "rooms": fill("rooms", rooms), "area": fill("area", area), "floor": fill("floor", floor),
        "floors_total": fill("floors_total", F.when(F.col("floor").isNull(), within(num(pair, 2), 1, 79))),
        "district": fill_text("district", detect_by_tokens(text, D.DISTRICT_TOKENS)),
        "street": fill_text("street", street), "residential_complex": fill_text("residential_complex", block),
        "commission": fill_text("commission", commission),
        "agent_type": fill_text("agent_type", detect_agent(text, D.AGENT_AGENCY_FIRST, None))}).drop("__text", "__low")
