"""Golden cases and brute-force checks of the text, money and fact functions."""
import re

import pytest

from rooftree import defaults as D
from rooftree.functions import arrays as A
from rooftree.functions import copygen as C
from rooftree.functions import display
from rooftree.functions import facts as X
from rooftree.functions import money as M
from rooftree.functions import text as T


def one(spark, expr, **values):
    schema = ", ".join(f"{k} {'array<string>' if isinstance(v, list) else 'double' if isinstance(v, float) else 'bigint' if isinstance(v, int) else 'string'}"
                       for k, v in values.items()) or "x int"
    return spark.createDataFrame([tuple(values.values()) or (1,)], schema).select(expr.alias("r")).first()["r"]


COMMISSION = [("", "Оренда без комісії для орендаря", "Без комісії"), ("Комісія 50", "", "Комісія 50%"),
              ("", "Послуги агенції: 2,5% від вартості", "Комісія 2,5%"), ("", "Комиссионные 1 500 грн", "Комісія 1500 грн"),
              ("", "Ціна 1 000 $, комісія обговорюється", "Комісія: умови уточнюються"),
              ("", "Жодної згадки про оплату послуг", "Не вказано"), ("Комісія 0%", "", "Без комісії"),
              ("", "50% комісія агентства", "Комісія 50%"), ("", "ріелторські послуги 300 дол.", "Комісія 300 $"),
              ("комісія", "комісія 30 %", "Комісія: умови уточнюються"), (None, None, "Не вказано")]


def test_commission(spark):
    df = spark.createDataFrame(COMMISSION, "v string, t string, want string")
    for r in df.withColumn("got", X.normalize_commission("v", "t")).collect():
        assert r.got == r.want, r


@pytest.mark.parametrize("raw, amount, currency", [
    ("45 000 грн/міс", 45000.0, "UAH"), ("2 400 $/міс", 2400.0, "USD"), ("45.000", 45.0, ""), ("1.500,00", 150000.0, ""),
    ("1.500.000 грн", 1500000.0, "UAH"), ("1 500 000,50 €", 1500000.5, "EUR"), ("95000 usd", 95000.0, "USD"), ("договірна", None, ""),
    ("0 $", None, "USD"), (None, None, ""), ("", None, "")])
def test_price(spark, raw, amount, currency):
    got = one(spark, M.parse_price("p"), p=raw)
    assert (got.amount, got.currency) == (amount, currency)


@pytest.mark.parametrize("raw, operation, area, total, currency, period, rate", [
    ("15 $/м²", "rent", 100.0, 1500.0, "USD", "unknown", 15.0), ("30000 грн/міс", "rent", 60.0, 30000.0, "UAH", "month", 500.0),
    ("$ 1 200 за м2, всього 240000$", "buy", 200.0, 240000.0, "USD", "total", 1200.0),
    ("ціна: 5000", "rent", 50.0, 5000.0, "UNKNOWN", "unknown", None), ("", "rent", 50.0, None, "UNKNOWN", "unknown", None)])
def test_commercial_price(spark, raw, operation, area, total, currency, period, rate):
    got = one(spark, M.parse_commercial_price("raw", "op", "area"), raw=raw, op=operation, area=area)
    assert (got.total, got.currency, got.period, got.rate) == (total, currency, period, rate)


def test_disguised_rate(spark):
    got = one(spark, M.price_from_listing("raw", "t", "d", "op", "area"), raw="20 $", t="Склад", d="", op="rent", area=120.0)
    assert (got.total, got.rate) == (2400.0, 20.0)
    got = one(spark, M.price_from_listing("raw", "t", "d", "op", "area"), raw="300 $", t="Офіс", d="оренда 12 $/м²", op="rent", area=40.0)
    assert (got.total, got.rate, got.currency) == (480.0, 12.0, "USD")
    got = one(spark, M.price_from_listing("raw", "t", "d", "op", "area"), raw="90 000 $", t="Офіс", d="", op="buy", area=100.0)
    assert (got.total, got.rate) == (90000.0, 900.0)


@pytest.mark.parametrize("raw, plain, blank, digits", [
    ("067 123 45 67", "+380671234567", "+380671234567", "+380671234567"), ("+38 (067) 123-45-67", "+380671234567", "+380671234567", "+380671234567"),
    (" 12345 ", "12345", "", "12345"), (None, "", "", "")])
def test_phone(spark, raw, plain, blank, digits):
    assert one(spark, T.normalize_phone("p"), p=raw) == plain
    assert one(spark, T.normalize_phone("p", "blank"), p=raw) == blank
    assert one(spark, T.normalize_phone("p", "digits"), p=raw) == digits


def test_phones_in_text(spark):
    text = "тел. 067 123 45 67 або +38(050)111-22-33, ще раз 0671234567; код 12345"
    assert one(spark, T.extract_phones("t"), t=text) == ["+380671234567", "+380501112233"]
    assert one(spark, T.phone_values("t"), t="067 1234567; 380501112233|bad, 0671234567") == ["+380671234567", "+380501112233"]
    html = '<a class="x" href="tel:0671234567">call</a> <a href="tel:123">x</a>'
    assert one(spark, T.tel_links("h"), h=html) == ["+380671234567"]


def test_whitespace_and_numbers(spark):
    assert one(spark, T.clean_text("t"), t="  a  b\n\tc ") == "a b c"
    assert one(spark, T.extract_number("t"), t="ціна 1 250,5 грн") == 1250.5
    assert one(spark, T.extract_int("t"), t="12,9") == 12
    assert one(spark, T.is_blank("t"), t="   ") is True


@pytest.mark.parametrize("raw, want", [("Печерський", "Печерський"), ("Голосеевский", "Голосіївський"), ("печерський р-н", "Печерський"),
                                       ("Подол, Київ", "Подільський"), ("Ірпінь", "Ірпінь"), (" ", ""), (None, "")])
def test_district(spark, raw, want):
    assert one(spark, X.normalize_district("d"), d=raw) == want


def test_address(spark):
    got = one(spark, X.parse_address("a", "d", "s", "r"), a="Київ, Оболонський район, вул. Героїв 5, ЖК «Парковий»", d="", s=None, r="")
    assert (got.district, got.street, got.residential_complex) == ("Оболонський", "Героїв 5", "Парковий")


def test_region(spark):
    for text, city, region in (("Київ, Оболонь", True, True), ("Київська область, Бровари", False, True), ("Львів", False, False)):
        assert one(spark, X.in_city("t"), t=text) is city
        assert one(spark, X.in_region("t"), t=text) is region
    assert one(spark, X.region_label("t"), t="Бровари") == "Київська область"


def test_facts(spark):
    text = "Здам 2-кімн квартиру, 54,5 м², 3 поверх/9 поверх"
    assert one(spark, X.rooms_from_text("t"), t=text) == 2
    assert one(spark, X.area_from_text("t"), t=text) == 54.5
    assert tuple(one(spark, X.floor_from_text("t"), t=text)) == (3, 9)
    assert tuple(one(spark, X.floor_from_text("t"), t="на 7 поверх")) == (7, None)
    assert one(spark, X.extract_street("t"), t="Київ, вул. Лесі Українки, 5") == "Лесі Українки"
    assert one(spark, X.extract_street("t"), t="вул. квартира без адреси") is None
    assert one(spark, X.property_type_from("p", "t"), p="", t="Продаж будинку біля лісу") == D.HOUSE
    assert one(spark, X.property_type_from("p", "t"), p="Квартира", t="Квартира біля будинку") == D.FLAT
    assert one(spark, X.detect_agent("t"), t="агентство нерухомості") == "agent"
    assert one(spark, X.detect_agent("t", D.AGENT_AGENCY_FIRST, None), t="агентство нерухомості") == "agency"
    assert one(spark, X.flag("t", ["генератор"]), t="Є ГЕНЕРАТОР") is True
    assert one(spark, X.flag("t", ["генератор"]), t="немає") is None
    areas = one(spark, X.extract_areas("t"), t="Загальна площа: 1 200 м², корисна площа 900 м2")
    assert tuple(areas) == (1200.0, 900.0)


@pytest.mark.parametrize("floor, total, tf, tt, want", [(3, 9, None, None, (3, 9, None)), (12, 5, 3, 9, (3, 9, "regex_override")),
                                                        (12, 5, None, None, (None, None, "invalid")), (12, 5, 9, 3, (None, None, "invalid"))])
def test_reconcile_floor(spark, floor, total, tf, tt, want):
    df = spark.createDataFrame([(floor, total, tf, tt)], "f bigint, t bigint, a bigint, b bigint")
    assert tuple(df.select(X.reconcile_floor("f", "t", "a", "b").alias("r")).first()["r"]) == want


ROW = dict(operation="rent", property_type="Квартира", rooms=2, area=55.5, district="Печерський", residential_complex="ЖК «Сонячний»",
           street="вул. Лесі Українки", metro_station="Кловська", floor=3, floors_total=9, description="Гарна квартира у центрі міста. Телефонуйте 0671234567!")


def test_residential_copy(spark):
    row = C.fields_of(type("Df", (), {"columns": list(ROW)}))
    assert one(spark, C.build_title(row), **ROW) == "Оренда 2-кімнатної квартири 55,5 м² у ЖК «Сонячний»"
    assert one(spark, C.build_summary(row), **ROW) == (
        "Пропонується в оренду 2-кімнатна квартира площею 55,5 м². Розташування: Печерський район, ЖК «Сонячний», "
        "вул. Лесі Українки, метро Кловська. Поверх 3 із 9.")
    full = one(spark, C.fallback_detailed(row, "description"), **ROW)
    assert "Деталі об'єкта:\nГарна квартира у центрі міста." in full and "0671234567" not in full and full.endswith("9-поверховому будинку.")
    empty = one(spark, C.fallback_detailed(row, "description"), **{**ROW, "description": ""})
    assert "немає розгорнутого опису" in empty
    house = {**ROW, "property_type": "house", "operation": "buy", "residential_complex": "", "district": "", "rooms": 21}
    assert one(spark, C.build_title(row), **house) == "Продаж 21-кімнатного будинку 55,5 м² у Києві"
    assert one(spark, C.rooms_phrase("n"), n=12) == "12 кімнат" and one(spark, C.rooms_phrase("n"), n=22) == "22 кімнати"


def test_commercial_copy(spark):
    row = dict(operation="rent", commercial_type="office", area_total_m2=120.0, district="Печерський", street="вул. Садова", full_address="вул. Садова",
               floor=None, floor_label="2 поверх", floors_total=9, condition="з ремонтом", description="Світлий офіс біля метро. Телефон 0671234567.")
    f = C.fields_of(type("Df", (), {"columns": list(row)}))
    assert one(spark, C.commercial_title(f), **row) == "Оренда офісного приміщення 120 м² у Печерському районі"
    text = one(spark, C.commercial_description(f), **row)
    assert text.split("\n\n") == ["Пропонується в оренду офісне приміщення загальною площею 120 м².",
                                  "Розташування, зазначене в оголошенні: Печерський, вул. Садова.", "Поверх: 2 з 9.",
                                  "Характеристики: Стан: з ремонтом.", "Деталі об’єкта: Світлий офіс біля метро."]


def test_publication_text(spark):
    assert one(spark, C.clean_title("t", "i", "Agency"), t="Квартира - оголошення №123 на сайті", i=7) == "Квартира · #7"
    assert one(spark, C.clean_title("t", "i", "Agency"), t="", i=7) == "Agency · #7"
    assert one(spark, C.money_text("v", "UAH"), v=1234567.0) == "1 234 567 UAH"
    assert one(spark, T.publishable_text("t"), t="<b>Гарний</b> вид. Телефонуйте власнику!\n\nПарк поруч.") == "Гарний вид.\n\nПарк поруч."


def test_scores(spark):
    assert tuple(one(spark, C.score_title("t"), t="Квартира")) == (0, "generic")
    assert tuple(one(spark, C.score_title("t", "r", "a", "d"), t="2-кімнатна квартира, Печерський ЖК", r=2, a=50.0, d="Печерський")) == (90, "ok")
    assert tuple(one(spark, C.score_description("t"), t="x" * 39)) == (0, "too_short")
    assert one(spark, C.score_description("t"), t="Терміново продам квартиру у центрі міста недорого").reason == "spam"


def test_display(spark):
    assert one(spark, display.safe_text("v"), v="=SUM(A1)") == "'=SUM(A1)" and one(spark, display.safe_text("v"), v="None") == ""
    assert one(spark, display.safe_int("v"), v=12.9) == "12"
    assert one(spark, display.floor_display("f", "t", "l"), f=3, t=9, l="мансарда") == "мансарда; 3 з 9"
    assert one(spark, display.label_status("s"), s="Active") == "Актуальне" and one(spark, display.label_status("s"), s="?") == "На перевірці"


@pytest.mark.parametrize("a, b, same", [("1,50", "1.5", True), ("'12", "12", True), ("abc", "abd", False), (None, "", True), ("12345678901234567", "12345678901234568", False)])
def test_cell_equal(spark, a, b, same):
    assert one(spark, T.cell_equal("a", "b"), a=a, b=b) is same


def test_identifiers(spark):
    assert one(spark, T.external_id("u"), u="https://x/d/uk/obyavlenie/kv-IDabC1.html?x=1") == "olx_abC1"
    assert one(spark, T.external_id("u"), u="https://x/flats-rent/view/123/") == "rieltor_123"
    assert one(spark, T.external_id("u"), u="https://other/").startswith("web_")
    assert one(spark, T.display_id("s", "u", "e"), s="OLX", u="https://x/kv-IDabC1.html", e="e1") == "olx_IDabC1"
    assert one(spark, T.normalize_url("u"), u=" https://x/a/?q=1#z ") == "https://x/a"


def test_photos(spark):
    photos = ["https://a/1.jpg 1x, https://a/2.jpg 2x", "https://a/logo.png", "https://cdn/gallery/3.jpg", "https://a/1.jpg", "ftp://no"]
    assert one(spark, A.rank_photos("p", "f"), p=photos, f="https://a/9.jpg;") == ["https://cdn/gallery/3.jpg", "https://a/9.jpg", "https://a/1.jpg"]
    assert one(spark, A.https_photos("p", "f"), p=["http://x", " https://y ", "https://y"], f="https://z") == ["https://y", "https://z"]


def test_numbers_supported(spark):
    text = "Площа 55,5 м², 3 поверх. " + "слово " * 40
    assert one(spark, T.numbers_supported("t", "s", ["a", "f"]), t=text, s="", a=55.5, f=3) is True
    assert one(spark, T.numbers_supported("t", "s", ["a", "f"]), t=text, s="", a=54.5, f=3) is False
    assert one(spark, T.numbers_supported("t", "s", ["a", "f"]), t="коротко 3", s="", a=55.5, f=3) is False


# ---- brute force for what SQL cannot express ---------------------------------------------------
TEXTS = ["Опис: Світла квартира біля парку. Дзвоніть +38 067 123 45 67! Є балкон і вид на річку.\n\nПродаж від власника.",
         "Short. Tiny one. This sentence is long enough to stay here. http://x.y/z see www.site.com now please",
         "Комісія 50%. Ремонт зроблено минулого року, меблі нові? Так, усе нове!\n \nДругий абзац з текстом про школу.", "", None,
         "a " * 700 + "\n" + "слово " * 500 + "\r\nкінець"]


def plain_redact(text):
    text = re.sub(D.URL_SHAPE, "", re.sub(D.PHONE_SHAPE, "", text or ""), flags=re.I)
    for p in D.REDACTIONS:
        text = re.sub(p, " ", text, flags=re.I)
    out = []
    for block in re.split(r"\n\s*\n+", text):
        good = []
        for s in re.split(r"(?<=[.!?])\s+", block):
            s = re.sub(D.BANNED, "", re.sub(D.LEADING_LABEL, "", " ".join(s.split()), flags=re.I), flags=re.I)
            if len(s) >= 12 and not re.search(D.BANNED, s, re.I):
                good.append(s)
        out += [" ".join(good)] if good else []
    return "\n\n".join(out)


def plain_chunks(text, n):
    out = []
    for line in text.splitlines():
        cur = ""
        for w in line.split():
            if cur and len(cur) + 1 + len(w) > n:
                out.append(cur)
                cur = w
            else:
                cur = f"{cur} {w}".strip()
        out.append(cur)
    return out


def test_redaction_against_brute_force(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    for r in df.select("i", T.redact_text("t", limit=None).alias("r")).collect():
        assert r.r == plain_redact(TEXTS[r.i])


def test_chunks_against_brute_force(spark):
    texts = [t for t in TEXTS if t]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for n in (20, 900):
        for r in df.select("i", T.chunk_text("t", n).alias("r")).collect():
            assert r.r == plain_chunks(texts[r.i], n)


def test_whole_texts_unless_a_cut_is_asked_for(spark):
    text = "Світла квартира біля парку. " * 3_000
    df = spark.createDataFrame([(text.strip(), "i" * 300, "Назва " * 200)], "d string, i string, t string")
    r = df.select(T.redact_plain("d").alias("plain"), T.redact_text("d").alias("text"), T.publishable_text("d").alias("page"),
                  T.redact_plain("d", limit=100).alias("head"), C.clean_title("t", "i", "Agency").alias("title"),
                  display.safe_text("i").alias("cell"), display.safe_text("i", 12).alias("short")).first()
    assert [len(r[c]) for c in ("plain", "text", "page", "head")] == [len(text.strip())] * 3 + [100]
    assert len(r.title) == len(("Назва " * 200).strip()) + len(" · #") + 300 and (len(r.cell), len(r.short)) == (300, 12)


def test_payload_fields_stay_whole(spark):
    from rooftree.operators.normalize import PAYLOAD_SCHEMA, normalize_payload
    item = {"id": "9" * 400, "title": "t" * 900, "description": "d" * 60_000, "price": "5", "currency": "usd", "street": "s" * 700,
            "photos": [{"src": f"https://h/{i}/" + "p" * 2_500, "url": None} for i in range(40)], "operation": "rent"}
    r = normalize_payload(spark.createDataFrame([item], PAYLOAD_SCHEMA + ", operation string")).first()
    assert (r.external_id, r.title, r.description, r.street) == (item["id"], item["title"], item["description"], item["street"])
    assert [p for p in r.photos] == [p["src"] for p in item["photos"]]
