"""Commercial, agency and board pages, link ids, and display specs of the other catalogs."""
from pyspark.sql import functions as F

from rooftree import defaults as D
from rooftree.functions import arrays, display
from rooftree.sources import pages

OFFICE = """<html><head><script type="application/ld+json">[{"@type": "Offer"}]</script>
<script type="application/ld+json">{"@type": "Product", "name": "Офіс 120 м²", "description": "з JSON", "offers": {"price": "1200"}, "image": ["https://cdn/1.jpg", "data:x", "https://cdn/1.jpg"]}</script></head>
<body><h1>Заголовок</h1><div data-testid="ad-price-container"><span>x</span><h3> 1 300 $ </h3></div><ul class="css-params"><li>Поверх: цоколь</li><li>Площа: 120,5 м²</li><li>Площа кухні: 9 м²</li>
<li>Поверх: 2 / 5</li></ul><div data-testid="main-parameters"><p>Поверх: перший</p></div><a href="https://x/map?q=1"><span>Київ, вул. Січових Стрільців, 10</span></a>
<div class="user-info"><div><a href="/u">Олена</a></div></div><img src="https://cdn/9.jpg"></body></html>"""
WAREHOUSE = """<body><span class="offer-photo-gallery__title">Склад</span><div class="offer-view-price">5 000 грн</div><div class="offer-view-address-line">просп. Перемоги, 1</div>
<div class="offer-view-region">Київ, Печерський р-н</div><div class="offer-view-section-text"><p>Опис <b>складу</b></p></div><div class="offer-view-details-row">350 м²</div>
<div class="offer-view-details-row">1 з 3 поверх</div><a class="offer-view-rieltor-name x">Ігор</a><div class="offer-view-rieltor-position">Власник</div>
<a class="offer-view-rieltor-agency-link">Агенція</a><div class="offer-view-rieltor-phones"><p>+38 (067) 123-45-60</p>, <p>0501112200</p></div><img data-src="https://cdn/a.jpg" src="x"><img src="https://cdn/a.jpg"></body>"""


def one(spark, fields, html):
    return fields(spark.createDataFrame([(1, html), (2, None), (3, "")], "page_id bigint, html string")).orderBy("page_id").collect()


def test_commercial_board_page(spark):
    a, *blank = one(spark, pages.commercial_board_fields, OFFICE)
    assert (a.title, a.description, a.price_raw, a.area) == ("Офіс 120 м²", "з JSON", "1 300 $", "120,5")
    assert (a.floor, a.floors_total, a.floor_label, a.contact_name) == ("2", "5", "Поверх: перший", "Олена")
    assert (a.address, a.street) == ("Київ, вул. Січових Стрільців, 10", "вул. Січових Стрільців")
    assert (a.photos, a.photo_url) == (["https://cdn/1.jpg"], "https://cdn/1.jpg")
    assert all(b.title is None and b.photos == [] and b.photo_url is None for b in blank)


def test_commercial_agency_page(spark):
    a, *blank = one(spark, pages.commercial_agency_fields, WAREHOUSE)
    assert (a.title, a.description, a.price_raw, a.area, a.floor, a.floors_total) == ("Склад", "Опис складу", "5 000 грн", "350", "1", "3")
    assert (a.address, a.district, a.street) == ("просп. Перемоги, 1 Київ, Печерський р-н", "Печерський", "просп. Перемоги")
    assert (a.contact_name, a.advertiser_type, a.agency_name) == ("Ігор", "agency", "Агенція")
    assert (a.phones, a.photos) == (["+38 (067) 123-45-60", "0501112200"], ["https://cdn/a.jpg"])
    assert all(b.title is None and b.phones == [] for b in blank)


def test_page_markup_is_read_in_one_stage(spark):
    df = spark.createDataFrame([(1, OFFICE)], "page_id bigint, html string")
    for fields in (pages.board_fields, pages.agency_fields, pages.commercial_board_fields, pages.commercial_agency_fields):
        plan = fields(df)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan and plan.count("MapInArrow") == 1


def test_link_ids(spark):
    html = '<a href="/d/uk/obyavlenie/x-IDab1.html">1</a> <a href="https://rieltor.x/flats-rent/view/77/">2</a> <a href="/about">3</a> <a href="/d/uk/no.html">4</a>'
    df = spark.createDataFrame([(1, "https://www.olx.x/list/", html)], "page_id int, url string, html string")
    assert {(r.href, r.external_id) for r in pages.extract_links(df, sites=D.SITE_RULES).collect()} == {
        ("https://www.olx.x/d/uk/obyavlenie/x-IDab1.html", "olx_ab1"), ("https://rieltor.x/flats-rent/view/77/", "rieltor_77")}
    assert pages.extract_links(df).count() == 4


def test_display_specs_of_commercial_and_houses(spark):
    df = spark.createDataFrame([(1, "rent", "active", "=x", 12.0, 3, 9, "цоколь", True, ["+380", "050"], None)],
                               "id long, operation string, status string, title string, area_total_m2 double, floor int, floors_total int, floor_label string, generator boolean, phones array<string>, comments string")
    row = display.display_projection(df, display.commercial_grid_spec(df, D.COMMERCIAL_WIDTHS)).first()
    assert list(row.asDict()) == D.COMMERCIAL_HEADERS
    assert (row["Операція"], row["Статус"], row["Заголовок"], row["Площа, м²"], row["Поверх"]) == ("Оренда", "Актуальне", "'=x", "12", "цоколь; 3 з 9")
    assert (row["Генератор"], row["Рампа"], row["Телефони"], row["Коментарі"], row["Місто"]) == ("Так", "", "'+380 050", "", "")
    house = spark.createDataFrame([(1, " None ", "http://x/1.jpg", "x" * 600)], "id long, title string, photo_url string, city string")
    house = house.select("*", *[F.lit(None).cast("string").alias(c) for c in D.HOUSE_COLUMNS if c not in house.columns])
    row = display.display_projection(house, display.house_grid_spec(D.HOUSE_WIDTHS)).first()
    assert (row.id, row.title, row.photo_url, len(row.city), row.source) == ("1", "None", '=IMAGE("http://x/1.jpg")', 500, "")


def test_photo_urls_keep_their_digits(spark):
    urls = ["https://cdn/100", "https://cdn/111", " https://cdn/x2 "]
    got = spark.createDataFrame([(urls,)], "p array<string>").select(arrays.https_photos("p").alias("p")).first().p
    assert got == ["https://cdn/100", "https://cdn/111", "https://cdn/x2"]
