"""Snapshot mutations: merge policies, idempotence, notes, archive, verification."""
import json

import pytest
from pyspark.sql import functions as F

from rooftree.operators import lookups, normalize, snapshots as S
from rooftree.operators.values import merge_values_by_key

COLS = "source string, external_id string, title string, price_uah double, photos array<string>, agent_type string, status string, retry_count bigint, updated_at string"
NOW = "'now'"
POLICY = {"title": "non_blank", "price_uah": "non_null", "photos": "non_empty", "agent_type": "unless_unknown", "status": "sticky", "retry_count": "increment", "updated_at": "asof"}


@pytest.fixture(scope="module")
def both(spark):
    cur = spark.createDataFrame([("olx", "a", "Old", 1.0, ["p"], "owner", "archived", 2, "then"), ("olx", "b", "Old", None, ["p"], "agent", "inactive", 0, "then"),
                                 ("feed", "c", "Old", 1.0, [], None, "active", 0, "then")], COLS)
    inc = spark.createDataFrame([("olx", "a", "", None, [], "unknown", "active", 0, "x"), ("olx", "b", "New", 5.0, ["q"], "owner", "active", 0, "x"),
                                 ("feed", "c", "New", 9.0, ["z"], "owner", "active", 0, "x"), ("olx", "d", "Fresh", 7.0, [], None, "active", 0, "x")], COLS)
    return cur, inc


def rows(df):
    return {r.external_id: r for r in df.collect()}


def test_policies(both):
    got = rows(S.upsert(*both, policy=POLICY, asof=NOW, guard=F.col("source") == "feed"))
    a, b, c, d = (got[k] for k in "abcd")
    assert (a.title, a.price_uah, a.photos, a.agent_type, a.status, a.retry_count, a.updated_at) == ("Old", 1.0, ["p"], "owner", "archived", 3, "now")
    assert (b.title, b.price_uah, b.photos, b.agent_type, b.status) == ("New", 5.0, ["q"], "owner", "active")
    assert (c.title, c.updated_at) == ("Old", "then")
    assert (d.title, d.status, d.retry_count, d.updated_at) == ("Fresh", "active", 0, "now")


def test_merge_is_idempotent(both):
    cur, inc = both
    policy = {k: v for k, v in POLICY.items() if v != "increment"}
    once = S.upsert(cur, inc, policy=policy, asof=NOW)
    twice = S.upsert(once, inc, policy=policy, asof=NOW)
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))


def test_latest_per_key_and_insert_if_absent(spark):
    df = spark.createDataFrame([("k", 1, "x"), ("k", 3, "z"), ("k", 2, "y"), ("j", 1, "w")], "key string, n int, v string")
    assert sorted(r.v for r in S.latest_per_key(df, ["key"], ["n"]).collect()) == ["w", "z"]
    new = spark.createDataFrame([("k", 9, "no"), ("m", 1, "yes")], df.schema)
    assert sorted(r.v for r in S.insert_if_absent(df, new, ("key",)).collect()) == ["w", "x", "y", "yes", "z"]


def test_archive_once_with_whole_snapshot(spark):
    df = spark.createDataFrame([("apartments", 1, "inactive", None), ("apartments", 2, "active", "t"), ("apartments", 3, "archived", "t")], "catalog string, id bigint, status string, title string")
    done = spark.createDataFrame([("apartments", 3, "then", "r", "{}")], "catalog string, id bigint, archived_at string, reason string, snapshot string")
    archive, rest = S.archive_inactive(df, done, "historical_inactive", NOW)
    added = {r.id: r for r in archive.collect()}
    assert set(added) == {1, 3} and json.loads(added[1].snapshot) == {"catalog": "apartments", "id": 1, "status": "inactive", "title": None}
    assert [r.id for r in rest.collect()] == [2]
    again, _ = S.archive_inactive(df, archive, "historical_inactive", NOW)
    assert again.count() == 2


def test_fill_missing_rules(spark):
    schema = "id int, property_type string, title string, description string, floor int, floors_total int, agent_type string, photos array<string>"
    cur = spark.createDataFrame([(1, "Квартира", " ", "short", None, None, "unknown", None), (2, "Будинок", "T", "x" * 50, None, None, "owner", ["a"])], schema)
    cand = spark.createDataFrame([(1, "", "New", "y" * 45, 3, 9, "agency", ["p"]), (2, "", "New", "y" * 60, 3, 9, "agent", ["p"])], schema).drop("property_type")
    a, b = S.fill_missing(cur, cand).orderBy("id").collect()
    assert (a.title, a.description, a.floor, a.floors_total, a.agent_type, a.photos, a.changed_fields) == ("New", "y" * 45, 3, 9, "agency", ["p"], 6)
    assert (b.title, b.floor, b.floors_total, b.agent_type, b.photos, b.changed_fields) == ("T", None, 9, "owner", ["a"], 1)


def test_verify_and_fingerprint(spark):
    before = spark.createDataFrame([(1, "a", "p"), (2, "b", "p"), (3, "c", "p")], "id int, title string, phone string")
    after = spark.createDataFrame([(1, "a", "q"), (2, "B", "q"), (3, "c", "p")], before.schema)
    plan = spark.createDataFrame([(1, "q"), (2, "q"), (3, "q")], "id int, new_value string")
    assert tuple(S.verify_only_changed(before, after, "id", "phone", plan).first()) == (1, 1, 1)


def test_import_plan(spark):
    cat = spark.createDataFrame([("apartments", 1, "e1", "rent", "active", "0671234567"), ("houses", 2, "e1", "buy", "inactive", None), ("houses", 3, "e2", "buy", "active", "+380509999999")],
                                "catalog string, id int, external_id string, operation string, status string, agent_phone string")
    phones = spark.createDataFrame([("e1", ["+380671234567", "+380501112233"]), ("e2", ["+380509999999"]), ("e9", ["+380000000000"])], "external_id string, phones array<string>")
    plan, stats = lookups.plan_import(cat, phones)
    got = {r.id: (r.new_value, r.needs_update) for r in plan.collect()}
    assert got == {1: ("+380671234567 +380501112233", True), 2: ("+380671234567 +380501112233", True), 3: ("+380509999999", False)}
    s = stats.first()
    assert (s.matched_keys, s.matched_rows, s.unmatched_keys, s.cross_catalog_keys, s.rows_to_update) == (2, 3, 1, 1, 2)


def test_merge_values_order_and_conflicts(spark):
    df = spark.createDataFrame([(0, "a", ["2", "1"]), (1, "a", ["1", "3"]), (2, "b", ["x"]), (3, None, ["x"]), (4, "b", []), (5, "b", ["x"])], "pos int, k string, v array<string>")
    merged, stats = merge_values_by_key(df, "k", "v", "pos")
    got = {r.k: (r.merged, r.conflict) for r in merged.collect()}
    assert got == {"a": (["2", "1", "3"], True), "b": (["x"], False)}
    s = stats.first()
    assert (s.source_rows, s.invalid_key_rows, s.invalid_value_rows, s.unique_keys, s.conflicting_keys, s.duplicate_rows) == (6, 1, 1, 2, 1, 2)


def test_normalize_listing_fallbacks(spark):
    df = spark.createDataFrame([("olx", "rent", "olx_1", "u", "Здам 2-кімн квартиру", "50 м², 12 поверх/5 поверх, без комісії", "25 000", "12", "5", "067 123 45 67", ["https://a/1.jpg"]),
                                ("olx", "buy", "olx_2", "u", "", "", "", None, None, None, None)],
                               "source string, operation string, external_id string, url string, title string, description string, price_raw string, floor string, floors_total string, contact_phone string, photos array<string>")
    a, b = normalize.normalize_listing(df).orderBy("external_id").collect()
    assert (a.price_uah, a.price_usd, a.source_currency, a.rooms, a.area, a.floor, a.floors_total) == (25000.0, 602.0, "UAH", 2, 50.0, None, None)
    assert a.extraction_confidence == {"price": "structured", "rooms": "regex", "area": "regex", "floor": "invalid"}
    assert (a.agent_type, a.commission, a.agent_phone, a.photo_url, a.is_valid) == ("owner", "Без комісії", "+380671234567", "https://a/1.jpg", True)
    assert (b.validation_errors, b.is_valid, b.source_currency) == (["no_content", "no_price"], False, "USD")


def test_normalize_commercial_record(spark):
    df = spark.createDataFrame([("olx", "rent", "olx_1", "u", "Офіс у центрі, Київ", "Оренда 12 $/м². Є генератор, окремий вхід. Поверх 2 з 9, стеля 3,2 м, 40 кВт", "300 $", "120", "0671234567"),
                                ("olx", "buy", "olx_2", "u", "Склад у Львові", "", "", None, None)],
                               "source string, operation string, external_id string, url string, title string, description string, price_raw string, area string, contact_phone string")
    a, b = normalize.normalize_commercial(df).orderBy("external_id").collect()
    assert (a.commercial_type, a.price_amount, a.price_currency, a.price_per_m2, a.area_total_m2) == ("office", 1440.0, "USD", 12.0, 120.0)
    assert (a.generator, a.separate_entrance, a.ramp, a.floor, a.floors_total, a.electric_power_kw) == (True, True, None, 2, 9, 40.0)
    assert (a.phones, a.contact_visibility, a.city, a.validation_errors) == (["+380671234567"], "public", "Київ", [])
    assert (b.commercial_type, b.price_amount, b.price_currency, b.validation_errors) == ("warehouse", None, "UNKNOWN", ["outside_kyiv_region", "missing_area"])
