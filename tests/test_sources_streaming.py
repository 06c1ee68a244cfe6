"""Pages, payloads, grids and the streaming forms against their batch twins."""
import csv
import datetime
import io
import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rooftree.operators import state
from rooftree.operators.snapshots import upsert
from rooftree.sources import grids, pages, payloads, splits
from rooftree.streaming import availability, merge

BOARD = """<html><head><title>x</title><meta property="og:title" content="OG title"><meta property="og:image" content="https://cdn/og.jpg">
<script type="application/ld+json">{"@type": "Product", "name": "LD name", "description": "short", "offers": {"price": "25000"}, "image": ["https://cdn/1.jpg"]}</script></head>
<body><h1>Head</h1><ul><li class="css param"><p>Кількість кімнат: 2</p></li><li class="param"><p>Загальна площа: 54,5 м²</p></li>
<li class="param">Поверх: 3</li><li class="param">Поверховість: 9</li></ul>
<div data-cy="ad_description"><div>Довгий опис квартири у Печерському районі, метро Кловська<br>поруч.</div></div><p class="location">Київ, вул. Лесі Українки</p>
<h4 class="seller-name">Ганна</h4></body></html>"""
AGENCY = """<html><head><meta property="og:description" content="70 000 $ - продаж"></head><body><h1>Квартира</h1><div class="offer-view-price-title">95 000 $</div>
<div class="offer-view-region">Київ, Печерський р-н</div><div class="offer-view-details-row">3 кімнати</div><div class="offer-view-details-row">75,5 / 50 / 12 м²</div>
<div class="offer-view-details-row">поверх 4 з 16</div><div class="offer-view-labels">Комісія 50% <span>Кловська</span></div>
<div class="offer-view-rieltor-position">Власник</div><div class="offer-view-rieltor-phones">тел +38 (067) 123-45-67</div>
<div class="offer-view-gallery"><img src="https://cdn/a.jpg"><img data-src="https://cdn/b.jpg" src="x"></div><div class="offer-view-address">вул. Садова</div>
<div class="offer-view-address-line">Садова, 5</div></body></html>"""


def test_board_page(spark):
    df = spark.createDataFrame([(1, BOARD), (2, "<html><h1>Only head</h1>")], "page_id bigint, html string")
    a, b = pages.board_fields(df).orderBy("page_id").collect()
    assert (a.title, a.price_raw, a.rooms, a.area, a.floor, a.floors_total) == ("LD name", "25000", "2", "54,5", "3", "9")
    assert a.description.startswith("Довгий опис") and (a.address, a.district, a.street, a.metro_station) == ("Київ, вул. Лесі Українки", "Печерський", "Лесі Українки", "Кловська")
    assert (a.contact_name, a.photos, a.photo_url) == ("Ганна", ["https://cdn/1.jpg"], "https://cdn/og.jpg")
    assert (b.title, b.price_raw, b.photos) == ("Only head", None, [])


def test_agency_page(spark):
    a = pages.agency_fields(spark.createDataFrame([(1, AGENCY)], "page_id bigint, html string")).first()
    assert (a.title, a.price_raw, a.rooms, a.area, a.floor, a.floors_total) == ("Квартира", "95 000 $", "3", "75.5", "4", "16")
    assert (a.street, a.address, a.city, a.district) == ("вул. Садова", "Садова, 5", "Київ", "Печерський")
    assert (a.agent_type, a.contact_phone, a.commission, a.photos) == ("owner", "+38 (067) 123-45-67", "Комісія 50%", ["https://cdn/a.jpg", "https://cdn/b.jpg"])


def test_links_and_ad_id(spark):
    df = spark.createDataFrame([(1, "https://s.x/list?p=1", '<a href="/d/uk/a-ID1.html">a</a><a href=\'https://s.x/d/uk/b\'>b</a><a href="/d/uk/a-ID1.html">a</a><a href="#">c</a>')], "page_id int, url string, html string")
    assert sorted(r.href for r in pages.extract_links(df, scope="/d/uk/").collect()) == ["https://s.x/d/uk/a-ID1.html", "https://s.x/d/uk/b"]
    assert spark.createDataFrame([('{"ad_id": "77"}',)], "h string").select(pages.ad_id("h").alias("x")).first().x == "77"


def test_payload_defects(spark):
    items = ['{"id": "1", "price": "1 200,50", "currency": "uah", "floor": 9, "total_floors": 5, "rooms": "2.5", "city": {"name": "Київ"}}', '{"price": -5}']
    df = spark.createDataFrame([(i, "rent", p) for i, p in enumerate(items)], "n int, operation string, payload string")
    from rooftree.operators.normalize import normalize_payload
    a, b = normalize_payload(payloads.read_payloads(df)).orderBy(F.col("external_id").desc()).collect()
    assert (float(a.price_uah), a.rooms, a.floor, a.city, a.validation_errors, a.is_valid) == (1200.5, None, None, "Київ", ["invalid floor pair cleared"], False)
    assert b.validation_errors == ["missing external id", "missing or invalid price"]


def test_export_file(spark, tmp_path):
    path = tmp_path / "export.json"
    path.write_text('[{"external_token": "a1", "phone": "0671234567", "pos": 0}, {"url": "https://x/kv-IDa1.html", "phone": "0501112233", "pos": 1}, {"url": "none", "phone": "0671234567", "pos": 2}, {"external_token": "b", "phone": "12", "pos": 3}]')
    merged, stats = payloads.read_export(spark, str(path))
    assert {r.external_id: r.merged for r in merged.collect()} == {"olx_a1": ["+380671234567", "+380501112233"]}
    s = stats.first()
    assert (s.source_rows, s.unique_keys, s.invalid_key_rows, s.invalid_value_rows, s.conflicting_keys) == (4, 1, 1, 1, 1)


def test_grid_io(spark, tmp_path):
    df = spark.createDataFrame([("rent", "1", 'a "quoted"\nline'), ("rent", "2", None), ("buy", "3", "=x")], "tab string, id string, note string")
    counts = {r.tab: r.n_rows for r in grids.write_grid(df, str(tmp_path / "out")).collect()}
    assert counts == {"rent": 2, "buy": 1}
    back = grids.read_grid(spark, str(tmp_path / "out"), {"ID": ["id"]})
    assert {r.ID: r.note for r in back.collect()}["1"] == 'a "quoted"\nline'
    with pytest.raises(ValueError):
        grids.assert_header(df, ["id"])
    with pytest.raises(ValueError):
        grids.rename_aliases(df, {"url": ["link"]})
    assert grids.conform(df, ["id", "extra"]).columns == ["id", "extra"]


SCHEMA = "event_id bigint, listing_id bigint, checked_at timestamp, http_status int"


def checks(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.randint(0, 6), i * 60, rnd.choice([200, 404, 404, 410, 429, None])) for i in range(240)]
    df = spark.createDataFrame(rows, "event_id bigint, listing_id bigint, s bigint, http_status int")
    return df.select("event_id", "listing_id", F.timestamp_seconds("s").alias("checked_at"), "http_status")


def test_availability_stream_equals_batch_in_any_order(spark, tmp_path):
    df = checks(spark)
    for i, part in enumerate([2, 0, 1]):  # files arrive out of order
        df.where(F.floor(F.col("event_id") / 80) == part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    seen = {}

    def sink(batch, n):
        for r in batch.collect():
            seen[r.listing_id] = (r.missing, r.status)

    q = (availability.availability_stream(stream).writeStream.outputMode("update").foreachBatch(sink)
         .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert seen == {r.listing_id: (r.missing, r.status) for r in state.availability_state(df).collect()}


def files(path):
    return {str(p): p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def test_merge_rewrites_touched_buckets_only_and_replays(spark, tmp_path):
    src, out = str(tmp_path / "src"), tmp_path / "snap"
    schema = T.StructType.fromDDL("source string, external_id string, title string, retry_count long")
    keys = ["source", "external_id"]
    old = [("olx", f"k{i}", "old", 1) for i in range(200)]
    merge.create_snapshot(spark.createDataFrame(old, schema), str(out), keys, 16)
    before = files(out)
    step = lambda current, batch: upsert(current, batch, keys, {"title": "non_blank", "retry_count": "increment"})
    sink = merge.bucketed_sink(str(out), schema, keys, step, 16)
    for title in ("one", "two"):
        spark.createDataFrame([("olx", "k7", title, 1), ("olx", "new", title, 1)], schema).coalesce(1).write.mode("append").parquet(src)
    merge.run_available(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src), sink, str(tmp_path / "cp"))
    want = {**{k: (t, n) for _, k, t, n in old}, "k7": ("two", 3), "new": ("two", 2)}
    rows = lambda: {r.external_id: (r.title, r.retry_count) for r in merge.read_snapshot(spark, str(out), schema).collect()}
    assert rows() == want
    after = files(out)
    touched = {p.split("merge_bucket=")[1].split("/")[0] for p in after if before.get(p) != after[p]}
    assert len(touched) <= 2 and sum(p in before and before[p] == after[p] for p in after) >= 13
    sink(spark.createDataFrame([("olx", "k7", "two", 1), ("olx", "new", "two", 1)], schema), 1)  # the last batch once more
    assert rows() == want


def test_merge_into_no_snapshot_and_empty_batches(spark, tmp_path):
    schema = T.StructType.fromDDL("id string, title string")
    sink = merge.bucketed_sink(str(tmp_path / "s"), schema, ["id"], lambda current, batch: upsert(current, batch, ["id"]), 4)
    sink(spark.createDataFrame([], schema), 0)
    sink(spark.createDataFrame([("a", "x"), (None, "y")], schema), 1)
    assert sorted(map(str, merge.read_snapshot(spark, str(tmp_path / "s"), schema).collect())) == ["Row(id='a', title='x')", "Row(id=None, title='y')"]


def one_by_one(spark, tmp_path, batches, schema, stream, mode):
    """Run ``stream`` over the batches; the rows of each update in order, and the checkpoint."""
    path, out = str(tmp_path / "in"), []
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    (stream(source).writeStream.outputMode(mode).foreachBatch(lambda b, n: out.append([tuple(r) for r in b.collect()]))
     .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination())
    return [r for rows in out for r in rows], str(tmp_path / "cp")


def at(day, hour=0):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(days=day, hours=hour)


def test_a_listing_missing_for_ever_has_constant_state(spark, tmp_path):
    batches = [[(day * 10 + h, 1, at(day, h), 404) for h in range(4)] for day in range(6)]
    batches[3].append((99, 1, at(2, 20), 404))  # late, but in time
    batches[4].append((100, 1, at(0), 200))  # too late
    found, checkpoint = one_by_one(spark, tmp_path, batches, SCHEMA, lambda s: availability.availability_stream(s, delay="1 day"), "update")
    assert [r[3] for r in found] == [4, 8, 12, 17, 21, 25]
    open_ = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "misses").load()
    assert open_.count() <= 8  # two days' misses of six
    value = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "latest").load().select("value.*").first()
    assert value.folded >= 17 and value.ok_us == -1


def test_a_success_resets_folded_misses_and_dead_listings_are_forgotten(spark, tmp_path):
    batches = [[(1, 1, at(0), 404), (2, 2, at(0), 404)], [(3, 3, at(5), 200)], [(4, 1, at(6), 200), (5, 1, at(6, 1), 404)], [(6, 3, at(9), 200)], [(7, 3, at(20), 200)],
               [(8, 2, at(21), 410)]]
    found, checkpoint = one_by_one(spark, tmp_path, batches, SCHEMA, lambda s: availability.availability_stream(s, delay="1 day", forget="7 days"), "update")
    assert [(r[0], r[3], r[4]) for r in found if r[0] == 1] == [(1, 1, "active"), (1, 1, "active"), (1, 1, "forgotten")]
    assert [(r[3], r[4]) for r in found if r[0] == 2] == [(1, "active"), (1, "forgotten"), (1, "active")]
    assert spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "latest").load().select("key.*").distinct().count() == 2


def test_confirmations_wait_for_late_rows_and_come_once(spark, tmp_path):
    batches = [[(1, 1, at(0), 404), (2, 1, at(0, 2), 404), (3, 2, at(0), 404), (4, 2, at(0, 2), 410)],
               [(5, 2, at(0, 1), 200), (1, 1, at(0), 404)],  # late success between two misses; a repeat
               [(6, 1, at(3), 404), (7, 1, at(3, 1), 404), (8, None, at(9), None)]]
    found, _ = one_by_one(spark, tmp_path, batches, SCHEMA, lambda s: availability.confirmed_stream(s, delay="1 day"), "append")
    assert [(r[0], r[1], r[3]) for r in found] == [(1, 2, "http_404_confirmed")]


def test_sightings_of_incomplete_runs_never_pass(spark, tmp_path):
    seen = spark.createDataFrame([("rent", 1, 10, at(0)), ("rent", 1, 11, at(0, 1)), ("rent", 2, 10, at(1)), ("buy", 1, 12, at(0))],
                                 "operation string, run_id long, listing_id long, seen_at timestamp")
    done = spark.createDataFrame([("rent", 1, at(0, 3)), ("buy", 9, at(1))], "operation string, run_id long, completed_at timestamp")
    for df, name in ((seen, "seen"), (done, "done")):
        df.write.parquet(str(tmp_path / name))
    stream = availability.run_gate(*[spark.readStream.schema(df.schema).parquet(str(tmp_path / n)) for df, n in ((seen, "seen"), (done, "done"))])
    out = []
    (stream.writeStream.foreachBatch(lambda b, n: out.extend((r.operation, r.run_id, r.listing_id) for r in b.collect()))
     .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination())
    assert sorted(out) == [("rent", 1, 10), ("rent", 1, 11)]


def test_streaming_ledger_and_confirmations(spark, tmp_path):
    checks(spark).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    q = merge.ledger_stream(stream, "listing_id", "checked_at").writeStream.outputMode("complete").format("memory").queryName("led").trigger(availableNow=True).start()
    q.awaitTermination()
    want = state.attempt_ledger(checks(spark), "listing_id", "checked_at")
    assert sorted(map(str, spark.table("led").collect())) == sorted(map(str, want.collect()))
    hits = stream.where("http_status = 404").select("listing_id", F.col("checked_at").alias("confirmed_at"))
    q = availability.confirmed_events(hits).writeStream.outputMode("append").format("memory").queryName("once").trigger(availableNow=True).start()
    q.awaitTermination()
    ids = [r.listing_id for r in spark.table("once").collect()]
    assert len(ids) == len(set(ids)) > 0


# --- files of many splits ------------------------------------------------------------------------------------------------------

@pytest.fixture
def tiny_splits(spark):
    """Splits of 64 bytes, so records cross several of them."""
    names = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


CELLS = ["", "plain", "a,b", 'say "hi"', "two\nlines", "\n\n", '"', '""\n"', "é ш", " padded ", "x" * 150, "long\n" * 40]


@pytest.mark.parametrize("seed", range(3))
def test_grid_rows_keep_their_number_across_splits(spark, tmp_path, tiny_splits, seed):
    rng = random.Random(seed)
    rows = [[rng.choice(CELLS) for _ in range(3)] for _ in range(40)]
    text = io.StringIO()
    writer = csv.writer(text, lineterminator=rng.choice(["\n", "\r\n"]), quoting=csv.QUOTE_ALL)
    writer.writerows([["A", "b ", "c"], *rows])
    (tmp_path / "grid.csv").write_bytes(text.getvalue().encode())
    df = grids.read_grid(spark, str(tmp_path / "grid.csv"), {"Key": ["a"]}, row_number="sheet_row")
    assert splits._fragments(spark, str(tmp_path / "grid.csv"), "\n").rdd.getNumPartitions() > 20
    got = {r.sheet_row: [r["Key"] or "", r["b "] or "", r["c"] or ""] for r in df.collect()}
    assert got == {i: r for i, r in enumerate(rows, 2)}


def test_blank_lines_and_several_files_are_numbered(spark, tmp_path):
    for name, body in (("one.csv", 'id,n\n1,a\n\n2,"b\n"\n'), ("two.csv", 'id,n\n3,c')):
        (tmp_path / name).write_text(body)
    got = grids.read_grid(spark, str(tmp_path), row_number="at").collect()
    assert sorted((r["at"], r["id"], r["n"]) for r in got) == [(2, "1", "a"), (2, "3", "c"), (4, "2", "b\n")]


NOTES = ["plain", "} ] { [", 'quote " and \\', "\\", '\\"}', "шрифт ☃", "", "]}" * 60]


@pytest.mark.parametrize("seed", range(4))
def test_array_elements_across_splits(spark, tmp_path, tiny_splits, seed):
    rng = random.Random(seed)
    items = [{"id": i, "note": rng.choice(NOTES), "inner": [{"note": rng.choice(NOTES)}] * rng.randrange(3), "more": {"a": {"b": rng.choice(NOTES)}}} for i in range(30)]
    path = tmp_path / "items.json"
    path.write_text(json.dumps(items, ensure_ascii=bool(seed & 1), indent=2 if seed & 2 else None))
    assert splits._fragments(spark, str(path), "}").rdd.getNumPartitions() > 20
    got = sorted((json.loads(r.text) for r in splits.array_elements(spark, str(path)).collect()), key=lambda x: x["id"])
    assert got == items
    rows = splits.read_json_array(spark, str(path), "id long, note string, inner array<struct<note: string>>").collect()
    one = spark.read.schema("id long, note string, inner array<struct<note: string>>").json(str(path), multiLine=True).collect()
    assert sorted(map(str, rows)) == sorted(map(str, one))


def test_arrays_of_nothing(spark, tmp_path):
    for name, body in (("a.json", "[]"), ("b.json", " [ ] \n"), ("c.json", "[{}]"), ("d.json", "")):
        (tmp_path / name).write_text(body)
    assert [r.text for r in splits.array_elements(spark, str(tmp_path)).collect()] == ["{}"]


def test_grid_counts_come_from_the_write(spark, tmp_path):
    df = spark.createDataFrame([("rent", "1", " a "), ("rent", "2", None), ("buy", "3", "")], "tab string, id string, note string")
    counted = grids.write_grid(df, str(tmp_path / "a"), tabs=["rent", "buy", "none"])
    assert {r.tab: r.n_rows for r in counted.collect()} == {"rent": 2, "buy": 1}
    assert {(r.id, r.note) for r in grids.read_grid(spark, str(tmp_path / "a")).collect()} == {("1", " a "), ("2", None), ("3", None)}
    with pytest.raises(ValueError, match="rows of other tabs"):
        grids.write_grid(df, str(tmp_path / "b"), tabs=["rent"])


def test_payloads_with_changed_types_come_through(spark):
    items = ['{"id": "1", "price": 10, "rooms": "2"}', '{"id": 2, "price": "12.5", "rooms": 3, "new": {"x": 1}}', '{"id": "3", "price": [1]}', "broken {", None, "[1]", "7"]
    df = payloads.as_variant(spark.createDataFrame([(i, p) for i, p in enumerate(items)], "n int, payload string"))
    rows = payloads.typed_fields(df, {"id": "string", "price": "double", "rooms": "int"}, others="others").orderBy("n").collect()
    assert [(r.id, r.price, r.rooms, r.others) for r in rows] == [("1", 10.0, 2, []), ("2", 12.5, 3, ["new"]), ("3", None, None, []), *[(None, None, None, [])] * 4]
    report = {(r.field, r.type): r["items"] for r in payloads.drift_report(df).collect()}
    assert report == {("id", "STRING"): 2, ("id", "BIGINT"): 1, ("price", "BIGINT"): 1, ("price", "STRING"): 1, ("price", "ARRAY<BIGINT>"): 1, ("rooms", "STRING"): 1,
                      ("rooms", "BIGINT"): 1, ("new", "OBJECT<x: BIGINT>"): 1}
    assert payloads.common_schema(df.where("n < 4")).first().broken == 1
