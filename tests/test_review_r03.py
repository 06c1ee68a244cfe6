"""Cases of the third review."""
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from rooftree import defaults as D
from rooftree.functions import arrays as A2
from rooftree.operators import state as S
from rooftree.plans import queries_sources, queries_streams
from rooftree.plans.queries_streams import deliveries
from rooftree.sources import pages as P
from rooftree.sources.splits import read_numbered_grid
from rooftree.streaming import availability as A


@pytest.mark.parametrize("message, transient", [
    ("FLOOD_WAIT_429", False), ("FLOOD_WAIT_1429", False), ("listing 42901 is gone", False), ("HTTP 429", True), ("status=429, slow down", True),
    ("429", True), ("Connection reset by peer, timeout", True), ("404 Client Error: not found", False), (None, False)])
def test_a_status_code_is_a_number_of_its_own(spark, message, transient):
    df = spark.createDataFrame([(message,)], "e string")
    assert df.select(S.is_transient(F.col("e"))).first()[0] is transient


def test_batches_of_a_stream_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    """A batch has several files, no row is lost or late, and each batch is taken whole."""
    rows = spark.range(0, 400, 1, 4).selectExpr("id % 7 AS listing_id", "id AS event_id", "timestamp_seconds(id * 3600) AS checked_at", "IF(id % 3 = 0, 404, 200) AS http_status")
    monkeypatch.setattr(queries_streams, "scratch_dir", lambda _: str(tmp_path))
    stream, batches = deliveries(rows, "checked_at", "event_id % 20")
    seen = []

    def sink(batch, n):
        seen.append((n, batch.count(), len(list(tmp_path.glob("deliveries-*/part-*.parquet")))))
    for _ in batches:
        stream.writeStream.foreachBatch(sink).option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    assert len(seen) == 4 and sum(n for _, n, _ in seen) == 400 and seen[-1][2] > 4


def test_open_checks_of_a_key_are_kept_in_one_call():
    """The state takes as many calls for a thousand open checks as for one."""
    class Calls:
        def __init__(self):
            self.rows, self.n = [], 0

        def exists(self):
            self.n += 1
            return bool(self.rows)

        def get(self):
            self.n += 1
            return iter(self.rows)

        def put(self, rows):
            self.n, self.rows = self.n + 1, list(rows)

        def clear(self):
            self.n, self.rows = self.n + 1, []
    state = Calls()
    A._keep(state, {(i, i): 404 for i in range(1_000)})
    assert state.n == 1 and A._taken(state) == {(i, i): 404 for i in range(1_000)} and state.n == 3
    A._keep(state, {})
    assert A._taken(state) == {}


def _by_parser(page, wanted):
    p = P._Blocks(wanted)
    p.feed(page)
    return p.finish()


@pytest.mark.parametrize("wanted", [D.BOARD_BLOCKS, D.AGENCY_BLOCKS, D.COMMERCIAL_BOARD_BLOCKS, D.COMMERCIAL_AGENCY_BLOCKS])
def test_plain_pages_read_by_pattern_give_what_the_parser_gives(wanted):
    rng, values = random.Random(7), sorted({r[3] for rules in wanted.values() for r in rules})
    tags = sorted({r[0] for rules in wanted.values() for r in rules} - {"*"} | {"div", "p", "li", "img", "br", "title", "script", "B"})
    odd = ["<!-- c -->", "a < b", "<p class=x>", "<br/>", "<input disabled>", "</>", "<", "<a href='q'>", "<title>a&amp;<b>"]
    plain = 0
    for i in range(3_000):
        parts = []
        for _ in range(rng.randrange(14)):
            tag, kind = rng.choice(tags), rng.randrange(5)
            attrs = "".join(f' {rng.choice(["class", "data-cy", "data-testid", "id", "SRC", "data-src"])}="{rng.choice(values)} x"' for _ in range(rng.randrange(3)))
            parts.append([f"<{tag}{attrs}>", f"</{tag} >", " text &amp; m&sup2; &lt ", "слово\n", f"<{tag}{attrs}>a</{tag}>"][kind])
        if i % 3 == 0:
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(odd))
        page = "".join(parts)
        got, want = P._read(page, wanted, P._rules_by_tag(wanted)), _by_parser(page, wanted)
        plain += P._Blocks(wanted).read_plain(page)
        assert (got.text, got.images, got.page_images) == (want.text, want.images, want.page_images), page
    assert plain > 1_000  # the parser alone reads none of them by pattern


def test_files_of_a_folder_are_one_sheet(spark, tmp_path):
    (tmp_path / "part-0.csv").write_text('"id","note"\n"1","a\nb"\n"2","c"\n')
    (tmp_path / "part-1.csv").write_text('"id","note"\n')
    (tmp_path / "part-2.csv").write_text('"id","note"\n"3","d"\n"4","e"')
    rows = read_numbered_grid(spark, str(tmp_path), ["id", "note"], one_sheet=True).collect()
    assert sorted((r["sheet_row"], r["id"], r["note"]) for r in rows) == [(2, "1", "a\nb"), (3, "2", "c"), (4, "3", "d"), (5, "4", "e")]


@pytest.mark.parametrize("name", ["grid_sheet_rows", "export_array"])
def test_no_task_writes_the_whole_table(spark, name, monkeypatch, tmp_path):
    monkeypatch.setattr(queries_sources, "scratch_dir", lambda _: str(tmp_path))
    monkeypatch.setattr(queries_sources, "ARRAY_ITEMS", 300)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        entry.queries()[name](spark, "/root/testdata/sf0.001").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len([p for p in tmp_path.rglob("part-*") if p.stat().st_size]) > 2


def test_photos_are_cleaned_once(spark):
    df = spark.createDataFrame([(["https://a/1.jpg 2x", "https://a/2.jpg", "https://a/1.jpg", "https://b/9.jpg", None],), (None,), ([],)], "p array<string>")
    out = df.select(A2.rank_photos("p", None, r"/2\.jpg", "/9").alias("u"))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract") == 1
    assert [r["u"] for r in out.collect()] == [["https://a/2.jpg", "https://a/1.jpg"], [], []]


def test_a_text_is_searched_once_for_each_shape_of_price(spark):
    """The groups of a mention are found in the mention, not by searches of the whole text."""
    from rooftree.functions import money

    shown = str(money._mentions(F.col("t"), money._SUFFIX, 1, 2, 0))
    assert shown.count("regexp_extract_all(") == 1
    df = spark.createDataFrame([("ціна 12 000 грн/м2, 5$ за кв.м або 700 usd",)], "t string")
    got = df.select(money._mentions(F.col("t"), money._SUFFIX, 1, 2, 0).alias("m")).first().m
    assert [(m["at"], m["amount"], m["currency"], m["is_rate"]) for m in got] == [
        (5, 12000.0, "UAH", True), (20, 5.0, "USD", True), (35, 700.0, "USD", False)]


def test_shuffles_of_the_intake_follow_the_rows(spark, monkeypatch):
    """Whole rows are dealt to as many tasks as their number asks for, and the session keeps its own setting."""
    from rooftree import session
    from rooftree.plans import flows

    small = entry.queries()["flow_intake"](spark, "/root/testdata/sf0.001").collect()
    parts, before = [], spark.conf.get("spark.sql.shuffle.partitions")
    monkeypatch.setattr(session, "TASK_ROWS", 150, raising=False)
    deal = flows.dedupe.dedupe_by_fingerprint
    monkeypatch.setattr(flows.dedupe, "dedupe_by_fingerprint", lambda df: parts.append(len(df.inputFiles())) or deal(df))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        many = entry.queries()["flow_intake"](spark, "/root/testdata/sf0.001").collect()
    finally:
        for name in ("coalescePartitions.enabled", "autoBroadcastJoinThreshold"):
            spark.conf.unset(f"spark.sql.adaptive.{name}")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(many) == sorted(small) and sum(r.n for r in small) >= 150
    assert parts[0] > 2 * int(before) and spark.conf.get("spark.sql.shuffle.partitions") == before


def test_sentences_are_looked_at_only_where_something_is_sensitive(spark):
    """The same text as sentence by sentence, for plain and for anchored patterns; other paragraphs are passed on."""
    from rooftree.functions import text as T

    def plainly(c, sensitive):
        paragraphs = F.transform(F.split(F.regexp_replace(T.unescape(F.coalesce(c, F.lit(""))), "<[^>]+>", " "), r"\n{2,}"), T.clean_text)
        return T._rejoin(paragraphs, lambda s: F.when((s != "") & ~T.has(s, sensitive), s))

    rng = random.Random(3)
    bits = [" ", "  ", "\n", "\n\n", " ", " ", ". ", "! ", "?", "<b>", "&lt;", "&amp;", "OLX", "xolx", "WhatſApp", "rİeltor", "rıeltor",
            "дзвᲂни", "Агент", "комісія", "ᲄелефон", "+38 067 123 45 67", "38٠٦٧ 123 45 67", "парк", "квартира", "́", "9"]
    rows = [("".join(rng.choice(bits) for _ in range(rng.randint(0, 20))),) for _ in range(3_000)] + [(None,), ("",)]
    df = spark.createDataFrame(rows, "t string")
    for sensitive in (D.SENSITIVE_SENTENCE, r"парк|olx\s", r"^парк|olx$", r"(?<=\s)olx", r"[^@]*+9"):
        got = df.select(T.publishable_text("t", sensitive).alias("a"), plainly(F.col("t"), sensitive).alias("b"))
        assert got.where("NOT a <=> b").take(3) == []
    shown = T.publishable_text("t")._jc.toString()
    assert shown.count("rlike") + shown.count("RLIKE") >= 2 and "contains(" in shown.lower()
