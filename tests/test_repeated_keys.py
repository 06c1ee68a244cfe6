"""Repeated incoming keys, relative links and top rows of a hot group."""
from pyspark.sql import functions as F

from rooftree.operators.skew import per_group_top
from rooftree.operators.snapshots import insert_if_absent, upsert
from rooftree.sources.pages import extract_links

COLUMNS = "k string, at int, v string, n int"


def test_last_row_of_a_key_wins(spark):
    current = spark.createDataFrame([("a", 1, "x", 5)], COLUMNS)
    incoming = spark.createDataFrame([("a", 3, "", 0), ("a", 2, "y", 0), ("b", 1, "p", 0), ("b", 2, "q", 0)], COLUMNS)
    got = upsert(current, incoming, ["k"], {"v": "non_blank", "n": "increment"}, order=["at"]).collect()
    assert sorted(map(tuple, got)) == [("a", 3, "y", 7), ("b", 2, "q", 1)]
    plain = upsert(current, incoming, ["k"], order=["at"]).collect()
    assert sorted(map(tuple, plain)) == [("a", 3, "", 0), ("b", 2, "q", 0)]


def test_insert_if_absent_inserts_once(spark):
    current = spark.createDataFrame([("a", 1, "x", 5)], COLUMNS)
    incoming = spark.createDataFrame([("a", 3, "z", 0), ("b", 2, "q", 0), ("b", 1, "p", 0)], COLUMNS)
    assert sorted(map(tuple, insert_if_absent(current, incoming, ["k"], ["at"]).collect())) == [("a", 1, "x", 5), ("b", 1, "p", 0)]


def test_all_relative_links(spark):
    hrefs = ["page.html", "./y", "//h.z/p", "/r", "../up", "?q=1", "#here", "mailto:a@b.c", "https://o.x/a/../b"]
    html = "".join(f'<a href="{h}">t</a>' for h in hrefs)
    pages = spark.createDataFrame([(1, "https://s.x/d/e/f?z=1", html)], "page_id long, url string, html string")
    assert {r.href for r in extract_links(pages).collect()} == {
        "https://s.x/d/e/page.html", "https://s.x/d/e/y", "https://h.z/p", "https://s.x/r", "https://s.x/d/up", "https://s.x/d/e/f?q=1", "https://o.x/b"}


def test_many_top_rows_of_one_group(spark):
    rows = spark.range(9_000).select(F.lit("g").alias("g"), "id")
    got = per_group_top(rows, ["g"], [F.col("id").desc()], 5_000)
    assert got.count() == 5_000 and got.agg(F.min("id")).first()[0] == 4_000
