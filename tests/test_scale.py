"""Skew-safe primitives against plain windows and brute force."""
import random
from pathlib import Path

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rooftree.functions.text import digits
from rooftree.operators import dedupe, quality, reconcile, selection, skew, state
from rooftree.operators.quality import source_filter

FEW = settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def skewed(spark, n=400):
    rnd = random.Random(7)
    rows = [(i, "hot" if rnd.random() < .4 else rnd.choice([None, "a", "b", f"k{i % 50}"]), rnd.randint(0, 9)) for i in range(n)]
    return spark.createDataFrame(rows, "id bigint, k string, v int")


def as_set(df):
    return sorted(map(str, df.collect()))


def test_attach_group_equals_window(spark):
    df = skewed(spark)
    w = Window.partitionBy("k")
    want = df.select("*", F.max("v").over(w).alias("m"), F.count("*").over(w).alias("n"))
    assert as_set(skew.attach_group(df, ["k"], {"m": F.max("v"), "n": F.count(F.lit(1))})) == as_set(want)


def test_attach_lookup_equals_a_left_join(spark):
    df = skewed(spark)
    dim = spark.createDataFrame([("hot", 1), ("a", 2), ("k3", 3)], "k string, x int")
    want = df.join(dim, "k", "left").select("id", "k", "v", "x")
    assert as_set(skew.attach_lookup(df, dim, "k")) == as_set(want)


def test_ordinal_equals_row_number(spark):
    df = skewed(spark)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("id")).cast("bigint"))
    got = skew.ordinal(df, ["k"], [F.col("id").asc()], F.floor(F.col("id") / 16))
    assert as_set(got) == as_set(want)


@FEW
@given(points=st.lists(st.tuples(st.sampled_from(["x", "y"]), st.integers(-40, 120)), min_size=1, max_size=80), width=st.sampled_from([1, 4, 16, 1000]))
def test_islands_cover_all_positions(spark, points, width):
    df = spark.createDataFrame(points, "g string, p int")
    got = sorted((r.g, r.range_start, r.range_end) for r in skew.islands(df, "p", ["g"], width).collect())
    want = []
    for g, p in sorted(set(points)):
        if want and want[-1][0] == g and want[-1][2] == p - 1:
            want[-1] = (g, want[-1][1], p)
        else:
            want.append((g, p, p))
    assert got == want


@FEW
@given(codes=st.lists(st.sampled_from([200, 404, 410, 429, None, 503]), min_size=1, max_size=60))
def test_availability_and_confirmation_against_replay(spark, codes):
    rows = [(i, i % 3, f"2024-01-{1 + i // 24:02d} {i % 24:02d}:00:00", c) for i, c in enumerate(codes)]
    df = spark.createDataFrame(rows, "event_id bigint, listing_id bigint, ts string, http_status int").withColumn("checked_at", F.to_timestamp("ts"))
    missing, confirmed = {}, {}
    for i, listing, _, code in rows:
        n = missing.setdefault(listing, 0)
        missing[listing] = n + 1 if code in (404, 410) else 0 if code and 200 <= code <= 399 else n
        if code in (404, 410) and missing[listing] >= 2:
            confirmed.setdefault(listing, i)
    got = {r.listing_id: r.missing for r in state.availability_state(df).collect()}
    assert got == missing
    got = {r.listing_id: r.event_id for r in state.confirmed_once(df, slice_seconds=7200).collect()}
    assert got == confirmed


@FEW
@given(codes=st.lists(st.sampled_from([200, 429]), min_size=1, max_size=50))
def test_throttle_cut_against_replay(spark, codes):
    df = spark.createDataFrame([(i, "s", c) for i, c in enumerate(codes)], "pos bigint, scope string, http_status int")
    run, cut, want = 0, False, []
    for c in codes:
        want.append(cut)
        run = run + 1 if c == 429 else 0
        cut = cut or run >= 3
    got = [r.deferred for r in selection.throttle_cut(df, ["scope"], "pos", width=8).orderBy("pos").collect()]
    assert got == want


def listings(spark, n=300):
    rnd = random.Random(3)
    rows = []
    for i in range(n):
        twin = rnd.randint(0, 12) if rnd.random() < .5 else 100 + i
        rows.append((i, rnd.choice(["olx", "rieltor", "feed"]), "rent", rnd.choice(["active", "active", "inactive"]), rnd.choice(["u1", f"u{i}", " ", None, f"u{i % 40}"]),
                     f"A bright listing number {twin} near the old park", 50.0 + twin, "D", 20000.0 + twin, "+38067000%04d" % twin, rnd.choice([None, "2024-01-01", f"2024-01-{1 + i % 28:02d}"]), None))
    df = spark.createDataFrame(rows, "id bigint, source string, operation string, status string, url string, title string, area double, district string, price_uah double, agent_phone string, d string, comments string")
    return df.withColumn("updated_at", F.to_timestamp("d")).drop("d")


def test_dedupe_keeps_the_newest_row_per_key(spark):
    df = listings(spark)
    rows = [r.asDict() for r in df.collect()]
    groups = {}
    for r in rows:
        if r["status"] == "active" and not r["source"].startswith("feed") and (r["url"] or "").strip():
            groups.setdefault(r["url"], []).append(r)
    keeper = {r["id"]: max(g, key=lambda x: (x["updated_at"] is not None, x["updated_at"] or 0, x["id"]))["id"] for g in groups.values() for r in g}
    for r in dedupe.dedupe_by_url(df).collect():
        k = keeper.get(r.id)
        assert (r.status == "inactive" and r.comments == f"duplicate_url:{k}") if k not in (None, r.id) else r.comments is None


def cross_source_pairs(df: DataFrame, min_title: int = 20, min_phone: int = 10) -> DataFrame:
    """The self-join form of ``cross_source_duplicates`` (small data only)."""
    rows = source_filter(df).where((F.col("status") == "active") & (F.length("title") > min_title)
                                   & (F.length(digits("agent_phone")) >= min_phone))
    side = lambda p: rows.select(*[F.col(c).alias(p + c) for c in ("id", "source", "title", "operation")],
                                 F.coalesce("area", F.lit(0.0)).alias(p + "area"),
                                 F.coalesce("district", F.lit("")).alias(p + "district"),
                                 F.coalesce("price_uah", F.lit(0.0)).alias(p + "price"),
                                 digits("agent_phone").alias(p + "phone"))
    a, b = side("a_"), side("b_")
    cond = [a[f"a_{c}"] == b[f"b_{c}"] for c in ("title", "area", "district", "price", "phone", "operation")]
    cond += [a["a_id"] > b["b_id"], a["a_source"] != b["b_source"]]
    return a.join(b, cond, "left_semi").select(F.col("a_id").alias("id"))


def test_cross_source_window_form_equals_pairs(spark):
    df = listings(spark)
    assert as_set(dedupe.cross_source_duplicates(df).distinct()) == as_set(cross_source_pairs(df).distinct())


def test_first_rule_wins_and_null_rules_do_not_match(spark):
    df = spark.createDataFrame([(1, "olx", "rent", "active", 600000.0, None, 5.0, 1, None, None, "test", None, None), (2, "olx", "rent", "active", 50000.0, None, None, None, None, None, "A good long title", None, None)],
                               "id int, source string, operation string, status string, price_uah double, price_usd double, area double, rooms int, floor int, floors_total int, title string, city string, property_type string").withColumn("comments", F.lit(None).cast("string"))
    got = {r.id: (r.status, r.comments) for r in quality.quality_gate(df).collect()}
    assert got == {1: ("quarantine", "rent_price_too_high"), 2: ("active", None)}


@FEW
@given(want=st.lists(st.integers(1, 8), max_size=8), copy=st.lists(st.one_of(st.none(), st.integers(1, 10)), max_size=20))
def test_reconcile_applied_gives_the_expected_ids(spark, want, copy):
    expected = spark.createDataFrame([(str(w),) for w in want], "id string")
    actual = spark.createDataFrame([(None if c is None else str(c), i, "cell") for i, c in enumerate(copy)], "id string, pos bigint, x string")
    plan = reconcile.reconcile(expected, actual, "id", "pos").collect()
    keep = [r.id for r in plan if r.action in ("keep", "append")]
    assert sorted(keep) == sorted({str(w) for w in want})
    drop = {r.pos for r in plan if r.action in ("stale", "duplicate", "orphan")}
    assert sorted(str(c) for i, c in enumerate(copy) if i not in drop) == sorted({str(w) for w in want} & {str(c) for c in copy if c})


@FEW
@given(flags=st.lists(st.tuples(st.sampled_from("xy"), st.integers(0, 2)), min_size=1, max_size=60), width=st.sampled_from([1, 3, 7, 1000]), k=st.integers(1, 4))
def test_first_run_over_slices(spark, flags, width, k):
    df = spark.createDataFrame([(g, i, f) for i, (g, f) in enumerate(flags)], "g string, p long, f int")
    found = skew.first_run(df, ["g"], F.col("p"), F.col("f") > 0, k, F.floor(F.col("p") / width), F.col("f"))
    want = {}
    for group in "xy":
        length = 0
        for i, (g, f) in enumerate(flags):
            if g == group:
                length = length + 1 if f else 0
                if length == k:
                    want.setdefault(group, (i, f))
    assert {r.g: (r.run_code, r.run_value) for r in found.collect()} == want


def test_islands_across_many_levels(spark):
    edges = [(1 << b) + d for b in (3, 16, 17, 32, 48, 61) for d in (-2, -1, 0, 1)] + [-3, -2, -1, 0, 1] + [-(1 << 16) - 1, -(1 << 16), 1 - (1 << 16)]
    df = spark.createDataFrame([(p,) for p in set(edges)], "p long")
    for width in (1, 8, 65_536):
        got = sorted((r.range_start, r.range_end) for r in skew.islands(df, "p", width=width).collect())
        want = []
        for p in sorted(set(edges)):
            if want and want[-1][1] == p - 1:
                want[-1] = (want[-1][0], p)
            else:
                want.append((p, p))
        assert got == want


def test_islands_and_hot_logs_never_meet_in_one_task(spark):
    df = spark.range(1_000)
    plan = skew.islands(df, "id")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_ordinal_without_groups_sums_offsets_in_parts(spark):
    df = spark.range(0, 9_000, 3)
    got = skew._offsets(df.groupBy(F.floor(F.col("id") / 2).alias("__slice")).agg(F.count("*").alias("__cnt")), [], fan=50)
    rows = sorted((r["__slice"], r["__offset"]) for r in got.collect())
    assert [o for _, o in rows] == list(range(len(rows)))


def test_staged_results_can_be_removed(spark):
    from rooftree import session
    session.drop_stages(spark)
    path = session.staged(spark.range(3)).inputFiles()[0]
    assert session.drop_stages(spark) == 1 and session.drop_stages(spark) == 0
    assert not Path(path.removeprefix("file://")).exists()
