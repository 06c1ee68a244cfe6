"""Registered queries against their SQL on the smallest data (all of them with ROOFTREE_ALL=1)."""
import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from check_oracle import TABLES, rows_of

FOLDER = "/root/testdata/sf0.001"
SOME = ["flow_gate_dedupe_coverage", "cross_source_duplicates", "merge_since", "import_plan_stats", "resolve_media_hold", "mismatch_report",
        "job_transition", "absence_by_run", "islands", "convert_with_rates", "distinct_counts", "page_links"]

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="shared test tables not present")


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()) if os.environ.get("ROOFTREE_ALL") else SOME)
def test_query_matches_sql(spark, duck, name):
    got = rows_of(entry.queries()[name](spark, FOLDER).toArrow())
    want = rows_of(duck.execute(entry.oracle_sql()[name]).to_arrow_table())
    assert got[0] == want[0] and got[2] == want[2]
