"""Headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line.

Large tables lie in many files; the shared ones are a single file with one row group, which one core would read.  So the tables
are written once, before any timing, as ``PARTS`` files each, and every query reads those.  ``task_sec`` are the seconds that
all tasks of a query took together: what it costs on any number of cores.
"""
from __future__ import annotations

import json
import os
import statistics
import tempfile
import time
from pathlib import Path

from rooftree.plans import load_queries
from rooftree.session import local_session

HEADLINE = [
    "flow_gate_dedupe_coverage", "quality_gate", "dedupe_by_url", "dedupe_by_fingerprint", "cross_source_duplicates",
    "coverage_report", "catalog_audit", "freshness", "photo_work_queue", "merge_apartments", "overwrite_upsert", "fill_missing",
    "reconcile", "mismatch_report", "import_plan", "resolve_media_hold", "availability_state", "confirmed_once", "throttle_cut",
    "islands", "balanced_batch", "job_transition", "merge_values_by_key", "display_projection", "normalize_commission",
    "enrich_from_text", "redact_documents", "normalize_listing", "normalize_payload", "page_links"]


PARTS = 16


def in_parts(spark, folder: str) -> str:
    """The tables of ``folder`` as folders of part files."""
    out = tempfile.mkdtemp(prefix="bench-")
    for table in sorted(Path(folder).glob("*.parquet")):
        spark.read.parquet(str(table)).repartition(PARTS).write.parquet(f"{out}/{table.name}")
    return out


def task_seconds(spark) -> float:
    """Seconds of all finished tasks so far."""
    executors = spark.sparkContext._jsc.sc().statusStore().executorList(False)
    return sum(executors.apply(i).totalDuration() for i in range(executors.size())) / 1000


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, cpus)
    queries = load_queries()[0]
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n in queries]
    parts, seconds, tasks = in_parts(spark, folder), {}, {}
    for name in names:
        times = []
        for attempt in range(3):
            before, start = task_seconds(spark), time.perf_counter()
            queries[name](spark, parts).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)  # the first run warms the JVM up
        tasks[name] = round(task_seconds(spark) - before, 3)
    print(json.dumps({"metric": "listing_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "task_sec": tasks, "parts": PARTS, "sf": folder.rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
