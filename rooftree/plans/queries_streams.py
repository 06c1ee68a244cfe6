"""Queries of the streaming forms; each has the SQL of its batch form."""
from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import zip_longest

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rooftree.operators import snapshots as SN
from rooftree.operators import state as S
from rooftree.operators.reports import run_completeness
from rooftree.plans.queries_snapshots import _core, _incoming
from rooftree.plans.queries_snapshots import ASOF, SINCE
from rooftree.plans.queries_state import OK_TS, STATE
from rooftree.plans.registry import ORACLE, query
from rooftree.session import ROCKSDB, scratch_dir
from rooftree.streaming import availability as A
from rooftree.streaming import merge as M

PARTS = 4
DELAY = "1 day"
LATE_HOURS = 20  # less than DELAY


@contextmanager
def state_store(spark: SparkSession):
    """The RocksDB state store while a query runs."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def deliveries(df: DataFrame, at: str, late: str = "0", repeat: bool = False, end: DataFrame | None = None) -> tuple[DataFrame, Iterator[int]]:
    """The rows as a file stream, and its ``PARTS`` batches by delivery time: ``at`` plus ``late`` hours, so some come after newer ones.

    A batch is written, by as many tasks as its rows are read by, when the iterator is asked for it; the first one at once, since a
    stream needs its folder.  ``repeat`` delivers every row twice; ``end`` is one more batch.
    """
    spark, path = df.sparkSession, f"{scratch_dir(df.sparkSession)}/deliveries-{uuid.uuid4().hex}"
    timed = df.withColumn("__at", F.unix_timestamp(at) + F.expr(late).cast("long") * 3_600)
    low, high = timed.agg(F.min("__at"), F.max("__at")).first()
    part = F.least(F.lit(PARTS - 1), F.floor((F.col("__at") - F.lit(low or 0)) * PARTS / F.lit(max((high or 0) - (low or 0), 1))))
    timed = timed.withColumn("__part", part).drop("__at")
    timed = timed.unionByName(timed) if repeat else timed
    parts = [timed.where(F.col("__part") == i).drop("__part") for i in range(PARTS)]
    if end is not None:
        parts.append(end.select(*[F.col(f.name).cast(f.dataType) for f in df.schema.fields]))
    parts[0].write.parquet(path)

    def rest() -> Iterator[int]:
        yield 0
        for i, rows in enumerate(parts[1:], 1):
            rows.write.mode("append").parquet(path)
            yield i
    return spark.readStream.schema(df.schema).parquet(path), rest()


def collected(stream: DataFrame, mode: str, *batches: Iterator[int]) -> DataFrame:
    """Run batch after batch, each with all that is there; the updates with the number of their batch."""
    spark, work = stream.sparkSession, f"{scratch_dir(stream.sparkSession)}/stream-{uuid.uuid4().hex}"
    empty = spark.createDataFrame([], stream.schema).withColumn("batch_no", F.lit(0).cast("long"))
    empty.write.parquet(f"{work}/out/b=-1")

    def sink(batch: DataFrame, n: int) -> None:
        batch.withColumn("batch_no", F.lit(n).cast("long")).write.mode("overwrite").parquet(f"{work}/out/b={n}")
    with state_store(spark):
        for _ in zip_longest(*batches):
            run = (stream.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", f"{work}/checkpoint")
                   .trigger(availableNow=True).start())
            run.awaitTermination()
    return spark.read.schema(empty.schema).parquet(f"{work}/out")


@query("availability_stream_folded", STATE.format(checked="epoch_us(b.last_checked_at)", seen=f"epoch_us({OK_TS})"))
def _(t):
    checks = t.checks.select("listing_id", "event_id", "checked_at", "http_status")
    stream, batches = deliveries(checks, "checked_at", f"event_id % {LATE_HOURS}")
    updates = collected(A.availability_stream(stream, delay=DELAY), "update", batches)
    last = updates.groupBy("listing_id").agg(F.max_by(F.struct("last_checked_us", "last_seen_us", "missing", "status"), "batch_no").alias("s"))
    return last.select("listing_id", F.col("s.last_checked_us").alias("last_checked"), F.col("s.last_seen_us").alias("last_seen"), "s.missing", "s.status")


@query("confirmed_once_stream", ORACLE["confirmed_once"])
def _(t):
    checks = t.checks.select("listing_id", "event_id", "checked_at", "http_status")
    after = checks.agg(F.max("checked_at").alias("t")).select(F.lit(None).alias("listing_id"), F.lit(-1).alias("event_id"),
                                                               F.expr(f"t + INTERVAL {DELAY} + INTERVAL 1 HOUR").alias("checked_at"), F.lit(None).alias("http_status"))
    stream, batches = deliveries(checks, "checked_at", f"event_id % {LATE_HOURS}", repeat=True, end=after)
    found = collected(A.confirmed_stream(stream, delay=DELAY), "append", batches)
    return found.select("listing_id", "event_id", F.timestamp_micros("confirmed_us").cast(checks.schema["checked_at"].dataType).alias("confirmed_at"), "reason")


@query("absence_run_gate", ORACLE["absence_by_run"])
def _(t):
    pages = t.run_pages
    runs = run_completeness(pages)
    ended = pages.groupBy("operation", "run_id").agg(F.max("started_at").alias("completed_at"))
    done = runs.where("complete").join(ended, ["operation", "run_id"]).select("operation", "run_id", "completed_at")
    seen = pages.where("ok").select("operation", "run_id", "listing_id", F.col("started_at").alias("seen_at"))
    (sightings, first), (completions, second) = deliveries(seen, "seen_at"), deliveries(done, "completed_at")
    gate = A.run_gate(sightings, completions, delay="10 days", longest_run="40 days")
    return S.absence_by_run(runs, collected(gate, "append", first, second).select("operation", "run_id", "listing_id").distinct())


@query("merge_since_stream", ORACLE["merge_since"])
def _(t):
    spark, current = t.spark, _core(t.listings)
    path, keys = f"{scratch_dir(spark)}/catalog-{uuid.uuid4().hex}", ["source", "external_id"]
    M.create_snapshot(current, path, keys, 32)
    sink = M.bucketed_sink(path, current.schema, keys, lambda old, new: SN.merge_since(old, new, SINCE, ASOF), 32)
    stream, batches = deliveries(_incoming(t), "updated_at")
    for _ in batches:
        M.run_available(stream, sink, f"{path}-checkpoint")
    return M.read_snapshot(spark, path, current.schema)


@query("attempt_ledger_stream", ORACLE["attempt_ledger"])
def _(t):
    stream, batches = deliveries(t.checks.select("listing_id", "event_id", "checked_at"), "checked_at", f"event_id % {LATE_HOURS}")
    updates = collected(M.ledger_stream(stream, "listing_id", "checked_at"), "update", batches)
    return updates.groupBy("listing_id").agg(F.max("attempted_at").alias("attempted_at"))
