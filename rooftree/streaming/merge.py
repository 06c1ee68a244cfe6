"""Incremental merge of a stream into a bucketed snapshot, and streaming ledgers."""
from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET = "merge_bucket"


def _folder(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), root


def _complete(spark: SparkSession, path: str) -> bool:
    fs, root = _folder(spark, f"{path}/_SUCCESS")
    return fs.exists(root)


def _remove(spark: SparkSession, path: str) -> None:
    fs, root = _folder(spark, path)
    fs.delete(root, True)


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def create_snapshot(df: DataFrame, path: str, keys: list[str], buckets: int = 256) -> None:
    """Write a snapshot as one folder for each bucket of keys."""
    (df.withColumn(BUCKET, bucket_of(keys, buckets)).repartition(buckets, BUCKET)
     .write.partitionBy(BUCKET).mode("errorifexists").parquet(path))


def read_snapshot(spark: SparkSession, path: str, schema) -> DataFrame:
    """All rows; ``schema`` is the table's, without the bucket."""
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def bucketed_sink(path: str, schema, keys: list[str], merge: Callable[[DataFrame, DataFrame], DataFrame], buckets: int = 256):
    """foreachBatch function that merges a batch into the buckets of its keys and rewrites no other.

    A batch of k keys reads and writes k buckets at most; the list of touched buckets is bounded by ``buckets``.  The merged
    buckets are first written beside the snapshot, whole, then moved over the old ones by dynamic partition overwrite.  A
    batch that is replayed after a failure finds its merged buckets and only moves them again, so no merge happens twice,
    whatever the merge policy counts.  Until a batch is done, readers may see some of its buckets before others.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        pending = f"{path.rstrip('/')}-pending/batch-{batch_id}"
        if not _complete(spark, pending):
            incoming = batch.withColumn(BUCKET, bucket_of(keys, buckets)).persist()
            try:
                touched = [r[0] for r in incoming.select(BUCKET).distinct().collect()]
                if not touched:
                    return
                current = spark.read.schema(schema).parquet(path).where(F.col(BUCKET).isin(touched)) if _complete(spark, path) else spark.createDataFrame([], schema)
                merged = merge(current.select(*schema.fieldNames()), incoming.drop(BUCKET))
                merged = merged.withColumn(BUCKET, bucket_of(keys, buckets)).repartition(min(buckets, len(touched)), BUCKET)
                merged.write.mode("overwrite").partitionBy(BUCKET).parquet(pending)
            finally:
                incoming.unpersist()
        (spark.read.parquet(pending).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path))
        _remove(spark, f"{path.rstrip('/')}-pending/batch-{batch_id - 1}")
    return apply


def run_available(stream: DataFrame, sink, checkpoint: str) -> None:
    """Drive everything that is available now through a foreachBatch sink and stop."""
    query = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def ledger_stream(events: DataFrame, key: str = "listing_id", ts: str = "attempted_at") -> DataFrame:
    """Last attempt per key as a streaming aggregate (update mode)."""
    return events.groupBy(key).agg(F.max(ts).alias("attempted_at"))
