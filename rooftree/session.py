"""Session settings for tests and benches, and the shared scratch folder of a cluster."""
from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(cores: int | str = 8, partitions: int = 8, memory: str = "8g") -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{cores}]").appName("rooftree")
             .config("spark.driver.memory", memory).config("spark.ui.enabled", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.shuffle.partitions", str(partitions))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.files.openCostInBytes", "512k")  # small files of several row groups are split over the cores
             .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # call sites cost more than the calls
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """Folder that survives the loss of an executor: the one the cluster names; a temporary one only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="rooftree-")


_STAGES: list[str] = []  # what this driver has staged
TASK_ROWS = 500_000  # whole rows that a task of a shuffle should read at most, on average


@contextmanager
def shuffles_for(spark: SparkSession, rows: int):
    """Enough shuffle partitions for ``rows`` rows in the jobs that run inside; never fewer than the session has."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(max(int(before), -(-rows // TASK_ROWS))))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def staged(df: DataFrame, rows: int = 0) -> DataFrame:
    """Write an intermediate result to the shared folder once and go on from there.

    Later steps may read it several times without recomputing it, and it survives the loss of any executor.
    ``rows`` is the number of rows that its shuffles move: what one task reads then does not grow with the tables.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/stage-{uuid.uuid4().hex}"
    with shuffles_for(spark, rows):
        df.write.parquet(path)
    _STAGES.append(path)
    return spark.read.parquet(path)


def drop_stages(spark: SparkSession) -> int:
    """Remove all staged results of this driver, once the results that read them are written; their number."""
    jvm, done = spark.sparkContext._jvm, 0
    while _STAGES:
        path = jvm.org.apache.hadoop.fs.Path(_STAGES.pop())
        done += path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return done
