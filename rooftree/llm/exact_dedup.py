"""Exact duplicates through an extendible-hash index in the shared folder, with DataFrame functions only.

The key of a text is a 64-bit hash of its normalised form.  The directory starts as one bucket; an overfull bucket splits
by one more leading bit of its keys, which doubles the directory where the split bucket was as deep as the directory
(``directory`` takes all these doublings at once from one histogram of leading bits).  A bucket that is still overfull at
the greatest depth holds repeats of few keys; equal texts are combined before they travel, so it gets one row for each
task and text.  Owner tasks take ranges of buckets and write them to the shared folder; texts with one key but different
bytes follow each other as a chain of entries, told apart by comparing the bytes.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rooftree.llm.common import free_name, staged

BUCKET_ROWS = 4_096
MAX_DEPTH = 16  # at most 65,536 slots
_STEP = "CAST(100000000000000000000 AS DECIMAL(21, 0))"  # above the range of ids
_TOP = "CAST(9223372036854775807 AS DECIMAL(20, 0))"


def normalised(text: str = "text") -> Column:
    return F.translate(F.coalesce(F.col(text), F.lit("")), " \t\n\x0b\x0c\r", "")


def _slot(key: str, depth: int) -> Column:
    return F.shiftrightunsigned(F.col(key), 64 - depth) if depth else F.lit(0).cast("long")


def directory(keys: DataFrame, rows: int, bucket_rows: int = BUCKET_ROWS) -> tuple[DataFrame, int]:
    """(slot, depth, bucket) for each used slot, and the directory's depth; ``bucket`` is the slot's first slot."""
    depth = min(MAX_DEPTH, max(1, math.ceil(math.log2(max(2, rows / bucket_rows))) + 3))
    used = keys.groupBy(_slot("key", depth).alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    used = staged(used)
    levels = used.select("slot", "n", F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("depth"))
    levels = levels.withColumn("head", F.expr(f"shiftright(slot, {depth} - depth)"))
    filled = levels.groupBy("depth", "head").agg(F.sum("n").alias("filled"))
    fitting = levels.join(filled, ["depth", "head"]).where((F.col("filled") <= bucket_rows) | (F.col("depth") == depth))
    local = fitting.groupBy("slot").agg(F.min("depth").alias("depth"))
    return staged(local.withColumn("bucket", F.expr(f"shiftleft(shiftright(slot, {depth} - depth), {depth} - depth)"))), depth


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("__norm", normalised()).withColumn("key", F.xxhash64("__norm"))


def index(docs: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Entries (bucket, key, text_sha256, group_size, keep_id, keep_chars), written to the shared folder by owner tasks."""
    docs = docs.select("doc_id", "text")
    keyed = _keyed(docs)
    slots, depth = directory(keyed.select("key"), docs.count(), bucket_rows)
    code = f"CAST(CAST(char_length(coalesce(text, '')) AS DECIMAL(10, 0)) * {_STEP} + ({_TOP} - coalesce(doc_id, 9223372036854775807)) AS DECIMAL(38, 0))"
    placed = keyed.withColumn("slot", _slot("key", depth)).join(F.broadcast(slots.drop("depth")), "slot")
    # grouping by the text itself compares bytes; the best row is the maximum of one number, so this stays a hash aggregate
    groups = placed.groupBy("bucket", "key", "__norm").agg(F.count(F.lit(1)).alias("group_size"), F.max(F.expr(code)).alias("best"))
    best = F.expr(f"CAST({_TOP} - pmod(best, {_STEP}) AS BIGINT)")
    entries = groups.select("bucket", "key", F.sha2(F.col("__norm").cast("binary"), 256).alias("text_sha256"), "group_size",
                            F.nullif(best, F.lit((1 << 63) - 1)).alias("keep_id"))
    return staged(entries.repartitionByRange("bucket", "key"))


def report(docs: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Null text is empty, and all empty texts are equal.  Of equal texts the longest original stays, then the smallest id (a
    null id comes last); rows that repeat the id of the row that stays are kept, too.  An empty table gives an empty result;
    other columns are ignored.
    """
    found = index(docs, bucket_rows).select("key", "text_sha256", "group_size", "keep_id")
    rows = _keyed(docs.select("doc_id", "text")).select("doc_id", "key", F.sha2(F.col("__norm").cast("binary"), 256).alias("text_sha256"))
    return (rows.join(found, ["key", "text_sha256"])
            .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"))


def keep_one(docs: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The documents that stay, all columns kept; of repeated rows (one id and text) one stays."""
    key, sha = free_name(docs, "key"), free_name(docs, "sha")
    id_ = F.coalesce("doc_id", F.lit(-(1 << 63)))
    stays = report(docs, bucket_rows).where("kept").select(id_.alias(key), F.col("text_sha256").alias(sha))
    rows = docs.withColumns({key: id_, sha: F.sha2(normalised().cast("binary"), 256)})
    return rows.join(stays, [key, sha], "left_semi").dropDuplicates([key, sha]).select(*docs.columns)


SQL = r"""
WITH d AS (SELECT doc_id, length(coalesce("text", '')) AS n, regexp_replace(coalesce("text", ''), '[\x20\x09-\x0D]', '', 'g') AS t FROM documents),
g AS (SELECT *, first_value(doc_id) OVER (PARTITION BY t ORDER BY n DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM g
"""
