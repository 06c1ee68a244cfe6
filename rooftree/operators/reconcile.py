"""Reconcile an expected set of rows with a downstream copy: ids, cells and samples."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rooftree.functions.text import cell_equal, is_blank
from rooftree.operators.skew import attach_lookup, per_group_top


def reconcile(expected: DataFrame, actual: DataFrame, key: str, pos: str) -> DataFrame:
    """(key, pos, action) with action keep / append / stale / duplicate / orphan.

    Rows without an id never reach a join or a key group, so a copy full of blank ids costs one scan.
    """
    cells = [c for c in actual.columns if c not in (key, pos)]
    anything = ~is_blank(F.concat_ws("", *[F.col(c).cast("string") for c in cells])) if cells else F.lit(True)
    named = actual.where(~is_blank(key)).select(F.trim(F.col(key).cast("string")).alias(key), pos)
    orphan = actual.where(is_blank(key) & anything).select(F.lit(None).cast("string").alias(key), pos,
                                                           F.lit("orphan").alias("action"))
    firsts = named.groupBy(key).agg(F.min(pos).alias("__first"))
    want = expected.select(F.trim(F.col(key).cast("string")).alias(key)).distinct().withColumn("__want", F.lit(1))
    marked = attach_lookup(named, firsts.join(want, key, "left"), key)
    action = F.when(F.col(pos) > F.col("__first"), "duplicate").when(F.col("__want").isNull(), "stale").otherwise("keep")
    absent = want.join(firsts, key, "left_anti").select(key, F.lit(None).cast(actual.schema[pos].dataType).alias(pos), F.lit("append").alias("action"))
    return marked.select(key, pos, action.alias("action")).unionByName(absent).unionByName(orphan)


def _pairs(expected: DataFrame, actual: DataFrame, key: str, how: str) -> DataFrame:
    cells = [c for c in expected.columns if c != key]
    left = expected.select(F.col(key).alias("k"), F.struct(*[F.col(f"`{c}`") for c in cells]).alias("e"))
    right = actual.select(F.col(key).alias("k"), F.struct(*[F.col(f"`{c}`") for c in cells if c in actual.columns]).alias("a"))
    return left.join(right, "k", how)


def diff_rows(expected: DataFrame, actual: DataFrame, key: str, ignore=()) -> DataFrame:
    """Per expected row: insert, update or unchanged, with number-tolerant cells and ignored columns."""
    watch = [c for c in expected.columns if c != key and c not in ignore]
    same = reduce(lambda a, b: a & b, [cell_equal(F.col("e")[c], F.col("a")[c]) for c in watch], F.lit(True))
    action = F.when(F.col("a").isNull(), "insert").when(same, "unchanged").otherwise("update")
    return _pairs(expected, actual, key, "left").select(F.col("k").alias(key), action.alias("action"))


def mismatch_rows(expected: DataFrame, actual: DataFrame, key: str, ignore=()) -> DataFrame:
    """(kind, field, k): every id with a different cell, one row for each such field, and every missing or stale id."""
    watch = [c for c in expected.columns if c != key and c not in ignore]
    both = _pairs(expected, actual, key, "full_outer")
    found, want = F.col("a").isNotNull(), F.col("e").isNotNull()
    cell = lambda c: F.when(found & want & ~cell_equal(F.col("e")[c], F.col("a")[c]),
                            F.struct(F.lit("mismatch").alias("kind"), F.lit(c).alias("field")))
    absent = F.when(want & ~found, F.struct(F.lit("missing").alias("kind"), F.lit("").alias("field")))
    stale = F.when(found & ~want, F.struct(F.lit("stale").alias("kind"), F.lit("").alias("field")))
    issues = F.filter(F.array(*[cell(c) for c in watch], absent, stale), lambda s: s.isNotNull())
    return both.select("k", F.explode(issues).alias("i")).select("i.kind", "i.field", F.col("k").cast("string").alias("k"))


def mismatch_report(rows: DataFrame, k: int = 10, samples: int = 100) -> DataFrame:
    """(kind, field, n, sample) of ``mismatch_rows``: whole counts, and the smallest ids as a sample; the rows have all ids.

    Sample ids come from a pre-limited rank per field, so a field that differs everywhere is never collected.  Rows that are
    staged first are found once and not twice.
    """
    counts = rows.groupBy("kind", "field").agg(F.count(F.lit(1)).alias("n"))
    top = per_group_top(rows, ["kind", "field"], [F.col("k").asc()], max(k, samples), "r")
    top = top.where((F.col("kind") != "mismatch") | (F.col("r") <= k))
    picks = top.groupBy("kind", "field").agg(F.array_sort(F.collect_list("k")).alias("sample"))
    return counts.join(picks, ["kind", "field"], "left")
