"""Ordered value lists per key from repeated rows (contact exports)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rooftree.operators.skew import SLICE, ordinal

_LIST = "CAST(10000000000 AS DECIMAL(11, 0))"  # above the length of any list


def ordered_values(df: DataFrame, key: str, values: str, pos: str, width: int = SLICE) -> DataFrame:
    """(key, value_no, value): the distinct values of each key, numbered from 1 by first occurrence (row position, place in the list).

    One row a value and no list a key, so a key with very many values is numbered slice by slice of ``width`` positions.
    """
    usable = F.col(key).isNotNull() & (F.size(values) > 0)
    items = df.where(usable).select(key, F.col(pos).cast("bigint").alias("__pos"), F.posexplode(values).alias("__i", "value"))
    at = F.min(F.expr(f"CAST(CAST(__pos AS DECIMAL(19, 0)) * {_LIST} + __i AS DECIMAL(38, 0))"))  # one number: a hash aggregate
    first = items.groupBy(key, "value").agg(at.alias("__at"))
    slice_ = F.expr(f"CAST(floor(__at / ({_LIST} * {int(width)})) AS BIGINT)")
    numbered = ordinal(first, [key], [F.col("__at").asc(), F.col("value").asc()], slice_, "value_no")
    return numbered.select(key, "value_no", "value")


def merge_values_by_key(df: DataFrame, key: str, values: str, pos: str) -> tuple[DataFrame, DataFrame]:
    """(merged, stats): distinct values per key in order of first occurrence, and row counters.

    Values are reduced to one row per (key, value) before anything is collected, so a key repeated in a third
    of the input costs only its distinct values.  A key is in conflict when its rows carry different value sets.
    Where a key may have very many distinct values, use ``ordered_values``: it makes no list of them.
    """
    usable = F.col(key).isNotNull() & (F.size(values) > 0)
    rows = df.where(usable).select(key, pos, F.col(values).alias("vals"),
                                   F.sha2(F.to_json(F.struct(F.array_sort(values).alias("v"))), 256).alias("set_id"))
    items = rows.select(key, F.posexplode("vals").alias("i", "value"), pos)
    first = items.groupBy(key, "value").agg(F.min(F.struct(F.col(pos), F.col("i"))).alias("at"))
    merged = first.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("__v"))
    sets = rows.groupBy(key).agg(F.min("set_id").alias("lo"), F.max("set_id").alias("hi"), F.count(F.lit(1)).alias("rows"))
    merged = merged.join(sets, key).select(key, F.transform("__v", lambda s: s["value"]).alias("merged"), "rows",
                                           (F.col("lo") != F.col("hi")).alias("conflict"))
    totals = df.agg(F.count(F.lit(1)).alias("source_rows"), F.count_if(F.col(key).isNull()).alias("invalid_key_rows"),
                    F.count_if(F.col(key).isNotNull() & ~F.coalesce(F.size(values) > 0, F.lit(False))).alias("invalid_value_rows"))
    per_key = merged.agg(F.count(F.lit(1)).alias("k"), F.count_if("conflict").alias("c"))
    stats = totals.withColumns({"unique_keys": per_key.select("k").scalar(), "conflicting_keys": per_key.select("c").scalar()})
    return merged, stats.withColumn("duplicate_rows", F.col("source_rows") - F.col("unique_keys")
                                    - F.col("invalid_key_rows") - F.col("invalid_value_rows"))
