"""Grouping primitives that stay spread out when one key holds a large share of the rows.

A plain ``Window.partitionBy(key)`` puts a whole key into one task.  The functions here give the same results from
map-side-combined aggregates, plain joins that the engine may split at run time, and slices of bounded size:

* ``attach_lookup`` / ``attach_group`` - per-key values back onto every row, by a left join.
* ``ordinal`` - exact ``row_number`` per group from fixed-width slices plus slice offsets, themselves summed up slice-wise.
* ``islands`` - gaps-and-islands in slices, then merges of the islands that touch an edge over coarser and coarser slices.
* ``first_run`` - the row at which the first run of ``k`` flagged rows is complete, from one summary per slice.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SALTS = 64
SLICE = 65_536
FAN = 4_096  # slices whose offsets are summed up together
COARSER = 1 << 16  # slices that make one of the next level
FARTHEST = 1 << 62  # positions lie within plus and minus this
ROW_IDS = ("id", "event_id", "job_id", "page_id", "doc_id", "pos")

_SPREADABLE = (T.NumericType, T.DatetimeType, T.BooleanType)


def null_safe(left: DataFrame, right: DataFrame, pairs) -> Column:
    return reduce(lambda a, b: a & b, [left[x].eqNullSafe(right[y]) for x, y in pairs])


def _spread(df: DataFrame, skip) -> Column:
    """Deterministic row hash over cheap columns (a retried task must route rows the same way)."""
    free = [f for f in df.schema.fields if f.name not in skip]
    ids = [f.name for f in free if f.name in ROW_IDS]
    if ids:
        return F.xxhash64(*ids)  # one id column is enough and keeps the scan narrow
    cols = [f.name for f in free if isinstance(f.dataType, _SPREADABLE)]
    cols = cols or [f.name for f in free if isinstance(f.dataType, T.StringType)] or list(skip)
    return F.xxhash64(*cols)


def attach_lookup(df: DataFrame, dim: DataFrame, on, eligible: Column | None = None) -> DataFrame:
    """Left join ``df`` with ``dim`` (one row per key, NULL being a key); rows that are not ``eligible`` match nothing.

    The key's hash is a second join column: both sides then get a shuffle of their own, even if ``dim`` is an aggregate by the
    same key, and the engine can split the partition of a hot key.
    """
    on = [on] if isinstance(on, str) else list(on)
    values = [c for c in dim.columns if c not in on]
    right = dim.select(*[F.col(c).alias(f"__d_{c}") for c in on], F.xxhash64(*on).alias("__d_hash"), *[F.col(v).alias(f"__v_{v}") for v in values])
    left = df.withColumn("__hash", F.xxhash64(*on))
    match = null_safe(left, right, [(c, f"__d_{c}") for c in on]) & (left["__hash"] == right["__d_hash"])
    out = left.join(right, match if eligible is None else match & eligible, "left")
    return out.select(*df.columns, *[F.col(f"__v_{v}").alias(v) for v in values])


def attach_group(df: DataFrame, keys: dict[str, Column] | list[str], aggs: dict[str, Column]) -> DataFrame:
    """Add per-group aggregates to every row of ``df`` (a skew-safe ``agg(...).over(partition)``)."""
    keys = keys if isinstance(keys, dict) else {k: F.col(k) for k in keys}
    temp = {f"__k{i}": expr for i, expr in enumerate(keys.values())}
    keyed = df.withColumns(temp)
    stats = keyed.groupBy(*temp).agg(*[c.alias(n) for n, c in aggs.items()])
    return attach_lookup(keyed, stats, list(temp)).select(*df.columns, *aggs)


def _offsets(counts: DataFrame, by: list[str], fan: int = FAN) -> DataFrame:
    """``counts`` (by, __slice, __cnt) with ``__offset``, the sum of all slices before: first among ``fan`` slices, then among those."""
    before = lambda keys, order: F.coalesce(F.sum("__cnt").over(Window.partitionBy(*keys).orderBy(F.col(order).asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    near = counts.withColumn("__part", F.floor(F.col("__slice") / F.lit(fan)))
    near = near.withColumn("__near", before([*by, "__part"], "__slice"))
    parts = near.groupBy(*by, "__part").agg(F.sum("__cnt").alias("__cnt")).withColumn("__far", before(by, "__part"))
    far = parts.select(*[F.col(c).alias(f"__f_{c}") for c in (*by, "__part")], "__far")
    out = near.join(far, null_safe(near, far, [(c, f"__f_{c}") for c in (*by, "__part")]))
    return out.select(*by, "__slice", "__cnt", (F.col("__near") + F.col("__far")).alias("__offset"))


def ordinal(df: DataFrame, by: list[str], order: list[Column], slice_by: Column, name: str = "rn") -> DataFrame:
    """Exact ``row_number`` per ``by`` group; ``slice_by`` is a number and non-decreasing along ``order``."""
    sliced = df.withColumn("__slice", slice_by)
    keys = [*by, "__slice"]
    counts = sliced.groupBy(*keys).agg(F.count(F.lit(1)).alias("__cnt"))
    offsets = _offsets(counts, by).select(*[F.col(k).alias(f"__o_{k}") for k in keys], "__offset")
    local = sliced.withColumn("__local", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    out = local.join(offsets, null_safe(local, offsets, [(k, f"__o_{k}") for k in keys]))
    return out.select(*df.columns, (F.col("__local") + F.col("__offset")).cast("bigint").alias(name))


def _slice_start(pos: str, width: int) -> Column:
    """First position of the slice; the last level has three slices, and no edge within the positions' range."""
    if width >= FARTHEST:
        return F.when(F.col(pos) >= F.lit(FARTHEST), 1).when(F.col(pos) < F.lit(-FARTHEST), -1).otherwise(0)
    return F.col(pos) - F.pmod(F.col(pos), F.lit(width))


def islands(df: DataFrame, pos: str, by: list[str] | None = None, width: int = SLICE) -> DataFrame:
    """Collapse consecutive integer positions into ``range_start``/``range_end`` per group.

    Ranges are whole unless they touch an edge of their slice; those that do are merged in slices ``COARSER`` times as wide,
    and so on.  A slice has two such ranges for each finer slice at most, so no task gets more than ``2 * COARSER`` of them.
    """
    by = by or []
    points = df.select(*by, F.col(pos).cast("bigint").alias("__p")).where("__p IS NOT NULL").distinct().withColumn("__slice", _slice_start("__p", width))
    order = Window.partitionBy(*by, "__slice").orderBy("__p")
    ranges = (points.withColumn("__run", F.col("__p") - F.row_number().over(order))
              .groupBy(*by, "__slice", "__run").agg(F.min("__p").alias("range_start"), F.max("__p").alias("range_end")))
    ranges, whole = ranges.select(*by, "range_start", "range_end"), None
    while width < FARTHEST:
        edge = (F.pmod("range_start", F.lit(width)) == 0) | (F.pmod("range_end", F.lit(width)) == width - 1)
        done = ranges.where(~edge)
        whole = done if whole is None else whole.unionByName(done)
        width *= COARSER
        along = Window.partitionBy(*by, "__slice").orderBy("range_start")
        breaks = F.when(F.lag("range_end").over(along) == F.col("range_start") - 1, 0).otherwise(1)
        ranges = (ranges.where(edge).withColumn("__slice", _slice_start("range_start", width)).withColumn("__b", breaks)
                  .withColumn("__g", F.sum("__b").over(along.rowsBetween(Window.unboundedPreceding, 0)))
                  .groupBy(*by, "__slice", "__g").agg(F.min("range_start").alias("range_start"), F.max("range_end").alias("range_end"))
                  .select(*by, "range_start", "range_end"))
    return ranges if whole is None else whole.unionByName(ranges)


def first_run(df: DataFrame, by: list[str], code: Column, flag: Column, k: int, slice_by: Column, value: Column | None = None) -> DataFrame:
    """(by, run_code, run_value): the row that completes the first run of ``k`` flagged rows of a group, along ``code``.

    ``code`` is a distinct number for each row of a group and ``slice_by`` is non-decreasing along it.  Rows are shuffled once,
    by slice; a slice comes down to its number of rows, the flagged rows at its start and at its end, the first run inside
    it, and the ``k - 1`` rows that could complete a run begun before.  The slices of a group are then put together in order.
    """
    value = F.lit(None).cast("int") if value is None else value
    rows = df.select(*by, code.alias("__code"), F.coalesce(flag, F.lit(False)).alias("__flag"), value.alias("__value"), slice_by.alias("__slice"))
    along = Window.partitionBy(*by, "__slice").orderBy("__code")
    rows = rows.withColumn("__n", F.row_number().over(along))
    rows = rows.withColumn("__gap", F.coalesce(F.max(F.when(~F.col("__flag"), F.col("__n"))).over(along.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)))
    inside = F.col("__flag") & (F.col("__n") - F.col("__gap") == k)
    picks = {"own": inside, **{f"at_{i}": F.col("__flag") & (F.col("__gap") == 0) & (F.col("__n") == i) for i in range(1, k)}}
    pair = lambda name, when: (F.min(F.when(when, F.col("__code"))).alias(name), F.min_by(F.when(when, F.col("__value")), F.when(when, F.col("__code"))).alias(f"{name}_v"))
    last_gap = F.max(F.when(~F.col("__flag"), F.col("__n")))
    parts = rows.groupBy(*by, "__slice").agg(F.count(F.lit(1)).alias("n"), F.coalesce(last_gap, F.lit(0)).alias("gap"), *[c for name, when in picks.items() for c in pair(name, when)])
    # rows of the run that a slice goes on with: the rows since the newest slice with a gap, and the run at that slice's end
    group = Window.partitionBy(*by).orderBy(F.col("__slice").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("total", F.coalesce(F.sum("n").over(group), F.lit(0)))
    since = F.last(F.when(F.col("gap") > 0, F.col("total") + F.col("gap")), ignorenulls=True).over(group)
    parts = parts.withColumn("carried", F.col("total") - F.coalesce(since, F.lit(0)))
    code_, val = F.col("own"), F.col("own_v")
    for i in range(1, k):
        done = (F.col("carried") == k - i) & F.col(f"at_{i}").isNotNull()
        code_, val = F.when(done, F.col(f"at_{i}")).otherwise(code_), F.when(done, F.col(f"at_{i}_v")).otherwise(val)
    found = parts.select(*by, code_.alias("__code"), val.alias("__value")).where(F.col("__code").isNotNull())
    return found.groupBy(*by).agg(F.min("__code").alias("run_code"), F.min_by("__value", "__code").alias("run_value"))


PRE_LIMIT = 1_000  # the engine limits every map task by itself up to this rank


def per_group_top(df: DataFrame, by: list[str], order: list[Column], k: int, name: str = "group_rank", salts: int = SALTS) -> DataFrame:
    """First ``k`` rows per group; hot groups stay spread for every ``k``.

    Up to ``PRE_LIMIT`` the engine cuts each map task's rows; above it, the first ``k`` of each (group, salt) are taken before
    the first ``k`` of the group.
    """
    rank = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    if k > PRE_LIMIT:
        salted = df.withColumn("__salt", F.pmod(_spread(df, by), F.lit(salts)))
        df = salted.withColumn("__first", rank(*by, "__salt")).where(F.col("__first") <= k).drop("__first", "__salt")
    return df.withColumn(name, rank(*by)).where(F.col(name) <= k)


_STEP = "CAST(10000000000000000000 AS DECIMAL(20, 0))"  # above every 64-bit id


def micros_of(df: DataFrame, column: str) -> str:
    """SQL text for the microseconds of a time column; wall-clock columns do not depend on the session time zone."""
    kind = df.schema[column].dataType.simpleString()
    return f"timestampdiff(MICROSECOND, CAST(TIMESTAMP '1970-01-01 00:00:00' AS {kind}), {column})"


def age_code(df: DataFrame, updated: str = "updated_at", key: str = "id") -> Column:
    """(time, id) as one exact decimal, NULL times lowest: its maximum is a plain hash aggregate.

    A maximum over a struct would force a sort of every map task's rows before the partial aggregate.
    """
    time = f"COALESCE({micros_of(df, updated)}, -999999999999999999)"
    return F.expr(f"CAST(CAST({time} AS DECIMAL(18, 0)) * {_STEP} + CAST({key} AS DECIMAL(19, 0)) AS DECIMAL(38, 0))")


def code_id(code: str) -> Column:
    """Id part of an age code."""
    return F.pmod(F.col(code), F.expr(_STEP)).cast("bigint")


def code_time(code: str, kind) -> Column:
    """Time part of an age code, as a column of ``kind``."""
    micros = F.expr(f"CAST(({code} - pmod({code}, {_STEP})) / {_STEP} AS BIGINT)")
    return F.timestamp_micros(micros).cast(kind)
