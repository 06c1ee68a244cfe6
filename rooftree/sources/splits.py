"""Files whose records cross lines and splits, read by many tasks at once: quoted grids and JSON arrays.

A task that starts in the middle of a file cannot know whether it is inside a cell, a string or an element.  So every
split is read twice.  The first pass says what a split does to the reader's state, for each state it could start in: how
many quotes it has, how deep it goes, how many records end in it.  Prefix sums over the splits of a file (a row for each
split) give every split its true start.  The second pass cuts records; only the pieces of records that cross a split are
shuffled and put together.  Spark's text reader makes the splits, so any store that Spark reads will do.
"""
from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rooftree.session import staged

_ESCAPED = re.compile(r"\\.", re.S)
_RECORDS = pa.schema([("file", pa.string()), ("record", pa.int64()), ("block", pa.int64()), ("whole", pa.bool_()), ("text", pa.string())])
_RECORDS_DDL = "file string, record long, block long, whole boolean, text string"


def _fragments(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """Text between separators, in file order within a split, with the file and the split's first byte."""
    rows = spark.read.option("lineSep", sep).text(path)
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """Slices of one split each; a task may go through several splits."""
    for batch in batches:
        if not batch.num_rows:
            continue
        block, file = batch.column("block").to_numpy(), batch.column("file")
        change = np.flatnonzero(pc.or_(pc.not_equal(batch.column("block")[1:], batch.column("block")[:-1]),
                                       pc.not_equal(file[1:], file[:-1])).to_numpy(zero_copy_only=False)) + 1
        for a, b in zip([0, *change.tolist()], [*change.tolist(), batch.num_rows]):
            yield (file[a].as_py(), int(block[a])), batch.slice(a, b - a)


class _Cutter:
    """Collects fragments and hands out records; the first and the last piece of a split may be parts of a record."""

    def __init__(self, sep: str) -> None:
        self.sep, self.split, self.out = sep, None, []

    def start(self, split: tuple[str, int], record: int, inside: bool) -> None:
        self.finish()
        self.split, self.record, self.open, self.part = split, record, [], inside

    def add(self, text: str, ends: bool) -> None:
        self.open.append(text)
        if ends:
            self.out.append((self.split[0], self.record, self.split[1], not self.part, self.sep.join(self.open) + self.sep))
            self.record, self.open, self.part = self.record + 1, [], False

    def finish(self) -> None:
        if self.split is not None and self.open:
            self.out.append((self.split[0], self.record, self.split[1], False, self.sep.join(self.open) + self.sep))
        self.split = None

    def rows(self, least: int = 1) -> Iterator[pa.RecordBatch]:
        if len(self.out) >= least:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*self.out), _RECORDS)], schema=_RECORDS)
            self.out = []


def _joined(cut: DataFrame) -> DataFrame:
    """(file, record, text): pieces of a record that crosses splits in the order of the splits."""
    parts = cut.where("NOT whole").groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("block", "text"))).alias("parts"))
    parts = parts.select("file", "record", F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"))
    return cut.where("whole").select("file", "record", "text").unionByName(parts)


def _before(value: str):
    along = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(along), F.lit(0))


# --- grids -----------------------------------------------------------------------------------------------------------------------

_QUOTES = pa.schema([("file", pa.string()), ("block", pa.int64()), ("quotes", pa.int64()), ("ends_even", pa.int64()), ("ends_odd", pa.int64())])


def _line_parity(lines: pa.Array, parity: int) -> np.ndarray:
    """Parity of the quotes up to the end of each line."""
    return (np.cumsum(pc.count_substring(lines, '"').to_numpy(zero_copy_only=False)) + parity) & 1


def _count_quotes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[tuple[str, int], list[int]] = {}
    for split, part in _by_split(batches):
        have = totals.setdefault(split, [0, 0, 0])
        parity = _line_parity(part.column("value"), have[0] & 1)
        have[1] += int((parity == 0).sum())
        have[2] += int(parity.sum())
        have[0] = int(parity[-1])
    if totals:
        columns = zip(*((*split, *have) for split, have in totals.items()))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _QUOTES)], schema=_QUOTES)


def _cut_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cutter, parity = _Cutter("\n"), 0
    for split, part in _by_split(batches):
        if split != cutter.split:
            parity = part.column("odd")[0].as_py()
            cutter.start(split, part.column("first")[0].as_py(), bool(parity))
        ends = _line_parity(part.column("value"), parity)
        for text, odd in zip(part.column("value").to_pylist(), ends.tolist()):
            cutter.add(text, not odd)
        parity = int(ends[-1])
        yield from cutter.rows(4_096)
    cutter.finish()
    yield from cutter.rows()


def grid_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, record, text, ahead) of the lines of a grid, record 0 being a file's header; a quoted cell may have line breaks.

    Quotes inside a quoted cell are doubled, as spreadsheets write them.  ``ahead`` is the number of records, without headers,
    in the files whose names come before.
    """
    lines = _fragments(spark, path, "\n")
    counted = lines.mapInArrow(_count_quotes, "file string, block long, quotes long, ends_even long, ends_odd long")
    starts = counted.withColumn("odd", _before("quotes") % 2)
    starts = starts.withColumn("ends", F.when(F.col("odd") == 0, F.col("ends_even")).otherwise(F.col("ends_odd")))
    starts = starts.select("file", "block", "ends", F.col("odd").cast("int").alias("odd"), _before("ends").alias("first"))
    earlier = F.coalesce(F.sum("ends").over(Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    headers = F.dense_rank().over(Window.orderBy("file")) - 1
    starts = staged(starts.withColumn("ahead", earlier - F.col("first") - headers).drop("ends"))  # a row of 100 bytes for each split
    placed = lines.join(F.broadcast(starts.drop("ahead")), ["file", "block"])  # keeps the rows in order
    cut = _joined(placed.mapInArrow(_cut_lines, _RECORDS_DDL))
    return cut.join(F.broadcast(starts.select("file", "ahead").distinct()), "file")


# --- JSON arrays -----------------------------------------------------------------------------------------------------------------

_DEPTHS_DDL = "file string, block long, quotes long, deeper array<long>, closings array<array<struct<level: long, n: long>>>"
_LEVEL = pa.list_(pa.struct([("level", pa.int64()), ("n", pa.int64())]))
_DEPTHS = pa.schema([("file", pa.string()), ("block", pa.int64()), ("quotes", pa.int64()), ("deeper", pa.list_(pa.int64())), ("closings", pa.list_(_LEVEL))])


def _outside(text: str) -> tuple[list[int], int]:
    """Change of depth outside of strings, when the text starts outside and when it starts inside of one; and its quotes."""
    parts = _ESCAPED.sub("", text).split('"')
    change = [0, 0]
    for i, part in enumerate(parts):
        change[i & 1] += part.count("{") + part.count("[") - part.count("]")
    return change, len(parts) - 1


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[tuple[str, int], tuple[list[int], list[int], list[Counter]]] = {}
    for split, part in _by_split(batches):
        state, depth, closings = totals.setdefault(split, ([0], [0, 0], [Counter(), Counter()]))
        for text in part.column("value").to_pylist():
            change, quotes = _outside(text)
            now = state[0]
            state[0] = (now + quotes) & 1
            for start in (0, 1):  # the state that the split starts in
                depth[start] += change[now ^ start]
                if not state[0] ^ start:  # the brace behind the fragment is no part of a string
                    depth[start] -= 1
                    closings[start][depth[start]] += 1
    if totals:
        rows = [(*split, state[0], depth, [[{"level": k, "n": n} for k, n in c.items()] for c in closings]) for split, (state, depth, closings) in totals.items()]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _DEPTHS)], schema=_DEPTHS)


def _cut_elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cutter, odd, depth = _Cutter("}"), 0, 0
    for split, part in _by_split(batches):
        if split != cutter.split:
            odd, depth = part.column("odd")[0].as_py(), part.column("depth")[0].as_py()
            cutter.start(split, part.column("first")[0].as_py(), split[1] > 0)
        for text in part.column("value").to_pylist():
            change, quotes = _outside(text)
            depth += change[odd]
            odd = (odd + quotes) & 1
            depth -= not odd
            cutter.add(text, not odd and depth == 1)
        yield from cutter.rows(4_096)
    cutter.finish()
    yield from cutter.rows()


def array_elements(spark: SparkSession, path: str) -> DataFrame:
    """(file, record, text) of the objects in files that hold one JSON array each; other top-level elements are left out."""
    braces = _fragments(spark, path, "}")
    measured = braces.mapInArrow(_measure, _DEPTHS_DDL).withColumn("odd", (_before("quotes") % 2).cast("int"))
    starts = measured.withColumn("change", F.expr("deeper[odd]")).withColumn("depth", _before("change"))
    starts = starts.withColumn("ends", F.expr("aggregate(closings[odd], 0L, (a, c) -> a + IF(c.level = 1 - depth, c.n, 0L))"))
    starts = starts.select("file", "block", "odd", "depth", _before("ends").alias("first"))
    placed = braces.join(F.broadcast(starts), ["file", "block"])  # a row of 100 bytes for each split; keeps the rows in order
    found = _joined(placed.mapInArrow(_cut_elements, _RECORDS_DDL))
    return found.withColumn("text", F.expr(r"regexp_replace(text, '^[\\s,\\[]+', '')")).where(F.col("text").startswith("{"))


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Typed rows of JSON-array files, each file read by as many tasks as it has splits."""
    return array_elements(spark, path).select(F.from_json("text", schema).alias("item")).select("item.*")


def read_numbered_grid(spark: SparkSession, path: str, columns: list[str], row_number: str = "sheet_row", one_sheet: bool = False) -> DataFrame:
    """Cells as text, and each row's 1-based number in its sheet (the header is row 1); blank lines count, but give no row.

    Each file is a sheet; with ``one_sheet`` a folder's files are one, in the order of their names, with a header each.
    """
    schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in columns)
    text = F.regexp_replace("text", r"\r?\n$", "")
    rows = grid_records(spark, path).where("record > 0").where(F.trim(text) != "")
    cells: Callable = F.from_csv(text, schema, {"escape": '"', "quote": '"', "multiLine": "true", "maxCharsPerColumn": "-1"})
    return rows.select(((F.col("ahead") if one_sheet else F.lit(0)) + F.col("record") + 1).alias(row_number), cells.alias("row")).select(row_number, "row.*")
