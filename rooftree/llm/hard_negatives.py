"""Hard negatives by slot-decomposed selection.

The upper limits of an anchor's positives cut the scores below them into disjoint slots, one slot for each distinct limit:
slot j has the scores above the next lower limit, up to limit j.  While a task goes through its rows it keeps the best
``k`` of each anchor and slot; the tasks' rests are reduced by (anchor, slot).  A window under limit j is slot j and all
slots below it, so merging the slots from the lowest to the highest, ``k`` rows kept after each step, answers the windows
of all positives, however they overlap; a window's lower limit only cuts the end of its list.

All anchors have to meet all rows.  Rows lie in blocks of a bounded size, each anchor is sent to every block, and a task
holds one block and streams the anchors through it; nothing is broadcast.  Positives take a first pass, in which an anchor
meets the rows of its own label only.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rooftree.llm.common import as_batch, staged

POSITIVES = NEGATIVES = 5
EVERY = 100
FROM_PERCENT = 80
BLOCK_BYTES = 32 << 20  # of components, as doubles
LEAST_ROWS = 4_096  # a smaller block is not worth another copy of the anchors
SCORES = 1 << 21  # scores that a task has at once
_TOP = (1 << 63) - 1


def codes(vectors: DataFrame) -> DataFrame:
    """(id, label, code, key) of the rows that take part; equal rows once."""
    whole = F.transform("embedding", lambda x: F.floor(F.lit(256.0) * x.cast("double")))
    broken = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    rows = vectors.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").where(~broken)
    return (rows.select(F.col("vec_id").cast("long").alias("id"), label.cast("long").alias("label"), whole.alias("code")).distinct()
            .withColumn("key", F.xxhash64("id", "label", "code")))


def _matrix(code: pa.Array, width: int) -> np.ndarray:
    """Codes as rows; a shorter vector is filled up with zeros, which add nothing to a product."""
    size = code.value_lengths().to_numpy(zero_copy_only=False)
    flat = code.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(size), max(width, int(size.max(initial=0)))), np.int64)
    out[np.arange(out.shape[1])[None, :] < size[:, None]] = flat
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products; beyond the range of a long the nearest long."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    if _largest(a) * _largest(b) * max(width, 1) < 1 << 53:  # doubles are exact
        return np.rint(a.astype(float) @ b.T.astype(float, copy=False)).astype(np.int64)
    return np.clip(a.astype(object) @ b.astype(np.int64).astype(object).T, -_TOP - 1, _TOP).astype(np.int64)


def _largest(x: np.ndarray) -> int:
    return max(int(x.max(initial=0)), -int(x.min(initial=0)))


class _Block:
    """One block of rows by (label, id); ``take`` collects them until the first anchor comes."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []
        self.ready = False

    def take(self, ids: np.ndarray, labels: np.ndarray, code: pa.Array) -> None:
        self.parts.append((ids, labels, code))

    def close(self) -> None:
        if self.ready:
            return
        self.ready = True
        self.ids, self.labels = (np.concatenate([np.zeros(0, np.int64), *(p[i] for p in self.parts)]) for i in (0, 1))
        code = [_matrix(p[2], 0) for p in self.parts]
        self.code = np.zeros((len(self.ids), max((c.shape[1] for c in code), default=0)), np.int64)
        at = 0
        for c in code:
            self.code[at:at + len(c), :c.shape[1]] = c
            at += len(c)
        order = np.lexsort((self.ids, self.labels))
        self.parts, self.ids, self.labels, self.code = [], self.ids[order], self.labels[order], self.code[order]
        if _largest(self.code) < 1 << 53:
            self.code = self.code.astype(float)  # once, not for every batch of anchors

    def of_label(self, label: int) -> tuple[int, int]:
        return tuple(np.searchsorted(self.labels, [label, label + 1]).tolist())


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the best ``k``: higher scores first, then smaller ids."""
    if not k:
        return np.zeros(0, np.int64)
    some = np.arange(len(scores))
    if len(scores) > 4 * k:
        some = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    return some[np.lexsort((ids[some], -scores[some]))[:k]]


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Block, pa.RecordBatch]]:
    """Rows come sorted by (block, kind): for each batch of anchors, the block whose rows came before."""
    number, block = None, _Block()
    for batch in batches:
        of, kind = (batch.column(c).to_numpy() for c in ("block", "kind"))
        cuts = np.flatnonzero((of[1:] != of[:-1]) | (kind[1:] != kind[:-1])) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            if a == b:
                continue
            if of[a] != number:
                number, block = of[a], _Block()
            part = batch.slice(a, b - a)
            if kind[a] == 0:
                block.take(part.column("id").to_numpy(), part.column("label").to_numpy(), part.column("code"))
            else:
                block.close()
                yield block, part


_FOUND = pa.schema([("anchor_id", pa.int64()), ("anchor_key", pa.int64()), ("slot", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])
_FOUND_DDL = "anchor_id long, anchor_key long, slot long, id long, score long"


def _same_label(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The best ``k`` rows of a block with the anchor's label, the anchor's own id left out."""
    for block, part in _streams(batches):
        ids, labels, keys = (part.column(c).to_numpy() for c in ("id", "label", "key"))
        code = _matrix(part.column("code"), 0)
        out = []
        for label in np.unique(labels):
            lo, hi = block.of_label(label)
            mine = np.flatnonzero(labels == label)
            step = max(1, SCORES // max(hi - lo, 1))
            for a in range(0, len(mine) if hi > lo else 0, step):
                some = mine[a:a + step]
                for i, scores in zip(some, _products(code[some], block.code[lo:hi])):
                    other = np.flatnonzero(block.ids[lo:hi] != ids[i])
                    for j in other[_best(scores[other], block.ids[lo:hi][other], k)]:
                        out.append((int(ids[i]), int(keys[i]), 0, int(block.ids[lo + j]), int(scores[j])))
        if out:
            yield as_batch(_FOUND, **dict(zip(_FOUND.names, zip(*out))))


def slot_of(scores: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """The slot of each score under descending distinct limits; -1 above the first."""
    return np.searchsorted(-limits, -scores, side="right") - 1


def _per_slot(batches: Iterator[pa.RecordBatch], k: int, percent: int) -> Iterator[pa.RecordBatch]:
    """The best ``k`` rows of other labels in a block, for each slot of each anchor."""
    for block, part in _streams(batches):
        ids, labels, keys = (part.column(c).to_numpy() for c in ("id", "label", "key"))
        code = _matrix(part.column("code"), 0)
        step, out = max(1, SCORES // max(len(block.ids), 1)), []
        limits = part.column("limits").to_pylist()
        for a in range(0, len(ids), step):
            for i, scores in enumerate(_products(code[a:a + step], block.code), a):
                limit = np.array(limits[i], np.int64)
                least = -(-percent * int(limit[-1]) // 100)  # below every window
                lo, hi = block.of_label(labels[i])
                some = np.flatnonzero((scores <= limit[0]) & (scores >= least))
                some = some[(some < lo) | (some >= hi)]
                slot = slot_of(scores[some], limit)
                for s in range(len(limit)):
                    own = some[slot == s]
                    out += [(int(ids[i]), int(keys[i]), s, int(block.ids[j]), int(scores[j])) for j in own[_best(scores[own], block.ids[own], k)]]
        if out:
            yield as_batch(_FOUND, **dict(zip(_FOUND.names, zip(*out))))


def suffix_merges(slots: list[list[tuple[int, int]]], k: int) -> list[list[tuple[int, int]]]:
    """For each slot the best ``k`` of it and all lower ones; a slot's rows (score, id) come best first."""
    below, out = [], []
    for own in reversed(slots):
        below = (own + below)[:k]
        out.append(below)
    return out[::-1]


_MINED = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("rank", pa.int32()), ("negative_id", pa.int64()),
                    ("positive_score", pa.int64()), ("negative_score", pa.int64())])


def _answer(batches: Iterator[pa.RecordBatch], k: int, percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            slots = [[] for _ in row["limits"]]
            for slot, _, score, id_ in sorted((f["slot"], -f["score"], f["score"], f["id"]) for f in row["found"]):
                slots[slot].append((score, id_))
            for slot in slots:
                slot.sort(key=lambda x: (-x[0], x[1]))
            best = suffix_merges(slots, k)
            place = {limit: i for i, limit in enumerate(row["limits"])}
            for positive in row["positives"]:
                window = [f for f in best[place[positive["score"]]] if 100 * f[0] >= percent * positive["score"]]
                out += [(row["anchor_id"], positive["id"], rank, id_, positive["score"], score) for rank, (score, id_) in enumerate(window, 1)]
        if out:
            yield as_batch(_MINED, **dict(zip(_MINED.names, zip(*out))))


def _met(rows: DataFrame, anchors: DataFrame, n_blocks: int, *more: str) -> DataFrame:
    """Each block's rows, then every anchor, in one task."""
    extra = [F.lit(None).cast(anchors.schema[c].dataType).alias(c) for c in more]
    held = rows.select(F.pmod(F.col("key"), F.lit(n_blocks)).cast("int").alias("block"), F.lit(0).alias("kind"), "id", "label", "code", "key", *extra)
    sent = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"), F.lit(1).alias("kind"), "id", "label", "code", "key", *more)
    return held.unionByName(sent).repartitionById(n_blocks, "block").sortWithinPartitions("block", "kind")


def mine(vectors: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES, percent: int = FROM_PERCENT,
         block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Rows without id, label or vector, or with a null or non-finite component, take no part; equal rows count once; different
    rows of one id are rows of their own, none of them the other's positive; a shorter vector counts as filled up with
    zeros; scores beyond the range of a long count as its nearest value; ties go to the smaller id; a positive without
    negatives in its window has no rows; an empty table gives an empty result; other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = staged(codes(vectors))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("code").cast("long")).alias("cells")).first()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_blocks = max(1, math.ceil(8 * (size["cells"] or 0) / block_bytes), min(tasks, math.ceil(size["n"] / LEAST_ROWS)))
    anchors = rows.where(F.col("id") % every == 0)
    best = Window.partitionBy("anchor_id", "anchor_key", "slot").orderBy(F.desc("score"), "id")
    near = _met(rows, anchors, n_blocks).mapInArrow(partial(_same_label, k=positives), _FOUND_DDL)
    near = near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= positives)
    limited = near.groupBy("anchor_id", "anchor_key").agg(F.collect_list(F.struct("id", "score")).alias("positives"))
    limited = limited.withColumn("limits", F.reverse(F.array_sort(F.array_distinct("positives.score"))))
    limited = staged(limited)
    asking = anchors.join(limited, (F.col("id") == F.col("anchor_id")) & (F.col("key") == F.col("anchor_key"))).select("id", "label", "code", "key", "limits")
    found = _met(rows, asking, n_blocks, "limits").mapInArrow(partial(_per_slot, k=negatives, percent=percent), _FOUND_DDL)
    found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    found = found.groupBy("anchor_id", "anchor_key").agg(F.collect_list(F.struct("slot", "score", "id")).alias("found"))
    return (limited.join(found, ["anchor_id", "anchor_key"])
            .mapInArrow(partial(_answer, k=negatives, percent=percent),
                        "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"))


SQL = """
WITH v AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL),
x AS (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM v),
bad AS (SELECT DISTINCT vec_id FROM x WHERE x IS NULL OR NOT isfinite(x)),
c AS (SELECT vec_id, label, i, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS code FROM x WHERE vec_id NOT IN (SELECT vec_id FROM bad)),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(sum(a.code * b.code) AS BIGINT) AS score
    FROM c a JOIN c b ON a.i = b.i AND a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0 GROUP BY a.vec_id, b.vec_id, a.label = b.label),
p AS (SELECT * FROM (SELECT anchor_id, id, score, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS r FROM s WHERE same) q WHERE r <= 5),
n AS (SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS r
    FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same WHERE 80 * p.score <= 100 * s.score AND s.score <= p.score)
SELECT anchor_id, positive_id, CAST(r AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE r <= 5
"""
