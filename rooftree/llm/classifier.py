"""Quality classifier: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates.

Features of a text are its words, word pairs, word shapes and pairs of shapes (a shape says which kinds of characters follow
each other), all hashed into 2 ** BITS places; a place weighs log(1 + times), and a text's weights have length one.  The
model learns from at most ``sample`` labelled rows, those with the smallest hash of their id: a documented bound that makes
training one small job.  Shards train side by side and their weights are averaged; scoring is one sparse dot product a text.
"""
from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from rooftree.llm.common import _SPACE, blocks, byte_codes, free_name, mix, prefix_hash, range_hash, utf8, words_of

BITS = 18
SAMPLE = 20_000
SHARDS = 6
BLOCK = 1 << 18  # bytes of text whose features are built at once, in about 65 times as much memory
EPOCHS = 4
FOLDS = 5
CUT = 0.3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.05, 0.1
_KIND = np.arange(256, dtype=np.uint8)
_KIND[97:123] = _KIND[128:] = ord("a")
_KIND[65:91] = ord("A")
_KIND[48:58] = ord("0")
_SHAPE = byte_codes(41)


def _pairs(hashes: np.ndarray, doc: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    both = doc[1:] == doc[:-1]
    return mix(hashes[:-1][both] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:][both] + np.uint64(seed)), doc[1:][both]


def features(text: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows of a block: (row starts, places, values)."""
    start, stop, doc, words = words_of(text, offsets)
    rows = len(offsets) - 1
    kind = _KIND[text]
    first = np.ones(len(text), bool)
    first[1:] = (kind[1:] != kind[:-1]) | _SPACE[text[:-1]]
    first[offsets[:-1][offsets[:-1] < len(text)]] = True
    seen = np.concatenate([[0], np.cumsum(first)])
    shape = mix(range_hash(prefix_hash(kind[first], _SHAPE), seen[start], seen[stop]) + np.uint64(5))
    again = (doc[1:] == doc[:-1]) & (words[1:] == words[:-1])
    parts = [(mix(words + np.uint64(1)), doc), _pairs(words, doc, 2), (mix(shape + np.uint64(3)), doc), _pairs(shape, doc, 4),
             (np.full(int(again.sum()), 99, np.uint64), doc[1:][again]), (np.full(rows, 7, np.uint64), np.arange(rows))]
    place = np.concatenate([p for p, _ in parts]) & np.uint64((1 << bits) - 1)
    row = np.concatenate([d for _, d in parts]).astype(np.uint64)
    both, times = np.unique((row << np.uint64(bits)) | place, return_counts=True)
    row, place = (both >> np.uint64(bits)).astype(np.int64), (both & np.uint64((1 << bits) - 1)).astype(np.int64)
    value = np.log1p(times)
    length = np.sqrt(np.bincount(row, value * value, rows))
    return np.searchsorted(row, np.arange(rows + 1)), place, value / length[row]


def ftrl(examples: list[tuple[np.ndarray, np.ndarray, float]], size: int, epochs: int = EPOCHS) -> np.ndarray:
    """Weights after ``epochs`` passes of per-coordinate FTRL-proximal steps."""
    z, n = np.zeros(size), np.zeros(size)

    def weights(at):
        own = z[at]
        return np.where(np.abs(own) <= L1, 0.0, -(own - np.sign(own) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    order = np.random.RandomState(5)
    for _ in range(epochs):
        for i in order.permutation(len(examples)):
            at, value, label = examples[i]
            w = weights(at)
            g = (1 / (1 + np.exp(-np.clip(w @ value, -30, 30))) - label) * value
            old = n[at]
            n[at] = old + g * g
            z[at] += g - (np.sqrt(n[at]) - np.sqrt(old)) / ALPHA * w
    return weights(np.arange(size))


def _train(batches: Iterator[pa.RecordBatch], bits: int, epochs: int) -> Iterator[pa.RecordBatch]:
    examples = []
    for block in blocks(batches, "text", BLOCK):
        text, offsets = utf8(block, "text")
        ends, place, value = features(text, offsets, bits)
        place = place.astype(np.int32)  # examples stay until the training
        for a, b, label, doc_id in zip(ends, ends[1:], block.column("quality").to_pylist(), block.column("doc_id").to_pylist()):
            examples.append((doc_id, place[a:b], value[a:b], float(label)))
    examples.sort(key=lambda e: e[0])  # the same order whatever way the rows came
    if examples:
        w = ftrl([e[1:] for e in examples], 1 << bits, epochs)
        yield pa.RecordBatch.from_pydict({"n": pa.array([len(examples)], pa.int64()), "w": pa.array([w.tobytes()], pa.binary())})


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo FOLDS; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, bits: int = BITS, shards: int = SHARDS, epochs: int = EPOCHS) -> np.ndarray:
    """Weights learnt from labelled rows outside fold 0; rows without id, label or document are left out."""
    known = labels.select("doc_id", "quality").where("doc_id IS NOT NULL AND quality IS NOT NULL").where(fold() != 0)
    known = known.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    known = known.withColumn("rank", F.xxhash64("doc_id")).orderBy("rank", "doc_id").limit(sample)  # bounds what is broadcast
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    dealt = rows.repartition(shards, F.pmod("rank", F.lit(shards))).select("doc_id", "text", "quality")
    models = dealt.mapInArrow(partial(_train, bits=bits, epochs=epochs), "n long, w binary").collect()  # a row from each shard
    total = sum(m["n"] for m in models)
    if not total:
        return np.zeros(1 << bits)
    return sum(np.frombuffer(m["w"], np.float64) * (m["n"] / total) for m in models)


def _score_of(block: pa.RecordBatch, weights: np.ndarray, bits: int) -> np.ndarray:
    text, offsets = utf8(block, "text")
    ends, place, value = features(text, offsets, bits)
    dots = np.add.reduceat(weights[place] * value, ends[:-1])  # every row has at least the constant place
    return 1 / (1 + np.exp(-np.clip(dots, -30, 30)))


def _score(batches: Iterator[pa.RecordBatch], model, bits: int, name: str) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches, "text", BLOCK):
        scores = pa.array(_score_of(block, model.value, bits))
        yield pa.RecordBatch.from_arrays([*block.columns, scores], names=[*block.schema.names, name])


def scored(docs: DataFrame, weights: np.ndarray, bits: int = BITS, name: str = "score") -> DataFrame:
    """The documents with one more column ``name``."""
    model = docs.sparkSession.sparkContext.broadcast(weights)  # 2 ** bits numbers, whatever the input
    schema = StructType([*docs.schema.fields, StructField(name, DoubleType())])
    return docs.mapInArrow(partial(_score, model=model, bits=bits, name=name), schema)


def report(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """doc_id, held_out, score and predicted of every document.

    Null and empty texts get the score of a text without words; a null id is held out; repeated rows stay; without any label
    every score is 0.5; an empty table gives an empty result; other columns are never looked at.
    """
    rows = scored(docs.select("doc_id", "text"), fit(docs, labels))
    return rows.select("doc_id", (fold() == 0).alias("held_out"), "score",
                       F.when(F.col("score") >= cut, 1).otherwise(0).alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """The documents that the classifier does not reject, all columns kept."""
    name = free_name(docs, "score")
    return scored(docs, fit(docs, labels), name=name).where(F.col(name) >= cut).drop(name)
