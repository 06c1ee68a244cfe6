"""Near duplicates by SimHash: fingerprints split into blocks, joined on blocks, verified by Hamming distance.

A fingerprint of 64 bits is cut into ``BLOCKS`` blocks.  Two fingerprints that differ in ``DISTANCE`` bits at most agree on
``BLOCKS - DISTANCE`` whole blocks at least, so every choice of that many blocks is a key and close pairs share one of the
keys.  A bucket with more than ``BUCKET`` fingerprints is never gathered: its members get finer keys, one for each of
``DISTANCE + 1`` parts of the bits that the bucket leaves open (a close pair agrees on one of those parts, too).  A bucket
with 8 open bits has 256 fingerprints at most, so this ends, and nothing is capped.  Equal fingerprints are one class from
the start.  A bucket's links come out as a spanning forest, not as pairs; large-star and small-star rounds join the rest.
"""
from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rooftree.llm.common import as_batch, blocks, staged
from rooftree.llm.minhash import NO_ID, components

SHINGLE = 3
DISTANCE = 3
BLOCKS = 5
BUCKET = 256
OPEN = 8  # with so few open bits a bucket has 2 ** OPEN fingerprints at most and is not split
SEED = 42
_PIECE = 1 << 15  # shingles that are hashed at once
_ALL = (1 << 64) - 1


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    """The bits that are set in over half of the hashes of the text's shingles; 0 for a text without words."""
    words = text.lower().split()  # on bytes both touch ASCII only
    if not words:
        return 0
    body = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    stop = np.cumsum(size + 1) - 1
    start = (stop - size)[:max(1, len(words) - width + 1)]
    stop = stop[min(width, len(words)) - 1:]
    digest, ones = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for i in range(0, len(start), _PIECE):
        hashes = b"".join([digest(body[a:b], SEED) for a, b in zip(start[i:i + _PIECE].tolist(), stop[i:i + _PIECE].tolist())])
        ones += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(start)).tobytes(), "big")


_SIGNED = pa.schema([("doc", pa.int64()), ("fp", pa.int64())])


def _sign(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches, "text"):
        prints = np.array([fingerprint((t or "").encode(), width) for t in block.column("text").to_pylist()], np.uint64)
        yield as_batch(_SIGNED, doc=block.column("doc"), fp=prints.view(np.int64))


def _split(bits: list[int], parts: int) -> list[int]:
    """The masks of ``parts`` even parts of the given bit positions."""
    return [sum(1 << int(b) for b in part) for part in np.array_split(bits, parts)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def block_masks(distance: int = DISTANCE, n_blocks: int = BLOCKS) -> list[int]:
    """The masks of all choices of ``n_blocks - distance`` blocks."""
    parts = _split(list(range(64)), n_blocks)
    return [sum(choice) for choice in combinations(parts, n_blocks - distance)]


def finer_masks(mask: int, distance: int = DISTANCE) -> list[int]:
    """``mask`` with one more part of its open bits, for each of ``distance + 1`` parts."""
    open_ = [b for b in range(64) if not mask >> b & 1]
    return [mask | part for part in _split(open_, distance + 1)]


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _forest(prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (member, first member of its component) among the fingerprints of one bucket."""
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= distance
    root = near.argmax(axis=1)
    while True:
        lower = np.where(near, root[None, :], len(root)).min(axis=1)
        if (lower == root).all():
            break
        root = lower
    moved = np.flatnonzero(root != np.arange(len(root)))
    return moved, root[moved]


def _verify(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("prints")
        prints = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
        size = np.diff(ends)
        first = ends[:-1][size == 2]  # buckets of two, all at once
        close = first[np.bitwise_count(prints[first] ^ prints[first + 1]) <= distance]
        a, b = [close + 1], [close]
        for at in np.flatnonzero(size > 2):
            moved, root = _forest(prints[ends[at]:ends[at + 1]], distance)
            a.append(moved + ends[at])
            b.append(root + ends[at])
        left, right = prints[np.concatenate(a)].view(np.int64), prints[np.concatenate(b)].view(np.int64)
        if len(left):
            yield as_batch(_LINKS, a=left, b=right)


def _keys(members: DataFrame, masks: list) -> DataFrame:
    keys = [F.struct(m.alias("mask"), F.col("fp").bitwiseAND(m).alias("value")) for m in masks]
    return members.select("fp", F.explode(F.array(*keys)).alias("key")).select("fp", "key.mask", "key.value")


def links(prints: DataFrame, distance: int = DISTANCE, n_blocks: int = BLOCKS, bucket: int = BUCKET) -> DataFrame:
    """(a, b): links between the distinct fingerprints ``fp``, enough of them to connect all that are close."""
    spark = prints.sparkSession
    masks = block_masks(distance, n_blocks)
    keys, found = _keys(prints, [F.lit(_signed(m)) for m in masks]), None
    while True:
        size = keys.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        shared = keys.join(size, ["mask", "value"]).withColumn("hot", (F.col("size") > bucket) & (F.lit(64) - F.bit_count("mask") > OPEN))
        shared = staged(shared.drop("size"))
        small = shared.where("NOT hot").groupBy("mask", "value").agg(F.collect_list("fp").alias("prints"))
        new = small.select("prints").mapInArrow(partial(_verify, distance=distance), "a long, b long")
        found = new if found is None else found.unionByName(new)
        hot = shared.where("hot")
        used = [r[0] & _ALL for r in hot.select("mask").distinct().collect()]  # at most len(masks) masks, never members
        if not used:
            return found
        finer = spark.createDataFrame([(_signed(m), [_signed(x) for x in finer_masks(m, distance)]) for m in used], "mask long, finer array<long>")
        hot = hot.join(F.broadcast(finer), "mask").select("fp", F.explode("finer").alias("mask"))  # one row for each of the masks
        keys = hot.select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("value")).distinct()


def near_duplicates(docs: DataFrame, width: int = SHINGLE, distance: int = DISTANCE, n_blocks: int = BLOCKS, bucket: int = BUCKET) -> DataFrame:
    """doc_id, fingerprint and component_id of every document.

    Null text, empty text and text without words have the fingerprint zero and are linked like any other; texts with fewer
    words than ``width`` are one shingle; texts of any length are read whole.  Repeated rows stay; rows of one id with
    different texts are linked only by their fingerprints; a null id counts as the largest one and comes back as null;
    an empty table gives an empty result; other columns are ignored.
    """
    rows = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), "text")
    signed = staged(rows.mapInArrow(partial(_sign, width=width), "doc long, fp long"))
    classes = staged(signed.groupBy("fp").agg(F.min("doc").alias("least")))
    joined = components(links(classes.select("fp"), distance, n_blocks, bucket)).select(F.col("node").alias("fp"), "comp")
    joined = joined.join(classes, "fp")
    named = joined.join(joined.groupBy("comp").agg(F.min("least").alias("component")), "comp").select("fp", "component")
    # staged, so the documents of one frequent fingerprint meet a side with a shuffle of its own and can be split
    mapped = staged(classes.join(named, "fp", "left").select("fp", F.coalesce("component", "least").alias("component")))
    return signed.join(mapped, "fp").select(F.nullif("doc", F.lit(NO_ID)).alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                            F.nullif("component", F.lit(NO_ID)).alias("component_id"))
