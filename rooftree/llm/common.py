"""Helpers that several operators share: staging, row keys, text blocks and word hashes as numpy arrays.

Executors run these inside ``mapInArrow``: a task takes its Arrow batches in blocks of bounded size, so a worker's
memory does not depend on the number of rows.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rooftree.session import staged

__all__ = ["staged", "read", "row_key", "free_name", "blocks", "utf8", "words_of", "mix", "as_batch", "concat_ranges"]

BLOCK_BYTES = 1 << 21
LOWEST = -(1 << 63)


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores behind it as keep it apart from the table's columns."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """64-bit key of a row's content: rows of one id but different texts stay apart, repeated rows share it."""
    return F.xxhash64(F.col(doc_id), F.col(text))


def blocks(batches: Iterator[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Row slices whose texts have about ``limit`` bytes at most; a longer text comes alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data = batch.column(column)
        if pa.types.is_null(data.type):
            yield batch
            continue
        ends = np.frombuffer(data.buffers()[1], dtype=_offset_type(data.type))[data.offset:data.offset + len(data) + 1]
        start = 0
        while start < len(data):
            stop = int(np.searchsorted(ends, ends[start] + limit, side="right")) - 1
            stop = min(max(stop, start + 1), len(data))
            yield batch.slice(start, stop - start)
            start = stop


def _offset_type(kind: pa.DataType):
    return np.int64 if pa.types.is_large_string(kind) or pa.types.is_large_binary(kind) else np.int32


def utf8(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts joined, n + 1 offsets); null counts as empty."""
    data = batch.column(column)
    if pa.types.is_null(data.type):
        return np.zeros(0, np.uint8), np.zeros(len(data) + 1, np.int64)
    if data.null_count:
        data = pa.array(data.to_pylist(), data.type) if data.offset else data
        data = data.fill_null("" if pa.types.is_string(data.type) or pa.types.is_large_string(data.type) else b"")
    ends = np.frombuffer(data.buffers()[1], dtype=_offset_type(data.type))[data.offset:data.offset + len(data) + 1].astype(np.int64)
    body = data.buffers()[2]
    text = np.frombuffer(body, np.uint8)[ends[0]:ends[-1]] if body is not None else np.zeros(0, np.uint8)
    return text, ends - ends[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values (wraps around)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def byte_codes(seed: int) -> np.ndarray:
    """A random odd-looking 64-bit value for each byte, the same in every process."""
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(seed))


_CODES = byte_codes(7)
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64, kept between blocks."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = _POWERS[base] = np.multiply.accumulate(have)
    return have[:n]


def prefix_hash(text: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Sums of code * base ** position; the hash of [a, b) is (p[b] - p[a]) * inverse ** a."""
    out = np.zeros(len(text) + 1, np.uint64)
    np.cumsum(codes[text] * powers(_BASE, len(text)), out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    return (prefix[stop] - prefix[start]) * powers(_INVERSE, len(prefix))[start]


def words_of(text: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of every text: (start, stop, index of the text, 64-bit hash)."""
    gap = np.ones(len(text) + 2, bool)
    gap[1:-1] = _SPACE[text]
    start = np.flatnonzero(gap[:-1] & ~gap[1:])
    stop = np.flatnonzero(~gap[:-1] & gap[1:])
    inner = offsets[1:-1]  # a word that runs over the end of a text is two words
    inner = np.unique(inner[(inner > 0) & (inner < len(text))])
    cut = inner[~gap[inner] & ~gap[inner + 1]] if len(inner) else inner
    if len(cut):
        start, stop = np.sort(np.concatenate([start, cut])), np.sort(np.concatenate([stop, cut]))
    prefix = prefix_hash(_LOWER[text] if lower else text, _CODES)
    hashes = mix(range_hash(prefix, start, stop) + (stop - start).astype(np.uint64))
    return start, stop, np.searchsorted(offsets, start, side="right") - 1, hashes


def as_batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for f, c in
                                       ((f, columns[f.name]) for f in schema)], schema=schema)


def concat_ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... for each range, joined."""
    total = int(length.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(length)
    return np.arange(total) - np.repeat(ends - length, length) + np.repeat(start, length)
