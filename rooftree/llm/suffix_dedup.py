"""Repeated byte strings found with suffix arrays (two-stage sorting) over content-anchored segments.

Every window of ``length`` bytes picks the smallest ``GRAM``-byte hash inside it as its anchor, so equal windows have
equal anchors wherever they stand.  Neighbouring windows with one anchor make a run.  Spark counts anchors; a run whose
anchor occurs once is unique.  Equal runs are counted once.  The distinct runs of one anchor go to one task, which
builds the suffix array of their texts and compares adjacent common prefixes.  An anchor with more than ``hot_runs``
distinct runs is split by content: blocks of windows keyed by what all of their windows have in common.  Equal blocks are
repeats; the distinct blocks of one key are compared in one task, and those of a key with too many as single windows.

Two-stage sorting: only suffixes smaller than their successor are sorted directly; the others are induced by one scan
over the buckets of first characters.  Suffixes are ordered by their first ``length`` characters, which is all that
adjacent prefixes of that length need.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rooftree.llm.common import (LOWEST, as_batch, blocks, byte_codes, concat_ranges, mix, prefix_hash, range_hash, row_key,
                                 staged, utf8)

LENGTH = 400
GRAM = 32
HOT_RUNS = 2_000
SUB = 32
PIECE = 1 << 21  # windows of a long text that are anchored at once; positions must fit the low bits of the hashes
_LOW = np.uint64((1 << 24) - 1)
_A, _B = byte_codes(11), byte_codes(29)


# --- anchors -----------------------------------------------------------------------------------------------------------------

def _window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, by prefix and suffix minima of blocks."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    grid = padded.reshape(-1, width)
    left = np.minimum.accumulate(grid, axis=1).ravel()
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n - width + 1], left[width - 1:n])


def runs_of(text: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Runs of windows with one anchor: (text index, start in text, windows, anchor offset, anchor hash, run hash)."""
    width = length - gram + 1
    none = np.zeros(0, np.int64)
    if len(text) < length:
        return none, none, none, none, none, none
    prefix = prefix_hash(text, _A)
    at = np.arange(len(text) - gram + 1)
    grams = mix(range_hash(prefix, at, at + gram))
    anchor = (_window_minima((grams & ~_LOW) | at.astype(np.uint64), width) & _LOW).astype(np.int64)
    doc = np.searchsorted(offsets, np.arange(len(anchor)), side="right") - 1
    inside = np.arange(len(anchor)) + length <= offsets[doc + 1]
    fresh = np.ones(len(anchor), bool)
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1]) | (inside[1:] != inside[:-1])
    start = np.flatnonzero(fresh)
    count = np.diff(np.append(start, len(anchor)))
    keep = inside[start]
    start, count = start[keep], count[keep]
    whole = mix(range_hash(prefix_hash(text, _B), start, start + count - 1 + length) + count.astype(np.uint64))
    spot = anchor[start]
    return doc[start], start - offsets[doc[start]], count, spot - start, grams[spot].view(np.int64), whole.view(np.int64)


def _runs_by_piece(text: np.ndarray, offsets: np.ndarray, length: int, piece: int = PIECE):
    """``runs_of``; one long text is taken in pieces that overlap by a window less a byte, so each window is in one piece."""
    if len(offsets) != 2 or len(text) <= piece:
        return runs_of(text, offsets, length)
    found = []
    for lo in range(0, len(text) - length + 1, piece):
        part = text[lo:lo + piece + length - 1]
        doc, start, *rest = runs_of(part, np.array([0, len(part)]), length)
        found.append((doc, start + lo, *rest))
    return tuple(np.concatenate(c) for c in zip(*found)) if found else runs_of(text, offsets, length)


_RUNS = pa.schema([("doc", pa.int64()), ("rk", pa.int64()), ("start", pa.int64()), ("windows", pa.int32()), ("off", pa.int32()),
                   ("anchor", pa.int64()), ("run", pa.int64())])


def _emit_runs(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches, "text", 1 << 23):
        text, offsets = utf8(block, "text")
        for lo, hi in _slabs(offsets):
            part = offsets[lo:hi + 1] - offsets[lo]
            doc, start, windows, off, anchor, run = _runs_by_piece(text[offsets[lo]:offsets[hi]], part, length)
            pick = pa.array(doc + lo)
            yield as_batch(_RUNS, doc=block.column("doc").take(pick), rk=block.column("rk").take(pick), start=start, windows=windows,
                           off=off, anchor=anchor, run=run)


def _slabs(offsets: np.ndarray, limit: int = PIECE) -> Iterator[tuple[int, int]]:
    lo, last = 0, len(offsets) - 1
    while lo < last:
        hi = min(max(int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1, lo + 1), last)
        yield lo, hi
        lo = hi


# --- suffix arrays -------------------------------------------------------------------------------------------------------------

_SYMBOLS = 7  # nine bits each
_SETTLE = 8  # rounds between two comparisons of whole groups
_WIDE = np.concatenate([byte_codes(41), byte_codes(43)])  # a code for each of 257 symbols


def _words(t: np.ndarray) -> np.ndarray:
    """The next seven symbols of each position as one number; nothing counts after a sentinel (0)."""
    padded = np.concatenate([t, np.zeros(_SYMBOLS, t.dtype)]).astype(np.uint64)
    out, alive = np.zeros(len(t), np.uint64), np.ones(len(t), bool)
    for j in range(_SYMBOLS):
        symbol = padded[j:j + len(t)]
        out = (out << np.uint64(9)) | np.where(alive, symbol, np.uint64(0))
        alive &= symbol != 0
    return out


def _sort_directly(t: np.ndarray, words: np.ndarray, which: np.ndarray, depth: int) -> np.ndarray:
    """``which`` ordered by up to ``depth`` symbols of their suffixes: radix words, ties refined word by word.

    A round touches only suffixes that are still tied, and sorts only groups in which the next words differ.  Before the
    rounds begin, and again from time to time, groups that agree on all symbols up to ``depth`` are settled by one comparison.
    """
    order = which[np.argsort(words[which], kind="stable")]
    last, prefix = len(t) - 1, prefix_hash(t, _WIDE)
    stop = np.flatnonzero(t == 0)
    stop = stop[np.searchsorted(stop, np.arange(len(t)))]  # each position's sentinel
    alive, key, group = np.arange(len(order)), words[order], np.zeros(len(order), np.int64)
    done = _SYMBOLS
    while True:
        fresh = np.ones(len(alive), bool)
        fresh[1:] = (group[1:] != group[:-1]) | (key[1:] != key[:-1])
        tied = ~fresh | ~np.append(fresh[1:], True)
        keep = tied & ((key & np.uint64(511)) != 0)  # a sentinel in the word: equal suffixes end there
        group = np.cumsum(fresh)[keep]
        alive = alive[keep]
        if len(alive) and (done - _SYMBOLS) % (_SYMBOLS * _SETTLE) == 0:
            item = order[alive]
            whole = item + depth <= stop[item]
            code = range_hash(prefix, item, np.minimum(item + depth, last))
            first = np.flatnonzero(np.diff(group, prepend=-1))
            equal = np.logical_and.reduceat(whole & (code == np.repeat(code[first], np.diff(np.append(first, len(item))))), first)
            open_ = ~np.repeat(equal, np.diff(np.append(first, len(item))))
            alive, group = alive[open_], group[open_]
        if not len(alive) or done >= depth:
            return order
        item = order[alive]
        key = words[np.minimum(item + done, last)]
        differs = np.zeros(len(alive), bool)
        differs[1:] = (group[1:] == group[:-1]) & (key[1:] != key[:-1])
        if differs.any():
            first = np.flatnonzero(np.diff(group, prepend=-1))
            size = np.diff(np.append(first, len(alive)))
            rows = np.flatnonzero(np.repeat(np.logical_or.reduceat(differs, first), size))
            ranked = rows[np.lexsort((key[rows], group[rows]))]
            order[alive[rows]], key[rows] = item[ranked], key[ranked]
        done += _SYMBOLS


def suffix_array(t: np.ndarray, depth: int = LENGTH, words: np.ndarray | None = None, wanted: np.ndarray | None = None) -> np.ndarray:
    """Suffixes of ``t`` (uint16 symbols, each segment ended by the sentinel 0) ordered by their first ``depth`` symbols.

    ``wanted`` marks the first places of each segment that the caller asks for.  A suffix is induced from its successor, so
    beside them only those up to the segment's next directly sorted suffix take part.
    """
    n = len(t)
    change = np.append(t[1:] != t[:-1], True)
    reach = np.minimum.accumulate(np.where(change, np.arange(n), n)[::-1])[::-1]  # last position of the run of equal symbols
    smaller = t[reach] < t[np.minimum(reach + 1, n - 1)]  # smaller than its successor: sorted directly
    smaller |= t == 0
    use = np.ones(n, bool)
    if wanted is not None:
        direct = np.flatnonzero(smaller)
        use = wanted.copy()
        beyond = np.flatnonzero(~wanted & np.append(False, wanted[:-1]))  # the place behind the wanted ones of each segment
        use[concat_ranges(beyond, direct[np.searchsorted(direct, beyond)] - beyond + 1)] = True
    direct = _sort_directly(t, _words(t) if words is None else words, np.flatnonzero(smaller & use & (t != 0)), depth)
    size = np.bincount(t[use], minlength=258)
    base = np.concatenate([[0], np.cumsum(size)])
    out = np.empty(base[-1], np.int64)
    out[:size[0]] = np.flatnonzero((t == 0) & use)
    tails = np.bincount(t[direct], minlength=258)
    at = np.concatenate([[0], np.cumsum(tails)])
    symbols = np.flatnonzero(size)
    for c in symbols:
        if c:
            out[base[c + 1] - tails[c]:base[c + 1]] = direct[at[c]:at[c + 1]]
    front = base[:-1].copy()  # where each bucket's next induced suffix goes

    def induce(found: np.ndarray) -> np.ndarray:
        """Put the predecessors of ``found`` that are larger than their successor into their buckets; own bucket's come back."""
        before = found - 1
        before = before[before >= 0]
        before = before[use[before] & ~smaller[before]]
        bucket = t[before]
        ranked = np.argsort(bucket, kind="stable")
        before, bucket = before[ranked], bucket[ranked]
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        for part in np.split(before, cuts) if len(before) else []:
            b = t[part[0]]
            out[front[b]:front[b] + len(part)] = part
            front[b] += len(part)
        return before

    for c in symbols:
        seen, stop = base[c], (front[c] if c else base[1])
        while seen < stop:  # a run of one symbol puts suffixes into the bucket under scan
            induce(out[seen:stop])
            seen, stop = stop, (front[c] if c else base[1])
        if c and tails[c]:
            induce(out[base[c + 1] - tails[c]:base[c + 1]])
    return out


def common_prefix(t: np.ndarray, a: np.ndarray, b: np.ndarray, limit: int, words: np.ndarray | None = None) -> np.ndarray:
    """Length of the common prefix of the suffixes at a[i] and b[i], at most ``limit``: whole words first, then symbols."""
    words = _words(t) if words is None else words
    found, open_, last = np.zeros(len(a), np.int64), np.arange(len(a)), len(t) - 1
    for j in range(0, limit, _SYMBOLS):
        x, y = words[np.minimum(a[open_] + j, last)], words[np.minimum(b[open_] + j, last)]
        open_ = open_[(x == y) & ((x & np.uint64(511)) != 0)]
        if not len(open_):
            break
        found[open_] = j + _SYMBOLS
    open_ = np.flatnonzero(found < limit)
    for _ in range(_SYMBOLS):
        x, y = t[np.minimum(a[open_] + found[open_], last)], t[np.minimum(b[open_] + found[open_], last)]
        open_ = open_[(x == y) & (x != 0)]
        found[open_] += 1
    return np.minimum(found, limit)


def repeated_windows(segments: list[np.ndarray], windows: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """For each segment, which of its first ``windows`` starts begin a string of ``length`` that starts elsewhere, too."""
    sizes = np.array([len(s) + 1 for s in segments])
    start = np.concatenate([[0], np.cumsum(sizes)])
    t = np.zeros(start[-1], np.uint16)
    for s, p in zip(segments, start):
        t[p:p + len(s)] = s.astype(np.uint16) + 1
    valid = np.zeros(len(t), bool)
    valid[concat_ranges(start[:-1], windows)] = True
    words = _words(t)
    order = suffix_array(t, length, words, valid)
    order = order[valid[order]]
    hit = np.zeros(len(t), bool)
    if len(order) > 1:
        equal = common_prefix(t, order[:-1], order[1:], length, words) >= length
        hit[order[:-1][equal]] = True
        hit[order[1:][equal]] = True
    return [hit[p:p + w] for p, w in zip(start[:-1], windows)]


_MARKS = pa.schema([("anchor", pa.int64()), ("run", pa.int64()), ("lo", pa.int32()), ("n", pa.int32())])


def _spans(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edge[::2], edge[1::2] - edge[::2]


def _mark_groups(batches: Iterator[pa.RecordBatch], length: int, by: str = "anchor", limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by ``by``; whole groups are taken together until ``limit`` bytes are reached."""
    held, size, current = [], 0, None

    def flush():
        flags = repeated_windows([np.frombuffer(h[3], np.uint8) for h in held], np.array([h[4] for h in held]), length)
        out = [(h[0], h[1], h[2] + lo, n) for h, f in zip(held, flags) for lo, n in zip(*_spans(f))]
        held.clear()
        if out:
            a, r, lo, n = zip(*out)
            yield as_batch(_MARKS, anchor=a, run=r, lo=lo, n=n)

    for batch in batches:
        for group, *row in zip(*(batch.column(c).to_pylist() for c in (by, "anchor", "run", "lo", "body", "windows"))):
            if group != current and size >= limit:
                yield from flush()
                size = 0
            current = group
            held.append(row)
            size += len(row[3])
    if held:
        yield from flush()


_BODY = pa.schema([("anchor", pa.int64()), ("run", pa.int64()), ("hot", pa.bool_()), ("n", pa.int64()), ("off", pa.int32()),
                   ("windows", pa.int32()), ("body", pa.binary())])


def _cut_bodies(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted runs of each document."""
    for block in blocks(batches, "text"):
        text, offsets = utf8(block, "text")
        raw, out = text.tobytes(), []
        for base, wanted in zip(offsets, block.column("wanted").to_pylist()):
            for w in wanted:
                a = int(base) + w["start"]
                out.append((w["anchor"], w["run"], w["hot"], w["n"], w["off"], w["windows"], raw[a:a + w["windows"] - 1 + length]))
        if out:
            yield as_batch(_BODY, **dict(zip(_BODY.names, zip(*out))))


_PIECES = pa.schema([("key", pa.binary()), ("anchor", pa.int64()), ("run", pa.int64()), ("n", pa.int64()), ("lo", pa.int32()),
                     ("windows", pa.int32()), ("body", pa.binary())])


def _pieces(batches: Iterator[pa.RecordBatch], length: int, sub: int) -> Iterator[pa.RecordBatch]:
    """Hot runs as blocks of at most ``sub`` windows, aligned to the anchor and keyed by the bytes that all of them share."""
    for batch in batches:
        out = []
        for a, r, n, off, windows, body in zip(*(batch.column(c).to_pylist() for c in ("anchor", "run", "n", "off", "windows", "body"))):
            lo = 0
            while lo < windows:
                block = (off - lo) // sub  # windows start off - lo bytes before the anchor
                hi = min(windows - 1, off - block * sub)
                first, last = off - (block * sub + sub - 1), off - block * sub
                shared = body[last:first + length]
                key = hashlib.blake2b(shared + block.to_bytes(4, "big", signed=True), digest_size=16).digest()
                out.append((key, a, r, n, lo, hi - lo + 1, body[lo:hi + length]))
                lo = hi + 1
        if out:
            yield as_batch(_PIECES, **dict(zip(_PIECES.names, zip(*out))))


_SINGLE = pa.schema([("key", pa.binary()), ("anchor", pa.int64()), ("run", pa.int64()), ("n", pa.int64()), ("lo", pa.int32())])


def _single_windows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [(hashlib.blake2b(body[j:j + length], digest_size=16).digest(), a, r, n, lo + j)
               for a, r, n, lo, windows, body in zip(*(batch.column(c).to_pylist() for c in ("anchor", "run", "n", "lo", "windows", "body")))
               for j in range(windows)]
        if out:
            yield as_batch(_SINGLE, **dict(zip(_SINGLE.names, zip(*out))))


# --- Spark plan ----------------------------------------------------------------------------------------------------------------

_RUNS_DDL = "doc long, rk long, start long, windows int, off int, anchor long, run long"
_BODY_DDL = "anchor long, run long, hot boolean, n long, off int, windows int, body binary"
_MARKS_DDL = "anchor long, run long, lo int, n int"
_PIECES_DDL = "key binary, anchor long, run long, n long, lo int, windows int, body binary"


def repeated_spans(docs: DataFrame, length: int = LENGTH, hot_runs: int = HOT_RUNS) -> DataFrame:
    """(doc, rk, spans) for documents with repeats: starts and lengths of the bytes to remove, unsorted and overlapping.

    ``doc`` is the id (the lowest long for null), ``rk`` the row key: see ``common.row_key``.
    """
    docs = _keyed(docs)
    runs = staged(docs.mapInArrow(partial(_emit_runs, length=length), _RUNS_DDL))
    # one row per distinct run: how often it occurs and one place where it stands; equal runs have equal bytes, so any place
    # serves, and the staged result holds on to one (first values are a hash aggregate, the least struct would sort)
    place = [F.first(c).alias(c) for c in ("doc", "rk", "start", "windows", "off")]
    kinds = runs.groupBy("anchor", "run").agg(F.count(F.lit(1)).alias("n"), *place)
    # staged, so a frequent anchor's rows meet a side with a shuffle of its own and can be split
    anchors = staged(runs.groupBy("anchor").agg(F.count(F.lit(1)).alias("total")).where("total > 1").select("anchor"))
    kinds = staged(kinds.join(anchors, "anchor", "left_semi"))
    variety = staged(kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1"))
    mixed = kinds.join(variety, "anchor").withColumn("hot", F.col("kinds") > hot_runs)
    wanted = (mixed.where("n = 1 OR hot OR kinds > 1").groupBy("doc", "rk")
              .agg(F.collect_list(F.struct("anchor", "run", "hot", "n", "off", "windows", "start")).alias("wanted")))
    one_each = docs.join(wanted, ["doc", "rk"])
    bodies = one_each.select("text", "wanted").mapInArrow(partial(_cut_bodies, length=length), _BODY_DDL)
    bodies = staged(bodies)
    cool = (bodies.where("NOT hot").select("anchor", "run", F.lit(0).alias("lo"), "windows", "body").dropDuplicates(["anchor", "run"])
            .repartition("anchor").sortWithinPartitions("anchor", "run"))
    marks = cool.mapInArrow(partial(_mark_groups, length=length), _MARKS_DDL)
    hot = bodies.where("hot").drop("hot")
    marks = marks.unionByName(_hot_marks(hot, length, hot_runs))
    whole = kinds.where("n > 1").select("anchor", "run", F.lit(0).alias("lo"), F.col("windows").alias("n"))
    found = marks.unionByName(whole)
    placed = runs.select("doc", "rk", "start", "anchor", "run").join(found, ["anchor", "run"])
    span = F.struct((F.col("start") + F.col("lo")).alias("at"), (F.col("n") - 1 + length).cast("long").alias("size"))
    return placed.groupBy("doc", "rk").agg(F.collect_list(span).alias("spans"))


def _hot_marks(hot: DataFrame, length: int, hot_runs: int) -> DataFrame:
    """Repeats among the runs of anchors with very many distinct runs, without gathering them.

    A block that stands twice is repeated whole; the others' windows are compared with one block of each kind of their key.
    """
    hot = hot.dropDuplicates(["anchor", "run"])
    pieces = hot.mapInArrow(partial(_pieces, length=length, sub=SUB), _PIECES_DDL).withColumn("sum", F.xxhash64("body"))
    places = staged(pieces.drop("body", "n"))
    kinds = staged(places.groupBy("key", "sum").agg(F.count(F.lit(1)).alias("n")))
    equal = places.join(kinds.where("n > 1"), ["key", "sum"], "left_semi").select("anchor", "run", "lo", F.col("windows").alias("n"))
    mixed = kinds.groupBy("key").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    one_each = staged(pieces.join(mixed, "key").dropDuplicates(["key", "sum"]).select("key", "kinds", "anchor", "run", "n", "lo", "windows", "body"))
    few = one_each.where(F.col("kinds") <= hot_runs).repartition("key").sortWithinPartitions("key", "anchor", "run")
    marks = equal.unionByName(few.mapInArrow(partial(_mark_groups, length=length, by="key"), _MARKS_DDL))
    single = (one_each.where(F.col("kinds") > hot_runs).drop("key", "kinds")
              .mapInArrow(partial(_single_windows, length=length), "key binary, anchor long, run long, n long, lo int"))
    often = single.groupBy("key").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    return marks.unionByName(single.join(often, "key", "left_semi").select("anchor", "run", "lo", F.lit(1).alias("n")))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("doc_id", F.lit(LOWEST)).alias("doc"), row_key().alias("rk"), "text")


def _merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal runs covered by the spans."""
    out: list[list[int]] = []
    for at, stop in sorted((s["at"], s["at"] + s["size"]) for s in spans or []):
        if out and at <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([at, stop])
    return [(a, b) for a, b in out]


def _left(raw: bytes, cut: list[tuple[int, int]]) -> bytes:
    ends = [0, *(b for _, b in cut)]
    return b"".join(raw[a:b] for a, b in zip(ends, [*(a for a, _ in cut), len(raw)]))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                        ("kept_sha256", pa.string())])
    for block in blocks(batches, "text"):
        text, offsets = utf8(block, "text")
        raw, rows = text.tobytes(), []
        for doc_id, a, b, spans in zip(block.column("doc_id").to_pylist(), offsets.tolist(), offsets[1:].tolist(), block.column("spans").to_pylist()):
            cut = _merged(spans)
            rows.append((doc_id, b - a, sum(y - x for x, y in cut), len(cut), hashlib.sha256(_left(raw[a:b], cut)).hexdigest()))
        yield as_batch(schema, **dict(zip(schema.names, zip(*rows))))


def _with_spans(docs: DataFrame, length: int, hot_runs: int) -> DataFrame:
    """(row, text, spans): the document as one struct, so its columns may have any names."""
    spans = repeated_spans(docs, length, hot_runs)
    keyed = docs.select(F.coalesce("doc_id", F.lit(LOWEST)).alias("doc"), row_key().alias("rk"), "text", F.struct(*docs.columns).alias("row"))
    return keyed.join(spans, ["doc", "rk"], "left").select("row", "text", "spans")


def report(docs: DataFrame, length: int = LENGTH, hot_runs: int = HOT_RUNS) -> DataFrame:
    """Per document: bytes, removed bytes, removed runs and the SHA-256 of what is left.

    Null text is empty; texts shorter than ``length`` keep everything; repeated rows are repeats of each other, so all of
    their bytes go; a null id is kept as null; an empty table gives an empty result; other columns are ignored.
    """
    rows = _with_spans(docs.select("doc_id", "text"), length, hot_runs).select("row.doc_id", "text", "spans")
    return rows.mapInArrow(_digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches, "text"):
        texts = [t if t is None or not s else _left(t.encode(), _merged(s)).decode(errors="ignore")
                 for t, s in zip(block.column("text").to_pylist(), block.column("spans").to_pylist())]
        row = block.column("row")
        fields = [pa.array(texts, pa.string()) if f.name == "text" else c for f, c in zip(row.type, row.flatten())]
        yield pa.RecordBatch.from_arrays(fields, names=[f.name for f in row.type])


def remove_repeats(docs: DataFrame, length: int = LENGTH, hot_runs: int = HOT_RUNS) -> DataFrame:
    """The documents without repeated bytes, all columns kept, whatever their names; a character cut in two by a removal goes whole."""
    return _with_spans(docs, length, hot_runs).mapInArrow(_strip, docs.schema)
