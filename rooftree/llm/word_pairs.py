"""Word-pair model with modified Kneser-Ney discounts over a spelling model; it grows with the corpus and no task holds all of it.

    p(word | previous) = (c - D(c)) / c(previous) + g(previous) * spelling(word)

c are counts over all whole texts of a language (of the other texts: a document's own occurrences of the pair are left out
before its pairs are scored, so a word that only one document has is spelled), D the discounts for counts of 1, 2 and 3 or
more, g the mass that they free.  The lower order is open: it spells a word with the symbol model it is given.

A pair is one 63-bit key: language, hash of the word before, hash of the word.  Tasks send each shard the sorted pairs of a
unit of texts, with the texts that have them, as compressed arrays; a shard owns whole contexts, so it can merge its sorted
arrays, count, and score the same pairs: every word is shuffled once, in 4 to 6 bytes, and read twice.  Frequent contexts are
dealt over all shards by pair.  The first reading adds up their totals, at most twice the number of shards, and the counts of
counts of all pairs, from which the discounts follow; the second one scores.
"""
from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

from rooftree.llm.common import concat_ranges, mix

UNIT_BYTES = 1 << 22
CONTEXT_BITS, WORD_BITS = 36, 22
SAMPLE = 1  # the discounts come from one in this many classes of contexts: from all
START = np.uint64(0x5851F42D4C957F2D)  # stands before the first word of a text
COST = 1024  # costs are sent in this part of a nat

SENT = pa.schema([("shard", pa.int32()), ("unit", pa.int64()), ("kind", pa.int32()), ("body", pa.binary())])
SENT_DDL = "shard int, unit long, kind int, body binary"
STATS_DDL = "kind int, key long, n1 long, n2 long, n3 long, n4 long"
CONTEXT, CLASS = 0, 1


def squeeze(*arrays: np.ndarray) -> bytes:
    """Unsigned arrays in their smallest width; each byte plane is compressed by itself, or left as it is where that is shorter."""
    parts = []
    for a in arrays:
        top = int(a.max()) if len(a) else 0
        width = next(w for w in range(1, 9) if top < 1 << 8 * w)
        parts.append(struct.pack("<IB", len(a), width))
        for plane in np.ascontiguousarray(a.astype("<u8").view(np.uint8).reshape(-1, 8).T[:width]):
            raw = plane.tobytes()
            small = pa.compress(raw, "zstd", asbytes=True)
            raw = small if len(small) < len(raw) else raw
            parts.append(struct.pack("<I", len(raw)) + raw)
    return b"".join(parts)


def unsqueeze(body: bytes, first: int | None = None) -> list[np.ndarray]:
    """The arrays of ``squeeze``, or only the ``first`` ones."""
    out, at = [], 0
    while at < len(body) and (first is None or len(out) < first):
        n, width = struct.unpack_from("<IB", body, at)
        at += 5
        planes = np.zeros((n, 8), np.uint8)
        for k in range(width):
            size, = struct.unpack_from("<I", body, at)
            raw = body[at + 4:at + 4 + size]
            planes[:, k] = np.frombuffer(raw if size == n else pa.decompress(raw, n, "zstd", asbytes=True), np.uint8)
            at += 4 + size
        out.append(planes.view("<u8").ravel().astype(np.int64))
    return out


def pair_keys(words: np.ndarray, doc: np.ndarray, cls: np.ndarray) -> np.ndarray:
    """Key of every word with the one before it in its text; ``cls`` is the language class of each text, below 32."""
    before = np.empty_like(words)
    if len(words):
        before[1:] = words[:-1]
        before[np.flatnonzero(np.diff(doc, prepend=-1))] = START
    context = mix(before ^ np.uint64(0xA24BAED4963EE407)) >> np.uint64(64 - CONTEXT_BITS)
    word = mix(words ^ np.uint64(0x9FB21C651E98DF25)) >> np.uint64(64 - WORD_BITS)
    return (cls[doc].astype(np.int64) << CONTEXT_BITS | context.astype(np.int64)) << WORD_BITS | word.astype(np.int64)


def contexts(keys: np.ndarray) -> np.ndarray:
    return keys >> WORD_BITS


def among(values: np.ndarray, listed: np.ndarray) -> np.ndarray:
    """Which values are in a sorted list."""
    if not len(listed):
        return np.zeros(len(values), bool)
    return listed[np.searchsorted(listed, values).clip(0, len(listed) - 1)] == values


def shard_of(keys: np.ndarray, hot: np.ndarray, shards: int) -> np.ndarray:
    by = np.where(among(contexts(keys), hot), keys, contexts(keys))
    return (mix(by.astype(np.uint64)) % np.uint64(shards)).astype(np.int32)


def frequent(keys: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Contexts with at least one in 4 * shards of the pairs of a block, and how often each stands there."""
    context, n = np.unique(contexts(keys), return_counts=True)
    enough = n * 4 * shards >= len(keys)
    return context[enough], n[enough]


def _dealt(keys: np.ndarray, shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, positions of its keys in ascending order) of sorted keys."""
    order = np.argsort(shard, kind="stable")
    cuts = np.flatnonzero(np.diff(shard[order], prepend=-1))
    for a, b in zip(cuts, [*cuts[1:], len(order)]):
        yield int(shard[order[a]]), order[a:b]


class Merged:
    """Sorted keys and their summed counts; arrays are merged in as they come, so the memory is that of the distinct keys."""

    def __init__(self):
        self.keys, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.waiting, self.size = [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((keys, counts))
        self.size += len(keys)
        if self.size > max(1 << 20, len(self.keys) // 2):
            self.settle()

    def settle(self) -> None:
        keys = np.concatenate([self.keys, *(k for k, _ in self.waiting)])
        counts = np.concatenate([self.counts, *(c for _, c in self.waiting)])
        self.waiting, self.size = [], 0
        if len(keys):
            order = np.argsort(keys, kind="stable")
            keys, counts = keys[order], counts[order]
            first = np.flatnonzero(np.diff(keys, prepend=-1))
            self.keys, self.counts = keys[first], np.add.reduceat(counts, first)


def _by_context(merged: Merged) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(contexts, first pair of each, rows of total count and of pairs seen once, twice and three times or more)."""
    context = contexts(merged.keys)
    first = np.flatnonzero(np.diff(context, prepend=-1))
    columns = [merged.counts, merged.counts == 1, merged.counts == 2, merged.counts >= 3]
    sums = np.array([np.add.reduceat(c.astype(np.int64), first) if len(first) else np.zeros(0, np.int64) for c in columns])
    return context[first], first, sums


def stats(rows: Iterable[tuple], hot) -> Iterator[tuple[int, ...]]:
    """A shard's part of the totals of frequent contexts (CONTEXT) and of the counts of counts by language (CLASS)."""
    merged = Merged()
    for _, _, kind, body in rows:
        if kind == 1:
            gaps, n = unsqueeze(body, 2)
            merged.add(np.cumsum(gaps), n)
    merged.settle()
    context, _, sums = _by_context(merged)
    own = among(context, hot.value)
    yield from zip([CONTEXT] * int(own.sum()), context[own].tolist(), *sums[:, own].tolist())
    few = merged.counts <= 4
    cls = contexts(merged.keys[few]) >> CONTEXT_BITS
    times = np.bincount(cls * 5 + merged.counts[few], minlength=5 * 32).reshape(-1, 5)[:, 1:]
    yield from ((CLASS, c, *n) for c, n in enumerate(times.tolist()) if any(n))


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """Discounts for counts of 0, 1, 2 and 3 or more, from the counts of counts."""
    n1, n2, n3, n4 = (max(int(n), 1) for n in (n1, n2, n3, n4))
    y = n1 / (n1 + 2 * n2)
    return np.clip([0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3], 0, [0, 0.9, 1.8, 2.7])


def send(keys: np.ndarray, doc: np.ndarray, spell: np.ndarray, hot: np.ndarray, shards: int) -> list[tuple[int, bytes]]:
    """A unit's pairs for each shard: key gaps, occurrences, the text of each occurrence, spelling cost (1/16 of a doubling)."""
    order = np.argsort(keys, kind="stable")
    ordered, text = keys[order], doc[order]
    first = np.flatnonzero(np.diff(ordered, prepend=-1))
    times = np.diff(np.append(first, len(ordered)))
    step = text.copy()
    step[1:] -= text[:-1]
    step[first] = text[first]
    cost = np.minimum(np.rint(16 * np.log2(1 + spell[order][first])), 65_535).astype(np.int64)
    pairs = ordered[first]
    return [(s, squeeze(np.diff(pairs[own], prepend=0), times[own], step[concat_ranges(first[own], times[own])], cost[own]))
            for s, own in _dealt(pairs, shard_of(pairs, hot, shards))]


class Shard:
    """Counts of a shard's pairs, and the cost of a unit's texts under them."""

    def __init__(self, merged: Merged, hot: np.ndarray, hot_sums: np.ndarray, cuts: np.ndarray):
        context, first, sums = _by_context(merged)
        own = among(context, hot)
        sums[:, own] = hot_sums[:, np.searchsorted(hot, context[own])]
        self.keys, self.counts, self.cuts = merged.keys, merged.counts, cuts
        self.context = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(merged.keys))))
        self.total = sums[0]
        d = cuts[context >> CONTEXT_BITS]
        self.free = (d[:, 1:] * sums[1:].T).sum(axis=1) / np.maximum(sums[0], 1)

    def costs(self, body: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(texts of the unit, cost of each in nats)."""
        gaps, times, step, spell = unsqueeze(body)
        keys = np.cumsum(gaps)
        start = np.cumsum(times) - times
        text = np.cumsum(step)
        text -= np.repeat(text[start] - step[start], times)
        pair = np.repeat(np.arange(len(keys)), times)
        run = np.flatnonzero((np.diff(pair, prepend=-1) != 0) | (np.diff(text, prepend=-1) != 0))
        own = np.diff(np.append(run, len(pair)))
        pair, text = pair[run], text[run]
        at = np.searchsorted(self.keys, keys)[pair]
        count, total = self.counts[at] - own, self.total[self.context[at]] - own
        spelled = np.exp(-(np.exp2(spell / 16) - 1))[pair]
        cut = self.cuts[contexts(keys)[pair] >> CONTEXT_BITS, np.minimum(count, 3)]
        free = np.where(total > 0, self.free[self.context[at]], 1)
        p = np.maximum(count - cut, 0) / np.maximum(total, 1) + free * spelled
        cost = -np.log(np.maximum(p, 1e-300)) * own
        texts, which = np.unique(text, return_inverse=True)
        return texts, np.bincount(which, cost, len(texts))


def score(rows: Iterable[tuple], model) -> Iterator[tuple[int, int, int, bytes]]:
    """Passes rows of other kinds on; turns a shard's pairs (kind 1) into the costs of each unit's texts."""
    held, merged = [], Merged()
    for row in rows:
        shard, unit, kind, body = row
        if kind != 1:
            yield tuple(row)
            continue
        gaps, times = unsqueeze(body, 2)
        merged.add(np.cumsum(gaps), times)
        held.append((unit, body))
    merged.settle()
    counted = Shard(merged, *model.value)
    for unit, body in held:
        texts, cost = counted.costs(body)
        yield 0, unit, 1, squeeze(np.diff(texts, prepend=0), np.rint(cost * COST).astype(np.int64))
