"""Mixture-controlled packing: deficit round-robin over source queues, spread over all tasks.

Each source is a queue of its documents' tokens in the order of ids.  A window (sequence) is filled so that after every
window each source has had its share of the tokens so far, to within one token: the deficits that remain are carried into
the next window.  Serving the queue that is furthest behind, token by token, gives token j of a source with weight w the
due time (j + 1/2) / w; window k takes the next tokens by due time.  So how far each queue has been served before window k
follows from k and the queue lengths alone, and tasks carry the deficits across partitions without waiting for each other.
A queue that runs out drops from the round, the others go on in proportion.
"""
from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rooftree.llm.common import _LOWER, _SPACE, as_batch, blocks, concat_ranges, staged, utf8
from rooftree.llm.merges import Merges

WINDOW = 2048
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
MAX_QUEUES = 1_024  # the largest sources; all others share the last queue
CACHE_WORDS = 600_000
_PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+").fullmatch  # one pre-token, its own normal form


# --- tokens --------------------------------------------------------------------------------------------------------------------

@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


_TAIL = np.zeros(256, bool)  # what a full stop or comma is cut off from
_TAIL[[*range(97, 123), *range(48, 58)]] = True


def _words(text: np.ndarray, offsets: np.ndarray) -> tuple[pa.BinaryArray, np.ndarray]:
    """(words of all texts, number of words before each text and in all); a text with a special token keeps capitals and stops."""
    gap, low = _SPACE[text], _LOWER[text]
    edge = np.zeros(len(text) + 1, bool)
    edge[offsets] = True
    at = np.flatnonzero((low == 46) | (low == 44))
    at = at[~edge[at] & ~edge[at + 1]]  # a byte of the same text stands before it, and one behind it
    stops = at[_TAIL[low[at - 1]] & ((text[at + 1] == 32) | (text[at + 1] == 10))]
    mark = np.flatnonzero((text[:-1] == 60) & (text[1:] == 124))
    for r in np.unique(np.searchsorted(offsets, mark[~edge[mark + 1]], side="right") - 1).tolist():
        a, b = offsets[r], offsets[r + 1]
        low[a:b] = text[a:b]
        stops = stops[(stops < a) | (stops >= b)]
    begin = edge[:-1]
    begin[1:] |= gap[:-1]
    begin[stops] = True
    start = np.flatnonzero(begin & ~gap)
    ends = np.append(np.flatnonzero(begin[~gap]), len(text) - np.count_nonzero(gap)).astype(np.int32)
    words = pa.BinaryArray.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(low[~gap])])
    return words, np.searchsorted(start, offsets)


class WordCache:
    """Token ids of words, each distinct word encoded once; emptied when it has grown too large.

    White space only separates in this vocabulary, so the ids of a text are those of its words one after the other.  ASCII
    capitals are the same as small letters except in special tokens, and a full stop or comma between an ASCII letter and
    white space is a word of its own.  Words of small Latin letters are merged together, all others go to the tokenizers library.
    """

    def __init__(self, path: str, limit: int = CACHE_WORDS):
        self.tokenizer, self.merges, self.limit, self.known = _tokenizer(path), Merges(path, "</w>"), limit, {}

    def encode(self, text: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(16-bit ids of all texts, place of each text's first id and the end)."""
        words, first = _words(text, offsets)
        coded, known = words.dictionary_encode(), self.known
        which, (raw, ends) = coded.indices.to_numpy(), utf8(pa.RecordBatch.from_arrays([coded.dictionary], ["word"]), "word")
        raw, ends = raw.tobytes(), ends.tolist()
        distinct = [raw[a:b] for a, b in zip(ends, ends[1:])]
        if len(known) > self.limit:
            known.clear()
        bodies = list(map(known.get, distinct))
        new = [w for w, ids in zip(distinct, bodies) if ids is None]
        if new:
            plain = [w for w in new if _PLAIN(w)]
            known.update(zip(plain, self.merges.encode(plain)))
            odd = [w for w in new if w not in known]
            for w, e in zip(odd, self.tokenizer.encode_batch_fast([w.decode() for w in odd], add_special_tokens=False)):
                known[w] = np.array(e.ids, "<u2").tobytes()
            bodies = [known[w] if ids is None else ids for w, ids in zip(distinct, bodies)]
        size = np.fromiter(map(len, bodies), np.int64, len(bodies)) // 2
        each = size[which]
        ids = np.frombuffer(b"".join(bodies), "<u2")[concat_ranges((np.cumsum(size) - size)[which], each)]
        return ids, np.concatenate([[0], np.cumsum(each)])[first]


_CACHES: dict[str, WordCache] = {}


def _cache(path: str) -> WordCache:
    if path not in _CACHES:
        _CACHES[path] = WordCache(path)
    return _CACHES[path]


def _default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER)


_TOKENS = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("tokens", pa.int64()), ("ids", pa.binary())])


def _tokenize(batches: Iterator[pa.RecordBatch], path: str | None) -> Iterator[pa.RecordBatch]:
    cache = _cache(path or _default_path())
    for block in blocks(batches, "text", 1 << 22):  # distinct words are looked up once a block
        ids, place = cache.encode(*utf8(block, "text"))
        ids = np.insert(ids, place[1:], END_ID)
        place = place + np.arange(len(place))
        bodies = pa.BinaryArray.from_buffers(pa.binary(), block.num_rows, [None, pa.py_buffer((2 * place).astype(np.int32)), pa.py_buffer(ids)])
        yield as_batch(_TOKENS, doc_id=block.column("doc_id"), source=block.column("source"), tokens=np.diff(place), ids=bodies)


# --- windows -------------------------------------------------------------------------------------------------------------------

class Mixture:
    """How far each queue has been served before a window; ``weights`` are target shares (default: the queue lengths)."""

    def __init__(self, totals: list[int], weights: list[float] | None = None, window: int = WINDOW):
        self.totals = np.array(totals, np.int64)
        self.weights = np.array(weights if weights is not None else totals, np.float64)
        self.window, self.all = window, int(self.totals.sum())
        self.windows = -(-self.all // window)

    def _due(self, queue, served):
        return (served + 0.5) / self.weights[queue]

    def _start(self, goal: np.ndarray) -> np.ndarray:
        """Close to the right counts: in proportion, or by bisection over the due time."""
        if np.array_equal(self.weights, self.totals):
            return np.floor(goal[:, None] * (self.totals / max(self.all, 1)) + 0.5).astype(np.int64).clip(0, self.totals)
        low, high = np.zeros(len(goal)), np.full(len(goal), float((self.totals / self.weights).max()) + 1)
        for _ in range(64):
            mid = (low + high) / 2
            at = np.minimum(np.floor(mid[:, None] * self.weights + 0.5), self.totals).sum(axis=1)
            low, high = np.where(at < goal, mid, low), np.where(at < goal, high, mid)
        return np.minimum(np.floor(high[:, None] * self.weights + 0.5), self.totals).astype(np.int64)

    def served(self, k: np.ndarray) -> np.ndarray:
        """Tokens of each queue (columns) in the windows before ``k`` (rows): those with the smallest due times, ties by queue."""
        goal = np.minimum(np.asarray(k, np.int64) * self.window, self.all)
        have = self._start(goal)
        rows, queues = np.arange(len(goal)), np.arange(len(self.totals))
        while True:
            more = np.where(have < self.totals, self._due(queues, have), np.inf)
            less = np.where(have > 0, self._due(queues, have - 1), -np.inf)
            nxt = more.argmin(axis=1)  # the first of equal ones
            last = len(self.totals) - 1 - less[:, ::-1].argmax(axis=1)  # the last of equal ones
            gap = goal - have.sum(axis=1)
            a, b = more[rows, nxt], less[rows, last]
            swap = (gap == 0) & ((a < b) | ((a == b) & (nxt < last)))
            grow, shrink = (gap > 0) | swap, (gap < 0) | swap
            if not (grow | shrink).any():
                return have
            have[rows[grow], nxt[grow]] += 1
            have[rows[shrink], last[shrink]] -= 1


_PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                     ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


def _cut(batches: Iterator[pa.RecordBatch], totals: list[int], weights: list[float] | None, window: int) -> Iterator[pa.RecordBatch]:
    """Pieces of documents; rows have queue, the place ``at`` of the document in its queue, and its ids."""
    mixture = Mixture(totals, weights, window)
    for block in blocks(batches, "ids", 1 << 20):
        queue = np.array(block.column("queue").to_pylist(), np.int64)
        at, size = (np.array(block.column(c).to_pylist(), np.int64) for c in ("at", "tokens"))
        first, last = _window_of(mixture, queue, at), _window_of(mixture, queue, at + size - 1)
        wanted = np.unique(np.concatenate([np.arange(a, b + 2) for a, b in zip(first, last)]))
        before = mixture.served(wanted)
        order = np.searchsorted(wanted, first)
        out = {n: [] for n in _PIECES.names}
        ids = block.column("ids").to_pylist()
        docs = block.column("doc_id").to_pylist()
        for r in range(len(docs)):
            q, n = queue[r], int(last[r] - first[r]) + 1
            rows = before[order[r]:order[r] + n + 1]
            edge = rows[:, q]
            lo, hi = np.maximum(edge[:-1], at[r]), np.minimum(edge[1:], at[r] + size[r])
            ahead = (rows[1:, :q] - rows[:-1, :q]).sum(axis=1) + lo - edge[:-1]
            body = np.frombuffer(ids[r], "<u2").astype("<u4").tobytes()
            for j in np.flatnonzero(hi > lo):
                a, b = int(lo[j] - at[r]), int(hi[j] - at[r])
                for name, v in zip(_PIECES.names, (docs[r], a, b - a, zlib.crc32(body[4 * a:4 * b]), int(size[r]), int(first[r] + j), int(ahead[j]))):
                    out[name].append(v)
        yield as_batch(_PIECES, **out)


def _window_of(mixture: Mixture, queue: np.ndarray, token: np.ndarray) -> np.ndarray:
    """The window of a queue's token: the last one before which no more than ``token`` have been served."""
    due = mixture._due(queue, token)
    guess = np.minimum(np.floor(due[:, None] * mixture.weights + 0.5), mixture.totals).sum(axis=1).astype(np.int64) // mixture.window
    while True:
        guess = np.clip(guess, 0, max(mixture.windows - 1, 0))
        ks, where = np.unique(np.concatenate([guess, guess + 1]), return_inverse=True)
        served = mixture.served(ks)
        here, after = served[where[:len(guess)], queue], served[where[len(guess):], queue]
        down, up = here > token, after <= token
        if not (down | up).any():
            return guess
        guess = guess - down + up


# --- Spark plan ----------------------------------------------------------------------------------------------------------------

_PIECES_DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, weights: dict[str, float] | None = None, window: int = WINDOW, tokenizer: str | None = None) -> DataFrame:
    """Pieces of all documents in sequences of ``window`` tokens; only the last sequence is not full.

    ``weights``: target token share by source; without it each source weighs as many tokens as it has, and so does one that is
    not named.  Null text is empty (one end token); a null source is a queue of its own; repeated rows are packed as often as
    they come; a null id is kept as null and comes first; texts of any length are cut where a window ends; an empty table
    gives an empty result; other columns are ignored.
    """
    rows = docs.select("doc_id", "text", F.coalesce("source", F.lit("\x00")).alias("source"))
    tokens = rows.mapInArrow(partial(_tokenize, path=tokenizer), "doc_id long, source string, tokens long, ids binary")
    tokens = staged(tokens.withColumn("row", F.monotonically_increasing_id()))  # fixed once it is written
    sizes = tokens.groupBy("source").agg(F.sum("tokens").alias("total")).orderBy(F.desc("total"), "source").limit(MAX_QUEUES - 1).collect()
    if not sizes:
        return docs.sparkSession.createDataFrame([], _PIECES_DDL)
    names = [s["source"] for s in sizes]
    number = docs.sparkSession.createDataFrame(list(enumerate(names)), "queue int, source string")
    light = tokens.select("row", "doc_id", "source", "tokens").join(F.broadcast(number), "source", "left").fillna(len(names), ["queue"]).drop("source")
    # a document's place in its queue: sums over ranges of ids, then within a range
    ranged = staged(light.repartitionByRange("queue", "doc_id", "row").withColumn("part", F.spark_partition_id()))
    sums = ranged.groupBy("queue", "part").agg(F.sum("tokens").alias("sum"))
    earlier = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("queue", "part", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("queue", "part").orderBy("doc_id", "row").rowsBetween(Window.unboundedPreceding, -1)
    places = (ranged.withColumn("inner", F.coalesce(F.sum("tokens").over(inside), F.lit(0))).join(starts, ["queue", "part"])
              .select("row", "queue", (F.col("base") + F.col("inner")).alias("at")))
    queued = {r["queue"]: r["t"] for r in ranged.groupBy("queue").agg(F.sum("tokens").alias("t")).collect()}
    totals = [queued.get(q, 0) for q in range(max(queued) + 1)]
    shares = [float(weights.get(n, t)) for n, t in zip([*names, None], totals)] if weights else None
    ready = tokens.drop("source").join(places, "row").drop("row")
    return ready.mapInArrow(partial(_cut, totals=totals, weights=shares, window=window), _PIECES_DDL)
