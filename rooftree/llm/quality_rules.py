"""Quality rules: counts of words, symbols and repeats, and perplexity bands under an n-gram model of the corpus.

The model is a modified Kneser-Ney model of word pairs by language (``word_pairs``), counted over all whole texts: it grows with
the corpus, lies in sorted arrays of hashes, and no task or broadcast holds all of it.  Its lower order spells words with a
modified Kneser-Ney model of symbol trigrams.  A symbol is a small or capital letter, a digit class, one of a few classes of
other characters, or the gap between words: 64 in all, so a language has at most 2 ** 18 trigrams, a size fit for a broadcast.
A document is rejected if its mean surprise per word leaves its language's band.  The upper limit is counted from the median over all
documents of the language in steps of the way from there to the upper quartile: copies, which their twins make predictable, widen
the lower half of the distribution, so its lower quartile is no measure of what clean text varies by.  The lower limit is a part of
the median, which text reaches whose word pairs many other documents have.
"""
from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import RDD, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rooftree.llm import word_pairs
from rooftree.llm.common import _SPACE, as_batch, blocks, mix, staged, utf8, words_of

LANGUAGES = 31  # the most frequent languages have models of their own; all others share one
ORDER_BITS = 18
WINDOW = 5
LEAST_WORDS = 10
REPEAT_PERCENT = 20
ABOVE = 4.0  # upper limit of a band, in steps from the median to the upper quartile
BELOW = 0.2  # lower limit, in medians
LEAST_SPREAD = 0.15
SHORT = 16.0  # allowance for short texts: this many nats by the square root of their words
PAIRED, ALL = -1, -2  # classes of the count of frequent contexts and of all pairs


def _symbols() -> np.ndarray:
    """Symbol of each byte: 0 gap, 1-26 small, 27-52 capital, 53 digits, 54-57 other scripts, 58 . and , 59 ! and ?, 60 marks, 61 rest."""
    out = np.full(256, 61, np.uint8)
    out[_SPACE] = 0
    out[97:123], out[65:91] = np.arange(1, 27), np.arange(27, 53)
    out[48:58] = 53
    out[128:] = 54 + np.arange(128) % 4
    out[[ord(c) for c in ".,"]] = 58
    out[[ord(c) for c in "!?"]] = 59
    out[[ord(c) for c in "#*$%&|<>"]] = 60
    return out


_SYMBOL = _symbols()
_MARK = _SYMBOL == 60


def trigrams(text: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code, text index, byte position) of every symbol with the two before it; runs of white space are one gap, texts start with a gap."""
    s = _SYMBOL[text]
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] != 0) | (s[:-1] != 0)
    begin = offsets[:-1][np.diff(offsets) > 0]
    keep[begin] = s[begin] != 0
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[keep]
    s = s[keep].astype(np.int64)
    one, two = np.zeros(len(s), np.int64), np.zeros(len(s), np.int64)
    one[1:] = np.where(row[1:] == row[:-1], s[:-1], 0)
    two[2:] = np.where(row[2:] == row[:-2], s[:-2], 0)
    return two << 12 | one << 6 | s, row, np.flatnonzero(keep)


def _pairs(block: pa.RecordBatch, text: np.ndarray, offsets: np.ndarray):
    """(start, stop, text index, hash and pair key of every word, language class of every text)."""
    lang = np.array(block.column("cls").to_pylist(), np.int64)
    start, stop, doc, words = words_of(text, offsets)
    return start, stop, doc, words, word_pairs.pair_keys(words, doc, lang), lang


def _count(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """One row per language and trigram of a task; rows for its frequent contexts and the number of its word pairs."""
    totals: dict[int, np.ndarray] = {}
    often, every = word_pairs.Merged(), 0
    for block in blocks(batches, "text"):
        text, offsets = utf8(block, "text")
        code, row, _ = trigrams(text, offsets)
        _, _, _, _, keys, lang = _pairs(block, text, offsets)
        often.add(*word_pairs.frequent(keys, shards))
        every += len(keys)
        for c in np.unique(lang):
            own = totals.setdefault(int(c), np.zeros(1 << ORDER_BITS, np.int64))
            own += np.bincount(code[lang[row] == c], minlength=1 << ORDER_BITS)
    often.settle()
    schema = pa.schema([("cls", pa.int32()), ("gram", pa.int64()), ("n", pa.int64())])
    for c, own in totals.items():
        seen = np.flatnonzero(own)
        yield as_batch(schema, cls=np.full(len(seen), c), gram=seen, n=own[seen])
    yield as_batch(schema, cls=np.full(len(often.keys), PAIRED), gram=often.keys, n=often.counts)
    yield as_batch(schema, cls=[ALL], gram=[0], n=[every])


class KneserNey:
    """Trigram counts in arrays sorted by hash; log probabilities of a language are laid out when they are first needed."""

    def __init__(self, cls: np.ndarray, gram: np.ndarray, n: np.ndarray):
        keys = self._key(cls, gram)
        order = np.argsort(keys)
        self.keys, self.counts = keys[order], n[order]
        self.ready: dict[int, np.ndarray] = {}

    @staticmethod
    def _key(cls, gram) -> np.ndarray:
        return mix(np.asarray(cls, np.uint64) << np.uint64(ORDER_BITS) | np.asarray(gram, np.uint64))

    def counts_of(self, cls: int) -> np.ndarray:
        grams = np.arange(1 << ORDER_BITS)
        want = self._key(np.full(len(grams), cls), grams)
        at = np.searchsorted(self.keys, want).clip(0, max(len(self.keys) - 1, 0))
        return np.where(self.keys[at] == want, self.counts[at], 0) if len(self.keys) else np.zeros(len(grams), np.int64)

    def _level(self, c: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Interpolated probabilities of the last axis given the axes before it."""
        d = word_pairs.discounts(*((c == k).sum() for k in range(1, 5)))
        total = c.sum(axis=-1, keepdims=True)
        cut = d[np.minimum(c, 3)]
        seen = np.maximum(total, 1)
        return np.where(total > 0, np.maximum(c - cut, 0) / seen + cut.sum(axis=-1, keepdims=True) / seen * lower, lower)

    def surprise(self, cls: int) -> np.ndarray:
        """-log p of the third symbol of every trigram code."""
        if cls not in self.ready:
            c3 = self.counts_of(cls).reshape(64, 64, 64)
            c2 = (c3 > 0).sum(axis=0)  # in how many contexts a pair was seen
            c1 = (c2 > 0).sum(axis=0)
            p1 = self._level(c1, np.full(64, 1 / 64))
            p3 = self._level(c3, self._level(c2, p1[None, :])[None, :, :])
            self.ready[cls] = -np.log(p3).astype(np.float32).ravel()
        return self.ready[cls]


_RULES = pa.schema([("doc_id", pa.int64()), ("cls", pa.int32()), ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
                    ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64())])
_ROW = _RULES.append(pa.field("surprise", pa.float64()))
_ROW_DDL = "doc_id long, cls int, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, surprise double"


def _repeat_words(start: np.ndarray, doc: np.ndarray, words: np.ndarray, rows: int) -> np.ndarray:
    """Words of each text inside a window of five that it has twice or more."""
    n = len(words) - WINDOW + 1
    if n < 1:
        return np.zeros(rows, np.int64)
    key = doc[:n].astype(np.uint64)
    for j in range(WINDOW):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + words[j:j + n])
    whole = np.flatnonzero(doc[:n] == doc[WINDOW - 1:])
    _, which, times = np.unique(key[whole], return_inverse=True, return_counts=True)
    again = whole[times[which] > 1]
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, again, 1)
    np.add.at(cover, again + WINDOW, -1)
    return np.bincount(doc[np.cumsum(cover[:-1]) > 0], minlength=rows)


def _dup_lines(raw: bytes) -> int:
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def _spelled(text, offsets, start, stop, doc, lang, spelling: KneserNey) -> np.ndarray:
    """Surprise of every word's symbols and of the gap behind it, also where the text ends; the pair before it decides it."""
    code, row, position = trigrams(text, offsets)
    at = np.zeros(len(text), np.int32)
    at[position] = code
    end = (at[stop - 1] & 0xFFF) << 6
    cost, gap = np.zeros(len(text) + 1), np.zeros(len(start))
    for c in np.unique(lang):
        own, word = lang[row] == c, lang[doc] == c
        cost[position[own] + 1] = spelling.surprise(int(c))[code[own]]
        gap[word] = spelling.surprise(int(c))[end[word]]
    cost = np.cumsum(cost, out=cost)
    return cost[stop] - cost[start] + gap


def _rules_and_pairs(batches: Iterator[pa.RecordBatch], spelling, hot, shards: int) -> Iterator[pa.RecordBatch]:
    """For each unit of texts its rule counts (kind 0) and, for each shard, its word pairs (kind 1)."""
    task = TaskContext.get().partitionId()
    for number, block in enumerate(blocks(batches, "text", word_pairs.UNIT_BYTES)):
        text, offsets = utf8(block, "text")
        rows, unit = block.num_rows, task << 32 | number
        start, stop, doc, words, keys, lang = _pairs(block, text, offsets)
        raw = text.tobytes()
        within = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets])
        rules = as_batch(_RULES, doc_id=block.column("doc_id"), cls=lang, n_words=np.bincount(doc, minlength=rows),
                         word_chars=within(~_SPACE[text] & ((text & 0xC0) != 0x80)), n_symbols=within(_MARK[text]),
                         n_dup_lines=[_dup_lines(raw[a:b]) for a, b in zip(offsets, offsets[1:])],
                         n_repeat_words=_repeat_words(start, doc, words, rows))
        del raw
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, _RULES, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_batch(rules)
        yield as_batch(word_pairs.SENT, shard=[unit % shards], unit=[unit], kind=[0], body=[sink.getvalue().to_pybytes()])
        spell = _spelled(text, offsets, start, stop, doc, lang, spelling.value)
        for shard, body in word_pairs.send(keys, doc, spell, hot.value, shards):
            yield as_batch(word_pairs.SENT, shard=[shard], unit=[unit], kind=[1], body=[body])


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the shards' costs up for each unit and gives out its rows."""
    rules: dict[int, bytes] = {}
    costs: dict[int, np.ndarray] = {}
    for batch in batches:
        for unit, kind, body in zip(*(batch.column(c).to_pylist() for c in ("unit", "kind", "body"))):
            if kind == 0:
                rules[unit] = body
                continue
            gaps, cost = word_pairs.unsqueeze(body)
            texts = np.cumsum(gaps)
            have = costs.get(unit, np.zeros(0, np.int64))
            if len(have) <= texts[-1]:
                have = np.concatenate([have, np.zeros(texts[-1] + 1 - len(have), np.int64)])
            have[texts] += cost
            costs[unit] = have
    for unit, body in rules.items():
        for block in pa.ipc.open_stream(body):
            total = np.zeros(block.num_rows)
            have = costs.get(unit, np.zeros(0, np.int64))
            total[:len(have)] = have / word_pairs.COST
            yield as_batch(_ROW, **{c: block.column(c) for c in _RULES.names},
                           surprise=total / np.maximum(block.column("n_words").to_numpy(), 1))


def _classed(docs: DataFrame) -> DataFrame:
    rows = docs.select("doc_id", "text", F.coalesce("lang", F.lit("")).alias("lang"))
    top = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()
    number = docs.sparkSession.createDataFrame([(r["lang"], i) for i, r in enumerate(top)], "lang string, cls int")
    return rows.join(F.broadcast(number), "lang", "left").select("doc_id", "text", F.coalesce("cls", F.lit(LANGUAGES)).alias("cls"))


def train(classed: DataFrame, shards: int) -> tuple[KneserNey, np.ndarray]:
    """The spelling model, and the frequent contexts in order: those with at least one in 2 * shards of all word pairs."""
    counted = staged(classed.select("text", "cls").mapInArrow(partial(_count, shards=shards), "cls int, gram long, n long")
                     .groupBy("cls", "gram").agg(F.sum("n").alias("n")))
    table = counted.where("cls >= 0").toArrow()  # at most 32 * 2 ** 18 rows
    every = counted.where(F.col("cls") == ALL).agg(F.sum("n")).first()[0] or 0
    often = counted.where((F.col("cls") == PAIRED) & (F.col("n") * 2 * shards >= every)).select("gram").toArrow()  # at most 2 * shards rows
    return KneserNey(*(table.column(c).to_numpy() for c in ("cls", "gram", "n"))), np.sort(often.column("gram").to_numpy())


def totals_and_discounts(sent: RDD, spark: SparkSession, hot) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(frequent contexts, their totals and numbers of pairs, discounts by language class), from all pairs of all shards."""
    parts = spark.createDataFrame(sent.mapPartitions(partial(word_pairs.stats, hot=hot)), word_pairs.STATS_DDL)
    stats = parts.groupBy("kind", "key").agg(*[F.sum(f"n{k}").alias(f"n{k}") for k in range(1, 5)]).toArrow().to_pylist()  # at most 2 * shards + 32 rows
    sums = np.zeros((4, len(hot.value)), np.int64)
    cuts = np.tile(word_pairs.discounts(0, 0, 0, 0), (LANGUAGES + 1, 1))
    for r in stats:
        n = [r[f"n{k}"] for k in range(1, 5)]
        if r["kind"] == word_pairs.CONTEXT:
            sums[:, np.searchsorted(hot.value, r["key"])] = n
        else:
            cuts[r["key"]] = word_pairs.discounts(*n)
    return hot.value, sums, cuts


def surprises(classed: DataFrame) -> DataFrame:
    """Rule counts and mean surprise per word of every row."""
    spark = classed.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spelling, hot = (spark.sparkContext.broadcast(x) for x in train(classed, shards))
    sent = (classed.mapInArrow(partial(_rules_and_pairs, spelling=spelling, hot=hot, shards=shards), word_pairs.SENT_DDL)
            .repartitionById(shards, F.col("shard")).rdd)  # both readings of an RDD share one shuffle
    model = spark.sparkContext.broadcast(totals_and_discounts(sent, spark, hot))
    costs = spark.createDataFrame(sent.mapPartitions(partial(word_pairs.score, model=model)), word_pairs.SENT_DDL)
    return costs.repartition(shards, "unit").mapInArrow(_gather, _ROW_DDL)


def report(docs: DataFrame, above: float = ABOVE, below: float = BELOW) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, surprise of every document.

    Null text has no words and fails; a null language is a language of its own; repeated rows stay and count as often as they
    come; a null id is kept; an empty table gives an empty result; other columns are ignored.
    """
    rows = staged(surprises(_classed(docs)))
    band = (rows.where("n_words >= 10").groupBy("cls").agg(F.percentile_approx("surprise", [0.5, 0.75], 10_000).alias("q"))
            .select("cls", F.col("q")[0].alias("middle"), F.greatest(F.col("q")[1] - F.col("q")[0], F.lit(LEAST_SPREAD)).alias("step")))
    rows = rows.join(F.broadcast(band), "cls", "left")  # at most 32 rows
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    room = above * F.col("step") + SHORT / F.sqrt(F.greatest("n_words", F.lit(1)))
    upper = F.coalesce(F.col("surprise") <= F.col("middle") + room, F.lit(False))
    lower = F.coalesce(F.col("surprise") >= below * F.col("middle"), F.lit(False))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
                       (~failed & upper & lower).alias("kept"), "surprise")
