"""Source divergence audit with in-mapper stripes.

Every partition folds whole documents into stripes: a term of a language with its document frequency and its count in each
source.  A full table of stripes is spilled and started anew; the shuffle brings the stripes of a term together, packed by
a hash of the term, and one pass merges equal keys and drops the terms that too few documents have.  The merged stripes emit the divergences: for
every pair of sources partial sums, for every source its most over-used terms, both combined in the task first.

All numbers are integers.  A source's share of a term is p = 1 + floor(SCALE * (count + 2) / (N + 2 * V)), so a source
without the term has a share, too.  Sums over all terms start from "neither source has it" and are corrected by the
stripes: work follows the counts that are not zero, times the sources of the language.
"""
from __future__ import annotations

import heapq
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import partial
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rooftree.llm.common import as_batch, blocks, staged

LEAST_DOCS = 10
SCALE = 1_000_000_000
TOP = 10
ENTRIES = 400_000  # stripe entries that a task holds before it spills
HELD_BYTES = 32 << 20  # bytes of terms that it holds
CELLS = 1 << 20  # sums of pairs that it holds, and shares that it works on at once
BLOCK_TERMS = 4_096
BUCKETS = 4
_PIECE = 1 << 20
_FOLD = bytes(b if b >= 128 else (b | 32 if 65 <= b & 0xDF <= 90 else 32) for b in range(256))  # letters lower-cased, else a space


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in lists of bounded size."""
    at = 0
    while at < len(text):
        stop = len(text) if len(text) - at <= _PIECE else text.find(b" ", at + _PIECE)
        stop = len(text) if stop < 0 else stop
        yield text[at:stop].split()
        at = stop


_PACKED = pa.schema([("bucket", pa.int32()), ("lang", pa.string()), ("names", pa.list_(pa.string())), ("terms", pa.binary()), ("docs", pa.binary()),
                     ("entries", pa.binary()), ("sources", pa.binary()), ("counts", pa.binary())])
_PACKED_DDL = "bucket int, lang string, names array<string>, terms binary, docs binary, entries binary, sources binary, counts binary"
_STRIPES = pa.schema([("lang", pa.string()), ("term", pa.string()), ("docs", pa.int64()), ("sources", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])
_STRIPES_DDL = "lang string, term string, docs long, sources array<string>, counts array<long>"


def _cuts(size: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(size)]).astype(np.int64)


class _Stripes:
    """Document frequencies by language and counts by language and source; the empty term counts documents."""

    def __init__(self) -> None:
        self.docs: dict[str, Counter] = defaultdict(Counter)
        self.counts: dict[str, dict[str, Counter]] = defaultdict(lambda: defaultdict(Counter))
        self.entries = self.bytes = 0

    def add(self, lang: str, source: str, text: bytes) -> None:
        docs, counts = self.docs[lang], self.counts[lang][source]
        before, seen = len(counts), {b""}
        counts[b""] += 1
        for terms in _pieces(text.translate(_FOLD)):
            counts.update(terms)
            seen.update(terms)
        fresh = [t for t in seen if t not in docs]
        docs.update(seen)
        self.entries += len(fresh) + len(counts) - before
        self.bytes += sum(map(len, fresh))

    def rows(self, buckets: int) -> Iterator[pa.RecordBatch]:
        """All stripes, packed by the bucket of their term; the fold starts anew."""
        for lang, docs in self.docs.items():
            names, terms = list(self.counts[lang]), list(docs)
            held = [self.counts[lang][s] for s in names]
            place = {t: i for i, t in enumerate(terms)}
            term = np.concatenate([np.fromiter(map(place.__getitem__, c), np.int64, len(c)) for c in held])
            count = np.concatenate([np.fromiter(c.values(), np.int64, len(c)) for c in held])
            source = np.repeat(np.arange(len(held)), [len(c) for c in held]).astype(np.int32)
            bucket = np.fromiter(map(crc32, terms), np.int64, len(terms)) % buckets
            order = np.argsort(bucket, kind="stable")
            rank = np.empty(len(terms), np.int64)
            rank[order] = np.arange(len(terms))
            by_term = np.argsort(rank[term], kind="stable")
            source, count = source[by_term], count[by_term]
            entries = np.bincount(rank[term], minlength=len(terms)).astype(np.int32)
            frequency = np.fromiter(docs.values(), np.int64, len(docs))[order]
            used, first = np.unique(bucket[order], return_index=True)
            ends, reach = np.append(first, len(terms)), _cuts(entries)
            sorted_terms = [terms[i] for i in order.tolist()]
            spans = list(zip(ends.tolist(), ends[1:].tolist()))
            inner = [(int(reach[x]), int(reach[y])) for x, y in spans]
            for i in range(0, len(used), 256):
                part, within = spans[i:i + 256], inner[i:i + 256]
                yield as_batch(_PACKED, bucket=used[i:i + 256], lang=[lang] * len(part), names=pa.array([names] * len(part), _PACKED.field("names").type),
                               terms=[b" ".join(sorted_terms[x:y]) for x, y in part], docs=[frequency[x:y].tobytes() for x, y in part],
                               entries=[entries[x:y].tobytes() for x, y in part], sources=[source[x:y].tobytes() for x, y in within],
                               counts=[count[x:y].tobytes() for x, y in within])
        self.__init__()


def _fold(batches: Iterator[pa.RecordBatch], entries: int, buckets: int) -> Iterator[pa.RecordBatch]:
    stripes = _Stripes()
    for block in blocks(batches, "text"):
        for lang, source, text in zip(*(block.column(c).to_pylist() for c in ("lang", "source", "text"))):
            stripes.add(lang or "", source or "", (text or "").encode())
        if stripes.entries >= entries or stripes.bytes >= HELD_BYTES:
            yield from stripes.rows(buckets)
    yield from stripes.rows(buckets)


def _summed(rows: list[dict], least: int) -> Iterator[pa.RecordBatch]:
    """The stripes of one bucket and language, equal terms added up; those in fewer than ``least`` documents go."""
    terms = [t for r in rows for t in r["terms"].split(b" ")]
    coded = pa.array(terms, pa.binary()).dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    docs = np.zeros(len(coded.dictionary), np.int64)
    np.add.at(docs, code, np.concatenate([np.frombuffer(r["docs"], np.int64) for r in rows]))
    kept = docs >= least
    documents = coded.dictionary.index(pa.scalar(b"", pa.binary())).as_py()  # -1 if the empty term lies in another bucket
    if documents >= 0:
        kept[documents] = True
    names: dict[str, int] = {}
    source = np.concatenate([np.array([names.setdefault(n, len(names)) for n in r["names"]])[np.frombuffer(r["sources"], np.int32)] for r in rows])
    owner = np.repeat(code, np.concatenate([np.frombuffer(r["entries"], np.int32) for r in rows]))
    count = np.concatenate([np.frombuffer(r["counts"], np.int64) for r in rows])
    stay = kept[owner]
    entry, inverse = np.unique(owner[stay] * len(names) + source[stay], return_inverse=True)
    total = np.zeros(len(entry), np.int64)
    np.add.at(total, inverse, count[stay])
    which, size = np.unique(entry // len(names), return_counts=True)
    ends = pa.array(_cuts(size).astype(np.int32))
    lists = pa.ListArray.from_arrays(ends, pa.array(list(names), pa.string()).take(pa.array(entry % len(names)))), pa.ListArray.from_arrays(ends, pa.array(total))
    out = pa.RecordBatch.from_arrays([pa.array([rows[0]["lang"]] * len(which), pa.string()), coded.dictionary.take(pa.array(which)).cast(pa.string()),
                                      pa.array(docs[which]), *lists], schema=_STRIPES)
    yield from (out.slice(i, 1 << 12) for i in range(0, out.num_rows, 1 << 12))


def _merge(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (bucket, lang)."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and (row["bucket"], row["lang"]) != (held[0]["bucket"], held[0]["lang"]):
                yield from _summed(held, least)
                held = []
            held.append(row)
    if held:
        yield from _summed(held, least)


def stripes(docs: DataFrame, least: int = LEAST_DOCS, entries: int = ENTRIES) -> DataFrame:
    """Merged stripes (lang, term, docs, sources, counts) of the terms in ``least`` documents of a language or more.

    The stripe of the empty term has the number of documents of each source.  Stripes travel packed by a hash of the term,
    ``BUCKETS`` buckets for each shuffle partition, so what a task merges at once is a small part of its share.
    """
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = docs.select("lang", "source", "text").mapInArrow(partial(_fold, entries=entries, buckets=BUCKETS * tasks), _PACKED_DDL)
    packed = packed.repartition(tasks, "bucket").sortWithinPartitions("bucket", "lang")
    return packed.mapInArrow(partial(_merge, least=least), _STRIPES_DDL)


# --- divergences ---------------------------------------------------------------------------------------------------------------

def shares(count: np.ndarray, total: np.ndarray | int, terms: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 2) / (total + 2 * terms)), exact for any count."""
    count, total = np.asarray(count), np.asarray(total)
    if count.max(initial=0) >= 1 << 33:  # the product would not fit a long
        count, total = count.astype(object), total.astype(object)
    return (1 + SCALE * (count + 2) // (total + 2 * terms)).astype(np.int64)


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


_OUT = pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64())])


class _Sums:
    """Pair sums and the best terms of the languages that a task meets."""

    def __init__(self, top: int) -> None:
        self.top, self.cells = top, 0
        self.pairs: dict[tuple[str, str], tuple[list[str], np.ndarray]] = {}
        self.other: dict[tuple[str, str], tuple[list[str], np.ndarray]] = {}
        self.best: dict[tuple[str, str], list] = defaultdict(list)

    def take(self, lang: str, terms: list[str], sources: list[list[str]], counts: list[list[int]], names: list[str], totals: list[int], n_terms: int) -> None:
        place = {s: i for i, s in enumerate(names)}
        step = max(1, CELLS // len(names))
        ordered = sorted(range(len(terms)), key=lambda i: terms[i].encode())
        for a in range(0, len(terms), step):
            some = ordered[a:a + step]
            size = [len(sources[i]) for i in some]
            self._add(lang, [terms[i] for i in some], np.repeat(np.arange(len(some)), size), np.array([place[s] for i in some for s in sources[i]], np.int64),
                      np.array([c for i in some for c in counts[i]], np.int64), names, np.array(totals, np.int64), n_terms)

    def _add(self, lang: str, terms: list[str], row: np.ndarray, at: np.ndarray, count: np.ndarray, names: list[str], totals: np.ndarray, n_terms: int) -> None:
        """Entries (row: term, at: source, count); ``terms`` are in order."""
        absent = shares(np.zeros(len(names), np.int64), totals, n_terms)
        p = np.tile(absent, (len(terms), 1))
        own = p[row, at] = shares(count, totals[at], n_terms)
        lacks = np.ones(p.shape, bool)
        lacks[row, at] = False
        whole = np.zeros(len(terms), np.int64)
        np.add.at(whole, row, count)
        q = shares(whole, int(totals.sum()), n_terms)[row]
        order = np.argsort(at, kind="stable")
        step = max(1, CELLS // len(names))
        for i in range(0, len(order), step):
            e = order[i:i + step]
            change = divergence(own[e, None], p[row[e]]) - divergence(absent[at[e], None], absent[None, :])
            first = np.flatnonzero(np.diff(at[e], prepend=-1))
            one_sided = np.where(lacks[row[e]], change, 0)  # the other source of the pair does not meet this term
            for s, both, single in zip(at[e][first], np.add.reduceat(change, first), np.add.reduceat(one_sided, first)):
                self._row(self.pairs, lang, names, s)[:] += both
                self._row(self.other, lang, names, s)[:] += single
        over = np.flatnonzero(own > q)
        value = divergence(own[over], q[over])
        ranked = np.lexsort((row[over], -value, at[over]))
        first = np.flatnonzero(np.diff(at[over][ranked], prepend=-1))
        for lo, hi in zip(first, np.append(first[1:], len(ranked))):
            for j in ranked[lo:min(hi, lo + self.top)]:
                self._offer((lang, names[at[over[j]]]), int(value[j]), terms[row[over[j]]])

    def _row(self, held: dict, lang: str, names: list[str], i: int) -> np.ndarray:
        row = held.get((lang, names[i]))
        if row is None:
            row = held[lang, names[i]] = (names, np.zeros(len(names), np.int64))
            self.cells += len(names)
        return row[1]

    def _offer(self, group: tuple[str, str], value: int, term: str) -> None:
        best = self.best[group]
        best.append((-value, term.encode(), term))
        if len(best) >= 16 * self.top:
            best[:] = heapq.nsmallest(self.top, best)

    def rows(self) -> Iterator[pa.RecordBatch]:
        out = []
        for (lang, s), (names, row) in self.pairs.items():
            out += [(lang, s, "pair", o, int(v)) for o, v in zip(names, row) if o != s and v]
        for (lang, s), (names, row) in self.other.items():
            out += [(lang, o, "pair", s, int(v)) for o, v in zip(names, row) if o != s and v]
        for (lang, s), best in self.best.items():
            out += [(lang, s, "term", term, -v) for v, _, term in heapq.nsmallest(self.top, best)]
        self.__init__(self.top)
        for i in range(0, len(out), 1 << 15):
            yield as_batch(_OUT, **dict(zip(_OUT.names, zip(*out[i:i + (1 << 15)]))))


def _emit(batches: Iterator[pa.RecordBatch], top: int, cells: int) -> Iterator[pa.RecordBatch]:
    sums = _Sums(top)
    for batch in batches:
        for row in batch.to_pylist():
            sums.take(row["lang"], [t["term"] for t in row["block"]], [t["sources"] for t in row["block"]], [t["counts"] for t in row["block"]],
                      [g["source"] for g in row["groups"]], [g["total"] for g in row["groups"]], row["terms"])
            if sums.cells >= cells:
                yield from sums.rows()
    yield from sums.rows()


def audit(docs: DataFrame, least: int = LEAST_DOCS, top: int = TOP, entries: int = ENTRIES, cells: int = CELLS, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): divergence of every two sources of a language, and each source's most over-used terms.

    Null text, lang and source count as ''; a text without terms still makes its source a group; repeated rows are documents
    of their own; equal values are ranked by the item's UTF-8 bytes; very long texts are folded piece by piece; a language of
    one source has terms but no pairs, one without kept terms has pairs of value 0; an empty table gives an empty result;
    other columns are ignored.
    """
    merged = staged(stripes(docs, least, entries))
    kept = merged.where("term <> ''")
    entry = F.explode(F.arrays_zip("sources", "counts")).alias("e")
    met = merged.select("lang", "term", entry).select("lang", F.col("e.sources").alias("source"), F.when(F.col("term") != "", F.col("e.counts")).otherwise(0).alias("n"))
    totals = met.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    terms = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"))
    # a language's groups, one row a language: as many as the square root of the pairs that the result lists
    langs = totals.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", "total"))).alias("groups"))
    langs = staged(langs.join(terms, "lang", "left").withColumn("terms", F.coalesce("terms", F.lit(0).cast("long"))))
    slots = max(1, -(-kept.count() // block_terms))
    packed = (kept.groupBy("lang", F.pmod(F.xxhash64("term"), F.lit(slots)).alias("slot"))
              .agg(F.collect_list(F.struct("term", "sources", "counts")).alias("block")))
    emitted = packed.join(langs, "lang").select("lang", "block", "groups", "terms").mapInArrow(
        partial(_emit, top=top, cells=cells), "lang string, source string, part string, item string, value long")
    emitted = staged(emitted)
    share_of = "1 + CAST({} AS DECIMAL(38, 0)) DIV nullif(CAST({} + 2 * terms AS DECIMAL(38, 0)), 0)"
    every = langs.select("lang", "terms", "groups", F.explode("groups").alias("own")).repartition("lang", "own")
    every = every.select("lang", "terms", "own", F.explode("groups").alias("other")).where("own.source <> other.source")
    every = every.withColumns({"p": F.expr(share_of.format(2 * SCALE, "own.total")), "q": F.expr(share_of.format(2 * SCALE, "other.total"))})
    start = every.select("lang", F.col("own.source").alias("source"), F.col("other.source").alias("item"),
                         F.expr("coalesce(terms * ((p - q) * (p - q) DIV (p + q)), 0)").alias("value"))
    pairs = start.unionByName(emitted.where("part = 'pair'").drop("part")).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    best = emitted.where("part = 'term'").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.unionByName(best)


SQL = """
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT k, lang, source, unnest(regexp_extract_all(t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT k) >= 10),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN kept ON w.lang = kept.lang AND w.term = kept.term GROUP BY w.lang, w.source, w.term),
gt AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n FROM g JOIN kept k ON g.lang = k.lang
    LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
tot AS (SELECT lang, source, sum(n) AS total FROM gt GROUP BY lang, source),
p AS (SELECT gt.lang, gt.source, gt.term, gt.n, CAST(1 + (1000000000 * (gt.n + 2)) // (tot.total + 2 * v.v) AS BIGINT) AS p
    FROM gt JOIN tot ON gt.lang = tot.lang AND gt.source = tot.source JOIN v ON gt.lang = v.lang),
wt AS (SELECT gt.lang, gt.term, sum(n) AS n FROM gt GROUP BY gt.lang, gt.term),
wn AS (SELECT lang, sum(n) AS total FROM wt GROUP BY lang),
q AS (SELECT wt.lang, wt.term, CAST(1 + (1000000000 * (wt.n + 2)) // (wn.total + 2 * v.v) AS BIGINT) AS q
    FROM wt JOIN wn ON wt.lang = wn.lang JOIN v ON wt.lang = v.lang),
pv AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(pv.value, 0) AS BIGINT) AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pv ON pv.lang = a.lang AND pv.source = a.source AND pv.item = b.source),
terms AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, ((p.p - q.q) * (p.p - q.q)) // (p.p + q.q) AS value
    FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE p.n > 0 AND p.p > q.q),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms) u)
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 10
"""
