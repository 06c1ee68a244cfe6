"""Near duplicates: universal hash minima with banding, links confirmed on full sets, components by alternating stars.

Texts with equal shingle sets are one class from the start.  A class puts its bands into buckets; in each bucket every
member is compared with the bucket's hub, the member whose buckets are fullest, so near copies of one text share few hubs
and a bucket never emits its pairs.  Large-star and small-star rounds turn confirmed links into components.  A bucket that
still holds several components may hide links that do not pass through a hub: there the members outside the largest
component are compared with all members on full sets, in blocks of ``BLOCK`` members, and one link for each pair of
components is enough.  Two texts of similarity 0.8 share no bucket with a chance of 5 in 10 ** 8.
"""
from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rooftree.llm.common import as_batch, blocks, free_name, mix, staged, utf8, words_of

SHINGLE = 4
BANDS, ROWS = 32, 4
PERCENT = 80
BLOCK = 1_024
NO_ID = (1 << 63) - 1  # stands for a null id
_K = np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)
_MUL, _ADD = mix(_K * np.uint64(0xA24BAED4963EE407)) | np.uint64(1), mix(_K * np.uint64(0x9FB21C651E98DF25))
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: np.ndarray, offsets: np.ndarray, width: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer words than ``width`` are one shingle, no word is none."""
    _, _, doc, words = words_of(text, offsets, lower=True)
    first = np.searchsorted(doc, np.arange(len(offsets)))
    n = len(words) - width + 1
    key = np.full(max(n, 0), width, np.uint64)
    for j in range(width):
        key = mix(key * _STEP + words[j:j + n]) if n > 0 else key
    out = []
    for a, b in zip(first, first[1:]):
        if b - a >= width:
            out.append(np.unique(key[a:b - width + 1]))
        elif b > a:
            short = np.uint64(b - a)
            for w in words[a:b]:
                short = mix(np.array([short]) * _STEP + w)[0]
            out.append(np.array([short]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def minima(items: np.ndarray) -> np.ndarray:
    """One 64-bit word per band: four minima of 16 bits each."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(items), 1024):
        np.minimum(least, (_MUL[:, None] * items[None, a:a + 1024] + _ADD[:, None]).min(axis=1), out=least)
    return (mix(least) & np.uint64(0xFFFF)).astype(np.uint16).view(np.int64)


_SIGNED = pa.schema([("doc", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("bands", pa.list_(pa.int64()))])
_SIGNED_DDL = "doc long, n long, s1 long, s2 long, bands array<long>"


def _sign(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches, "text"):
        sets = shingles(*utf8(block, "text"), width)
        yield as_batch(_SIGNED, doc=block.column("doc"), n=[len(s) for s in sets], s1=[int(mix(s).sum().view(np.int64)) for s in sets],
                       s2=[int(np.bitwise_xor.reduce(mix(s + _STEP)).view(np.int64)) if len(s) else 0 for s in sets],
                       bands=pa.array([minima(s) if len(s) else [] for s in sets], _SIGNED.field("bands").type))


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)) or not len(a):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


_EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _confirm(batches: Iterator[pa.RecordBatch], width: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs (hub, member) that are linked; rows come sorted by hub."""
    hub, hub_set = None, np.zeros(0, np.uint64)
    for block in blocks(batches, "text"):
        found = []
        others = block.column("hub_text")
        for i, (a, b, own) in enumerate(zip(block.column("hub").to_pylist(), block.column("cid").to_pylist(), shingles(*utf8(block, "text"), width))):
            if a != hub:
                raw = others[i].as_py().encode()
                hub, hub_set = a, shingles(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), width)[0]
            if _linked(own, hub_set, percent):
                found.append((a, b))
        if found:
            yield as_batch(_EDGE, a=[f[0] for f in found], b=[f[1] for f in found])


def _compare_blocks(batches: Iterator[pa.RecordBatch], width: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Links between components of one bucket; rows come sorted by unit (bucket and block), members before the asking ones."""
    unit, members, ready = None, [], None
    for block in blocks(batches, "text"):
        found = set()
        sets = shingles(*utf8(block, "text"), width)
        for key, part, asks, comp, own in zip(block.column("bucket").to_pylist(), block.column("part").to_pylist(), block.column("asks").to_pylist(),
                                              block.column("comp").to_pylist(), sets):
            if (key, part) != unit:
                unit, members, ready = (key, part), [], None
            if not asks:
                members.append((comp, own))
                continue
            if not members or not len(own):
                continue
            if ready is None:
                joined = np.concatenate([m[1] for m in members])
                owner = np.repeat(np.arange(len(members)), [len(m[1]) for m in members])
                order = np.argsort(joined, kind="stable")
                ready = joined[order], owner[order], np.array([len(m[1]) for m in members]), np.array([m[0] for m in members])
            items, owner, sizes, comps = ready
            lo, hi = np.searchsorted(items, own), np.searchsorted(items, own, side="right")
            hit = lo < hi
            spans = [owner[x:y] for x, y in zip(lo[hit], hi[hit])]
            common = np.bincount(np.concatenate(spans), minlength=len(sizes)) if spans else np.zeros(len(sizes), np.int64)
            for other in np.unique(comps[(100 * common >= percent * (len(own) + sizes - common)) & (comps != comp)]):
                found.add((comp, int(other)))
        if found:
            yield as_batch(_EDGE, a=[f[0] for f in found], b=[f[1] for f in found])


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for all nodes of ``edges`` (a, b): alternating large-star and small-star until nothing changes."""
    edges = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = staged(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct())


def near_duplicates(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document.

    Null text and text without words have an empty set and are linked with nothing; rows that share an id share its links;
    repeated rows stay; a null id counts as the largest one and comes back as null; ties go to the smaller id; an empty table
    gives an empty result; other columns are ignored.
    """
    rows = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), "text")
    signed = staged(rows.mapInArrow(partial(_sign, width=width), _SIGNED_DDL))
    classes = staged(signed.where("n > 0").groupBy("s1", "s2", "n").agg(F.min("doc").alias("cid"), F.first("bands").alias("bands")))
    comps = _components_of(rows, classes, width, percent, block)
    mapped = classes.select("s1", "s2", "n", "cid").join(comps, F.col("cid") == F.col("node"), "left")
    mapped = mapped.select("s1", "s2", "n", F.coalesce("comp", "cid").alias("comp"))
    out = signed.drop("bands").join(mapped, ["s1", "s2", "n"], "left")
    comp = F.coalesce("comp", "doc")
    return out.select(F.nullif("doc", F.lit(NO_ID)).alias("doc_id"), F.col("n").alias("n_shingles"),
                      F.nullif(comp, F.lit(NO_ID)).alias("component_id"), (F.col("doc") == comp).alias("kept"))


def _components_of(rows: DataFrame, classes: DataFrame, width: int, percent: int, block: int) -> DataFrame:
    bands = classes.select("cid", F.posexplode("bands").alias("band", "value")).select(F.xxhash64("band", "value").alias("bucket"), "cid")
    sizes = bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = staged(bands.join(sizes, "bucket"))
    fullness = members.groupBy("cid").agg(F.sum("size").alias("full"))
    texts = staged(rows.withColumnRenamed("doc", "cid").join(fullness, "cid", "left_semi"))
    hubs = (members.join(fullness, "cid").groupBy("bucket").agg(F.max(F.struct("full", (-F.col("cid")).alias("least"))).alias("top"))
            .select("bucket", (-F.col("top.least")).alias("hub")))
    stars = members.join(hubs, "bucket").where("cid <> hub").select("hub", "cid").distinct()
    pairs = stars.join(texts, "cid").join(texts.select(F.col("cid").alias("hub"), F.col("text").alias("hub_text")), "hub").sortWithinPartitions("hub")
    links = pairs.mapInArrow(partial(_confirm, width=width, percent=percent), "a long, b long")
    first = staged(components(links))
    # buckets that still hold several components: members outside the largest one are compared with all members
    known = members.join(first, F.col("cid") == F.col("node"), "left").select("bucket", "cid", "size", F.coalesce("comp", "cid").alias("comp"))
    shares = known.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("k"))
    main = (shares.groupBy("bucket").agg(F.count(F.lit(1)).alias("comps"), F.max(F.struct("k", "comp")).alias("top")).where("comps > 1")
            .select("bucket", F.col("top.comp").alias("main")))
    open_ = staged(known.join(main, "bucket"))
    parts = F.ceil(F.col("size") / block).cast("int")
    held = open_.select("bucket", F.pmod(F.xxhash64("cid"), parts).cast("int").alias("part"), F.lit(False).alias("asks"), "cid", "comp")
    asking = open_.where("comp <> main").select("bucket", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), F.lit(True).alias("asks"), "cid", "comp")
    units = held.unionByName(asking).join(texts, "cid").select("bucket", "part", "asks", "comp", "text")
    units = units.repartition("bucket", "part").sortWithinPartitions("bucket", "part", "asks")
    late = units.mapInArrow(partial(_compare_blocks, width=width, percent=percent), "a long, b long").distinct()
    merged = components(late).select(F.col("node").alias("part"), F.col("comp").alias("whole"))
    moved = first.join(merged, F.col("comp") == F.col("part"), "left").select("node", F.coalesce("whole", "comp").alias("comp"))
    lone = merged.join(first.select("node"), F.col("part") == F.col("node"), "left_anti")  # without a link of the first kind
    return moved.unionByName(lone.select(F.col("part").alias("node"), F.col("whole").alias("comp")))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each group of near duplicates, all columns kept."""
    key, id_ = free_name(docs, "key"), F.coalesce("doc_id", F.lit(NO_ID))
    stays = near_duplicates(docs).where("kept").select(id_.alias(key)).distinct()
    return docs.withColumn(key, id_).join(stays, key, "left_semi").select(*docs.columns)
