"""Hard negatives, source divergence and SimHash against brute force, on awkward rows and under forced splits."""
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex
import xxhash

from rooftree.llm import divergence, hard_negatives, simhash
from test_training_data import AWKWARD, SCHEMA, docs, empty, rows, small  # noqa: F401

VECTORS = "vec_id long, embedding array<float>, label int, id long, key long, code string, block int, limits int"


# --- hard negatives ------------------------------------------------------------------------------------------------------------

def brute_negatives(vectors, k=5):
    part = {}
    for vec_id, vec, label in {(i, tuple(v) if v is not None else None, la) for i, v, la in vectors}:
        if vec_id is None or vec is None or label is None or any(x is None or not np.isfinite(x) for x in vec):
            continue
        if vec_id % 7 == 0:
            label = (label + 1) % 10
        part[vec_id, label, tuple(int(np.floor(256 * float(np.float32(x)))) for x in vec)] = None
    out = []
    for a, a_label, a_code in part:
        if a % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a_code, code)), i, label) for i, label, code in part if i != a)
        for s, p, label in [x for x in scored if x[2] == a_label][:k]:
            found = [x for x in scored if x[2] != a_label and 80 * -s <= 100 * -x[0] <= 100 * -s][:k]
            out += [(a, p, r, i, -s, -t) for r, (t, i, _) in enumerate(found, 1)]
    return sorted(out)


def mined(df, **more):
    return sorted(tuple(r) for r in hard_negatives.mine(df, **more).collect())


@pytest.mark.parametrize("block_bytes", [1 << 25, 700])
def test_hard_negatives_equal_brute_force(spark, block_bytes):
    rng = random.Random(3)
    vectors = [(i, [rng.choice([0.1, 0.2, 0.35, -0.1, 0.6]) for _ in range(4)], rng.randrange(4)) for i in range(0, 420, 2)]
    vectors += [(1, None, 1), (3, [0.1, None, 0.2, 0.1], 1), (5, [float("nan")] * 4, 2), (9, [float("inf"), 0.0, 0.0, 0.0], 2), (11, [0.1] * 4, None),
                (None, [0.3] * 4, 1), (13, [], 1), (15, [0.5, 0.5], 0)] + vectors[:3]
    df = spark.createDataFrame([(*v, 1, 2, "x", 3, 4) for v in vectors], VECTORS).repartition(3)
    want = brute_negatives(vectors)
    assert want and mined(df, block_bytes=block_bytes) == want


def test_hard_negatives_of_an_empty_table(spark):
    assert mined(spark.createDataFrame([], VECTORS)) == []


def test_scores_beyond_doubles_stay_exact():
    a, b = np.array([[1 << 40, 3], [1 << 62, 1 << 62]], np.int64), np.array([[1 << 20, 1], [1 << 62, 1 << 62]], np.int64)
    assert hard_negatives._products(a, b).tolist() == [[(1 << 60) + 3, (1 << 63) - 1], [(1 << 63) - 1, (1 << 63) - 1]]


def test_suffix_merges_answer_all_windows():
    rng = random.Random(5)
    limits = np.array([90, 70, 40], np.int64)
    scored = [(rng.randrange(100), i) for i in range(60)]
    slot = hard_negatives.slot_of(np.array([s for s, _ in scored]), limits)
    slots = [sorted((x for x, at in zip(scored, slot) if at == j), key=lambda x: (-x[0], x[1]))[:4] for j in range(3)]
    for limit, found in zip(limits, hard_negatives.suffix_merges(slots, 4)):
        assert found == sorted((x for x in scored if x[0] <= limit), key=lambda x: (-x[0], x[1]))[:4]


# --- source divergence ---------------------------------------------------------------------------------------------------------

def brute_audit(docs, least, top=10):
    docs = [(t or "", la or "", s or "") for t, la, s in docs]
    docs = [("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t), la, s) for t, la, s in docs]
    terms = [regex.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t) for t, _, _ in docs]
    out = []
    for lang in {d[1] for d in docs}:
        frequency, counts, whole = Counter(), defaultdict(Counter), Counter()
        for (_, la, source), found in zip(docs, terms):
            if la == lang:
                frequency.update(set(found))
                counts[source].update(found)
        kept = {t for t, n in frequency.items() if n >= least}
        for c in counts.values():
            whole.update({t: n for t, n in c.items() if t in kept})

        def shares(c):
            total = sum(n for t, n in c.items() if t in kept)
            return {t: 1 + 10 ** 9 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}
        by = {s: shares(c) for s, c in counts.items()}
        q = shares(whole)

        def f(x, y):
            return (x - y) ** 2 // (x + y)
        for s, p in by.items():
            pairs = sorted(((sum(f(p[t], r[t]) for t in kept), o) for o, r in by.items() if o != s), key=lambda x: (-x[0], x[1].encode()))
            best = sorted(((f(p[t], q[t]), t) for t in kept if counts[s][t] and p[t] > q[t]), key=lambda x: (-x[0], x[1].encode()))[:top]
            out += [(lang, s, part, item, v, r) for part, found in (("pair", pairs), ("term", best)) for r, (v, item) in enumerate(found, 1)]
    return sorted(out)


def audited(df, **more):
    return sorted(tuple(r) for r in divergence.audit(df, **more).select("lang", "source", "part", "item", "value", "rank").collect())


@pytest.mark.parametrize("more", [{}, {"entries": 1, "cells": 1, "block_terms": 2}])
def test_audit_equals_brute_force(spark, docs, small, more):  # noqa: F811
    assert audited(docs, least=2, **more) == brute_audit([(r[1], r[2], r[3]) for r in AWKWARD], 2)
    table = small.where("doc_id < 80").unionByName(small.where("doc_id < 5"))
    assert audited(table, least=5, **more) == brute_audit([(r["text"], r["lang"], r["source"]) for r in table.collect()], 5)


def test_audit_of_odd_letters_and_many_sources(spark):
    table = [(i, t, "x", f"s{i % 40}", i) for i, t in enumerate(["Ünder İ ß K Zz zZ zz-zz 1a2b   é́"] * 60 + [None, "", "123 ..."] + ["zz"] * 30)]
    df = spark.createDataFrame(table, "doc_id long, text string, lang string, source string, docs long")
    assert audited(df) == brute_audit([r[1:4] for r in table], 10)


def test_audit_of_an_empty_table(empty):  # noqa: F811
    assert audited(empty) == []


def test_long_texts_are_folded_in_pieces(monkeypatch):
    monkeypatch.setattr(divergence, "_PIECE", 7)
    text = b"alpha be alpha verylongtermhere be x" * 3
    assert [t for part in divergence._pieces(text) for t in part] == text.split()


# --- SimHash -------------------------------------------------------------------------------------------------------------------

def brute_fingerprint(text, width=3):
    words = regex.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(words[i:i + width]) for i in range(max(len(words) - width + 1, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(items, distance=3):
    """items: (doc_id, fingerprint); the smallest id reachable, for each item."""
    parent = list(range(len(items)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(items)):
        for j in range(i):
            if (items[i][1] ^ items[j][1]).bit_count() <= distance:
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(items):
        least[root(i)] = min(least.get(root(i), simhash.NO_ID), simhash.NO_ID if doc_id is None else doc_id)
    return [None if least[root(i)] == simhash.NO_ID else least[root(i)] for i in range(len(items))]


def grouped(df, **more):
    return sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(df, **more).collect()), key=str)


def test_fingerprints_and_components_equal_brute_force(docs, small):  # noqa: F811
    for table in (docs, small):
        items = [(r["doc_id"], brute_fingerprint(r["text"])) for r in table.collect()]
        assert grouped(table) == sorted(((d, f"{p:016x}", c) for (d, p), c in zip(items, brute_components(items))), key=str)


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    monkeypatch.setattr(simhash, "_PIECE", 4)
    text = " ".join(f"w{i * 7 % 13}" for i in range(50)) + "\x0bEnd É"
    assert simhash.fingerprint(text.encode()) == brute_fingerprint(text)


@pytest.mark.parametrize("bucket", [256, 2, 3])
def test_links_connect_all_close_fingerprints(spark, bucket):
    rng = random.Random(bucket)
    prints = {rng.getrandbits(64) for _ in range(20)}
    for p in list(prints)[:6]:  # dense neighbourhoods and chains, so buckets overflow at several depths
        for _ in range(25):
            for b in rng.sample(range(64), rng.randrange(1, 5)):
                p ^= 1 << b
            prints.add(p)
    centre = rng.getrandbits(64)
    prints |= {centre ^ sum(1 << b for b in rng.sample(range(8), rng.randrange(4))) for _ in range(60)}
    items = [(i, p) for i, p in enumerate(sorted(prints))]
    df = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for _, p in items], "fp long")
    found = simhash.links(df, bucket=bucket).collect()
    mask = (1 << 64) - 1
    parent = {p: p for _, p in items}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p
    for a, b in found:
        parent[root(a & mask)] = root(b & mask)
    want = brute_components(items)
    least = {}
    for i, p in items:
        least.setdefault(root(p), i)
    assert [least[root(p)] for _, p in items] == want


def test_masks_cover_every_close_pair():
    for mask in simhash.block_masks():
        finer = simhash.finer_masks(mask)
        assert len(finer) == 4 and all(m & mask == mask for m in finer)
        union = 0
        for m in finer:
            assert not union & (m ^ mask)
            union |= m ^ mask
        assert union | mask == (1 << 64) - 1


def test_simhash_of_an_empty_table(empty):  # noqa: F811
    assert grouped(empty) == []
