"""The pipeline's stages against brute force, with planted copies and passages and with columns of every internal name."""
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from rooftree.llm import classifier, minhash
from test_training_data import FOLDER, here

CLASH = ["doc", "rk", "row", "spans", "key", "sha", "score", "__doc", "__rk", "__spans", "__score", "__id", "__sha", "slot", "bucket", "anchor", "fp"]
WORDS = [f"{a}{b}" for a in ("lor", "ips", "dol", "sit", "amet", "cons", "adip", "elit", "sed", "tempor") for b in ("a", "em", "or", "is", "un", "et", "ix")]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(1000)) for _ in range(n))


@pytest.fixture(scope="module")
def planted():
    """(doc_id, text): clean texts, exact and near copies, and passages of 51 words that several texts share."""
    rng = random.Random(11)
    clean = [prose(rng, rng.randrange(80, 200)) for _ in range(40)]
    passages = [" ".join(rng.choice(WORDS)[:4] for _ in range(51)) + " " + prose(rng, 9) for _ in range(3)]
    texts = list(clean)
    texts += [clean[0], clean[0] + " \n", re.sub(" ", "  ", clean[1])]  # exact copies, but for white space
    texts += [clean[2] + " tail", " ".join(clean[3].split()[2:])]  # near copies
    texts += [f"{prose(rng, 60)} {p} {prose(rng, 60)}" for p in passages for _ in range(3)]
    texts += [None, "", " ", "few words"]
    rows = list(enumerate(texts)) + [(0, clean[0]), (None, prose(rng, 90))]
    return rows, clean, passages


@pytest.fixture(scope="module")
def docs(spark, planted):
    schema = ", ".join(["doc_id long", "text string", "lang string", "source string", "n_chars long", *(f"`{c}` string" for c in CLASH)])
    return spark.createDataFrame([(i, t, "en", f"s{n % 3}", len(t or ""), *CLASH) for n, (i, t) in enumerate(planted[0])], schema).repartition(3)


def kept(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def as_sorted(rows):
    return sorted(rows, key=str)


def test_exact_stage_keeps_one_of_each_group(spark, docs, planted):
    out = corpus_pipeline.exact(spark, docs, FOLDER)
    assert out.columns == docs.columns
    groups = defaultdict(list)
    for i, t in planted[0]:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), (1 << 63) if i is None else i, i, t))
    assert as_sorted(kept(out)) == as_sorted((i, t) for _, _, i, t in (min(g, key=lambda x: x[:2]) for g in groups.values()))


def brute_near(rows):
    """The rows that stay: the smallest id of each component of linked shingle sets."""
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        sets.append({tuple(w[i:i + 4]) for i in range(max(len(w) - 3, 1))} if w else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    ids = [minhash.NO_ID if i is None else i for i, _ in rows]
    for n, i in enumerate(ids):
        least[root(n)] = min(least.get(root(n), minhash.NO_ID), i)
    stay = {i for n, i in enumerate(ids) if least[root(n)] == i}
    return [r for r, i in zip(rows, ids) if i in stay]


def test_near_stage_keeps_one_of_each_component(spark, docs, planted):
    out = corpus_pipeline.near(spark, docs, FOLDER)
    assert out.columns == docs.columns
    assert as_sorted(kept(out)) == as_sorted(brute_near(planted[0]))


def brute_passages(rows, length):
    seen = defaultdict(int)
    for _, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - length + 1):
            seen[b[i:i + length]] += 1
    out = []
    for i, t in rows:
        b, gone = (t or "").encode(), np.zeros(len((t or "").encode()), bool)
        for at in range(len(b) - length + 1):
            if seen[b[at:at + length]] > 1:
                gone[at:at + length] = True
        out.append((i, t if t is None else bytes(np.frombuffer(b, np.uint8)[~gone]).decode(errors="ignore")))
    return out


def test_passage_stage_removes_planted_passages_and_leaves_clean_texts(spark, docs, planted):
    rows, clean, passages = planted
    once = docs.where("doc_id >= 1 AND (doc_id < 40 OR doc_id >= 45)")  # without copies
    out = corpus_pipeline.passages(spark, once, FOLDER)
    assert out.columns == docs.columns
    got = kept(out)
    assert as_sorted(got) == as_sorted(brute_passages(kept(once), corpus_pipeline.PASSAGE_BYTES))
    assert not any(p in (t or "") for _, t in got for p in passages)
    assert {t for i, t in got if i is not None and 1 <= i < 40} == set(clean[1:])


@here
def test_quality_stage_keeps_what_the_classifier_does_not_reject(spark, docs):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = corpus_pipeline.quality(spark, table, FOLDER)
    good = [r.doc_id for r in classifier.report(table, labels).where("predicted = 1").collect()]
    assert out.columns == table.columns and sorted(r.doc_id for r in out.collect()) == sorted(good)
    assert corpus_pipeline.quality(spark, docs, FOLDER).columns == docs.columns


def test_scores_equal_a_plain_dot_product():
    texts = ["good words here now", "bad $$$ %%% words", "good calm text", "bad ### words ###"] * 6
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in raw])])
    ends, place, value = classifier.features(np.frombuffer(b"".join(raw), np.uint8), offsets, 12)
    weights = np.random.default_rng(3).normal(size=1 << 12)
    dots = [sum(weights[place[j]] * value[j] for j in range(ends[i], ends[i + 1])) for i in range(len(texts))]
    fast = 1 / (1 + np.exp(-np.add.reduceat(weights[place] * value, ends[:-1])))
    assert np.allclose(fast, [1 / (1 + np.exp(-d)) for d in dots])


def test_training_equals_plain_follow_the_regularised_leader():
    rng = random.Random(8)
    examples = []
    for _ in range(30):
        at = rng.sample(range(12), 4)
        examples.append((np.array(at), np.array([rng.random() for _ in at]), float(at[0] % 2)))
    z, n = [0.0] * 12, [0.0] * 12

    def weight(i):
        if abs(z[i]) <= classifier.L1:
            return 0.0
        sign = 1 if z[i] > 0 else -1
        return -(z[i] - sign * classifier.L1) / ((classifier.BETA + n[i] ** 0.5) / classifier.ALPHA + classifier.L2)
    order = np.random.RandomState(5)
    for _ in range(3):
        for e in order.permutation(len(examples)):
            at, value, label = examples[e]
            w = [weight(i) for i in at]
            p = 1 / (1 + np.exp(-sum(x * v for x, v in zip(w, value))))
            for i, x, v in zip(at, w, value):
                g = (p - label) * v
                sigma = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / classifier.ALPHA
                z[i] += g - sigma * x
                n[i] += g * g
    assert np.allclose(classifier.ftrl(examples, 12, 3), [weight(i) for i in range(12)])


@here
def test_run_applies_the_stages_in_order(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "near dedup", "repeated passages", "packing"]
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    good = corpus_pipeline.quality(spark, table, FOLDER)
    rows = kept(good)
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i, t))
    rows = [(i, t) for _, i, t in (min(g) for g in groups.values())]
    rows = brute_passages(brute_near(rows), corpus_pipeline.PASSAGE_BYTES)
    from public_tokenizers import path
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path("word_bpe_49k.json"))
    want = {i: tok.encode(t or "", add_special_tokens=False).ids + [1] for i, t in rows}
    pieces = defaultdict(list)
    for r in corpus_pipeline.run(spark, FOLDER).collect():
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
    assert set(pieces) == set(want)
    for i, found in pieces.items():
        at = 0
        for start, length, crc, total in sorted(found):
            assert start == at and total == len(want[i])
            assert crc == zlib.crc32(np.array(want[i][start:start + length], "<u4").tobytes())
            at += length
        assert at == len(want[i])
