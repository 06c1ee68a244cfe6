"""Training-data cases of the third review."""
import hashlib
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from rooftree.llm import classifier, common, packing, quality_rules, suffix_dedup, word_pairs


def test_discounts_come_from_all_pairs(spark, monkeypatch):
    """The counts of counts of a language are those of all of its word pairs, whichever shard has them."""
    rng, seen, real = random.Random(3), [], word_pairs.discounts
    table = [(i, " ".join(f"w{int(rng.paretovariate(0.6)) % 400}" for _ in range(50)), rng.choice(["en", "de"])) for i in range(80)]
    monkeypatch.setattr(word_pairs, "discounts", lambda *n: seen.append(n) or real(*n))
    quality_rules.report(spark.createDataFrame(table, "doc_id long, text string, lang string").repartition(3)).count()
    pairs = Counter()
    for _, text, lang in table:
        words = re.findall(r"\S+", text)
        pairs.update((lang, *p) for p in zip([None, *words], words))
    for lang in ("en", "de"):
        times = Counter(n for (of, _, _), n in pairs.items() if of == lang)
        assert tuple(times[k] for k in range(1, 5)) in seen


class _Counted(dict):
    lookups = 0

    def __getitem__(self, key):
        self.lookups += 1
        return super().__getitem__(key)

    def get(self, key, default=None):
        self.lookups += 1
        return super().get(key, default)


def test_packing_looks_up_each_word_of_a_block_once(monkeypatch):
    cache = packing._cache(packing._default_path())
    monkeypatch.setattr(cache, "known", _Counted())
    texts = [" ".join(f"word{k}" for k in range(40)) + " end. "] * 200
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(200)), "source": ["s"] * 200, "text": texts})
    assert sum(b.num_rows for b in packing._tokenize(iter([batch]), None)) == 200
    assert cache.known.lookups <= 3 * 42


def test_packing_tokens_of_texts_that_meet_in_a_block():
    """Stops, special tokens and capitals at the ends of texts are cut as the tokenizers library cuts each text alone."""
    rng = random.Random(4)
    bits = ["a", "B", ".", ",", " ", "\n", "\t", "<|", "<", "|", "|>", "ä", "É", "9", "x.", "word", "<|endoftext|>", "日本", "\x0b"]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 9))) for _ in range(3_000)] + ["", None, "<", "|", "a", ".", ". ", "b. "]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "source": ["s"] * len(texts), "text": texts})
    got = [ids for b in packing._tokenize(iter([batch]), None) for ids in b.column("ids").to_pylist()]
    tokenizer = packing._tokenizer(packing._default_path())
    want = [np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, packing.END_ID], "<u2").tobytes() for t in texts]
    assert [i for i, (a, b) in enumerate(zip(got, want)) if a != b] == []


@pytest.mark.parametrize("hot_runs", [12, 3])
def test_near_copies_are_compared_by_blocks(spark, monkeypatch, hot_runs):
    """Blocks of an anchor with many distinct runs become rows of single windows only where their key has too many, too."""
    rng, length = random.Random(6), 100
    base = "".join(rng.choices("abcdefgh ", k=1_500))
    texts = [base] + [base[:k] + "Z" + base[k + 1:] for k in range(0, 1_500, 7)] + [base[200:900], base[:700] * 2, None, "short"]

    def no_rows(batches, length):
        for batch in batches:
            assert batch.num_rows == 0
            yield from ()
    if hot_runs == 12:
        monkeypatch.setattr(suffix_dedup, "_single_windows", no_rows)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup.report(df, length, hot_runs).collect()}
    times = Counter(t[a:a + length] for t in texts if t for a in range(len(t) - length + 1))
    for i, t in enumerate(texts):
        t = t or ""
        gone = np.zeros(len(t) + 1, bool)
        for a in range(len(t) - length + 1):
            if times[t[a:a + length]] > 1:
                gone[a:a + length] = True
        kept = "".join(c for c, g in zip(t, gone) if not g)
        assert got[i] == (int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept.encode()).hexdigest())


class _Model:
    value = np.linspace(-1, 1, 1 << 18)


def _peak_mb(run) -> float:
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def _worded(docs: int) -> pa.RecordBatch:
    rng = random.Random(6)
    texts = [" ".join(f"{'abcdefghijklmnop'[k % 16]}{'qrstuvwxyz'[k % 10]}{k:x}" for k in rng.choices(range(60_000), k=300)) for _ in range(docs)]
    return pa.RecordBatch.from_pydict({"doc_id": list(range(docs)), "source": ["s"] * docs, "text": texts, "quality": [k % 2 for k in range(docs)]})


def test_memory_of_a_worker_that_scores_and_trains(monkeypatch):
    """A worker's memory follows the size of a block, not of a batch; the scores are those of each text alone."""
    batch, scores = _worded(1_500), []
    monkeypatch.setattr(common, "_POWERS", {})
    assert _peak_mb(lambda: scores.extend(s for b in classifier._score(iter([batch]), _Model, 18, "score") for s in b.column("score").to_pylist())) < 50
    alone = [b.column("score")[0].as_py() for k in range(0, 1_500, 100) for b in classifier._score(iter([batch.slice(k, 1)]), _Model, 18, "score")]
    assert scores[::100] == alone
    assert _peak_mb(lambda: list(classifier._train(iter([batch]), 18, 1))) < 75


def test_memory_of_a_worker_that_packs(monkeypatch):
    batch, path = _worded(4_000), packing._default_path()
    packing._cache(path)  # the vocabulary's own memory is not counted
    monkeypatch.setitem(packing._CACHES, path, packing.WordCache(path))
    assert _peak_mb(lambda: [None for _ in packing._tokenize(iter([batch]), None)]) < 120
