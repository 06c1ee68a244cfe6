"""Training-data operators against brute force, on the smallest tables and on awkward rows."""
import hashlib
import random
import re
import zlib
from collections import Counter
from itertools import combinations
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rooftree.llm import bpe, classifier, exact_dedup, html_text, minhash, packing, preference, quality_rules, suffix_dedup, url_filter, word_pairs
from rooftree.llm.common import words_of

FOLDER = "/root/testdata/sf0.001"
here = pytest.mark.skipif(not Path(FOLDER).exists(), reason="shared test tables not present")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key long, doc string, anchor string, spans int, rk int"
PASSAGE = " ".join(f"w{i * 37 % 101}" for i in range(300))
LONG = " ".join(f"long{i % 9973}" for i in range(60_000))
AWKWARD = [(1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t ", None, None), (4, "one two", "en", "a"), (5, "One  two", "en", "b"),
           (6, PASSAGE, "de", "a"), (7, "Before. " + PASSAGE + " After.", "de", "b"), (8, PASSAGE, "de", "a"), (8, PASSAGE, "de", "a"),
           (None, "no id at all here", "en", "a"), (None, None, None, None), (9, LONG, "en", "a"), (10, LONG + " end", "en", "b"),
           (11, "a" * 3_000, "en", "a"), (12, "é" * 900 + "<|endoftext|> ß it's 1,5.", "fr", "c"), (13, "same\nsame\n\nsame\nother #|", "en", "c")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, 0, 1, "x", "y", 2, 3) for r in AWKWARD], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def rows(df):
    return [r.asDict() for r in df.collect()]


def texts_of(df):
    return [(r["doc_id"], r["text"] or "") for r in df.collect()]


def brute_repeats(docs, length):
    seen = Counter()
    for _, t in docs:
        b = t.encode()
        seen.update(b[i:i + length] for i in range(len(b) - length + 1))
    out = []
    for doc_id, t in docs:
        b = t.encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((doc_id, len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_suffix_array_order_and_windows():
    rng = random.Random(2)
    for _ in range(60):
        parts = [np.array([rng.choice(b"ab\xff") for _ in range(rng.randint(6, 50))], np.uint8) for _ in range(rng.randint(1, 6))]
        t = np.concatenate([np.append(p.astype(np.uint16) + 1, 0) for p in parts]).astype(np.uint16)
        cut = lambda i: bytes(str(t[i:].tolist()), "ascii") and t[i:i + 1 + int(np.flatnonzero(t[i:] == 0)[0])].tolist()
        order = suffix_dedup.suffix_array(t, 60)
        assert sorted(order) == list(range(len(t)))
        assert all(cut(a) <= cut(b) for a, b in zip(order, order[1:]))


@pytest.mark.parametrize("hot", [2_000, 1])
def test_repeats_on_awkward_rows(spark, hot):
    rng = random.Random(4)
    body = " ".join(rng.choice("alpha beta gamma delta".split()) + str(rng.randint(0, 500)) for _ in range(60))
    own = [(i, "".join(rng.choice("xyz ") for _ in range(rng.randint(0, 90))) + body[i:] + str(i) * 30) for i in range(12)]
    own += [(20, None), (21, ""), (22, "é" * 200), (None, "z" * 150), (8, body), (8, body)]
    got = rows(suffix_dedup.report(spark.createDataFrame(own, "doc_id long, text string"), length=60, hot_runs=hot))
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got), key=str)
    assert got == brute_repeats([(i, t or "") for i, t in own], 60)


def _anchors(text, found):
    """{window start: (anchor, its place in the text)}."""
    _, start, windows, off, anchor, _ = found
    return {int(s + i): (int(h), int(s + o)) for s, n, o, h in zip(start, windows, off, anchor) for i in range(n)}


def test_long_text_in_pieces():
    raw = np.frombuffer(random.Random(9).randbytes(3_000), np.uint8)
    whole = np.array([0, len(raw)])
    want = _anchors(raw, suffix_dedup.runs_of(raw, whole, 60))
    for piece in (1, 59, 500, 2_940, 2_941, 2_999):
        assert _anchors(raw, suffix_dedup._runs_by_piece(raw, whole, 60, piece)) == want


def test_repeats_behind_16_mib():
    """Windows of a passage that stands twice behind the 24 bits of a position have the same anchors."""
    passage = "".join(random.Random(10).choices("abcdefgh ", k=1_000))
    text = np.random.RandomState(3).randint(97, 123, (1 << 24) + 5_000).astype(np.uint8).tobytes().decode() + passage + " between " + passage
    batch = pa.record_batch({"doc": pa.array([1], pa.int64()), "rk": pa.array([1], pa.int64()), "text": [text]})
    first, second = len(text) - 2_009, len(text) - 1_000
    got = {}
    for out in suffix_dedup._emit_runs(iter([batch]), 400):
        for s, n, o, h in zip(*(out.column(c).to_numpy() for c in ("start", "windows", "off", "anchor"))):
            if s + n > first:
                got.update({int(s + i): (int(h), int(s + o - (s + i))) for i in range(n)})
    assert all(got[first + i] == got[second + i] for i in range(601)) and max(got) == len(text) - 400


@here
def test_repeats_on_documents(small):
    got = sorted((tuple(r) for r in suffix_dedup.report(small).collect()), key=str)
    assert got == brute_repeats(texts_of(small), suffix_dedup.LENGTH)


def test_removed_text_keeps_other_columns(docs):
    out = suffix_dedup.remove_repeats(docs)
    assert out.columns == docs.columns and out.count() == len(AWKWARD)
    assert all(r["text"] == "" for r in rows(out.where("doc_id = 8")))


def _bpe_expected(docs):
    import public_tokenizers
    tokenizer = bpe._tokenizer(public_tokenizers.path(bpe.TOKENIZER))
    out = []
    for doc_id, t in docs:
        ids = tokenizer.encode(t, add_special_tokens=False).ids
        plain = tokenizer.decode(ids, skip_special_tokens=False)
        out.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(plain.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("table", ["docs", pytest.param("small", marks=here)])
def test_bpe_equals_the_tokenizers_library(table, request):
    df = request.getfixturevalue(table)
    assert sorted((tuple(r) for r in bpe.report(df).collect()), key=str) == _bpe_expected(texts_of(df))


def test_url_rules(spark):
    urls = ["http://a.org/x", "https://org/", "http://org", "ftp://example.org/es/1?q", "http://www.EXAMPLE.org/en/123#f", "http://x.com/fr/", "http://x.com/de/1",
            "http://x.com/it/", "http://xorg/", None, "no scheme", "http://", "http://x.com/de/1", "http://a.b://c.org/y", "http://Ä.Org/"]
    pages = spark.createDataFrame([(i, u, 1) for i, u in enumerate(urls)], "page_id long, url string, key int")
    want = []
    for i, u in enumerate(urls):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.sub("[A-Z]", lambda m: m[0].lower(), re.match("[^/?#]*", rest)[0])
        path = re.match("[^?#]*", rest[len(host):])[0]
        fit = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        want.append((i, host, path, max(fit)[1] if fit else None, max(fit)[2] if fit else "allow"))
    assert sorted(tuple(r) for r in url_filter.judge(pages).collect()) == sorted(want)
    assert url_filter.judge(pages.limit(0)).count() == 0


def test_cascade_is_exact(spark):
    universe = spark.range(3_000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = universe.where("crc32(key) % 7 = 0")
    levels = url_filter.cascade(listed, universe)
    asked = universe.withColumns({f"b{i}": lv.bits.scalar() for i, lv in enumerate(levels)})
    yes = asked.where(url_filter.member(F.col("key"), [F.col(f"b{i}") for i in range(len(levels))], levels)).select("key")
    assert {r[0] for r in yes.collect()} == {r[0] for r in listed.collect()}


def _rules_expected(t):
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    again = {j for i in range(len(words) - 4) if grams[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(again),
            len(words) < 10 or 100 * len(again) > 20 * len(words))


@pytest.mark.parametrize("table", ["docs", pytest.param("small", marks=here)])
def test_rule_counts(table, request):
    df = request.getfixturevalue(table)
    got = [(r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in rows(quality_rules.report(df))]
    assert sorted(got, key=str) == sorted(((i, *_rules_expected(t)) for i, t in texts_of(df)), key=str)


def test_kneser_ney_sums_to_one(spark):
    n = np.random.RandomState(1).randint(1, 6, 500)
    gram = np.unique(np.random.RandomState(2).randint(0, 1 << 18, 500))
    model = quality_rules.KneserNey(np.full(len(gram), 3), gram, n[:len(gram)])
    assert np.allclose(np.exp(-model.surprise(3).astype(float)).reshape(-1, 64).sum(axis=1), 1, atol=1e-3)


def _surprises_expected(table):
    """Mean surprise of every text by plain counting; the symbol model and the sample of contexts are the operator's own."""
    words_by, pairs, spell_counts = [], {}, Counter()
    often = [k for k, _ in sorted(Counter(c or "" for _, _, c in table).items(), key=lambda x: (-x[1], x[0]))]
    for _, text, lang in table:
        cls = often.index(lang or "")
        raw = np.frombuffer((text or "").encode(), np.uint8)
        spell_counts.update((cls, int(g)) for g in quality_rules.trigrams(raw, np.array([0, len(raw)]))[0])
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        own = Counter(zip([None, *words], words))
        pairs.setdefault(cls, Counter()).update(own)
        words_by.append((cls, raw, words, own))
    grams = sorted(spell_counts)
    spelling = quality_rules.KneserNey(*np.array([(*g, spell_counts[g]) for g in grams]).reshape(-1, 3).T)

    def hashes(words):
        raw = np.frombuffer(" ".join(words).encode(), np.uint8)
        _, _, doc, found = words_of(raw, np.array([0, len(raw)]))
        return found, doc

    stats, cuts = {}, {}
    for cls, counts in pairs.items():
        sample = Counter()
        for (before, word), n in counts.items():
            total, kinds = stats.setdefault((cls, before), [0, Counter()])
            stats[cls, before][0] += n
            kinds[min(n, 3)] += 1
            keys = word_pairs.pair_keys(*hashes([before, word] if before is not None else [word]), np.array([cls]))
            context = word_pairs.contexts(keys[-1:]).astype(np.uint64)
            if word_pairs.mix(context)[0] % np.uint64(word_pairs.SAMPLE) == 0:
                sample[n] += 1
        cuts[cls] = word_pairs.discounts(*(sample[k] for k in range(1, 5)))
    out = []
    for cls, raw, words, own in words_by:
        costs = {}
        code, _, position = quality_rules.trigrams(raw, np.array([0, len(raw)]))
        codes = dict(zip(position.tolist(), code.tolist()))
        for at, c in codes.items():
            costs[at] = float(spelling.surprise(cls)[c])
        total = 0.0
        spans = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw.tobytes())]
        first = {}
        for k, (a, b) in enumerate(spans):
            first.setdefault((words[k - 1] if k else None, words[k]), sum(costs.get(i, 0) for i in range(a, b))
                             + float(spelling.surprise(cls)[(codes[b - 1] & 0xFFF) << 6]))
        for pair, o in own.items():
            n, kinds = stats[cls, pair[0]]
            d = cuts[cls]
            free = sum(d[k] * kinds[k] for k in (1, 2, 3)) / n if n > o else 1
            c = pairs[cls][pair] - o
            p = max(c - d[min(c, 3)], 0) / max(n - o, 1) + free * np.exp(1 - np.exp2(np.rint(16 * np.log2(1 + first[pair])) / 16))  # the steps in which costs are sent
            total -= o * np.log(max(p, 1e-300))
        out.append(total / max(len(words), 1))
    return out


@pytest.mark.parametrize("partitions", [1, 8])
def test_word_pairs_against_plain_counts(spark, partitions):
    """The same surprises for any number of shards, whether contexts count as frequent or not."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)]
    table = [(i, " ".join(rng.choices(vocabulary, [1 / (k + 1) for k in range(60)], k=rng.randint(0, 80))), rng.choice(["en", "de", None]))
             for i in range(60)] + [(100, None, "en"), (101, "", "de"), (102, "alone", "fr")]
    df = spark.createDataFrame(table, "doc_id long, text string, lang string").repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        got = {r["doc_id"]: r["surprise"] for r in rows(quality_rules.report(df))}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = _surprises_expected(table)
    off = [(i, got[i], w) for (i, _, _), w in zip(table, want) if abs(got[i] - w) > 0.01]
    assert not off, off


def test_squeezed_arrays_come_back():
    for a in ([], [0], [255, 256], list(range(70_000)), [1 << 62, 3]):
        back = word_pairs.unsqueeze(word_pairs.squeeze(np.array(a, np.int64), np.array([7])))
        assert back[0].tolist() == a and back[1].tolist() == [7]


def test_html(spark):
    page = ('<html><head><title>T</title><style>p{}</style></head><body><nav><a>menu</a></nav><div class="cookie notice">ok?</div><article><h1>Head &amp; more</h1>'
            '<p>One\n <b>two<br>three<p>four</p><div class="ad">buy</div><script>var a="</p>";</script></article><section id="comments"><article>me too</article>'
            '</section><footer>&copy;</footer>')
    plain = '<body><div class="x">site line</div><div id="c"><p>text {0} of its own</p></div></body>'
    data = [(1, "http://h.net/1", page), (2, "http://h.net/2", None), (3, "http://h.net/3", ""), (None, None, "<p>lone"), (4, "http://h.net/1", page)]
    data += [(10 + i, f"http://t.net/{i}", plain.format(i)) for i in range(8)]
    got = {(r["page_id"], r["text"], r["n_chars"]) for r in rows(html_text.extract(spark.createDataFrame(data, "page_id long, url string, html string")))}
    body = "Head & more\n\nOne two three\n\nfour"
    want = {(1, body, len(body)), (4, body, len(body)), (2, "", 0), (3, "", 0), (None, "lone", 4)} | {(10 + i, f"text {i} of its own", 17) for i in range(8)}
    assert got == want


@pytest.mark.parametrize("table", ["docs", pytest.param("small", marks=here)])
def test_exact_copies(table, request):
    df = request.getfixturevalue(table)
    groups = {}
    for i, t in texts_of(df):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t), []).append((-len(t), i if i is not None else 1 << 63))
    want = []
    for t, own in groups.items():
        keep = min(own)[1]
        want += [(None if i == 1 << 63 else i, None if keep == 1 << 63 else keep, len(own), i == keep, hashlib.sha256(t.encode()).hexdigest()) for _, i in own]
    got = [tuple(r[c] for c in ("doc_id", "keep_id", "group_size", "kept", "text_sha256")) for r in rows(exact_dedup.report(df, 4))]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert exact_dedup.keep_one(df).count() == len(groups)


@pytest.mark.parametrize("table", ["docs", pytest.param("small", marks=here)])
def test_packing(table, request):
    df = request.getfixturevalue(table)
    import public_tokenizers
    tokenizer = packing._tokenizer(public_tokenizers.path(packing.TOKENIZER))
    ids = {}
    for r in df.collect():
        ids.setdefault(r["doc_id"], []).append(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [1])
    got = rows(packing.pack(df))
    assert sum(r["length"] for r in got) == sum(len(x) for own in ids.values() for x in own)
    sequences = {}
    for r in got:
        fits = [np.array(x[r["start"]:r["start"] + r["length"]], "<u4").tobytes() for x in ids[r["doc_id"]] if len(x) == r["doc_tokens"]]
        assert any(zlib.crc32(f) == r["ids_crc32"] for f in fits)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sorted(sequences) == list(range(len(sequences)))
    for k, parts in sequences.items():
        ends = np.cumsum([0, *(n for _, n in sorted(parts))])
        assert [o for o, _ in sorted(parts)] == ends[:-1].tolist() and (ends[-1] == packing.WINDOW or k == len(sequences) - 1)


@pytest.mark.parametrize("weights", [None, [1.0, 1.0, 1.0, 1.0]])
def test_served_follows_the_rule(weights):
    totals = [50, 7, 1, 42]
    mixture = packing.Mixture(totals, weights, 8)
    due = sorted(((j + 0.5) / mixture.weights[q], q) for q, n in enumerate(totals) for j in range(n))
    for k in range(mixture.windows + 1):
        want = Counter(q for _, q in due[:k * 8])
        assert mixture.served(np.array([k]))[0].tolist() == [want[q] for q in range(4)]


def _near_expected(docs):
    sets = []
    for _, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
        sets.append({tuple(w[i:i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set())
    node = [i if i is not None else 1 << 63 for i, _ in docs]
    root = {n: n for n in node}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in combinations(range(len(docs)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            x, y = find(node[a]), find(node[b])
            root[max(x, y)] = min(x, y)
    return sorted(((i, len(s), find(n), find(n) == n) for (i, _), s, n in zip(docs, sets, node)), key=str)


def _near_got(df, **options):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"] if r["component_id"] is not None else 1 << 63, r["kept"])
                   for r in rows(minhash.near_duplicates(df, **options))), key=str)


@pytest.mark.parametrize("table", ["docs", pytest.param("small", marks=here)])
def test_near_copies(table, request):
    df = request.getfixturevalue(table)
    assert _near_got(df) == _near_expected(texts_of(df))


def test_large_group_of_near_copies(spark):
    rng = random.Random(6)
    base = [f"w{i}" for i in range(120)]
    texts = [(i, " ".join(f"x{i}_{j}" if rng.random() < rng.choice([0.01, 0.03]) else w for j, w in enumerate(base))) for i in range(90)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    assert _near_got(df, block=16) == _near_expected(texts)


@here
def test_classifier_on_held_out_rows(spark, small):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    got = classifier.report(docs, labels).join(labels, "doc_id").where("held_out").collect()
    good, bad = ([r["score"] for r in got if r["quality"] == q] for q in (1, 0))
    assert sum(g > b for g in good for b in bad) >= 0.95 * len(good) * len(bad)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)


def test_classifier_without_labels(spark, docs):
    none = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, quality int")
    assert {r["score"] for r in rows(classifier.report(docs, none))} == {0.5}


def test_preference_pairs(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "A"), (2, 0, "user", "hi"), (2, 1, "assistant", "B"), (2, 2, "user", "more"), (2, 2, "user", "more"),
             (3, 0, "user", None), (None, None, None, "x"), (4, 0, "user", "hi"), (5, 0, "user", "hi")]
    got = {(r["pair_id"], r["part"], r["pos"], r["loss"], r["prompt_turns"], r["paired"])
           for r in rows(preference.format_pairs(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")))}
    assert got == {(1, "prompt", 1, False, 1, True), (1, "chosen", 2, True, 1, True), (1, "rejected", 2, True, 1, True), (1, "rejected", 3, False, 1, True),
                   (3, "chosen", 1, False, 0, False), (None, "chosen", 1, False, 0, False), (4, "prompt", 1, False, 1, True)}


def test_empty_tables(spark, empty):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    for out in (suffix_dedup.report(empty), bpe.report(empty), url_filter.judge(pages), quality_rules.report(empty), html_text.extract(pages),
                exact_dedup.report(empty), packing.pack(empty), minhash.near_duplicates(empty), classifier.report(empty, labels),
                preference.format_pairs(turns)):
        assert out.count() == 0


def test_bands_reject_planted_junk(spark):
    """Marks glued to the words leave the band above, one paragraph on many rows below; clean text stays, also in two copies."""
    rng = random.Random(8)
    vocabulary = ["".join(rng.choices("abcdefghiklmnoprstuvw", k=rng.randint(2, 9))) for _ in range(3_000)]
    weights = [1 / (k + 3) for k in range(3_000)]
    clean = [" ".join(rng.choices(vocabulary, weights, k=rng.randint(150, 250))) for _ in range(300)]
    clean += clean[:30]
    glued = [" ".join(w + rng.choice(["###", "$$$", "%%%", "&&&"]) for w in rng.choices(vocabulary, weights, k=200)) for _ in range(12)]
    paragraph = " ".join(rng.choices(vocabulary, weights, k=100))
    template = [f"{paragraph} {i}" for i in range(60)]
    kinds = ["clean"] * len(clean) + ["glued"] * len(glued) + ["template"] * len(template)
    table = [(i, t, "en") for i, t in enumerate([*clean, *glued, *template])]
    got = {r["doc_id"]: r for r in rows(quality_rules.report(spark.createDataFrame(table, "doc_id long, text string, lang string")))}
    assert not any(r["base_failed"] for r in got.values())
    kept = Counter((kind, got[i]["kept"]) for i, kind in enumerate(kinds))
    middle = np.median([r["surprise"] for r in got.values()])
    assert kept == {("clean", True): len(clean), ("glued", False): len(glued), ("template", False): len(template)}, (kept, middle)
    assert all((got[i]["surprise"] > middle) == (kind == "glued") for i, kind in enumerate(kinds) if kind != "clean")


def test_templates_inside_marks(spark):
    """A box that recurs inside articles goes, their own paragraphs stay; teasers in an article do not hide the body outside it."""
    box = '<body><div id="x"><article><h1>Head {0}</h1><p>Same opening.</p><div class="x{0}"><p>Site line</p></div><p>own {0}</p></article></div></body>'
    teaser = '<body><article><div><p>Read more</p></div></article><section><p>body {0}</p></section></body>'
    copy = "<body><article><div><p>one text in copies</p></div></article></body>"
    data = [(i, f"http://a.net/{i}", box.format(i)) for i in range(6)] + [(10 + i, f"http://b.net/{i}", teaser.format(i)) for i in range(6)]
    data += [(20 + i, f"http://c.net/{i}", copy) for i in range(6)]
    got = {r["page_id"]: r["text"] for r in rows(html_text.extract(spark.createDataFrame(data, "page_id long, url string, html string")))}
    want = {i: f"Head {i}\n\nSame opening.\n\nown {i}" for i in range(6)} | {10 + i: f"body {i}" for i in range(6)}
    assert got == want | {20 + i: "one text in copies" for i in range(6)}


def test_template_of_a_part_of_a_host(spark):
    """A section's template goes from a large host as it would from a host of its own."""
    part = "<body><div><p>Section line</p></div><p>in the section {0}</p></body>"
    rest = "<body><p>elsewhere {0}</p></body>"
    data = [(i, f"http://big.net/{i}", (part if i < 6 else rest).format(i)) for i in range(200)]
    got = {r["page_id"]: r["text"] for r in rows(html_text.extract(spark.createDataFrame(data, "page_id long, url string, html string")))}
    assert got == {i: f"in the section {i}" if i < 6 else f"elsewhere {i}" for i in range(200)}
