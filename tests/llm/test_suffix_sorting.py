"""Suffix order, common prefixes and repeated windows against plain sorting, with deep ties."""
import random

import numpy as np
import pytest

from rooftree.llm import suffix_dedup


def text_of(rng):
    out = []
    for _ in range(rng.randrange(1, 6)):
        base = [rng.randrange(1, 4) for _ in range(rng.randrange(1, 9))]
        out += (base * rng.randrange(1, 60))[:rng.randrange(1, 220)] + [0]
    return np.array(out, np.uint16)


def suffix(t, i, depth):
    piece = t[i:i + depth].tolist()
    return piece[:piece.index(0) + 1] if 0 in piece else piece


@pytest.mark.parametrize("depth", [5, 7, 60, 130])
def test_order_of_all_and_of_wanted_suffixes(depth):
    rng = random.Random(depth)
    for _ in range(60):
        t = text_of(rng)
        order = suffix_dedup.suffix_array(t, depth)
        keys = [suffix(t, i, depth) for i in order]
        assert sorted(order.tolist()) == list(range(len(t))) and keys == sorted(keys)
        ends, wanted = np.flatnonzero(t == 0), np.zeros(len(t), bool)
        for a, b in zip([0, *(ends[:-1] + 1)], ends):
            wanted[a:a + rng.randrange(0, b - a + 1)] = True
        some = suffix_dedup.suffix_array(t, depth, None, wanted)
        some = some[wanted[some]]
        keys = [suffix(t, i, depth) for i in some]
        assert sorted(some.tolist()) == np.flatnonzero(wanted).tolist() and keys == sorted(keys)


def test_common_prefixes_by_words_equal_those_by_symbols():
    rng = random.Random(9)
    for _ in range(60):
        t = text_of(rng)
        a, b = (np.array([rng.randrange(len(t)) for _ in range(40)]) for _ in range(2))
        limit = rng.choice([1, 6, 7, 8, 50])
        want = []
        for i, j in zip(a, b):
            n = 0
            while n < limit and i + n < len(t) and j + n < len(t) and t[i + n] == t[j + n] and t[i + n] != 0:
                n += 1
            want.append(n)
        assert suffix_dedup.common_prefix(t, a, b, limit).tolist() == want


def test_repeated_windows_equal_counts_of_strings():
    rng = random.Random(12)
    for _ in range(40):
        base = bytes(rng.choice(b"ab") for _ in range(120))
        parts = [base[rng.randrange(60):] + bytes(rng.choice(b"abc") for _ in range(rng.randrange(30))) for _ in range(rng.randrange(1, 6))]
        length = rng.choice([8, 20, 33])
        parts = [p + b"z" * max(0, length - len(p)) for p in parts]
        windows = np.array([len(p) - length + 1 for p in parts])
        strings = [p[i:i + length] for p in parts for i in range(len(p) - length + 1)]
        got = suffix_dedup.repeated_windows([np.frombuffer(p, np.uint8) for p in parts], windows, length)
        assert np.concatenate(got).tolist() == [strings.count(s) > 1 for s in strings]
