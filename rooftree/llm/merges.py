"""Byte-level BPE merges of many words at once, as numpy arrays; the merges come from a public vocabulary file."""
from __future__ import annotations

import json

import numpy as np

NO_RANK = 1 << 30


class Merges:
    """The vocabulary's merges for many plain words at once: in each round every word takes its best pair, the first of equal ones."""

    def __init__(self, path: str, end: str = ""):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        ids = model["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([ids[a] << 16 | ids[b] for a, b in pairs], np.uint64)
        self.made = np.array([ids[a + b] for a, b in pairs], np.int64)
        self.slots, self.ranks = np.full(1 << 18, np.iinfo(np.uint64).max, np.uint64), np.full(1 << 18, NO_RANK, np.int64)
        rank, at = np.arange(len(keys)), self._slot(keys)
        while len(rank):  # open addressing: the first of those that want a slot gets it
            free = self.slots[at] == np.iinfo(np.uint64).max
            _, first = np.unique(at[free], return_index=True)
            won = np.flatnonzero(free)[first]
            self.slots[at[won]], self.ranks[at[won]] = keys[rank[won]], rank[won]
            rest = np.ones(len(rank), bool)
            rest[won] = False
            rank, at = rank[rest], (at[rest] + 1) & 0x3FFFF
        shown = {**{b: chr(b) for b in [*range(33, 127), *range(161, 173), *range(174, 256)]}}
        hidden = [b for b in range(256) if b not in shown]
        shown |= {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.inner, self.last = (np.array([ids.get(shown[b] + tail, 0) for b in range(256)], np.int64) for tail in ("", end))

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(46)).astype(np.int64)

    def _rank(self, keys: np.ndarray) -> np.ndarray:
        at = self._slot(keys)
        found = self.slots[at]
        out = np.where(found == keys, self.ranks[at], NO_RANK)
        open_ = np.flatnonzero((found != keys) & (found != np.iinfo(np.uint64).max))
        at = at[open_]
        while len(open_):
            at = (at + 1) & 0x3FFFF
            found, want = self.slots[at], keys[open_]
            hit = found == want
            out[open_[hit]] = self.ranks[at[hit]]
            go = ~hit & (found != np.iinfo(np.uint64).max)
            open_, at = open_[go], at[go]
        return out

    def encode(self, words: list[bytes]) -> list[bytes]:
        size = np.array([len(w) for w in words], np.int64)
        raw = np.frombuffer(b"".join(words), np.uint8)
        symbol = self.inner[raw]
        ends = np.cumsum(size) - 1
        symbol[ends] = self.last[raw[ends]]
        word = np.repeat(np.arange(len(words)), size)
        done: list[bytes] = [b""] * len(words)
        while len(symbol):
            rank = np.full(len(symbol), NO_RANK, np.int64)
            inside = np.flatnonzero(word[1:] == word[:-1])
            rank[inside] = self._rank((symbol[inside] << 16 | symbol[inside + 1]).astype(np.uint64))
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            best = np.minimum.reduceat(rank << 32 | np.arange(len(symbol)), first)
            over = best >> 32 == NO_RANK
            if over.any():
                stop = np.append(first[1:], len(symbol))
                packed = symbol.astype("<u2").tobytes()
                for i, a, b in zip(word[first[over]].tolist(), first[over].tolist(), stop[over].tolist()):
                    done[i] = packed[2 * a:2 * b]
            at = best[~over] & 0xFFFFFFFF
            symbol[at] = self.made[best[~over] >> 32]
            keep = ~np.repeat(over, np.diff(np.append(first, len(symbol))))
            keep[at + 1] = False
            symbol, word = symbol[keep], word[keep]
        return done
