"""BPE encoding and decoding with reuse of content-defined chunks.

A rolling hash cuts texts where their content says so, so documents that share passages share chunks.  Documents are dealt
out by the smallest hash of their chunks, which brings copies and near copies to one task; there each distinct chunk is
encoded once.  A chunk's own tokens hold between its first and last *synchronous* places (a single blank between printable
ASCII characters always starts a new pre-token).  What lies around a join of two chunks is encoded again, together with a
known piece on either side; where these pieces do not come out as before, the window grows to the whole document.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rooftree.llm.common import as_batch, blocks, byte_codes, mix, prefix_hash, range_hash, utf8
from rooftree.llm.merges import Merges

TOKENIZER = "byte_bpe_50k.json"
MASK_BITS, LEAST, MOST = 10, 256, 8_192
CHUNK_CACHE_BYTES = 64 << 20
CACHE_PIECES = 800_000
_GEAR = byte_codes(3)
_SYNC = re.compile(rb"(?<=[!-~]) (?=[!-~])")
_UNSURE = re.compile(rb"[\x00-\x20\x80-\xbf] [\x00-\x20\xc2\xe1\xe2\xe3]|<\||\x01")
_STOP = re.compile(rb"(?<=[A-Za-z0-9])(?=[.,][ \n])")
_PLAIN = re.compile(rb" ?(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+").fullmatch  # one pre-token
_LINE = re.compile(rb"(?<=[!-~])\n(?=[!-~])")


def cuts(text: np.ndarray, offsets: np.ndarray) -> list[list[int]]:
    """Chunk ends of each text (places in the joined bytes), never inside a character."""
    h = _GEAR[text]
    for k in (1, 2, 4, 8, 16):  # rolling hash of the last 32 bytes
        shifted = h[:-k] << np.uint64(k)
        h = h.copy()
        h[k:] += shifted
    marks = np.flatnonzero((h >> np.uint64(64 - MASK_BITS)) == 0) + 1
    inside = (text & 0xC0) == 0x80
    out = []
    for a, b in zip(offsets.tolist(), offsets[1:].tolist()):
        own, at = [], a
        for m in [*marks[np.searchsorted(marks, a + LEAST):np.searchsorted(marks, b)].tolist(), b]:
            while m - at > MOST:
                at = _whole(inside, at + MOST, b)
                own.append(at)
            if m - at >= LEAST and m < b:
                at = _whole(inside, m, b)
                own.append(at)
        if b > at:
            own.append(b)
        out.append(own)
    return out


def _whole(inside: np.ndarray, at: int, end: int) -> int:
    while at < end and inside[at]:
        at += 1
    return at


def sketches(batches: Iterator[pa.RecordBatch], with_text: bool) -> Iterator[pa.RecordBatch]:
    """Add to each row the smallest hash of its chunks (0 for an empty text)."""
    for block in blocks(batches, "text"):
        text, offsets = utf8(block, "text")
        ends = cuts(text, offsets) if len(text) else [[] for _ in range(block.num_rows)]
        sizes = np.array([len(e) for e in ends])
        stop = np.array([x for e in ends for x in e], np.int64)
        start = np.array([x for a, e in zip(offsets.tolist(), ends) for x in [a, *e[:-1]][:len(e)]], np.int64)
        found = np.zeros(block.num_rows, np.int64)
        if len(stop):
            hashes = mix(range_hash(prefix_hash(text, _GEAR), start, stop)).view(np.int64)
            full = np.flatnonzero(sizes)
            found[full] = np.minimum.reduceat(hashes, np.concatenate([[0], np.cumsum(sizes[full])[:-1]]))
        columns = [block.column("doc_id"), block.column("text")] if with_text else []
        names = ["doc_id", "text"] if with_text else []
        yield pa.RecordBatch.from_arrays([*columns, pa.array(found)], names=[*names, "sketch"])


def _sync_places(raw: bytes) -> list[int]:
    """The first two and the last two synchronous places (all of them in a chunk with few)."""
    tail = [m.start() for m in _SYNC.finditer(raw, max(len(raw) - 100, 0))]
    first = _SYNC.search(raw)
    second = first and _SYNC.search(raw, first.start() + 1)
    if len(tail) < 2 or second is None or second.start() > tail[-2]:
        return [m.start() for m in _SYNC.finditer(raw)]
    return [first.start(), second.start(), *tail[-2:]]


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _byte_table(tokenizer) -> list[bytes]:
    """Bytes of each id of a byte-level vocabulary: printable bytes stand for themselves, the others for 256, 257, ..."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    char = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
    special = {i: t.content.encode() for i, t in tokenizer.get_added_tokens_decoder().items()}
    return [special[i] if i in special else bytes(char[c] for c in tokenizer.id_to_token(i)) for i in range(tokenizer.get_vocab_size())]


class ChunkEncoder:
    """Encodes texts from cached chunks and pieces; both caches are bounded."""

    def __init__(self, path: str):
        self.tokenizer, self.merges = _tokenizer(path), Merges(path)
        self.table = _byte_table(self.tokenizer)
        self.pieces: dict[bytes, bytes] = {}
        self.chunks: dict[bytes, tuple | None] = {}
        self.held = 0

    def whole(self, texts: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
        return [np.array(e.ids, "<u2").tobytes() for e in found]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids (16 bits each) of bytes that start and end at synchronous places, from cached pieces where cuts are safe."""
        split = [None if _UNSURE.search(t) else _LINE.sub(b"\x01\n\x01", _STOP.sub(b"\x01", t)).replace(b" ", b"\x01 ").removeprefix(b"\x01").split(b"\x01")
                 for t in texts]
        known = self.pieces
        if len(known) > CACHE_PIECES:
            known.clear()
        new = list(set().union(*(s for s in split if s)).difference(known))
        plain = [w for w in new if _PLAIN(w)]
        known.update(zip(plain, self.merges.encode(plain)))
        odd = [w for w in new if w not in known]
        known.update(zip(odd, self.whole(odd)))
        direct = iter(self.whole([t for t, s in zip(texts, split) if s is None]))
        return [next(direct) if s is None else b"".join(map(known.__getitem__, s)) for s in split]

    def _learn(self, chunks: dict[bytes, bytes]) -> None:
        """Encode chunks that are not cached: (head, first piece and its ids, ids of the body, last piece and its ids, tail) each;
        None without two synchronous places."""
        made, wanted = [], []
        for key, raw in chunks.items():
            at = _sync_places(raw)
            if len(at) > 1:
                made.append((key, raw, at))
                wanted += [raw[at[0]:at[1]], raw[at[0]:at[-1]], raw[at[-2]:at[-1]]]
            else:
                self.chunks[key] = None
            self.held += 200 + 2 * len(raw)
        ids = self.encode(wanted)
        for i, (key, raw, at) in enumerate(made):
            self.chunks[key] = (raw[:at[0]], wanted[3 * i], ids[3 * i], ids[3 * i + 1], wanted[3 * i + 2], ids[3 * i + 2], raw[at[-1]:])

    def documents(self, texts: list[list[bytes]]) -> list[bytes]:
        """Ids of each text, given as its chunks."""
        if self.held > CHUNK_CACHE_BYTES:
            self.chunks.clear()
            self.held = 0
        keys = [[hashlib.blake2b(p, digest_size=16).digest() for p in parts] for parts in texts]
        self._learn({k: p for own, parts in zip(keys, texts) for k, p in zip(own, parts) if k not in self.chunks})
        windows: list[tuple[int, int, bytes, bytes, bytes]] = []  # text, place in its list, window, ids known on its left and right
        lists: list[list[bytes]] = []
        for t, (own, parts) in enumerate(zip(keys, texts)):
            out: list[bytes] = []
            pending, left, left_ids = b"", b"", b""
            for key, part in zip(own, parts):
                made = self.chunks[key]
                if made is None:
                    pending += part
                    continue
                head, first, first_ids, body, last, last_ids, tail = made
                windows.append((t, len(out), left + pending + head + first, left_ids, first_ids))
                out += [b"", body]
                pending, left, left_ids = tail, last, last_ids
            windows.append((t, len(out), left + pending, left_ids, b""))
            out.append(b"")
            lists.append(out)
        differ = set()
        for (t, place, _, before, after), ids in zip(windows, self.whole([w[2] for w in windows])):
            if ids.startswith(before) and ids.endswith(after) and len(ids) >= len(before) + len(after):
                lists[t][place] = ids[len(before):len(ids) - len(after)]
            else:
                differ.add(t)  # the pieces do not agree: the window grows to the whole text
        for t in differ:
            lists[t] = self.whole([b"".join(texts[t])])
        return [b"".join(x) for x in lists]

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.table.__getitem__, ids.tolist())).decode(errors="replace")


_ENCODERS: dict[str, ChunkEncoder] = {}
_OUT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
_FULL = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])


def _encode(batches: Iterator[pa.RecordBatch], path: str | None, digest: bool) -> Iterator[pa.RecordBatch]:
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path(TOKENIZER)
    encoder = _ENCODERS.setdefault(path, None) or ChunkEncoder(path)
    _ENCODERS[path] = encoder
    for block in blocks(batches, "text"):
        text, offsets = utf8(block, "text")
        raw, rows = text.tobytes(), []
        ends = cuts(text, offsets) if len(text) else [[] for _ in range(block.num_rows)]
        parts = [[raw[x:y] for x, y in zip([a, *own[:-1]], own)] for a, own in zip(offsets.tolist(), ends)]
        for doc_id, packed in zip(block.column("doc_id").to_pylist(), encoder.documents(parts)):
            ids = np.frombuffer(packed, "<u2")
            body, plain = ids.astype("<u4").tobytes(), encoder.decode(ids)
            rows.append((doc_id, len(ids), hashlib.sha256(body).hexdigest(), hashlib.sha256(plain.encode()).hexdigest()) if digest
                        else (doc_id, body, plain))
        schema = _OUT if digest else _FULL
        yield as_batch(schema, **dict(zip(schema.names, zip(*rows))))


def _gathered(docs: DataFrame) -> DataFrame:
    """Documents dealt out by their sketch; sketches with more rows than a quarter of a task's share go to several tasks."""
    docs = docs.select("doc_id", "text")
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = max(16, docs.count() // (4 * tasks))
    counts = docs.mapInArrow(partial(sketches, with_text=False), "sketch long").groupBy("sketch").agg(F.count(F.lit(1)).alias("n"))
    often = counts.where(F.col("n") > share).select("sketch", F.ceil(F.col("n") / share).alias("salts"))  # at most 4 x tasks rows
    rows = docs.mapInArrow(partial(sketches, with_text=True), "doc_id long, text string, sketch long")
    rows = rows.join(F.broadcast(often), "sketch", "left")
    salt = F.when(F.col("salts").isNull(), F.lit(0).cast("long")).otherwise(F.pmod(F.xxhash64("doc_id"), F.col("salts")))
    return rows.withColumn("salt", salt).repartition(tasks, "sketch", "salt").select("doc_id", "text")


def report(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Per document: number of tokens and SHA-256 of its ids (little-endian, 32 bits) and of the decoded text.

    Null text is empty and has no tokens; strings of special tokens in a text are these tokens; repeated rows stay; a null id
    is kept; texts of any length are encoded whole; an empty table gives an empty result; other columns are ignored.
    """
    return _gathered(docs).mapInArrow(partial(_encode, path=tokenizer, digest=True),
                                      "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, ids, decoded): the ids themselves as little-endian 32-bit numbers, and the text decoded from them."""
    return _gathered(docs).mapInArrow(partial(_encode, path=tokenizer, digest=False), "doc_id long, ids binary, decoded string")
