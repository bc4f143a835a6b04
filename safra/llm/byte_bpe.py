"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier one: a minimal perfect hash over the vocabulary resolves every pre-token that is
itself a vocabulary entry. Tier two: any other pre-token is merged by a heap of pair
ranks over a doubly linked list of its parts. Tables are built once on the driver from
the rank file and broadcast: their size is that of the vocabulary, not of the data.

Texts are cut before each space that a non-space follows; no match of the pre-token
pattern crosses such a cut, so a worker can remember the ids of whole pieces. The
memory is bounded by ``MEMO`` pieces and only saves work.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import byte_slices, handing_back, read_table, text_sizes

#: Characters with the Unicode property White_Space (fixed values).
SPACES = "\t-\r \x85\xa0  -     　"
#: Pieces and pre-tokens that a worker remembers, and the characters of one at most: 200 MB at the very worst, 60 MB with usual words.
MEMO, MEMO_LENGTH = 300_000, 32
BATCH_BYTES = 1 << 20
_MULT = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def read_ranks(path: str) -> list[bytes]:
    """Vocabulary entries by rank from a file of ``base64 rank`` lines."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    out = [b""] * len(pairs)
    for token, rank in pairs:
        out[int(rank)] = base64.b64decode(token)
    return out


def _powers(n: int) -> np.ndarray:
    p = np.full(n, _MULT)
    p[:1] = 1
    return np.multiply.accumulate(p)


def _hashes(flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each byte string."""
    sizes = np.diff(offsets)
    out = np.zeros(len(sizes), np.uint64)
    full = sizes > 0
    if full.any():
        starts = offsets[:-1]
        inner = np.arange(len(flat)) - np.repeat(starts, sizes)
        terms = (flat.astype(np.uint64) + np.uint64(1)) * _powers(int(sizes.max()))[inner]
        out[full] = np.add.reduceat(terms, starts[full])
    out ^= out >> np.uint64(32)
    return out * _MIX + sizes.astype(np.uint64)


def _slots(h: np.ndarray, seeds: np.ndarray, n: int) -> np.ndarray:
    x = (h ^ (seeds.astype(np.uint64) * _MULT)) * _MIX
    x ^= x >> np.uint64(29)
    return ((x * _MULT) >> np.uint64(17)).astype(np.int64) % n


class PerfectHash:
    """Minimal perfect hash of n distinct byte strings onto 0..n-1 (hash and displace)."""

    def __init__(self, keys: list[bytes]):
        n = self.n = max(1, len(keys))
        flat = np.frombuffer(b"".join(keys), np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int64)
        h = _hashes(flat, offsets)
        self.buckets = max(1, n // 4)
        bucket = (h % np.uint64(self.buckets)).astype(np.int64)
        members: dict[int, list[int]] = {}
        for i, b in enumerate(bucket.tolist()):
            members.setdefault(b, []).append(i)
        self.displace = np.zeros(self.buckets, np.int64)
        self.entry = np.full(n, -1, np.int64)
        taken = np.zeros(n, bool)
        tries = np.arange(1, 257)
        for b, own in sorted(members.items(), key=lambda x: -len(x[1])):
            if len(own) == 1:
                break
            base = 0
            while not self.displace[b]:
                seeds = tries + base
                at = np.stack([_slots(np.repeat(h[i], len(seeds)), seeds, n) for i in own])
                free = ~taken[at].any(0)
                at_sorted = np.sort(at, axis=0)
                free &= (at_sorted[1:] != at_sorted[:-1]).all(0)
                if free.any():
                    k = int(np.argmax(free))
                    self.displace[b] = seeds[k]
                    taken[at[:, k]] = True
                    self.entry[at[:, k]] = own
                base += len(seeds)
        spare = iter(np.flatnonzero(~taken).tolist())
        for b, own in members.items():
            if len(own) == 1:
                slot = next(spare)
                self.displace[b] = -slot - 1
                self.entry[slot] = own[0]
        self.flat, self.offsets = flat, offsets

    def find(self, flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The number of each byte string among the keys, or -1."""
        h = _hashes(flat, offsets)
        d = self.displace[(h % np.uint64(self.buckets)).astype(np.int64)]
        slot = np.where(d < 0, -d - 1, _slots(h, np.maximum(d, 0), self.n))
        key = self.entry[slot]
        sizes = np.diff(offsets)
        same = (key >= 0) & (np.diff(self.offsets)[np.maximum(key, 0)] == sizes)
        maybe = np.flatnonzero(same)
        if len(maybe):  # the bytes decide
            n = sizes[maybe]
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            equal = flat[np.repeat(offsets[:-1][maybe], n) + at] == self.flat[np.repeat(self.offsets[:-1][key[maybe]], n) + at]
            differ = np.zeros(len(maybe), np.int64)
            np.add.at(differ, np.repeat(np.arange(len(maybe)), n)[~equal], 1)
            same[maybe[differ > 0]] = False
        return np.where(same, key, -1)


def merge_pairs(vocabulary: list[bytes]) -> dict[int, int]:
    """``left id << 32 | right id`` to merged id, for every split of an entry into two entries."""
    ids = {t: i for i, t in enumerate(vocabulary)}
    pairs = {}
    for token, i in ids.items():
        for cut in range(1, len(token)):
            left = ids.get(token[:cut])
            if left is not None and (right := ids.get(token[cut:])) is not None:
                pairs[left << 32 | right] = i
    return pairs


def heap_merge(piece: bytes, byte_ids: list[int], pairs: dict[int, int]) -> list[int]:
    """Merge the pair of lowest rank, leftmost first, until no pair is an entry."""
    part = [byte_ids[b] for b in piece]
    n = len(part)
    get = pairs.get
    heap = [r << 32 | i for i in range(n - 1) if (r := get(part[i] << 32 | part[i + 1])) is not None]
    heapify(heap)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    while heap:
        top = heappop(heap)
        i = top & 0xFFFFFFFF
        left = part[i]
        j = after[i]
        if left < 0 or j >= n or get(left << 32 | part[j]) != top >> 32:
            continue  # one of the two has been merged since
        part[i] = left = top >> 32
        part[j] = -1
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (r := get(left << 32 | part[k])) is not None:
                heappush(heap, r << 32 | i)
        k = before[i]
        if k >= 0 and (r := get(part[k] << 32 | left)) is not None:
            heappush(heap, r << 32 | k)
    return [p for p in part if p >= 0]


class Codec:
    """Encodes and decodes texts; ids are little-endian unsigned 32-bit integers."""

    def __init__(self, vocabulary: list[bytes], pattern: str):
        self.vocabulary = vocabulary
        self.pattern = pattern
        self.hash = PerfectHash(vocabulary)
        self.pairs = merge_pairs(vocabulary)
        ids = {t: i for i, t in enumerate(vocabulary)}
        self.byte_ids = [ids[bytes([b])] for b in range(256)]
        self._ready()

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("find", "inner", "odd", "cut", "tokens", "pieces", "long")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._ready()

    def _ready(self) -> None:
        self.find = regex.compile(self.pattern.replace(r"[^\s", f"[^{SPACES}").replace(r"\S", f"[^{SPACES}]").replace(r"\s", f"[{SPACES}]")).findall
        self.odd = regex.compile(f" (?=[{SPACES}]|\\Z)").search
        self.cut = regex.compile(f" (?=[^{SPACES}])").split
        self.tokens: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        #: Long ones, which are forgotten when the texts that hold them are done.
        self.long: list[tuple[dict[str, bytes], str]] = []

    def _learn(self, missing: set[str]) -> None:
        """Ids of pieces (without the space before them) and of their pre-tokens."""
        tokens, find = self.tokens, self.find
        split = {p: find(" " + p) for p in missing}
        self._resolve({t for found in split.values() for t in found})
        pieces = self.pieces
        self.long += [(pieces, p) for p in missing if len(p) > MEMO_LENGTH]
        for p, found in split.items():
            pieces[p] = tokens[found[0]] if len(found) == 1 else b"".join([tokens[t] for t in found])

    def _resolve(self, wanted: set[str]) -> None:
        tokens = self.tokens
        new = [t for t in wanted if t not in tokens]
        if not new:
            return
        self.long += [(tokens, t) for t in new if len(t) > MEMO_LENGTH]
        raw = [t.encode() for t in new]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
        ids = self.hash.find(np.frombuffer(b"".join(raw), np.uint8), offsets)
        for t, x, i, as_bytes in zip(new, raw, ids.tolist(), memoryview(ids.astype("<u4").tobytes()).cast("I"), strict=True):
            if i >= 0:
                tokens[t] = int(as_bytes).to_bytes(4, "little")
            else:
                tokens[t] = np.array(heap_merge(x, self.byte_ids, self.pairs), "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, end to end."""
        cut = [t.split(" ") if self.odd(t) is None else self.cut(t) for t in texts]
        if len(self.pieces) > MEMO or len(self.tokens) > MEMO:
            self.pieces.clear()
            self.tokens.clear()
        missing: set[str] = set()
        for parts in cut:
            missing.update(set(parts[1:]).difference(self.pieces))
        if missing:
            self._learn(missing)
        known, out = self.pieces, []
        firsts = [self.find(parts[0]) for parts in cut]
        self._resolve({t for found in firsts for t in found})
        tokens = self.tokens
        for found, parts in zip(firsts, cut, strict=True):
            ids = [tokens[t] for t in found]
            ids.extend([known[p] for p in parts[1:]])
            out.append(b"".join(ids))
        for memo, key in self.long:
            memo.pop(key, None)
        self.long.clear()
        return out

    def decode(self, ids: bytes) -> bytes:
        entries = self.vocabulary
        return b"".join([entries[i] for i in memoryview(ids).cast("I")])


def load_codec(path: str | None = None, pattern: str | None = None) -> Codec:
    """From a rank file; by default the multilingual one of the public tokenizers."""
    if path is None or pattern is None:
        import public_tokenizers

        path = path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
        pattern = pattern or public_tokenizers.PATTERN
    return Codec(read_ranks(path), pattern)


def _encoded(docs: DataFrame, codec: Codec, id_col: str, text_col: str, out: list[str]) -> DataFrame:
    """``doc_id, n_tokens`` and of ``ids, ids_sha256, decoded_sha256`` those in ``out``, from one encoding in one worker a task."""
    shared = docs.sparkSession.sparkContext.broadcast(codec)
    sha = hashlib.sha256

    @handing_back
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        made = {
            "ids": lambda ids: pa.array(ids, pa.binary()),
            "ids_sha256": lambda ids: pa.array([sha(x).hexdigest() for x in ids], pa.string()),
            "decoded_sha256": lambda ids: pa.array([sha(own.decode(x)).hexdigest() for x in ids], pa.string()),
        }
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for a, b in byte_slices(text_sizes(texts), BATCH_BYTES):
                ids = own.encode(texts.slice(a, b - a).to_pylist())
                yield pa.RecordBatch.from_arrays([keys.slice(a, b - a), pa.array([len(x) // 4 for x in ids], pa.int64()), *[made[c](ids) for c in out]], ["doc_id", "n_tokens", *out])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    types = {"ids": "binary", "ids_sha256": "string", "decoded_sha256": "string"}
    return rows.mapInArrow(encode, ", ".join(["doc_id long", "n_tokens long", *[f"{c} {types[c]}" for c in out]]))


def encode_documents(docs: DataFrame, codec: Codec, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids`` (binary, little-endian uint32) for each row; null texts encode to no ids."""
    return _encoded(docs, codec, id_col, text_col, ["ids"])


def round_trip(docs: DataFrame, codec: Codec, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: encodes each text, decodes the ids, digests both.

    One row per row, repeated rows included. A null or empty text has no tokens. Every
    text is encoded whole, in one worker, whatever its length. An empty table gives no rows; other columns are not read.
    """
    return _encoded(docs, codec, id_col, text_col, ["ids_sha256", "decoded_sha256"])


def encoded(docs: DataFrame, codec: Codec, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``encode_documents`` with the digests of ``round_trip`` beside the ids, from one encoding."""
    return _encoded(docs, codec, id_col, text_col, ["ids", "ids_sha256", "decoded_sha256"])


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(read_table(spark, sf_dir, "documents"), load_codec())
