"""Byte-level BPE encoding and decoding.

Two tiers. A minimal perfect hash over the vocabulary resolves every pre-token that is a
vocabulary entry as a whole; it is looked up for all distinct pre-tokens of a batch at once.
Pre-tokens that are no entry are merged from linked single bytes with a heap of candidate
merges ordered by (rank, position), which costs n log n for a pre-token of n bytes.

The vocabulary (ranks file) is read on the driver, as executors may not have it, and broadcast;
its size is that of the file, whatever the corpus. Texts are encoded whole, each row alone, so
nothing is shuffled and a lost task is simply run again.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm.shared import broadcast

#: Characters of text that a worker splits at a time; bounds the memory for pre-tokens.
SLICE_CHARS = 1 << 20
#: Bytes of memory, about, for the distinct pre-tokens that a worker remembers before it begins a new generation; it holds two.
MEMO = 64 << 20
#: Bytes that a pre-token and its ids take, about, besides two for each character.
ENTRY = 180


#: Links of pieces of up to so many bytes.
_AFTER, _BEFORE = list(range(1, 257)), list(range(-1, 256))


class PerfectHash:
    """Minimal perfect hash (hash, displace): n keys to the slots 0..n-1 without collision.

    Buckets of about four keys, the largest first, each get the first displacement that sends all
    their keys to free slots; buckets of one key store their slot itself, as -1 - slot.
    """

    def __init__(self, keys: list[bytes]):
        n = max(len(keys), 1)
        self.n, self.buckets = n, max(1, n // 4)
        self.hashes = hashes_of(keys)
        if len(np.unique(self.hashes)) != len(keys):
            raise ValueError("two keys have one 64-bit hash")
        where = (self.hashes % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(where, kind="stable")
        sizes = np.bincount(where, minlength=self.buckets)
        starts = np.concatenate(([0], np.cumsum(sizes)))
        self.shift = np.zeros(self.buckets, np.int64)
        taken = np.zeros(n, bool)
        self.slot_key = np.full(n, -1, np.int64)
        seeds = np.arange(1, 257, dtype=np.int64)
        by_size = np.argsort(-sizes, kind="stable")
        for b in by_size[sizes[by_size] > 1]:
            members = order[starts[b] : starts[b + 1]]
            first = 0
            while True:
                slots = self._mix(self.hashes[members][None, :], (seeds + first)[:, None])
                fits = ~taken[slots].any(axis=1)
                fits &= (np.diff(np.sort(slots, axis=1), axis=1) > 0).all(axis=1)
                if fits.any():
                    at = int(np.argmax(fits))
                    break
                first += len(seeds)
            self.shift[b] = seeds[at] + first
            taken[slots[at]] = True
            self.slot_key[slots[at]] = members
        free = iter(np.flatnonzero(~taken))
        for b in np.flatnonzero(sizes == 1):
            slot = next(free)
            self.shift[b] = -1 - slot
            self.slot_key[slot] = order[starts[b]]

    def _mix(self, h: np.ndarray, shift: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            x = (h ^ (h >> np.uint64(29))) + shift.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            x ^= x >> np.uint64(32)
        return (x % np.uint64(self.n)).astype(np.int64)

    def slots(self, h: np.ndarray) -> np.ndarray:
        shift = self.shift[(h % np.uint64(self.buckets)).astype(np.int64)]
        return np.where(shift < 0, -1 - shift, self._mix(h, shift))


def hashes_of(keys: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))


class Vocabulary:
    """Tokens by id, the perfect hash over them and the pattern that cuts text into pre-tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = pattern
        self.keys = list(ranks)
        self.ids = np.fromiter(ranks.values(), np.int64, len(ranks))
        self.hash = PerfectHash(self.keys)
        self._ranks = self._pairs = self._find = self._bytes = None
        self._memo: dict[str, bytes] = {}  # pre-token to its ids, as 32-bit integers
        self._older: dict[str, bytes] = {}  # the generation before; what is met again goes over to the new one
        self._held = 0  # bytes in _memo

    def __getstate__(self):
        return self.__dict__ | {"_ranks": None, "_pairs": None, "_find": None, "_bytes": None, "_memo": {}, "_older": {}, "_held": 0}

    @classmethod
    def load(cls, spark: SparkSession, path: str, pattern: str) -> "Vocabulary":
        """Reads a file of lines 'base64-token rank'."""
        if "://" in path:
            lines = [r[0].encode() for r in spark.read.text(path).collect()]  # a vocabulary file: bounded
        else:
            with open(path, "rb") as f:
                lines = f.read().splitlines()
        return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(None, lines))}, pattern)

    def merge(self, piece: bytes) -> list[int]:
        """The second tier: linked bytes, and a heap of the merges that neighbours allow."""
        if self._ranks is None:
            self._ranks = dict(zip(self.keys, self.ids.tolist()))
            self._pairs = [self._ranks.get(bytes((a, b)), -1) for a in range(256) for b in range(256)]
        rank, n = self._ranks.get, len(piece)
        if n == 1:
            return [rank(piece)]
        shift = n.bit_length()
        after, before = (_AFTER[:n], _BEFORE[: n + 1]) if n < len(_AFTER) else (list(range(1, n + 1)), list(range(-1, n)))  # the links; the part at i ends at after[i]
        pairs = self._pairs
        pair = [pairs[a << 8 | b] for a, b in zip(piece, piece[1:])]  # rank of the part at i joined with the next one
        heap = [r << shift | i for i, r in enumerate(pair) if r >= 0]
        left = len(heap)  # merges that are still possible; the heap also holds some that no longer are
        pair.append(-1)
        heapify(heap)
        mask = (1 << shift) - 1
        while left:
            x = heappop(heap)
            i = x & mask
            if pair[i] != x >> shift:
                continue  # one of the two parts has been merged meanwhile
            j = after[i]
            stop = after[i] = after[j]
            left -= 1 if pair[j] < 0 else 2
            pair[i] = pair[j] = -1
            if stop < n:
                before[stop] = i
                if (r := rank(piece[i : after[stop]], -1)) >= 0:
                    pair[i] = r
                    heappush(heap, r << shift | i)
                    left += 1
            if (p := before[i]) >= 0:
                r = rank(piece[p:stop], -1)
                left += (r >= 0) - (pair[p] >= 0)
                pair[p] = r
                if r >= 0:
                    heappush(heap, r << shift | p)
        out, i = [], 0
        while i < n:
            out.append(rank(piece[i : after[i]]))
            i = after[i]
        return out

    def recall(self, pieces: set[str]) -> None:
        """Sees to it that the memo has these pre-tokens. A full memo becomes the older generation, from which those met
        again are taken over, so that pre-tokens in use are not merged anew."""
        if self._held > MEMO:
            self._older, self._memo, self._held = self._memo, {}, 0
        if missing := pieces.difference(self._memo):
            new = missing.difference(self._older)
            old = missing - new
            self._memo.update(zip(old, map(self._older.__getitem__, old)))
            self.resolve(list(new))
            self._held += ENTRY * len(missing) + 2 * sum(map(len, missing))

    def resolve(self, pieces: list[str]) -> None:
        """Enters the ids of new distinct pre-tokens in the memo: the first tier for all of them at once."""
        raw = [p.encode() for p in pieces]
        hashes = hashes_of(raw)
        slots = self.hash.slots(hashes)
        at = self.hash.slot_key[slots]
        hit = (at >= 0) & (self.hash.hashes[at] == hashes)
        keys, memo = self.keys, self._memo
        for p, b, k, h in zip(pieces, raw, at.tolist(), hit.tolist()):
            memo[p] = array("i", [int(self.ids[k])] if h and keys[k] == b else self.merge(b)).tobytes()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, list[int]]:
        """The ids of all texts in one row, and how many each text has."""
        if self._find is None:
            self._find = regex.compile(self.pattern).findall
        flat, counts, start = [], [], 0
        while start < len(texts):
            stop, chars = start, 0
            while stop < len(texts) and (stop == start or chars + len(texts[stop]) <= SLICE_CHARS):
                chars += len(texts[stop])
                stop += 1
            found = [self._find(t) for t in texts[start:stop]]
            self.recall(set(chain.from_iterable(found)))
            of = self._memo.__getitem__
            for pieces in found:
                ids = np.frombuffer(b"".join(map(of, pieces)), np.int32)
                flat.append(ids)
                counts.append(len(ids))
            start = stop
        return (np.concatenate(flat) if flat else np.empty(0, np.int32)), counts

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a column's texts in one row and where each text's begin; few texts are Python objects at a time."""
        parts = [self.encode([t or "" for t in texts[at : at + 256].to_pylist()]) for at in range(0, len(texts), 256)]
        ids = np.concatenate([p for p, _ in parts]) if parts else np.empty(0, np.int32)
        return ids, np.concatenate(([0], np.cumsum([n for _, c in parts for n in c]))).astype(np.int32)

    def decode_column(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """The bytes of the ids from each offset to the next; an id that is no entry becomes the replacement character."""
        if self._bytes is None:
            table = ["�".encode()] * (int(self.ids.max(initial=-1)) + 2)
            for k, t in zip(self.ids.tolist(), self.keys):
                table[k] = t
            self._bytes = pa.array(table, pa.large_binary())
        none = len(self._bytes) - 1
        tokens = self._bytes.take(pa.array(np.where((ids >= 0) & (ids < none), ids, none)))
        # the bytes of consecutive tokens lie side by side, so rows only need their own offsets
        _, ends, data = tokens.buffers()
        at = np.frombuffer(ends, np.int64)[tokens.offset :][offsets] if len(tokens) else np.zeros(len(offsets), np.int64)
        if at[-1] > np.iinfo(np.int32).max:
            raise ValueError("over 2 GB of decoded bytes at once")
        return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(at.astype(np.int32)), data or pa.py_buffer(b"")])

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """decode_column() as Python objects."""
        return self.decode_column(ids, offsets).to_pylist()


def _lists(ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))


def encode(df: DataFrame, vocabulary: Vocabulary, text: str = "text", out: str = "ids") -> DataFrame:
    """Adds the token ids of column text, as array<int>.

    Null and empty texts have no ids. Rows are independent: repeated rows, other columns and
    an empty table pass as they are. A column named out is replaced.
    """
    shared = broadcast(df.sparkSession, vocabulary)

    @F.arrow_udf("array<int>")
    def ids_of(texts: pa.Array) -> pa.Array:
        return _lists(*shared.value.encode_column(texts))

    return df.withColumn(out, ids_of(F.col(text)))


def decode(df: DataFrame, vocabulary: Vocabulary, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds the bytes that column ids stands for. Null: no bytes. Ids that the vocabulary
    lacks become the replacement character. A column named out is replaced."""
    shared = broadcast(df.sparkSession, vocabulary)

    @F.arrow_udf("binary")
    def bytes_of(rows: pa.Array) -> pa.Array:
        rows = rows.fill_null([]) if rows.null_count else rows
        flat = rows.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
        offsets = np.asarray(rows.offsets)
        return shared.value.decode_column(flat, offsets - offsets[0])

    return df.withColumn(out, bytes_of(F.col(ids)))


def round_trip(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Encodes documents and decodes the ids, in one pass. Returns doc_id, ids and decoded as encode()
    and decode() define them; other columns go, so none can clash."""
    shared = broadcast(docs.sparkSession, vocabulary)

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, len(b), 256):  # so that few results wait in memory
                part = b.slice(at, 256)
                ids, offsets = shared.value.encode_column(part.column(1))
                yield pa.RecordBatch.from_arrays([part.column(0), _lists(ids, offsets), shared.value.decode_column(ids, offsets)], ["doc_id", "ids", "decoded"])
            pa.default_memory_pool().release_unused()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(both, f"doc_id {kind}, ids array<int>, decoded binary")


def digests(rows: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids, joined by commas), decoded_sha256."""
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
