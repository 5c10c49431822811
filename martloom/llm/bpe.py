"""Byte-level BPE in two tiers.

Most pre-tokens are whole vocabulary entries: a minimal perfect hash finds their rank
with one probe and one comparison. The others are merged from bytes, the lowest rank
first, on a linked list of parts with a heap of candidate pairs: n log n for any piece.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Pre-tokens whose ids a task remembers; then it starts anew.
REMEMBERED = 500_000
#: Keys in a bucket of the perfect hash, on average.
LOAD = 4
_MASK, _STEP = (1 << 64) - 1, 0x9E3779B97F4A7C15


def _place(h: np.ndarray, d: np.ndarray, n: int) -> np.ndarray:
    x = h + d * np.uint64(_STEP)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x % np.uint64(n)


class PerfectHash:
    """A slot of its own for each of n keys, n slots in all (hash and displace).

    Keys fall into buckets; each bucket, largest first, takes the first displacement
    that sends all its keys to free slots. Buckets of one key point at a slot directly.
    """

    def __init__(self, keys: list[bytes]):
        n = self.n = len(keys)
        self.buckets = max(1, n // LOAD)
        hashes = np.array([xxhash.xxh64_intdigest(k) for k in keys], np.uint64)
        if len(np.unique(hashes)) != n:
            raise ValueError("two keys are equal or share a hash")
        bucket = (hashes % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        members = np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1)
        self.shift = [0] * self.buckets
        slots, free = np.full(n, -1, np.int64), np.ones(n, bool)
        for own in sorted(members, key=len, reverse=True):
            if len(own) == 1:
                break
            tried = 1
            while True:
                d = np.arange(tried, tried + 1024, dtype=np.uint64)
                at = _place(hashes[own][None, :], d[:, None], n).astype(np.int64)
                good = free[at].all(axis=1)
                for row in np.flatnonzero(good):
                    if len(set(at[row].tolist())) == len(own):
                        break
                else:
                    tried += 1024
                    continue
                break
            slots[at[row]] = own
            free[at[row]] = False
            self.shift[bucket[own[0]]] = int(d[row])
        spare = iter(np.flatnonzero(free).tolist())
        for own in members:
            if len(own) == 1:
                at = next(spare)
                slots[at] = own[0]
                self.shift[bucket[own[0]]] = -1 - at
        self.slots = slots.tolist()
        self.keys = keys

    def find(self, key: bytes) -> int:
        """The key's index, or -1."""
        h = xxhash.xxh64_intdigest(key)
        d = self.shift[h % self.buckets]
        if d < 0:
            slot = -1 - d
        else:
            x = (h + d * _STEP) & _MASK
            x ^= x >> 29
            x = (x * 0xBF58476D1CE4E5B9) & _MASK
            x ^= x >> 32
            slot = x % self.n
        found = self.slots[slot]
        return found if self.keys[found] == key else -1


class Encoder(dict):
    """Pre-token -> its ids as little-endian 32-bit integers, made when first asked for."""

    def __init__(self, vocabulary: list[bytes], pattern: str):
        super().__init__()
        self.vocabulary = vocabulary
        self.split = regex.compile(pattern).findall
        self.perfect = PerfectHash(vocabulary)
        self.ranks = {entry: rank for rank, entry in enumerate(vocabulary)}  # of pairs, in the second tier
        self.longest = max(map(len, vocabulary))

    def __missing__(self, piece: str) -> bytes:
        raw = piece.encode()
        whole = self.perfect.find(raw)
        ids = [whole] if whole >= 0 else self.merge(raw)
        self[piece] = found = np.array(ids, "<u4").tobytes()
        return found

    def merge(self, raw: bytes) -> list[int]:
        """Ids of bytes that are no entry as a whole."""
        n, ranks, longest = len(raw), self.ranks, self.longest
        end = list(range(1, n + 1))  # of the part that starts here; 0: no part starts here any more
        before = list(range(-1, n))  # start of the part before the one that starts here
        pairs = ((ranks.get(raw[i : i + 2]), i, i + 2) for i in range(n - 1))
        heap = [p for p in pairs if p[0] is not None]
        heapq.heapify(heap)

        def propose(start: int, stop: int) -> None:
            if stop - start <= longest and (rank := ranks.get(raw[start:stop])) is not None:
                heapq.heappush(heap, (rank, start, stop))

        while heap:
            _, start, stop = heapq.heappop(heap)
            middle = end[start]
            if not middle or middle >= stop or end[middle] != stop:
                continue  # one of the two parts has become longer
            end[start], end[middle] = stop, 0
            before[stop] = start
            if stop < n:
                propose(start, end[stop])
            if before[start] >= 0:
                propose(before[start], stop)
        ids, at = [], 0
        while at < n:
            ids.append(ranks[raw[at : end[at]]])
            at = end[at]
        return ids

    def encode(self, text: str) -> bytes:
        if len(self) > REMEMBERED:
            self.clear()
        return b"".join(map(self.__getitem__, self.split(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def read_vocabulary(path: str) -> list[bytes]:
    """Entries by rank; ranks are 0 to n - 1 without gaps."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(key): int(rank) for key, rank in (x.split() for x in lines if x.strip())}
    entries = sorted(ranks, key=ranks.__getitem__)
    if [ranks[e] for e in entries] != list(range(len(entries))) or any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError(f"{path}: ranks must be gapless and every byte needs one")
    return entries


@cache
def encoder(name: str) -> Encoder:
    """One encoder for each worker process, kept between its tasks."""
    return Encoder(read_vocabulary(public_tokenizers.path(name)), public_tokenizers.PATTERN)


RESULT = T.StructType(
    [
        T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
)


def _digest(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


def encoded(text: Column, vocabulary: str = VOCABULARY, with_ids: bool = True) -> Column:
    """Struct of ids, n_tokens, ids_sha256 and decoded_sha256. Null counts as the empty text, which has no ids."""

    @F.arrow_udf(RESULT)
    def run(texts: pa.Array) -> pa.Array:
        own = encoder(vocabulary)
        ids, counts, digests, decoded = [], [], [], []
        for t in texts:
            raw = own.encode(t.as_py() or "")
            ids.append(np.frombuffer(raw, "<i4") if with_ids else None)
            counts.append(len(raw) // 4)
            digests.append(_digest(raw))
            decoded.append(_digest(own.decode(raw)))
        return pa.StructArray.from_arrays(
            [pa.array(ids, pa.list_(pa.int32())), pa.array(counts, pa.int64()), pa.array(digests), pa.array(decoded)],
            ["ids", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return run(text)


def decoded(ids: Column, vocabulary: str = VOCABULARY) -> Column:
    """The bytes of an array of ids; null for null."""

    @F.arrow_udf(T.BinaryType())
    def run(rows: pa.Array) -> pa.Array:
        own = encoder(vocabulary)
        return pa.array(
            [None if r is None else own.decode(np.array(r, "<u4").tobytes()) for r in rows.to_pylist()], pa.binary()
        )

    return run(ids)


def encode(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: the ids encoded, and decoded again.

    One row for each row of `docs`, without a shuffle; repeated rows repeat, null ids
    stay null, null texts count as empty, an empty table gives no rows, other columns
    are not read. `encoded` has the ids themselves.
    """
    e = docs.select("doc_id", encoded(F.col("text"), vocabulary, with_ids=False).alias("e"))
    return e.select("doc_id", "e.n_tokens", "e.ids_sha256", "e.decoded_sha256")

