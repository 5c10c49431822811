"""Document fingerprints from closed syncmers.

A piece of K code points is an anchor if the smallest hash of its inner pieces of S
code points lies at its first or last place. Whether it is one depends on these K code
points alone, so equal passages have equal anchors wherever they stand. About one piece
in (K - S + 1) / 2 is chosen, and no gap is longer than K - S.

A fingerprint keeps the anchors with the smallest hashes and where each first occurs.
Two fingerprints are compared on the anchors among the smallest of both: those that
both have, in the same order, against all.
"""

from __future__ import annotations

import hashlib
import json
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Length of a piece and of its inner pieces, in code points.
K, S = 24, 9
#: Anchors in a fingerprint, at most; those of the smallest hashes.
KEPT = 64
#: Ranges that the documents are cut into by id, to find each one's neighbour.
RANGES = 512
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _ODD[1]
    x = (x ^ (x >> np.uint64(27))) * _ODD[2]
    return x ^ (x >> np.uint64(31))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)


def _doubled(codes: np.ndarray, length: int) -> np.ndarray:
    """A polynomial hash of every piece of this length, put together from powers of two."""
    power, h, size = _ODD[0], codes + np.uint64(1), 1
    result, done = None, 0
    while True:
        if length & size:
            if result is None:
                result = h
            else:
                # what is there, then this block behind it
                n = len(codes) - done - size + 1
                result = result[:n] * power_of(power, size) + h[done : done + n]
            done += size
        if done == length:
            return result
        h = h[:-size] * power_of(power, size) + h[size:]
        size *= 2


def power_of(base: np.uint64, exponent: int) -> np.uint64:
    return np.uint64(pow(int(base), exponent, 1 << 64))


def anchors(codes: np.ndarray, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """Places and 32-bit hashes of the anchors of a text; none if it is shorter than k."""
    n = len(codes)
    if n < k:
        return np.zeros(0, np.int64), np.zeros(0, np.uint32)
    inner, width = _mixed(_doubled(codes, s)), k - s + 1
    least, size = inner, 1
    while size * 2 <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < width:
        least = np.minimum(least[: n - k + 1], least[width - size :])
    at = np.flatnonzero((inner[: n - k + 1] == least) | (inner[width - 1 :] == least))
    return at, _short(_doubled(codes, k)[at])


def _short(h: np.ndarray) -> np.ndarray:
    return (_mixed(h) >> np.uint64(32)).astype(np.uint32)


def sketch(codes: np.ndarray, places: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The KEPT smallest different hashes, and where each first occurs.

    A text without an anchor, because it is short or by chance, is one anchor as a whole;
    the empty text has none.
    """
    if not len(places) and len(codes):
        whole = np.frombuffer(hashlib.sha256(codes.tobytes()).digest()[:8], np.uint64)
        return _short(whole), np.zeros(1, np.int64)
    distinct, first = np.unique(hashes, return_index=True)
    return distinct[:KEPT], places[first[:KEPT]]


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Share of the anchors among the smallest of both that both have, in the same order. Two without any: 1."""
    union = np.union1d(a[0], b[0])[:KEPT]
    if not len(union):
        return 1.0
    common, in_a, in_b = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    use = common <= union[-1]
    order = np.argsort(a[1][in_a[use]], kind="stable")
    chain: list[int] = []  # longest rising run of places: smallest last place for each length
    for place in b[1][in_b[use]][order].tolist():
        k = bisect_left(chain, place)
        chain[k : k + 1] = [place]
    return len(chain) / len(union)


def written(fingerprint: tuple[np.ndarray, np.ndarray]) -> str:
    """hash and place of each anchor, 8 hexadecimal digits each, by hash."""
    both = np.stack([fingerprint[0].astype(">u4"), fingerprint[1].astype(">u4")], axis=1)
    return both.tobytes().hex()


def fingerprint(text: str | None) -> str:
    codes = _codes(text or "")
    return written(sketch(codes, *anchors(codes)))


def _edited(codes: np.ndarray, following: np.ndarray, found: tuple[np.ndarray, np.ndarray]) -> tuple:
    """The text with its last third replaced, and its sketch; only pieces that reach the edit are hashed again."""
    third = len(codes) // 3
    cut = len(codes) - third
    changed = np.concatenate([codes[:cut], following[:third]])
    start = max(cut - K + 1, 0)
    early = found[0] < start
    places, hashes = anchors(changed[start:])
    places = np.concatenate([found[0][early], places + start])
    return changed, sketch(changed, places, np.concatenate([found[1][early], hashes]))


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by range and then order; a guest closes its range and is only looked at."""
    before = None
    for batch in batches:
        out = []
        groups, guests, ids = (batch.column(c).to_pylist() for c in ("group", "guest", "doc_id"))
        for k, text in enumerate(batch.column("text")):
            codes = _codes(text.as_py() or "")
            found = anchors(codes)
            own = sketch(codes, *found)
            if before is not None and before[0] == groups[k]:
                _, doc_id, last, last_found, last_own = before
                changed, after = _edited(last, codes, last_found)
                digest = hashlib.sha256(changed.astype("<u4").tobytes().decode("utf-32-le").encode()).hexdigest()
                out.append((doc_id, len(last), digest, written(last_own), written(after),
                            likeness(last_own, after), likeness(last_own, own)))
            before = None if guests[k] else (groups[k], ids[k], codes, found, own)
        yield pa.RecordBatch.from_pylist([dict(zip(RESULT.names, r, strict=True)) for r in out], schema=RESULT)


RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)


RESULT_DDL = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def compare_with_next(docs: DataFrame, ranges: int = RANGES) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one of the next smaller id (after the last one the first).
    The ids are cut into ranges; one task sorts a range, and the first document of the
    following range comes along as a guest, so each text is shuffled once. Rows of the
    same id come by their texts' hashes, repeated rows follow each other. Null ids come
    last; they are spread over ranges of their own by the texts' hashes. Null texts count
    as empty: no anchors, and likeness 1 to each other. A single document is its own
    next one. An empty table gives no rows. Other columns are not read.
    """
    texts = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"))
    # at most `ranges` bounds reach the driver
    steps = [k / ranges for k in range(1, ranges)]
    found = texts.agg(F.percentile_approx("doc_id", steps, 10 * ranges)).first()[0]
    bounds = sorted(set(found or []), reverse=True)
    # ranges are numbered in the order of documents: larger ids first
    cut = F.array(*[F.lit(b).cast("long") for b in bounds]) if bounds else F.array().cast("array<bigint>")
    inside = F.size(F.filter(cut, lambda b: b > F.col("doc_id")))
    null_range = len(bounds) + 1 + F.shiftrightunsigned(F.col("text_key").bitwiseXOR(F.lit(-(1 << 63))), 64 - 6)
    group = F.when(F.col("doc_id").isNull(), null_range).otherwise(inside.cast("long"))
    placed = texts.withColumn("group", group.cast("int"))
    first = F.min(F.struct((-F.col("doc_id")).alias("order"), "text_key")).alias("first")
    heads = placed.groupBy("group").agg(first).orderBy("group").collect()
    if not heads:
        return placed.select("group", F.lit(False).alias("guest"), "doc_id", "text").mapInArrow(_pairs, RESULT_DDL)
    # the head of each range is the guest of the range before it
    hosts = {(h["first"]["order"], h["first"]["text_key"]): heads[k - 1].group for k, h in enumerate(heads)}
    pairs = F.from_json(
        F.lit(json.dumps([{"order": o, "key": t, "host": g} for (o, t), g in hosts.items()])),
        "array<struct<order:bigint,key:bigint,host:int>>",
    )
    table = docs.sparkSession.range(1).select(F.explode(pairs).alias("h")).select("h.*")
    guests = (
        placed.join(
            F.broadcast(table),
            (-F.col("doc_id")).eqNullSafe(F.col("order")) & (F.col("text_key") == F.col("key")),
        )
        .groupBy("host")
        .agg(F.min("doc_id").alias("doc_id"), F.min("text").alias("text"), F.min("text_key").alias("text_key"))
        .select("doc_id", "text", "text_key", F.col("host").alias("group"), F.lit(True).alias("guest"))
    )
    rows = placed.select("doc_id", "text", "text_key", "group", F.lit(False).alias("guest")).unionByName(guests)
    dealt = rows.repartition("group").sortWithinPartitions("group", "guest", F.col("doc_id").desc_nulls_last(), "text_key")
    return dealt.select("group", "guest", "doc_id", "text").mapInArrow(_pairs, RESULT_DDL)

