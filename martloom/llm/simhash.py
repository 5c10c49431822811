"""Near-duplicates by SimHash, compared bit-sliced.

A fingerprint has 64 bits, one for each bit that more than half of the shingle hashes
have set. Two texts are linked if their fingerprints differ in few bits.

Candidates meet exactly: of two fingerprints within the radius, one of four 16-bit
blocks is equal, and of the other 48 bits one of four 12-bit parts. So 16 keys of 28
bits bring every such pair together, and a key is shared by few others even among
billions. Inside a key, fingerprints are stored as bit planes: 64 distances advance
with one XOR, and carry-save counters keep them until all have left the radius.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.links import components
from martloom.session import materialize

#: Largest number of differing bits of a link.
RADIUS = 3
#: Words of a shingle.
SHINGLE = 3
#: Fingerprints that one comparison holds; larger keys are cut into blocks and all pairs of blocks compared.
BLOCK = 1024
#: Fixed value: the seed of the hash.
SEED = 42
#: Hashes counted at once.
PIECE = 1 << 16


def fingerprint(text: str | None) -> int:
    """SimHash of a text as a signed 64-bit number; zero without words."""
    # on UTF-8 bytes, lower() and split() know ASCII letters and ASCII white space only
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= SHINGLE:
        return int(np.uint64(xxhash.xxh64_intdigest(line, SEED)).astype(np.int64))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: 1 - SHINGLE].tolist()
    ends = ends[SHINGLE - 1 :].tolist()
    hashed, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(starts), PIECE):
        part = zip(starts[at : at + PIECE], ends[at : at + PIECE], strict=True)
        h = np.array([hashed(line[s:e], SEED) for s, e in part], "<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(starts), bitorder="little")
    return int(bits.view("<i8")[0])


@F.pandas_udf(T.LongType())
def fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(t) for t in texts], dtype="int64")


def _bits(value: Column, low: int, width: int) -> Column:
    return F.shiftrightunsigned(value, low).bitwiseAND(F.lit((1 << width) - 1))


def block_keys(value: Column) -> Column:
    """The 16 keys of a fingerprint: a 16-bit block, one 12-bit part of the rest, and which."""
    keys = []
    for b in range(4):
        # the other three blocks, next to each other
        rest = F.lit(0).cast("long")
        for n, other in enumerate(x for x in range(4) if x != b):
            rest = rest.bitwiseOR(F.shiftleft(_bits(value, 16 * other, 16), 16 * n))
        for p in range(4):
            key = F.shiftleft(_bits(value, 16 * b, 16), 12).bitwiseOR(_bits(rest, 12 * p, 12))
            keys.append(key.bitwiseOR(F.lit((4 * b + p) << 28).cast("long")))
    return F.array(*keys)


def near_pairs(values: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Square boolean matrix: which of these fingerprints differ in at most `radius` bits.

    Bit j of plane p, over all words, is bit p of fingerprint j.
    """
    n = len(values)
    v = values.astype(np.uint64)
    width = -(-n // 64)
    padded = np.zeros(width * 64, np.uint64)
    padded[:n] = v
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    planes = np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view(np.uint64)
    ones, zero = np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0)
    alive = np.arange(n)
    low, high, over = (np.zeros((n, width), np.uint64) for _ in range(3))
    for p in range(64):
        own = np.where((v[alive] >> np.uint64(p)) & np.uint64(1), ones, zero)
        x = planes[p][None, :] ^ own[:, None]
        carry = low & x
        low ^= x
        over |= high & carry
        high ^= carry
        if p % 8 == 7:
            # every fingerprint is within the radius of itself, so look at the others
            keep = np.bitwise_count(~over).sum(axis=1) > 1
            if not keep.all():
                alive, low, high, over = alive[keep], low[keep], high[keep], over[keep]
                if not len(alive):
                    break
    near = np.eye(n, dtype=bool)
    if len(alive):
        # two counter bits hold 0 to 3; a third bit is lost into `over`
        within = ~over
        for r in range(radius + 1, 4):
            within &= ~((low if r & 1 else ~low) & (high if r & 2 else ~high))
        near[alive] = np.unpackbits(np.ascontiguousarray(within).view(np.uint8), axis=1, bitorder="little")[:, :n].astype(bool)
    return near


def _forest(values: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """Members and smallest member of each group of two or more linked fingerprints."""
    near, left = near_pairs(values), np.ones(len(values), bool)
    for seed in np.flatnonzero(near.sum(axis=1) > 1):
        if not left[seed]:
            continue
        group, edge = np.zeros(len(values), bool), np.array([seed])
        group[seed] = True
        while len(edge):
            reached = near[edge].any(axis=0) & ~group
            group |= reached
            edge = np.flatnonzero(reached)
        left &= ~group
        members = values[group]
        yield members, int(members.min())


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links from rows sorted by cell. Small cells share a comparison; no cell is cut."""
    cells, rest = [], np.zeros((0, 2), np.int64)

    def links(parts: list[np.ndarray]) -> pa.RecordBatch:
        values = np.unique(np.concatenate(parts))
        a, b = [], []
        for members, root in _forest(values):
            others = members[members != root]
            a.append(others)
            b.append(np.full(len(others), root))
        both = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b)]
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in both], ["a", "b"])

    held = 0
    for batch in batches:
        rows = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()], axis=1)
        rows = np.concatenate([rest, rows])
        cuts = np.flatnonzero(np.diff(rows[:, 0])) + 1
        *whole, rest = np.split(rows, cuts) if len(rows) else [rows]
        for cell in whole:
            cells.append(cell[:, 1])
            held += len(cell)
            if held >= BLOCK // 4:
                yield links(cells)
                cells, held = [], 0
    if len(rest) or cells:
        yield links([*cells, rest[:, 1]])


def fingerprint_links(distinct: DataFrame) -> DataFrame:
    """Links (a, b) that join all fingerprints (column fp, each once) within the radius.

    Not every pair: in each comparison a group of linked fingerprints gives one link for
    each member, which leaves the components the same. A key with many fingerprints is
    cut into blocks of about BLOCK, and each pair of blocks is one comparison.
    """
    keyed = distinct.select("fp", F.explode(block_keys(F.col("fp"))).alias("key"))
    shared = keyed.groupBy("key").count().where("count > 1")
    blocks = F.ceil(F.col("count") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("blocks")).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: o != F.col("own"))
    cells = (
        keyed.join(shared, "key")
        .withColumn("blocks", blocks)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(others)))
        .select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("cell"), "fp")
    )
    return cells.repartition("cell").sortWithinPartitions("cell").mapInArrow(_compare, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint, component_id for every document.

    component_id is the smallest doc_id that can be reached through links. Null and
    empty texts have fingerprint zero and are linked like any other. Null ids take part
    but never name a component with other ids; a component of null ids only has null.
    Repeated rows are equal texts. Empty table: no rows. Other columns are not read.
    """
    marked = materialize(docs.select("doc_id", fingerprints("text").alias("fp")), "fingerprints")
    distinct = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = components(fingerprint_links(distinct.select("fp")))
    named = distinct.join(roots, distinct.fp == roots.node, "left").withColumn("root", F.coalesce("root", "fp"))
    classes = named.groupBy("root").agg(F.min("first").alias("component_id"))
    by_fp = named.join(classes, "root").select("fp", "component_id")
    return marked.join(by_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """`docs` without near-duplicates: of each component the row with the smallest id stays.

    Rows of the same id come in the order of their texts' hashes; of repeated rows one
    stays. The cases of `near_duplicates` apply. Columns whose names start with __sim are taken.
    """
    key = [F.col("doc_id").alias("__sim_id"), F.xxhash64("text").alias("__sim_text")]
    marked = materialize(docs.select(*key, fingerprints("text").alias("fp")), "fingerprints")
    order = F.struct(F.col("__sim_id").isNull().alias("none"), "__sim_id", "__sim_text")
    distinct = materialize(marked.groupBy("fp").agg(F.min(order).alias("first")), "distinct")
    roots = components(fingerprint_links(distinct.select("fp")))
    named = distinct.join(roots, distinct.fp == roots.node, "left")
    kept = named.groupBy(F.coalesce("root", "fp")).agg(F.min("first").alias("first")).select("first.*")
    same = F.col("doc_id").eqNullSafe(F.col("__sim_id")) & (F.col("__sim_hash") == F.col("__sim_text"))
    rows = docs.withColumn("__sim_hash", F.xxhash64("text")).join(kept, same, "left_semi")
    return rows.dropDuplicates(["doc_id", "__sim_hash"]).drop("__sim_hash")
