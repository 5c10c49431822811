"""Approximate nearest neighbours: a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample; every vector is then put into a leaf. A query
opens nodes in the order of their centres' distances, through one priority queue, and
visits so many leaves as a calibration against exact search has shown to be enough.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.session import materialize

#: Vectors that the tree is fitted on, at most about; chosen by hash of the id.
SAMPLE = 20_000
#: Children of a node, sample vectors of a leaf.
BRANCH, LEAF = 16, 64
#: Rounds of k-means in a node.
ROUNDS = 8
#: Queries that the number of leaves is calibrated on, at most about, and the recall to reach.
CALIBRATE, RECALL = 64, 0.97
#: Vectors that one task compares, about.
BLOCK = 4096


@dataclass
class Tree:
    """Nodes in one list; node 0 is the root. Leaves are numbered on their own."""

    centres: np.ndarray
    children: list[list[int]]
    #: Number of the leaf, or -1 for an inner node.
    leaf: np.ndarray

    @property
    def leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def place(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector: the nearest child, from the root down."""
        node = np.zeros(len(vectors), np.int64)
        while True:
            inner = np.flatnonzero(self.leaf[node] < 0)
            if not len(inner):
                return self.leaf[node]
            for n in np.unique(node[inner]):
                at = inner[node[inner] == n]
                own = np.array(self.children[n])
                node[at] = own[_squares(vectors[at], self.centres[own]).argmin(axis=1)]

    def order(self, query: np.ndarray, limit: int, sizes: list[int] | None = None, least: int = 0) -> list[int]:
        """The first `limit` leaves, best bin first, and more until they hold `least` vectors."""
        found, queue, held = [], [(0.0, 0)], 0
        while queue and (len(found) < limit or held < least):
            _, n = heapq.heappop(queue)
            if self.leaf[n] >= 0:
                found.append(int(self.leaf[n]))
                held += sizes[found[-1]] if sizes else 0
                continue
            own = np.array(self.children[n])
            for d, c in zip(_squares(query[None], self.centres[own])[0].tolist(), own.tolist(), strict=True):
                heapq.heappush(queue, (d, c))
        return found


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)[None], 0)


def build(vectors: np.ndarray, branch: int = BRANCH, leaf: int = LEAF) -> Tree:
    """Split by k-means until a node holds `leaf` vectors, or equal ones only."""
    rng = np.random.default_rng(0)
    centres, children, leaves, count = [vectors.mean(axis=0) if len(vectors) else np.zeros(0)], [[]], [-1], 0
    open_nodes = [(0, np.arange(len(vectors)))]
    while open_nodes:
        node, rows = open_nodes.pop()
        own = vectors[rows]
        label, means = _kmeans(own, branch, rng) if len(rows) > leaf else (None, [])
        if len(means) < 2:
            leaves[node], count = count, count + 1
            continue
        for k, mean in enumerate(means):
            children[node].append(len(centres))
            open_nodes.append((len(centres), rows[label == k]))
            centres.append(mean)
            children.append([])
            leaves.append(-1)
    return Tree(np.array(centres), children, np.array(leaves))


def _kmeans(vectors: np.ndarray, k: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Labels and centres of the clusters that are not empty."""
    distinct = np.unique(vectors, axis=0)
    centres = distinct[rng.choice(len(distinct), min(k, len(distinct)), replace=False)]
    for _ in range(ROUNDS):
        label = _squares(vectors, centres).argmin(axis=1)
        used, label = np.unique(label, return_inverse=True)
        sums = np.zeros((len(used), vectors.shape[1]))
        np.add.at(sums, label, vectors)
        centres = sums / np.bincount(label)[:, None]
    return label, centres


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding as doubles, without vectors that are null, empty, zero or hold null or non-finite parts.

    Vectors of another length than most have no distance to the others; those of the most
    frequent length (ties: the longest) stay. Rows without an id cannot be answered with.
    """
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = (
        vectors.where(F.col("vec_id").isNotNull())
        .select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
        .where(F.col("v").isNotNull() & ~bad & F.exists("v", lambda x: x != 0))
    )
    common = kept.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return kept.where(F.size("v") == (common.n if common else 0))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _nearest(query: np.ndarray, ids: np.ndarray, vectors: np.ndarray, own: int, k: int) -> list[tuple[int, float]]:
    """The k nearest of these vectors but the query's own, exactly, ties to the smaller id."""
    keep = ids != own
    ids = ids[keep]
    d = np.sqrt(((vectors[keep] - query) ** 2).sum(axis=1))
    if len(d) > k:
        near = np.flatnonzero(d <= np.partition(d, k - 1)[k - 1])
        ids, d = ids[near], d[near]
    order = np.lexsort((ids, d))[:k]
    return list(zip(ids[order].tolist(), d[order].tolist(), strict=True))


FOUND = "query_id long, vec_id long, score double"


def _found_batch(rows: list[tuple[int, int, float]]) -> pa.RecordBatch:
    q, v, s = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(q, pa.int64()), pa.array(v, pa.int64()), pa.array(s, pa.float64())], ["query_id", "vec_id", "score"]
    )


def exact(index: DataFrame, ids: list[int], queries: np.ndarray, k: int) -> DataFrame:
    """The k nearest of a bounded number of queries, by comparison with all vectors (query_id, vec_id, score).

    Every task keeps its k best for each query.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, float]]] = [[] for _ in ids]
        for batch in batches:
            own, vectors = batch.column("vec_id").to_numpy(), _matrix(batch.column("v"))
            for n, (q, query) in enumerate(zip(ids, queries, strict=True)):
                best[n] = sorted(best[n] + _nearest(query, own, vectors, q, k), key=lambda r: (r[1], r[0]))[:k]
        yield _found_batch([(q, v, s) for q, rows in zip(ids, best, strict=True) for v, s in rows])

    return _ranked(index.select("vec_id", "v").mapInArrow(scan, FOUND), k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query with ranks. Each query has k rows of each block at most."""
    best = F.slice(F.array_sort(F.collect_list(F.struct("score", "vec_id"))), 1, k)
    each = found.groupBy("query_id").agg(best.alias("best")).select("query_id", F.posexplode("best"))
    return each.select("query_id", (F.col("pos") + 1).alias("rank"), "col.vec_id", "col.score")


def _compare(k: int):
    def compare(queries: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(members):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        ids, leaf, vectors = members["vec_id"].to_numpy(), members["leaf"].to_numpy(), np.stack(members["v"].to_numpy())
        rows = []
        for q, query, leaves in zip(queries["query_id"], queries["q"], queries["leaves"], strict=True):
            seen = np.isin(leaf, leaves)
            rows += [(q, v, s) for v, s in _nearest(np.asarray(query), ids[seen], vectors[seen], q, k)]
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"])

    return compare


@dataclass
class Index:
    tree: Tree
    #: vec_id, v, leaf: all vectors.
    members: DataFrame
    #: Vectors of each leaf.
    sizes: list[int]
    #: Shelf of each leaf, and into how many blocks each shelf is cut.
    shelf: list[int]
    blocks: list[int]


def make_index(vectors: DataFrame, sample: int = SAMPLE) -> Index:
    """Fit the tree on about `sample` vectors and put all of them into its leaves.

    Neighbouring leaves share a shelf of about BLOCK vectors, which is what one task
    compares. A leaf with more is a shelf of its own, cut into blocks by a hash of the
    id, so no task holds much more than BLOCK vectors, whatever share of the input is equal.
    """
    kept = materialize(usable(vectors), "vectors")
    total = kept.count()
    draw = F.pmod(F.xxhash64("vec_id"), F.lit(1_000_000)) / 1_000_000
    chosen = kept.where(draw < sample / max(total, 1)).orderBy("vec_id").select("v").toArrow()
    tree = build(_matrix(chosen.column("v").combine_chunks()) if len(chosen) else np.zeros((0, 0)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.place(_matrix(batch.column("v"))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("v"), pa.array(leaf)], ["vec_id", "v", "leaf"]
            )

    placed = materialize(kept.mapInArrow(place, "vec_id long, v array<double>, leaf int"), "leaves")
    # the sample bounds the number of leaves
    sizes = {r.leaf: r.n for r in placed.groupBy("leaf").agg(F.count("*").alias("n")).collect()}
    shelf, blocks, held = [], [], 0
    for leaf in range(tree.leaves):
        size = sizes.get(leaf, 0)
        if not blocks or held + size > BLOCK:
            blocks.append(1)
            held = 0
        held += size
        blocks[-1] = max(1, -(-held // BLOCK))
        shelf.append(len(blocks) - 1)
    return Index(tree, placed, [sizes.get(leaf, 0) for leaf in range(tree.leaves)], shelf, blocks)


def search(index: Index, queries: DataFrame, k: int, visits: int) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest vectors found in the first `visits` leaves of each query.

    A query goes on to further leaves until they hold k vectors besides the `copies` that have its own id.
    """
    tree, sizes, shelf, blocks = index.tree, index.sizes, index.shelf, index.blocks

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            own_ids, copies = (batch.column(c).to_pylist() for c in ("vec_id", "copies"))
            for q, vector, own_rows in zip(own_ids, _matrix(batch.column("v")), copies, strict=True):
                asked: dict[int, list[int]] = {}
                for leaf in tree.order(vector, visits, sizes, k + own_rows):
                    asked.setdefault(shelf[leaf], []).append(leaf)
                rows += [(q, vector, own, leaves, b) for own, leaves in asked.items() for b in range(blocks[own])]
            q, vector, own, leaves, b = zip(*rows, strict=True) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(q, pa.int64()), pa.array(vector, pa.list_(pa.float64())), pa.array(own, pa.int32()),
                 pa.array(leaves, pa.list_(pa.int32())), pa.array(b, pa.int32())],
                ["query_id", "q", "shelf", "leaves", "block"],
            )

    asked = queries.select("vec_id", "v", "copies").mapInArrow(
        route, "query_id long, q array<double>, shelf int, leaves array<int>, block int"
    )
    rows = F.from_json(
        F.lit(json.dumps([{"leaf": n, "shelf": s, "blocks": blocks[s]} for n, s in enumerate(shelf)])),
        "array<struct<leaf:int,shelf:int,blocks:int>>",
    )
    places = index.members.sparkSession.range(1).select(F.explode(rows).alias("p")).select("p.*")
    members = index.members.join(F.broadcast(places), "leaf").select(
        "vec_id", "v", "leaf", "shelf", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int").alias("block")
    )
    pairs = asked.groupBy("shelf", "block").cogroup(members.groupBy("shelf", "block"))
    return _ranked(pairs.applyInPandas(_compare(k), FOUND), k)


def calibrate(index: Index, queries: DataFrame, k: int, recall: float = RECALL, sample: int = CALIBRATE) -> int:
    """How many leaves to visit: a quarter more at a time, until the sample's recall against exact search is reached.

    All leaves give exact results, so this ends. The sample's queries are chosen by hash.
    """
    total = queries.count()
    draw = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(1_000_000)) / 1_000_000
    chosen = queries.where(draw < sample / max(total, 1)).orderBy("vec_id").limit(2 * sample).toArrow()
    if not len(chosen):
        return index.tree.leaves
    ids, vectors = chosen.column("vec_id").to_pylist(), _matrix(chosen.column("v").combine_chunks())
    truth = exact(index.members, ids, vectors, k)
    # the leaf of each true neighbour tells at which visit it would be found
    leaf_of = truth.join(index.members.select("vec_id", "leaf"), "vec_id").select("query_id", "leaf").collect()
    turns = {q: {leaf: n for n, leaf in enumerate(index.tree.order(v, index.tree.leaves))} for q, v in zip(ids, vectors, strict=True)}
    needed = np.array([turns[r.query_id][r.leaf] for r in leaf_of])
    visits = 1
    while visits < index.tree.leaves and (needed < visits).mean() < recall:
        visits = min(visits + max(1, visits // 4), index.tree.leaves)
    return visits


def nearest(vectors: DataFrame, every: int = 100, k: int = 10, recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose vec_id is divisible by `every`, its k nearest others.

    Score is the Euclidean distance of the original vectors in double precision. Rows as
    in `usable` take no part. Fewer candidates than k give fewer rows; an id that repeats
    is a candidate once for each of its vectors, and never for its own query; a query id that repeats
    is asked once, with its smallest vector. An empty table gives no rows. Other columns are not read.
    """
    index = make_index(vectors)
    queries = index.members.where(F.col("vec_id") % every == 0).groupBy("vec_id")
    queries = queries.agg(F.min("v").alias("v"), F.count("*").alias("copies"))
    queries = materialize(queries, "queries")
    return search(index, queries, k, calibrate(index, queries, k, recall))
