"""Many k-means fits over the same rows, side by side.

A fit is a handful of centres, so one pass over the rows can serve all fits: every
round is one job, whatever the number of fits. A task keeps one sum per centre and
sends those; rows are never shuffled, and the driver sees centres only. The rows are
packed once, some thousand to a row of bytes, so that a round does not convert them again.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

HASH, POINT = "_hash", "_point"
SEED_ROUNDS = 2
LOCAL_ROUNDS = 30
#: Rows whose distances to all centres are held at a time: what fits a processor's cache.
BLOCK = 1024
#: Up to so many tasks send their sums to the driver at once; those of more tasks are added up in a shuffle before.
MERGED = 64


class Fit(NamedTuple):
    k: int
    start: int
    centres: np.ndarray  # at most k rows; fewer if there are fewer different points
    sizes: np.ndarray
    cost: float  # sum of squared distances to the nearest centre


def points(df: DataFrame, key: str, vector: Column) -> DataFrame:
    """The rows as `fit_all` takes them: a hash for its draws, and an array of doubles without NULLs."""
    return df.select(F.xxhash64(key).alias(HASH), vector.alias(POINT))


def packed(rows: DataFrame) -> DataFrame:
    """`points` with the rows of an Arrow batch as one row of bytes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hashes, x in _rows(batches):
            yield pa.RecordBatch.from_pydict({
                HASH: pa.array([hashes.tobytes()], pa.binary()), POINT: pa.array([x.tobytes()], pa.binary()),
            })

    return rows.mapInArrow(pack, f"{HASH} binary, {POINT} binary")


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        if pa.types.is_binary(batch.schema.field(HASH).type) or pa.types.is_large_binary(batch.schema.field(HASH).type):
            for hashes, flat in zip(batch.column(HASH), batch.column(POINT)):
                keys = np.frombuffer(hashes.as_buffer(), np.int64)
                yield keys, np.frombuffer(flat.as_buffer(), float).reshape(len(keys), -1)
        elif batch.num_rows:
            flat = batch.column(POINT).flatten().to_numpy(zero_copy_only=False)
            yield batch.column(HASH).to_numpy(zero_copy_only=False), flat.reshape(batch.num_rows, -1)


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    away = np.zeros((len(x), len(centres)))
    for column, values in zip(x.T, centres.T):
        away += (column[:, None] - values[None, :]) ** 2
    return away


def _add_nearest(x: np.ndarray, centres: np.ndarray, n: np.ndarray, sums: np.ndarray, cost: np.ndarray) -> None:
    """Add the rows to the nearest centre of every set, the smaller of equals.

    `centres` and `sums` are sets x centres x columns, `n` is sets x centres and `cost` is per set. The rows come
    last in all arrays in between, so that every step runs along them.
    """
    sets, k, width = centres.shape
    away, step = np.empty((sets, k, len(x))), np.empty((sets, k, len(x)))
    for j in range(width):
        np.subtract(x[:, j], centres[:, :, j, None], out=step if j else away)
        np.multiply(step, step, out=step) if j else np.multiply(away, away, out=away)
        if j:
            np.add(away, step, out=away)
    least = away.min(axis=1)
    cost += least.sum(axis=1)
    free = np.ones((sets, len(x)), bool)
    values = np.column_stack([np.ones(len(x)), x])
    for j in range(k):
        mine = free & (away[:, j] == least)
        free ^= mine
        added = mine.astype(float) @ values
        n[:, j] += added[:, 0].astype(np.int64)
        sums[:, j] += added[:, 1:]


def _uniform(hashes: np.ndarray, *numbers: int) -> np.ndarray:
    """A number in (0, 1) per row that depends on its hash and the given numbers only, so that a task run again draws alike."""
    state = hashes.astype(np.uint64)
    with np.errstate(over="ignore"):
        for number in (*numbers, 0):
            state = state + np.uint64(number + 1) * np.uint64(0x9E3779B97F4A7C15)
            state = (state ^ (state >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            state = (state ^ (state >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            state = state ^ (state >> np.uint64(31))
    return ((state >> np.uint64(11)).astype(float) + 0.5) / 2.0**53


def _totals(
    rows: DataFrame, sets: Sequence[np.ndarray], merge: bool = True
) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """Per set of centres: rows nearest to each centre, their sums, and the cost of the set. One job.

    With `merge` a shuffle adds up what the tasks have found, else the driver does.
    """
    stacked = np.vstack(sets)
    ends = np.cumsum([len(c) for c in sets])
    slices = [slice(end - len(c), end) for c, end in zip(sets, ends)]
    alike: dict[int, list[slice]] = {}  # sets of equal size are taken together
    for part in slices:
        alike.setdefault(part.stop - part.start, []).append(part)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, cost = np.zeros(len(stacked), np.int64), np.zeros_like(stacked), np.zeros(len(stacked))
        together = {k: np.stack([stacked[part] for part in parts]) for k, parts in alike.items()}
        found = {k: (np.zeros(c.shape[:2], np.int64), np.zeros_like(c), np.zeros(len(c))) for k, c in together.items()}
        for _, x in _rows(batches):
            for begin in range(0, len(x), BLOCK):
                for k, centres in together.items():
                    _add_nearest(x[begin : begin + BLOCK], centres, *found[k])
        for k, parts in alike.items():
            for i, part in enumerate(parts):
                n[part], sums[part] = found[k][0][i], found[k][1][i]
                cost[part.start + n[part].argmax()] = found[k][2][i]  # a centre that has rows speaks for its set
        used = np.flatnonzero(n)
        for begin in range(0, len(used), 10_000):
            at = used[begin : begin + 10_000]
            yield pa.RecordBatch.from_pydict({
                "centre": pa.array(at, pa.int32()), "n": pa.array(n[at]), "cost": pa.array(cost[at]),
                **{f"s{j}": pa.array(sums[at, j]) for j in range(stacked.shape[1])},
            })

    values = ["n", "cost", *[f"s{j}" for j in range(stacked.shape[1])]]
    schema = "centre int, n bigint, cost double" + "".join(f", {c} double" for c in values[2:])
    summed = rows.mapInArrow(partial, schema)
    if merge:
        summed = summed.groupBy("centre").agg(*[F.sum(c).alias(c) for c in values])
    # at most one row per centre and task; with many tasks one per centre
    table = summed.toArrow()
    at = table["centre"].to_numpy()
    n, cost, sums = np.zeros(len(stacked), np.int64), np.zeros(len(stacked)), np.zeros_like(stacked)
    np.add.at(n, at, table["n"].to_numpy())
    np.add.at(cost, at, table["cost"].to_numpy())
    for j in range(stacked.shape[1]):
        np.add.at(sums[:, j], at, table[f"s{j}"].to_numpy())
    return [(n[part], sums[part], float(cost[part].sum())) for part in slices]


def _drawn(rows: DataFrame, sets: Sequence[np.ndarray | None], size: int, *numbers: int) -> list[np.ndarray]:
    """`size` rows per set, drawn without return, with odds by squared distance to the set (None: even odds). One job.

    A row's place in the draw is an exponential number over its weight; the smallest places win. So the number drawn
    is exact, needs no total weight beforehand, and a task sends `size` rows per set at most. Rows at distance zero are
    not drawn.
    """

    def smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[tuple[np.ndarray, np.ndarray] | None] = [None] * len(sets)
        for hashes, x in _rows(batches):
            for i, centres in enumerate(sets):
                weight = np.ones(len(x)) if centres is None else _distances(x, centres).min(axis=1)
                far = weight > 0
                place, kept = -np.log(_uniform(hashes[far], i, *numbers)) / weight[far], x[far]
                if best[i] is not None:
                    place, kept = np.concatenate([best[i][0], place]), np.concatenate([best[i][1], kept])
                first = np.argsort(place, kind="stable")[:size]
                best[i] = place[first], kept[first]
        for i, found in enumerate(best):
            if found is not None and len(found[0]):
                yield pa.RecordBatch.from_pydict({
                    "set": pa.array([i] * len(found[0]), pa.int32()), "place": pa.array(found[0]),
                    POINT: pa.array(found[1].tolist(), pa.list_(pa.float64())),
                })

    drawn = rows.mapInArrow(smallest, f"set int, place double, {POINT} array<double>")
    order = Window.partitionBy("set").orderBy("place", POINT)
    picked = drawn.withColumn("n", F.row_number().over(order)).where(F.col("n") <= size).orderBy("set", "n")
    result: list[list] = [[] for _ in sets]
    for r in picked.collect():  # at most `size` rows per set
        result[r["set"]].append(r[POINT])
    return [np.array(found, float) for found in result]


def _spread(candidates: np.ndarray, weights: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k of the weighted candidates far from each other, then moved to the means of the candidates around them."""
    centres = candidates[[rng.choice(len(candidates), p=weights / weights.sum())]]
    while len(centres) < k:
        odds = weights * _distances(candidates, centres).min(axis=1)
        if odds.sum() <= 0:
            break
        centres = np.vstack([centres, candidates[rng.choice(len(candidates), p=odds / odds.sum())]])
    for _ in range(LOCAL_ROUNDS):
        near = _distances(candidates, centres).argmin(axis=1)
        mass = np.bincount(near, weights=weights, minlength=len(centres))
        means = np.column_stack([np.bincount(near, weights=weights * c, minlength=len(centres)) for c in candidates.T])
        moved = np.where(mass[:, None] > 0, means / np.maximum(mass, 1e-300)[:, None], centres)
        if np.array_equal(moved, centres):
            break
        centres = moved
    return centres


def _first_centres(
    rows: DataFrame, ks: Sequence[int], starts: int, seed: int, merge: bool
) -> dict[tuple[int, int], np.ndarray]:
    """Oversampled candidates per start, weighted by the rows around them; every k takes its centres from those."""
    sets = _drawn(rows, [None] * starts, 1, seed, 0)
    if not all(len(c) for c in sets):
        raise ValueError("k-means needs at least one row")
    for number in range(1, SEED_ROUNDS + 1):
        more = _drawn(rows, sets, 2 * max(ks), seed, number)
        sets = [np.vstack([c, m]) if len(m) else c for c, m in zip(sets, more)]
    weights = [n for n, _, _ in _totals(rows, sets, merge)]
    return {
        (k, i): _spread(sets[i], weights[i].astype(float), k, np.random.default_rng([seed, i, k]))
        for k in ks
        for i in range(starts)
    }


def fit_all(
    rows: DataFrame, ks: Sequence[int], starts: int, seed: int = 0, rounds: int = 300, tolerance: float = 1e-4
) -> list[Fit]:
    """Fit every k from every start; fits come ordered by k and start.

    A fit rests once no centre moves further than `tolerance`; rounds go on with the others. Jobs: one per round of the
    slowest fit and a fixed number around them. A centre no row is nearest to stays where it is. `rows`, a table of
    `points`, is read once, packed and cached; a round uses as many tasks as it has partitions.
    """
    kept = packed(rows).cache()
    try:
        return _fit_packed(kept, ks, starts, seed, rounds, tolerance)
    finally:
        kept.unpersist()


def _fit_packed(rows: DataFrame, ks: Sequence[int], starts: int, seed: int, rounds: int, tolerance: float) -> list[Fit]:
    merge = rows.rdd.getNumPartitions() > MERGED
    centres = _first_centres(rows, ks, starts, seed, merge)
    moving = list(centres)
    for _ in range(rounds):
        if not moving:
            break
        still = []
        for name, (n, sums, _) in zip(moving, _totals(rows, [centres[name] for name in moving], merge)):
            moved = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres[name])
            if ((moved - centres[name]) ** 2).sum(axis=1).max() > tolerance**2:
                still.append(name)
            centres[name] = moved
        moving = still
    final = _totals(rows, list(centres.values()), merge)
    return [Fit(k, i, c, n, cost) for ((k, i), c), (n, _, cost) in zip(centres.items(), final)]


def nearest(vector: Column, centres: np.ndarray) -> Column:
    """Number of the centre nearest to an array column, the smaller of equals, as a plain expression."""
    away = []
    for j, centre in enumerate(np.asarray(centres).tolist()):
        squares = [(vector[i] - F.lit(c)) * (vector[i] - F.lit(c)) for i, c in enumerate(centre)]
        away.append(F.struct(sum(squares[1:], squares[0]).alias("away"), F.lit(j).alias("number")))
    return F.array_min(F.array(*away))["number"]
