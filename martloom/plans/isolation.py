"""Isolation forest over Spark.

Every tree is grown from a small random sample in its own task; the finished
forest is a few hundred kilobytes whatever the data's size, is sent to every
task once, and all rows are scored in Arrow batches.

Liu, Ting, Zhou: Isolation Forest, ICDM 2008.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from martloom.operators.ordering import exact_percentiles
from martloom.operators.windows import first_per_group
from martloom.session import materialize

TREES, SAMPLE, CONTAMINATION, SEED = 150, 256, 0.05, 42
DRAWS = 4  # expected drawn rows per sampled row of one tree
NODE_SCHEMA = "tree int, node int, feature int, cut double, below int, above int, depth double"


class Forest(NamedTuple):
    """Node arrays of all trees; a leaf has feature -1 and keeps its path length in `depth`."""

    feature: np.ndarray
    cut: np.ndarray
    below: np.ndarray
    above: np.ndarray
    depth: np.ndarray
    sample: int


def path_correction(n: float) -> float:
    """Mean path length of an unsuccessful search in a tree of n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (np.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n


def tree_samples(df: DataFrame, key: str, features: Sequence[str], trees: int, sample: int) -> DataFrame:
    """`sample` rows for each tree, drawn from all rows by a hash of the key and the tree.

    Each tree has a draw of its own, so any row can reach any tree, and about
    `DRAWS * trees * sample` rows leave the scan whatever the data's size.
    """
    total = df.count()
    space = 1 << 62
    limit = F.lit(int(space * min(1.0, DRAWS * sample / max(total, 1))))
    drawn = F.filter(
        F.sequence(F.lit(0), F.lit(trees - 1)),
        lambda tree: F.pmod(F.xxhash64(F.col(key), tree, F.lit(SEED)), F.lit(space)) < limit,
    )
    spread = df.select(key, *features).withColumn("tree", F.explode(drawn))
    order = [F.xxhash64(F.col(key), F.col("tree"), F.lit(SEED)).asc(), F.col(key).asc()]
    return first_per_group(spread, ["tree"], order, sample)


def _grow(points: np.ndarray, rng: np.random.Generator, limit: int) -> list[tuple]:
    """Nodes of one tree as (feature, cut, below, above, path length)."""
    nodes: list[tuple] = [()]
    todo = [(0, points, 0)]
    while todo:
        at, rows, depth = todo.pop()
        low, high = (rows.min(axis=0), rows.max(axis=0)) if len(rows) else (None, None)
        open_features = np.flatnonzero(high > low) if len(rows) > 1 else np.empty(0, int)
        if depth >= limit or len(open_features) == 0:
            nodes[at] = (-1, 0.0, -1, -1, depth + path_correction(len(rows)))
            continue
        f = int(rng.choice(open_features))
        cut = float(rng.uniform(low[f], high[f]))
        left = rows[:, f] <= cut
        below, above = len(nodes), len(nodes) + 1
        nodes += [(), ()]
        nodes[at] = (f, cut, below, above, 0.0)
        todo += [(below, rows[left], depth + 1), (above, rows[~left], depth + 1)]
    return nodes


def grow_forest(df: DataFrame, key: str, features: Sequence[str], trees: int = TREES, sample: int = SAMPLE) -> Forest:
    names = list(features)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        ordered = pdf.sort_values(key)[names].to_numpy(float)
        limit = int(np.ceil(np.log2(max(len(ordered), 2))))
        nodes = _grow(ordered, np.random.default_rng([SEED, tree]), limit)
        out = pd.DataFrame(nodes, columns=["feature", "cut", "below", "above", "depth"])
        out.insert(0, "node", range(len(out)))
        out.insert(0, "tree", tree)
        return out

    doubles = df.select(key, *[F.col(c).cast("double").alias(c) for c in names])
    grown = tree_samples(doubles, key, names, trees, sample).groupBy("tree").applyInPandas(grow, NODE_SCHEMA)
    nodes = grown.toPandas()  # at most trees * (2 * sample - 1) rows, whatever the data's size
    width = int(nodes["node"].max()) + 1
    arrays = {c: np.zeros((trees, width), int if c in ("feature", "below", "above") else float)
              for c in ("feature", "cut", "below", "above", "depth")}
    for c, a in arrays.items():
        a[nodes["tree"], nodes["node"]] = nodes[c]
    used = min(sample, int(df.count()))
    return Forest(**arrays, sample=used)


def anomaly_score(forest: Forest, rows: np.ndarray) -> np.ndarray:
    """2^(-mean path / expected path): near 1 for points that are easily set apart."""
    total = np.zeros(len(rows))
    index = np.arange(len(rows))
    for f, cut, below, above, depth in zip(forest.feature, forest.cut, forest.below, forest.above, forest.depth):
        at = np.zeros(len(rows), int)
        while True:
            inner = f[at] >= 0
            if not inner.any():
                break
            goes_below = rows[index, np.maximum(f[at], 0)] <= cut[at]
            at = np.where(inner, np.where(goes_below, below[at], above[at]), at)
        total += depth[at]
    return 2.0 ** (-(total / len(forest.feature)) / max(path_correction(forest.sample), 1e-9))


def score_rows(df: DataFrame, forest: Forest, key: str, features: Sequence[str]) -> DataFrame:
    names = list(features)
    shared = df.sparkSession.sparkContext.broadcast(forest)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({key: pdf[key], "isolation": anomaly_score(shared.value, pdf[names].to_numpy(float))})

    doubles = df.select(key, *[F.col(c).cast("double").alias(c) for c in names])
    return doubles.mapInPandas(score, f"{key} {dict(df.dtypes)[key]}, isolation double")


def anomaly_scores(
    df: DataFrame, key: str, features: Sequence[str], trees: int = TREES, sample: int = SAMPLE,
    contamination: float = CONTAMINATION,
) -> DataFrame:
    """(key, anomaly_score_raw, is_anomaly): scores above the contamination cut are positive and flagged."""
    forest = grow_forest(df, key, features, trees, sample)
    scored = materialize(score_rows(df, forest, key, features), "isolation")
    cut = exact_percentiles(scored, "isolation", [1.0 - contamination]).first()[0]
    raw = F.col("isolation") - F.lit(cut)
    return scored.select(key, raw.alias("anomaly_score_raw"), (raw > 0).cast("int").alias("is_anomaly"))
