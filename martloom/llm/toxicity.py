"""Toxicity: a linear model over letter n-grams, scaled by naive Bayes log-count ratios.

A feature is the presence of an n-gram (3 to 5 code points, lower case, hashed) in the
text. Its value is its log-count ratio: how much likelier toxic documents have it than
others. A logistic regression on these values gives the weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.common import held_out

#: Labelled documents of each class that the model is fitted on, at most about; chosen by hash.
SAMPLE = 3000
#: Lengths of n-grams.
ORDERS = (3, 4, 5)
#: Bits of a feature's number.
BITS = 20
#: Features that the regression weighs: those that tell the classes apart best.
FEATURES = 1 << 14
#: Documents of the sample that must have a feature.
LEAST = 5
#: Regression: strength of the penalty, rounds.
RIDGE, ROUNDS = 1e-3, 200
#: Code points hashed at once.
PIECE = 1 << 18


def features(text: str) -> Iterator[np.ndarray]:
    """Feature numbers of all n-grams, in pieces; a text shorter than an n-gram has none of it."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    for at in range(0, len(codes), PIECE):
        # a piece overlaps the next by the longest n-gram, less one
        c = codes[at : at + PIECE + ORDERS[-1] - 1]
        h = c.copy()
        for n in range(2, ORDERS[-1] + 1):
            if len(c) < n:
                break
            h = h[:-1] * np.uint32(0x01000193) + c[n - 1 :]
            if n >= ORDERS[0]:
                # the high bits of the product depend on all letters
                yield ((h ^ (h >> np.uint32(15))) * np.uint32(0x9E3779B1 + 2 * n)) >> np.uint32(32 - BITS)


class Presence:
    """Distinct features of one text after another, with one table for all."""

    def __init__(self) -> None:
        self.seen = np.zeros(1 << BITS, np.int32)
        self.turn = 0

    def distinct(self, text: str) -> np.ndarray:
        self.turn += 1
        if self.turn == 2**31 - 1:
            self.seen[:], self.turn = 0, 1
        found = []
        for ids in features(text):
            fresh = ids[self.seen[ids] != self.turn]
            self.seen[fresh] = self.turn
            found.append(fresh)
        if not found:
            return np.zeros(0, np.int64)
        # what is left repeats only within a piece
        return np.unique(np.concatenate(found)).astype(np.int64)


@dataclass
class Model:
    #: Weight of each feature, times its log-count ratio; zero for most.
    weights: np.ndarray
    intercept: float

    def __post_init__(self) -> None:
        known = np.flatnonzero(self.weights)
        self.known = np.concatenate(([0], self.weights[known])).astype(np.float32)
        self.place = np.zeros(len(self.weights), np.int32)
        self.place[known] = np.arange(1, len(known) + 1)

    def score(self, text: str) -> float:
        """Log odds of label 1: the intercept and each present feature's weight once."""
        present = np.zeros(len(self.known), np.float32)
        for ids in features(text):
            present[self.place[ids]] = 1
        return self.intercept + float(present @ self.known)


def _labelled(docs: DataFrame, labels: DataFrame, sample: int) -> tuple[DataFrame, float]:
    """(toxic, text) of the sample, and the share of toxic documents among all that may be learnt from."""
    known = (
        labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), 5, 0))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    sizes = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1_000_000
    share = F.when(F.col("toxic") == 1, sample / sizes.get(1, 1)).otherwise(sample / sizes.get(0, 1))
    # about 2 * sample short rows, whatever the input holds
    chosen = F.broadcast(known.where(draw < share).withColumnsRenamed({"doc_id": "__id"}))
    texts = docs.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("__id"))
    return texts.select("toxic", "text"), sizes.get(1, 0) / max(1, sum(sizes.values()))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    presence = Presence()
    for batch in batches:
        ids = [presence.distinct(t or "") for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("toxic").cast(pa.int32()), pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32()))],
            ["toxic", "ids"],
        )


def _fit_one(frame: pd.DataFrame) -> pd.DataFrame:
    """The regression itself, on the bounded sample: one row of features, weights and intercept.

    The intercept is what is left without the log odds of these rows. One class alone tells nothing.
    """
    y = frame["toxic"].to_numpy().astype(float)
    if len(np.unique(y)) < 2:
        return pd.DataFrame({"ids": [[]], "weights": [[]], "intercept": [0.0]})
    size = 1 << BITS
    p, q = np.zeros(size), np.zeros(size)
    for ids, toxic in zip(frame["ids"], y, strict=True):  # each feature once in a document
        (p if toxic else q)[ids] += 1
    ones, zeros = max(y.sum(), 1), max((1 - y).sum(), 1)
    ratio = np.log((p + 1) / (p + 1).sum()) - np.log((q + 1) / (q + 1).sum())
    # how far the shares of documents with the feature lie apart, in standard errors
    pooled = (p + q) / (ones + zeros)
    apart = np.abs(p / ones - q / zeros) / np.sqrt(np.maximum(pooled * (1 - pooled), 1e-9) * (1 / ones + 1 / zeros))
    apart[p + q < LEAST] = 0
    kept = np.argsort(-apart, kind="stable")[:FEATURES]
    kept = np.sort(kept[apart[kept] > 0])
    place = np.full(size, -1, np.int32)
    place[kept] = np.arange(len(kept))
    cols = [c[c >= 0] for c in (place[ids] for ids in frame["ids"])]
    row = np.repeat(np.arange(len(y)), [len(c) for c in cols])
    col = np.concatenate(cols) if cols else np.zeros(0, np.int64)
    value = ratio[kept][col]
    w, b = np.zeros(len(kept)), 0.0
    # gradient descent with momentum; the step suits the largest curvature
    norms = np.bincount(row, value**2, minlength=len(y))
    step = 1.0 / (0.25 * (norms.mean() + 1) * 4 + RIDGE) if len(y) else 0.0
    ahead, b_ahead, last_w, last_b = w, b, w, b
    for k in range(ROUNDS):
        z = np.bincount(row, value * ahead[col], minlength=len(y)) + b_ahead
        wrong = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / max(len(y), 1)
        w = ahead - step * (np.bincount(col, value * wrong[row], minlength=len(kept)) + RIDGE * ahead)
        b = b_ahead - step * wrong.sum()
        pace = k / (k + 3)
        ahead, b_ahead = w + pace * (w - last_w), b + pace * (b - last_b)
        last_w, last_b = w, b
    own = np.log(ones / zeros)
    return pd.DataFrame({"ids": [kept.astype(np.int32)], "weights": [w * ratio[kept]], "intercept": [b - own]})


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from the labelled documents that are not held out.

    About `sample` documents of each class are used (all, if there are fewer), so the one
    task that fits them has a bounded size. The intercept then moves from the shares of the
    fitted rows to the classes' true ones: not at all where all rows of both were used.
    Without both classes the model knows only these shares.
    """
    rows, prior = _labelled(docs, labels, sample)
    fitted = (
        rows.mapInArrow(_rows, "toxic int, ids array<int>")
        .groupBy(F.lit(1).alias("all"))
        .applyInPandas(_fit_one, "ids array<int>, weights array<double>, intercept double")
        .first()
    )
    prior = min(max(prior, 1e-6), 1 - 1e-6)
    weights = np.zeros(1 << BITS, np.float32)
    if fitted is None:
        return Model(weights, float(np.log(prior / (1 - prior))))
    weights[np.array(fitted.ids, np.int64)] = fitted.weights
    return Model(weights, fitted.intercept + float(np.log(prior / (1 - prior))))


def toxicity(text: Column, model: Model) -> Column:
    """Probability of the label 1. Null and empty texts have no features: the intercept's probability."""

    @F.arrow_udf(T.DoubleType())
    def run(texts: pa.Array) -> pa.Array:
        z = np.array([model.score(t.as_py() or "") for t in texts])
        return pa.array(1 / (1 + np.exp(-np.clip(z, -700, 700))), pa.float64())

    return run(text)


def score(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted for every document.

    One row for each row of `docs`; repeated rows repeat, null ids stay null, null and
    empty texts get the score of no evidence, an empty table gives no rows. Of labels
    that contradict each other the toxic one counts; null labels do not. Columns other
    than doc_id, text and toxic are not read.
    """
    model = model or fit(docs, labels)
    scored = docs.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), toxicity(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
