"""Customer segments: k-means with k chosen by silhouette, clusters named in order of value."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from martloom.functions.labels import label_lookup
from martloom.operators.clustering import fit_all, nearest, points

FEATURES = ("total_revenue", "total_orders", "days_since_last_order", "loyalty_points")
K_RANGE, SEED, STARTS = range(2, 7), 42, 20
ROWS_PER_PART, FEWEST_ROWS = 200_000, 10_000
# Segment names from the lowest to the highest value.
NAMES = {
    2: ("Low Value", "High Value"),
    3: ("Low Value", "Medium Value", "High Value"),
    4: ("Low Value", "Developing", "High Value", "Champions"),
    5: ("Low Value", "Developing", "Medium Value", "High Value", "Champions"),
    6: ("Low Value", "Emerging", "Developing", "Growing", "High Value", "Champions"),
}


class Segmentation(NamedTuple):
    k: int
    scaling: PipelineModel
    centres: np.ndarray
    labels: dict[int, str]
    trials: list[tuple[int, float, float]]  # k, silhouette, within-cluster cost


def _scaler() -> list:
    assemble = VectorAssembler(inputCols=list(FEATURES), outputCol="raw")
    return [assemble, StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True)]


def cluster_profile(assigned: DataFrame) -> DataFrame:
    """Mean revenue, orders and recency of every cluster, and the value they add up to."""
    mean = {c: F.avg(c) for c in ("total_revenue", "total_orders", "days_since_last_order")}
    value = mean["total_revenue"] + mean["total_orders"] * 50 - mean["days_since_last_order"] * 2
    return assigned.groupBy("cluster").agg(*[v.alias(c) for c, v in mean.items()], value.alias("value_score"))


def labels_by_value(profile: DataFrame, k: int) -> dict[int, str]:
    ordered = profile.orderBy("value_score", "cluster").select("cluster").collect()  # at most k rows
    return {r["cluster"]: NAMES[k][i] for i, r in enumerate(ordered)}


def _parts(rows: int, cores: int) -> int:
    """A round is one job over all parts: all cores at the same time, but few rows in many parts only cost scheduling."""
    waves = max(1, -(-rows // (ROWS_PER_PART * cores)))
    return max(1, min(waves * cores, -(-rows // FEWEST_ROWS)))


def place(scaled: DataFrame, centres: np.ndarray) -> DataFrame:
    return scaled.withColumn("cluster", nearest(vector_to_array("features"), centres))


def fit_segments(customers: DataFrame, ks=K_RANGE, starts: int = STARTS) -> Segmentation:
    """Try every k on the scaled features and keep the one with the best silhouette.

    All k and starts are fitted together, one job a round; of the starts of a k the one of least cost counts, ties
    go to the earlier one. Spark's silhouette needs only per-cluster sums, so all rows take part.
    """
    scaling = Pipeline(stages=_scaler()).fit(customers)
    parts = _parts(customers.count(), customers.sparkSession.sparkContext.defaultParallelism)
    scaled = scaling.transform(customers).select("customer_id", *FEATURES, "features").repartition(parts).cache()
    judge = ClusteringEvaluator(predictionCol="cluster", featuresCol="features")
    try:
        fits = fit_all(points(scaled, "customer_id", vector_to_array("features")), list(ks), starts, SEED)
        best = {k: min((f for f in fits if f.k == k), key=lambda f: f.cost) for k in ks}
        trials = []
        for k, fit in best.items():
            filled = (fit.sizes > 0).sum()
            score = judge.evaluate(place(scaled, fit.centres)) if filled > 1 else 0.0
            trials.append((k, float(score), fit.cost))
        k = max(trials, key=lambda x: x[1])[0]
        labels = labels_by_value(cluster_profile(place(scaled, best[k].centres)), k)
    finally:
        scaled.unpersist()
    return Segmentation(k, scaling, best[k].centres, labels, trials)


def assign(segmentation: Segmentation, customers: DataFrame) -> DataFrame:
    placed = place(segmentation.scaling.transform(customers), segmentation.centres)
    label = label_lookup(F.col("cluster"), segmentation.labels)
    return placed.select("customer_id", F.col("cluster").alias("segment_id"), label.alias("segment_label"))


def trial_rows(spark, segmentation: Segmentation) -> DataFrame:
    rows = [(*t, t[0] == segmentation.k) for t in segmentation.trials]
    return spark.createDataFrame(rows, "k int, silhouette double, inertia double, chosen boolean")
