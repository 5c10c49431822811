"""Churn features, three classifiers, their metrics and the choice between them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from martloom.functions.labels import segment_score
from martloom.operators.joins import match
from martloom.operators.ordering import ordered_split
from martloom.session import materialize, stored_model

Tables = Mapping[str, DataFrame]

# Recency defines the label, so it is not among the features.
FEATURES = ("tenure_days", "total_orders", "total_revenue", "avg_order_value", "loyalty_points", "segment_score")
TRAIN_SHARE, SEED, INACTIVE_DAYS = 0.8, 42, 500
MODEL_VERSION = "v3.2"


def churn_features(t: Tables) -> DataFrame:
    """One labelled row per customer."""
    status = t["dim_customers"].select("customer_id", F.col("status").alias("_status"))
    c = match(t["customer_360"], status, "customer_id")
    long_gone = (F.col("_status") == "Inactive") & (F.col("days_since_last_order") > INACTIVE_DAYS)
    churned = F.coalesce((F.col("_status") == "Churned") | long_gone, F.lit(False))
    return c.select(
        "customer_id",
        *[F.coalesce(c_, F.lit(0)).alias(c_) for c_ in ("tenure_days", "total_orders")],
        *[F.coalesce(c_, F.lit(0.0)).alias(c_) for c_ in ("total_revenue", "avg_order_value")],
        F.coalesce("days_since_last_order", F.lit(365)).alias("days_since_last_order"),
        F.coalesce("loyalty_points", F.lit(0)).alias("loyalty_points"),
        segment_score(F.col("customer_segment")).alias("segment_score"),
        churned.cast("int").alias("churn_label"),
    )


def split(features: DataFrame) -> tuple[DataFrame, DataFrame]:
    """First 80% by customer id to train, the rest to test."""
    return ordered_split(features, "customer_id", TRAIN_SHARE)


def with_class_weight(train: DataFrame) -> DataFrame:
    """Weight so that both classes count the same: rows / (2 * rows of the class)."""
    n = train.groupBy("churn_label").agg(F.count(F.lit(1)).alias("n"))
    sizes = {r["churn_label"]: r["n"] for r in n.collect()}  # two classes
    total = sum(sizes.values())
    weight = F
    for label, size in sorted(sizes.items()):
        weight = weight.when(F.col("churn_label") == label, total / (len(sizes) * size))
    return train.withColumn("class_weight", weight.otherwise(1.0))


class Candidate(NamedTuple):
    name: str
    model: PipelineModel
    metrics: dict[str, float]


def pipelines(trees: int = 150, boosts: int = 100) -> dict[str, Pipeline]:
    """The hyperparameters of the compared models."""
    common = {"labelCol": "churn_label"}
    raw = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    unscaled = VectorAssembler(inputCols=list(FEATURES), outputCol="unscaled")
    scale = StandardScaler(inputCol="unscaled", outputCol="features", withMean=True, withStd=True)
    return {
        "Logistic Regression": Pipeline(
            stages=[unscaled, scale, LogisticRegression(maxIter=500, weightCol="class_weight", **common)]
        ),
        "Random Forest": Pipeline(
            stages=[raw, RandomForestClassifier(numTrees=trees, maxDepth=8, minInstancesPerNode=5, seed=SEED,
                                                weightCol="class_weight", **common)]
        ),
        "Gradient Boosting": Pipeline(
            stages=[raw, GBTClassifier(maxIter=boosts, maxDepth=5, stepSize=0.1, seed=SEED, **common)]
        ),
    }


def metrics(scored: DataFrame) -> dict[str, float]:
    """Test metrics from one confusion row and two curve areas; 0 where undefined."""
    y, p = F.col("churn_label") == 1, F.col("prediction") == 1
    row = scored.agg(
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn"),
        F.count(F.lit(1)).alias("n"), F.count_if(y).alias("pos"),
    ).first()
    both = 0 < row.pos < row.n

    def area(kind: str) -> float:
        if not both:
            return 0.0
        return BinaryClassificationEvaluator(labelCol="churn_label", metricName=kind, numBins=0).evaluate(scored)

    precision = row.tp / (row.tp + row.fp) if row.tp + row.fp else 0.0
    recall = row.tp / (row.tp + row.fn) if row.tp + row.fn else 0.0
    return {
        "accuracy": (row.n - row.fp - row.fn) / row.n if row.n else 0.0,
        "roc_auc": area("areaUnderROC"),
        "pr_auc": area("areaUnderPR"),
        "precision": precision,
        "recall": recall,
        "f1": 2 * precision * recall / (precision + recall) if precision + recall else 0.0,
    }


def compare_models(features: DataFrame, names: Sequence[str] | None = None, **sizes: int) -> list[Candidate]:
    """Fit every model on the first customers and measure it on the rest."""
    train, test = split(materialize(features, "features"))
    train = with_class_weight(train)
    candidates = []
    for name, pipeline in pipelines(**sizes).items():
        if names is None or name in names:
            model = stored_model(features.sparkSession, pipeline.fit(train), "churn")
            candidates.append(Candidate(name, model, metrics(model.transform(test))))
    return candidates


def best(candidates: Sequence[Candidate]) -> Candidate:
    """Highest F1, then PR-AUC; the first listed wins a tie, so there is always a choice."""
    return max(candidates, key=lambda c: (c.metrics["f1"], c.metrics["pr_auc"]))


def metric_rows(spark, candidates: Sequence[Candidate]) -> DataFrame:
    chosen = best(candidates).name
    rows = [(c.name, *[float(v) for v in c.metrics.values()], c.name == chosen) for c in candidates]
    columns = ", ".join(f"{m} double" for m in candidates[0].metrics)
    return spark.createDataFrame(rows, f"model string, {columns}, chosen boolean")


def churn_probabilities(model: PipelineModel, features: DataFrame) -> DataFrame:
    # the weight column only exists while training
    scored = model.transform(features)
    return scored.select("customer_id", "churn_label", vector_to_array("probability")[1].alias("churn_probability"))
