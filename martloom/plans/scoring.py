"""The customer models and their predictions in one table, each model fitted when it is first asked for."""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from martloom.operators.joins import match
from martloom.plans import churn, isolation, segmentation
from martloom.session import materialize

TABLES = ("churn_predictions", "customer_segments", "anomaly_scores", "model_metrics", "segment_trials")


def churn_predictions(
    probabilities: DataFrame, segments: DataFrame, anomalies: DataFrame, at: dt.datetime, threshold: float = 0.5
) -> DataFrame:
    c = match(match(probabilities, segments, "customer_id"), anomalies, "customer_id")
    return c.select(
        "customer_id", "churn_probability", (F.col("churn_probability") >= threshold).cast("int").alias("churn_predicted"),
        F.col("churn_label").alias("actual_churn"), F.col("segment_id").alias("cluster"), "anomaly_score_raw",
        "is_anomaly", F.lit(churn.MODEL_VERSION).alias("model_version"), F.lit(at).alias("scored_at"),
    )


class ModelTables:
    """The tables of all customer models. A model is fitted once, when a table first needs it."""

    def __init__(self, features: DataFrame, at: dt.datetime, trees: int, boosts: int) -> None:
        self._features, self._at, self._sizes = features, at, {"trees": trees, "boosts": boosts}
        self._candidates: dict[str, churn.Candidate] = {}

    @cached_property
    def customers(self) -> DataFrame:
        return materialize(self._features, "customers")

    def candidates(self, *names: str) -> list[churn.Candidate]:
        """The named classifiers, or all of them, in the order in which they are listed."""
        wanted = [n for n in churn.pipelines() if not names or n in names]
        if missing := [n for n in wanted if n not in self._candidates]:
            found = churn.compare_models(self.customers, missing, **self._sizes)
            self._candidates |= {c.name: c for c in found}
        return [self._candidates[n] for n in wanted]

    @cached_property
    def _segmentation(self) -> segmentation.Segmentation:
        return segmentation.fit_segments(self.customers)

    def metrics_of(self, *names: str) -> DataFrame:
        """Test metrics of the named classifiers; the choice takes all of them (`model_metrics`)."""
        return churn.metric_rows(self.customers.sparkSession, self.candidates(*names)).drop("chosen")

    @cached_property
    def model_metrics(self) -> DataFrame:
        return churn.metric_rows(self.customers.sparkSession, self.candidates())

    @cached_property
    def customer_segments(self) -> DataFrame:
        return segmentation.assign(self._segmentation, self.customers)

    @cached_property
    def segment_trials(self) -> DataFrame:
        return segmentation.trial_rows(self.customers.sparkSession, self._segmentation)

    @cached_property
    def anomaly_scores(self) -> DataFrame:
        return isolation.anomaly_scores(self.customers, "customer_id", churn.FEATURES)

    @cached_property
    def churn_predictions(self) -> DataFrame:
        probabilities = churn.churn_probabilities(churn.best(self.candidates()).model, self.customers)
        return churn_predictions(probabilities, self.customer_segments, self.anomaly_scores, self._at)

    def _asdict(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in TABLES}


def train_and_score(features: DataFrame, at: dt.datetime, trees: int = 150, boosts: int = 100) -> ModelTables:
    """The classifiers, the segments and the forest, and the scores of every customer; each is fitted on first use."""
    return ModelTables(features, at, trees, boosts)
