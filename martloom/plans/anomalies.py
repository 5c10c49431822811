"""Tables over anomaly scores."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from martloom.functions import money as m
from martloom.operators.ordering import exact_percentiles, with_one_row
from martloom.operators.windows import numbered_top

MAX_EVENTS = 500


def anomaly_summary(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("is_anomaly").agg(
        F.count(F.lit(1)).alias("count"), F.round(F.avg("churn_probability"), 4).alias("avg_churn")
    )


def anomaly_kpi(predictions: DataFrame, as_of: dt.date) -> DataFrame:
    n, flagged = F.count(F.lit(1)), F.sum(F.col("is_anomaly").cast("bigint"))
    return predictions.agg(
        n.alias("total_scored"), flagged.alias("anomaly_count"), m.pct(flagged, n).alias("anomaly_rate_pct"),
        F.round(F.avg("churn_probability"), 4).alias("avg_churn_risk"),
    ).select(F.lit(as_of).alias("report_date"), "*")


def anomaly_events(predictions: DataFrame, as_of: dt.date, k: int = MAX_EVENTS) -> DataFrame:
    """The k highest flagged scores; severity by percentiles over all flagged rows."""
    flagged = predictions.where(F.col("is_anomaly") == 1)
    cuts = exact_percentiles(flagged, "anomaly_score_raw", [0.9, 0.7])
    order = [F.col("anomaly_score_raw").desc(), F.col("customer_id").asc()]
    top = with_one_row(numbered_top(flagged, order, k), cuts)
    score = F.col("anomaly_score_raw")
    severity = F.when(score >= F.col("p1"), "critical").when(score >= F.col("p2"), "high").otherwise("medium")
    return top.select(
        F.concat(F.lit("ANM"), F.col("position").cast("string")).alias("event_id"),
        F.col("customer_id").alias("entity_id"), F.lit("customer").alias("entity_type"),
        F.lit("customer_behavior").alias("anomaly_type"), severity.alias("severity"),
        score.alias("anomaly_score"), "churn_probability", F.lit(as_of).alias("detected_at"),
    )
