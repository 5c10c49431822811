"""Dashboard queries: functions from finished tables to the frame that is shown."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from martloom.functions import labels, money as m
from martloom.functions.dates import since
from martloom.operators.aggregates import count_when, share_pct
from martloom.operators.joins import match
from martloom.operators.ordering import sorted_by_label, top_k


def executive(kpi: DataFrame) -> DataFrame:
    names = {"total_orders": "recognized_orders", "open_tickets": "open_support_tickets"}
    counts = ["total_customers", "active_customers", "order_attempts", "total_orders", "total_returns",
              "active_products", "open_tickets"]
    return kpi.select(
        *[F.col(c).cast("int").alias(names.get(c, c)) for c in counts],
        *[F.round(F.col(c).cast("double"), 2).alias(f"{c}_usd") for c in ("total_revenue", "avg_order_value")],
    )


def revenue_by_channel(daily_sales: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    recent = daily_sales.where(since("order_date", as_of, days))
    return recent.select(
        "order_date", "channel", "total_orders", F.round("total_revenue", 2).alias("revenue"),
        F.round("avg_order_value", 2).alias("aov"),
    ).orderBy(F.desc("order_date"), F.desc("revenue"), "channel")


def top_customers(customer_360: DataFrame, k: int = 20) -> DataFrame:
    best = top_k(customer_360, [F.desc("total_revenue"), F.asc("customer_id")], k)
    return best.select(
        "customer_id", "full_name", "customer_segment", "country", "total_orders",
        F.round("total_revenue", 2).alias("lifetime_revenue"), "days_since_last_order", "recency_risk", "clv_tier",
        F.round("baseline_3yr_clv", 2).alias("baseline_3yr_clv"),
    )


def churn_bands(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy(labels.churn_band(F.col("churn_probability")).alias("risk_band")).agg(
        F.count(F.lit(1)).alias("customer_count"), F.round(F.avg("churn_probability") * 100, 1).alias("avg_churn_pct")
    ).orderBy(F.desc("avg_churn_pct"))


def segment_profile(segments: DataFrame, customer_kpis: DataFrame) -> DataFrame:
    s = match(segments.select("customer_id", "segment_label"), customer_kpis, "customer_id")
    return s.groupBy("segment_label").agg(
        F.count(F.lit(1)).alias("customers"),
        m.mean_cents(m.total("total_revenue"), F.count("total_revenue")).alias("avg_revenue"),
        F.round(F.avg("total_orders"), 1).alias("avg_orders"),
        F.round(F.avg("days_since_last_order"), 0).alias("avg_recency_days"),
    ).orderBy(F.desc("avg_revenue"))


def top_anomalies(events: DataFrame, customer_360: DataFrame, k: int = 20) -> DataFrame:
    profile = customer_360.select(
        F.col("customer_id").alias("entity_id"), "customer_segment", "country", "total_revenue", "days_since_last_order"
    )
    best = top_k(match(events, profile, "entity_id"), [F.desc("anomaly_score"), F.asc("entity_id")], k)
    return best.select(
        F.col("entity_id").alias("customer_id"), "customer_segment", "country",
        F.round("anomaly_score", 4).alias("anomaly_score"), F.round("churn_probability", 4).alias("churn_probability"),
        "total_revenue", "days_since_last_order",
    )


def top_demand(forecast: DataFrame, products: DataFrame, k: int = 20) -> DataFrame:
    p = products.select("product_id", "product_name", "category_name", "price")
    best = top_k(match(forecast, p, "product_id"), [F.desc("predicted_units"), F.asc("product_id")], k)
    return best.select(
        "product_id", "product_name", "category_name", "price", "predicted_units",
        F.round(F.col("stability_score") * 100, 1).alias("stability_score_pct"),
        m.dollars(F.col("predicted_units") * m.cents("price")).alias("baseline_revenue_estimate"),
    )


def inventory_rollup(inventory_health: DataFrame) -> DataFrame:
    by_status = inventory_health.groupBy("stock_status").agg(
        F.count(F.lit(1)).alias("product_warehouse_combos"), F.sum("current_stock").alias("total_units"),
        count_when(F.col("reorder_flag")).alias("reorder_needed"),
    )
    return sorted_by_label(by_status, "stock_status", labels.STOCK_ORDER)


def rules_with_results(results: DataFrame, rules: DataFrame) -> DataFrame:
    q = match(results.select("rule_id", "total_records", "failed_records", "failure_pct", "status"), rules, "rule_id")
    shown = q.select(
        "rule_id", "rule_type", "dataset", "field", "severity", "description", "total_records", "failed_records",
        F.round("failure_pct", 4).alias("failure_pct"), F.col("threshold").alias("threshold_pct"), "status",
    )
    return sorted_by_label(shown, "severity", labels.SEVERITY_ORDER, "rule_id")


def quality_by_severity(summary: DataFrame) -> DataFrame:
    return sorted_by_label(summary, "severity", labels.SEVERITY_ORDER)


def evaluation_by_type(evaluation: DataFrame) -> DataFrame:
    return evaluation.groupBy("question_type").agg(
        F.count(F.lit(1)).alias("questions"), count_when(F.col("tool_correct")).alias("correctly_routed"),
        count_when(F.col("response_supported")).alias("supported_responses"),
        F.round(F.avg("latency_ms"), 1).alias("avg_latency_ms"),
        share_pct(F.col("tool_correct"), 1).alias("routing_accuracy_pct"),
    ).orderBy("question_type")


def interaction_log(interactions: DataFrame, width: int = 180) -> DataFrame:
    return interactions.select(
        "interaction_id", "session_id", "query", "agent_name", "tool_used", "status",
        F.round("latency_ms", 1).alias("latency_ms"),
        F.substring("response_summary", 1, width).alias("response_preview"), "created_at",
    ).orderBy(F.desc("created_at"), "interaction_id")


def live_sales(minutes: DataFrame, k: int = 50) -> DataFrame:
    best = top_k(minutes, [F.desc("event_minute"), F.desc("revenue"), F.asc("channel")], k)
    return best.select(
        "event_minute", "channel", "order_count", "unique_customers",
        *[F.round(c, 2).alias(c) for c in ("gross_sales", "discounts", "revenue", "avg_order_value")], "last_updated",
    )


def stream_health(metrics: DataFrame, k: int = 50) -> DataFrame:
    seconds = F.greatest(F.col("processing_ms") / 1000.0, F.lit(0.001))
    best = top_k(metrics, [F.desc("batch_finished_at"), F.desc("microbatch_id")], k)
    return best.select(
        "stream_name", "microbatch_id", "input_rows", "bronze_rows", "silver_rows", "processing_ms",
        "event_lag_seconds", "status", "batch_finished_at",
        F.round(F.col("input_rows") / seconds, 2).alias("processing_rows_per_sec"),
    )


def managed_live_sales(minutes: DataFrame, k: int = 50) -> DataFrame:
    best = top_k(minutes, [F.desc("event_minute"), F.desc("revenue"), F.asc("channel")], k)
    return best.select(
        "event_minute", "channel", "order_count", "unique_customers", "revenue", "avg_order_value", "last_updated"
    )
