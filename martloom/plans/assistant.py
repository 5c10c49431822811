"""The assistant as operators on a frame of questions: safety, routing, metrics, listings, evaluation."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from martloom.functions import money as m, text as tx
from martloom.functions.dates import since
from martloom.operators.aggregates import count_when, status_counts
from martloom.operators.joins import match, one_row
from martloom.operators.ordering import top_k

Tables = Mapping[str, DataFrame]

# Phrase lists, keywords and labelled questions.
INJECTION = (
    "ignore previous", "ignore instructions", "ignore all instructions", "system prompt", "reveal credentials",
    "reveal configuration", "drop table", "delete from", "insert into", "you are now", "pretend you are", "act as",
    "jailbreak", "unrestricted ai", "dan mode", "developer mode", "admin access", "escalate privilege", "bypass",
    "override safety",
)
SENSITIVE = (
    "credentials", "connection string", "api key", "secret key", "password", "access token", "private key",
    "give me access", "grant access",
)
DESTRUCTIVE = ("delete all", "drop table", "truncate", "remove all records", "wipe", "destroy", "erase all")
CHAT_BLOCKED = (
    "ignore previous", "ignore instructions", "system prompt", "reveal credentials", "drop table", "delete from",
    "insert into", "you are now", "pretend you are", "act as", "jailbreak", "bypass", "override safety",
    "admin access", "give me access", "show me secrets", "api key", "password", "what is your prompt",
)
ROUTES = {
    "quality": ("quality", "rule", "rules", "validation", "pass", "fail", "dq", "score", "completeness"),
    "anomaly": ("anomaly", "anomalies", "unusual", "spike", "alert", "outlier", "fraud", "suspicious"),
    "knowledge": (
        "return", "refund", "shipping", "loyalty", "warranty", "privacy", "policy", "procedure", "runbook", "guide",
        "document", "help", "explain", "return policy", "refund policy", "shipping policy", "loyalty program",
    ),
    "operations": (
        "pipeline", "status", "job", "jobs", "run", "runs", "monitor", "monitoring", "health", "system", "schedule",
        "stream", "streams",
    ),
    "analytics": (
        "revenue", "sales", "order", "orders", "customer", "customers", "kpi", "metric", "metrics", "profit", "total",
        "amount", "churn",
    ),
}
CHAT_ROUTES = {
    "realtime": ("realtime", "real-time", "live", "stream"),
    "knowledge": (
        "return", "refund", "policy", "shipping", "loyalty", "warranty", "privacy", "billing", "security",
        "sustainability", "international", "b2b",
    ),
    "sales": ("sales", "revenue", "daily", "trend", "channel", "orders last"),
    "kpi": ("executive", "kpi", "summary", "platform", "overview", "dashboard"),
    "inventory": ("inventory", "stock", "reorder", "out of stock", "warehouse", "critical"),
    "churn": ("churn", "at risk", "high risk", "losing", "retention"),
    "anomaly": ("anomaly", "anomalies", "fraud", "suspicious", "outlier", "unusual"),
    "quality": ("quality", "dq", "rules", "pass rate", "validation"),
    "pipeline": ("pipeline", "job", "status", "monitoring", "run", "notebook"),
    "ml": ("model", "ml", "machine learning", "prediction", "forecast", "segment"),
    "customer": ("customer", "profile", "c0", "who is"),
}
UNSUPPORTED_WORDS = ("unavailable", "no quality results", "error:")
METRIC_WORDS = (
    (("churn",), "high_churn_risk"),
    (("revenue", "sales"), "total_revenue"),
    (("order",), "total_orders"),
    (("customer",), "active_customers"),
)
RISKY_STOCK = ("Out of Stock", "Critical", "Low")


# --- per question -----------------------------------------------------------------------------


def rejection(text: Column) -> Column:
    """Which family of unsafe phrases is hit first; NULL for a safe question."""
    q = F.lower(text)
    return (
        F.when(tx.contains_any(q, INJECTION), "INJECTION_ATTEMPT")
        .when(tx.contains_any(q, SENSITIVE), "SENSITIVE_REQUEST")
        .when(tx.contains_any(q, DESTRUCTIVE), "DESTRUCTIVE_REQUEST")
    )


def chat_rejection(text: Column) -> Column:
    """The blocked phrase that is hit, NULL for a safe question."""
    return tx.first_phrase(F.lower(text), CHAT_BLOCKED)


def _first_route(text: Column, routes: Mapping[str, tuple[str, ...]]) -> Column:
    return reduce(lambda chain, r: chain.when(tx.has_any_keyword(text, routes[r]), r), routes, F)


def route(text: Column) -> Column:
    return _first_route(F.lower(text), ROUTES).otherwise("knowledge")


def chat_route(text: Column) -> Column:
    q = F.lower(text)
    # the id must stand alone here: c and exactly seven digits
    return _first_route(q, CHAT_ROUTES).when(
        q.rlike(r"(^|[^\p{L}\p{N}_])c\p{Nd}{7}([^\p{L}\p{N}_]|$)"), "customer"
    ).otherwise("knowledge")


def answering_agent(text: Column) -> Column:
    return F.when(rejection(text).isNotNull(), "safety_filter").otherwise(route(text))


def metric_for(text: Column) -> Column:
    q = F.lower(text)
    return reduce(lambda c, rule: c.when(tx.contains_any(q, rule[0]), rule[1]), METRIC_WORDS, F).otherwise("summary")


def sql_refusal(sql: Column) -> Column:
    """Why a SQL text may not run; NULL for one read-only SELECT or WITH."""
    # TRIM alone leaves tabs and line ends
    q = F.regexp_replace(F.coalesce(sql, F.lit("")), r"^\s+|\s+$", "")
    first = F.upper(F.regexp_extract(q, r"^\S+", 0))
    single = first.isin("SELECT", "WITH") & ~F.regexp_replace(q, ";+$", "").contains(";")
    return F.when(~single, "not a single SELECT or WITH").when(tx.mentions_forbidden_sql(q), "mutating statement")


def answers(questions: DataFrame) -> DataFrame:
    """Questions with their safety verdict and route."""
    text = F.col("text")
    return questions.withColumns(
        {"rejection": rejection(text), "agent": answering_agent(text), "metric": metric_for(text)}
    )


def supported(agent: Column, status: Column, response: Column) -> Column:
    """Whether an answer is backed: grounded, rejected where it should be, free of failure words."""
    failing = tx.contains_any(F.lower(response), UNSUPPORTED_WORDS)
    return (
        F.when(agent == "knowledge", (status == "SUCCESS") & response.startswith("Grounded matches"))
        .when(agent == "safety_filter", status == "REJECTED")
        .otherwise((status == "SUCCESS") & ~failing)
    )


def respond(
    questions: DataFrame, passages: DataFrame, lines: DataFrame, at: dt.datetime, elapsed_ms: float | None = None
) -> DataFrame:
    """One interaction row per question.

    `passages` come from `retrieval.passages`, `lines` from `answer_lines`. The questions are answered together, so
    `elapsed_ms` is the time of one question where the caller has measured it, and NULL where not.
    """
    ident = F.col("document_id").cast("string")
    piece = F.concat(F.lit("["), ident, F.lit("] "), F.coalesce("title", F.lit("")), F.lit(": "),
                     tx.preview(F.coalesce("chunk_text", F.lit("")), 180))
    places = F.array_sort(F.collect_list(F.struct("place", ident.alias("id"), piece.alias("piece"))))
    listed = passages.groupBy("question_id").agg(places.alias("_places")).select(
        "question_id", F.array_join(F.col("_places")["piece"], " | ").alias("_docs"),
        F.array_join(F.col("_places")["id"], ",").alias("_ids"),
    )
    topic = F.when(F.col("agent") == "analytics", F.col("metric")).otherwise(F.col("agent"))
    q = answers(questions).withColumn("topic", topic).join(listed, "question_id", "left").join(lines, "topic", "left")
    unmatched = F.concat(F.lit("No grounded document matched: '"), F.coalesce("text", F.lit("")), F.lit("'"))
    response = (
        F.when(F.col("agent") == "safety_filter", F.concat(F.lit("Request rejected: "), F.col("rejection")))
        .when(F.col("agent") == "knowledge", F.coalesce(F.concat(F.lit("Grounded matches | "), F.col("_docs")), unmatched))
        .otherwise(F.coalesce("line", F.concat(F.col("topic"), F.lit(" unavailable"))))
    )
    is_knowledge = F.col("agent") == "knowledge"
    return q.select(
        F.concat(F.lit("INT"), F.col("question_id")).alias("interaction_id"), F.lit("batch").alias("session_id"),
        F.col("text").alias("query"), F.concat(F.col("agent"), F.lit("_agent")).alias("agent_name"),
        F.col("agent").alias("tool_used"), F.col("agent").alias("route"),
        F.when(is_knowledge, F.coalesce("_ids", F.lit(""))).otherwise("").alias("source_document_ids"),
        tx.preview(response, 1000).alias("response_summary"),
        F.when(F.col("agent") == "safety_filter", "REJECTED").otherwise("SUCCESS").alias("status"),
        F.lit(elapsed_ms).cast("double").alias("latency_ms"), F.lit(at).alias("created_at"),
    )


def evaluate(labelled: DataFrame, interactions: DataFrame) -> DataFrame:
    """Expected against actual route for labelled questions (`question_id`, `question_type`, `expected_agent`)."""
    keyed = labelled.select(
        F.concat(F.lit("INT"), F.col("question_id")).alias("interaction_id"), "question_id", "question_type", "expected_agent"
    )
    e = match(keyed, interactions, "interaction_id")
    return e.select(
        F.concat(F.lit("EVAL"), F.col("question_id")).alias("evaluation_id"), "question_type", "query", "expected_agent",
        F.col("tool_used").alias("actual_agent"), (F.col("tool_used") == F.col("expected_agent")).alias("tool_correct"),
        supported(F.col("tool_used"), F.col("status"), F.col("response_summary")).alias("response_supported"),
        "latency_ms", F.col("created_at").alias("evaluated_at"),
    )


# --- metrics ----------------------------------------------------------------------------------


def _live(t: Tables) -> DataFrame:
    return t["fact_orders"].where(F.col("order_status") != "Cancelled")


def _count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).cast("double").alias("value"))


def _active(t: Tables) -> DataFrame:
    return t["dim_customers"].where((F.col("status") == "Active") & F.col("is_current"))


METRICS: dict[str, Callable[[Tables], DataFrame]] = {
    "total_revenue": lambda t: t["fact_orders"].agg(m.dollars(m.total("net_revenue")).alias("value")),
    "avg_order_value": lambda t: _live(t).agg(
        m.mean_cents(m.total("net_revenue"), F.count("net_revenue")).alias("value")
    ),
    "total_orders": lambda t: _count(_live(t)),
    "active_customers": lambda t: _count(_active(t)),
    "high_churn_risk": lambda t: _count(t["churn_predictions"].where(F.col("churn_predicted") == 1)),
    "quality_score": lambda t: t["data_quality_kpi"].agg(F.max("overall_pass_rate_pct").cast("double").alias("value")),
    "anomaly_count": lambda t: _count(t["anomaly_scores"].where(F.col("is_anomaly") == 1)),
}


def metric(t: Tables, name: str) -> DataFrame:
    """One (metric, value) row; an unknown name is an error."""
    if name not in METRICS:
        raise KeyError(f"unknown metric: {name}")
    return METRICS[name](t).select(F.lit(name).alias("metric"), F.coalesce("value", F.lit(0.0)).alias("value"))


def metric_values(t: Tables, names=tuple(METRICS)) -> DataFrame:
    return reduce(DataFrame.unionByName, [metric(t, n) for n in names])


def platform_summary(t: Tables) -> DataFrame:
    """Active customers, recognised orders and revenue, also as a line of text."""
    row = one_row(
        [
            _active(t).agg(F.count(F.lit(1)).alias("active_customers")),
            _live(t).agg(F.count(F.lit(1)).alias("orders"),
                         m.divide(m.total("net_revenue"), F.lit(100)).cast("double").alias("revenue")),
        ]
    )
    line = F.concat(F.lit("Platform | Active customers: "), tx.thousands(F.col("active_customers")), F.lit(" | Orders: "),
                    tx.thousands(F.col("orders")), F.lit(" | Revenue: $"), tx.thousands(F.col("revenue")))
    return row.withColumn("summary", line)


# --- answers of the agents --------------------------------------------------------------------


def _joined(best: DataFrame, order: list[Column], piece: Column) -> DataFrame:
    """One row `listed`: the pieces of a listing of a few rows, in its order, between bars."""
    numbered = best.select(F.row_number().over(Window.orderBy(*order)).alias("n"), piece.alias("piece"))
    return numbered.agg(
        F.array_join(F.array_sort(F.collect_list(F.struct("n", "piece")))["piece"], " | ").alias("listed")
    )


def metric_lines(metrics: DataFrame) -> DataFrame:
    """(topic, line) for the metrics that questions ask for by name."""
    name, value = F.col("metric"), F.col("value")
    line = (
        F.when(name == "high_churn_risk", F.concat(F.lit("Customers at high churn risk: "), tx.thousands(value)))
        .when(name == "total_revenue", F.concat(F.lit("Total revenue: "), tx.dollars(value)))
        .when(name == "total_orders", F.concat(F.lit("Total orders: "), tx.thousands(value)))
        .when(name == "active_customers", F.concat(F.lit("Active customers: "), tx.thousands(value)))
    )
    return metrics.select(name.alias("topic"), line.alias("line")).where("line IS NOT NULL")


def quality_line(metrics: DataFrame, results: DataFrame, k: int = 6) -> DataFrame:
    """The overall score and the first k counts of rules by table and status."""
    order = [F.asc("dataset"), F.asc("status")]
    piece = F.format_string("%s:%s(%d)", "dataset", "status", "rows")
    score = metrics.where(F.col("metric") == "quality_score").agg(F.max("value").alias("value"))
    row = one_row([score, _joined(top_k(quality_view(results), order, k), order, piece)])
    score_text = F.coalesce("value", F.lit(0.0)).cast("string")
    return row.select(
        F.lit("quality").alias("topic"),
        F.concat(F.lit("Overall quality: "), score_text, F.lit("% | "), F.coalesce("listed", F.lit(""))).alias("line"),
    )


def anomaly_line(metrics: DataFrame, events: DataFrame, k: int = 3) -> DataFrame:
    """How many customers are anomalous, and the top alerts."""
    order = [F.desc("detected_at"), F.desc("anomaly_score"), F.asc("entity_id")]
    piece = F.concat(
        F.col("entity_id").cast("string"), F.lit(" score="), F.format_string("%.3f", F.round("anomaly_score", 3)),
        F.lit(" severity="), F.coalesce("severity", F.lit("")),
    )
    count = metrics.where(F.col("metric") == "anomaly_count").agg(F.max("value").alias("value"))
    row = one_row([count, _joined(alerts(events, k=k), order, piece)])
    return row.select(
        F.lit("anomaly").alias("topic"),
        F.concat(F.lit("Anomalous customers: "), tx.thousands(F.coalesce("value", F.lit(0.0))), F.lit(" | "),
                 F.coalesce("listed", F.lit(""))).alias("line"),
    )


def operations_line(runs: DataFrame, health: DataFrame, k: int = 5) -> DataFrame:
    """The most recent runs; without any, the number of tables of each layer (`layer`, `tables`)."""
    order = [F.desc("end_time"), F.asc("run_id")]
    recent = _joined(top_k(runs, order, k), order, F.concat_ws(":", "notebook", "status"))
    layers = _joined(health, [F.asc("layer")], F.concat_ws(":", "layer", F.col("tables").cast("string")))
    row = one_row([recent, layers.withColumnRenamed("listed", "layers")])
    return row.select(
        F.lit("operations").alias("topic"),
        F.when(F.col("listed") != "", F.concat(F.lit("Recent pipeline runs | "), F.col("listed")))
        .otherwise(F.concat(F.lit("System health | "), F.coalesce("layers", F.lit(""))))
        .alias("line"),
    )


def answer_lines(
    t: Tables, metrics: DataFrame, results: DataFrame, events: DataFrame, runs: DataFrame, health: DataFrame
) -> DataFrame:
    """(topic, line): what each agent but the knowledge agent says, one row for each of eight topics."""
    parts = [
        metric_lines(metrics),
        platform_summary(t).select(F.lit("summary").alias("topic"), F.col("summary").alias("line")),
        quality_line(metrics, results), anomaly_line(metrics, events), operations_line(runs, health),
    ]
    return reduce(DataFrame.unionByName, parts)


# --- listings ---------------------------------------------------------------------------------


def alerts(events: DataFrame, severity: str | None = None, k: int = 10) -> DataFrame:
    chosen = events if severity is None else events.where(F.col("severity") == severity)
    return top_k(chosen, [F.desc("detected_at"), F.desc("anomaly_score"), F.asc("entity_id")], k)


def recent_runs(runs: DataFrame, k: int = 20) -> DataFrame:
    best = top_k(runs, [F.desc("end_time"), F.asc("run_id")], k)
    return best.select("notebook", "layer", "status", "rows_written", "start_time", "end_time", "duration_seconds",
                       "error_message")


def quality_view(results: DataFrame) -> DataFrame:
    return status_counts(results, "dataset", "status")


def sales_summary(daily_sales: DataFrame, as_of: dt.date, days: int = 7, k: int = 10) -> DataFrame:
    recent = daily_sales.where(since("order_date", as_of, days))
    per_day = recent.groupBy("order_date").agg(
        F.sum("total_orders").alias("orders"), m.total("total_revenue").alias("_revenue")
    )
    best = top_k(per_day, [F.desc("order_date")], k)
    return best.select("order_date", "orders", m.dollars(F.col("_revenue")).alias("revenue"),
                       m.mean_cents(F.col("_revenue"), F.col("orders")).alias("aov"))


def customer_profile(customer_360: DataFrame, customer_id) -> DataFrame:
    return customer_360.where(F.col("customer_id") == F.lit(customer_id)).select(
        "customer_id", "full_name", "customer_segment", "country", "status", "total_orders",
        F.round("total_revenue", 2).alias("revenue"), "days_since_last_order", "recency_risk", "clv_tier",
    ).limit(1)


def inventory_risk(inventory_health: DataFrame, k: int = 15) -> DataFrame:
    risky = inventory_health.where(F.col("stock_status").isin(*RISKY_STOCK))
    best = top_k(risky, [F.asc("current_stock"), F.asc("product_id"), F.asc("warehouse_id")], k)
    return best.select(tx.preview(F.col("product_name"), 30).alias("product_name"), "warehouse_id", "current_stock",
                       "stock_status")


def high_churn(predictions: DataFrame, customer_360: DataFrame, floor: float = 0.6, k: int = 10) -> DataFrame:
    p = predictions.where(F.col("churn_probability") >= floor).select("customer_id", "churn_probability")
    c = customer_360.select("customer_id", "full_name", "customer_segment", "total_revenue", "days_since_last_order")
    return top_k(match(p, c, "customer_id"), [F.desc("churn_probability"), F.asc("customer_id")], k)


def anomaly_details(events: DataFrame, k: int = 10) -> DataFrame:
    best = top_k(events, [F.desc("anomaly_score"), F.asc("entity_id")], k)
    return best.select("entity_id", F.round("anomaly_score", 4).alias("score"),
                       F.round("churn_probability", 4).alias("churn_prob"))


def quality_listing(summary: DataFrame) -> DataFrame:
    return summary.select("severity", "rule_count", "passed", "failed", "errors", "pass_rate_pct").orderBy("severity")


def kpi_rows(kpi: DataFrame) -> DataFrame:
    """The one-row KPI table as (metric, value) rows."""
    values = [c for c in kpi.columns if c != "report_date"]
    doubles = kpi.select(*[F.col(c).cast("double").alias(c) for c in values])
    return doubles.unpivot([], values, "metric", "value")


def model_summary(predictions: DataFrame, segments: DataFrame, forecast: DataFrame, k: int = 5) -> DataFrame:
    """(section, name, value) rows: scores, segment sizes and the products with most expected demand."""
    scores = predictions.agg(
        F.count(F.lit(1)).cast("double").alias("scored"),
        count_when(F.col("churn_probability") >= 0.7).cast("double").alias("high_risk"),
        F.round(F.avg("churn_probability") * 100, 1).alias("mean_probability_pct"),
    ).unpivot([], ["scored", "high_risk", "mean_probability_pct"], "name", "value")
    sizes = segments.groupBy(F.col("segment_label").alias("name")).agg(F.count(F.lit(1)).cast("double").alias("value"))
    demand = top_k(forecast, [F.desc("predicted_units"), F.asc("product_id")], k).select(
        F.col("product_id").cast("string").alias("name"), F.col("predicted_units").cast("double").alias("value")
    )
    parts = {"churn": scores, "segment": sizes, "demand": demand}
    return reduce(DataFrame.unionByName, [df.select(F.lit(s).alias("section"), "name", "value") for s, df in parts.items()])


def first_available(t: Tables, names: list[str]) -> tuple[str, DataFrame] | None:
    """The first listed table that exists and has rows."""
    for name in names:
        if name in t and not t[name].isEmpty():
            return name, t[name]
    return None


def live_listing(spark: SparkSession, t: Tables, k: int = 10) -> DataFrame:
    found = first_available(t, ["live_sales_minute", "live_sales_minute_pipeline"])
    if found is None:
        return spark.createDataFrame(
            [], "mode string, event_minute timestamp, channel string, order_count long, revenue double"
        )
    best = top_k(found[1], [F.desc("event_minute"), F.desc("revenue"), F.asc("channel")], k)
    return best.select(F.lit(found[0]).alias("mode"), "event_minute", "channel", "order_count",
                       F.round("revenue", 2).alias("revenue"))


