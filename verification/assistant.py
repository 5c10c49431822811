"""Assistant and dashboard queries (Q1-Q25, H1-H15)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from martloom.functions import text as tx
from martloom.functions.labels import label_lookup
from martloom.plans import anomalies, assistant as a, demand, quality as q, reports as h, validation as v
from martloom.plans.retrieval import passages, search
from martloom.sources.sinks import tables_per_layer
from verification.common import Registry
from verification.ctes import AS_OF, mean_cents, money, pct, sql
from verification.quality import EXTRA, results
from verification.states import ML

R = Registry()
AT = dt.datetime(2001, 8, 1)
SEGMENT_LABELS = {0: "Low Value", 1: "Developing", 2: "High Value", 3: "Champions"}


# --- comparison SQL for text tests --------------------------------------------------------------


def _any(text: str, phrases) -> str:
    return "(" + " OR ".join(f"contains({text}, '{p}')" for p in phrases) + ")"


def _keyword(text: str, k: str) -> str:
    if " " in k or "-" in k:
        return f"contains({text}, '{k}')"
    return f"regexp_matches({text}, '(^|[^\\p{{L}}\\p{{N}}_]){k}([^\\p{{L}}\\p{{N}}_]|$)')"


def _route(text: str, routes, last: str = "") -> str:
    whens = " ".join(f"WHEN {' OR '.join(_keyword(text, k) for k in ks)} THEN '{r}'" for r, ks in routes.items())
    return f"CASE {whens} {last} ELSE 'knowledge' END"


LOWER = "lower(text)"
REJECTION = (
    f"CASE WHEN {_any(LOWER, a.INJECTION)} THEN 'INJECTION_ATTEMPT' WHEN {_any(LOWER, a.SENSITIVE)} THEN"
    f" 'SENSITIVE_REQUEST' WHEN {_any(LOWER, a.DESTRUCTIVE)} THEN 'DESTRUCTIVE_REQUEST' END"
)
METRIC = "CASE " + " ".join(f"WHEN {_any(LOWER, w)} THEN '{n}'" for w, n in a.METRIC_WORDS) + " ELSE 'summary' END"
TERMS = (
    "list_transform(list_slice(list_filter(regexp_extract_all(text, '[A-Za-z0-9_]+'), lambda x: length(x) > 3), 1, 8),"
    " lambda x: lower(x))"
)
FORBIDDEN = "(?i)\\b(" + "|".join(tx.FORBIDDEN_SQL) + ")\\b"
PERIOD = (
    "CASE regexp_extract(text, '([0-9]+)\\s*(day|week|month)', 2) WHEN '' THEN 7"
    " ELSE CAST(regexp_extract(text, '([0-9]+)\\s*(day|week|month)', 1) AS INTEGER)"
    " * CASE regexp_extract(text, '([0-9]+)\\s*(day|week|month)', 2) WHEN 'day' THEN 1 WHEN 'week' THEN 7 ELSE 30 END END"
)
CTX = {
    **EXTRA,
    **ML,
    "asked": f"SELECT question_id, text, expected_agent, {REJECTION} AS rejection, {METRIC} AS metric,"
    f" {_route(LOWER, a.ROUTES)} AS route, {TERMS} AS terms FROM src_questions",
    "routed": "SELECT *, CASE WHEN rejection IS NOT NULL THEN 'safety_filter' ELSE route END AS agent FROM asked",
    "customer_segments": "SELECT customer_id, CASE cluster WHEN 0 THEN 'Low Value' WHEN 1 THEN 'Developing'"
    " WHEN 2 THEN 'High Value' ELSE 'Champions' END AS segment_label FROM src_customer_scores",
    "live_minutes": "SELECT date_trunc('minute', event_time) AS event_minute, channel, COUNT(*) AS order_count,"
    " COUNT(DISTINCT customer_id) AS unique_customers, CAST(SUM(" + money("order_total") + ") AS DOUBLE) AS gross_sales,"
    " CAST(SUM(" + money("discount_amount") + ") AS DOUBLE) AS discounts,"
    " CAST(SUM(" + money("order_total") + " - " + money("discount_amount") + ") AS DOUBLE) AS revenue,"
    " " + mean_cents("SUM(" + money("order_total") + " - " + money("discount_amount") + ")", "COUNT(*)") + " AS avg_order_value,"
    " MAX(event_time) AS last_updated FROM src_order_events GROUP BY 1, 2",
    "dq_kpi": f"SELECT {pct('SUM(passed)', 'SUM(rule_count)', 1)} AS overall_pass_rate_pct FROM quality_summary",
    "metric_values": "SELECT 'total_revenue' AS metric, CAST(SUM(net_revenue) AS DOUBLE) AS value FROM fact_orders UNION ALL"
    f" SELECT 'avg_order_value', {mean_cents('SUM(net_revenue)', 'COUNT(*)')} FROM fact_orders WHERE order_status <> 'Cancelled'"
    " UNION ALL SELECT 'total_orders', CAST(COUNT(*) AS DOUBLE) FROM fact_orders WHERE order_status <> 'Cancelled'"
    " UNION ALL SELECT 'active_customers', CAST(COUNT(*) AS DOUBLE) FROM dim_customers WHERE status = 'Active'"
    " UNION ALL SELECT 'high_churn_risk', CAST(COUNT(*) AS DOUBLE) FROM src_customer_scores WHERE churn_predicted = 1"
    " UNION ALL SELECT 'quality_score', overall_pass_rate_pct FROM dq_kpi"
    " UNION ALL SELECT 'anomaly_count', CAST(COUNT(*) AS DOUBLE) FROM src_customer_scores WHERE is_anomaly = 1",
    "answer_lines": "SELECT 'high_churn_risk' AS topic, 'Customers at high churn risk: ' || format('{:,.0f}', value) AS line"
    " FROM metric_values WHERE metric = 'high_churn_risk' UNION ALL"
    " SELECT 'total_revenue', 'Total revenue: $' || format('{:,.2f}', value) FROM metric_values WHERE metric = 'total_revenue'"
    " UNION ALL SELECT 'total_orders', 'Total orders: ' || format('{:,.0f}', value) FROM metric_values"
    " WHERE metric = 'total_orders' UNION ALL SELECT 'active_customers', 'Active customers: ' || format('{:,.0f}', value)"
    " FROM metric_values WHERE metric = 'active_customers' UNION ALL"
    " SELECT 'summary', 'Platform | Active customers: '"
    " || format('{:,}', (SELECT COUNT(*) FROM dim_customers WHERE status = 'Active')) || ' | Orders: ' || format('{:,}', COUNT(*))"
    " || ' | Revenue: $' || format('{:,.0f}', CAST(CAST(SUM(net_revenue) AS DECIMAL(28,0)) AS DOUBLE)) FROM fact_orders"
    " WHERE order_status <> 'Cancelled' UNION ALL"
    " SELECT 'quality', 'Overall quality: ' || CAST((SELECT value FROM metric_values WHERE metric = 'quality_score') AS VARCHAR)"
    " || '% | ' || string_agg(dataset || ':' || status || '(' || n || ')', ' | ' ORDER BY dataset, status) FROM (SELECT dataset,"
    " status, COUNT(*) AS n FROM quality_results GROUP BY dataset, status ORDER BY dataset, status LIMIT 6) UNION ALL"
    " SELECT 'anomaly', 'Anomalous customers: ' || format('{:,.0f}', (SELECT value FROM metric_values WHERE metric ="
    " 'anomaly_count')) || ' | ' || COALESCE(string_agg(entity_id || ' score=' || printf('%.3f', round(anomaly_score, 3)) ||"
    " ' severity=' || severity, ' | ' ORDER BY detected_at DESC, anomaly_score DESC, entity_id), '') FROM (SELECT * FROM"
    " anomaly_events ORDER BY detected_at DESC, anomaly_score DESC, entity_id LIMIT 3) UNION ALL"
    " SELECT 'operations', 'Recent pipeline runs | ' || string_agg(notebook || ':' || status, ' | ' ORDER BY end_time DESC, run_id)"
    " FROM (SELECT * FROM src_pipeline_runs ORDER BY end_time DESC, run_id LIMIT 5)",
    "passages": "SELECT m.question_id, string_agg('[' || m.document_id || '] ' || COALESCE(c.title, '') || ': ' ||"
    " substring(COALESCE(c.chunk_text, ''), 1, 180), ' | ' ORDER BY m.place) AS docs,"
    " string_agg(CAST(m.document_id AS VARCHAR), ',' ORDER BY m.place) AS ids FROM matches m JOIN document_chunks c"
    " ON m.document_id = c.document_id WHERE m.place <= 3 GROUP BY m.question_id",
    "interactions": "SELECT r.*, CASE WHEN agent = 'safety_filter' THEN 'REJECTED' ELSE 'SUCCESS' END AS status,"
    " CASE WHEN agent = 'knowledge' THEN COALESCE(p.ids, '') ELSE '' END AS ids,"
    " substring(CASE agent WHEN 'safety_filter' THEN 'Request rejected: ' || rejection WHEN 'knowledge' THEN"
    " COALESCE('Grounded matches | ' || p.docs, 'No grounded document matched: ''' || text || '''') ELSE l.line END, 1, 1000)"
    " AS response FROM routed r LEFT JOIN passages p ON p.question_id = r.question_id LEFT JOIN answer_lines l"
    " ON l.topic = CASE WHEN r.agent = 'analytics' THEN r.metric ELSE r.agent END",
    "matches": "SELECT question_id, document_id, n AS place FROM (SELECT q.question_id, c.document_id,"
    " row_number() OVER (PARTITION BY q.question_id ORDER BY c.document_id) AS n FROM asked q JOIN document_chunks c ON"
    " len(q.terms) = 0 OR len(list_filter(q.terms, lambda w: contains(lower(c.chunk_text), w)"
    " OR contains(lower(c.title), w) OR contains(lower(c.topic), w))) > 0) WHERE n <= 5",
}


def S(body: str) -> str:
    return sql(body, **CTX)


# --- inputs on fixed scores -------------------------------------------------------------------


def model_tables(x):
    scores = x.source["customer_scores"]
    return x.t.replacing(
        churn_predictions=scores, anomaly_scores=scores,
        data_quality_kpi=q.data_quality_kpi(q.quality_summary(results(x)), x.as_of),
    )


def segments(x):
    return x.source["customer_scores"].select("customer_id", label_lookup(F.col("cluster"), SEGMENT_LABELS).alias("segment_label"))


def events(x):
    return anomalies.anomaly_events(x.source["customer_scores"], x.as_of)


def live_minutes(x):
    from martloom.streaming.live_sales import minute_kpis

    return minute_kpis(
        x.source["order_events"].withColumn("net_revenue", F.round(F.col("order_total") - F.col("discount_amount"), 2)),
        F.max("event_time"),
    )


def matches(x):
    return search(x.source["questions"], x.t["document_chunks"])


def lines(x, runs=None):
    scores, found = x.source["customer_scores"], results(x)
    kpi = q.data_quality_kpi(q.quality_summary(found), x.as_of)
    t = x.t.replacing(churn_predictions=scores, anomaly_scores=scores, data_quality_kpi=kpi)
    runs = x.source["pipeline_runs"] if runs is None else runs
    # (layer, tables) from given rows: channels of each order status
    health = x.t["fact_orders"].groupBy(F.col("order_status").alias("layer")).agg(F.count_distinct("channel").alias("tables"))
    return a.answer_lines(t, a.metric_values(t), found, events(x), runs, health)


def interactions(x):
    return a.respond(x.source["questions"], passages(matches(x), x.t["document_chunks"]), lines(x), AT)


def labelled(x):
    return x.source["questions"].select("question_id", F.col("expected_agent").alias("question_type"), "expected_agent")


# --- assistant --------------------------------------------------------------------------------

text = lambda: F.col("text")
questions = lambda x: x.source["questions"]

R.add(
    "q1_safety",
    lambda x: questions(x).select("question_id", a.rejection(text()).isNull().alias("safe"), a.rejection(text()).alias("reason")),
    S("SELECT question_id, rejection IS NULL AS safe, rejection AS reason FROM asked"),
)
_CHAT = "COALESCE(" + ", ".join(f"CASE WHEN contains({LOWER}, '{p}') THEN '{p}' END" for p in a.CHAT_BLOCKED) + ")"
R.add(
    "q2_chat_safety",
    lambda x: questions(x).select("question_id", a.chat_rejection(text()).alias("phrase")),
    S(f"SELECT question_id, {_CHAT} AS phrase FROM src_questions"),
)
R.add(
    "q3_route",
    lambda x: questions(x).select("question_id", a.route(text()).alias("route")),
    S("SELECT question_id, route FROM asked"),
)
_ID_RULE = f"WHEN regexp_matches({LOWER}, '(^|[^\\p{{L}}\\p{{N}}_])c[0-9]{{7}}([^\\p{{L}}\\p{{N}}_]|$)') THEN 'customer'"
R.add(
    "q4_chat_route",
    lambda x: questions(x).select("question_id", a.chat_route(text()).alias("tool")),
    S(f"SELECT question_id, {_route(LOWER, a.CHAT_ROUTES, _ID_RULE)} AS tool FROM src_questions"),
)
R.add(
    "q5_read_only_sql",
    lambda x: x.source["sql_texts"].select("sql_id", a.sql_refusal(F.col("sql")).alias("refusal")),
    S(
        "SELECT sql_id, CASE WHEN upper(regexp_extract(q, '^\\S+')) NOT IN ('SELECT', 'WITH')"
        " OR contains(regexp_replace(q, ';+$', ''), ';') THEN 'not a single SELECT or WITH'"
        f" WHEN regexp_matches(regexp_replace(q, '''(?:''''|[^''])*''', '', 'g'), '{FORBIDDEN}') THEN 'mutating statement' END"
        " AS refusal FROM (SELECT sql_id, regexp_replace(sql, '^\\s+|\\s+$', '', 'g') AS q FROM src_sql_texts)"
    ),
)
R.add("q6_retrieval", matches, S("SELECT * FROM matches"))
R.add("q7_metrics", lambda x: a.metric_values(model_tables(x)), S("SELECT * FROM metric_values"))
R.add(
    "q8_alerts",
    lambda x: a.alerts(events(x), "critical").select("event_id", "entity_id", "severity", "anomaly_score"),
    S(
        "SELECT event_id, entity_id, severity, anomaly_score FROM anomaly_events WHERE severity = 'critical'"
        " ORDER BY detected_at DESC, anomaly_score DESC, entity_id LIMIT 10"
    ),
)
R.add(
    "q9_recent_runs",
    lambda x: a.recent_runs(x.source["pipeline_runs"]),
    S(
        "SELECT notebook, layer, status, rows_written, start_time, end_time, duration_seconds, error_message"
        " FROM src_pipeline_runs ORDER BY end_time DESC, run_id LIMIT 20"
    ),
)


def layer_health(x):
    """Layers as schemas; every source table of the run is visible in its own schema."""
    x.spark.sql("CREATE SCHEMA IF NOT EXISTS martloom_layers")
    for name in ("orders", "customer", "lineitem"):
        x.spark.sql(f"DROP TABLE IF EXISTS martloom_layers.{name}")
        x.spark.sql(f"CREATE TABLE martloom_layers.{name} USING parquet LOCATION '{x.folder}/{name}.parquet'")
    return tables_per_layer(x.spark, ["martloom_layers", "martloom_absent"])


R.add(
    "q10_layer_health",
    layer_health,
    "SELECT 'martloom_layers' AS layer, CAST(3 AS INTEGER) AS tables UNION ALL SELECT 'martloom_absent', CAST(0 AS INTEGER)",
)
R.add(
    "q11_platform_summary",
    lambda x: a.platform_summary(x.t).drop("summary"),
    S(
        "SELECT (SELECT COUNT(*) FROM dim_customers WHERE status = 'Active') AS active_customers, COUNT(*) AS orders,"
        " CAST(CAST(SUM(net_revenue) AS DECIMAL(28,0)) AS DOUBLE) AS revenue FROM fact_orders WHERE order_status <> 'Cancelled'"
    ),
)
R.add(
    "q12_metric_intent",
    lambda x: questions(x).select("question_id", a.metric_for(text()).alias("metric")),
    S("SELECT question_id, metric FROM asked"),
)
R.add(
    "q13_quality_view",
    lambda x: a.quality_view(results(x)),
    S("SELECT dataset, status, COUNT(*) AS rows FROM quality_results GROUP BY dataset, status"),
)
_SUPPORTED = (
    "CASE agent WHEN 'knowledge' THEN starts_with(response, 'Grounded matches') WHEN 'safety_filter' THEN status = 'REJECTED'"
    " ELSE NOT (contains(lower(response), 'unavailable') OR contains(lower(response), 'no quality results')"
    " OR contains(lower(response), 'error:')) END"
)
R.add(
    "q14_grounding",
    lambda x: interactions(x).select(
        "interaction_id", a.supported(F.col("tool_used"), F.col("status"), F.col("response_summary")).alias("supported")
    ),
    S(f"SELECT 'INT' || question_id AS interaction_id, {_SUPPORTED} AS supported FROM interactions"),
)
R.add(
    "q15_evaluation",
    lambda x: a.evaluate(labelled(x), interactions(x)).drop("latency_ms", "evaluated_at", "query"),
    S(
        "SELECT 'EVAL' || question_id AS evaluation_id, expected_agent AS question_type, expected_agent,"
        f" agent AS actual_agent, agent = expected_agent AS tool_correct, {_SUPPORTED} AS response_supported FROM interactions"
    ),
)
R.add(
    "q16_interactions",
    lambda x: interactions(x).select("interaction_id", "query", "agent_name", "status", "source_document_ids",
                                     "response_summary", "latency_ms"),
    S(
        "SELECT 'INT' || question_id AS interaction_id, text AS query, agent || '_agent' AS agent_name, status,"
        " ids AS source_document_ids, response AS response_summary, CAST(NULL AS DOUBLE) AS latency_ms FROM interactions"
    ),
)
R.add("q16_answer_lines", lines, S("SELECT * FROM answer_lines"))
R.add(
    "q10_operations_without_runs",
    lambda x: lines(x, x.source["pipeline_runs"].where("run_id = ''")).where("topic = 'operations'"),
    S(
        "SELECT 'operations' AS topic, 'System health | ' || string_agg(layer || ':' || tables, ' | ' ORDER BY layer) AS line"
        " FROM (SELECT order_status AS layer, COUNT(DISTINCT channel) AS tables FROM fact_orders GROUP BY order_status)"
    ),
)
R.add(
    "q17_sales_summary",
    lambda x: a.sales_summary(x.t["daily_sales_summary"], x.as_of, 21),
    S(
        f"SELECT order_date, CAST(SUM(total_orders) AS BIGINT) AS orders, CAST(SUM({money('total_revenue')}) AS DOUBLE) AS revenue,"
        f" {mean_cents('SUM(' + money('total_revenue') + ')', 'SUM(total_orders)')} AS aov FROM daily_sales_summary"
        f" WHERE order_date >= {AS_OF} - 21 GROUP BY order_date ORDER BY order_date DESC LIMIT 10"
    ),
)
R.add(
    "q18_customer_profile",
    lambda x: a.customer_profile(x.t["customer_360"], 42),
    S(
        "SELECT customer_id, full_name, customer_segment, country, status, total_orders, ROUND(total_revenue, 2) AS revenue,"
        " days_since_last_order, recency_risk, clv_tier FROM customer_360 WHERE customer_id = 42"
    ),
)
R.add(
    "q19_inventory_risk",
    lambda x: a.inventory_risk(x.t["inventory_health"]),
    S(
        "SELECT substring(product_name, 1, 30) AS product_name, warehouse_id, current_stock, stock_status FROM inventory_health"
        " WHERE stock_status IN ('Out of Stock', 'Critical', 'Low') ORDER BY current_stock, product_id, warehouse_id LIMIT 15"
    ),
)
R.add(
    "q20_high_churn",
    lambda x: a.high_churn(x.source["customer_scores"], x.t["customer_360"]),
    S(
        "SELECT p.customer_id, p.churn_probability, c.full_name, c.customer_segment, c.total_revenue, c.days_since_last_order"
        " FROM src_customer_scores p JOIN customer_360 c ON p.customer_id = c.customer_id WHERE p.churn_probability >= 0.6"
        " ORDER BY p.churn_probability DESC, p.customer_id LIMIT 10"
    ),
)
R.add(
    "q21_anomaly_details",
    lambda x: a.anomaly_details(events(x)),
    S(
        "SELECT entity_id, ROUND(anomaly_score, 4) AS score, ROUND(churn_probability, 4) AS churn_prob FROM anomaly_events"
        " ORDER BY anomaly_score DESC, entity_id LIMIT 10"
    ),
)
R.add("q22_quality_listing", lambda x: a.quality_listing(q.quality_summary(results(x))), S("SELECT * FROM quality_summary"))
_KPIS = ("total_customers", "active_customers", "order_attempts", "total_orders", "total_revenue", "avg_order_value",
         "total_returns", "active_products", "open_tickets")
R.add(
    "q23_kpi_rows",
    lambda x: a.kpi_rows(x.t["executive_kpi"]),
    S(" UNION ALL ".join(f"SELECT '{k}' AS metric, CAST({k} AS DOUBLE) AS value FROM executive_kpi" for k in _KPIS)),
)
R.add(
    "q24_model_summary",
    lambda x: a.model_summary(x.source["customer_scores"], segments(x), demand.demand_forecast(x.t, x.as_of)),
    S(
        "SELECT 'churn' AS section, 'scored' AS name, CAST(COUNT(*) AS DOUBLE) AS value FROM src_customer_scores UNION ALL"
        " SELECT 'churn', 'high_risk', CAST(COUNT(*) AS DOUBLE) FROM src_customer_scores WHERE churn_probability >= 0.7"
        " UNION ALL SELECT 'churn', 'mean_probability_pct', ROUND(AVG(churn_probability) * 100, 1) FROM src_customer_scores"
        " UNION ALL SELECT 'segment', segment_label, CAST(COUNT(*) AS DOUBLE) FROM customer_segments GROUP BY segment_label"
        " UNION ALL (SELECT 'demand', CAST(product_id AS VARCHAR), CAST(predicted_units AS DOUBLE) FROM demand_forecast"
        " ORDER BY predicted_units DESC, product_id LIMIT 5)"
    ),
)
R.add(
    "q25_live_listing",
    lambda x: a.live_listing(x.spark, {"live_sales_minute": live_minutes(x).limit(0), "live_sales_minute_pipeline": live_minutes(x)}),
    S(
        "SELECT 'live_sales_minute_pipeline' AS mode, event_minute, channel, order_count, ROUND(revenue, 2) AS revenue"
        " FROM live_minutes ORDER BY event_minute DESC, revenue DESC, channel LIMIT 10"
    ),
)

# --- dashboard --------------------------------------------------------------------------------

R.add(
    "h1_executive",
    lambda x: h.executive(x.t["executive_kpi"]),
    S(
        "SELECT CAST(total_customers AS INTEGER) AS total_customers, CAST(active_customers AS INTEGER) AS active_customers,"
        " CAST(order_attempts AS INTEGER) AS order_attempts, CAST(total_orders AS INTEGER) AS recognized_orders,"
        " total_revenue AS total_revenue_usd, avg_order_value AS avg_order_value_usd,"
        " CAST(total_returns AS INTEGER) AS total_returns, CAST(active_products AS INTEGER) AS active_products,"
        " CAST(open_tickets AS INTEGER) AS open_support_tickets FROM executive_kpi"
    ),
)
R.add(
    "h2_revenue_by_channel",
    lambda x: h.revenue_by_channel(x.t["daily_sales_summary"], x.as_of),
    S(
        "SELECT order_date, channel, total_orders, total_revenue AS revenue, avg_order_value AS aov FROM daily_sales_summary"
        f" WHERE order_date >= {AS_OF} - 30"
    ),
)
R.add(
    "h3_top_customers",
    lambda x: h.top_customers(x.t["customer_360"]),
    S(
        "SELECT customer_id, full_name, customer_segment, country, total_orders, total_revenue AS lifetime_revenue,"
        " days_since_last_order, recency_risk, clv_tier, baseline_3yr_clv FROM customer_360"
        " ORDER BY total_revenue DESC, customer_id LIMIT 20"
    ),
)
R.add(
    "h4_churn_bands",
    lambda x: h.churn_bands(x.source["customer_scores"]),
    S(
        "SELECT CASE WHEN churn_probability >= 0.7 THEN 'High (>=70%)' WHEN churn_probability >= 0.4 THEN 'Medium (40-70%)'"
        " ELSE 'Low (<40%)' END AS risk_band, COUNT(*) AS customer_count, ROUND(AVG(churn_probability) * 100, 1) AS avg_churn_pct"
        " FROM src_customer_scores GROUP BY 1"
    ),
)
R.add(
    "h5_segment_profile",
    lambda x: h.segment_profile(segments(x), x.t["customer_kpis"]),
    S(
        "SELECT s.segment_label, COUNT(*) AS customers,"
        f" {mean_cents('SUM(' + money('k.total_revenue') + ')', 'COUNT(*)')} AS avg_revenue, ROUND(AVG(k.total_orders), 1) AS avg_orders,"
        " ROUND(AVG(k.days_since_last_order), 0) AS avg_recency_days FROM customer_segments s JOIN customer_kpis k"
        " ON s.customer_id = k.customer_id GROUP BY s.segment_label"
    ),
)
R.add(
    "h6_top_anomalies",
    lambda x: h.top_anomalies(events(x), x.t["customer_360"]),
    S(
        "SELECT e.entity_id AS customer_id, c.customer_segment, c.country, ROUND(e.anomaly_score, 4) AS anomaly_score,"
        " ROUND(e.churn_probability, 4) AS churn_probability, c.total_revenue, c.days_since_last_order"
        " FROM anomaly_events e JOIN customer_360 c ON e.entity_id = c.customer_id"
        " ORDER BY e.anomaly_score DESC, e.entity_id LIMIT 20"
    ),
)
R.add(
    "h7_top_demand",
    lambda x: h.top_demand(demand.demand_forecast(x.t, x.as_of), x.t["dim_products"]),
    S(
        "SELECT d.product_id, p.product_name, p.category_name, CAST(p.price AS DOUBLE) AS price, d.predicted_units,"
        " ROUND(d.stability_score * 100, 1) AS stability_score_pct,"
        " CAST(d.predicted_units * p.price AS DOUBLE) AS baseline_revenue_estimate"
        " FROM demand_forecast d JOIN dim_products p ON d.product_id = p.product_id"
        " ORDER BY d.predicted_units DESC, d.product_id LIMIT 20"
    ),
)
R.add(
    "h8_inventory_rollup",
    lambda x: h.inventory_rollup(x.t["inventory_health"]),
    S(
        "SELECT stock_status, COUNT(*) AS product_warehouse_combos, SUM(current_stock) AS total_units,"
        " COUNT(CASE WHEN reorder_flag THEN 1 END) AS reorder_needed FROM inventory_health GROUP BY stock_status"
    ),
)
R.add(
    "h9_rules_with_results",
    lambda x: h.rules_with_results(results(x), q.rules_frame(x.spark)).drop("description"),
    S(
        "SELECT rule_id, rule_type, dataset, field, severity, total_records, failed_records, failure_pct,"
        " threshold AS threshold_pct, status FROM quality_results"
    ),
)
R.add(
    "h10_quality_by_severity",
    lambda x: h.quality_by_severity(q.quality_summary(results(x))),
    S("SELECT * FROM quality_summary"),
)
R.add(
    "h11_evaluation_by_type",
    lambda x: h.evaluation_by_type(a.evaluate(labelled(x), interactions(x))),
    S(
        "SELECT expected_agent AS question_type, COUNT(*) AS questions,"
        " COUNT(CASE WHEN agent = expected_agent THEN 1 END) AS correctly_routed,"
        f" COUNT(CASE WHEN {_SUPPORTED} THEN 1 END) AS supported_responses, CAST(NULL AS DOUBLE) AS avg_latency_ms,"
        f" {pct('COUNT(CASE WHEN agent = expected_agent THEN 1 END)', 'COUNT(*)', 1)} AS routing_accuracy_pct"
        " FROM interactions GROUP BY expected_agent"
    ),
)
R.add(
    "h12_interaction_log",
    lambda x: h.interaction_log(interactions(x)).select("interaction_id", "query", "response_preview", "status"),
    S(
        "SELECT 'INT' || question_id AS interaction_id, text AS query, substring(response, 1, 180) AS response_preview, status"
        " FROM interactions"
    ),
)
_LIVE_TOP = " FROM live_minutes ORDER BY event_minute DESC, revenue DESC, channel LIMIT 50"
R.add(
    "h13_live_sales",
    lambda x: h.live_sales(live_minutes(x)),
    S(
        "SELECT event_minute, channel, order_count, unique_customers, gross_sales, discounts, revenue, avg_order_value,"
        " last_updated" + _LIVE_TOP
    ),
)
R.add(
    "h14_stream_health",
    lambda x: h.stream_health(x.source["streaming_metrics"]),
    S(
        "SELECT stream_name, microbatch_id, input_rows, bronze_rows, silver_rows, processing_ms, event_lag_seconds, status,"
        " batch_finished_at, ROUND(input_rows / GREATEST(CAST(processing_ms AS DOUBLE) / 1000, CAST(0.001 AS DOUBLE)), 2)"
        " AS processing_rows_per_sec FROM src_streaming_metrics ORDER BY batch_finished_at DESC, microbatch_id DESC LIMIT 50"
    ),
)
R.add(
    "h15_managed_live_sales",
    lambda x: h.managed_live_sales(live_minutes(x)),
    S("SELECT event_minute, channel, order_count, unique_customers, revenue, avg_order_value, last_updated" + _LIVE_TOP),
)

# --- validation of the assistant and the stream -----------------------------------------------


def _named(*names):
    return [c for c in v.CHECKS if c.name in names]


R.add(
    "v11_routing_evaluation",
    lambda x: v.check_rows(x.spark, x.t.replacing(evaluation_results=a.evaluate(labelled(x), interactions(x))), x.as_of,
                           _named("agent_routing_eval")),
    S(
        "SELECT 'agent_routing_eval' AS check_name, 'genai' AS category, COUNT(*) AS actual, '0' AS expected FROM routed"
        " WHERE agent <> expected_agent"
    ),
)
R.add(
    "v12_live_rows",
    lambda x: v.check_rows(
        x.spark,
        x.t.replacing(live_sales_minute=live_minutes(x), realtime_order_events=x.source["order_events"]),
        x.as_of,
        _named("realtime_rows", "available_now_realtime_rows", "available_now_successful_microbatches"),
    ),
    S(
        "SELECT 'realtime_rows' AS check_name, 'streaming' AS category, COUNT(*) AS actual, '>0' AS expected FROM live_minutes"
        " UNION ALL SELECT 'available_now_realtime_rows', 'streaming', COUNT(*), '>0' FROM src_order_events"
        " UNION ALL SELECT 'available_now_successful_microbatches', 'streaming', COUNT(*), '>0' FROM src_streaming_metrics"
        " WHERE status = 'SUCCEEDED'"
    ),
)
