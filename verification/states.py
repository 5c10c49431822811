"""Order state operators, demand, anomalies, validation (G23-G31, M12-M14, V1-V15)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from martloom.plans import anomalies, demand, order_states as s, quality, validation as v
from verification.common import Registry
from verification.ctes import AS_OF, LINE_NET, money, pct, sql
from verification.quality import COUNTS

R = Registry()
PAYABLE = "order_total - discount_amount + tax_amount"
_PAIRS = f"SELECT order_id, product_id, SUM({LINE_NET}) AS net_value FROM src_order_items GROUP BY order_id, product_id"

R.add(
    "g23_order_payables",
    lambda x: s.order_payables(x.t),
    sql(f"SELECT order_id, CAST({PAYABLE} AS DOUBLE) AS payable FROM rec_orders"),
)
R.add(
    "g24_product_net_per_order",
    lambda x: s.product_net_per_order(x.t),
    sql(f"SELECT order_id, product_id, CAST(net_value AS DOUBLE) AS net_value FROM ({_PAIRS})"),
)
R.add(
    "g25_status_by_age",
    lambda x: s.status_by_age(x.t, x.as_of),
    sql(
        "SELECT order_id, status, age_days,"
        " CASE WHEN age_days <= 0 THEN 'up to 0' WHEN age_days <= 2 THEN 'up to 2' WHEN age_days <= 7 THEN 'up to 7'"
        " ELSE 'older' END AS age_band,"
        " CASE WHEN age_days <= 0 THEN status IN ('Processing', 'Cancelled')"
        " WHEN age_days <= 2 THEN status IN ('Processing', 'Shipped', 'Cancelled')"
        " WHEN age_days <= 7 THEN status IN ('Shipped', 'Completed', 'Cancelled')"
        " ELSE status IN ('Completed', 'Returned', 'Cancelled') END AS state_allowed"
        f" FROM (SELECT order_id, status, CAST(date_diff('day', order_date, {AS_OF}) AS INTEGER) AS age_days FROM src_orders)"
    ),
)
R.add(
    "g26_payment_states",
    lambda x: s.payment_states(x.t, x.as_of, (F.col("order_id") % 3).cast("int")),
    sql(
        f"SELECT order_id, 'primary' AS kind, CAST(GREATEST({PAYABLE}, 0.01) AS DOUBLE) AS amount,"
        " CASE WHEN status = 'Cancelled' THEN 'Refunded' ELSE 'Completed' END AS payment_status,"
        f" LEAST({AS_OF}, order_date + CAST(order_id % 3 AS INTEGER)) AS payment_date FROM rec_orders UNION ALL"
        f" SELECT p.order_id, 'attempt', CAST(GREATEST({PAYABLE}, 0.01) AS DOUBLE), 'Failed',"
        f" LEAST({AS_OF}, o.order_date + CAST(p.order_id % 3 AS INTEGER))"
        " FROM src_payments p JOIN rec_orders o ON p.order_id = o.order_id WHERE p.status = 'Failed'"
    ),
)
R.add(
    "g27_shipment_states",
    lambda x: s.shipment_states(x.t, x.as_of),
    sql(
        "SELECT shipment_id, order_id, order_status, ship_date, state,"
        " CASE WHEN state = 'Delivered' THEN d END AS actual_delivery FROM ("
        f" SELECT s.shipment_id, s.order_id, o.status AS order_status, LEAST({AS_OF}, s.ship_date) AS ship_date,"
        " CASE WHEN o.status = 'Processing' THEN 'Processing' WHEN o.status = 'Shipped' AND"
        f" (s.actual_delivery IS NULL OR s.estimated_delivery > {AS_OF}) THEN 'In Transit' ELSE 'Delivered' END AS state,"
        f" LEAST({AS_OF}, GREATEST(LEAST({AS_OF}, s.ship_date), COALESCE(s.actual_delivery, s.estimated_delivery))) AS d"
        " FROM src_shipments s JOIN src_orders o ON s.order_id = o.order_id WHERE o.status <> 'Cancelled')"
    ),
)
_ELIGIBLE = (
    "SELECT DISTINCT i.order_id, i.product_id, o.status FROM src_order_items i JOIN src_orders o ON i.order_id = o.order_id"
    f" WHERE o.status IN ('Completed', 'Returned') AND o.order_date < {AS_OF}"
)
R.add(
    "g28_select_returns",
    lambda x: s.select_returns(x.t, x.as_of, x.source["orders"].count() // 6, every_returned=False),
    sql(
        "SELECT order_id, product_id, true AS forced FROM forced_pairs UNION ALL"
        " SELECT order_id, product_id, false FROM (SELECT e.order_id, e.product_id, row_number() OVER (ORDER BY"
        " md5(CAST(e.order_id AS VARCHAR) || '-' || CAST(e.product_id AS VARCHAR)), e.order_id, e.product_id) AS n"
        " FROM eligible_pairs e WHERE NOT EXISTS (SELECT 1 FROM forced_pairs f WHERE f.order_id = e.order_id"
        " AND f.product_id = e.product_id))"
        " WHERE n <= (SELECT COUNT(*) FROM orders) // 6 - (SELECT COUNT(*) FROM forced_pairs)",
        eligible_pairs=_ELIGIBLE,
        forced_pairs="SELECT order_id, MIN(product_id) AS product_id FROM eligible_pairs WHERE status = 'Returned'"
        " GROUP BY order_id",
    ),
)
_AGE = f"CAST(date_diff('day', o.order_date, {AS_OF}) AS INTEGER)"
R.add(
    "g29_capped_refunds",
    lambda x: s.capped_refunds(x.t, x.as_of),
    sql(
        "SELECT return_id, order_id, product_id, CAST(net AS DOUBLE) AS purchased_net,"
        " CAST(LEAST(asked, net) AS DOUBLE) AS refund_amount, asked > net AS was_capped, last_day AS last_return_day,"
        " GREATEST(first_day, LEAST(return_date, last_day)) AS return_date FROM ("
        f" SELECT r.return_id, r.order_id, r.product_id, GREATEST({money('b.net_value')}, 0.01) AS net,"
        f" {money('r.refund_amount')} AS asked, r.return_date, o.order_date + 1 AS first_day,"
        f" o.order_date + LEAST(60, {_AGE}) AS last_day"
        " FROM src_returns r JOIN bought b ON r.order_id = b.order_id AND r.product_id = b.product_id"
        " JOIN src_orders o ON r.order_id = o.order_id)",
        bought=_PAIRS,
    ),
)
R.add(
    "g30_running_stock",
    lambda x: s.running_stock(x.t),
    sql(
        "SELECT *, running_stock < 0 AS below_zero FROM (SELECT event_id, product_id, warehouse_id, event_type, quantity,"
        " event_date, SUM(quantity) OVER (PARTITION BY product_id, warehouse_id ORDER BY event_date, event_id, quantity"
        " ROWS UNBOUNDED PRECEDING) AS running_stock FROM src_inventory_events)"
    ),
)
R.add(
    "g31_verified_purchases",
    lambda x: s.verified_purchases(x.t),
    sql(
        "SELECT r.review_id, r.customer_id, r.product_id, p.first_bought IS NOT NULL AS purchase_found,"
        " COALESCE(r.review_date >= p.first_bought + 1, false) AS after_purchase"
        " FROM src_product_reviews r LEFT JOIN (SELECT o.customer_id, i.product_id, MIN(o.order_date) AS first_bought"
        " FROM src_orders o JOIN src_order_items i ON o.order_id = i.order_id"
        " WHERE o.status IN ('Completed', 'Returned') GROUP BY o.customer_id, i.product_id) p"
        " ON r.customer_id = p.customer_id AND r.product_id = p.product_id WHERE r.verified_purchase"
    ),
)

DEMAND = f"""
  SELECT p.product_id, 'next_30d_baseline' AS forecast_period,
         CAST(ROUND(COALESCE(s.units, 0) / 90.0 * 30, 0) AS BIGINT) AS predicted_units,
         CASE WHEN COALESCE(s.active, 0) = 0 THEN 0.0 ELSE ROUND(LEAST(CAST(0.95 AS DOUBLE), CAST(s.active AS DOUBLE) / 90
              * (1 / (1 + s.std / (s.mean + CAST(1 AS DOUBLE))))), 3) END AS stability_score,
         '90d_calendar_daily_average_baseline' AS forecast_method, {AS_OF} AS generated_at
  FROM dim_products p LEFT JOIN (
    SELECT product_id, SUM(u) AS units, AVG(u) AS mean, STDDEV_POP(u) AS std, COUNT(*) AS active FROM (
      SELECT i.product_id, o.order_date, SUM(i.quantity) AS u
      FROM fact_order_items i JOIN fact_orders o ON i.order_id = o.order_id
      WHERE o.order_date >= {AS_OF} - 89 AND o.order_status <> 'Cancelled' GROUP BY i.product_id, o.order_date)
    GROUP BY product_id) s ON p.product_id = s.product_id"""
EVENTS = f"""
  SELECT 'ANM' || CAST(n AS VARCHAR) AS event_id, customer_id AS entity_id, 'customer' AS entity_type,
         'customer_behavior' AS anomaly_type,
         CASE WHEN score >= p90 THEN 'critical' WHEN score >= p70 THEN 'high' ELSE 'medium' END AS severity,
         score AS anomaly_score, churn_probability, {AS_OF} AS detected_at
  FROM (SELECT customer_id, anomaly_score_raw AS score, churn_probability,
               row_number() OVER (ORDER BY anomaly_score_raw DESC, customer_id) AS n,
               quantile_cont(anomaly_score_raw, 0.9) OVER () AS p90, quantile_cont(anomaly_score_raw, 0.7) OVER () AS p70
        FROM src_customer_scores WHERE is_anomaly = 1) WHERE n <= 500"""
ML = {"demand_forecast": DEMAND, "anomaly_events": EVENTS}

R.add("m12_demand_forecast", lambda x: demand.demand_forecast(x.t, x.as_of), sql("SELECT * FROM demand_forecast", **ML))
R.add(
    "m13_anomaly_summary",
    lambda x: anomalies.anomaly_summary(x.source["customer_scores"]),
    sql(
        "SELECT is_anomaly, COUNT(*) AS count, ROUND(AVG(churn_probability), 4) AS avg_churn FROM src_customer_scores"
        " GROUP BY is_anomaly"
    ),
)
R.add(
    "m13_anomaly_kpi",
    lambda x: anomalies.anomaly_kpi(x.source["customer_scores"], x.as_of),
    sql(
        f"SELECT {AS_OF} AS report_date, COUNT(*) AS total_scored, CAST(SUM(is_anomaly) AS BIGINT) AS anomaly_count,"
        f" {pct('SUM(is_anomaly)', 'COUNT(*)')} AS anomaly_rate_pct, ROUND(AVG(churn_probability), 4) AS avg_churn_risk"
        " FROM src_customer_scores"
    ),
)
R.add(
    "m14_anomaly_events",
    lambda x: anomalies.anomaly_events(x.source["customer_scores"], x.as_of),
    sql("SELECT * FROM anomaly_events", **ML),
)

# --- validation -------------------------------------------------------------------------------

AT = dt.datetime(2001, 8, 1)
_ANTI = "SELECT COUNT(*) FROM {l} l WHERE NOT EXISTS (SELECT 1 FROM {r} r WHERE {on})"
ACTUAL = {
    "orders_customer_fk": _ANTI.format(l="src_orders", r="src_customers", on="r.customer_id = l.customer_id"),
    "items_order_fk": _ANTI.format(l="src_order_items", r="src_orders", on="r.order_id = l.order_id"),
    "returns_product_order_fk": COUNTS["QR028"],
    "cancelled_shipments": COUNTS["QR029"],
    "future_orders": COUNTS["QR007"],
    "order_gross_reconciliation": COUNTS["QR025"],
    "returned_orders_have_approved_return": COUNTS["QR031"],
    "noncancelled_orders_have_completed_payment": COUNTS["QR032"],
    "cancelled_orders_have_no_completed_payment": COUNTS["QR033"],
    "negative_inventory_stock": COUNTS["QR034"],
    "shipment_delivery_temporal": COUNTS["QR035"],
    "return_date_temporal": COUNTS["QR036"],
    "bronze_silver_order_reconciliation": _ANTI.format(l="src_orders", r="fact_orders", on="r.order_id = l.order_id"),
    "silver_gold_customer_reconciliation": _ANTI.format(
        l="dim_customers", r="customer_360", on="r.customer_id = l.customer_id"
    ),
    "null_churn_predictions": "SELECT COUNT(*) FROM src_customer_scores WHERE churn_probability IS NULL",
    "forecast_negative_units": "SELECT COUNT(*) FROM demand_forecast WHERE predicted_units < 0",
    "ml_customer_coverage": "SELECT COUNT(*) FROM src_customer_scores",
}
GROUPS = {
    "v2_foreign_keys": ("orders_customer_fk", "items_order_fk", "returns_product_order_fk"),
    "v3_order_states": ("cancelled_shipments", "future_orders"),
    "v4_gross_reconciliation": ("order_gross_reconciliation",),
    "v5_returns_and_payments": (
        "returned_orders_have_approved_return", "noncancelled_orders_have_completed_payment",
        "cancelled_orders_have_no_completed_payment",
    ),
    "v6_stock_and_dates": ("negative_inventory_stock", "shipment_delivery_temporal", "return_date_temporal"),
    "v8_no_row_lost": ("bronze_silver_order_reconciliation", "silver_gold_customer_reconciliation"),
    "v9_model_outputs": ("null_churn_predictions", "forecast_negative_units"),
    "v10_every_customer_scored": ("ml_customer_coverage",),
}


def validated(x):
    """Unreconciled order headers, so that the reconciliation check has something to find."""
    return x.t.replacing(
        orders=x.source["orders"], churn_predictions=x.source["customer_scores"],
        demand_forecast=demand.demand_forecast(x.t, x.as_of),
    )


def _checks(names):
    return [c for c in v.CHECKS if c.name in names]


def _check_sql(names) -> str:
    expected = {"ml_customer_coverage": "CAST((SELECT COUNT(*) FROM dim_customers) AS VARCHAR)"}
    parts = [
        f"SELECT '{c.name}' AS check_name, '{c.category}' AS category, ({ACTUAL[c.name]}) AS actual,"
        f" {expected.get(c.name, repr(c.expected))} AS expected"
        for c in _checks(names)
    ]
    return sql(" UNION ALL ".join(parts), **ML)


for group, names in GROUPS.items():
    R.add(
        group,
        lambda x, names=names: v.check_rows(x.spark, validated(x), x.as_of, _checks(names)),
        _check_sql(names),
    )


def object_rows(x):
    t = x.t.replacing(churn_predictions=x.source["customer_scores"])
    return v.object_checks(x.spark, t, "run0", AT).select("check_name", "category", "status")


_PRESENT = {"customers", "orders", "order_items", "fact_orders", "customer_360", "product_kpis", "churn_predictions",
            "document_chunks"}
R.add(
    "v1_required_tables",
    lambda x: object_rows(x).where(F.col("category") == "objects"),
    sql(
        # a table that can be read has a row count; the two result tables have not been made in this run
        " UNION ALL ".join(
            f"SELECT 'object:{n}' AS check_name, 'objects' AS category, '{'PASS' if n in _PRESENT else 'FAIL'}' AS status"
            for n in v.REQUIRED
        )
    ),
)
R.add(
    "v13_optional_tables",
    lambda x: object_rows(x).where(F.col("category") == "managed"),
    sql(" UNION ALL ".join(f"SELECT 'managed:{n}' AS check_name, 'managed' AS category, 'SKIP' AS status" for n in v.OPTIONAL)),
)
_MAIN = tuple(c.name for c in v.CHECKS if c.name in ACTUAL)


def _run(x):
    return v.run_checks(x.spark, validated(x), x.as_of, "run0", AT, _checks(_MAIN))


_MAIN_SQL = _check_sql(_MAIN)
R.add(
    "v14_validation_results",
    lambda x: _run(x).select("check_name", "category", "status", "actual_value", "expected_value"),
    "SELECT check_name, category, CASE WHEN CAST(actual AS VARCHAR) = expected THEN 'PASS' ELSE 'FAIL' END AS status,"
    f" CAST(actual AS VARCHAR) AS actual_value, expected AS expected_value FROM ({_MAIN_SQL})",
)
R.add(
    "v15_blocking_checks",
    lambda x: _run(x).where((F.col("status") == "FAIL") & F.col("category").isin(*v.BLOCKING)).select("check_name", "category"),
    "SELECT check_name, category FROM"
    f" ({_MAIN_SQL}) WHERE CAST(actual AS VARCHAR) <> expected AND category IN ('core', 'objects')",
)
R.add(
    "v7_rule_errors",
    lambda x: v.check_rows(
        x.spark, x.t.replacing(quality_results=quality.run_rules(x.spark, x.source, x.as_of, "run0", AT)[0]), x.as_of,
        _checks(("dq_rule_errors",)),
    ),
    "SELECT 'dq_rule_errors' AS check_name, 'core' AS category, CAST(0 AS BIGINT) AS actual, '0' AS expected",
)
