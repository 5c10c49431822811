"""The 36 rules and the tables made from their results (QR001-QR036, D1-D11)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from martloom.plans import quality as q
from martloom.plans.quality_rules import RULES
from verification.common import Registry
from verification.ctes import AS_OF, LINE_DISCOUNT, LINE_TOTAL, money, pct, sql

R = Registry()
RUN, AT = "run0", dt.datetime(2001, 8, 1)
TAX = money("(order_total - discount_amount) * CAST(0.08 AS DECIMAL(4,2))")
_O = "(SELECT * REPLACE (" + ", ".join(
    f"CAST({c} AS DECIMAL(18,6)) AS {c}" for c in ("order_total", "discount_amount", "tax_amount")
) + ") FROM src_orders)"
_LINES = (
    f"(SELECT order_id, {money(f'SUM({LINE_TOTAL})')} AS gross, {money(f'SUM({LINE_DISCOUNT})')} AS disc"
    " FROM src_order_items GROUP BY order_id)"
)


def _where(table: str, cond: str) -> str:
    return f"SELECT COUNT(*) FROM src_{table} WHERE {cond}"


def _dup(table: str, key: str) -> str:
    return f"SELECT COUNT(*) - COUNT(DISTINCT {key}) FROM src_{table}"


def _not_in(table: str, key: str, ref: str) -> str:
    return f"SELECT COUNT(*) FROM src_{table} WHERE {key} NOT IN (SELECT {key} FROM src_{ref})"


COUNTS = {
    "QR001": _dup("customers", "customer_id"),
    "QR002": _where("customers", "email IS NULL OR trim(email) = ''"),
    "QR003": _where("customers", "email NOT LIKE '%@%.%'"),
    "QR004": _where("customers", f"registration_date > {AS_OF}"),
    "QR005": _not_in("orders", "customer_id", "customers"),
    "QR006": _where("orders", "order_total <= 0"),
    "QR007": _where("orders", f"order_date > {AS_OF}"),
    "QR008": _where("order_items", "quantity <= 0"),
    "QR009": _where("order_items", "unit_price <= 0"),
    "QR010": _where("payments", "amount <= 0"),
    "QR011": _not_in("payments", "order_id", "orders"),
    "QR012": _dup("products", "product_id"),
    "QR013": _where("products", "price <= 0"),
    "QR014": _where("inventory_events", "quantity = 0"),
    "QR015": _not_in("shipments", "order_id", "orders"),
    "QR016": _where("clickstream_events", "session_id IS NULL OR trim(session_id) = ''"),
    "QR017": _not_in("support_tickets", "customer_id", "customers"),
    "QR018": _not_in("returns", "order_id", "orders"),
    "QR019": _where("customers", "customer_segment NOT IN ('Basic','Standard','Premium','VIP')"),
    "QR020": _where("orders", "status NOT IN ('Processing','Shipped','Completed','Cancelled','Returned')"),
    "QR021": _not_in("products", "category_id", "categories"),
    "QR022": _where("shipments", "status NOT IN ('Processing','In Transit','Delivered','Failed')"),
    "QR023": _where("payments", "status NOT IN ('Completed','Failed','Refunded')"),
    "QR024": _where("customers", "length(country) <> 2"),
    "QR025": f"SELECT COUNT(*) FROM {_O} o JOIN {_LINES} i ON o.order_id = i.order_id WHERE abs(o.order_total - i.gross) > 0.01",
    "QR026": f"SELECT COUNT(*) FROM {_O} o JOIN {_LINES} i ON o.order_id = i.order_id WHERE abs(o.discount_amount - i.disc) > 0.01",
    "QR027": f"SELECT COUNT(*) FROM {_O} o WHERE abs(tax_amount - {TAX}) > 0.01",
    "QR028": "SELECT COUNT(*) FROM src_returns r WHERE NOT EXISTS (SELECT 1 FROM src_order_items i"
    " WHERE i.order_id = r.order_id AND i.product_id = r.product_id)",
    "QR029": "SELECT COUNT(*) FROM src_shipments s JOIN src_orders o ON s.order_id = o.order_id WHERE o.status = 'Cancelled'",
    "QR030": "SELECT COUNT(*) FROM src_product_reviews r WHERE r.verified_purchase AND NOT EXISTS (SELECT 1 FROM src_orders o"
    " JOIN src_order_items i ON o.order_id = i.order_id WHERE o.customer_id = r.customer_id"
    " AND i.product_id = r.product_id AND o.status IN ('Completed','Returned'))",
    "QR031": "SELECT COUNT(*) FROM src_orders o WHERE o.status = 'Returned' AND NOT EXISTS (SELECT 1 FROM src_returns r"
    " WHERE r.order_id = o.order_id AND r.status = 'Approved')",
    "QR032": "SELECT COUNT(*) FROM src_orders o WHERE o.status <> 'Cancelled' AND NOT EXISTS (SELECT 1 FROM src_payments p"
    " WHERE p.order_id = o.order_id AND p.status = 'Completed')",
    "QR033": "SELECT COUNT(*) FROM src_orders o WHERE o.status = 'Cancelled' AND EXISTS (SELECT 1 FROM src_payments p"
    " WHERE p.order_id = o.order_id AND p.status = 'Completed')",
    "QR034": "SELECT COUNT(*) FROM (SELECT SUM(quantity) AS s FROM src_inventory_events GROUP BY product_id, warehouse_id)"
    " WHERE s < 0",
    "QR035": _where("shipments", f"actual_delivery IS NOT NULL AND (actual_delivery < ship_date OR actual_delivery > {AS_OF})"),
    "QR036": "SELECT COUNT(*) FROM src_returns r JOIN src_orders o ON r.order_id = o.order_id"
    f" WHERE r.return_date <= o.order_date OR r.return_date > {AS_OF}",
}

for rule in RULES:
    R.add(
        rule.rule_id.lower(),
        lambda x, rule=rule: q.violation_counts(x.spark, x.source, [rule], x.as_of),
        sql(f"SELECT '{rule.rule_id}' AS rule_id, ({COUNTS[rule.rule_id]}) AS failed_records"),
    )

_ALL = " UNION ALL ".join(f"SELECT '{k}' AS rule_id, ({v}) AS failed_records" for k, v in COUNTS.items())
_TOTALS = " UNION ALL ".join(
    f"SELECT '{d}' AS dataset, COUNT(*) AS total_records FROM src_{d}" for d in dict.fromkeys(r.dataset for r in RULES)
)
_META = "SELECT * FROM (VALUES " + ", ".join(
    f"('{r.rule_id}', '{r.dataset}', '{r.field}', '{r.rule_type}', '{r.severity}', CAST({r.threshold} AS DOUBLE))" for r in RULES
) + ") AS v(rule_id, dataset, field, rule_type, severity, threshold)"
_PASSED = "COUNT(CASE WHEN status = 'PASS' THEN 1 END)"
EXTRA = {
    "rule_counts": _ALL,
    "dataset_totals": _TOTALS,
    "rule_meta": _META,
    "quality_results": "SELECT *, CASE WHEN failure_pct <= threshold THEN 'PASS' ELSE 'FAIL' END AS status FROM ("
    "SELECT m.rule_id, m.dataset, m.field, m.severity, m.rule_type, t.total_records,"
    " GREATEST(t.total_records - c.failed_records, 0) AS passed_records, c.failed_records,"
    f" COALESCE({pct('c.failed_records', 't.total_records', 4)}, 0) AS failure_pct, m.threshold"
    " FROM rule_meta m JOIN rule_counts c ON m.rule_id = c.rule_id JOIN dataset_totals t ON m.dataset = t.dataset)",
    "quality_summary": "SELECT severity, COUNT(*) AS rule_count, COUNT(CASE WHEN status = 'PASS' THEN 1 END) AS passed,"
    " COUNT(CASE WHEN status = 'FAIL' THEN 1 END) AS failed, COUNT(CASE WHEN status = 'ERROR' THEN 1 END) AS errors,"
    f" {pct(_PASSED, 'COUNT(*)', 1)} AS pass_rate_pct"
    " FROM quality_results GROUP BY severity",
}


def results(x):
    return q.run_rules(x.spark, x.source, x.as_of, RUN, AT)[0]


RESULT_COLUMNS = (
    "rule_id", "dataset", "field", "severity", "rule_type", "total_records", "passed_records", "failed_records",
    "failure_pct", "threshold", "status",
)

R.add(
    "d1_rules_by_dataset",
    lambda x: q.rules_frame(x.spark).join(q.dataset_counts(x.spark, x.source, RULES), "dataset").select(
        "rule_id", "dataset", "field", "rule_type", "severity", "threshold", "total_records"
    ),
    sql(
        "SELECT m.rule_id, m.dataset, m.field, m.rule_type, m.severity, m.threshold, t.total_records"
        " FROM rule_meta m JOIN dataset_totals t ON m.dataset = t.dataset", **EXTRA,
    ),
)
R.add(
    "d2_rule_counts",
    lambda x: q.violation_counts(x.spark, x.source, RULES, x.as_of),
    sql("SELECT * FROM rule_counts", **EXTRA),
)
R.add(
    "d3_dataset_counts",
    lambda x: q.dataset_counts(x.spark, x.source, RULES),
    sql("SELECT * FROM dataset_totals", **EXTRA),
)
R.add(
    "d4_small_datasets",
    lambda x: q.small_datasets(q.dataset_counts(x.spark, x.source, RULES), 2000),
    sql("SELECT * FROM dataset_totals WHERE total_records < 2000", **EXTRA),
)
R.add(
    "d5_quality_results",
    lambda x: results(x).select(*RESULT_COLUMNS),
    sql("SELECT * FROM quality_results", **EXTRA),
)
R.add(
    "d6_failure_samples",
    lambda x: q.failure_samples(x.spark, x.source, results(x), x.as_of, AT).groupBy("rule_id", "dataset", "field").agg(
        F.count(F.lit(1)).alias("samples")
    ),
    sql(
        # negative stock is counted in groups and has no rows of its own table
        "SELECT rule_id, dataset, field, LEAST(failed_records, 10) AS samples FROM quality_results"
        " WHERE status = 'FAIL' AND failed_records > 0", **EXTRA,
    ),
)
R.add(
    "d7_blocking_rules",
    lambda x: q.blocking(results(x)).select("rule_id", "severity", "status", "failed_records"),
    sql(
        "SELECT rule_id, severity, status, failed_records FROM quality_results"
        " WHERE severity IN ('critical', 'error') AND status IN ('FAIL', 'ERROR')", **EXTRA,
    ),
)


def latest_and_history(x):
    from martloom.session import scratch_path
    from martloom.sources.run_table import RunTable

    table = RunTable(x.spark, scratch_path(x.spark, "runs"))
    for run_id in ("r1", "r2", "r2"):  # a run that is repeated counts once
        table.commit(lambda: results(x), run_id)
    rows = table.history().groupBy("rule_id").agg(F.count(F.lit(1)).alias("runs"))
    return table.latest().select("rule_id", "status").join(rows, "rule_id")


R.add(
    "d8_latest_and_history",
    latest_and_history,
    sql("SELECT rule_id, status, CAST(2 AS BIGINT) AS runs FROM quality_results", **EXTRA),
)
R.add("d9_quality_summary", lambda x: q.quality_summary(results(x)), sql("SELECT * FROM quality_summary", **EXTRA))
R.add(
    "d10_data_quality_kpi",
    lambda x: q.data_quality_kpi(q.quality_summary(results(x)), x.as_of),
    sql(
        f"SELECT {AS_OF} AS report_date, CAST(SUM(rule_count) AS BIGINT) AS total_rules,"
        " CAST(SUM(passed) AS BIGINT) AS total_passed, CAST(SUM(failed) AS BIGINT) AS total_failed,"
        " CAST(SUM(errors) AS BIGINT) AS total_errors,"
        f" {pct('SUM(passed)', 'SUM(rule_count)', 1)} AS overall_pass_rate_pct FROM quality_summary", **EXTRA,
    ),
)
R.add(
    "d11_run_status",
    lambda x: q.run_status(results(x)),
    sql(
        "SELECT CASE WHEN COUNT(CASE WHEN status = 'ERROR' THEN 1 END) > 0 THEN 'FAILED' ELSE 'SUCCEEDED' END AS status,"
        " COUNT(*) AS rows_written FROM quality_results", **EXTRA,
    ),
)
