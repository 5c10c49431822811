"""Named SELECTs of the comparison engine; a query pulls in only those it mentions."""

from __future__ import annotations

import re

from martloom.sources.retail_views import RETAIL_VIEWS, WAREHOUSES

AS_OF = "(SELECT MAX(CAST(o_orderdate AS DATE)) FROM orders)"


def money(x: str) -> str:
    return f"CAST({x} AS DECIMAL(18,2))"


def half_up(a: str, b: str) -> str:
    """Non-negative integer quotient rounded half up."""
    return f"CASE WHEN {b} > 0 THEN (2 * CAST({a} AS HUGEINT) + {b}) // (2 * {b}) END"


def mean_cents(total: str, n: str) -> str:
    return f"CAST({half_up(f'({total}) * 100', n)} AS DOUBLE) / 100"


def pct(part: str, whole: str, digits: int = 2) -> str:
    scale = 10**digits
    return f"CAST({half_up(f'({part}) * {100 * scale}', whole)} AS DOUBLE) / {scale}"


def mean(total: str, n: str) -> str:
    return f"CAST({total} AS DOUBLE) / NULLIF({n}, 0)"


LINE_TOTAL = "CAST(line_total AS DECIMAL(26,6))"
LINE_DISCOUNT = f"{LINE_TOTAL} * CAST(discount_pct AS DECIMAL(12,10))"
LINE_NET = money(f"{LINE_TOTAL} * (CAST(1 AS DECIMAL(12,10)) - CAST(discount_pct AS DECIMAL(12,10)))")

CTES: dict[str, str] = {
    f"src_{name}": re.sub(r"\{(\w+)\}", r"\1", text.replace("EXPLODE_WAREHOUSES", WAREHOUSES["duckdb"])).strip()
    for name, text in RETAIL_VIEWS.items()
}

CTES["rec_orders"] = f"""
  SELECT o.order_id, o.customer_id, o.store_id, o.order_date, o.status, o.channel,
         COALESCE(i.gross, {money('o.order_total')}) AS order_total,
         COALESCE(i.discount, {money('o.discount_amount')}) AS discount_amount,
         CASE WHEN i.gross IS NULL THEN {money('o.tax_amount')}
              ELSE {money('(i.gross - i.discount) * CAST(0.08 AS DECIMAL(4,2))')} END AS tax_amount, o.currency
  FROM src_orders o LEFT JOIN (
    SELECT order_id, {money(f"SUM({LINE_TOTAL})")} AS gross, {money(f'SUM({LINE_DISCOUNT})')} AS discount
    FROM src_order_items GROUP BY order_id) i ON o.order_id = i.order_id"""
CTES["dim_date"] = f"""
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date, CAST(year(d) AS INTEGER) AS year,
         CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, strftime(d, '%B') AS month_name,
         CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(dayofmonth(d) AS INTEGER) AS day_of_month,
         CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, strftime(d, '%A') AS day_name,
         dayofweek(d) IN (0, 6) AS is_weekend,
         CASE WHEN month(d) IN (12, 1, 2) THEN 'Winter' WHEN month(d) IN (3, 4, 5) THEN 'Spring'
              WHEN month(d) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END AS season
  FROM (SELECT CAST(UNNEST(generate_series(a - INTERVAL 120 MONTH, a + INTERVAL 730 DAY, INTERVAL 1 DAY)) AS DATE) AS d
        FROM (SELECT {AS_OF} AS a))"""
CTES["dim_customers"] = f"""
  SELECT customer_id, first_name, last_name, first_name || ' ' || last_name AS full_name,
         lower(trim(email)) AS email_normalized, phone, date_of_birth, customer_segment, registration_date, country,
         city, status, loyalty_points, {AS_OF} AS valid_from, DATE '9999-12-31' AS valid_to, true AS is_current
  FROM src_customers"""
CTES["dim_products"] = f"""
  SELECT p.product_id, p.name AS product_name, p.category_id, c.name AS category_name, p.supplier_id,
         {money('p.price')} AS price, {money('p.cost')} AS cost,
         {money('p.price')} - {money('p.cost')} AS gross_margin,
         CAST({half_up(f"({money('p.price')} - {money('p.cost')}) * 1000000",
                       f"CAST({money('p.price')} * 100 AS HUGEINT)")} AS DOUBLE) / 100 AS margin_pct,
         p.sku, p.weight_kg, p.status
  FROM src_products p LEFT JOIN src_categories c ON p.category_id = c.category_id"""
CTES["dim_stores"] = """
  SELECT store_id, name AS store_name, city, state, country, store_type, size_sqft, opened_date, status
  FROM src_stores"""
CTES["dim_suppliers"] = """
  SELECT supplier_id, name AS supplier_name, country, contact_email, rating, lead_time_days, status,
         CASE WHEN rating >= 4.5 THEN 'Tier1' WHEN rating >= 3.5 THEN 'Tier2' ELSE 'Tier3' END AS tier
  FROM src_suppliers"""
CTES["fact_orders"] = f"""
  SELECT o.order_id, o.customer_id, o.store_id, CAST(strftime(o.order_date, '%Y%m%d') AS INTEGER) AS order_date_key,
         o.order_date, o.status AS order_status, o.channel, o.order_total, o.discount_amount, o.tax_amount,
         o.order_total - o.discount_amount AS net_sales_before_refunds,
         COALESCE(r.refund, CAST(0 AS DECIMAL(18,2))) AS approved_refund_amount,
         CASE WHEN o.status = 'Cancelled' THEN CAST(0 AS DECIMAL(18,2))
              ELSE GREATEST({money("o.order_total - o.discount_amount - COALESCE(r.refund, CAST(0 AS DECIMAL(18,2)))")},
                            CAST(0 AS DECIMAL(18,2))) END AS net_revenue,
         o.currency
  FROM rec_orders o LEFT JOIN (
    SELECT order_id, {money("SUM(CASE WHEN status = 'Approved' THEN refund_amount ELSE 0 END)")} AS refund
    FROM src_returns GROUP BY order_id) r ON o.order_id = r.order_id
  WHERE o.customer_id IS NOT NULL AND o.order_total > 0"""
CTES["fact_order_items"] = f"""
  SELECT item_id, order_id, product_id, quantity, unit_price, line_total, discount_pct, {LINE_NET} AS net_line_total
  FROM src_order_items WHERE quantity > 0 AND unit_price > 0"""
CTES["fact_payments"] = """
  SELECT payment_id, order_id, amount, method, status AS payment_status, payment_date, currency, transaction_ref
  FROM src_payments WHERE amount > 0"""
CTES["fact_shipments"] = """
  SELECT shipment_id, order_id, carrier, tracking_number, status AS shipment_status, ship_date, estimated_delivery,
         actual_delivery, weight_kg,
         CASE WHEN actual_delivery IS NULL THEN NULL ELSE actual_delivery <= estimated_delivery END AS delivered_on_time
  FROM src_shipments"""
CTES["fact_returns"] = """
  SELECT r.return_id, r.order_id, r.product_id, r.reason, r.return_date, r.refund_amount, r.status AS return_status,
         CAST(date_diff('day', o.order_date, r.return_date) AS INTEGER) AS days_to_return
  FROM src_returns r LEFT JOIN src_orders o ON r.order_id = o.order_id"""
CTES["fact_inventory_daily_movement"] = """
  SELECT product_id, warehouse_id, event_date AS snapshot_date, SUM(quantity) AS net_quantity,
         SUM(CASE WHEN event_type IN ('receipt', 'return') THEN quantity ELSE 0 END) AS total_received,
         SUM(CASE WHEN event_type = 'sale' THEN ABS(quantity) ELSE 0 END) AS total_sold, COUNT(*) AS event_count
  FROM src_inventory_events GROUP BY product_id, warehouse_id, event_date"""

_LIVE = "order_status <> 'Cancelled'"
_LIVE_SUM = f"SUM(CASE WHEN {_LIVE} THEN net_revenue END)"
_LIVE_N = f"COUNT(CASE WHEN {_LIVE} THEN 1 END)"

CTES["daily_sales_summary"] = f"""
  SELECT order_date, channel, COUNT(DISTINCT order_id) AS order_attempts,
         COUNT(DISTINCT CASE WHEN {_LIVE} THEN order_id END) AS total_orders,
         COUNT(DISTINCT customer_id) AS unique_customers, CAST(SUM(net_revenue) AS DOUBLE) AS total_revenue,
         {mean_cents(_LIVE_SUM, _LIVE_N)} AS avg_order_value,
         CAST(SUM(CASE WHEN {_LIVE} THEN discount_amount ELSE 0 END) AS DOUBLE) AS total_discounts,
         COUNT(CASE WHEN NOT ({_LIVE}) THEN 1 END) AS cancelled_orders
  FROM fact_orders GROUP BY order_date, channel"""
CTES["customer_kpis"] = f"""
  SELECT c.customer_id, c.full_name, c.customer_segment, c.country, c.status, c.registration_date, c.loyalty_points,
         COALESCE(o.n, 0) AS total_orders, COALESCE(o.revenue, 0) AS total_revenue, COALESCE(o.aov, 0) AS avg_order_value,
         COALESCE(o.last_live, c.registration_date) AS last_order_date,
         CAST(date_diff('day', COALESCE(o.last_live, c.registration_date), {AS_OF}) AS INTEGER) AS days_since_last_order,
         CAST(date_diff('day', c.registration_date, {AS_OF}) AS INTEGER) AS tenure_days
  FROM dim_customers c LEFT JOIN (
    SELECT customer_id, COUNT(DISTINCT CASE WHEN {_LIVE} THEN order_id END) AS n,
           CAST(SUM(net_revenue) AS DOUBLE) AS revenue, {mean(_LIVE_SUM, _LIVE_N)} AS aov,
           MAX(CASE WHEN {_LIVE} THEN order_date END) AS last_live
    FROM fact_orders GROUP BY customer_id) o ON c.customer_id = o.customer_id"""
CTES["customer_lifetime_value"] = f"""
  SELECT customer_id, full_name, customer_segment, total_revenue AS historical_revenue, total_orders, avg_order_value,
         tenure_days,
         CASE WHEN tenure_days >= 0
              THEN CAST({half_up(f"{money('total_revenue')} * 100 * 1095", "GREATEST(tenure_days, 30)")} AS DOUBLE) / 100
              ELSE 0 END AS baseline_3yr_clv,
         'historical_run_rate_floor_30d' AS clv_method,
         CASE WHEN total_revenue >= 5000 THEN 'Platinum' WHEN total_revenue >= 2000 THEN 'Gold'
              WHEN total_revenue >= 500 THEN 'Silver' ELSE 'Bronze' END AS clv_tier
  FROM customer_kpis"""
CTES["customer_360"] = """
  SELECT k.customer_id, k.full_name, k.customer_segment, k.country, k.status, k.total_orders, k.total_revenue,
         k.avg_order_value, k.days_since_last_order, k.tenure_days, k.loyalty_points, v.baseline_3yr_clv, v.clv_tier,
         CASE WHEN k.days_since_last_order > 365 THEN 'High' WHEN k.days_since_last_order > 180 THEN 'Medium'
              ELSE 'Low' END AS recency_risk
  FROM customer_kpis k LEFT JOIN customer_lifetime_value v ON k.customer_id = v.customer_id"""
CTES["product_kpis"] = f"""
  SELECT p.product_id, p.product_name, p.category_name, CAST(p.price AS DOUBLE) AS price, p.margin_pct, p.status,
         COALESCE(s.n, 0) AS order_count, COALESCE(s.units, 0) AS total_units_sold,
         CAST(GREATEST(COALESCE(s.net, 0) - COALESCE(f.refund, 0), 0) AS DOUBLE) AS total_revenue,
         CAST(COALESCE(f.refund, 0) AS DOUBLE) AS approved_refunds, v.rating AS avg_review_rating,
         COALESCE(v.n, 0) AS review_count
  FROM dim_products p
  LEFT JOIN (SELECT i.product_id, COUNT(DISTINCT i.order_id) AS n, SUM(i.quantity) AS units, SUM(i.net_line_total) AS net
             FROM fact_order_items i JOIN fact_orders o ON i.order_id = o.order_id
             WHERE o.order_status <> 'Cancelled' GROUP BY i.product_id) s ON p.product_id = s.product_id
  LEFT JOIN (SELECT product_id, SUM(CASE WHEN return_status = 'Approved' THEN refund_amount ELSE 0 END) AS refund
             FROM fact_returns GROUP BY product_id) f ON p.product_id = f.product_id
  LEFT JOIN (SELECT product_id, {mean('SUM(rating)', 'COUNT(rating)')} AS rating, COUNT(*) AS n
             FROM src_product_reviews GROUP BY product_id) v ON p.product_id = v.product_id"""
CTES["store_performance"] = f"""
  SELECT s.store_id, s.store_name, s.city, s.state, s.store_type, COALESCE(o.a, 0) AS order_attempts,
         COALESCE(o.n, 0) AS total_orders, COALESCE(o.u, 0) AS unique_customers, COALESCE(o.r, 0) AS total_revenue,
         COALESCE(o.v, 0) AS avg_order_value
  FROM dim_stores s LEFT JOIN (
    SELECT store_id, COUNT(DISTINCT order_id) AS a, COUNT(DISTINCT CASE WHEN {_LIVE} THEN order_id END) AS n,
           COUNT(DISTINCT CASE WHEN {_LIVE} THEN customer_id END) AS u, CAST(SUM(net_revenue) AS DOUBLE) AS r,
           {mean(_LIVE_SUM, _LIVE_N)} AS v
    FROM fact_orders GROUP BY store_id) o ON s.store_id = o.store_id"""
CTES["supplier_performance"] = """
  SELECT s.supplier_id, s.supplier_name, s.country, s.tier, s.rating, s.lead_time_days,
         COUNT(DISTINCT p.product_id) AS product_count
  FROM dim_suppliers s LEFT JOIN src_products p ON s.supplier_id = p.supplier_id
  GROUP BY s.supplier_id, s.supplier_name, s.country, s.tier, s.rating, s.lead_time_days"""
CTES["inventory_health"] = """
  SELECT i.product_id, p.product_name, p.category_name, i.warehouse_id, SUM(i.net_quantity) AS current_stock,
         SUM(i.total_sold) AS total_sold,
         CASE WHEN SUM(i.net_quantity) <= 0 THEN 'Out of Stock' WHEN SUM(i.net_quantity) <= 10 THEN 'Critical'
              WHEN SUM(i.net_quantity) <= 50 THEN 'Low' WHEN SUM(i.net_quantity) <= 200 THEN 'Normal'
              ELSE 'Overstocked' END AS stock_status,
         SUM(i.net_quantity) <= 10 AS reorder_flag
  FROM fact_inventory_daily_movement i LEFT JOIN dim_products p ON i.product_id = p.product_id
  GROUP BY i.product_id, p.product_name, p.category_name, i.warehouse_id"""
CTES["support_operations"] = f"""
  SELECT category, priority, status AS ticket_status, COUNT(*) AS ticket_count,
         {mean_cents('SUM(satisfaction_score)', 'COUNT(satisfaction_score)')} AS avg_satisfaction,
         COUNT(resolved_date) AS resolved_count, {pct('COUNT(resolved_date)', 'COUNT(*)')} AS resolution_rate_pct
  FROM src_support_tickets GROUP BY category, priority, status"""
CTES["executive_kpi"] = f"""
  SELECT {AS_OF} AS report_date, (SELECT COUNT(*) FROM dim_customers) AS total_customers,
         (SELECT COUNT(*) FROM dim_customers WHERE status = 'Active') AS active_customers,
         COUNT(*) AS order_attempts, {_LIVE_N} AS total_orders, CAST(SUM(net_revenue) AS DOUBLE) AS total_revenue,
         {mean_cents(_LIVE_SUM, _LIVE_N)} AS avg_order_value, (SELECT COUNT(*) FROM src_returns) AS total_returns,
         (SELECT COUNT(*) FROM src_products WHERE status = 'Active') AS active_products,
         (SELECT COUNT(*) FROM src_support_tickets WHERE status = 'open') AS open_tickets
  FROM fact_orders"""
CTES["knowledge_index"] = f"""
  SELECT doc_id AS document_id, title, doc_type AS document_type, topic, content, effective_date, version, status,
         {AS_OF} AS indexed_at
  FROM src_knowledge_documents WHERE status = 'Active'"""
CTES["document_chunks"] = """
  SELECT CAST(document_id AS VARCHAR) || '_001' AS chunk_id, document_id, title, document_type, topic,
         content AS chunk_text, CAST(len(string_split(content, ' ')) AS INTEGER) AS word_count, indexed_at
  FROM knowledge_index"""


def sql(body: str, **extra: str) -> str:
    """`body` with a WITH clause for every named SELECT it needs, in dependency order."""
    known = {**CTES, **extra}
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in dict.fromkeys(re.findall(r"\b[a-z_0-9]+\b", text)):
            if name in known and name not in ordered and known[name] is not text:
                visit(known[name])
                if name not in ordered:
                    ordered.append(name)

    visit(body)
    if not ordered:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({known[n]})" for n in ordered) + "\n" + body


def doubles(table: str, *columns: str) -> str:
    """SELECT * with money columns as DOUBLE."""
    casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)
    return sql(f"SELECT * REPLACE ({casts}) FROM {table}")
