"""The derived tables (G1-G24, G32-G33)."""

from __future__ import annotations

from verification.common import Registry
from verification.ctes import doubles, sql

R = Registry()

ORDER_MONEY = ("order_total", "discount_amount", "tax_amount")


def _table(name):
    return lambda x: x.t[name]


R.add("g1_dim_date", _table("dim_date"), sql("SELECT * FROM dim_date"))
R.add("g2_dim_customers", _table("dim_customers"), sql("SELECT * FROM dim_customers"))
R.add("g3_dim_products", _table("dim_products"), doubles("dim_products", "price", "cost", "gross_margin"))
R.add("g4_dim_stores", _table("dim_stores"), sql("SELECT * FROM dim_stores"))
R.add("g5_dim_suppliers", _table("dim_suppliers"), sql("SELECT * FROM dim_suppliers"))
R.add(
    "g6_fact_orders",
    _table("fact_orders"),
    doubles("fact_orders", *ORDER_MONEY, "net_sales_before_refunds", "approved_refund_amount", "net_revenue"),
)
R.add("g7_fact_order_items", _table("fact_order_items"), doubles("fact_order_items", "net_line_total"))
R.add("g8_fact_payments", _table("fact_payments"), sql("SELECT * FROM fact_payments"))
R.add("g9_fact_shipments", _table("fact_shipments"), sql("SELECT * FROM fact_shipments"))
R.add("g10_fact_returns", _table("fact_returns"), doubles("fact_returns", "refund_amount"))
R.add(
    "g11_fact_inventory_daily_movement",
    _table("fact_inventory_daily_movement"),
    sql("SELECT * FROM fact_inventory_daily_movement"),
)
for number, name in [
    (12, "daily_sales_summary"), (13, "customer_kpis"), (14, "customer_lifetime_value"), (15, "customer_360"),
    (16, "product_kpis"), (17, "store_performance"), (18, "supplier_performance"), (19, "inventory_health"),
    (20, "support_operations"), (21, "executive_kpi"),
]:
    R.add(f"g{number}_{name}", _table(name), sql(f"SELECT * FROM {name}"))
R.add("g22_reconciled_orders", lambda x: x.t["orders"], doubles("rec_orders", *ORDER_MONEY))
R.add("g32_knowledge_index", _table("knowledge_index"), sql("SELECT * FROM knowledge_index"))
R.add("g33_document_chunks", _table("document_chunks"), sql("SELECT * FROM document_chunks"))
