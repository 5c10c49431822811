"""All derived tables of the retail model as one lazy set."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame

from martloom.plans import gold, knowledge, silver
from martloom.sources.tables import TableSet

SILVER = (
    "dim_date", "dim_customers", "dim_products", "dim_stores", "dim_suppliers", "fact_orders", "fact_order_items",
    "fact_payments", "fact_shipments", "fact_returns", "fact_inventory_daily_movement",
)
GOLD = (
    "daily_sales_summary", "customer_kpis", "customer_lifetime_value", "customer_360", "product_kpis",
    "store_performance", "supplier_performance", "inventory_health", "support_operations", "executive_kpi",
)
GENAI = ("knowledge_index", "document_chunks")


def lakehouse(
    spark, source: Mapping[str, DataFrame], as_of: dt.date, written: Mapping[str, DataFrame] | None = None
) -> TableSet:
    """Source, silver and gold tables by name.

    Order headers are reconciled to their lines on the way in. Tables given as
    `written` are read instead of being computed again.
    """
    holder: dict[str, TableSet] = {}

    def t() -> TableSet:
        return holder["t"]

    builders = {name: (lambda name=name: source[name]) for name in source}
    if "orders" in source:
        builders["orders"] = lambda: silver.reconciled_orders(source)
    for name in SILVER:
        build = getattr(silver, name)
        if name == "dim_date":
            builders[name] = lambda: silver.dim_date(spark, as_of)
        elif name == "dim_customers":
            builders[name] = lambda: silver.dim_customers(t(), as_of)
        else:
            builders[name] = lambda build=build: build(t())
    for name in GOLD:
        build = getattr(gold, name)
        if name in ("customer_kpis", "executive_kpi"):
            builders[name] = lambda build=build: build(t(), as_of)
        else:
            builders[name] = lambda build=build: build(t())
    builders["knowledge_index"] = lambda: knowledge.knowledge_index(t(), as_of)
    builders["document_chunks"] = lambda: knowledge.document_chunks(t())
    for name, df in (written or {}).items():
        builders[name] = lambda df=df: df
    holder["t"] = TableSet(builders)
    return holder["t"]
