"""Business tables over the facts and dimensions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from martloom.functions import labels, money as m
from martloom.functions.dates import age_days
from martloom.operators.aggregates import count_when, distinct_when, sum_when, with_distinct
from martloom.operators.joins import attach, enrich, match, one_row, zero_fill
from martloom.plans.silver import approved_refunds

Tables = Mapping[str, DataFrame]

CLV_METHOD = "historical_run_rate_floor_30d"


def live() -> Column:
    return F.col("order_status") != "Cancelled"


def _live_sum() -> Column:
    return F.sum(F.when(live(), m.cents("net_revenue")))


def _live_count() -> Column:
    return F.count(F.when(live(), F.col("net_revenue")))


def daily_sales_summary(t: Tables) -> DataFrame:
    day = with_distinct(
        t["fact_orders"], ["order_date", "channel"], "order_id", {"order_attempts": None, "total_orders": live()},
        others={"unique_customers": ("customer_id", None)},
        totals={
            "_revenue": m.total("net_revenue"), "_live_revenue": _live_sum(), "_live_rows": _live_count(),
            "_discounts": sum_when(live(), m.cents("discount_amount")), "cancelled_orders": count_when(~live()),
        },
    )
    return day.select(
        "order_date", "channel", "order_attempts", "total_orders", "unique_customers",
        m.dollars(F.col("_revenue")).alias("total_revenue"),
        m.mean_cents(F.col("_live_revenue"), F.col("_live_rows")).alias("avg_order_value"),
        m.dollars(F.col("_discounts")).alias("total_discounts"), "cancelled_orders",
    )


def customer_kpis(t: Tables, as_of: dt.date) -> DataFrame:
    """Facts are brought to one row per customer before they meet the dimension."""
    spent = t["fact_orders"].groupBy("customer_id").agg(
        distinct_when(live(), "order_id").alias("total_orders"),
        m.dollars(m.total("net_revenue")).alias("total_revenue"),
        m.mean(_live_sum(), _live_count()).alias("avg_order_value"),
        F.max(F.when(live(), F.col("order_date"))).alias("_last_live"),
    )
    c = attach(t["dim_customers"], [spent], "customer_id")
    c = zero_fill(c, ["total_orders", "total_revenue", "avg_order_value"])
    last = F.coalesce("_last_live", "registration_date")
    return c.select(
        "customer_id", "full_name", "customer_segment", "country", "status", "registration_date", "loyalty_points",
        "total_orders", "total_revenue", "avg_order_value", last.alias("last_order_date"),
        age_days(last, as_of).alias("days_since_last_order"),
        age_days("registration_date", as_of).alias("tenure_days"),
    )


def customer_lifetime_value(t: Tables) -> DataFrame:
    tenure = F.col("tenure_days")
    run_rate = m.mean_cents(m.cents("total_revenue") * (365 * 3), F.greatest(tenure, F.lit(30)))
    return t["customer_kpis"].select(
        "customer_id", "full_name", "customer_segment", F.col("total_revenue").alias("historical_revenue"),
        "total_orders", "avg_order_value", "tenure_days",
        F.when(tenure >= 0, run_rate).otherwise(0.0).alias("baseline_3yr_clv"),
        F.lit(CLV_METHOD).alias("clv_method"),
        labels.clv_tier(F.col("total_revenue")).alias("clv_tier"),
    )


def customer_360(t: Tables) -> DataFrame:
    value = t["customer_lifetime_value"].select("customer_id", "baseline_3yr_clv", "clv_tier")
    return enrich(t["customer_kpis"], value, "customer_id").select(
        "customer_id", "full_name", "customer_segment", "country", "status", "total_orders", "total_revenue",
        "avg_order_value", "days_since_last_order", "tenure_days", "loyalty_points", "baseline_3yr_clv", "clv_tier",
        labels.recency_risk(F.col("days_since_last_order")).alias("recency_risk"),
    )


def product_kpis(t: Tables) -> DataFrame:
    """Sales, refunds and reviews are each one row per product before they are joined."""
    sold = t["fact_orders"].where(live()).select("order_id")
    sales = match(t["fact_order_items"], sold, "order_id").groupBy("product_id").agg(
        F.count_distinct("order_id").alias("order_count"),
        F.sum("quantity").alias("total_units_sold"),
        m.total("net_line_total").alias("_sales"),
    )
    returned = t["fact_returns"].withColumnRenamed("return_status", "status")
    refunds = approved_refunds(returned, "product_id")
    reviews = t["product_reviews"].groupBy("product_id").agg(
        F.avg("rating").alias("avg_review_rating"), F.count(F.lit(1)).alias("review_count")
    )
    p = attach(t["dim_products"], [sales, refunds, reviews], "product_id")
    p = zero_fill(p, ["order_count", "total_units_sold", "_sales", "approved_refunds", "review_count"])
    kept = F.greatest(F.col("_sales") - F.col("approved_refunds"), F.lit(0))
    return p.select(
        "product_id", "product_name", "category_name", "price", "margin_pct", "status", "order_count",
        "total_units_sold", m.dollars(kept).alias("total_revenue"),
        m.dollars(F.col("approved_refunds")).alias("approved_refunds"), "avg_review_rating", "review_count",
    )


def store_performance(t: Tables) -> DataFrame:
    sold = with_distinct(
        t["fact_orders"], ["store_id"], "order_id", {"order_attempts": None, "total_orders": live()},
        others={"unique_customers": ("customer_id", live())},
        totals={"_revenue": m.total("net_revenue"), "_live_revenue": _live_sum(), "_live_rows": _live_count()},
    ).select(
        "store_id", "order_attempts", "total_orders", "unique_customers",
        m.dollars(F.col("_revenue")).alias("total_revenue"),
        m.mean(F.col("_live_revenue"), F.col("_live_rows")).alias("avg_order_value"),
    )
    measures = sold.columns[1:]
    s = zero_fill(attach(t["dim_stores"], [sold], "store_id"), measures)
    return s.select("store_id", "store_name", "city", "state", "store_type", *measures)


def supplier_performance(t: Tables) -> DataFrame:
    offered = t["products"].groupBy("supplier_id").agg(F.count_distinct("product_id").alias("product_count"))
    s = zero_fill(attach(t["dim_suppliers"], [offered], "supplier_id"), ["product_count"])
    return s.select("supplier_id", "supplier_name", "country", "tier", "rating", "lead_time_days", "product_count")


def inventory_health(t: Tables) -> DataFrame:
    stock = t["fact_inventory_daily_movement"].groupBy("product_id", "warehouse_id").agg(
        F.sum("net_quantity").alias("current_stock"), F.sum("total_sold").alias("total_sold")
    )
    names = t["dim_products"].select("product_id", "product_name", "category_name")
    return enrich(stock, names, "product_id").select(
        "product_id", "product_name", "category_name", "warehouse_id", "current_stock", "total_sold",
        labels.stock_status(F.col("current_stock")).alias("stock_status"),
        (F.col("current_stock") <= 10).alias("reorder_flag"),
    )


def support_operations(t: Tables) -> DataFrame:
    resolved = F.col("resolved_date").isNotNull()
    score = F.col("satisfaction_score")
    return t["support_tickets"].groupBy("category", "priority", F.col("status").alias("ticket_status")).agg(
        F.count(F.lit(1)).alias("ticket_count"),
        m.mean_rounded(F.sum(score), F.count(score)).alias("avg_satisfaction"),
        count_when(resolved).alias("resolved_count"),
        m.pct(count_when(resolved), F.count(F.lit(1))).alias("resolution_rate_pct"),
    )


def executive_kpi(t: Tables, as_of: dt.date) -> DataFrame:
    n = F.count(F.lit(1))
    row = one_row(
        [
            t["dim_customers"].agg(
                n.alias("total_customers"), count_when(F.col("status") == "Active").alias("active_customers")
            ),
            t["fact_orders"].agg(
                n.alias("order_attempts"),
                count_when(live()).alias("total_orders"),
                m.dollars(m.total("net_revenue")).alias("total_revenue"),
                m.mean_cents(_live_sum(), _live_count()).alias("avg_order_value"),
            ),
            t["fact_returns"].agg(n.alias("total_returns")),
            t["dim_products"].agg(count_when(F.col("status") == "Active").alias("active_products")),
            t["support_tickets"].agg(count_when(F.col("status") == "open").alias("open_tickets")),
        ]
    )
    return row.select(F.lit(as_of).alias("report_date"), "*")


