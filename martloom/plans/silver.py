"""Typed dimensions and facts from the source tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from martloom.functions import labels, money as m
from martloom.functions.dates import as_date, date_key, season
from martloom.operators.aggregates import sum_when
from martloom.operators.joins import attach, enrich

Tables = Mapping[str, DataFrame]

LINEAGE = ("_batch_id", "_run_id")


def lineage(df: DataFrame) -> list[str]:
    return [c for c in LINEAGE if c in df.columns]


def history_columns(as_of: dt.date) -> list[Column]:
    """Validity columns of a dimension that keeps only its current state."""
    return [
        F.lit(as_of).alias("valid_from"),
        F.lit(dt.date(9999, 12, 31)).alias("valid_to"),
        F.lit(True).alias("is_current"),
    ]


def dim_date(spark, as_of: dt.date) -> DataFrame:
    """Ten years back to two years ahead of the as-of date."""
    first, last = F.add_months(F.lit(as_of), -120), F.date_add(F.lit(as_of), 730)
    days = spark.range(1).select(F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("d"))
    d = F.col("d")
    return days.select(
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        season(F.month(d)).alias("season"),
    )


def dim_customers(t: Tables, as_of: dt.date) -> DataFrame:
    c = t["customers"]
    return c.select(
        "customer_id",
        "first_name",
        "last_name",
        F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
        F.lower(F.trim("email")).alias("email_normalized"),
        "phone",
        as_date("date_of_birth").alias("date_of_birth"),
        "customer_segment",
        as_date("registration_date").alias("registration_date"),
        "country",
        "city",
        "status",
        "loyalty_points",
        *history_columns(as_of),
        *lineage(c),
    )


def dim_products(t: Tables) -> DataFrame:
    categories = t["categories"].select("category_id", F.col("name").alias("category_name"))
    p = enrich(t["products"], categories, "category_id")
    price, margin = m.cents("price"), m.cents("price") - m.cents("cost")
    return p.select(
        "product_id",
        F.col("name").alias("product_name"),
        "category_id",
        "category_name",
        "supplier_id",
        m.money("price").alias("price"),
        m.money("cost").alias("cost"),
        m.dollars(margin).alias("gross_margin"),
        m.mean_rounded(margin * 100, price).alias("margin_pct"),
        "sku",
        "weight_kg",
        "status",
    )


def dim_stores(t: Tables) -> DataFrame:
    return t["stores"].select(
        "store_id",
        F.col("name").alias("store_name"),
        "city",
        "state",
        "country",
        "store_type",
        "size_sqft",
        as_date("opened_date").alias("opened_date"),
        "status",
    )


def dim_suppliers(t: Tables) -> DataFrame:
    return t["suppliers"].select(
        "supplier_id",
        F.col("name").alias("supplier_name"),
        "country",
        "contact_email",
        "rating",
        "lead_time_days",
        "status",
        labels.supplier_tier(F.col("rating")).alias("tier"),
    )


def reconciled_orders(t: Tables) -> DataFrame:
    """Order headers with totals, discount and tax taken from their lines.

    An order without lines keeps the header it came with.
    """
    lines = t["order_items"].groupBy("order_id").agg(
        m.units_to_cents(F.sum(m.line_total_units())).alias("_gross"),
        m.units_to_cents(F.sum(m.line_discount_units())).alias("_discount"),
    )
    o = enrich(t["orders"], lines, "order_id")
    has_lines = F.col("_gross").isNotNull()
    own = {c: m.money(c) for c in ("order_total", "discount_amount", "tax_amount")}
    lined = {
        "order_total": m.dollars(F.col("_gross")),
        "discount_amount": m.dollars(F.col("_discount")),
        "tax_amount": m.dollars(m.tax_on(F.col("_gross") - F.col("_discount"))),
    }
    return o.select(
        *[
            F.when(has_lines, lined[c]).otherwise(own[c]).alias(c) if c in own else F.col(c)
            for c in t["orders"].columns
        ]
    )


def approved_refunds(returns: DataFrame, *keys: str) -> DataFrame:
    """Approved refunds per key, in cents."""
    approved = F.col("status") == "Approved"
    return returns.groupBy(*keys).agg(sum_when(approved, m.cents("refund_amount")).alias("approved_refunds"))


def fact_orders(t: Tables) -> DataFrame:
    """Orders with refund-aware revenue. Expects reconciled headers in `orders`."""
    refunds = approved_refunds(t["returns"], "order_id")
    sold = t["orders"].where(F.col("customer_id").isNotNull() & (F.col("order_total") > 0))
    o = attach(sold, [refunds], "order_id")
    gross, discount = m.cents("order_total"), m.cents("discount_amount")
    refund = F.coalesce("approved_refunds", F.lit(0))
    return o.select(
        "order_id",
        "customer_id",
        "store_id",
        date_key(as_date("order_date")).alias("order_date_key"),
        as_date("order_date").alias("order_date"),
        F.col("status").alias("order_status"),
        "channel",
        m.dollars(gross).alias("order_total"),
        m.dollars(discount).alias("discount_amount"),
        m.money("tax_amount").alias("tax_amount"),
        m.dollars(gross - discount).alias("net_sales_before_refunds"),
        m.dollars(refund).alias("approved_refund_amount"),
        m.dollars(m.net_revenue(F.col("status"), gross, discount, refund)).alias("net_revenue"),
        "currency",
        *lineage(o),
    )


def fact_order_items(t: Tables) -> DataFrame:
    lines = t["order_items"].where((F.col("quantity") > 0) & (F.col("unit_price") > 0))
    return lines.select(
        "item_id", "order_id", "product_id", "quantity", "unit_price", "line_total", "discount_pct",
        m.dollars(m.line_net()).alias("net_line_total"),
    )


def fact_payments(t: Tables) -> DataFrame:
    return t["payments"].where(F.col("amount") > 0).select(
        "payment_id", "order_id", "amount", "method", F.col("status").alias("payment_status"),
        as_date("payment_date").alias("payment_date"), "currency", "transaction_ref",
    )


def fact_shipments(t: Tables) -> DataFrame:
    actual, promised = as_date("actual_delivery"), as_date("estimated_delivery")
    on_time = F.when(F.col("actual_delivery").isNull(), F.lit(None).cast("boolean")).otherwise(
        F.coalesce(actual <= promised, F.lit(False))
    )
    return t["shipments"].select(
        "shipment_id", "order_id", "carrier", "tracking_number", F.col("status").alias("shipment_status"),
        as_date("ship_date").alias("ship_date"), promised.alias("estimated_delivery"),
        actual.alias("actual_delivery"), "weight_kg", on_time.alias("delivered_on_time"),
    )


def fact_returns(t: Tables) -> DataFrame:
    orders = t["orders"].select("order_id", as_date("order_date").alias("_ordered"))
    returned = as_date("return_date")
    return enrich(t["returns"], orders, "order_id").select(
        "return_id", "order_id", "product_id", "reason", returned.alias("return_date"),
        m.money("refund_amount").alias("refund_amount"),
        F.col("status").alias("return_status"), F.datediff(returned, F.col("_ordered")).alias("days_to_return"),
    )


def fact_inventory_daily_movement(t: Tables) -> DataFrame:
    kind, qty = F.col("event_type"), F.col("quantity")
    events = t["inventory_events"].withColumn("snapshot_date", as_date("event_date"))
    return events.groupBy("product_id", "warehouse_id", "snapshot_date").agg(
        F.sum(qty).alias("net_quantity"),
        F.sum(F.when(kind.isin("receipt", "return"), qty).otherwise(0)).alias("total_received"),
        F.sum(F.when(kind == "sale", F.abs(qty)).otherwise(0)).alias("total_sold"),
        F.count(F.lit(1)).alias("event_count"),
    )
