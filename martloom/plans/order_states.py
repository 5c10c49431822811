"""What an order's payments, shipments, returns and reviews are allowed to look like."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from martloom.functions import money as m
from martloom.functions.dates import age_days, as_date
from martloom.operators.joins import enrich, match, missing
from martloom.operators.ordering import first_by_digest
from martloom.operators.windows import running_total
from martloom.plans.quality import eligible_purchases
from martloom.session import materialize

Tables = Mapping[str, DataFrame]

RETURN_WINDOW_DAYS = 60
# The states an order may be in at a given age in days.
STATES_BY_AGE = (
    (0, ("Processing", "Cancelled")),
    (2, ("Processing", "Shipped", "Cancelled")),
    (7, ("Shipped", "Completed", "Cancelled")),
)
STATES_LATER = ("Completed", "Returned", "Cancelled")


def payable(orders: DataFrame) -> Column:
    """Cents to be paid."""
    return m.cents("order_total") - m.cents("discount_amount") + m.cents("tax_amount")


def order_payables(t: Tables) -> DataFrame:
    return t["orders"].select("order_id", m.dollars(payable(t["orders"])).alias("payable"))


def product_net_per_order(t: Tables) -> DataFrame:
    return t["order_items"].groupBy("order_id", "product_id").agg(m.dollars(F.sum(m.line_net())).alias("net_value"))


def status_by_age(t: Tables, as_of: dt.date) -> DataFrame:
    age, status = F.col("age_days"), F.col("status")
    band, allowed = F, F
    for limit, states in STATES_BY_AGE:
        band = band.when(age <= limit, f"up to {limit}")
        allowed = allowed.when(age <= limit, status.isin(*states))
    return (
        t["orders"]
        .select("order_id", "status", age_days(as_date("order_date"), as_of).alias("age_days"))
        .select(
            "*",
            band.otherwise("older").alias("age_band"),
            allowed.otherwise(status.isin(*STATES_LATER)).alias("state_allowed"),
        )
    )


def payment_states(t: Tables, as_of: dt.date, lag_days: Column) -> DataFrame:
    """One primary payment per order in the state its order implies, and the failed attempts beside it."""
    due = m.dollars(F.greatest(payable(t["orders"]), F.lit(1)))
    orders = t["orders"].select("order_id", "status", as_date("order_date").alias("_ordered"), due.alias("amount"))
    paid_on = F.least(F.lit(as_of), F.date_add(F.col("_ordered"), lag_days))
    primary = orders.select(
        "order_id", F.lit("primary").alias("kind"), "amount",
        F.when(F.col("status") == "Cancelled", "Refunded").otherwise("Completed").alias("payment_status"),
        paid_on.alias("payment_date"),
    )
    tries = t["payments"].where(F.col("status") == "Failed").select("order_id")
    failed = match(tries, orders, "order_id").select(
        "order_id", F.lit("attempt").alias("kind"), "amount", F.lit("Failed").alias("payment_status"),
        paid_on.alias("payment_date"),
    )
    return primary.unionByName(failed)


def shipment_states(t: Tables, as_of: dt.date) -> DataFrame:
    """Shipments of orders that were not cancelled, with a delivery date no earlier than shipping and not in the future."""
    orders = t["orders"].where(F.col("status") != "Cancelled").select("order_id", F.col("status").alias("order_status"))
    s = match(t["shipments"], orders, "order_id")
    now = F.lit(as_of)
    shipped = F.least(now, as_date("ship_date"))
    eta, actual = as_date("estimated_delivery"), as_date("actual_delivery")
    state = (
        F.when(F.col("order_status") == "Processing", "Processing")
        .when((F.col("order_status") == "Shipped") & (actual.isNull() | (eta > now)), "In Transit")
        .otherwise("Delivered")
    )
    delivered = F.least(now, F.greatest(shipped, F.coalesce(actual, eta)))
    return s.select("shipment_id", "order_id", "order_status", shipped.alias("ship_date"), state.alias("state"),
                    delivered.alias("_d")).select(
        "shipment_id", "order_id", "order_status", "ship_date", "state",
        F.when(F.col("state") == "Delivered", F.col("_d")).alias("actual_delivery"),
    )


def eligible_pairs(t: Tables, as_of: dt.date) -> DataFrame:
    """Distinct (order, product) of completed or returned orders placed before the as-of date."""
    done = t["orders"].where(F.col("status").isin("Completed", "Returned") & (as_date("order_date") < F.lit(as_of)))
    pairs = match(t["order_items"].select("order_id", "product_id"), done.select("order_id", "status"), "order_id")
    return pairs.distinct()


def select_returns(t: Tables, as_of: dt.date, quota: int, every_returned: bool = True) -> DataFrame:
    """One approved return for every returned order, then other eligible pairs until the quota is full.

    The rest is taken in the order of a hash, so the choice looks random and repeats; where it ends is found by
    counting, not by sorting all pairs. A quota that cannot be filled is an error, and so is a returned order
    without an eligible product unless `every_returned` is False; such orders then get no return.
    """
    placed = as_date("order_date") < F.lit(as_of)
    returned = t["orders"].where((F.col("status") == "Returned") & placed).select("order_id")
    first = match(t["order_items"].select("order_id", "product_id"), returned, "order_id").groupBy("order_id").agg(
        F.min("product_id").alias("_first"), F.lit(True).alias("_returned")
    )
    digest = F.md5(F.concat_ws("-", F.col("order_id").cast("string"), F.col("product_id").cast("string")))
    picked = F.coalesce(F.col("_returned") & F.col("product_id").eqNullSafe(F.col("_first")), F.lit(False))
    # written once, with everything the counts and the choice need
    pairs = materialize(
        enrich(eligible_pairs(t, as_of), first, "order_id").select(
            "order_id", "product_id", "status", picked.alias("_picked"), F.when(~picked, digest).alias("_key")
        ),
        "eligible-pairs",
    )
    forced = pairs.where(F.col("_picked") & (F.col("status") == "Returned")).select("order_id", "product_id")
    n_pairs, n_forced = pairs.agg(
        F.count(F.lit(1)), F.count_if(F.col("_picked") & (F.col("status") == "Returned"))
    ).first()
    if n_forced > quota:
        raise ValueError(f"{n_forced} returned orders do not fit a quota of {quota} returns")
    if every_returned:
        asked = t["orders"].where(F.col("status") == "Returned").select("order_id")
        lacking = missing(asked, forced, ["order_id"]).count()
        if lacking:
            raise ValueError(f"{lacking} returned orders have no eligible product")
    if n_pairs < quota:
        raise ValueError(f"{n_pairs} eligible pairs do not fill a quota of {quota} returns")
    taken = first_by_digest(pairs, "_key", ["order_id", "product_id", "status"], quota - n_forced)
    return forced.select("order_id", "product_id", F.lit(True).alias("forced")).unionByName(
        taken.select("order_id", "product_id", F.lit(False).alias("forced"))
    )


def capped_refunds(t: Tables, as_of: dt.date) -> DataFrame:
    """Refunds held to what was paid for the product, and return dates held to the return window."""
    orders = t["orders"].select("order_id", as_date("order_date").alias("_ordered"))
    bought = product_net_per_order(t)
    r = match(match(t["returns"], bought, ["order_id", "product_id"]), orders, "order_id")
    net = F.greatest(F.col("net_value"), F.lit(0.01))
    window = F.least(F.lit(RETURN_WINDOW_DAYS), age_days("_ordered", as_of))
    first, last = F.date_add("_ordered", 1), F.date_add(F.col("_ordered"), window)
    asked = m.money("refund_amount")
    return r.select(
        "return_id", "order_id", "product_id", net.alias("purchased_net"), F.least(asked, net).alias("refund_amount"),
        (asked > net).alias("was_capped"), last.alias("last_return_day"),
        F.greatest(first, F.least(as_date("return_date"), last)).alias("return_date"),
    )


def running_stock(t: Tables) -> DataFrame:
    """Stock after every movement; flags the moments below zero that a final sum cannot show."""
    events = t["inventory_events"].select(
        "event_id", "product_id", "warehouse_id", "event_type", "quantity", as_date("event_date").alias("event_date")
    )
    order = [F.col("event_date").asc(), F.col("event_id").asc(), F.col("quantity").asc()]
    placed = running_total(events, ["product_id", "warehouse_id"], order, "quantity", "running_stock")
    return placed.withColumn("below_zero", F.col("running_stock") < 0)


def verified_purchases(t: Tables) -> DataFrame:
    """Verified reviews with whether an eligible purchase stands behind them, at least a day earlier."""
    verified = t["product_reviews"].where(F.col("verified_purchase"))
    r = enrich(verified, eligible_purchases(t), ["customer_id", "product_id"])
    found = F.col("first_bought").isNotNull()
    in_time = F.coalesce(as_date("review_date") >= F.date_add("first_bought", 1), F.lit(False))
    return r.select(
        "review_id", "customer_id", "product_id", found.alias("purchase_found"), in_time.alias("after_purchase")
    )
