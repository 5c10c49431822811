"""Calendar-average demand baseline per product."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from martloom.functions.dates import since
from martloom.operators.aggregates import two_level
from martloom.operators.joins import attach, match

Tables = Mapping[str, DataFrame]
DAYS, HORIZON, CEILING = 90, 30, 0.95


def demand_forecast(t: Tables, as_of: dt.date) -> DataFrame:
    recent = t["fact_orders"].where(since("order_date", as_of, DAYS - 1) & (F.col("order_status") != "Cancelled"))
    sold = match(t["fact_order_items"].select("order_id", "product_id", "quantity"),
                 recent.select("order_id", "order_date"), "order_id")
    stats = two_level(sold, ["product_id", "order_date"], ["product_id"], "quantity")
    p = attach(t["dim_products"].select("product_id"), [stats], "product_id")
    units, active = F.coalesce("total", F.lit(0)), F.coalesce("groups", F.lit(0))
    spread = F.coalesce("std", F.lit(0.0)) / (F.coalesce("mean", F.lit(0.0)) + 1.0)
    steady = F.round(F.least(F.lit(CEILING), active / float(DAYS) * (1.0 / (1.0 + spread))), 3)
    return p.select(
        "product_id", F.lit("next_30d_baseline").alias("forecast_period"),
        F.round(units / float(DAYS) * HORIZON, 0).cast("bigint").alias("predicted_units"),
        F.when(active == 0, 0.0).otherwise(steady).alias("stability_score"),
        F.lit("90d_calendar_daily_average_baseline").alias("forecast_method"), F.lit(as_of).alias("generated_at"),
    )
