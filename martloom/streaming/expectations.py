"""Row expectations that drop failing rows and count them while the data flows."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Observation, functions as F

# The expectations of the managed order stream.
ORDER_EVENT_RULES = {
    "valid_event_id": "event_id IS NOT NULL AND length(event_id) > 0",
    "valid_order_id": "order_id IS NOT NULL AND length(order_id) > 0",
    "valid_event_time": "event_time IS NOT NULL",
    "valid_channel": "channel IN ('web', 'mobile', 'store')",
    "valid_amount": "order_total > 0 AND discount_amount >= 0 AND discount_amount <= order_total",
}
NET_REVENUE_RULES = {"positive_net_revenue": "net_revenue >= 0"}


def expect_or_drop(df: DataFrame, rules: Mapping[str, str], seen: Observation | str | None = None) -> DataFrame:
    """Keep the rows that meet every rule; an unknown (NULL) outcome counts as a failure.

    `seen` collects one count of failing rows per rule: an Observation for a
    batch, a metric name for a stream (found in its progress events).
    """
    held = {name: F.coalesce(F.expr(text), F.lit(False)) for name, text in rules.items()}
    if seen is not None:
        failures = [F.count_if(~ok).alias(name) for name, ok in held.items()]
        df = df.observe(seen, F.count(F.lit(1)).alias("rows"), *failures)
    return df.where(reduce(and_, held.values()))
