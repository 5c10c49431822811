"""Labels from numbers, ranks from labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

# Thresholds and labels of the published bands.
SUPPLIER_TIERS = ((4.5, "Tier1"), (3.5, "Tier2"))
CLV_TIERS = ((5000, "Platinum"), (2000, "Gold"), (500, "Silver"))
RECENCY_RISK = ((365, "High"), (180, "Medium"))
STOCK_LEVELS = ((0, "Out of Stock"), (10, "Critical"), (50, "Low"), (200, "Normal"))
CHURN_BANDS = ((0.7, "High (>=70%)"), (0.4, "Medium (40-70%)"))
SEGMENT_SCORES = {"VIP": 4, "Premium": 3, "Standard": 2}
SEVERITY_ORDER = ("critical", "error", "warning", "informational")
STOCK_ORDER = ("Out of Stock", "Critical", "Low", "Normal", "Overstocked")


def band(value: Column, cuts: Sequence[tuple[float, str]], otherwise: str, test: str = ">=") -> Column:
    """First cut that holds gives the label; NULL falls through to `otherwise`."""
    tests = {">=": Column.__ge__, ">": Column.__gt__, "<=": Column.__le__}
    chain = F
    for cut, label in cuts:
        chain = chain.when(tests[test](value, F.lit(cut)), label)
    return chain.otherwise(otherwise)


def supplier_tier(rating: Column) -> Column:
    return band(rating, SUPPLIER_TIERS, "Tier3")


def clv_tier(revenue: Column) -> Column:
    return band(revenue, CLV_TIERS, "Bronze")


def recency_risk(days: Column) -> Column:
    return band(days, RECENCY_RISK, "Low", ">")


def stock_status(stock: Column) -> Column:
    return band(stock, STOCK_LEVELS, "Overstocked", "<=")


def churn_band(probability: Column) -> Column:
    return band(probability, CHURN_BANDS, "Low (<40%)")


def ordinal(value: Column, scores: Mapping[str, int], otherwise: int) -> Column:
    chain = F
    for label, score in scores.items():
        chain = chain.when(value == label, score)
    return chain.otherwise(otherwise)


def segment_score(segment: Column) -> Column:
    return ordinal(segment, SEGMENT_SCORES, 1)


def position(value: Column, order: Sequence[str]) -> Column:
    """1-based place of a label in a fixed order; unknown labels come last."""
    return ordinal(value, {label: i for i, label in enumerate(order, 1)}, len(order) + 1)


def label_lookup(value: Column, labels: Mapping[int, str], otherwise: str = "Unknown") -> Column:
    """Small id -> label lookup kept inside the JVM."""
    pairs = [F.lit(x) for pair in labels.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), value), F.lit(otherwise))
