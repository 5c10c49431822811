"""End-to-end checks over source, silver, gold, model and stream tables.

A check is a name, a category and a frame with one `actual` number. A table
that is missing or broken makes its checks FAIL (or SKIP where that is allowed)
and leaves the others alone.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martloom.operators.joins import missing
from martloom.plans.quality import in_halves, violation_counts
from martloom.plans.quality_rules import RULES

Tables = Mapping[str, DataFrame]
BLOCKING = ("core", "objects")
RULE = {r.rule_id: r for r in RULES}

REQUIRED = (
    "customers", "orders", "order_items", "fact_orders", "customer_360", "product_kpis", "quality_results",
    "churn_predictions", "document_chunks", "evaluation_results",
)
OPTIONAL = ("orders_bronze_stream", "orders_silver_stream", "live_sales_minute_pipeline")


class ValidationError(ValueError):
    """A core or object check failed."""


class RuleCount(NamedTuple):
    """Violations of a quality rule. Checks of this kind share the scans and ledgers of the rules."""

    rule_id: str


class RowsWhere(NamedTuple):
    """Rows of a table that meet a condition. Checks on one table share its scan."""

    table: str
    condition: str


class Check(NamedTuple):
    name: str
    category: str
    actual: RuleCount | RowsWhere | Callable[[SparkSession, Tables, dt.date], DataFrame]
    expected: str = "0"  # "0", ">0", or the name of a table whose row count is expected
    if_missing: str = "FAIL"


def _rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("actual"))


def _unmatched(left: str, right: str, *keys: str):
    return lambda spark, t, as_of: _rows(missing(t[left], t[right], list(keys)))


CHECKS: tuple[Check, ...] = (
    Check("orders_customer_fk", "core", _unmatched("orders", "customers", "customer_id")),
    Check("items_order_fk", "core", _unmatched("order_items", "orders", "order_id")),
    Check("returns_product_order_fk", "core", _unmatched("returns", "order_items", "order_id", "product_id")),
    Check("cancelled_shipments", "core", RuleCount("QR029")),
    Check("future_orders", "core", RuleCount("QR007")),
    Check("order_gross_reconciliation", "core", RuleCount("QR025")),
    Check("returned_orders_have_approved_return", "core", RuleCount("QR031")),
    Check("noncancelled_orders_have_completed_payment", "core", RuleCount("QR032")),
    Check("cancelled_orders_have_no_completed_payment", "core", RuleCount("QR033")),
    Check("negative_inventory_stock", "core", RuleCount("QR034")),
    Check("shipment_delivery_temporal", "core", RuleCount("QR035")),
    Check("return_date_temporal", "core", RuleCount("QR036")),
    Check("dq_rule_errors", "core", RowsWhere("quality_results", "status = 'ERROR'")),
    Check("bronze_silver_order_reconciliation", "core", _unmatched("orders", "fact_orders", "order_id")),
    Check("silver_gold_customer_reconciliation", "core", _unmatched("dim_customers", "customer_360", "customer_id")),
    Check("null_churn_predictions", "core", RowsWhere("churn_predictions", "churn_probability IS NULL")),
    Check("forecast_negative_units", "core", RowsWhere("demand_forecast", "predicted_units < 0")),
    Check("ml_customer_coverage", "ml", RowsWhere("churn_predictions", "true"), "dim_customers"),
    Check("agent_routing_eval", "genai", RowsWhere("evaluation_results", "NOT tool_correct")),
    Check("realtime_rows", "streaming", RowsWhere("live_sales_minute", "true"), ">0", "SKIP"),
    Check("available_now_realtime_rows", "streaming", RowsWhere("realtime_order_events", "true"), ">0"),
    Check("available_now_successful_microbatches", "streaming", RowsWhere("streaming_metrics", "status = 'SUCCEEDED'"), ">0"),
)

SCHEMA = (
    "check_name string, category string, status string, actual_value string, expected_value string, detail string,"
    " run_id string, evaluated_at timestamp"
)


def _expected(t: Tables, c: Check) -> Column:
    return F.lit(c.expected) if c.expected in ("0", ">0") else _rows(t[c.expected]).scalar().cast("string")


def _row_of(t: Tables, c: Check, actual: Column) -> Column:
    return F.struct(
        F.lit(c.name).alias("check_name"), F.lit(c.category).alias("category"), actual.cast("bigint").alias("actual"),
        _expected(t, c).alias("expected"),
    )


def check_rows(spark: SparkSession, t: Tables, as_of: dt.date, checks: Sequence[Check] = CHECKS) -> DataFrame:
    """(check_name, category, actual, expected) of the given checks as one lazy frame.

    All rule checks are one fused plan of `quality.violation_counts`, so each order ledger and each table is read
    once for all of them; conditions on one table are counted in one scan.
    """
    rules = [c for c in checks if isinstance(c.actual, RuleCount)]
    tables: dict[str, list[Check]] = {}
    for c in checks:
        if isinstance(c.actual, RowsWhere):
            tables.setdefault(c.actual.table, []).append(c)
    parts = []
    if rules:
        asked = {c.actual.rule_id: RULE[c.actual.rule_id] for c in rules}
        counts = violation_counts(spark, t, list(asked.values()), as_of)
        rows = [F.when(F.col("rule_id") == c.actual.rule_id, _row_of(t, c, F.col("failed_records"))) for c in rules]
        parts.append(counts.select(F.explode(F.array_compact(F.array(*rows))).alias("row")).select("row.*"))
    for table, members in tables.items():
        counted = t[table].agg(*[F.count_if(F.expr(c.actual.condition)).alias(f"n{i}") for i, c in enumerate(members)])
        rows = [_row_of(t, c, F.col(f"n{i}")) for i, c in enumerate(members)]
        parts.append(counted.select(F.explode(F.array(*rows)).alias("row")).select("row.*"))
    for c in checks:
        if callable(c.actual):
            parts.append(c.actual(spark, t, as_of).select(_row_of(t, c, F.col("actual")).alias("row")).select("row.*"))
    return reduce(DataFrame.unionByName, parts)


def verdict(skip_when_empty: Sequence[str] = ("realtime_rows",)):
    """Status column of `check_rows`."""
    ok = F.when(F.col("expected") == ">0", F.col("actual") > 0).otherwise(
        F.col("actual") == F.col("expected").try_cast("bigint")
    )
    return F.when(ok, "PASS").when(F.col("check_name").isin(*skip_when_empty), "SKIP").otherwise("FAIL")


def run_checks(
    spark: SparkSession, t: Tables, as_of: dt.date, run_id: str, at: dt.datetime, checks: Sequence[Check] = CHECKS
) -> DataFrame:
    """Evaluate all checks together; where something in the joint plan breaks, in halves down to the broken checks."""
    # checks that share a scan stay next to each other, so a damaged table costs its own group only
    grouped = sorted(checks, key=lambda c: (type(c.actual).__name__, c.actual.table if isinstance(c.actual, RowsWhere) else ""))
    done, errors = in_halves(
        grouped, lambda some: check_rows(spark, t, as_of, some).withColumn("status", verdict()).collect()
    )
    broken = [(c.name, c.category, c.if_missing, "ERROR", c.expected, str(e)[:1000], run_id, at) for c, e in errors]
    rows = [(r.check_name, r.category, r.status, str(r.actual), r.expected, "", run_id, at) for r in done]
    return spark.createDataFrame(rows + broken, SCHEMA)


def object_checks(spark: SparkSession, t: Tables, run_id: str, at: dt.datetime) -> DataFrame:
    """Required tables exist; optional ones are non-empty where they exist."""

    def present(name: str) -> bool:
        try:
            return name in t and t[name] is not None
        except Exception:  # a failed read arrives in many forms
            return False

    rows = []
    for name in REQUIRED:
        ok = present(name)
        rows.append((f"object:{name}", "objects", "PASS" if ok else "FAIL", str(ok), "True", "", run_id, at))
    for name in OPTIONAL:
        if present(name):
            filled = not t[name].isEmpty()
            rows.append((f"managed:{name}", "managed", "PASS" if filled else "FAIL", str(filled), "True", "", run_id, at))
        else:
            rows.append((f"managed:{name}", "managed", "SKIP", "False", "True", "the managed path has not run", run_id, at))
    return spark.createDataFrame(rows, SCHEMA)


def gate(results: DataFrame) -> list[str]:
    """Raise on failed core or object checks; return the names of the other failures."""
    failed = results.where(F.col("status") == "FAIL").orderBy("check_name").collect()  # one row per check
    blocking = [r for r in failed if r.category in BLOCKING]
    if blocking:
        listed = "; ".join(f"{r.check_name}: expected {r.expected_value}, got {r.actual_value}" for r in blocking)
        raise ValidationError(f"{len(blocking)} blocking checks failed: {listed}")
    return [r.check_name for r in failed]
