"""Write the whole lakehouse: bronze -> quality gate -> silver -> gold, with an audit row per step."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from martloom.plans import quality, silver
from martloom.plans.lakehouse import GENAI, GOLD, SILVER, lakehouse
from martloom.sources.run_table import RunTable
from martloom.sources.sinks import logged_run, stamp, write_table
from martloom.sources.tables import TableSet


def build_lakehouse(
    spark: SparkSession,
    source: Mapping[str, DataFrame],
    root: str,
    as_of: dt.date,
    run_id: str,
    at: dt.datetime,
    names: Sequence[str],
    partition_by: Mapping[str, Sequence[str]] | None = None,
    enforce_quality: bool = True,
) -> tuple[TableSet, dict[str, int]]:
    """Write every layer from the named source tables; returns the written tables and their row counts.

    Each table is computed from tables already written, so nothing is computed twice.
    """
    partition_by = partition_by or {}
    counts: dict[str, int] = {}
    log = f"{root}/monitoring/pipeline_runs"
    written: dict[str, DataFrame] = {}

    def put(layer: str, name: str, df: DataFrame) -> None:
        path = f"{root}/{layer}/{name}"
        counts[name] = write_table(df, path, partition_by=partition_by.get(name, ()))
        written[name] = spark.read.parquet(path)

    with logged_run(spark, log, run_id, "load_bronze", "bronze") as run:
        for name in names:
            df = silver.reconciled_orders(source) if name == "orders" else source[name]
            put("bronze", name, stamp(df, run_id, run_id, at))
        run["rows"] = sum(counts.values())
    bronze = dict(written)

    with logged_run(spark, log, run_id, "check_quality", "quality") as run:
        results, _ = quality.run_rules(spark, bronze, as_of, run_id, at)
        runs = RunTable(spark, f"{root}/quality/quality_results_history")
        runs.commit(results)
        latest = f"{root}/quality/quality_results"
        write_table(runs.latest(), latest)  # a copy for readers of plain folders, made again by every run
        results = runs.latest()
        samples = quality.failure_samples(spark, bronze, results, as_of, at)
        write_table(samples, f"{root}/quality/quality_failure_samples", "append")
        summary = quality.quality_summary(results)
        put("quality", "quality_summary", summary)
        put("gold", "data_quality_kpi", quality.data_quality_kpi(written["quality_summary"], as_of))
        written["quality_results"] = results
        run["rows"] = len(quality.RULES)
        if enforce_quality:
            quality.gate(results)

    for layer, tables in (("silver", SILVER), ("gold", GOLD), ("genai", GENAI)):
        with logged_run(spark, log, run_id, f"build_{layer}", layer) as run:
            before = sum(counts.values())
            for name in tables:
                put(layer, name, lakehouse(spark, bronze, as_of, written)[name])
            run["rows"] = sum(counts.values()) - before
    return lakehouse(spark, bronze, as_of, written), counts
