"""What follows the gold layer: models, forecast, anomalies, answers and validation, each written with an audit row."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from martloom.plans import anomalies, assistant, churn, demand, retrieval, scoring, validation
from martloom.plans.evaluation_cases import labelled_questions
from martloom.session import materialize
from martloom.sources.run_table import RunTable
from martloom.sources.sinks import logged_run, write_table
from martloom.sources.tables import TableSet


def answer_questions(
    spark: SparkSession, t: TableSet, questions: DataFrame, runs: DataFrame, layers: Sequence[tuple[str, int]], at: dt.datetime
) -> DataFrame:
    """One interaction per question; the latency is the measured time of the whole batch over its questions."""
    begun = time.perf_counter()
    found = retrieval.search(questions, t["document_chunks"])
    passages = materialize(retrieval.passages(found, t["document_chunks"]), "passages")
    health = spark.createDataFrame(list(layers), "layer string, tables int")
    facts = assistant.answer_lines(
        t, assistant.metric_values(t), t["quality_results"], t["anomaly_events"], runs, health
    )
    lines = materialize(facts, "lines")
    elapsed = (time.perf_counter() - begun) * 1000 / max(questions.count(), 1)
    return assistant.respond(questions, passages, lines, at, elapsed)


def build_platform(
    spark: SparkSession,
    t: TableSet,
    root: str,
    as_of: dt.date,
    run_id: str,
    at: dt.datetime,
    *,
    questions: DataFrame | None = None,
    trees: int = 150,
    boosts: int = 100,
    enforce_validation: bool = True,
) -> tuple[TableSet, dict[str, int]]:
    """Continue a run of `medallion.build_lakehouse` from its tables `t`, under the same root.

    Every step reads what the ones before have written: the events come from the fitted models' scores, answers from
    those events, and validation sees all of it. `questions` (question_id, question_type, text, expected_agent) default to
    the labelled ones. Tables of the order stream take part in validation if `t` holds them. A step that fails leaves a
    FAILED audit row; run again, every table is written anew, and validation results are kept per run.
    """
    counts: dict[str, int] = {}
    layers: dict[str, int] = {}
    log = f"{root}/monitoring/pipeline_runs"
    questions = labelled_questions(spark) if questions is None else questions

    def put(layer: str, **frames: DataFrame) -> int:
        nonlocal t
        for name, df in frames.items():
            path = f"{root}/{layer}/{name}"
            counts[name] = write_table(df, path)
            t = t.replacing(**{name: spark.read.parquet(path)})
        layers[layer] = layers.get(layer, 0) + len(frames)
        return sum(counts[name] for name in frames)

    with logged_run(spark, log, run_id, "train_models", "ml") as run:
        put("ml", churn_features=churn.churn_features(t))
        models = scoring.train_and_score(t["churn_features"], at, trees, boosts)
        run["rows"] = put("ml", **models._asdict())

    with logged_run(spark, log, run_id, "forecast_demand", "gold") as run:
        run["rows"] = put("gold", demand_forecast=demand.demand_forecast(t, as_of))

    with logged_run(spark, log, run_id, "detect_anomalies", "gold") as run:
        scores = t["churn_predictions"]
        run["rows"] = put(
            "gold", anomaly_events=anomalies.anomaly_events(scores, as_of), anomaly_kpi=anomalies.anomaly_kpi(scores, as_of),
            anomaly_summary=anomalies.anomaly_summary(scores),
        )

    with logged_run(spark, log, run_id, "evaluate_assistant", "genai") as run:
        runs = spark.read.parquet(log)
        rows = put("genai", agent_interactions=answer_questions(spark, t, questions, runs, sorted(layers.items()), at))
        run["rows"] = rows + put("genai", evaluation_results=assistant.evaluate(questions, t["agent_interactions"]))

    with logged_run(spark, log, run_id, "validate", "quality") as run:
        checked = validation.run_checks(spark, t, as_of, run_id, at)
        results = checked.unionByName(validation.object_checks(spark, t, run_id, at))
        history = RunTable(spark, f"{root}/quality/validation_history")
        history.commit(results)
        t = t.replacing(validation_results=history.latest())
        counts["validation_results"] = run["rows"] = history.latest().count()
        if enforce_validation:
            validation.gate(history.latest())
    return t, counts
