import datetime as dt

import pytest
from pyspark.sql import functions as F

from martloom.plans import anomalies, reports, validation
from martloom.plans.medallion import build_lakehouse
from martloom.plans.platform import build_platform
from martloom.sources.tables import latest_order_date, retail_tables

AT = dt.datetime(2001, 8, 1)


@pytest.fixture(scope="module")
def run(spark, small, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("platform"))
    source, as_of = retail_tables(spark, small), latest_order_date(spark, small)
    names = [n for n in source if n not in ("order_events", "questions", "sql_texts", "customer_scores", "pipeline_runs", "streaming_metrics")]
    gold, _ = build_lakehouse(spark, source, root, as_of, "r1", AT, names, enforce_quality=False)
    t, counts = build_platform(spark, gold, root, as_of, "r1", AT, trees=5, boosts=2, enforce_validation=False)
    return root, t, counts, as_of


def test_downstream_tables_come_from_the_fitted_scores(run):
    _, t, counts, as_of = run
    scored = t["churn_predictions"]
    assert counts["churn_predictions"] == t["dim_customers"].count() == scored.select("customer_id").distinct().count()
    want = anomalies.anomaly_events(scored, as_of).select("entity_id", "severity", "anomaly_score")
    got = t["anomaly_events"].select(want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and not got.isEmpty()
    labels = reports.segment_profile(t["customer_segments"], t["customer_kpis"]).collect()
    assert len(labels) == t["segment_trials"].where("chosen").first().k
    assert t["model_metrics"].where("chosen").count() == 1


def test_answers_see_models_and_have_a_measured_latency(run):
    _, t, counts, _ = run
    assert counts["agent_interactions"] == counts["evaluation_results"] == 55
    assert t["evaluation_results"].where("latency_ms IS NULL OR latency_ms <= 0").isEmpty()
    anomalous = t["anomaly_scores"].where("is_anomaly = 1").count()
    answer = t["agent_interactions"].where("tool_used = 'anomaly'").first().response_summary
    assert answer.startswith(f"Anomalous customers: {anomalous:,}")
    assert reports.evaluation_by_type(t["evaluation_results"]).where("avg_latency_ms IS NULL").isEmpty()


def test_validation_sees_the_whole_run(spark, run):
    root, t, _, _ = run
    rows = {r.check_name: r for r in t["validation_results"].collect()}
    assert {f"object:{n}" for n in validation.REQUIRED} | {c.name for c in validation.CHECKS} <= set(rows)
    assert all(rows[f"object:{n}"].status == "PASS" for n in validation.REQUIRED)
    assert all(rows[n].status == "PASS" for n in ("null_churn_predictions", "forecast_negative_units", "ml_customer_coverage"))
    assert rows["agent_routing_eval"].actual_value == str(t["evaluation_results"].where("NOT tool_correct").count())
    log = spark.read.parquet(f"{root}/monitoring/pipeline_runs").where(F.col("status") == "SUCCEEDED")
    steps = {"train_models", "forecast_demand", "detect_anomalies", "evaluate_assistant", "validate"}
    assert steps <= {r.notebook for r in log.collect()}
