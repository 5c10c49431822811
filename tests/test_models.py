import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import Observation, functions as F

from martloom.plans import anomalies, churn, isolation, scoring, segmentation

COLUMNS = "customer_id long, tenure_days int, total_orders long, total_revenue double, avg_order_value double, days_since_last_order int, loyalty_points long, segment_score int, churn_label int"


@pytest.fixture(scope="module")
def customers(spark):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        gone = rng.random() < 0.3
        orders = rng.randint(0, 3) if gone else rng.randint(5, 30)
        revenue = orders * rng.uniform(20, 60)
        recency = rng.randint(300, 700) if gone else rng.randint(1, 100)
        rows.append((i, rng.randint(100, 2000), orders, revenue, revenue / max(orders, 1), recency, rng.randint(0, 500), rng.randint(1, 4), int(gone)))
    rows.append((400, 5, 900, 9e6, 1e4, 1, 99999, 4, 0))  # an extreme customer
    return spark.createDataFrame(rows, COLUMNS).repartition(4)


def test_label_and_features(spark):
    base = dict(total_orders=1, total_revenue=1.0, avg_order_value=1.0, tenure_days=1, loyalty_points=1, customer_segment="VIP")
    rows = [(i, d, s) for i, (d, s) in enumerate([(500, "Inactive"), (501, "Inactive"), (1, "Churned"), (None, "Inactive"), (900, "Active")])]
    c360 = spark.createDataFrame([(i, d) for i, d, _ in rows], "customer_id long, days_since_last_order int")
    c360 = c360.withColumns({k: F.lit(v) for k, v in base.items()})
    status = spark.createDataFrame([(i, s) for i, _, s in rows], "customer_id long, status string")
    got = churn.churn_features({"customer_360": c360, "dim_customers": status}).orderBy("customer_id").collect()
    assert [r.churn_label for r in got] == [0, 1, 1, 0, 0]
    assert got[3].days_since_last_order == 365 and got[0].segment_score == 4
    assert "days_since_last_order" not in churn.FEATURES


@pytest.fixture(autouse=True)
def observed(spark):
    """A session that has counted rows during a write must still be able to fit and apply models."""
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 3


def test_models_learn_and_one_is_always_chosen(spark, customers):
    found = churn.compare_models(customers, trees=10, boosts=3)
    assert [c.name for c in found] == ["Logistic Regression", "Random Forest", "Gradient Boosting"]
    assert all(c.metrics["f1"] > 0.8 and c.metrics["roc_auc"] > 0.9 for c in found)
    zero = [c._replace(metrics={**c.metrics, "f1": 0.0, "pr_auc": i / 10}) for i, c in enumerate(found)]
    assert churn.best(zero).name == "Gradient Boosting"
    rows = churn.metric_rows(spark, found).collect()
    assert sum(r.chosen for r in rows) == 1


def test_metrics_are_zero_where_undefined(spark):
    one_class = spark.createDataFrame([(0, 0.0)] * 3, "churn_label int, prediction double")
    got = churn.metrics(one_class)
    assert (got["accuracy"], got["roc_auc"], got["precision"], got["recall"], got["f1"]) == (1.0, 0.0, 0.0, 0.0, 0.0)


def test_segments_are_named_by_value(spark, customers):
    normal = customers.where("customer_id < 400")
    s = segmentation.fit_segments(normal, ks=range(2, 4))
    placed = segmentation.assign(s, normal)
    assert placed.count() == 400 and len(s.labels) == s.k
    profile = placed.join(normal, "customer_id").groupBy("segment_label").agg(F.avg("total_revenue").alias("r")).collect()
    value = {r.segment_label: r.r for r in profile}
    assert value["High Value"] == max(value.values()) and value["Low Value"] == min(value.values())
    assert max(s.trials, key=lambda t: t[1])[0] == s.k


def test_isolation_forest_finds_the_outlier_and_repeats(spark, customers):
    first = isolation.anomaly_scores(customers, "customer_id", churn.FEATURES, trees=50, sample=128)
    rows = {r.customer_id: r for r in first.collect()}
    assert max(rows.values(), key=lambda r: r.anomaly_score_raw).customer_id == 400
    flagged = sum(r.is_anomaly for r in rows.values())
    assert len(rows) == 401 and 10 <= flagged <= 25
    again = isolation.anomaly_scores(customers.repartition(7), "customer_id", churn.FEATURES, trees=50, sample=128)
    assert {r.customer_id: r.anomaly_score_raw for r in again.collect()} == {k: r.anomaly_score_raw for k, r in rows.items()}


def test_tree_samples_are_full_and_distinct(spark):
    df = spark.range(3000).select(F.col("id").alias("k"), F.col("id").cast("double").alias("x"))
    sizes = isolation.tree_samples(df, "k", ["x"], 8, 100).groupBy("tree").agg(F.count_distinct("k").alias("n")).collect()
    assert sorted((r.tree, r.n) for r in sizes) == [(i, 100) for i in range(8)]


def test_path_correction():
    assert isolation.path_correction(1) == 0.0 and isolation.path_correction(2) == 1.0
    assert isolation.path_correction(256) == pytest.approx(10.244, abs=0.01)
    constant = isolation._grow(np.ones((10, 2)), np.random.default_rng(1), 8)
    assert constant == [(-1, 0.0, -1, -1, isolation.path_correction(10))]


def test_predictions_table(spark, customers):
    probs = customers.select("customer_id", "churn_label", F.lit(0.5).alias("churn_probability"))
    segs = customers.select("customer_id", F.lit(1).alias("segment_id"), F.lit("x").alias("segment_label"))
    scores = customers.select("customer_id", F.lit(0.1).alias("anomaly_score_raw"), F.lit(1).alias("is_anomaly"))
    got = scoring.churn_predictions(probs, segs, scores, dt.datetime(2024, 1, 1))
    assert got.count() == 401 and got.first().churn_predicted == 1


def test_anomaly_events_with_ties_and_few_flags(spark):
    rows = [(i, 0.5, 1.0 if i < 4 else 0.1 * (i % 7), int(i < 12)) for i in range(30)]
    df = spark.createDataFrame(rows, "customer_id long, churn_probability double, anomaly_score_raw double, is_anomaly int")
    got = anomalies.anomaly_events(df, dt.date(2024, 1, 1), 10).orderBy("event_id").collect()
    assert len(got) == 10 and {r.entity_id for r in got if r.severity == "critical"} == {0, 1, 2, 3}
    assert next(r for r in got if r.event_id == "ANM1").entity_id == 0


def test_a_table_fits_only_the_models_it_needs(spark, customers, monkeypatch):
    fitted = []
    for plan, name in ((churn, "compare_models"), (segmentation, "fit_segments"), (isolation, "anomaly_scores")):
        real = getattr(plan, name)
        monkeypatch.setattr(plan, name, lambda *a, real=real, name=name, **kw: fitted.append(name) or real(*a, **kw))
    models = scoring.train_and_score(customers, dt.datetime(2024, 1, 1), trees=5, boosts=2)
    assert [r.model for r in models.metrics_of("Logistic Regression").collect()] == ["Logistic Regression"]
    assert models.model_metrics.count() == 3 and sum(r.chosen for r in models.model_metrics.collect()) == 1
    assert fitted == ["compare_models"] * 2  # the second for the two models that were missing
    predictions = models.churn_predictions
    assert predictions.count() == 401 and sorted(fitted[2:]) == ["anomaly_scores", "fit_segments"]
    assert list(models._asdict()) == list(scoring.TABLES) and len(fitted) == 4


def test_segment_rounds_use_all_cores():
    assert [segmentation._parts(n, 12) for n in (0, 1, 90_000, 900_000, 5_400_000)] == [1, 1, 9, 12, 36]
