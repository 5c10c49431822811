"""Model operators (M1-M11). Fitted models have no SQL counterpart; features and splits do."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from martloom.plans import churn, scoring, segmentation
from verification.common import Registry
from verification.ctes import sql

R = Registry()
AT = dt.datetime(2001, 8, 1)
EXTRA = {
    "features": "SELECT c.customer_id, c.tenure_days, c.total_orders, c.total_revenue, c.avg_order_value,"
    " c.days_since_last_order, c.loyalty_points, CASE c.customer_segment WHEN 'VIP' THEN 4 WHEN 'Premium' THEN 3"
    " WHEN 'Standard' THEN 2 ELSE 1 END AS segment_score, CASE WHEN d.status = 'Churned' THEN 1"
    " WHEN d.status = 'Inactive' AND c.days_since_last_order > 500 THEN 1 ELSE 0 END AS churn_label"
    " FROM customer_360 c JOIN dim_customers d ON c.customer_id = d.customer_id"
}
_DONE: dict[tuple[str, str], scoring.ModelTables] = {}


def models(x) -> scoring.ModelTables:
    """The models of a folder, each fitted once per session, when it is first asked for."""
    key = (x.spark.sparkContext.applicationId, x.folder)
    if key not in _DONE:
        _DONE[key] = scoring.train_and_score(churn.churn_features(x.t), AT)
    return _DONE[key]


R.add("m1_churn_features", lambda x: churn.churn_features(x.t), sql("SELECT * FROM features", **EXTRA))
R.add(
    "m2_model_inputs",
    lambda x: churn.churn_features(x.t).select("customer_id", *churn.FEATURES),
    sql("SELECT customer_id, " + ", ".join(churn.FEATURES) + " FROM features", **EXTRA),
)


def split_rows(x):
    train, test = churn.split(churn.churn_features(x.t))
    rows = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return rows.select("customer_id", "part", "churn_label")


R.add(
    "m3_ordered_split",
    split_rows,
    sql(
        "SELECT customer_id, CASE WHEN n <= CAST(floor(total * 0.8) AS BIGINT) THEN 'train' ELSE 'test' END AS part, churn_label"
        " FROM (SELECT *, row_number() OVER (ORDER BY customer_id) AS n, COUNT(*) OVER () AS total FROM features)", **EXTRA,
    ),
)
for number, name in ((4, "Logistic Regression"), (5, "Random Forest"), (6, "Gradient Boosting")):
    R.add(
        f"m{number}_{name.lower().replace(' ', '_')}",
        lambda x, name=name: models(x).metrics_of(name).select("model", "roc_auc", "pr_auc", "f1"),
    )
R.add("m7_model_metrics", lambda x: models(x).model_metrics.drop("chosen"))
R.add("m8_chosen_model", lambda x: models(x).model_metrics.where("chosen").select("model", "f1"))
R.add("m9_customer_segments", lambda x: models(x).customer_segments)
R.add("m9_segment_trials", lambda x: models(x).segment_trials)
R.add("m10_anomaly_scores", lambda x: models(x).anomaly_scores)
R.add("m11_churn_predictions", lambda x: models(x).churn_predictions)
R.add(
    "a13_cluster_profile",
    lambda x: segmentation.cluster_profile(
        x.t["customer_kpis"].withColumn("cluster", (F.col("customer_id") % 4).cast("int"))
    ).select("cluster", *[F.round(c, 4).alias(c) for c in ("total_revenue", "total_orders", "days_since_last_order")]),
    sql(
        "SELECT CAST(customer_id % 4 AS INTEGER) AS cluster, ROUND(AVG(total_revenue), 4) AS total_revenue,"
        " ROUND(AVG(total_orders), 4) AS total_orders, ROUND(AVG(days_since_last_order), 4) AS days_since_last_order"
        " FROM customer_kpis GROUP BY 1"
    ),
)
