"""Streaming operators on landed order events (T1-T15)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Observation, functions as F

from martloom.functions.dates import minute
from martloom.session import scratch_path
from martloom.streaming import live_sales as ls, managed
from martloom.streaming.events import event_stream, events_from_sequence, land
from martloom.streaming.expectations import ORDER_EVENT_RULES, expect_or_drop
from verification.common import Registry
from verification.ctes import mean_cents, money, sql

R = Registry()
NOW = dt.datetime(2024, 2, 1)
NET = f"{money('order_total')} - {money('discount_amount')}"


def kpis(source: str, updated: str = "") -> str:
    return (
        "SELECT date_trunc('minute', event_time) AS event_minute, channel, COUNT(*) AS order_count,"
        f" COUNT(DISTINCT customer_id) AS unique_customers, CAST(SUM({money('order_total')}) AS DOUBLE) AS gross_sales,"
        f" CAST(SUM({money('discount_amount')}) AS DOUBLE) AS discounts, CAST(SUM({NET}) AS DOUBLE) AS revenue,"
        f" {mean_cents(f'SUM({NET})', 'COUNT(*)')} AS avg_order_value{updated} FROM {source} GROUP BY 1, 2"
    )


VALID = "channel IN ('web', 'mobile', 'store') AND order_total > 0 AND discount_amount >= 0 AND discount_amount <= order_total"
EXTRA = {
    "latest_events": "SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY order_id"
    " ORDER BY event_time DESC, event_id DESC) AS n FROM src_order_events) WHERE n = 1",
    "valid_events": f"SELECT * FROM src_order_events WHERE {VALID}",
}


def S(body: str) -> str:
    return sql(body, **EXTRA)


def feed(x, folder: str) -> None:
    land(x.source["order_events"].repartitionByRange(6, "event_time"), folder)


_RUNS: dict[tuple[str, str], ls.LiveSales] = {}


def stream_run(x) -> ls.LiveSales:
    """Events in several batches, then a second run over replayed files. Kept per session and folder."""
    key = (x.spark.sparkContext.applicationId, x.folder)
    if key not in _RUNS:
        landing = scratch_path(x.spark, "landing")
        live = ls.LiveSales(x.spark, scratch_path(x.spark, "live"))
        feed(x, landing)
        live.run(landing, files_per_trigger=3)
        land(x.source["order_events"].where("channel = 'store'"), landing)
        live.run(landing)
        _RUNS[key] = live
    return _RUNS[key]


def _sequence(x):
    return events_from_sequence(x.star["events"].select(F.col("event_id").alias("seq")), "T", NOW)


R.add(
    "t1_sequence_feed",
    _sequence,
    sql(
        "SELECT 'RTEVT_T_' || lpad(CAST(event_id AS VARCHAR), 6, '0') AS event_id,"
        " 'RTORD_T_' || lpad(CAST(event_id AS VARCHAR), 6, '0') AS order_id,"
        " 'C' || lpad(CAST(event_id % 10000 + 1 AS VARCHAR), 7, '0') AS customer_id,"
        " 'STR' || lpad(CAST(event_id % 50 + 1 AS VARCHAR), 4, '0') AS store_id,"
        " TIMESTAMP '2024-02-01' - to_seconds(event_id % 60) AS event_time,"
        " CASE event_id % 3 WHEN 0 THEN 'web' WHEN 1 THEN 'mobile' ELSE 'store' END AS channel,"
        " CAST(total AS DOUBLE) AS order_total, CAST(CAST(total * off AS DECIMAL(18,2)) AS DOUBLE) AS discount_amount,"
        " CAST(CAST((total - total * off) * CAST(0.08 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS DOUBLE) AS tax_amount,"
        " 'Completed' AS status, 'sequence_feed' AS source FROM (SELECT event_id,"
        " CAST(25 + CAST(event_id % 5000 AS DECIMAL(10,0)) * CAST(0.37 AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS total,"
        " CAST(event_id % 10 AS DECIMAL(4,0)) * CAST(0.01 AS DECIMAL(3,2)) AS off FROM events)"
    ),
)


def read_back(x):
    """The JSON stream with its fixed schema, copied to a table by one finite run."""
    landing, out = scratch_path(x.spark, "landing"), scratch_path(x.spark, "copied")
    feed(x, landing)
    query = (
        event_stream(x.spark, landing, 2).writeStream.format("parquet").trigger(availableNow=True)
        .option("checkpointLocation", f"{out}-cp").start(out)
    )
    query.awaitTermination()
    return x.spark.read.parquet(out)


R.add("t2_json_stream", read_back, sql("SELECT * FROM src_order_events"))


def resumed(x):
    """Micro-batches and rows of a stream that ran twice, and of a third run with nothing new."""
    live = stream_run(x)
    m = live.metrics().where(F.col("status") == "SUCCEEDED")
    return m.agg(F.count(F.lit(1)).alias("batches"), F.sum("input_rows").alias("input_rows"),
                 F.sum("bronze_rows").alias("bronze_rows"))


_TWICE = "(SELECT COUNT(*) FROM src_order_events WHERE channel = 'store')"
R.add(
    "t3_finite_runs",
    resumed,
    sql(
        f"SELECT CAST(3 AS BIGINT) AS batches, COUNT(*) + {_TWICE} AS input_rows, COUNT(*) AS bronze_rows FROM src_order_events"
    ),
)
R.add(
    "t4_batch_dedupe",
    lambda x: x.source["order_events"].unionByName(x.source["order_events"].where("channel = 'web'"))
    .dropDuplicates(["event_id"]).select("event_id", "order_id"),
    sql("SELECT event_id, order_id FROM src_order_events"),
)
_EVENT_COLUMNS = ("event_id", "order_id", "customer_id", "store_id", "event_time", "channel", "order_total",
                  "discount_amount", "tax_amount", "status", "source")
R.add("t5_bronze_once", lambda x: stream_run(x).bronze().select(*_EVENT_COLUMNS), sql("SELECT * FROM src_order_events"))
R.add(
    "t6_silver_latest",
    lambda x: stream_run(x).silver().drop("_microbatch_id", "_processed_at", "event_slot"),
    S(
        "SELECT order_id, customer_id, store_id, event_time, channel, order_total, discount_amount, tax_amount,"
        f" CAST({NET} AS DOUBLE) AS net_revenue, status AS order_status, source FROM latest_events"
    ),
)
R.add(
    "t7_affected_keys",
    lambda x: x.source["order_events"].select(minute("event_time").alias("event_minute"), "channel").distinct(),
    sql("SELECT DISTINCT date_trunc('minute', event_time) AS event_minute, channel FROM src_order_events"),
)
R.add("t8_gold_minutes", lambda x: stream_run(x).gold().drop("last_updated", "event_slot"), S(kpis("latest_events")))
R.add(
    "t9_batch_metrics",
    lambda x: stream_run(x).metrics().groupBy("stream_name", "status").agg(
        F.sum("input_rows").alias("input_rows"), (F.min("processing_ms") >= 0).alias("timed"),
        (F.min("event_lag_seconds") >= 0).alias("lag_known"),
    ),
    sql(
        "SELECT 'retail_orders_available_now' AS stream_name, 'SUCCEEDED' AS status,"
        f" COUNT(*) + {_TWICE} AS input_rows, true AS timed, true AS lag_known FROM src_order_events"
    ),
)


def failed_batch(x):
    """A batch that cannot be folded leaves a FAILED row and raises."""
    live = ls.LiveSales(x.spark, scratch_path(x.spark, "live"))
    try:
        live.process(x.source["order_events"].drop("order_total").withColumn("_bad", F.lit(1)), 7)
    except Exception:
        return live.metrics().select("microbatch_id", "status", (F.length("error_message") > 0).alias("has_message"))
    raise AssertionError("the broken batch was accepted")


R.add(
    "t10_failure_row",
    failed_batch,
    "SELECT CAST(7 AS BIGINT) AS microbatch_id, 'FAILED' AS status, COUNT(*) > 0 AS has_message FROM events",
)


def dropped(x):
    """Valid rows per channel, beside the number of rows each expectation rejected."""
    seen = Observation()
    kept = expect_or_drop(x.source["order_events"], ORDER_EVENT_RULES, seen).groupBy("channel").agg(
        F.count(F.lit(1)).alias("kept")
    )
    rows = kept.collect()  # three channels
    return x.spark.createDataFrame(
        [(r.channel, r.kept, seen.get["valid_channel"], seen.get["valid_amount"]) for r in rows],
        "channel string, kept long, bad_channel long, bad_amount long",
    )


R.add(
    "t11_expectations",
    dropped,
    sql(
        "SELECT channel, COUNT(*) AS kept, (SELECT COUNT(*) FROM src_order_events WHERE channel NOT IN"
        " ('web', 'mobile', 'store')) AS bad_channel, (SELECT COUNT(*) FROM src_order_events WHERE NOT"
        " (order_total > 0 AND discount_amount >= 0 AND discount_amount <= order_total)) AS bad_amount"
        f" FROM src_order_events WHERE {VALID} GROUP BY channel"
    ),
)

_MANAGED: dict[tuple[str, str], tuple] = {}


def managed_run(x):
    key = (x.spark.sparkContext.applicationId, x.folder)
    if key not in _MANAGED:
        landing, root = scratch_path(x.spark, "landing"), scratch_path(x.spark, "managed")
        feed(x, landing)
        _MANAGED[key] = (managed.run(x.spark, landing, root, 4), root)
    return _MANAGED[key]


R.add(
    "t12_managed_bronze",
    lambda x: x.spark.read.parquet(managed_run(x)[1] + "/orders_bronze_stream").select(*_EVENT_COLUMNS),
    S("SELECT * FROM valid_events"),
)
R.add(
    "t13_managed_silver",
    lambda x: x.spark.read.parquet(managed_run(x)[1] + "/orders_silver_stream").drop("_pipeline_ingested_at"),
    S(
        "SELECT event_id, order_id, customer_id, store_id, event_time, channel, order_total, discount_amount, tax_amount,"
        f" CAST({NET} AS DOUBLE) AS net_revenue, status AS order_status, source FROM valid_events"
    ),
)
R.add("t14_managed_minutes", lambda x: managed_run(x)[0].drop("last_updated"), S(kpis("valid_events")))
R.add(
    "t15_latest_minutes",
    lambda x: ls.latest_minutes(stream_run(x).gold()).drop("last_updated"),
    S(
        "SELECT event_minute, channel, order_count, unique_customers, revenue, avg_order_value FROM"
        f" ({kpis('latest_events')}) ORDER BY event_minute DESC, revenue DESC, channel LIMIT 30"
    ),
)
R.add(
    "t15_latest_batches",
    lambda x: ls.latest_batches(x.source["streaming_metrics"], "orders"),
    sql(
        "SELECT stream_name, microbatch_id, input_rows, processing_ms, event_lag_seconds, status, batch_finished_at"
        " FROM src_streaming_metrics ORDER BY microbatch_id DESC LIMIT 20"
    ),
)
