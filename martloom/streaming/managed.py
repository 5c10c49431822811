"""Declarative order stream: bronze with expectations -> silver -> minute KPIs.

The KPIs are a stream as well: every micro-batch of silver is folded into sums by minute
and channel, and into a multiset of customers, which are kept in partitions. No watermark
is needed, so a row counts however late it comes; memory holds a batch, never the state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from martloom.functions import money as m
from martloom.streaming.events import EVENT_SCHEMA, event_stream
from martloom.streaming.expectations import NET_REVENUE_RULES, ORDER_EVENT_RULES, expect_or_drop
from martloom.streaming.live_sales import (
    GOLD_SCHEMA, add_to_sums, minute_kpis, read_or_empty, refresh_gold, slot, slots_of,
)

BRONZE_SCHEMA = T.StructType([*EVENT_SCHEMA.fields, T.StructField("_pipeline_ingested_at", T.TimestampType())])

#: What the KPIs take from silver. Every job on a micro-batch reads all columns that the stream has.
KPI_COLUMNS = ("event_time", "channel", "customer_id", "order_total", "discount_amount", "net_revenue", "_pipeline_ingested_at")


def bronze_rows(events: DataFrame) -> DataFrame:
    return expect_or_drop(events, ORDER_EVENT_RULES, "bronze_expectations").withColumn(
        "_pipeline_ingested_at", F.current_timestamp()
    )


def silver_rows(bronze: DataFrame) -> DataFrame:
    net = m.dollars(m.cents("order_total") - m.cents("discount_amount"))
    typed = bronze.select(
        "event_id", "order_id", "customer_id", "store_id", "event_time", "channel", "order_total", "discount_amount",
        "tax_amount", net.alias("net_revenue"), F.col("status").alias("order_status"), "source", "_pipeline_ingested_at",
    )
    return expect_or_drop(typed, NET_REVENUE_RULES, "silver_expectations")


def live_sales_minute(silver: DataFrame) -> DataFrame:
    """The KPIs in one pass over all of silver: what the stream's sums amount to."""
    return minute_kpis(silver, F.max("_pipeline_ingested_at"))


def _append(df: DataFrame, path: str, checkpoint: str, name: str) -> StreamingQuery:
    return (
        df.writeStream.queryName(name)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .format("parquet")
        .start(path)
    )


def fold_minutes(spark: SparkSession, root: str, silver: DataFrame, batch_id: int) -> None:
    """Fold a micro-batch of silver rows into the sums and renew the KPIs of the slots it touches."""
    hours = silver.select(F.date_trunc("hour", "event_time").alias("hour")).distinct()
    slots = slots_of(hours.select(slot("hour").alias("event_slot")))
    if slots:
        add_to_sums(spark, root, silver.withColumn("sign", F.lit(1)), batch_id, F.col("_pipeline_ingested_at"), slots)
        refresh_gold(spark, root, f"{root}/live_sales_minute", slots)


def run(spark: SparkSession, landing: str, root: str, files_per_trigger: int = 100) -> DataFrame:
    """Bring both streaming tables and the minute KPIs up to date and return the KPIs."""
    bronze, silver = f"{root}/orders_bronze_stream", f"{root}/orders_silver_stream"
    _append(bronze_rows(event_stream(spark, landing, files_per_trigger)), bronze, f"{root}/_bronze_cp",
            "orders_bronze_stream").awaitTermination()
    source = spark.readStream.schema(BRONZE_SCHEMA).parquet(bronze)
    query = _append(silver_rows(source), silver, f"{root}/_silver_cp", "orders_silver_stream")
    query.awaitTermination()
    minutes = (
        spark.readStream.schema(_silver_schema()).parquet(silver).select(*KPI_COLUMNS)
        .writeStream.queryName("live_sales_minute")
        .foreachBatch(lambda batch, batch_id: fold_minutes(spark, root, batch, batch_id))
        .option("checkpointLocation", f"{root}/_minute_cp")
        .trigger(availableNow=True)
        .start()
    )
    minutes.awaitTermination()
    return read_or_empty(spark, f"{root}/live_sales_minute", GOLD_SCHEMA).drop("event_slot")


def _silver_schema() -> str:
    return (
        "event_id string, order_id string, customer_id string, store_id string, event_time timestamp, channel string,"
        " order_total double, discount_amount double, tax_amount double, net_revenue double, order_status string,"
        " source string, _pipeline_ingested_at timestamp"
    )
