"""Order events: schema, test feed, file source."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from martloom.functions import money as m
from martloom.functions.dates import seconds_before

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType(), False),
        T.StructField("order_id", T.StringType(), False),
        T.StructField("customer_id", T.StringType(), True),
        T.StructField("store_id", T.StringType(), True),
        T.StructField("event_time", T.TimestampType(), False),
        T.StructField("channel", T.StringType(), False),
        T.StructField("order_total", T.DoubleType(), False),
        T.StructField("discount_amount", T.DoubleType(), False),
        T.StructField("tax_amount", T.DoubleType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("source", T.StringType(), False),
    ]
)
MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def events_from_sequence(numbers: DataFrame, token: str, now: dt.datetime) -> DataFrame:
    """Order events computed from a `seq` column (0, 1, 2, ...)."""
    seq = F.col("seq")
    total = F.lit(2500) + (seq % 5000) * 37  # cents
    off = seq % 10  # percent
    hundredth = F.lit(100)
    padded = F.lpad(seq.cast("string"), 6, "0")
    return numbers.select(
        F.concat(F.lit(f"RTEVT_{token}_"), padded).alias("event_id"),
        F.concat(F.lit(f"RTORD_{token}_"), padded).alias("order_id"),
        F.concat(F.lit("C"), F.lpad((seq % 10000 + 1).cast("string"), 7, "0")).alias("customer_id"),
        F.concat(F.lit("STR"), F.lpad((seq % 50 + 1).cast("string"), 4, "0")).alias("store_id"),
        seconds_before(F.lit(now).cast("timestamp"), seq % 60).alias("event_time"),
        F.when(seq % 3 == 0, "web").when(seq % 3 == 1, "mobile").otherwise("store").alias("channel"),
        m.dollars(total).alias("order_total"),
        m.dollars(m.divide(total * off, hundredth)).alias("discount_amount"),
        m.dollars(m.divide(total * (hundredth - off) * 8, hundredth * 100)).alias("tax_amount"),
        F.lit("Completed").alias("status"),
        F.lit("sequence_feed").alias("source"),
    )


def land(events: DataFrame, path: str) -> None:
    """Add events to the landing folder as JSON files."""
    typed = events.withColumn("event_time", F.col("event_time").cast("timestamp"))
    typed.write.mode("append").option("timestampFormat", MICROS).json(path)


def event_stream(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", files_per_trigger).json(path)
