"""Incremental order stream: files -> bronze -> silver (latest per order) -> minute KPIs.

Plain Parquet has no MERGE, so an upsert rewrites the time slots it touches and
no others. What a batch has to know about the past comes from indexes, not from the
tables: which event ids are known, and in which slot an order lies. The KPIs follow from
what the batch adds and takes away, so the other rows of a slot are not read again. Each step
gives the same tables when a batch is run again, which is what the stream does after a failure.
"""

from __future__ import annotations

import datetime as dt
import time
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from martloom.functions import money as m
from martloom.functions.dates import minute
from martloom.operators.windows import latest_by_key, latest_of_many
from martloom.session import configure, delete_path, no_rows, path_exists
from martloom.sources.sinks import insert_absent, upsert_rows
from martloom.streaming.events import EVENT_SCHEMA, event_stream
from martloom.streaming.key_index import (
    KeyIndex, changed_rows, fold_deltas, folder_names, read_parts, state_schema, write_parts,
)

BRONZE_SCHEMA = T.StructType([*EVENT_SCHEMA.fields, T.StructField("_ingestion_ts", T.TimestampType()),
                              T.StructField("_microbatch_id", T.LongType())])
SILVER_SCHEMA = (
    "order_id string, customer_id string, store_id string, event_time timestamp, channel string, order_total double,"
    " discount_amount double, tax_amount double, net_revenue double, order_status string, source string,"
    " _microbatch_id long, _processed_at timestamp, event_slot string"
)
GOLD_SCHEMA = (
    "event_minute timestamp, channel string, order_count long, unique_customers long, gross_sales double,"
    " discounts double, revenue double, avg_order_value double, last_updated timestamp, event_slot string"
)
#: +1: the row enters the table, -1: it leaves.
CHANGE_SCHEMA = SILVER_SCHEMA + ", sign int"
MINUTE = "event_minute timestamp, channel string"
ORDERS = ("orders", "gross", "discounts", "net", "gross_known", "discounts_known", "net_known")
#: Folder of the counts of orders by minute, channel and customer.
CUSTOMERS = "customers_by_slot"
TOTAL_SCHEMA = state_schema(MINUTE, (*ORDERS, "customers"), "event_slot string")
CUSTOMER_SCHEMA = state_schema(MINUTE + ", customer_id string", ("orders",), "event_slot string")
METRIC_SCHEMA = (
    "input_rows long, bronze_rows long, silver_rows long, batch_started_at timestamp, batch_finished_at timestamp,"
    " processing_ms long, event_lag_seconds double, status string, error_message string, stream_name string,"
    " microbatch_id long"
)


# Size of a rewritten partition: days by default, hours for streams with very many orders per day.
SLOTS = {"day": "yyyy-MM-dd", "hour": "yyyy-MM-dd-HH"}


NO_TIME = "unknown"


def slot(ts, grain: str = "day") -> Column:
    # rows without a readable time need a slot that a filter on slots can name
    return F.coalesce(F.date_format(ts, SLOTS[grain]), F.lit(NO_TIME))


def read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return no_rows(spark, schema)


def silver_orders(events: DataFrame, processed_at: Column, grain: str = "day") -> DataFrame:
    """One row per order: its latest event in the batch."""
    latest = latest_of_many(events, "order_id", ["event_time", "event_id"])
    net = m.dollars(m.cents("order_total") - m.cents("discount_amount"))
    return latest.select(
        "order_id", "customer_id", "store_id", "event_time", "channel", "order_total", "discount_amount", "tax_amount",
        net.alias("net_revenue"), F.col("status").alias("order_status"), "source", "_microbatch_id",
        processed_at.alias("_processed_at"), slot("event_time", grain).alias("event_slot"),
    )


def minute_kpis(silver: DataFrame, last_updated: Column) -> DataFrame:
    """Sales per minute and channel."""
    return silver.groupBy(minute("event_time").alias("event_minute"), "channel").agg(
        F.count(F.lit(1)).alias("order_count"),
        F.count_distinct("customer_id").alias("unique_customers"),
        m.dollars(m.total("order_total")).alias("gross_sales"),
        m.dollars(m.total("discount_amount")).alias("discounts"),
        m.dollars(m.total("net_revenue")).alias("revenue"),
        m.mean_cents(m.total("net_revenue"), F.count("net_revenue")).alias("avg_order_value"),
        last_updated.alias("last_updated"),
    )


def accepted_rows(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """Batch rows that are new or at least as recent as the stored row of the same order."""
    newest = stored.groupBy("order_id").agg(F.max("event_time").alias("_stored_at"))
    joined = batch.join(newest, "order_id", "left")
    newer = F.col("_stored_at").isNull() | (F.col("event_time") >= F.col("_stored_at"))
    return joined.where(newer).drop("_stored_at")


def changes_of(accepted: DataFrame, stored: DataFrame) -> DataFrame:
    """What a batch does to silver: accepted rows enter, the stored rows of the same orders leave."""
    leaving = stored.join(accepted.select("order_id"), "order_id", "left_semi").select(*accepted.columns)
    return accepted.withColumn("sign", F.lit(1)).unionByName(leaving.withColumn("sign", F.lit(-1)))


def order_deltas(changes: DataFrame, at: Column, grain: str = "day") -> DataFrame:
    """Signed counts and sums in cents by minute and channel; `at` is the time of a change."""
    sums, known = [], []
    for column, name in (("order_total", "gross"), ("discount_amount", "discounts"), ("net_revenue", "net")):
        sums.append(F.coalesce(F.sum(m.cents(column) * F.col("sign")), F.lit(0)).alias(name))
        known.append(F.sum(F.when(F.col(column).isNotNull(), F.col("sign")).otherwise(0)).alias(f"{name}_known"))
    grouped = _by_minute(changes).agg(F.sum("sign").alias("orders"), *sums, *known, F.max(at).alias("updated"))
    return grouped.withColumn("event_slot", slot("event_minute", grain))


def _by_minute(changes: DataFrame, *more: str):
    # a minute lies in one slot, so the slot is found once for each group
    return changes.withColumn("event_minute", minute("event_time")).groupBy("event_minute", "channel", *more)


def customer_deltas(changes: DataFrame, at: Column, grain: str = "day") -> DataFrame:
    """Signed counts of orders by minute, channel and customer: a multiset, so that the last order takes the customer away."""
    known = _by_minute(changes.where("customer_id IS NOT NULL"), "customer_id")
    counted = known.agg(F.sum("sign").alias("orders"), F.max(at).alias("updated"))
    return counted.withColumn("event_slot", slot("event_minute", grain))


def gold_rows(totals: DataFrame) -> DataFrame:
    def amount(name: str) -> Column:
        return F.when(F.col(f"{name}_known") > 0, m.dollars(F.col(name)))

    return totals.where("orders > 0").select(
        "event_minute", "channel", F.col("orders").alias("order_count"), F.col("customers").alias("unique_customers"),
        amount("gross").alias("gross_sales"), amount("discounts").alias("discounts"), amount("net").alias("revenue"),
        m.mean_cents(F.col("net"), F.col("net_known")).alias("avg_order_value"), F.col("updated").alias("last_updated"),
        "event_slot",
    )


def slots_of(df: DataFrame, column: str = "event_slot") -> list[str]:
    """Distinct slots of a batch: partition names, not data."""
    return sorted(r[0] for r in df.select(column).distinct().collect())


def replace_slots(spark: SparkSession, merged: DataFrame, path: str, slots: list[str]) -> None:
    """Put the merged rows in place of the given slots, and drop the slots that became empty.

    The old files of a slot are removed only when the job that read them commits.
    """
    seen = Observation()
    # rebalancing gathers a slot into few files but still splits a slot that is too large for one task
    rows = merged.hint("rebalance", "event_slot").observe(seen, F.collect_set("event_slot").alias("filled"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_slot").parquet(path)
    for name in set(slots) - set(seen.get["filled"]):
        delete_path(spark, f"{path}/event_slot={name}")


def add_to_sums(
    spark: SparkSession, root: str, changes: DataFrame, batch_id: int, at: Column, slots: list[str], grain: str = "day"
) -> None:
    """Fold signed silver rows of the given slots into the sums by minute and channel; running a batch again changes nothing."""
    root, by_minute, measures = root.rstrip("/"), ["event_minute", "channel"], [*ORDERS, "customers"]
    names, customers = [f"event_slot={s}" for s in slots], f"{root}/{CUSTOMERS}"
    adopt_customers(spark, root)
    fold_deltas(spark, customers, CUSTOMER_SCHEMA, customer_deltas(changes, at, grain), [*by_minute, "customer_id"], ["orders"],
                ["event_slot"], batch_id, names)
    counted = changed_rows(spark, customers, CUSTOMER_SCHEMA, batch_id, names)
    there = (F.col("orders") > 0).cast("long") - (F.coalesce("before_orders", F.lit(0)) > 0).cast("long")
    come = counted.groupBy("event_slot", *by_minute).agg(F.sum(there).alias("customers"))
    sums = order_deltas(changes, at, grain).withColumn("customers", F.lit(0)).unionByName(come, allowMissingColumns=True)
    delta = sums.groupBy("event_slot", *by_minute).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in measures], F.max("updated").alias("updated")
    )
    fold_deltas(spark, f"{root}/totals", TOTAL_SCHEMA, delta, by_minute, measures, ["event_slot"], batch_id, names)


def adopt_customers(spark: SparkSession, root: str) -> None:
    """Counts by customer that were written in eight folders for each slot; they now have one.

    The old folders go last, so a failure in between leaves them or a whole copy.
    """
    old, new = f"{root}/customers", f"{root}/{CUSTOMERS}"
    if path_exists(spark, old):
        if not path_exists(spark, f"{new}/_SUCCESS"):
            kept = spark.read.schema(CUSTOMER_SCHEMA + ", kpi_bucket int").parquet(old).drop("kpi_bucket")
            write_parts(kept, new, "event_slot")
        delete_path(spark, old)


def refresh_gold(spark: SparkSession, root: str, gold: str, slots: list[str]) -> None:
    """The KPI rows of the slots, from the sums: one row for each minute and channel."""
    totals = read_parts(spark, f"{root.rstrip('/')}/totals", TOTAL_SCHEMA, [f"event_slot={s}" for s in slots])
    replace_slots(spark, gold_rows(totals), gold, slots)


@dataclass
class LiveSales:
    """The stream's tables under one folder, and the function that folds a batch into them."""

    spark: SparkSession
    root: str
    stream_name: str = "retail_orders_available_now"
    grain: str = "day"
    paths: dict[str, str] = field(init=False)

    def __post_init__(self) -> None:
        configure(self.spark)
        names = ("bronze", "silver", "gold", "metrics", "checkpoint", "changes", "totals", "work")
        self.paths = {n: f"{self.root.rstrip('/')}/{n}" for n in names}
        self.paths["customers"] = f"{self.root.rstrip('/')}/{CUSTOMERS}"
        self.events = KeyIndex(self.spark, f"{self.root.rstrip('/')}/event_index", "event_id")
        self.slots = KeyIndex(self.spark, f"{self.root.rstrip('/')}/order_index", "order_id", "event_slot")

    def bronze(self) -> DataFrame:
        return read_or_empty(self.spark, self.paths["bronze"], BRONZE_SCHEMA)

    def silver(self) -> DataFrame:
        return read_or_empty(self.spark, self.paths["silver"], SILVER_SCHEMA)

    def gold(self) -> DataFrame:
        return read_or_empty(self.spark, self.paths["gold"], GOLD_SCHEMA)

    def metrics(self) -> DataFrame:
        return read_or_empty(self.spark, self.paths["metrics"], METRIC_SCHEMA)

    def run(self, landing: str, files_per_trigger: int = 100) -> None:
        """Process everything that has landed since the last run, then stop."""
        query = (
            event_stream(self.spark, landing, files_per_trigger)
            .writeStream.queryName(self.stream_name)
            .foreachBatch(self.process)
            .option("checkpointLocation", self.paths["checkpoint"])
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    def process(self, batch: DataFrame, batch_id: int) -> None:
        started, clock = _now(), time.perf_counter()
        counts = {"input_rows": 0, "bronze_rows": 0, "silver_rows": 0}
        try:
            newest = self._fold(batch, int(batch_id), counts)
            if counts["input_rows"] == 0:
                return
            lag = max(0.0, (_now() - newest).total_seconds()) if newest else 0.0
            self._record(batch_id, counts, started, clock, lag, "SUCCEEDED", "")
        except Exception as e:
            self._record(batch_id, counts, started, clock, None, "FAILED", str(e)[:1000])
            raise

    def _fold(self, batch: DataFrame, batch_id: int, counts: dict[str, int]) -> dt.datetime | None:
        self._adopt_tables()
        stamped = batch.withColumns(
            {"_ingestion_ts": F.current_timestamp(), "_microbatch_id": F.lit(batch_id).cast("long")}
        )
        staged = self._one_per_event(self._stage(stamped, "input"))
        seen = staged.agg(F.count(F.lit(1)), F.max("event_time")).first()
        counts["input_rows"] = seen[0]
        if seen[0]:
            counts["bronze_rows"] = self._add_to_bronze(staged, batch_id)
            counts["silver_rows"] = self._update_silver_and_gold(staged, batch_id)
        delete_path(self.spark, self.paths["work"])
        return seen[1]

    def _one_per_event(self, rows: DataFrame) -> DataFrame:
        """The latest row of each event id. Whole rows are shuffled and sorted only where an id may come twice in the batch."""
        digest = F.xxhash64("event_id").alias("_digest")
        repeated = rows.groupBy(digest).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_digest")
        repeated = self._stage(repeated, "repeated")
        if repeated.isEmpty():
            return rows
        marked = rows.withColumn("_digest", digest)
        once = marked.join(repeated, "_digest", "left_anti").select(*rows.columns)
        again = marked.join(repeated, "_digest", "left_semi").select(*rows.columns)
        return self._stage(once.unionByName(latest_by_key(again, "event_id", ["event_time"])), "batch")

    def _stage(self, df: DataFrame, label: str) -> DataFrame:
        """A written copy that lasts for this batch."""
        path = f"{self.paths['work']}/{label}"
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _adopt_tables(self) -> None:
        """Indexes and sums for tables that were written without them."""
        if path_exists(self.spark, self.paths["silver"]) and not path_exists(self.spark, self.paths["changes"]):
            for path in (self.events.path, self.slots.path, self.paths["totals"], self.paths["customers"], f"{self.root}/customers"):
                delete_path(self.spark, path)
            self.events.put(self.bronze(), -1)
            self.slots.put(self.silver(), -1)
            self._add_to_sums(self.silver().withColumn("sign", F.lit(1)), -1, slots_of(self.silver()))

    def _add_to_bronze(self, staged: DataFrame, batch_id: int) -> int:
        # the batch owns its partition and its index entries, so running it again replaces its own rows only
        self.events.fold(batch_id)
        known = self.events.known(staged, but=batch_id)
        part = f"_microbatch_id={batch_id}"
        insert_absent(known, staged, "event_id").drop("_microbatch_id").write.mode("overwrite").option(
            "partitionOverwriteMode", "static"
        ).parquet(f"{self.paths['bronze']}/{part}")
        fresh = read_parts(self.spark, self.paths["bronze"], BRONZE_SCHEMA, [part])
        self.events.put(fresh, batch_id)
        return fresh.count()

    def _update_silver_and_gold(self, staged: DataFrame, batch_id: int) -> int:
        changes = self._plan_changes(staged, batch_id)
        found = changes.groupBy("event_slot").agg(F.count_if(F.col("sign") > 0)).collect()  # one row for each slot
        slots = sorted(r[0] for r in found)
        if slots:
            accepted = changes.where("sign > 0").drop("sign")
            replace_slots(self.spark, upsert_rows(self._silver_of(slots), accepted, ["order_id"]), self.paths["silver"], slots)
            self.slots.fold(batch_id)
            self.slots.put(accepted, batch_id)
            self._add_to_sums(changes, batch_id, slots)
            self._refresh_gold(slots)
        return sum(r[1] for r in found)

    def _plan_changes(self, staged: DataFrame, batch_id: int) -> DataFrame:
        """Rows that enter and leave silver. Written before any table changes; a batch that is run again finds its plan."""
        path = f"{self.paths['changes']}/batch={batch_id}"
        if not path_exists(self.spark, f"{path}/_SUCCESS"):
            rows = self._stage(silver_orders(staged, F.current_timestamp(), self.grain), "orders")
            lying_in = self.slots.find(rows)
            stored = self._silver_of(slots_of(lying_in)).join(rows.select("order_id"), "order_id", "left_semi")
            stored = self._stage(stored.select(*rows.columns), "stored")
            accepted = self._stage(accepted_rows(rows, stored), "accepted")
            changes_of(accepted, stored).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
        for name in folder_names(self.spark, self.paths["changes"]):
            if name != f"batch={batch_id}":
                delete_path(self.spark, f"{self.paths['changes']}/{name}")
        return self.spark.read.schema(CHANGE_SCHEMA).parquet(path)

    def _silver_of(self, slots: list[str]) -> DataFrame:
        return read_parts(self.spark, self.paths["silver"], SILVER_SCHEMA, [f"event_slot={s}" for s in slots])

    def _add_to_sums(self, changes: DataFrame, batch_id: int, slots: list[str]) -> None:
        add_to_sums(self.spark, self.root, changes, batch_id, F.current_timestamp(), slots, self.grain)

    def _refresh_gold(self, slots: list[str]) -> None:
        refresh_gold(self.spark, self.root, self.paths["gold"], slots)

    def _record(self, batch_id, counts, started, clock, lag, status, error) -> None:
        ms = int((time.perf_counter() - clock) * 1000)
        row = (counts["input_rows"], counts["bronze_rows"], counts["silver_rows"], started, _now(), ms, lag, status, error,
               self.stream_name, int(batch_id))
        # one partition per (stream, batch): writing it again replaces it
        self.spark.createDataFrame([row], METRIC_SCHEMA).coalesce(1).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("stream_name", "microbatch_id").parquet(self.paths["metrics"])


def _now() -> dt.datetime:
    return dt.datetime.now(dt.UTC).replace(tzinfo=None)


def latest_minutes(gold: DataFrame, k: int = 30) -> DataFrame:
    best = gold.orderBy(F.desc("event_minute"), F.desc("revenue"), F.asc("channel")).limit(k)
    return best.select("event_minute", "channel", "order_count", "unique_customers", "revenue", "avg_order_value",
                       "last_updated")


def latest_batches(metrics: DataFrame, stream_name: str, k: int = 20) -> DataFrame:
    mine = metrics.where(F.col("stream_name") == stream_name).orderBy(F.desc("microbatch_id")).limit(k)
    return mine.select("stream_name", "microbatch_id", "input_rows", "processing_ms", "event_lag_seconds", "status",
                       "batch_finished_at")
