"""Table writes: overwrite, append, row counts, run log, catalog chores."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

LAYERS = ("bronze", "silver", "gold", "ml", "genai", "quality", "monitoring", "metrics", "realtime")
RUN_SCHEMA = (
    "run_id string, notebook string, layer string, status string, rows_written long, start_time timestamp,"
    " end_time timestamp, duration_seconds double, project_version string, environment string, error_message string"
)


def stamp(df: DataFrame, batch_id: str, run_id: str, at: dt.datetime) -> DataFrame:
    """Lineage columns of a load."""
    return df.withColumns({"_batch_id": F.lit(batch_id), "_run_id": F.lit(run_id), "_ingestion_ts": F.lit(at)})


def write_table(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = (), max_rows_per_file: int = 0
) -> int:
    """Write Parquet and return the rows written, counted during the write itself."""
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode)
    # a replaced table is replaced whole, whatever the session's partition setting
    writer = writer.option("partitionOverwriteMode", "static").option("maxRecordsPerFile", max_rows_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return seen.get["rows"]


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """Managed table laid out by a key that large tables are joined on again and again.

    Two tables with the same key and bucket count join without a shuffle.
    """
    df.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return df.sparkSession.table(name)


def write_chunks(chunks: Iterable[DataFrame], path: str) -> int:
    """First chunk replaces, the others append."""
    return sum(write_table(c, path, "append" if i else "overwrite") for i, c in enumerate(chunks))


def append_json(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_latest_and_history(df: DataFrame, latest: str, history: str) -> None:
    """Replace the latest results and add the same rows to the history."""
    write_table(df, latest)
    done = df.sparkSession.read.schema(df.schema).parquet(latest)
    write_table(done, history, "append")


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """A table whose appends may have added columns."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def with_missing_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Typed NULL columns for those an older table lacks."""
    absent = {c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns}
    return df.withColumns(absent) if absent else df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Column order and types of a declared table."""
    filled = with_missing_columns(df, {f.name: f.dataType.simpleString() for f in schema})
    return filled.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def create_table(spark: SparkSession, name: str, ddl: str, comment: str = "") -> None:
    """Managed Parquet table, if absent."""
    schema = name.rsplit(".", 1)[0] if "." in name else None
    if schema:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet")
    if comment:
        describe_tables(spark, {name: comment})


def add_column_if_missing(spark: SparkSession, name: str, column: str, kind: str) -> bool:
    if column in spark.table(name).columns:
        return False
    spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({column} {kind})")
    return True


def describe_tables(spark: SparkSession, comments: Mapping[str, str]) -> None:
    for name, text in comments.items():
        spark.sql(f"COMMENT ON TABLE {name} IS :text", args={"text": text})


def tables_exist(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    rows = [(n, spark.catalog.tableExists(n)) for n in names]
    return spark.createDataFrame(rows, "table_name string, present boolean")


def tables_per_layer(spark: SparkSession, layers: Sequence[str]) -> DataFrame:
    known = {d.name for d in spark.catalog.listDatabases()}
    rows = [
        (x, sum(not t.isTemporary for t in spark.catalog.listTables(x)) if x in known else 0) for x in layers
    ]
    return spark.createDataFrame(rows, "layer string, tables int")


def update_matched(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Target rows with the update's non-key columns where its key matches."""
    columns = [c for c in updates.columns if c != key]
    renamed = updates.select(key, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = target.join(renamed, key, "left")
    return joined.select(
        *[F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
          for c in target.columns]
    )


def upsert_rows(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch rows replace target rows of the same key; `batch` has one row per key."""
    kept = target.join(batch.select(*keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(batch.select(*target.columns))


def insert_absent(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """The batch rows whose key the target does not hold yet."""
    return batch.join(target.select(key), key, "left_anti").select(*batch.columns)


def run_row(
    spark: SparkSession, run_id: str, step: str, layer: str, status: str, rows: int, start: dt.datetime,
    end: dt.datetime, version: str = "1", environment: str = "spark", error: str = "",
) -> DataFrame:
    seconds = round((end - start).total_seconds(), 2)
    return spark.createDataFrame(
        [(run_id, step, layer, status, rows, start, end, seconds, version, environment, error[:1000])], RUN_SCHEMA
    )


@contextmanager
def logged_run(spark: SparkSession, log_path: str, run_id: str, step: str, layer: str):
    """Append one audit row when the step ends, also when it fails. Set `rows` on the yielded dict."""
    start = dt.datetime.now(dt.UTC).replace(tzinfo=None)
    state: dict[str, int] = {"rows": 0}

    def log(status: str, error: str = "") -> None:
        end = dt.datetime.now(dt.UTC).replace(tzinfo=None)
        run_row(spark, run_id, step, layer, status, state["rows"], start, end, error=error).write.mode(
            "append"
        ).parquet(log_path)

    try:
        yield state
    except Exception as e:
        log("FAILED", str(e))
        raise
    log("SUCCEEDED")
