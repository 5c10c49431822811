"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Runtime settings every plan here relies on. All of them can be changed on a
# live session, so `configure` also works on a session somebody else built.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # Casts and sums that do not fit raise errors.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split hot join keys even when that costs an extra shuffle afterwards.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Folders of a partitioned table are listed in so many tasks at most, not in one task each.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def get_session(app: str = "martloom", master: str | None = None, **conf: str) -> SparkSession:
    """Build a session. Size-dependent settings come from the cluster or `conf`."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, as named by the cluster.

    A folder of our own is made only where the setting is missing and everything runs
    on this machine (tests); on a cluster a missing setting is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="martloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/martloom/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage through a written table in the shared folder.

    The rows survive the loss of any executor, and values that depend on the
    physical layout (a partition number) stay what they were when written.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_model(spark: SparkSession, model, label: str):
    """A fitted model written to the shared folder and read back.

    The copy has no training summary. A summary holds the session, and a session
    that has run an Observation cannot be sent to tasks along with the model.
    """
    path = scratch_path(spark, label)
    model.write().save(path)
    return type(model).load(path)


def no_rows(spark: SparkSession, schema: str | T.StructType) -> DataFrame:
    """An empty table that the optimizer knows to be empty: joins with it vanish, and no Python worker is started for it."""
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return spark.range(0).where("false").select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the actions inside are deleted as each action ends.

    Otherwise they stay until the driver happens to collect garbage, and jobs that follow each other add up on disk. Frames
    that are made inside are meant for one action: a second one computes them again.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def path_exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def delete_path(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
