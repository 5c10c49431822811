"""Keyed state of a stream in plain Parquet: an index by hash bucket, and retractable sums by partition.

Both survive a batch that fails half-way and is run again under the same number, which is
how the stream repeats it: an index entry belongs to its batch, and a sum keeps the value
it had before the last batch that changed it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martloom.session import delete_path, no_rows, path_exists


def read_parts(spark: SparkSession, root: str, schema: str, parts: Sequence[str]) -> DataFrame:
    """The named partition folders of a table, those that exist; no other folder is listed or read."""
    found = existing_parts(spark, root, parts)
    if not found:
        return no_rows(spark, schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*found)


def existing_parts(spark: SparkSession, root: str, parts: Sequence[str]) -> list[str]:
    """Paths of the named folders that exist. A batch can touch thousands, so the file system is looked up once."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path(root)):
        return []
    return [f"{root}/{p}" for p in parts if system.exists(path(f"{root}/{p}"))]


def folder_names(spark: SparkSession, path: str) -> list[str]:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in system.listStatus(folder)) if system.exists(folder) else []


def write_parts(df: DataFrame, path: str, *parts: str) -> None:
    """Replace the partitions that `df` holds rows of, and no others."""
    rows = df.hint("rebalance", *parts)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)


@dataclass
class KeyIndex:
    """key -> value in hash buckets. A batch reads and extends the buckets of its own keys only.

    Every batch adds a folder to each of its buckets. Once a bucket has more than
    `fold_after` folders, those of earlier batches are put together, so that the number of
    files a look-up opens stays the same however long the stream runs. A key that is put
    again has the value of the latest batch. A null key is neither kept nor found.
    """

    spark: SparkSession
    path: str
    key: str
    value: str | None = None
    buckets: int = 64
    fold_after: int = 8

    @property
    def _schema(self) -> str:
        return f"{self.key} string, value string, seq long, bucket int, batch long"

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def buckets_of(self, keys: DataFrame) -> list[int]:
        """At most `buckets` numbers, whatever the size of the batch."""
        return sorted(r[0] for r in keys.select(self._bucket()).distinct().collect())

    def read(self, buckets: Sequence[int], but: int | None = None) -> DataFrame:
        entries = read_parts(self.spark, self.path, self._schema, [f"bucket={b}" for b in buckets])
        return entries if but is None else entries.where(F.col("batch") != but)

    def find(self, keys: DataFrame, but: int | None = None) -> DataFrame:
        """(key, value) of the keys that are held; `but` leaves out what that batch has put."""
        return self._latest(self._held(keys, but)).select(self.key, F.col("last.value").alias(self.value or "value"))

    def known(self, keys: DataFrame, but: int | None = None) -> DataFrame:
        """The keys that are held, without their values; a key can come several times."""
        return self._held(keys, but).select(self.key)

    def _held(self, keys: DataFrame, but: int | None) -> DataFrame:
        return self.read(self.buckets_of(keys), but).join(keys.select(self.key), self.key, "left_semi")

    def _latest(self, entries: DataFrame) -> DataFrame:
        return entries.groupBy(self.key).agg(F.max(F.struct("seq", "value")).alias("last"))

    def put(self, rows: DataFrame, batch: int) -> None:
        value = F.col(self.value) if self.value else F.lit(None).cast("string")
        entries = rows.where(F.col(self.key).isNotNull()).select(
            self.key, value.alias("value"), F.lit(batch).cast("long").alias("seq"), self._bucket().alias("bucket"),
            F.lit(batch).cast("long").alias("batch"),
        )
        write_parts(entries, self.path, "bucket", "batch")

    def fold(self, batch: int) -> None:
        """Put together what batches before `batch` have added to buckets with too many folders.

        Looks every `fold_after` batches, so a bucket has twice as many folders at most. The folded entries are written before the old ones go. A failure in between leaves
        entries twice, which changes no look-up.
        """
        old = {}
        if batch % self.fold_after:
            return
        for bucket in range(self.buckets):
            names = folder_names(self.spark, f"{self.path}/bucket={bucket}")
            mine = [n for n in names if n.startswith("batch=") and int(n[6:]) < batch and int(n[6:]) != -batch]
            if len(mine) > self.fold_after:
                old[bucket] = mine
        if not old:
            return
        entries = self.read(list(old)).where(F.col("batch") < batch)
        folded = entries.groupBy(self.key, "bucket").agg(F.max(F.struct("seq", "value")).alias("last"))
        write_parts(
            folded.select(self.key, "last.value", "last.seq", "bucket", F.lit(-batch).cast("long").alias("batch")),
            self.path, "bucket", "batch",
        )
        for bucket, names in old.items():
            for name in names:
                delete_path(self.spark, f"{self.path}/bucket={bucket}/{name}")


def state_schema(keys: str, measures: Sequence[str], parts: str) -> str:
    values = ", ".join(f"{m} long, before_{m} long" for m in measures)
    return f"{keys}, {values}, batch long, updated timestamp, {parts}"


def add_deltas(
    spark: SparkSession, path: str, schema: str, delta: DataFrame, keys: Sequence[str], measures: Sequence[str],
    parts: Sequence[str], batch: int,
) -> DataFrame:
    """Add signed `measures` to the sums by `keys` and return the rows that the batch changed."""
    names = touched_parts(delta, parts)
    fold_deltas(spark, path, schema, delta, keys, measures, parts, batch, names)
    return changed_rows(spark, path, schema, batch, names)


def changed_rows(spark: SparkSession, path: str, schema: str, batch: int, names: Sequence[str]) -> DataFrame:
    """The rows of the named folders that the batch changed."""
    return read_parts(spark, path, schema, names).where(F.col("batch") == batch)


def fold_deltas(
    spark: SparkSession, path: str, schema: str, delta: DataFrame, keys: Sequence[str], measures: Sequence[str],
    parts: Sequence[str], batch: int, names: Sequence[str],
) -> None:
    """Add signed `measures` to the sums by `keys`. `names` are the folders of the partitions of `delta`.

    `delta` has the keys, the measures and the time `updated`, of which a sum keeps the latest.

    Only the partitions with a change are read and written. Rows whose first measure, a
    count, has come down to 0 stay for the batch that did it, in case it runs again.
    """
    state = read_parts(spark, path, schema, names)
    mine = F.col("batch") == batch
    none = F.lit(None).cast("long")
    old = state.select(
        *keys, *parts, F.lit(False).alias("hit"),
        *[F.when(mine, F.col(f"before_{m}")).otherwise(F.col(m)).alias(m) for m in measures],
        *[F.col(f"before_{m}").alias(f"before_{m}") for m in measures], "batch", "updated",
    )
    new = delta.select(
        *keys, *parts, F.lit(True).alias("hit"), *measures, *[none.alias(f"before_{m}") for m in measures],
        none.alias("batch"), "updated",
    )
    summed = old.unionByName(new).groupBy(*keys, *parts).agg(
        F.max("hit").alias("hit"),
        *[F.sum(m).alias(m) for m in measures],
        *[F.coalesce(F.sum(F.when(~F.col("hit"), F.col(m))), F.lit(0)).alias(f"base_{m}") for m in measures],
        *[F.max(f"before_{m}").alias(f"before_{m}") for m in measures],
        F.max("batch").alias("batch"), F.max("updated").alias("updated"),
    )
    after = summed.select(
        *keys, *measures,
        *[F.when(F.col("hit"), F.col(f"base_{m}")).otherwise(F.col(f"before_{m}")).alias(f"before_{m}") for m in measures],
        F.when(F.col("hit"), F.lit(batch)).otherwise(F.col("batch")).cast("long").alias("batch"),
        "updated", *parts,
    )
    write_parts(after.where((F.col(measures[0]) != 0) | (F.col("batch") == batch)), path, *parts)


def touched_parts(df: DataFrame, parts: Sequence[str]) -> list[str]:
    """Folder names of the partitions of `df`: names, not data."""
    rows = df.select(*parts).distinct().collect()
    return sorted("/".join(f"{p}={r[p]}" for p in parts) for r in rows)
