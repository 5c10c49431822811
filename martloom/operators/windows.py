"""Order-dependent operators that stay spread out.

A window function gathers a whole group in one task, and a window without
groups gathers the whole table. The operators here cut the sorted data into
ranges instead: one range per task, a small table of range totals, and each
range shifted by the total of those before it. A hot group is simply cut into
several ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from martloom.session import materialize

SLICE = "_slice"


def ordered_slices(df: DataFrame, order: Sequence[Column], slices: int | None = None) -> DataFrame:
    """Rows cut into ranges of the sort order; `_slice` numbers the ranges in that order.

    The numbered rows are written out, because a range number recomputed after
    a lost executor could differ from the one already used.
    """
    n = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).withColumn(SLICE, F.spark_partition_id())
    return materialize(ranged, "slices")


def _shifted(sliced: DataFrame, keys: Sequence[str], amount: Column, within: Column, out: str) -> DataFrame:
    """`within` (a running value inside a slice) plus the `amount` of all earlier slices per key."""
    totals = sliced.groupBy(SLICE, *keys).agg(amount.alias("_amount"))
    earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    # At most one row per (key, slice): bounded by the number of slices for any one key.
    offsets = totals.select(SLICE, *keys, F.sum("_amount").over(earlier).alias("_before"))
    same = [F.col(f"s.{k}").eqNullSafe(F.col(f"o.{k}")) for k in (SLICE, *keys)]
    joined = sliced.withColumn(out, within).alias("s").join(offsets.alias("o"), same, "left")
    value = F.col(f"s.{out}") + F.coalesce(F.col("o._before"), F.lit(0))
    return joined.select(*[F.col(f"s.{c}") for c in sliced.columns if c != SLICE], value.alias(out))


def running_total(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: str, out: str
) -> DataFrame:
    """Running sum of `value` per key in sort order, up to and including each row."""
    sliced = ordered_slices(df, [*[F.col(k) for k in keys], *order])
    inside = Window.partitionBy(SLICE, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return _shifted(sliced, keys, F.sum(value), F.sum(value).over(inside), out)


def numbered(df: DataFrame, order: Sequence[Column], out: str = "position") -> DataFrame:
    """Row number over the whole table."""
    sliced = ordered_slices(df, order)
    inside = Window.partitionBy(SLICE).orderBy(*order)
    return _shifted(sliced, [], F.count(F.lit(1)), F.row_number().over(inside).cast("bigint"), out)


def numbered_top(df: DataFrame, order: Sequence[Column], k: int, out: str = "position") -> DataFrame:
    """The first k rows and their numbers. Only k rows ever meet in one task."""
    return df.orderBy(*order).limit(k).withColumn(out, F.row_number().over(Window.orderBy(*order)))


def latest_by_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by `order`, then by the remaining columns.

    A maximum combines before the shuffle, so a key with very many versions
    sends one row per task instead of all of them.
    """
    rest = [c for c in df.columns if c != key and c not in order]
    best = F.max(F.struct(*order, *rest)).alias("best")
    picked = df.groupBy(key).agg(best)
    return picked.select(*[F.col(key) if c == key else F.col(f"best.{c}").alias(c) for c in df.columns])


def latest_of_many(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """What `latest_by_key` returns, for keys with many versions.

    A maximum over whole rows sorts all of them in every task. Here a pass over two
    columns finds the greatest first `order` value of each key, by hashing, and only
    the rows that have it are compared as a whole.
    """
    best = df.groupBy(F.col(key).alias("_key")).agg(F.max(order[0]).alias("_best"))
    same = F.col(key).eqNullSafe(F.col("_key")) & F.col(order[0]).eqNullSafe(F.col("_best"))
    return latest_by_key(df.join(best, same, "left_semi"), key, order)


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """k rows per group. Spark keeps k per group in every task before it shuffles."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= k).drop("_n")
