"""Joins named by what they keep.

No side is hinted: Spark broadcasts only what it has measured to be small, and
splits hot keys of larger joins at run time (see `martloom.session`).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

Keys = str | Sequence[str]


def _keys(keys: Keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def match(left: DataFrame, right: DataFrame, keys: Keys) -> DataFrame:
    return left.join(right, _keys(keys), "inner")


def enrich(fact: DataFrame, dim: DataFrame, keys: Keys) -> DataFrame:
    """Fact rows with the dimension's columns, NULL where there is no match."""
    return fact.join(dim, _keys(keys), "left")


def attach(base: DataFrame, sides: Sequence[DataFrame], keys: Keys) -> DataFrame:
    """Left-join sides that are already one row per key, so no side multiplies another."""
    return reduce(lambda acc, side: enrich(acc, side, keys), sides, base)


def zero_fill(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    types = dict(df.dtypes)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(types[c])) for c in columns})


def existing(left: DataFrame, right: DataFrame, keys: Keys) -> DataFrame:
    """EXISTS: rows of `left` with a partner."""
    ks = _keys(keys)
    return left.join(right.select(*ks), ks, "left_semi")


def missing(left: DataFrame, right: DataFrame, keys: Keys) -> DataFrame:
    """NOT EXISTS: rows of `left` without a partner; a NULL key never has one."""
    ks = _keys(keys)
    return left.join(right.select(*ks), ks, "left_anti")


def not_in(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: `violations` of `key NOT IN (SELECT key FROM right)`.

    NULL on the left is not counted, and one NULL on the right makes the whole
    test unknown. Both facts come out of one grouping by key, which combines
    before the shuffle, so neither a hot key nor a large right side matters.
    """
    tagged = left.select(F.col(key).alias("k"), F.lit(1).alias("l"), F.lit(0).alias("r")).unionAll(
        right.select(F.col(key).alias("k"), F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    per_key = tagged.groupBy("k").agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    orphan = F.sum(F.when(F.col("k").isNotNull() & (F.col("r") == 0), F.col("l")).otherwise(0))
    null_right = F.coalesce(F.sum(F.when(F.col("k").isNull(), F.col("r"))), F.lit(0))
    right_rows = F.coalesce(F.sum("r"), F.lit(0))
    return per_key.agg(
        F.when(right_rows == 0, F.coalesce(F.sum("l"), F.lit(0)))
        .when(null_right > 0, 0)
        .otherwise(F.coalesce(orphan, F.lit(0)))
        .cast("bigint")
        .alias("violations")
    )


def mismatched(left: DataFrame, right: DataFrame, keys: Keys, condition: Column) -> DataFrame:
    """Partners that fail a residual test, as (left, right) columns of one row."""
    return match(left, right, keys).where(condition)


def one_row(frames: Sequence[DataFrame]) -> DataFrame:
    """Put one-row aggregates side by side by stacking them and keeping the only value per column."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    names = [c for f in frames for c in f.columns]
    return stacked.agg(*[F.max(c).alias(c) for c in names])
