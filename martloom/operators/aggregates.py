"""Aggregate expressions shared by the table builders."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from martloom.functions.money import pct


def count_when(cond: Column) -> Column:
    return F.count_if(cond)


def sum_when(cond: Column, value: Column) -> Column:
    return F.sum(F.when(cond, value).otherwise(0))


def distinct_when(cond: Column, value: str) -> Column:
    """Exact distinct count. Spark spreads it over (group, value), so a hot group is split."""
    return F.count_distinct(F.when(cond, F.col(value)))


def with_distinct(
    df: DataFrame, keys: Sequence[str], value: str, counts: Mapping[str, Column | None],
    others: Mapping[str, tuple[str, Column | None]] | None = None, totals: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per group: exact distinct counts of several columns, and sums, without copies of the rows.

    Several COUNT(DISTINCT) in one aggregate make Spark shuffle every row once per counted column. Here each
    column is a grouping by (keys, column) with one row per value, counted afterwards. `counts` names the counts of
    `value`, each with the condition a row must meet (None: all rows); its grouping also carries `totals`, sums or
    counts that are summed again. `others` names counts of other columns; their groupings read nothing but their
    column, keys and condition, so joins that only add columns fall away. A NULL value is not counted; NULL keys
    form a group. A hot group is spread over its values.
    """
    totals, others = totals or {}, others or {}
    flags = {f"_in_{name}": F.bool_or(F.lit(True) if cond is None else cond) for name, cond in counts.items()}
    per_value = df.groupBy(*keys, value).agg(
        *[c.alias(n) for n, c in totals.items()], *[c.alias(n) for n, c in flags.items()]
    )
    known = F.col(value).isNotNull()
    main = per_value.groupBy(*keys).agg(
        *[F.count_if(known & F.col(f"_in_{name}")).alias(name) for name in counts],
        *[F.sum(n).alias(n) for n in totals],
    )

    def beside(acc: DataFrame, item) -> DataFrame:
        name, (column, cond) = item
        rows = df.where(F.col(column).isNotNull() if cond is None else F.col(column).isNotNull() & cond)
        side = rows.select(*keys, column).distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
        same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
        joined = acc.alias("l").join(side.alias("r"), same, "left")
        return joined.select("l.*", F.coalesce(F.col(f"r.{name}"), F.lit(0).cast("bigint")).alias(name))

    return reduce(beside, others.items(), main)


def surplus_duplicates(key: str) -> Column:
    """Rows beyond the first per key; a NULL key is always surplus."""
    return F.count(F.lit(1)) - F.count_distinct(key)


def share_pct(cond: Column, digits: int = 2) -> Column:
    return pct(F.count_if(cond), F.count(F.lit(1)), digits)


def status_counts(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"))


def groups_where(df: DataFrame, keys: Sequence[str], total: Column, test) -> DataFrame:
    """Groups whose aggregate passes a test (an aggregate used as a filter)."""
    return df.groupBy(*keys).agg(total.alias("total")).where(test(F.col("total")))


def two_level(df: DataFrame, inner: Sequence[str], outer: Sequence[str], value: str) -> DataFrame:
    """Sum to the inner grain, then describe the sums at the outer grain."""
    daily = df.groupBy(*inner).agg(F.sum(value).alias("inner_total"))
    return daily.groupBy(*outer).agg(
        F.sum("inner_total").alias("total"),
        F.avg("inner_total").alias("mean"),
        F.stddev_pop("inner_total").alias("std"),
        F.count(F.lit(1)).alias("groups"),
    )
