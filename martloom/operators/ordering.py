"""Sorts, limits, exact percentiles and ordered splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from martloom.functions.labels import position
from martloom.operators.selection import SORTABLE, at_ranks
from martloom.operators.windows import numbered


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First k rows of a total order (give a key as the last sort column)."""
    return df.orderBy(*order).limit(k)


def sorted_by_label(df: DataFrame, column: str, order: Sequence[str], *then: str) -> DataFrame:
    return df.orderBy(position(F.col(column), order), *then)


def repeatable_limit(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """A cap that returns the same rows every time, unlike a bare LIMIT."""
    return df.orderBy(*keys).limit(n)


def first_by_digest(
    df: DataFrame, key: str, ties: Sequence[str], n: int, *, digits: int = 3, sortable: int = 10_000
) -> DataFrame:
    """The first `n` rows in the order of a hexadecimal digest, then of `ties`, without sorting the table.

    The last digest taken is found by counting: rows per prefix of `digits` characters, then per longer prefix
    inside the one that holds the n-th row, until at most `sortable` rows share it. Only those are ordered, and the
    result is a filter. Digests and ties together must be unique; digest NULL is never taken. `df` is read about
    log(rows) / log(16^digits) times, so it should be a written table.
    """
    taken = df.where(F.col(key).isNotNull())
    prefix, before, inside = "", 0, None
    while inside is None or inside > sortable:
        piece = F.substring(key, 1, len(prefix) + digits)
        counts = taken.where(F.col(key).startswith(prefix)).groupBy(piece.alias("p")).agg(F.count(F.lit(1)).alias("n"))
        found = None
        for row in sorted(counts.collect()):  # at most 16^digits prefixes
            if before + row.n >= n:
                found = row
                break
            before += row.n
        if found is None:  # fewer than n rows in all
            return taken
        if found.p == prefix:  # the digest has no further digits
            break
        prefix, inside = found.p, found.n
    order = [key, *ties]
    last = taken.where(F.col(key).startswith(prefix)).orderBy(*order).offset(max(n - before - 1, 0)).limit(1).select(*order)
    edge = last.first() if n > 0 else None
    if edge is None:
        return taken.limit(0)
    limit = F.struct(*[F.lit(v).cast(taken.schema[c].dataType).alias(c) for c, v in zip(order, edge)])
    return taken.where(F.struct(*order) <= limit)


def ordered_split(
    df: DataFrame, key: str, fraction: float, *, sortable: int = SORTABLE
) -> tuple[DataFrame, DataFrame]:
    """The first `fraction` of the rows by key (NULL first), and the rest, as two filters on the key.

    Rows are numbered only where several share the key at the cut; those are taken in the order of all columns that
    have an order. `df` is read several times, so it should be a written table.
    """
    sizes = df.agg(F.count(F.lit(1)).alias("n"), F.count(key).alias("filled")).first()
    cut, nulls, k = int(sizes.n * fraction), sizes.n - sizes.filled, F.col(key)
    if cut <= 0:
        return df.limit(0), df
    if cut >= sizes.n:
        return df, df.limit(0)
    if cut <= nulls:
        before, at, after, left, equal = F.lit(False), k.isNull(), k.isNotNull(), cut, nulls
    else:
        placed = at_ranks(df, key, [cut - nulls], sizes.filled, sortable=sortable)[cut - nulls]
        last = F.lit(placed.value).cast(df.schema[key].dataType)
        before, at, after = k.isNull() | (k < last), k == last, k > last
        left, equal = cut - nulls - placed.before, placed.equal
    if left == equal:
        return df.where(before | at), df.where(after)
    order = [key, *[c for c, t in df.dtypes if c != key and "map<" not in t and "variant" not in t]]
    tied = numbered(df.where(at), [F.col(c).asc() for c in order], "_position")
    first, rest = (tied.where(side).drop("_position") for side in (F.col("_position") <= left, F.col("_position") > left))
    return df.where(before).unionByName(first), df.where(after).unionByName(rest)


def exact_percentiles(
    df: DataFrame, column: str, points: Sequence[float], *, sortable: int = SORTABLE
) -> DataFrame:
    """One row of continuous percentiles `p1, p2, ...` of a column, interpolated between neighbours.

    The values at the ranks around each point are found by counting (`selection.at_ranks`): no sort, no shuffle of
    rows, no table written. NULLs are left out; without any value all percentiles are NULL.
    """
    values = df.select(F.col(column).cast("double").alias(column))
    total = values.agg(F.count(column)).first()[0]
    ranks = [(int(p * (total - 1)) + 1, min(int(p * (total - 1)) + 2, total)) for p in points]
    found = at_ranks(values, column, sorted({r for pair in ranks for r in pair}), total, sortable=sortable) if total else {}
    row = []
    for p, (low, high) in zip(points, ranks):
        share = p * (total - 1) - (low - 1)
        row.append(found[low].value + (found[high].value - found[low].value) * share if total else None)
    schema = ", ".join(f"p{i} double" for i in range(1, len(points) + 1))
    return df.sparkSession.createDataFrame([tuple(row)], schema)


def with_one_row(df: DataFrame, row: DataFrame) -> DataFrame:
    """Every row of `df` with the values of a one-row frame, as scalar subqueries."""
    return df.withColumns({c: row.select(c).scalar() for c in row.columns})


def global_window_percentile(df: DataFrame, column: str, p: float, out: str) -> DataFrame:
    return with_one_row(df, exact_percentiles(df, column, [p]).withColumnRenamed("p1", out))

