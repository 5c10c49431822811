"""Values at given ranks of a column, without sorting or writing the table.

A sample proposes two values close around a rank; counting says how many rows lie below and at them, and the search
goes on between the two. The sample decides only how fast the search is: counts are exact, and every proposed value
occurs in the column, so each round leaves fewer rows. With 20,000 sampled rows a round leaves about 3 % of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

SORTABLE, SAMPLED = 10_000, 20_000


class Placed(NamedTuple):
    value: Any
    before: int  # rows with a smaller value
    equal: int  # rows with this value


class _Span(NamedTuple):
    """The rows strictly between two values (None: no bound)."""

    low: Any
    high: Any
    before: int
    inside: int


def _within(span: _Span, v: Column, literal) -> Column:
    inside = F.lit(True)
    if span.low is not None:
        inside = inside & (v > literal(span.low))
    if span.high is not None:
        inside = inside & (v < literal(span.high))
    return inside


def _around(values: list, share: float, spread: float = 4.0) -> list:
    """Two sampled values that most likely lie below and above the given share of the rows."""
    n = len(values)
    margin = spread * (n * share * (1 - share)) ** 0.5 + 2
    at = share * n
    return [values[min(max(int(i), 0), n - 1)] for i in (at - margin, at + margin)]


def at_ranks(
    df: DataFrame, column: str, ranks: Sequence[int], total: int, *, sortable: int = SORTABLE, sampled: int = SAMPLED
) -> dict[int, Placed]:
    """The value at each rank (from 1 to `total`, the number of rows with a value) in Spark's ascending order.

    NULLs are left out; NaN comes last, as in a sort. At most `sampled` rows (about) and `sortable` counted values per
    searched span reach the driver, however many rows share a value. `df` is read twice a round and about
    log(total) / log(33) rounds are needed, so it should be a written table; of it only this column is read.
    """
    kind = df.schema[column].dataType
    v = F.col("v")
    values = df.select(F.col(column).alias("v")).where(v.isNotNull())

    def literal(value) -> Column:
        return F.lit(value).cast(kind)

    found: dict[int, Placed] = {}
    where = {rank: _Span(None, None, 0, total) for rank in ranks}
    seed = 0
    while where:
        spans = sorted(set(where.values()), key=lambda s: s.before)
        small, large = [s for s in spans if s.inside <= sortable], [s for s in spans if s.inside > sortable]
        if small:
            number = reduce(lambda c, i: c.when(_within(small[i], v, literal), i), range(len(small)), F)
            counted = values.withColumn("i", number.otherwise(None)).where("i IS NOT NULL").groupBy("i", "v")
            at, i = 0, None
            for r in counted.agg(F.count(F.lit(1)).alias("n")).orderBy("i", "v").collect():
                at, i = (small[r.i].before, r.i) if r.i != i else (at, i)
                for rank in [k for k, s in where.items() if s == small[i] and at < k <= at + r.n]:
                    found[rank] = Placed(r.v, at, r.n)
                at += r.n
        if large:
            seed += 1
            number = reduce(lambda c, i: c.when(_within(large[i], v, literal), i), range(len(large)), F)
            odds = F.element_at(F.array(*[F.lit(min(1.0, sampled / s.inside)) for s in large]), F.col("i") + 1)
            placed = values.withColumn("i", number.otherwise(None)).where("i IS NOT NULL")
            drawn: list[list] = [[] for _ in large]
            for r in placed.where(F.rand(seed) < odds).orderBy("i", "v").collect():
                drawn[r.i].append(r.v)
            pivots = []  # (span, value), ascending within a span
            for span, sample in zip(large, drawn):
                shares = [(k - span.before) / span.inside for k, s in where.items() if s == span] if sample else []
                near = {repr(p): p for share in shares for p in _around(sample, share)}
                pivots += [(span, p) for p in sorted(near.values(), key=lambda p: sample.index(p))]
            columns = [
                F.count_if(_within(span, v, literal) & (v <= literal(p) if closed else v < literal(p)))
                for span, p in pivots for closed in (False, True)
            ]
            counts = values.agg(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first() if columns else ()
            for span in large:
                own = [(p, counts[2 * i], counts[2 * i + 1]) for i, (s, p) in enumerate(pivots) if s == span]
                for rank in [k for k, s in where.items() if s == span]:
                    low, below, high, until = span.low, 0, span.high, span.inside
                    for p, less, upto in own:
                        if rank - span.before > upto:
                            low, below = p, upto
                        elif rank - span.before > less:
                            found[rank] = Placed(p, span.before + less, upto - less)
                            break
                        else:
                            high, until = p, less
                            break
                    where[rank] = _Span(low, high, span.before + below, until - below)
        left = {k: s for k, s in where.items() if k not in found}
        if any(s in small for s in left.values()):
            raise ValueError(f"ranks {sorted(left)} of {column!r} do not exist; has the table changed?")
        where = left
    return found
