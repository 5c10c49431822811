"""Calendar helpers. The as-of date is always an argument, never the clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(c) -> Column:
    """String, timestamp or date to DATE; unreadable text becomes NULL for the rules to report."""
    return _col(c).try_cast("date")


def day(value: dt.date) -> Column:
    return F.lit(value)


def date_key(c) -> Column:
    return F.date_format(_col(c), "yyyyMMdd").cast("int")


def season(month: Column) -> Column:
    return (
        F.when(month.isin(12, 1, 2), "Winter")
        .when(month.isin(3, 4, 5), "Spring")
        .when(month.isin(6, 7, 8), "Summer")
        .otherwise("Autumn")
    )


def since(c, as_of: dt.date, days: int) -> Column:
    """Within `days` days before the as-of date (a plain literal, so it reaches the scan)."""
    return _col(c) >= F.lit(as_of - dt.timedelta(days=days))


def age_days(c, as_of: dt.date) -> Column:
    return F.datediff(F.lit(as_of), _col(c))


def minute(ts) -> Column:
    return F.date_trunc("minute", _col(ts))


def seconds_before(ts: Column, n: Column) -> Column:
    return ts - F.make_dt_interval(secs=n)
