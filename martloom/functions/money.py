"""Exact money at the speed of primitives.

Amounts are DOUBLE columns holding whole cents. Whatever is added up goes
through BIGINT cents or parts of cents, so totals do not depend on the order of
the rows, and halves round away from zero. An amount that is not a number, not
finite or too large for BIGINT raises an error.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

UNITS = 1_000_000  # parts of a cent in products and sums that are rounded later


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _whole(x: Column) -> Column:
    """The nearest BIGINT. In ANSI mode, which `session.RUNTIME_CONF` asks for, the cast refuses what does not fit."""
    return F.rint(x).cast("bigint")


def cents(c) -> Column:
    return _whole(F.round(_col(c), 2) * 100)


def dollars(whole_cents: Column) -> Column:
    return whole_cents / F.lit(100.0)


def money(c) -> Column:
    """Rounded to cents, still DOUBLE."""
    return dollars(cents(c))


def divide(numerator: Column, denominator: Column) -> Column:
    """Integer quotient, halves away from zero; NULL unless the denominator is positive."""
    n, d = numerator.cast("bigint"), denominator.cast("bigint")
    size = F.call_function("div", F.abs(n) * 2 + d, d * 2)
    return F.when(d > 0, F.when(n < 0, -size).otherwise(size))


def total(c) -> Column:
    """SUM in cents."""
    return F.sum(cents(c))


def line_total_units(line_total="line_total") -> Column:
    """Total of one line in millionths of a cent, so that rounding happens after the sum."""
    return _whole(_col(line_total) * (100 * UNITS))


def line_discount_units(line_total="line_total", discount_pct="discount_pct") -> Column:
    """Discount of one line in millionths of a cent. Only the product is rounded, never the rate."""
    return _whole(_col(line_total) * _col(discount_pct) * (100 * UNITS))


def units_to_cents(units: Column) -> Column:
    return divide(units, F.lit(UNITS))


def line_net(line_total="line_total", discount_pct="discount_pct") -> Column:
    """Cents of one line after its discount."""
    return units_to_cents(_whole(_col(line_total) * (F.lit(1.0) - _col(discount_pct)) * (100 * UNITS)))


def tax_on(net_cents: Column, percent: int = 8) -> Column:
    return divide(net_cents * percent, F.lit(100))


def net_revenue(status: Column, gross: Column, discount: Column, refund: Column) -> Column:
    """Cents of gross less discount and approved refunds, never below 0, and 0 once cancelled."""
    return F.when(status == "Cancelled", F.lit(0).cast("bigint")).otherwise(
        F.greatest(gross - discount - refund, F.lit(0).cast("bigint"))
    )


def mean(total_cents: Column, n: Column) -> Column:
    """Unrounded average amount; NULL for an empty group."""
    return F.try_divide(dollars(total_cents), n.cast("double"))


def mean_cents(total_cents: Column, n: Column) -> Column:
    """Average amount rounded to cents; NULL for an empty group."""
    return dollars(divide(total_cents, n))


def mean_rounded(total: Column, n: Column, digits: int = 2) -> Column:
    """Average of integers, rounded."""
    scale = 10**digits
    return divide(total.cast("bigint") * scale, n) / F.lit(float(scale))


def pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """`100 * part / whole` of two counts, rounded; NULL when `whole` is 0."""
    return mean_rounded(part.cast("bigint") * 100, whole, digits)
