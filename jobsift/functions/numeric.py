"""Exact arithmetic helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def floor_div(a: Column, b: Column) -> Column:
    """Exact floor(a / b) for integral a and positive integral b.

    ``a - pmod(a, b)`` is a multiple of ``b``, so the decimal division that
    follows is exact and no floating point rounding can move the result.
    """
    return ((a - F.pmod(a, b)) / b).cast("bigint")


def rounded_ratio(numer: Column, denom: Column) -> Column:
    """round(numer / denom, 0) with halves away from zero, exactly.

    ``numer`` is an integral sum (held as DECIMAL(38,0), so it cannot
    overflow at any data size) and ``denom`` a count. NULL when the count is
    zero, as AVG over no rows is NULL.
    """
    n = numer.cast("decimal(38,0)")
    d = denom.cast("decimal(38,0)")
    q = floor_div(F.abs(n) * 2 + d, d * 2)
    return F.when(d > 0, F.signum(n).cast("bigint") * q)


def weighted_mid_salary_average(weight: str, min_col="min_salary", max_col="max_salary") -> Column:
    """ROUND(AVG((min + max) / 2), 0) as an exact, order-independent aggregate,
    where each row stands for ``weight`` identical rows (a job repeated by its
    category rows): sum((min+max)*w) / 2*sum(w).

    AVG skips rows where either bound is NULL, so both sums are taken over
    the same rows. The products are bigint (18 digits are enough for a row);
    only the sum is wider.
    """
    s = F.col(min_col) + F.col(max_col)
    w = F.col(weight).cast("bigint")
    return rounded_ratio(F.sum((s * w).cast("decimal(18,0)")), F.sum(F.when(s.isNotNull(), w)) * 2)


def half_up_div(col, divisor: int) -> Column:
    """round(col / divisor, 0), halves away from zero, for integral input."""
    c = (F.col(col) if isinstance(col, str) else col).cast("decimal(38,0)")
    return rounded_ratio(c, F.lit(divisor))
