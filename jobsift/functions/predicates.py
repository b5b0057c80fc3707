"""Row predicates: period exclusion, sentinel filter, text matching."""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobsift import schema as S


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def text_match(col, value: str, mode: str = "contains", collation: str | None = None) -> Column:
    """Substring match of ``value`` in ``col``.

    ``mode="contains"`` treats the value literally; ``mode="like"`` keeps the
    original behaviour where ``%`` and ``_`` in user input act as wildcards.
    ``collation`` (e.g. ``"UTF8_LCASE"`` or ``"UNICODE_CI_AI"``) makes the
    comparison case (and accent) insensitive; LIKE only accepts UTF8_LCASE.
    """
    c = _c(col)
    if collation:
        c = F.collate(c, collation)
    if mode == "contains":
        return c.contains(value)
    if mode == "like":
        return c.like(f"%{value}%")
    if mode == "prefix":
        return c.startswith(value)
    raise ValueError(f"unknown match mode {mode!r}")


def period_excluded(col="salary_period", match: str = "contains", negotiable: bool = True) -> Column:
    """True for yearly, hourly (and negotiable) pay texts.

    ``match="prefix"`` checks the markers at the start of the text,
    ``match="contains"`` anywhere. NULL input gives NULL, so a filter on the
    negation drops rows with no period, as SQL does.
    """
    c = _c(col)
    markers = [S.YEARLY, S.HOURLY] + ([S.NEGOTIABLE] if negotiable else [])
    if match == "prefix":
        tests = [c.startswith(m) for m in markers]
    elif match == "contains":
        tests = [c.contains(m) for m in markers]
    else:
        raise ValueError(match)
    return reduce(or_, tests)


def known_pay(min_col="min_salary", max_col="max_salary", period_col="salary_period") -> Column:
    """Sentinel exclusion: salary known, maximum not open-ended, not negotiable."""
    mn, mx, p = _c(min_col), _c(max_col), _c(period_col)
    return (((mn != S.UNKNOWN_SALARY) | (mx != S.UNKNOWN_SALARY))
            & (mx != S.OPEN_MAX_SALARY)
            & (p != S.NEGOTIABLE))


def salary_lower_bound(col, value: str, mode: str = "compat") -> Column:
    """``col > value`` with a text bound compared as a number.

    ``compat``: a text counts by the number it begins with, and as 0 without
    one (the original database's string to number rule: '40000元' is 40000,
    'nan' is 0). ``strict``: other text than a number raises at planning time.
    """
    m = re.match(r"\s*([-+]?[0-9]*\.?[0-9]+(?:[eE][-+]?[0-9]+)?)", value)
    if mode == "strict" and (m is None or m[0].strip() != value.strip()):
        raise ValueError(f"salary bound {value!r} is not a number")
    return _c(col).cast("double") > F.lit(float(m[1]) if m else 0.0)


def any_contains(cols, value: str, mode: str = "contains", collation: str | None = None) -> Column:
    """OR of ``text_match`` over several columns."""
    return reduce(or_, [text_match(c, value, mode, collation) for c in cols])
