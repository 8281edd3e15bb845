"""Calendar building blocks as Column -> Column functions.

All of them compile to Catalyst expressions (no Python at run time) and work
on DATE columns; callers cast timestamps to DATE at the edge.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_lit(value: str | dt.date) -> Column:
    """A DATE literal from ``YYYY-MM-DD`` text or a ``datetime.date``."""
    if isinstance(value, str):
        value = dt.date.fromisoformat(value)
    return F.lit(value)


def first_of_month(d: ColumnOrName) -> Column:
    """First day of the month of ``d`` as a DATE (``trunc``, not ``date_trunc``,
    which would return a TIMESTAMP)."""
    return F.trunc(_c(d), "MM")


def month_diff(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Number of calendar-month boundaries crossed from ``start`` to ``end``.

    31 January -> 1 February is 1.  (Spark's own ``datediff(MONTH, ...)`` counts
    whole months and would give 0.)
    """
    s, e = _c(start), _c(end)
    return (F.year(e) - F.year(s)) * 12 + (F.month(e) - F.month(s))


def days_in_month(month_start: ColumnOrName) -> Column:
    """Days from the first of the month to the first of the next month."""
    m = _c(month_start)
    return F.datediff(F.add_months(m, 1), m)


def fiscal_year_start(d: ColumnOrName, start_month: int = 4) -> Column:
    """First day of the fiscal year containing ``d`` (default: 1 April).

    NULL in, NULL out.
    """
    c = _c(d)
    year = F.year(c) - F.when(F.month(c) < start_month, 1).otherwise(0)
    return F.make_date(year, F.lit(start_month), F.lit(1))


def parse_period_month(text: ColumnOrName, pattern: str = "MMM-yy") -> Column:
    """Parse month text such as ``Apr-24`` (any letter case) to its first day.

    Unparsable text gives NULL.
    """
    return first_of_month(F.try_to_date(_c(text), pattern))


def parse_yyyymm(period: ColumnOrName) -> Column:
    """Parse an integer ``yyyymm`` month to its first day.

    The pattern must be ``yyyyMM``: lower-case ``mm`` means minutes and would
    silently return January.
    """
    return first_of_month(F.to_date(_c(period).cast("string"), "yyyyMM"))


def parse_day_month_year_time(text: ColumnOrName, strict: bool = True) -> Column:
    """Parse ``DD/MM/YYYY HH24:MI`` text to a DATE (the time is dropped).

    ``strict`` raises on malformed text (ANSI ``to_date``); otherwise it gives NULL.
    """
    fmt = "dd/MM/yyyy HH:mm"
    return F.to_date(_c(text), fmt) if strict else F.try_to_date(_c(text), fmt)
