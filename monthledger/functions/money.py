"""Fixed-point money helpers.

Amounts stay DECIMAL end to end.  ``round`` on decimals is HALF_UP (half away
from zero) and exact; proportional amounts multiply before they divide, so no
rounded ratio enters a result.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthledger.sources.schemas import MONEY

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dec(value: str) -> Column:
    """An exact DECIMAL literal whose precision and scale follow the text."""
    d = Decimal(value)
    sign, digits, exp = d.as_tuple()
    scale = max(-exp, 0)
    precision = max(len(digits), scale + 1)
    return F.lit(d).cast(T.DecimalType(precision, scale))


def round_money(amount: ColumnOrName, scale: int = 2) -> Column:
    """HALF_UP round to ``scale`` decimals, typed as money."""
    return F.round(_c(amount), scale).cast(T.DecimalType(18, scale))


def prorate(amount: ColumnOrName, part: ColumnOrName, whole: ColumnOrName) -> Column:
    """``amount * part / whole`` in decimal, unrounded (scale >= 6).

    The product is formed first, so the only rounding is Spark's decimal
    division at scale >= 6, which cannot move a later 2- or 4-place HALF_UP
    round for day counts (denominators up to 31).
    """
    day = T.DecimalType(5, 0)
    return (_c(amount) * _c(part).cast(day)) / _c(whole).cast(day)


def as_money(amount: ColumnOrName) -> Column:
    return _c(amount).cast(MONEY)
