"""Annual price rises of the monthly recurring charge.

A rule set is data (``PriceRiseRules``); ``price_rise`` folds it into one
Column at plan-build time, so the per-row work is a handful of CASE
multiplications inside whole-stage codegen.  The three generations of the
upstream formula are all available:

* ``price_rise``                 live rule: compounding factors + fixed add
* ``price_rise_exclusive``       earlier rule: late Vodafone contracts get the
                                 fixed add instead of percentages
* ``price_rise_simple_accrual``  earliest rule (O2 only): simple annual accrual
"""

from __future__ import annotations

import datetime as dt
import functools
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthledger.functions.dates import date_lit, first_of_month, month_diff
from monthledger.functions.money import dec, round_money

ColumnOrName = Column | str

# ---------------------------------------------------------------------------
# These must equal the upstream rule sets for right results.
# Rises: (fiscal year start, connected-before cut-off, factor).
# ---------------------------------------------------------------------------
O2_RISES = (
    ("2022-04-01", "2022-04-01", "1.117"),
    ("2023-04-01", "2023-04-01", "1.173"),
    ("2024-04-01", "2024-04-01", "1.088"),
)
VODAFONE_RISES = (
    ("2022-04-01", "2022-01-31", "1.093"),
    ("2023-04-01", "2023-01-31", "1.144"),
    ("2024-04-01", "2024-01-31", "1.079"),
    ("2025-04-01", "2025-01-31", "1.064"),
)
VODAFONE_RISES_EXCLUSIVE = (
    ("2022-04-01", "2022-01-31", "1.093"),
    ("2023-04-01", "2023-01-31", "1.144"),
    ("2024-04-01", "2024-01-31", "1.079"),
    ("2025-04-01", "2025-01-31", "1.069"),
)
FIXED_ADD_FROM = "2025-04-01"
FIXED_ADD_AMOUNT = "1.8"
VODAFONE_FIXED_ADD_CONNECTED_FROM = "2024-07-02"
O2_ACCRUAL_GROWTH = (
    ("2022-04-01", "0.117"),
    ("2023-04-01", "0.173"),
    ("2024-04-01", "0.088"),
)
ACCRUAL_END = "2025-04-01"
ACCRUAL_FLAT_ADD = "0.15"


@dataclass(frozen=True)
class PriceStep:
    fiscal_year: dt.date
    cut_off: dt.date
    factor: str


@dataclass(frozen=True)
class PriceRiseRules:
    """Compounding annual factors plus an optional yearly fixed add.

    A step applies when the contract was connected strictly before its cut-off
    and the claim's fiscal year starts on or after the step's fiscal year.
    The fixed add applies from ``fixed_from`` (one amount per fiscal year,
    including the first); ``fixed_connected_from`` restricts it to contracts
    connected on or after that date.
    """

    steps: tuple[PriceStep, ...]
    fixed_from: dt.date | None = dt.date.fromisoformat(FIXED_ADD_FROM)
    fixed_amount: str = FIXED_ADD_AMOUNT
    fixed_connected_from: dt.date | None = None

    @staticmethod
    def of(rows, **kw) -> "PriceRiseRules":
        steps = tuple(PriceStep(dt.date.fromisoformat(f), dt.date.fromisoformat(c), r) for f, c, r in rows)
        return PriceRiseRules(steps=steps, **kw)


O2 = PriceRiseRules.of(O2_RISES)
VODAFONE = PriceRiseRules.of(
    VODAFONE_RISES, fixed_connected_from=dt.date.fromisoformat(VODAFONE_FIXED_ADD_CONNECTED_FROM)
)
VODAFONE_EXCLUSIVE = PriceRiseRules.of(VODAFONE_RISES_EXCLUSIVE, fixed_from=None)
RULES_BY_NETWORK = {"O2": O2, "Vodafone": VODAFONE}

# Price arithmetic runs on a 10-digit base so the three or four chained factor
# products keep every decimal (no precision-driven scale loss).
_BASE = T.DecimalType(12, 2)


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rules_for(network: str) -> PriceRiseRules:
    """Rule set used for ``network``; unknown networks use the Vodafone set."""
    return RULES_BY_NETWORK.get(network, VODAFONE)


def apply_factor(amount: Column, condition: Column, factor: str) -> Column:
    """``amount`` times ``factor`` where ``condition`` holds, else unchanged."""
    return amount * F.when(condition, dec(factor)).otherwise(dec("1"))


def _factor(step: PriceStep, connection_date: Column, fiscal_year: Column) -> Column:
    cond = (connection_date < date_lit(step.cut_off)) & (fiscal_year >= date_lit(step.fiscal_year))
    return F.when(cond, dec(step.factor)).otherwise(dec("1.0"))


def fixed_add(fiscal_year: Column, connection_date: Column, rules: PriceRiseRules) -> Column:
    """Yearly fixed add: ``amount * (complete years since fixed_from + 1)``."""
    if rules.fixed_from is None:
        return dec("0")
    start = date_lit(rules.fixed_from)
    years = F.floor(month_diff(start, fiscal_year) / 12)
    amount = years * dec(rules.fixed_amount) + dec(rules.fixed_amount)
    cond = fiscal_year >= start
    if rules.fixed_connected_from is not None:
        cond = (connection_date >= date_lit(rules.fixed_connected_from)) & cond
    return F.when(cond, amount).otherwise(dec("0"))


def price_rise(
    base: ColumnOrName,
    connection_date: ColumnOrName,
    fiscal_year: ColumnOrName,
    rules: PriceRiseRules = O2,
) -> Column:
    """Uplifted monthly charge: ``round(base * prod(factors) + fixed, 2)``."""
    conn, fy = _c(connection_date), _c(fiscal_year)
    product = functools.reduce(
        lambda acc, step: acc * _factor(step, conn, fy), rules.steps, _c(base).cast(_BASE)
    )
    return round_money(product + fixed_add(fy, conn, rules))


def price_rise_by_network(
    network: ColumnOrName,
    base: ColumnOrName,
    connection_date: ColumnOrName,
    fiscal_year: ColumnOrName,
    rules_by_network: dict[str, PriceRiseRules] | None = None,
    default: PriceRiseRules = VODAFONE,
) -> Column:
    """Per-row choice of rule set by the row's network (mixed-network input).

    A network whose rules are the default's needs no branch of its own.  Each
    branch is a whole rule set of generated code, and a method of over 8000
    bytes is interpreted by the JVM instead of compiled.
    """
    table = rules_by_network or RULES_BY_NETWORK
    net = _c(network)
    out, otherwise = None, price_rise(base, connection_date, fiscal_year, default)
    for name, rules in table.items():
        if rules == default:
            continue
        expr = price_rise(base, connection_date, fiscal_year, rules)
        out = F.when(net == name, expr) if out is None else out.when(net == name, expr)
    return otherwise if out is None else out.otherwise(otherwise)


def price_rise_exclusive(
    network: ColumnOrName,
    base: ColumnOrName,
    connection_date: ColumnOrName,
    fiscal_year: ColumnOrName,
) -> Column:
    """Earlier rule: percentages *or* fixed add, never both for Vodafone.

    Vodafone contracts connected on or after the transition date get
    ``base + fixed``; O2 gets O2 factors plus the fixed add; every other row
    gets the (exclusive-variant) Vodafone factors without a fixed add.
    """
    net, conn, fy = _c(network), _c(connection_date), _c(fiscal_year)
    b = _c(base).cast(_BASE)
    fixed = fixed_add(fy, conn, O2)  # the fixed add without a connection-date test
    o2_product = functools.reduce(lambda a, s: a * _factor(s, conn, fy), O2.steps, b)
    vf_product = functools.reduce(lambda a, s: a * _factor(s, conn, fy), VODAFONE_EXCLUSIVE.steps, b)
    late_vf = (net == "Vodafone") & (conn >= date_lit(VODAFONE_FIXED_ADD_CONNECTED_FROM))
    value = F.when(late_vf, b + fixed).when(net == "O2", o2_product + fixed).otherwise(vf_product)
    return round_money(value)


def price_rise_simple_accrual(
    base: ColumnOrName,
    connection_date: ColumnOrName,
    claim_month: ColumnOrName,
    fiscal_year: ColumnOrName,
    scale: int = 6,
    network: ColumnOrName | None = None,
) -> Column:
    """Earliest rule (O2): simple accrual per fiscal year, no compounding.

    ``base + sum_r [conn < fy_r <= fy < accrual_end] (k*base*g + (base + k*base*g)*g/12)
    + flat`` with ``k`` the complete years from ``fy_r`` to the claim month and
    ``flat = 1.8 * complete years since 2025-04-01 + 0.15`` from that month on.
    The upstream rule does not round; the single division by 12 is done last
    and rounded HALF_UP to ``scale`` decimals.  With ``network`` only O2 rows
    get the rule and rows of other networks (or of none) keep ``base``; the
    rule has no defined result for Vodafone, whose rows are NULL.
    """
    b = _c(base).cast(_BASE)
    conn, fy = _c(connection_date), _c(fiscal_year)
    month = first_of_month(claim_month)
    end = date_lit(ACCRUAL_END)
    twelfths = b * 12
    years = T.DecimalType(4, 0)  # small counts keep the decimal products exact
    for start, growth in O2_ACCRUAL_GROWTH:
        s = date_lit(start)
        k = F.floor(month_diff(s, month) / 12).cast(years)
        grown = k * b * dec(growth)
        term = grown * 12 + (b + grown) * dec(growth)
        cond = (conn < s) & (fy >= s) & (fy < end)
        twelfths = twelfths + F.when(cond, term).otherwise(dec("0"))
    flat = F.floor(month_diff(end, month) / 12).cast(years) * dec(FIXED_ADD_AMOUNT) + dec(ACCRUAL_FLAT_ADD)
    twelfths = twelfths + F.when(_c(claim_month) >= end, flat * 12).otherwise(dec("0"))
    value = F.round(twelfths / 12, scale).cast(T.DecimalType(18, scale))
    if network is None:
        return value
    net = _c(network)
    kept = F.when(net == "Vodafone", F.lit(None)).otherwise(b).cast(T.DecimalType(18, scale))
    return F.when(net == "O2", value).otherwise(kept)
