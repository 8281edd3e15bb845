"""Contract-month spine, calendar, rate card lookup and expected commission.

The spine is a ``Generate`` (``explode(sequence(0, last))``): no join, no
shuffle, at most ``months`` rows per contract, and the upper bound already
stops at the payment horizon, so no month is generated only to be dropped.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthledger.functions.dates import days_in_month, first_of_month, fiscal_year_start, month_diff
from monthledger.functions.money import prorate, round_money
from monthledger.functions.pricing import O2, PriceRiseRules, price_rise, price_rise_by_network
from monthledger.operators.copies import collapse_copies

CONTRACT_MONTHS = 36
FIRST_TIER_MONTHS = 24


def month_spine(
    contracts: DataFrame,
    horizon: Column | None = None,
    months: int = CONTRACT_MONTHS,
    before: Column | None = None,
) -> DataFrame:
    """One row per contract and claim month.

    ``claim_month`` is the first of the connection month plus ``n`` months
    (``n = 0 .. months-1``) and ``month_number = n + 1``.  With ``horizon``
    (the latest paid month, usually a scalar subquery) only months up to it
    are generated; a NULL horizon (no payments at all) yields no rows.  With
    ``before`` only months before that date's month are, all where it is NULL.
    """
    start = first_of_month("connection_date")
    last = F.lit(months - 1)
    df = contracts
    if horizon is not None:
        bound = month_diff(start, horizon)
        df = df.where(bound >= 0)
        last = F.least(last, bound)
    if before is not None:
        earlier = month_diff(start, before) - 1
        df = df.where(before.isNull() | (earlier >= 0))
        last = F.least(last, earlier)
    n = F.col("_n")
    return (
        df.withColumn("_n", F.explode(F.sequence(F.lit(0), last)))
        .withColumn("claim_month", F.add_months(start, n))
        .withColumn("month_number", n + 1)
        .drop("_n")
    )


def with_calendar(spine: DataFrame) -> DataFrame:
    """Fiscal year start, month bounds and days in the claim month."""
    return spine.withColumns(
        {
            "claim_start_of_fy": fiscal_year_start("claim_month"),
            "start_of_claim_month": first_of_month("claim_month"),
        }
    ).withColumns(
        {
            "start_of_next_claim_month": F.add_months("start_of_claim_month", 1),
            "days_in_month": days_in_month("start_of_claim_month"),
        }
    )


def prorata_days_col() -> Column:
    """Days of the month from the connection day on, for months 1 and 25."""
    mn = F.col("month_number")
    anniversary = F.add_months("connection_date", (mn - 1).cast("int"))
    return F.when(
        mn.isin(1, 25),
        F.col("days_in_month") - F.datediff(anniversary, F.col("start_of_claim_month")),
    )


def with_prorata_days(df: DataFrame) -> DataFrame:
    return df.withColumn("days_pro_rata", prorata_days_col())


# ---------------------------------------------------------------- rate card --

RATE_COLUMNS = ("vat", "commission_rate_1", "commission_rate_2")


def rates_for(rates: DataFrame, operator: str) -> DataFrame:
    return rates.where(F.col("operator") == operator).select(*RATE_COLUMNS, "active_date", "end_date")


def rates_by_network(rates: DataFrame, networks: tuple[str, ...]) -> DataFrame:
    """The card of several networks; ``network`` then is a key of the lookup."""
    chosen = rates.where(F.col("operator").isin(*networks))
    return chosen.select(F.col("operator").alias("network"), *RATE_COLUMNS, "active_date", "end_date")


def _card_keys(rates: DataFrame) -> list[str]:
    return ["network"] if "network" in rates.columns else []


def rate_months(rates: DataFrame, horizon: Column | None = None) -> DataFrame:
    """Expand each rate row to the first-of-months inside ``[active, end]``.

    A claim month matches a rate row exactly when it is one of those months, so
    the range join becomes an equi-join on ``claim_month``.  The upper end is
    capped at the payment horizon so open-ended rows stay small.  A row with a
    NULL start or end covers no month, as in the interval comparison.
    """
    rates = rates.where(F.col("active_date").isNotNull() & F.col("end_date").isNotNull())
    first = F.when(F.dayofmonth("active_date") == 1, F.col("active_date")).otherwise(
        F.add_months(first_of_month("active_date"), 1)
    )
    last = first_of_month("end_date")
    if horizon is not None:
        last = F.least(last, horizon)
    return (
        rates.withColumns({"_first": first, "_last": last})
        .where(F.col("_first") <= F.col("_last"))
        .select(
            *_card_keys(rates),
            *RATE_COLUMNS,
            F.explode(F.sequence(F.col("_first"), F.col("_last"), F.expr("INTERVAL 1 MONTH"))).alias("claim_month"),
        )
    )


def rate_blocks(rates: DataFrame, until: Column) -> DataFrame:
    """The card as an interval index: a copy of each row for every block (year)
    that its window touches, up to ``until``, the last month looked up.

    A window of n years makes n + 1 rows however many months it has, and an
    open end no more than the blocks before ``until``.  ``until`` NULL: none.
    """
    whole = rates.where(F.col("active_date").isNotNull() & F.col("end_date").isNotNull())
    last = F.least("end_date", until)
    ok = (F.col("active_date") <= last) & until.isNotNull()
    blocks = F.explode(F.sequence(F.year("active_date"), F.year(last)))
    return whole.where(ok).withColumn("_block", blocks)


def months_of_several_rates(rates: DataFrame, horizon: Column | None = None) -> list:
    """The claim months (of a network, if the card has several) that two
    different rate rows cover: at most the card's calendar months.

    A small action on the month-expanded rate card (operator-filtered, capped
    at the horizon).  In all other months the rate join cannot make two month
    rows that differ only in their rates.
    """
    keys = [*_card_keys(rates), "claim_month"]
    m = rate_months(rates, horizon).select(*keys, *RATE_COLUMNS).distinct()
    return m.groupBy(*keys).count().where(F.col("count") > 1).select(*keys).collect()


def one_rate_per_month(rates: DataFrame, horizon: Column | None = None) -> bool:
    """True when no claim month is covered by two different rate rows."""
    return not months_of_several_rates(rates, horizon)


def among_months(found: list) -> Column:
    """Whether a month row is among ``months_of_several_rates``."""
    by_network: dict = {}
    for r in found:
        by_network.setdefault(r.asDict().get("network"), []).append(r.claim_month)
    each = [
        F.col("claim_month").isin(months) & (F.lit(True) if network is None else F.col("network") == network)
        for network, months in sorted(by_network.items(), key=str)
    ]
    return F.coalesce(reduce(or_, each, F.lit(False)), F.lit(False))


def rate_lookup(
    spine: DataFrame,
    rates: DataFrame,
    strategy: str = "auto",
    horizon: Column | None = None,
    copies: str | None = None,
    how: str = "left",
) -> DataFrame:
    """Left-join the rate row valid at each claim month (``active <= m <= end``).

    ``by_month`` and ``auto``: rates expanded to months, then an equi-join on
    the month; ``range``: an equi-join on the block of the month and, within
    it, the interval itself, for cards whose windows are long or not whole
    months.  Neither has a hint or a nested loop: Spark broadcasts the card or
    shuffles both sides, by the size it measures.  A card with a ``network``
    column (``rates_by_network``) is also joined on that.
    Overlapping rate windows duplicate months, as the interval join does;
    with ``copies`` identical rate rows arrive collapsed with their count.
    ``how="inner"`` leaves out the months without a rate.
    """
    keys = _card_keys(rates)
    if strategy == "range":
        r = rates.select(*keys, *RATE_COLUMNS, "active_date", "end_date")
        r = collapse_copies(r, copies) if copies else r
        until = F.lit(spine.agg(F.max("claim_month")).first()[0]).cast("date") if horizon is None else horizon
        index = rate_blocks(r, until).alias("r")
        probe = spine.withColumn("_block", F.year("claim_month")).alias("s")
        cond = F.col("claim_month").between(F.col("r.active_date"), F.col("r.end_date"))
        for k in [*keys, "_block"]:
            cond = cond & (F.col(f"s.{k}") == F.col(f"r.{k}"))
        added = [c for c in r.columns if c not in (*keys, "active_date", "end_date")]
        return probe.join(index, cond, how).select("s.*", *[f"r.{c}" for c in added]).drop("_block")
    if strategy not in ("auto", "by_month"):
        raise ValueError(f"unknown rate lookup strategy {strategy!r}")
    months = rate_months(rates, horizon)
    if copies:
        months = collapse_copies(months, copies)
    return spine.join(months, [*keys, "claim_month"], how)


# --------------------------------------------------------------- commission --


def with_uplift(df: DataFrame, rules: PriceRiseRules | dict[str, PriceRiseRules] = O2) -> DataFrame:
    """Uplifted charge by one rule set, or by the row's network's (a dict)."""
    columns = ("gross_mrc", "connection_date", "claim_start_of_fy")
    if isinstance(rules, dict):
        return df.withColumn("uplifted_mrc", price_rise_by_network("network", *columns, rules))
    return df.withColumn("uplifted_mrc", price_rise(*columns, rules))


def first_month_prorata_col() -> Column:
    """Month 1 of a contract connected after the 1st pays only its days.

    Rounded to 4 then to 2 decimals, both HALF_UP.
    """
    partial = F.round(prorate("uplifted_mrc", "days_pro_rata", "days_in_month"), 4)
    first = (F.col("month_number") == 1) & (F.dayofmonth("connection_date") > 1)
    return round_money(F.when(first, partial).otherwise(F.col("uplifted_mrc")))


def net_of_vat_col(gross: str = "uplifted_mrc_pro_rata") -> Column:
    return round_money(F.col(gross) / (F.col("vat") + 1))


def expected_commission_col() -> Column:
    """Tier 1 rate for months 1-24, tier 2 for 25-36, NULL otherwise."""
    mn = F.col("month_number")
    return round_money(
        F.when(mn.between(1, FIRST_TIER_MONTHS), F.col("net_mrc") * F.col("commission_rate_1")).when(
            mn.between(FIRST_TIER_MONTHS + 1, CONTRACT_MONTHS), F.col("net_mrc") * F.col("commission_rate_2")
        )
    )


def with_commission(df: DataFrame) -> DataFrame:
    """Pro-rata, VAT removal and tiered commission on an uplifted spine."""
    return (
        df.withColumn("uplifted_mrc_pro_rata", first_month_prorata_col())
        .withColumn("net_mrc", net_of_vat_col())
        .withColumn("expected_commission", expected_commission_col())
    )


def priced_months(
    spine: DataFrame,
    rates: DataFrame,
    rules: PriceRiseRules | dict[str, PriceRiseRules] = O2,
    rate_strategy: str = "auto",
    horizon: Column | None = None,
    copies: str | None = None,
    how: str = "left",
    settle: bool = False,
) -> DataFrame:
    """Spine -> calendar -> rate lookup -> uplift -> pro-rata -> net -> expected.

    ``settle``: the columns after each of the two halves are ``settled``, those
    that only its half reads are dropped.
    """
    df = with_prorata_days(with_calendar(spine))
    df = with_uplift(rate_lookup(df, rates, rate_strategy, horizon, copies=copies, how=how), rules)
    return with_commission(settled(df.drop(*UPLIFT_ONLY)) if settle else df)


#: Columns of the pricing that nothing after the uplift reads.
UPLIFT_ONLY = ("claim_start_of_fy", "start_of_claim_month", "start_of_next_claim_month")


def settled(df: DataFrame) -> DataFrame:
    """The same rows, their columns computed once.

    A generator stands between them and what follows.  Without it a filter on
    claim types is pushed below the pricing with the whole of it repeated in
    each condition, and pricing and classification become one generated method
    that is too long for the JVM to compile, so that it is interpreted.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))
