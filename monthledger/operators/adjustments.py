"""Disconnection, upgrade and non-billing adjustments of the expected amount.

Joins and rules are separate functions: the job attaches the per-contract
feeds (disconnections, upgrades) at contract grain, before the month spine
multiplies rows by up to 36, and applies the rules after pricing.  Both joins
are LEFT on ``usi`` and keep duplicate feed rows (each one multiplies the
contract's months), so the row multiset is the same at either grain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthledger.functions.dates import month_diff
from monthledger.functions.money import as_money, prorate, round_money
from monthledger.operators.copies import collapse_copies

UPGRADE_ZEROES_AFTER_MONTHS = 21
NON_BILLED = "NON BILLED"
FTU = "FTU"


def matchable(feed: DataFrame) -> DataFrame:
    """Drop rows whose ``usi`` is NULL: a left join can never match them."""
    return feed.where(F.col("usi").isNotNull())


def _feed(df: DataFrame, copies: str | None) -> DataFrame:
    return collapse_copies(df, copies) if copies else df


def attach_disconnections(df: DataFrame, disconnections: DataFrame, copies: str | None = None) -> DataFrame:
    """LEFT join on usi.  With ``copies``, identical feed rows arrive collapsed
    with their count in that column instead of as separate rows."""
    d = matchable(disconnections).select("usi", "disconnection_date", "disconnection_reason")
    return df.join(_feed(d, copies), "usi", "left")


def attach_upgrades(df: DataFrame, upgrades: DataFrame, copies: str | None = None) -> DataFrame:
    u = matchable(upgrades).select("usi", "last_upgrade_date", "upgrade_channel", "base_indicator")
    return df.join(_feed(u, copies), "usi", "left")


def disconnection_rule_col() -> Column:
    """0 after the disconnection month; the month itself pays up to the
    disconnection day (day / days in month); otherwise unchanged."""
    disc, month = F.col("disconnection_date"), F.col("claim_month")
    same_month = (
        (disc >= month) & (F.month(disc) == F.month(month)) & (F.year(disc) == F.year(month))
    )
    part = prorate("expected_commission", F.dayofmonth(disc), F.dayofmonth(F.last_day(month)))
    return round_money(F.when(disc < month, F.lit(0)).when(same_month, part).otherwise(F.col("expected_commission")))


def _months_to_upgrade() -> Column:
    return month_diff("connection_date", "last_upgrade_date")


def late_upgrade_col() -> Column:
    """Whether the contract was upgraded 21+ calendar months after connection."""
    return F.col("last_upgrade_date").isNotNull() & (_months_to_upgrade() >= UPGRADE_ZEROES_AFTER_MONTHS)


def upgrade_rule_col() -> Column:
    """An upgrade 21+ calendar months after connection zeroes every month."""
    return round_money(F.when(late_upgrade_col(), F.lit(0)).otherwise(F.col("expected_commission_after_disconnection")))


def ftu_flag_col() -> Column:
    """``FTU`` for an upgrade within 21 calendar months of connection, else NULL."""
    lud = F.col("last_upgrade_date")
    return F.when(lud.isNotNull() & (_months_to_upgrade() < UPGRADE_ZEROES_AFTER_MONTHS), F.lit(FTU))


def with_disconnection_rule(df: DataFrame) -> DataFrame:
    return df.withColumn("expected_commission_after_disconnection", disconnection_rule_col())


def with_upgrade_rules(df: DataFrame) -> DataFrame:
    return df.withColumns({"expected_commission_after_upgrade": upgrade_rule_col(), "ftu_flag": ftu_flag_col()})


def apply_disconnection(months: DataFrame, disconnections: DataFrame) -> DataFrame:
    return with_disconnection_rule(attach_disconnections(months, disconnections))


def apply_upgrade(months: DataFrame, upgrades: DataFrame) -> DataFrame:
    return with_upgrade_rules(attach_upgrades(months, upgrades))


def billing_by_month(non_billing: DataFrame, copies: str | None = None) -> DataFrame:
    """Billing statuses as the month rows meet them: by usi and claim month."""
    nb = matchable(non_billing).where(F.col("period_start_of_month").isNotNull())
    return _feed(nb.select("usi", F.col("period_start_of_month").alias("claim_month"), "billed_status"), copies)


def apply_non_billing(months: DataFrame, billing: DataFrame) -> DataFrame:
    """Left join billing status (``billing_by_month``) on (usi, claim month);
    NON BILLED zeroes it."""
    joined = months.join(billing.withColumn("_nb_month", F.col("claim_month")), ["usi", "claim_month"], "left")
    zero = (F.col("billed_status") == NON_BILLED) & (F.col("claim_month") == F.col("_nb_month"))
    return joined.withColumn(
        "final_expected_commission",
        round_money(F.when(zero, F.lit(0)).otherwise(F.col("expected_commission_after_upgrade"))),
    ).drop("_nb_month")


def adjusted_commission_col() -> Column:
    """Final expected amount unless disconnected on or before the month end."""
    disc, final = F.col("disconnection_date"), F.col("final_expected_commission")
    return as_money(
        F.when(disc.isNull(), final).when(disc > F.last_day("claim_month"), final).otherwise(F.lit(0))
    )
