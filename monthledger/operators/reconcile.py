"""Reconcile expected amounts with the payments made.

Each contract month is left-joined to the monthly payment rows on
``(usi, claim_month)`` and grouped on the 21 contract-month columns plus the
payment's period text, level-5 and SOS codes and month.  Identical
contract-month rows (duplicate feed rows) collapse in the group and multiply
its sum and count, exactly as a join followed by GROUP BY does.

Plan: the caller (``plans.job``) joins only months that some payment or billing
row may meet on a shuffle by ``(usi, claim_month)``; the 25-key aggregate reuses
whichever partitioning the months have, as its keys include it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthledger.functions.money import round_money

CONTRACT_MONTH_KEYS = (
    "opportunity_number",
    "usi",
    "ctn",
    "connection_date",
    "gross_mrc",
    "network",
    "claim_month",
    "month_number",
    "product_segment",
    "net_mrc",
    "expected_commission",
    "disconnection_date",
    "disconnection_reason",
    "expected_commission_after_disconnection",
    "last_upgrade_date",
    "upgrade_channel",
    "base_indicator",
    "expected_commission_after_upgrade",
    "ftu_flag",
    "billed_status",
    "final_expected_commission",
)
PAYMENT_GROUP_KEYS = ("period_date", "lvl5", "sos_code", "period_date_converted")


def payments_by_month(monthly: DataFrame) -> DataFrame:
    """Monthly payment rows reduced to the keys the reconciliation groups on.

    The six-key rows are summed per (usi, month, period text, level-5, SOS)
    and ``payment_lines`` counts the six-key rows with a non-NULL sum, which is
    what the reconciliation's COUNT sees.  Both are map-side partial
    aggregates: a contract with very many distinct payment lines (a hot key)
    is spread by the six-key shuffle and collapses before it is re-keyed by
    contract, so every contract reaches the join with at most one row per
    month and period text / code pair.
    """
    return matchable_payments(payment_groups(monthly))


def payment_groups(monthly: DataFrame) -> DataFrame:
    """The groups of ``payments_by_month``, also those without usi or month."""
    return monthly.groupBy("usi", *PAYMENT_GROUP_KEYS).agg(
        F.sum("commission_value").alias("commission_value"),
        F.count("commission_value").alias("payment_lines"),
    )


def matchable_payments(groups: DataFrame) -> DataFrame:
    valid = groups.where(F.col("usi").isNotNull() & F.col("period_date_converted").isNotNull())
    return valid.withColumn("claim_month", F.col("period_date_converted"))


def reconcile_payments(
    months: DataFrame,
    payments: DataFrame,
    copies: str | None = None,
    distinct_months: bool = False,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Join payments to contract months and aggregate (one row per contract
    month and payment period text / codes; unpaid months get one row).

    ``payments`` is the output of ``payments_by_month``.  With ``copies`` the
    month rows carry their copy count: each payment then counts and sums once
    per copy.  ``distinct_months`` asserts that no two month rows share all 21
    contract-month keys (the job proves it, see ``plans.job``): every joined
    row is then its own group, and the 25-key aggregate reduces to a
    projection with the same values.  ``carry``: columns that a contract's rows
    share, taken along.
    """
    keys = (*CONTRACT_MONTH_KEYS, *carry)
    cols = [*keys, copies] if copies else list(keys)
    joined = months.select(*cols).join(payments, ["usi", "claim_month"], "left")
    cv, lines = F.col("commission_value"), F.col("payment_lines")
    w = F.col(copies) if copies else F.lit(1)
    if distinct_months:
        paid = (cv * w).cast("decimal(28,2)")
        count = F.coalesce(lines * w, F.lit(0))
        out = joined.select(*keys, *PAYMENT_GROUP_KEYS, count.alias("payment_count"), paid.alias("commission_paid"))
    else:
        paid = F.sum(cv * w).cast("decimal(28,2)") if copies else F.sum(cv)
        count = F.coalesce(F.sum(lines * w), F.lit(0))
        out = joined.groupBy(*keys, *PAYMENT_GROUP_KEYS).agg(
            count.alias("payment_count"), paid.alias("commission_paid")
        )
    paid_col = F.col("commission_paid")
    return out.withColumn(
        "variance",
        round_money(F.coalesce(paid_col, F.lit(0)) - F.coalesce(F.col("final_expected_commission"), F.lit(0))),
    ).withColumns(
        {
            "usi_date": F.concat(F.col("usi").cast("string"), F.col("period_date").cast("string")),
            "input_filter": F.coalesce("period_date_converted", "claim_month"),
        }
    )
