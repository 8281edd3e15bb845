"""Cleaned views of the raw feeds (filters, renames, parsing).

Each function is a narrow projection + filter, so Catalyst prunes the scan to
the used columns and pushes the literal predicates into the Parquet reader.
Right-hand feeds drop NULL ``usi`` rows: they can match no contract, and
keeping them would pile every NULL key onto one shuffle partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthledger.functions.dates import parse_day_month_year_time, parse_period_month, parse_yyyymm
from monthledger.functions.money import round_money

ACTIVE_ORDER_STATUSES = ("Activated", "Exchange", "Exchange Received")
REVSHARE_FEATURE = "Line Rental"
REVSHARE_DESCRIPTION = "In Contract-71%"
BASE_OFF = "BASE OFF"


def sales_clean(sales: DataFrame, network: str | tuple[str, ...] | None = "O2") -> DataFrame:
    """Activated sales of one or several networks (``None`` keeps every row)."""
    cond = F.col("currentorderstatus").isin(*ACTIVE_ORDER_STATUSES) & F.col("activated_date").isNotNull()
    if network is not None:
        cond = cond & F.col("network").isin(*((network,) if isinstance(network, str) else network))
    return sales.where(cond).select(
        F.col("opportunitynumber").alias("opportunity_number"),
        "usi",
        "ctn",
        F.col("activated_date").alias("connection_date"),
        round_money("monthly_recurring_charge").alias("monthly_recurring_charge"),
        "network",
        F.col("currentorderstatus").alias("current_order_status"),
        "product_segment",
    )


def payments_union(postpay: DataFrame, ftu: DataFrame) -> DataFrame:
    """Both payment feeds on one column list (UNION ALL), months parsed."""
    rev = postpay.where(
        (F.col("revenue_feature_group_name") == REVSHARE_FEATURE) & (F.col("description") == REVSHARE_DESCRIPTION)
    ).select("usi", "period_date", "commission_value", "mpn", "lvl5", "sos_code")
    comp = ftu.select(
        "usi",
        F.col("periodname").alias("period_date"),
        F.col("commissionvalue").alias("commission_value"),
        "mpn",
        F.col("level5").alias("lvl5"),
        F.col("soscode").alias("sos_code"),
    )
    return rev.unionByName(comp).select(
        "usi",
        "period_date",
        parse_period_month("period_date").alias("period_date_converted"),
        "commission_value",
        "mpn",
        "lvl5",
        "sos_code",
    )


PAYMENT_KEYS = ("usi", "period_date", "period_date_converted", "mpn", "lvl5", "sos_code")


def payments_monthly(payments: DataFrame) -> DataFrame:
    """Payments summed per contract, period text, month, product and codes.

    A hash aggregate with map-side partial sums, so copies of one payment line
    collapse before the shuffle.
    """
    return payments.groupBy(*PAYMENT_KEYS).agg(F.sum("commission_value").alias("commission_value"))


def payment_horizon(monthly: DataFrame) -> DataFrame:
    """One row: the latest paid month and the last day of that month."""
    m = F.max("period_date_converted")
    return monthly.agg(m.alias("max_month"), F.last_day(m).alias("horizon_end"))


def upgrades_clean(base_movements: DataFrame, strict: bool = True) -> DataFrame:
    """``BASE OFF`` movements with the upgrade date parsed to a DATE."""
    return base_movements.where(F.col("base_indicator") == BASE_OFF).select(
        "usi",
        parse_day_month_year_time("last_upgrade_date", strict).alias("last_upgrade_date"),
        "upgrade_channel",
        "base_indicator",
    )


def non_billing_clean(base_movements: DataFrame) -> DataFrame:
    """Every base movement with its ``yyyymm`` period as a first-of-month."""
    return base_movements.select(
        "usi",
        "period",
        "billed_status",
        parse_yyyymm("period").alias("period_start_of_month"),
    )
