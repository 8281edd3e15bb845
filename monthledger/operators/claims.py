"""Classify reconciled contract months and build the claim report.

Spans (first and last missing month per contract, overall and FTU-only) are
computed only over claim rows.  Equivalent plans are offered:

``join``    group the claim rows by ``usi`` (map-side partial min/max, so a hot
            contract collapses before the shuffle) and join the spans back;
            AQE can split a skewed ``usi`` partition of that join.
``window``  ``min/max ... OVER (PARTITION BY usi)`` on the claim rows: one
            exchange, no join, but a hot contract is one window partition.
``attached`` the rows already carry their spans (``plans.job`` joins them to the
            contracts, before these become up to 36 months each).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from monthledger.functions.dates import date_lit, first_of_month
from monthledger.functions.money import dec
from monthledger.operators.adjustments import FTU, NON_BILLED, adjusted_commission_col

MISSING = "Missing Payment"
UNDERPAID = "Underpaid"
CLAIM_TYPES = (MISSING, UNDERPAID)
DEFAULT_LEVEL5 = "5L6890"
DEFAULT_SOS = "R23"
PAID_TOLERANCE = "0.10"
OVERPAID_FROM = "0.05"


def _paid() -> Column:
    return F.coalesce(F.col("commission_paid"), F.lit(0))


def missing_col() -> Column:
    """Nothing paid although a positive amount is expected."""
    return (_paid() == 0) & (F.col("adjusted_commission") > 0)


def claim_type_col() -> Column:
    """First matching label wins."""
    adj, var = F.col("adjusted_commission"), F.col("variance")
    return (
        F.when(adj == 0, "Customer Disconnected")
        .when(missing_col(), MISSING)
        .when((var > -dec(PAID_TOLERANCE)) & (var < dec(PAID_TOLERANCE)), "Paid")
        .when(var >= dec(OVERPAID_FROM), "Overpaid")
        .when(F.col("commission_paid") < adj, UNDERPAID)
        .otherwise("No Claim")
    )


def payment_status_col() -> Column:
    """Why a payment is missing: upgrade, non-billing, or genuinely missing."""
    up = first_of_month("last_upgrade_date")
    upgraded = (up >= F.col("connection_date")) & (up <= first_of_month("claim_month"))
    reason = (
        F.when(upgraded, "Customer Upgraded")
        .when(F.col("billed_status") == NON_BILLED, "Customer not billed")
        .otherwise(MISSING)
    )
    return F.when(missing_col(), reason)


def missing_flag_col() -> Column:
    return F.when(missing_col(), 1).otherwise(0)


def classify(reconciled: DataFrame) -> DataFrame:
    """Adjusted commission, claim type, payment status and the 0/1 flag."""
    return reconciled.withColumn("adjusted_commission", adjusted_commission_col()).withColumns(
        {"claim_type": claim_type_col(), "payment_status": payment_status_col(), "test": missing_flag_col()}
    )


def claim_rows(classified: DataFrame) -> DataFrame:
    """Rows to claim for: missing or underpaid, with a contract id."""
    return classified.where(F.col("claim_type").isin(*CLAIM_TYPES) & F.col("usi").isNotNull())


SPAN_COLUMNS = (
    "first_missing_revenue_share_month",
    "revenuesharemonthmissingto",
    "firstmissingftucompensationmonth",
    "ftucompensationmonthmissingto",
)


def _span_aggs() -> list[Column]:
    m = F.col("claim_month")
    ftu_m = F.when(F.col("ftu_flag") == FTU, m)
    return [F.min(m), F.max(m), F.min(ftu_m), F.max(ftu_m)]


def missing_spans(claims: DataFrame, keys: tuple[str, ...] = ("usi",)) -> DataFrame:
    """Per contract: first/last claim month, overall and FTU-only."""
    return claims.groupBy(*keys).agg(*[a.alias(n) for a, n in zip(_span_aggs(), SPAN_COLUMNS)])


def with_spans(claims: DataFrame, strategy: str = "join", keys: tuple[str, ...] = ("usi",)) -> DataFrame:
    if strategy == "join":
        return claims.join(missing_spans(claims, keys), list(keys), "inner")
    if strategy == "attached":  # the rows came with their spans
        return claims
    if strategy == "window":
        w = Window.partitionBy(*keys)
        return claims.withColumns({n: a.over(w) for a, n in zip(_span_aggs(), SPAN_COLUMNS)})
    raise ValueError(f"unknown span strategy {strategy!r}")


def payment_type_col() -> Column:
    return F.when(F.col("ftu_flag") == FTU, "FTU Compensation").otherwise("Postpay Revenue Share")


def event_type_col() -> Column:
    seg = F.col("product_segment")
    return F.when(seg == "New Contract", "Connection").when(seg == "Upgrade", "Resign").otherwise(seg)


def comment_col() -> Column:
    """Underpaid amount uses the unadjusted expected commission."""
    ct = F.col("claim_type")
    short = F.round("expected_commission", 2) - F.round("commission_paid", 2)
    return (
        F.when(ct == MISSING, "No payment found")
        .when(ct == UNDERPAID, F.concat(F.lit("Underpaid by "), short.cast("string")))
        .otherwise("Paid in full")
    )


def label_columns() -> dict[str, Column]:
    return {
        "paymenttype": payment_type_col(),
        "eventtype": event_type_col(),
        "comment": comment_col(),
        "level5code": F.coalesce(F.col("lvl5"), F.lit(DEFAULT_LEVEL5)),
        "soscode": F.coalesce(F.col("sos_code"), F.lit(DEFAULT_SOS)),
    }


def claims_in_period(report: DataFrame, start: dt.date | str | None, end: dt.date | str | None) -> DataFrame:
    """Optional reporting window on ``input_filter`` (inclusive)."""
    f = F.col("input_filter")
    if start is not None:
        report = report.where(f >= date_lit(start))
    if end is not None:
        report = report.where(f <= date_lit(end))
    return report


def claim_report(
    classified: DataFrame,
    span_strategy: str = "join",
    period: tuple | None = None,
    by_network: bool = False,
) -> DataFrame:
    """The 19-column claim report over classified contract months.

    ``by_network``: contracts of several networks; a span is then that of the
    contract within its network, and ``network`` is the report's first column.
    """
    keys = ("network", "usi") if by_network else ("usi",)
    rows = with_spans(claim_rows(classified), span_strategy, keys)
    out = rows.withColumns(label_columns()).select(
        *keys[:-1],
        "payment_status",
        "usi",
        F.col("ctn").alias("mpn"),
        F.col("opportunity_number").alias("ordernumber"),
        "connection_date",
        "claim_type",
        "claim_month",
        "paymenttype",
        "eventtype",
        F.col("adjusted_commission").alias("expectedtotalvalue"),
        F.col("commission_paid").alias("valuepaid"),
        *SPAN_COLUMNS,
        "comment",
        "level5code",
        "soscode",
        "input_filter",
    )
    if period is not None:
        out = claims_in_period(out, *period)
    return out
