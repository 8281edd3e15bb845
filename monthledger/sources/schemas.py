"""Explicit schemas of the reconciliation sources and of the claim report.

The upstream feeds declare no types, so every reader casts to these at the
edge (see ``sources.tables``).  Money is a two-decimal fixed point and rates
are four-decimal fractions; both stay decimal through the whole job so that
every ``round`` is exact and HALF_UP.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
RATE = T.DecimalType(6, 4)
SALE_CHARGE = T.DecimalType(18, 4)


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


S = T.StringType()

SALES = _schema(
    ("opportunitynumber", S),
    ("usi", S),
    ("ctn", S),
    ("activated_date", T.DateType()),
    ("monthly_recurring_charge", SALE_CHARGE),
    ("network", S),
    ("currentorderstatus", S),
    ("product_segment", S),
)

POSTPAY = _schema(
    ("usi", S),
    ("period_date", S),
    ("commission_value", MONEY),
    ("mpn", S),
    ("lvl5", S),
    ("sos_code", S),
    ("revenue_feature_group_name", S),
    ("description", S),
)

FTU = _schema(
    ("usi", S),
    ("periodname", S),
    ("commissionvalue", MONEY),
    ("mpn", S),
    ("level5", S),
    ("soscode", S),
)

DISCONNECTIONS = _schema(
    ("usi", S),
    ("disconnection_date", T.DateType()),
    ("disconnection_reason", S),
)

BASE_MOVEMENTS = _schema(
    ("usi", S),
    ("last_upgrade_date", S),
    ("upgrade_channel", S),
    ("base_indicator", S),
    ("period", T.IntegerType()),
    ("billed_status", S),
)

RATES = _schema(
    ("operator", S),
    ("vat", RATE),
    ("commission_rate_1", RATE),
    ("commission_rate_2", RATE),
    ("active_date", T.DateType()),
    ("end_date", T.DateType()),
)

# The claim report: 19 columns in report order.
CLAIM_REPORT = _schema(
    ("payment_status", S),
    ("usi", S),
    ("mpn", S),
    ("ordernumber", S),
    ("connection_date", T.DateType()),
    ("claim_type", S),
    ("claim_month", T.DateType()),
    ("paymenttype", S),
    ("eventtype", S),
    ("expectedtotalvalue", MONEY),
    ("valuepaid", T.DecimalType(28, 2)),
    ("first_missing_revenue_share_month", T.DateType()),
    ("revenuesharemonthmissingto", T.DateType()),
    ("firstmissingftucompensationmonth", T.DateType()),
    ("ftucompensationmonthmissingto", T.DateType()),
    ("comment", S),
    ("level5code", S),
    ("soscode", S),
    ("input_filter", T.DateType()),
)


def claim_report_schema(by_network: bool = False) -> T.StructType:
    """The report's schema; that of several networks starts with the network."""
    return T.StructType([T.StructField("network", S), *CLAIM_REPORT.fields]) if by_network else CLAIM_REPORT


# Logical source name -> schema.  The dealer statement is declared upstream
# but read by no step of the job, so it has no schema and no reader.
SOURCE_SCHEMAS: dict[str, T.StructType] = {
    "ao_internal": SALES,
    "postpay_revshare": POSTPAY,
    "mpd_ftu_compensation": FTU,
    "mpd_disconnection_report": DISCONNECTIONS,
    "mpd_base_movement_report": BASE_MOVEMENTS,
    "commission_reconciliation_rate": RATES,
}
