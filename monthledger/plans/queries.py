"""Query registry: one Spark DataFrame per operator, over the test tables.

Each entry takes ``(spark, sf_dir)``, derives the six feeds from the Parquet
tables under ``sf_dir`` and runs one operator of the job (or the whole job).
Outputs are passed through ``for_check``: money as DOUBLE and counters as
BIGINT, the same types the DuckDB oracle (``plans.oracle``) returns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthledger.functions.pricing import VODAFONE, price_rise, price_rise_exclusive, price_rise_simple_accrual
from monthledger.operators.claims import claim_rows, label_columns, missing_spans
from monthledger.operators.latest import latest_billing, latest_disconnections, latest_upgrades
from monthledger.operators.months import (
    month_spine,
    priced_months,
    rate_lookup,
    rates_by_network,
    rates_for,
    with_calendar,
    with_prorata_days,
)
from monthledger.operators.rejects import rejection_counts, with_rejection
from monthledger.operators.sources_clean import (
    non_billing_clean,
    payment_horizon,
    payments_union,
    sales_clean,
    upgrades_clean,
)
from monthledger.plans.job import (
    ALL_NETWORKS,
    Networks,
    ReconSources,
    adjusted_months,
    classified_months,
    monthly_payments,
    payment_horizon_value,
    payment_snapshot,
    reconcile,
    run_reconciliation,
)
from monthledger.plans.oracle import CLAIMS_PERIOD
from monthledger.sources.fixtures import fixture_sources, repeated_sources, skewed_sources
from monthledger.sources.stage import Stage
from monthledger.sources.tables import read_published

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


def for_check(df: DataFrame) -> DataFrame:
    """Cast DECIMAL -> DOUBLE and INT -> BIGINT (after all arithmetic)."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(name: str, feeds: Callable[[SparkSession, str], ReconSources] = fixture_sources):
    def deco(fn: Callable[[ReconSources], DataFrame]) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return for_check(fn(feeds(spark, sf_dir)))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        return fn

    return deco


CM = ("usi", "claim_month", "month_number")
PAY_KEYS = ("period_date", "lvl5", "sos_code")


def _sales(src: ReconSources, network: str | None = "O2") -> DataFrame:
    return sales_clean(src.sales, network).withColumnRenamed("monthly_recurring_charge", "gross_mrc")


def _horizon_spine(src: ReconSources, network: str | None = "O2", horizon=None) -> DataFrame:
    return month_spine(_sales(src, network), payment_horizon_value(src) if horizon is None else horizon)


def _priced(src: ReconSources, rate_strategy: str = "auto") -> DataFrame:
    horizon = payment_horizon_value(src)
    spine = _horizon_spine(src, horizon=horizon)
    return priced_months(spine, rates_for(src.rates, "O2"), rate_strategy=rate_strategy, horizon=horizon)


def _calendar(src: ReconSources) -> DataFrame:
    return with_prorata_days(with_calendar(_horizon_spine(src)))


# ------------------------------------------------------------------ scans --
@query("scan_sales")
def _scan_sales(src):
    """Sales feed."""
    return src.sales


@query("scan_postpay")
def _scan_postpay(src):
    """Revenue-share payments feed."""
    return src.postpay


@query("scan_ftu")
def _scan_ftu(src):
    """S3: FTU-compensation payments feed."""
    return src.ftu


@query("scan_disconnection")
def _scan_disc(src):
    """Disconnections feed."""
    return src.disconnections


@query("scan_base_movement")
def _scan_bm(src):
    """Base movements feed."""
    return src.base_movements


# ------------------------------------------------------------ clean feeds --
@query("sales_clean")
def _sales_clean(src):
    """Activated O2 sales, renamed, charge rounded."""
    return sales_clean(src.sales)


@query("payments_union")
def _payments_union(src):
    """Both payment feeds on one column list."""
    return payments_union(src.postpay, src.ftu)


@query("payments_monthly")
def _payments_monthly(src):
    """Payments summed by six keys."""
    return monthly_payments(src)


@query("payment_horizon")
def _payment_horizon(src):
    """A3: latest paid month."""
    return payment_horizon(monthly_payments(src))


@query("upgrades_clean")
def _upgrades_clean(src):
    """BASE OFF movements with parsed upgrade date."""
    return upgrades_clean(src.base_movements)


@query("non_billing_clean")
def _non_billing_clean(src):
    """Base movements with their yyyymm month parsed."""
    return non_billing_clean(src.base_movements)


# ------------------------------------------------------------------ spine --
@query("month_spine")
def _month_spine(src):
    """Every sale times 36 months."""
    return month_spine(_sales(src)).select("connection_date", *CM)


@query("month_spine_horizon")
def _month_spine_horizon(src):
    """months up to the latest paid month."""
    return _horizon_spine(src).select("connection_date", *CM)


@query("month_spine_calendar")
def _month_spine_calendar(src):
    """P5, B2: calendar columns per claim month."""
    return _calendar(src).select(
        *CM, "claim_start_of_fy", "start_of_claim_month", "start_of_next_claim_month", "days_in_month"
    )


@query("fiscal_year_start")
def _fiscal_year_start(src):
    """Fiscal-year start of each claim month."""
    return _calendar(src).select(*CM, "claim_start_of_fy")


@query("rate_lookup")
def _rate_lookup(src):
    """Rate row valid at the claim month (interval index and interval)."""
    horizon = payment_horizon_value(src)
    df = rate_lookup(_horizon_spine(src, horizon=horizon), rates_for(src.rates, "O2"), "range", horizon)
    return df.select(*CM, "vat", "commission_rate_1", "commission_rate_2")


@query("rate_lookup_by_month")
def _rate_lookup_by_month(src):
    """Same lookup through the month-expanded rate card (equi-join)."""
    horizon = payment_horizon_value(src)
    df = rate_lookup(_horizon_spine(src, horizon=horizon), rates_for(src.rates, "O2"), "by_month", horizon)
    return df.select(*CM, "vat", "commission_rate_1", "commission_rate_2")


# ---------------------------------------------------------------- pricing --
@query("price_rise_o2")
def _price_rise_o2(src):
    """Live O2 price rise."""
    return _priced(src).select(*CM, "connection_date", "claim_start_of_fy", "gross_mrc", "uplifted_mrc")


@query("price_rise_vodafone")
def _price_rise_vodafone(src):
    """Live Vodafone rule set over the Vodafone sales."""
    df = with_calendar(_horizon_spine(src, "Vodafone"))
    up = price_rise("gross_mrc", "connection_date", "claim_start_of_fy", VODAFONE)
    return df.select(*CM, "connection_date", "claim_start_of_fy", "gross_mrc", up.alias("uplifted_mrc"))


@query("price_rise_exclusive")
def _price_rise_exclusive(src):
    """Earlier exclusive rule, per-row network, all networks."""
    df = with_calendar(_horizon_spine(src, None))
    up = price_rise_exclusive("network", "gross_mrc", "connection_date", "claim_start_of_fy")
    return df.select("network", *CM, up.alias("uplifted_mrc"))


@query("price_rise_simple_accrual")
def _price_rise_simple_accrual(src):
    """Earliest simple-accrual rule (O2)."""
    df = with_calendar(_horizon_spine(src))
    up = price_rise_simple_accrual("gross_mrc", "connection_date", "claim_month", "claim_start_of_fy")
    return df.select(*CM, up.alias("uplifted_mrc"))


# ------------------------------------------------------------- commission --
@query("prorata_days")
def _prorata_days(src):
    """Days paid in months 1 and 25."""
    return _calendar(src).select(*CM, "days_in_month", "days_pro_rata")


@query("first_month_prorata")
def _first_month_prorata(src):
    """First-month pro-rata of the uplifted charge."""
    return _priced(src).select(*CM, "uplifted_mrc", "uplifted_mrc_pro_rata")


@query("net_of_vat")
def _net_of_vat(src):
    """Charge net of VAT."""
    return _priced(src).select(*CM, "uplifted_mrc_pro_rata", "vat", "net_mrc")


@query("expected_commission")
def _expected_commission(src):
    """Tiered expected commission (the priced month series)."""
    return _priced(src).select(
        "opportunity_number", "usi", "ctn", "connection_date", "gross_mrc", "network", "product_segment",
        "claim_month", "month_number", "claim_start_of_fy", "days_in_month", "days_pro_rata", "uplifted_mrc",
        "uplifted_mrc_pro_rata", "net_mrc", "expected_commission",
    )


# ------------------------------------------------------------ adjustments --
def _months(src: ReconSources) -> DataFrame:
    """The job's adjusted months, every copy a row of its own."""
    return adjusted_months(src, collapse=False)


@query("apply_disconnection")
def _apply_disconnection(src):
    """Disconnection rule."""
    return _months(src).select(
        *CM, "expected_commission", "disconnection_date", "disconnection_reason",
        "expected_commission_after_disconnection",
    )


@query("apply_upgrade")
def _apply_upgrade(src):
    """Upgrade rule."""
    return _months(src).select(
        *CM, "last_upgrade_date", "upgrade_channel", "base_indicator", "expected_commission_after_upgrade"
    )


@query("ftu_flag")
def _ftu_flag(src):
    """FTU flag."""
    return _months(src).select(*CM, "last_upgrade_date", "ftu_flag")


@query("apply_non_billing")
def _apply_non_billing(src):
    """Non-billing rule."""
    return _months(src).select(*CM, "billed_status", "final_expected_commission")


# --------------------------------------------------------- reconciliation --
def _staged(src: ReconSources, network: Networks = "O2", settle: bool = True) -> DataFrame:
    """Every classified month over payments staged once."""
    return classified_months(src, network, snapshot=payment_snapshot(src, Stage(src.sales.sparkSession)), settle=settle)


def _reconciled(src: ReconSources) -> DataFrame:
    return _staged(src)


@query("reconcile_payments")
def _reconcile_payments(src):
    """Payments joined and aggregated by 25 keys."""
    return _reconciled(src).select(
        "opportunity_number", "usi", "ctn", "connection_date", "gross_mrc", "network", "claim_month",
        "month_number", "product_segment", "net_mrc", "expected_commission", "disconnection_date",
        "disconnection_reason", "expected_commission_after_disconnection", "last_upgrade_date", "upgrade_channel",
        "base_indicator", "expected_commission_after_upgrade", "ftu_flag", "billed_status",
        "final_expected_commission", "usi_date", "payment_count", "commission_paid", "variance", "lvl5",
        "sos_code", "input_filter",
    )


@query("payment_variance")
def _payment_variance(src):
    """Paid minus expected."""
    return _reconciled(src).select(*CM, *PAY_KEYS, "commission_paid", "final_expected_commission", "variance")


@query("payment_key")
def _payment_key(src):
    """Contract + period text key."""
    return _staged(src, settle=False).select(*CM, *PAY_KEYS, "usi_date")


@query("adjusted_commission")
def _adjusted_commission(src):
    """Disconnection adjustment of the final amount."""
    return _reconciled(src).select(
        *CM, *PAY_KEYS, "disconnection_date", "final_expected_commission", "adjusted_commission"
    )


@query("claim_type")
def _claim_type(src):
    """Claim type."""
    return _staged(src).select(
        *CM, *PAY_KEYS, "adjusted_commission", "commission_paid", "variance", "claim_type"
    )


@query("payment_status")
def _payment_status(src):
    """Payment status."""
    return _staged(src).select(
        *CM, *PAY_KEYS, "claim_type", "last_upgrade_date", "billed_status", "payment_status"
    )


@query("missing_flag")
def _missing_flag(src):
    """Missing-payment 0/1 flag."""
    return _staged(src).select(*CM, *PAY_KEYS, "test")


def _spans(src: ReconSources, ftu_only: bool) -> DataFrame:
    snapshot = payment_snapshot(src, Stage(src.sales.sparkSession))
    spans = missing_spans(claim_rows(classified_months(src, snapshot=snapshot)))
    if ftu_only:
        return spans.where(F.col("firstmissingftucompensationmonth").isNotNull()).select(
            "usi",
            F.col("firstmissingftucompensationmonth").alias("first_missing_revenue_share_month"),
            F.col("ftucompensationmonthmissingto").alias("last_missing_revshare_month"),
        )
    return spans.select(
        "usi",
        "first_missing_revenue_share_month",
        F.col("revenuesharemonthmissingto").alias("last_missing_revshare_month"),
    )


@query("missing_span")
def _missing_span(src):
    """first/last missing month per contract."""
    return _spans(src, False)


@query("missing_span_ftu")
def _missing_span_ftu(src):
    """first/last missing FTU month per contract."""
    return _spans(src, True)


@query("claim_labels")
def _claim_labels(src):
    """Report labels on every classified month."""
    return (
        _staged(src)
        .withColumns(label_columns())
        .select(*CM, *PAY_KEYS, "claim_type", "paymenttype", "eventtype", "comment", "level5code", "soscode")
    )


@query("claims_in_period")
def _claims_in_period(src):
    """The report restricted to a reporting window on input_filter."""
    return reconcile(src, period=CLAIMS_PERIOD)


@query("claims_published")
def _claims_published(src):
    """K1, F8: the report published by month, the window read back from its months."""
    spark = src.sales.sparkSession
    stage = Stage(spark)
    path = f"{stage.path}/published"
    published = run_reconciliation(spark, src, "claims", path=path, by_month=True, stage=stage)
    return read_published(spark, path, published.schema, "input_filter", *CLAIMS_PERIOD)


@query("reconcile_claims")
def _reconcile_claims(src):
    """The full claim report (flagship)."""
    return reconcile(src)


@query("reconcile_all_networks")
def _reconcile_all_networks(src):
    """The claim report of every network in one pass."""
    return reconcile(src, network=ALL_NETWORKS, span_strategy="attached")


@query("rate_lookup_all_networks")
def _rate_lookup_all_networks(src):
    """Rates by (network, month block) for the sales of all networks."""
    horizon = payment_horizon_value(src)
    spine = _horizon_spine(src, ALL_NETWORKS, horizon)
    df = rate_lookup(spine, rates_by_network(src.rates, ALL_NETWORKS), "range", horizon)
    return df.select("network", *CM, "vat", "commission_rate_1", "commission_rate_2")


# ------------------------------------------------- repeated and skewed feeds --
@query("latest_disconnections", repeated_sources)
def _latest_disconnections(src):
    """The last disconnection of each contract."""
    return latest_disconnections(src.disconnections)


@query("latest_upgrades", repeated_sources)
def _latest_upgrades(src):
    """The last upgrade of each contract."""
    return latest_upgrades(upgrades_clean(src.base_movements))


@query("latest_billing", repeated_sources)
def _latest_billing(src):
    """The last billing status of each contract and period."""
    return latest_billing(src.base_movements)


@query("reconcile_latest", repeated_sources)
def _reconcile_latest(src):
    """The claim report where the last of repeated feed rows counts."""
    return reconcile(src, latest=True)


@query("reconcile_repeated", repeated_sources)
def _reconcile_repeated(src):
    """The same feeds with every repeated row counted."""
    return reconcile(src, span_strategy="attached")


@query("reconcile_skewed", skewed_sources)
def _reconcile_skewed(src):
    """A contract with a fifth of all rows, copies, overlapping rates."""
    return reconcile(src, span_strategy="attached")


# ------------------------------------------------------------ rejected rows --
def _judged(src: ReconSources) -> DataFrame:
    return with_rejection(payments_union(src.postpay, src.ftu), sales_clean(src.sales))


@query("rejected_payments")
def _rejected_payments(src):
    """Payments that meet no contract month, with the reason."""
    return _judged(src).where(F.col("reason").isNotNull())


@query("rejection_counts", skewed_sources)
def _rejection_counts(src):
    """Payment lines and amounts by reason, over the skewed feeds."""
    return rejection_counts(_judged(src))


def queries() -> dict[str, QueryFn]:
    return dict(REGISTRY)
