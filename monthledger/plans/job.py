"""The end-to-end reconciliation job.

Plan shape (each arrow is lazy; Catalyst sees one plan):

    sales ─filter─► ⟕ disconnections ⟕ upgrades      on usi (contract grain)
           └─► explode months up to the payment horizon (Generate, no shuffle)
               ⟕ rate card by month (equi-join, Spark picks by size)
               price rise → pro-rata → net of VAT → tiered commission
               disconnection / upgrade rules
               ⟕ billing status   on (usi, claim_month)
               ⟕ monthly payments on (usi, claim_month)   [pre-aggregated]
               25-key aggregate → classify → claim rows ─► staged table
    staged claim rows ─► spans by usi ─┐
           └───────────────────────────⟕─► 19-column report

Two tables are staged (``sources.stage``): the payments, aggregated, from whose
one scan the horizon comes too, and the claim rows, which the spans and the
report both read.  So each payment feed is scanned once, the reconciliation is
computed once, and a feed that grows meanwhile cannot show in half a report.

The month rows are shuffled once, on (usi, claim_month): the billing and
payments joins and the 25-key aggregate all use that partitioning.  It spreads
a contract over its months, so a contract that holds a large share of the rows
is not one task of the month stage, and adaptive execution can split what is
still skewed.  No partitioning is forced and no session setting is changed.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthledger.functions.pricing import RULES_BY_NETWORK, PriceRiseRules, rules_for
from monthledger.operators.adjustments import (
    apply_non_billing,
    billing_by_month,
    attach_disconnections,
    attach_upgrades,
    late_upgrade_col,
    with_disconnection_rule,
    with_upgrade_rules,
)
from monthledger.operators.claims import SPAN_COLUMNS, claim_report, claim_rows, classify, missing_spans
from monthledger.operators.copies import COPIES, collapse_copies, combined_copies
from monthledger.operators.latest import latest_feeds
from monthledger.operators.months import among_months, month_spine, months_of_several_rates, priced_months, rates_by_network, rates_for, settled
from monthledger.operators.reconcile import matchable_payments, payment_groups, payments_by_month, reconcile_payments
from monthledger.operators.rejects import rejected_payments
from monthledger.operators.sources_clean import (
    non_billing_clean,
    payments_monthly,
    payments_union,
    sales_clean,
    upgrades_clean,
)
from monthledger.sources.schemas import claim_report_schema
from monthledger.sources.stage import Stage
from monthledger.sources.tables import SourceLocation, conform, read_published, read_source, refresh_partitions, write_result

#: One network, or several in one pass.
Networks = str | tuple[str, ...]
ALL_NETWORKS = tuple(RULES_BY_NETWORK)


@dataclass(frozen=True)
class ReconSources:
    """The six input feeds, already conformed to their schemas."""

    sales: DataFrame
    postpay: DataFrame
    ftu: DataFrame
    disconnections: DataFrame
    base_movements: DataFrame
    rates: DataFrame
    #: Readings of ``base_movements`` that take its place, where given
    #: (``operators.latest``): ``upgrades_clean`` rows, and billing statuses.
    upgrades: DataFrame | None = None
    billing: DataFrame | None = None

    @staticmethod
    def read(spark: SparkSession, locations: dict[str, SourceLocation | str]) -> "ReconSources":
        """Read every feed from ``{logical source name: table or path}``."""
        r = lambda name: read_source(spark, name, locations[name])
        return ReconSources(
            sales=r("ao_internal"),
            postpay=r("postpay_revshare"),
            ftu=r("mpd_ftu_compensation"),
            disconnections=r("mpd_disconnection_report"),
            base_movements=r("mpd_base_movement_report"),
            rates=r("commission_reconciliation_rate"),
        )


def monthly_payments(src: ReconSources) -> DataFrame:
    return payments_monthly(payments_union(src.postpay, src.ftu))


def payment_horizon_value(src: ReconSources):
    """Latest paid month over both feeds, evaluated up front as a DATE literal.

    One small aggregate job returning a single value; the literal then folds
    into the spine bound and the rate-card cap (the subquery form would be
    planned once per reference).  NULL when there are no payments.
    """
    latest = payments_union(src.postpay, src.ftu).agg(F.max("period_date_converted")).first()[0]
    return F.lit(latest).cast("date")


@dataclass(frozen=True)
class PaymentSnapshot:
    """Payments by contract and month, and the latest paid month, of one scan."""

    by_month: DataFrame
    horizon: Column


def payment_snapshot(src: ReconSources, stage: Stage) -> PaymentSnapshot:
    """Scan both feeds once: the payment groups are written to ``stage``; the
    horizon (over all payments, also those without a contract) and the
    payments of the join are read from those files."""
    groups = stage.write(payment_groups(monthly_payments(src)), "payments")
    latest = groups.agg(F.max("period_date_converted")).first()[0]
    return PaymentSnapshot(matchable_payments(groups), F.lit(latest).cast("date"))


def rate_card(src: ReconSources, network: Networks) -> DataFrame:
    return rates_for(src.rates, network) if isinstance(network, str) else rates_by_network(src.rates, network)


def price_rules(network: Networks) -> PriceRiseRules | dict[str, PriceRiseRules]:
    return rules_for(network) if isinstance(network, str) else {n: rules_for(n) for n in network}


SALES_COLUMNS = ("opportunity_number", "usi", "ctn", "connection_date", "gross_mrc", "network", "product_segment")
COPY_COUNTS = ["_copies_sale", "_copies_disc", "_copies_upgrade", "_copies_rate", "_copies_billing"]


def _sales(src: ReconSources, network: Networks | None, collapse: bool) -> DataFrame:
    sales = sales_clean(src.sales, network).withColumnRenamed("monthly_recurring_charge", "gross_mrc")
    sales = sales.select(*SALES_COLUMNS)
    return collapse_copies(sales, "_copies_sale") if collapse else sales


def contracts(src: ReconSources, network: Networks | None = "O2", collapse: bool = True) -> DataFrame:
    """Sales of ``network`` with disconnections and upgrades attached (usi grain).

    Every feed arrives collapsed to distinct rows with a copy count, so a hot
    group of identical rows shrinks map-side before the contract shuffle.
    """
    with_disc = attach_disconnections(_sales(src, network, collapse), src.disconnections, copies=_c("_copies_disc", collapse))
    upgrades = upgrades_clean(src.base_movements) if src.upgrades is None else src.upgrades
    return attach_upgrades(with_disc, upgrades, copies=_c("_copies_upgrade", collapse))


def spread(contracts: DataFrame) -> DataFrame:
    """Contracts dealt over as many partitions as the session's shuffles have.

    The months are made from them, up to 36 each, so the contracts' own size
    (by which adaptive execution would pack them into a few tasks) misleads.
    The keys are a sale's, not the contract's alone: sales of one hot contract
    are spread too.
    """
    n = int(contracts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return contracts.repartition(n, "opportunity_number", "usi", "connection_date", "gross_mrc")


def _c(name: str, collapse: bool) -> str | None:
    return name if collapse else None


# ---------------------------------------------------- months that meet a feed --
#: A contract of at least so many sales, and so many times its billing and
#: payment rows, meets these by broadcast: at most that share of all sales.
HOT_SALES = 10_000
HOT_SHARE = 50
_BIT = "cast(pmod(year({0}) * 12 + month({0}), 64) as int)"


@dataclass(frozen=True)
class Meeting:
    """What month rows may meet: which months of a contract do (``marks``: usi
    and a bit a month), the contracts whose rows are broadcast, the feeds."""

    marks: DataFrame
    hot: DataFrame
    billing: DataFrame
    payments: DataFrame | None


def meeting(src: ReconSources, network: Networks, collapse: bool, payments: DataFrame | None) -> Meeting:
    """Months by contract that have a billing or payment row, as 64 bits.

    Month n has bit n modulo 64, so a contract is marked by one number whatever
    it holds, built by a map-side aggregate.  A bit that another month set only
    sends a month the longer way, where it meets nothing.
    """
    nb = non_billing_clean(src.base_movements if src.billing is None else src.billing)
    billing = billing_by_month(nb, _c("_copies_billing", collapse))
    rows = billing.select("usi", "claim_month")
    rows = rows if payments is None else rows.unionByName(payments.select("usi", "claim_month"))
    marks = rows.groupBy("usi").agg(F.bit_or(F.expr(f"shiftleft(1L, {_BIT.format('claim_month')})")).alias("_met"), F.count(F.lit(1)).alias("_rows"))
    large = _sales(src, network, collapse).where(F.col("usi").isNotNull()).groupBy("usi").agg(F.count(F.lit(1)).alias("_sales"))
    large = F.broadcast(large.where(F.col("_sales") >= HOT_SALES))
    is_hot = F.col("_rows") * HOT_SHARE <= F.col("_sales")
    # The hot contracts read ``_met`` too, so that both relations share one shuffle of the marks.
    return Meeting(
        marks.join(large, "usi", "left").select("usi", F.when(is_hot, F.lit(0)).otherwise(F.col("_met")).cast("long").alias("_met")),
        marks.where(F.col("_met") != 0).join(large, "usi").where(is_hot).select("usi"),
        billing,
        payments,
    )


def _from_first_month(marks: str, first: str) -> Column:
    """The marks turned so that bit n is the n-th month from ``first`` on: no
    month row then computes its place in the calendar to read its own."""
    bit = _BIT.format(first)
    return F.expr(f"shiftrightunsigned({marks}, {bit}) | shiftleft({marks}, 64 - {bit})")


def _of_hot(feed: DataFrame, met: Meeting) -> DataFrame:
    return F.broadcast(feed.join(F.broadcast(met.hot), "usi", "left_semi"))


def claimable(contracts: DataFrame) -> DataFrame:
    """Contracts that may have claim rows.

    ``claim_rows`` keeps no row without a contract id and none whose expected
    amount is 0, as all are after an upgrade 21+ months from the connection:
    the same filter, before such a contract becomes up to 36 months.
    """
    return contracts.where(F.col("usi").isNotNull() & ~F.coalesce(late_upgrade_col(), F.lit(False)))


def _spine(
    src: ReconSources, network: Networks, collapse: bool, horizon, met: Meeting, spans: DataFrame | None, claims_only: bool = False
) -> DataFrame:
    """Contract months, not yet priced; bit n of ``_met`` marks that the n-th
    month of the contract meets a billing or payment row.

    ``claims_only``: without months that cannot be claim rows: those of
    contracts that are not ``claimable``, and those from the disconnection's
    month on, whose adjusted amount is 0.
    """
    whole = contracts(src, network, collapse)
    whole = claimable(whole) if claims_only else whole
    whole = whole.join(met.marks, "usi", "left").withColumn("_met", F.coalesce("_met", F.lit(0).cast("long")))
    whole = whole.withColumn("_met", _from_first_month("_met", "connection_date"))
    if spans is not None:
        whole = whole.join(spans, [c for c in spans.columns if c not in SPAN_COLUMNS], "left")
    return month_spine(spread(whole), horizon, before=F.col("disconnection_date") if claims_only else None)


def _priced(
    spine: DataFrame,
    src: ReconSources,
    network: Networks,
    rules: PriceRiseRules | dict[str, PriceRiseRules] | None,
    rate_strategy: str,
    collapse: bool,
    horizon,
    how: str = "left",
    settle: bool = False,
) -> DataFrame:
    """The months priced, after the disconnection and upgrade rules."""
    card, copies = rate_card(src, network), _c("_copies_rate", collapse)
    priced = priced_months(spine, card, rules or price_rules(network), rate_strategy, horizon, copies=copies, how=how, settle=settle)
    return with_upgrade_rules(with_disconnection_rule(priced))


#: Columns of the pricing that no later step reads.
PRICING_ONLY = (
    "claim_start_of_fy", "start_of_claim_month", "start_of_next_claim_month", "days_in_month", "days_pro_rata", "vat",
    "commission_rate_1", "commission_rate_2", "uplifted_mrc", "uplifted_mrc_pro_rata",
)


def _billed(months: DataFrame, billing: DataFrame) -> DataFrame:
    billed = apply_non_billing(months, billing)
    present = [c for c in COPY_COUNTS if c in billed.columns]
    return billed.withColumn(COPIES, combined_copies(present) if present else F.lit(1).cast("long")).drop(*present, "_met")


def _ways(months: DataFrame, met: Meeting) -> list[tuple[DataFrame, DataFrame, DataFrame | None]]:
    """The month rows with the feeds they meet: months that meet nothing stay
    where they are, as do those of hot contracts, whose feed rows come to them;
    only the others are shuffled, by contract and month."""
    far = F.expr("(shiftright(_met, month_number - 1) & 1L) = 1L")
    near_payments = None if met.payments is None else _of_hot(met.payments, met)
    return [(months.where(~far), _of_hot(met.billing, met), near_payments), (months.where(far), met.billing, met.payments)]


def adjusted_months(
    src: ReconSources,
    network: Networks = "O2",
    rules: PriceRiseRules | dict[str, PriceRiseRules] | None = None,
    rate_strategy: str = "auto",
    collapse: bool = True,
    horizon=None,
) -> DataFrame:
    """Priced contract months after disconnection, upgrade and non-billing rules.

    One row per distinct contract month; ``_copies`` holds how many identical
    rows the un-collapsed join would have produced.  ``collapse=False`` carries
    every copy as its own row instead (``_copies`` is then 1).
    """
    horizon = payment_horizon_value(src) if horizon is None else horizon
    met = meeting(src, network, collapse, None)
    months = _priced(_spine(src, network, collapse, horizon, met, None), src, network, rules, rate_strategy, collapse, horizon)
    near, far = [_billed(rows, billing) for rows, billing, _ in _ways(months, met)]
    return near.unionByName(far)


def classified_months(
    src: ReconSources,
    network: Networks = "O2",
    rules: PriceRiseRules | dict[str, PriceRiseRules] | None = None,
    rate_strategy: str = "auto",
    collapse: bool = True,
    snapshot: PaymentSnapshot | None = None,
    spans: DataFrame | None = None,
    settle: bool = True,
    claims_only: bool = False,
) -> DataFrame:
    """Every reconciled contract month with its claim type and status.

    ``snapshot``: the payments, already staged; without it they are scanned for
    the horizon now and for the join when the result is read.  ``spans``: rows
    by contract that its months carry (``missing_spans``).  ``settle``: price
    the months once (``settled``); without it a reader of few columns prices none.
    ``claims_only``: for a reader of ``claim_rows`` only; months that cannot be
    among them are left out before they are priced (``_spine``; months without
    a rate expect no amount).

    With copies collapsed, every feed that multiplies a contract's months is
    distinct on columns that are themselves contract-month keys, so month rows
    are distinct on the 21 keys unless two different rate rows cover one
    month (they could price a month identically).  The 25-key aggregate is an
    identity in all other months and is skipped there.
    """
    horizon = snapshot.horizon if snapshot else payment_horizon_value(src)
    payments = snapshot.by_month if snapshot else payments_by_month(monthly_payments(src))
    met = meeting(src, network, collapse, payments)
    months = _spine(src, network, collapse, horizon, met, spans, claims_only)
    carry = SPAN_COLUMNS if spans is not None else ()
    if collapse and rate_strategy in ("auto", "by_month"):
        several = months_of_several_rates(rate_card(src, network), horizon)
        parts = [(months.where(~among_months(several)), True), (months.where(among_months(several)), False)] if several else [(months, True)]
    else:
        parts = [(months, False)]

    def priced(spine: DataFrame) -> DataFrame:
        rows = _priced(spine, src, network, rules, rate_strategy, collapse, horizon, "inner" if claims_only else "left", settle and not isinstance(network, str))
        return settled(rows.drop(*PRICING_ONLY)) if settle else rows

    reconciled = [
        reconcile_payments(_billed(priced(rows), billing), paid, copies=COPIES, distinct_months=distinct, carry=carry)
        for part, distinct in parts
        for rows, billing, paid in _ways(part, met)
    ]
    return classify(reduce(DataFrame.unionByName, reconciled))


#: What the spans and the report need of a claim row.
CLAIM_COLUMNS = (
    "network", "usi", "ctn", "opportunity_number", "connection_date", "product_segment", "claim_month", "claim_type",
    "payment_status", "ftu_flag", "expected_commission", "adjusted_commission", "commission_paid", "lvl5", "sos_code",
    "input_filter",
)


def staged_claims(
    src: ReconSources,
    stage: Stage,
    network: Networks = "O2",
    rate_strategy: str = "auto",
    rules: PriceRiseRules | dict[str, PriceRiseRules] | None = None,
    collapse: bool = True,
) -> DataFrame:
    """The claim rows (missing or underpaid months), computed once and written
    to ``stage``; payments are staged before them."""
    return stage.write(claims_with_spans(src, stage, network, rate_strategy, rules, collapse), "claims")


def claims_with_spans(
    src: ReconSources,
    stage: Stage,
    network: Networks = "O2",
    rate_strategy: str = "auto",
    rules: PriceRiseRules | dict[str, PriceRiseRules] | None = None,
    collapse: bool = True,
) -> DataFrame:
    """The claim rows, each with its contract's spans; lazy over staged payments.

    Months that cannot be claim rows are not made (``claims_only``).  The others
    are reconciled for the spans, one row a contract, and again for the rows,
    whose contracts then carry the spans: it costs pricing the months twice, but
    no claim row is shuffled to meet its span.
    """
    snapshot = payment_snapshot(src, stage)
    keys = ("usi",) if isinstance(network, str) else ("network", "usi")
    spans = missing_spans(claim_rows(classified_months(src, network, rules, rate_strategy, collapse, snapshot, claims_only=True)), keys)
    classified = classified_months(src, network, rules, rate_strategy, collapse, snapshot, spans, claims_only=True)
    return claim_rows(classified).select(*CLAIM_COLUMNS, *SPAN_COLUMNS)


def reconcile(
    src: ReconSources,
    network: Networks = "O2",
    span_strategy: str = "staged",
    rate_strategy: str = "auto",
    period: tuple | None = None,
    rules: PriceRiseRules | dict[str, PriceRiseRules] | None = None,
    collapse: bool = True,
    stage: Stage | None = None,
    latest: bool = False,
) -> DataFrame:
    """The claim report: months to claim for, with first/last missing months.

    ``network``: one network, or a tuple of them for one pass over all (rates
    and price rises then go by the row's network, spans by contract within its
    network, and ``network`` is the first column).

    ``span_strategy``: ``staged`` writes the payments and the claim rows to
    ``stage`` (default: a stage of its own, deleted when the driver ends), each
    row with its spans, and reads the report from those files; ``attached`` is
    the same without writing the claim rows; ``join`` is lazy and
    computes the reconciliation for both branches; ``window`` is lazy and one
    pass, but a contract is one window group.

    ``latest``: of repeated disconnections, upgrades and billing statuses only
    the last counts (``operators.latest``), instead of each making its own rows.
    """
    several = not isinstance(network, str)
    src = latest_feeds(src) if latest else src
    if span_strategy == "staged":
        stage = stage or Stage(src.sales.sparkSession)
        rows = staged_claims(src, stage, network, rate_strategy, rules, collapse)
        return claim_report(rows, "attached", period, several)
    if span_strategy == "attached":
        rows = claims_with_spans(src, stage or Stage(src.sales.sparkSession), network, rate_strategy, rules, collapse)
        return claim_report(rows, "attached", period, several)
    classified = classified_months(src, network, rules, rate_strategy, collapse)
    return claim_report(classified, span_strategy, period, several)


MONTH = "input_filter"


def run_reconciliation(
    spark: SparkSession,
    src: ReconSources,
    target: str,
    path: str | None = None,
    by_month: bool = False,
    rejects: str | None = None,
    **kw,
) -> DataFrame:
    """Build the report and materialise it as ``target`` (or Parquet at ``path``).

    The same job publishes the second copy by passing another target.  The old
    result stands until the new one is whole.  ``by_month`` makes one partition
    a month, which the optional period window then prunes; with ``period`` and
    an existing ``path`` the run replaces the months it has rows of and leaves
    the others.  ``rejects``: a path for the payments that meet no contract
    month.  The stage lives as long as this call.
    """
    with Stage(spark) as stage:
        report = reconcile(src, **{"stage": stage, "span_strategy": "attached", **kw})
        result = conform(report, claim_report_schema("network" in report.columns))
        if by_month and path is not None and kw.get("period") is not None:
            refresh_partitions(result, path, MONTH)
        else:
            write_result(result, target, path=path, partition=MONTH if by_month else None)
        if rejects is not None:
            sales = sales_clean(src.sales, kw.get("network", "O2"))
            write_result(rejected_payments(payments_union(src.postpay, src.ftu), sales), "rejects", path=rejects)
    if path is None:
        return spark.table(target).select(*result.columns)
    return read_published(spark, path, result.schema, MONTH)
