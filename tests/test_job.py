"""Operators and the job on tiny literal feeds, plan equivalences, plan shape."""

from __future__ import annotations

import datetime as dt
import re
from collections import Counter
from decimal import Decimal
from functools import reduce

import pytest
from pyspark.sql import functions as F

from monthledger.plans import job
from monthledger.functions.pricing import O2, VODAFONE, price_rise, price_rise_by_network
from monthledger.plans.job import ReconSources
from monthledger.plans.queries import queries
from monthledger.operators import latest as L
from monthledger.operators import months as M
from monthledger.operators import rejects as R
from monthledger.operators.claims import claim_rows, missing_spans
from monthledger.sources import schemas as S
from monthledger.sources.fixtures import RATE_CARD, fixture_sources
from monthledger.sources.stage import Stage
from monthledger.sources.tables import conform, read_published, refresh_partitions, write_result
from conftest import SMALL_SF

d = dt.date.fromisoformat


def sources(spark, sales=(), postpay=(), ftu=(), disc=(), bm=(), rates=None) -> ReconSources:
    def mk(rows, schema):
        return conform(spark.createDataFrame(list(rows), schema), schema)

    return ReconSources(
        sales=mk(sales, S.SALES),
        postpay=mk(postpay, S.POSTPAY),
        ftu=mk(ftu, S.FTU),
        disconnections=mk(disc, S.DISCONNECTIONS),
        base_movements=mk(bm, S.BASE_MOVEMENTS),
        rates=mk(RATE_CARD if rates is None else rates, S.RATES),
    )


def sale(usi, conn="2023-01-10", mrc="30.00", net="O2", status="Activated", seg="New Contract"):
    return (f"op{usi}", usi, f"ctn{usi}", d(conn) if conn else None, Decimal(mrc), net, status, seg)


def pay(usi, period, value, mpn="m1", lvl5="5L1", sos="R1"):
    return (usi, period, Decimal(value), mpn, lvl5, sos, "Line Rental", "In Contract-71%")


def test_empty_payments_give_no_months(spark):
    src = sources(spark, sales=[sale("1")])
    assert job.adjusted_months(src).count() == 0
    assert job.reconcile(src).count() == 0


def test_horizon_and_spine_bounds(spark):
    src = sources(spark, sales=[sale("1", "2023-01-31")], postpay=[pay("1", "Jun-23", "1.00")])
    months = job.adjusted_months(src).orderBy("month_number").collect()
    assert [r.month_number for r in months] == [1, 2, 3, 4, 5, 6]
    assert all(r.claim_month.day == 1 for r in months)
    assert months[-1].claim_month == d("2023-06-01")


def test_first_month_prorata_and_month_25(spark):
    src = sources(spark, sales=[sale("1", "2024-04-10", "30.00")], postpay=[pay("1", "Apr-24", "1.00")])
    r = job.adjusted_months(src).first()
    assert r.days_pro_rata == 21  # the connection day counts
    assert r.uplifted_mrc_pro_rata == Decimal("21.00")
    assert r.net_mrc == Decimal("17.50")
    assert r.expected_commission == Decimal("12.25")  # 2022+ O2 rate card: 0.70


def test_month_25_clamps_month_end(spark):
    src = sources(spark, sales=[sale("1", "2022-01-31")], postpay=[pay("1", "Jan-24", "1.00")])
    df = M.with_prorata_days(M.with_calendar(M.month_spine(src.sales.select(
        "usi", F.col("activated_date").alias("connection_date")))))
    r = df.where("month_number = 25").first()
    assert r.claim_month == d("2024-01-01") and r.days_pro_rata == 1  # 31 Jan -> 31 Jan: last day only
    feb = df.where("month_number = 2").first()
    assert feb.days_pro_rata is None


def test_duplicate_disconnections_fan_out_and_double(spark):
    same = ("1", d("2030-01-01"), "moved")
    src = sources(spark, sales=[sale("1")], postpay=[pay("1", "Jan-23", "5.00")], disc=[same, same])
    rec = job.classified_months(src).where("claim_month = date'2023-01-01'").collect()
    assert len(rec) == 1  # identical rows collapse in the 25-key group ...
    assert rec[0].payment_count == 2 and rec[0].commission_paid == Decimal("10.00")  # ... and double
    other = ("1", d("2031-01-01"), "moved")
    src2 = sources(spark, sales=[sale("1")], postpay=[pay("1", "Jan-23", "5.00")], disc=[same, other])
    assert job.classified_months(src2).where("claim_month = date'2023-01-01'").count() == 2


def test_copies_multiply_across_feeds(spark):
    s, dc = sale("1"), ("1", d("2030-01-01"), "x")
    src = sources(spark, sales=[s, s], postpay=[pay("1", "Jan-23", "5.00")], disc=[dc, dc, dc])
    rec = job.classified_months(src).where("claim_month = date'2023-01-01'").collect()
    assert len(rec) == 1 and rec[0].payment_count == 6 and rec[0].commission_paid == Decimal("30.00")
    months = job.adjusted_months(src).where("claim_month = date'2023-01-01'").collect()
    assert [r["_copies"] for r in months] == [6]
    assert job.adjusted_months(src, collapse=False).where("claim_month = date'2023-01-01'").count() == 6


def test_collapsed_and_uncollapsed_plans_agree(spark):
    s, dc, up = sale("1"), ("1", d("2023-03-20"), "x"), ("1", "15/03/2023 10:00", "w", "BASE OFF", 202302, "NON BILLED")
    p = [pay("1", "Jan-23", "5.00"), pay("1", "Jan-23", "5.00"), pay("1", "Feb-23", "0.00", mpn="m2")]
    src = sources(spark, sales=[s, s, sale("2")], postpay=p, disc=[dc, dc], bm=[up, up, up])
    a = job.classified_months(src, collapse=True).drop("_copies")
    b = job.classified_months(src, collapse=False).drop("_copies")
    assert _rows(a) == _rows(b) and _rows(a)


def test_hot_contract_with_many_payment_lines(spark):
    lines = [pay("1", f"{m}-23", "1.00", mpn=f"m{i}") for i in range(100) for m in ("Jan", "Feb", "Mar")]
    src = sources(spark, sales=[sale("1"), sale("2")], postpay=lines + [pay("2", "Jan-23", "1.00")])
    rows = job.classified_months(src).where("usi = '1'").collect()
    assert len(rows) == 3
    assert all(r.payment_count == 100 and r.commission_paid == Decimal("100.00") for r in rows)


def test_overlapping_rates_keep_the_aggregate(spark):
    """Two rate rows pricing the same month identically must collapse into one
    group (the aggregate is only skipped when no month has two rate rows)."""
    from monthledger.operators.months import one_rate_per_month, rates_for

    rates = list(RATE_CARD) + [("O2", Decimal("0.20"), Decimal("0.7001"), Decimal("0.30"), d("2022-01-01"), d("2025-09-15"))]
    src = sources(spark, sales=[sale("1", mrc="12.00")], postpay=[pay("1", "Jan-23", "5.00")], rates=rates)
    assert not one_rate_per_month(rates_for(src.rates, "O2"))
    assert one_rate_per_month(rates_for(sources(spark).rates, "O2"))
    a = job.classified_months(src).drop("_copies")
    b = job.classified_months(src, collapse=False).drop("_copies")
    assert _rows(a) == _rows(b)
    jan = a.where("claim_month = date'2023-01-01'").collect()
    assert len(jan) == 1 and jan[0].payment_count == 2  # both rate rows price 7.00 -> one group, counted twice


def test_mixed_case_period_text_is_two_groups(spark):
    src = sources(spark, sales=[sale("1")], postpay=[pay("1", "Jan-23", "1.00"), pay("1", "JAN-23", "2.00")])
    rows = job.classified_months(src).where("claim_month = date'2023-01-01'").collect()
    assert sorted(r.commission_paid for r in rows) == [Decimal("1.00"), Decimal("2.00")]
    assert {r.final_expected_commission for r in rows} == {rows[0].final_expected_commission}


def test_clawback_without_rate_is_no_claim(spark):
    rates = [("O2", Decimal("0.2"), Decimal("0.7"), Decimal("0.3"), d("2030-01-01"), d("2030-12-31"))]
    src = sources(spark, sales=[sale("1")], postpay=[pay("1", "Jan-23", "-1.00")], rates=rates)
    r = job.classified_months(src).where("claim_month = date'2023-01-01'").first()
    assert r.expected_commission is None and r.claim_type == "No Claim"


def test_overlapping_rates_duplicate_months_in_both_plans(spark):
    rates = list(RATE_CARD) + [("O2", Decimal("0.2"), Decimal("0.5"), Decimal("0.3"), d("2023-01-01"), d("2023-03-31"))]
    src = sources(spark, sales=[sale("1")], postpay=[pay("1", "Jun-23", "1.00")], rates=rates)
    spine = M.month_spine(src.sales.select("usi", F.col("activated_date").alias("connection_date")), F.lit(d("2023-06-01")))
    r = M.rates_for(src.rates, "O2")
    a = M.rate_lookup(spine, r, "range").select("claim_month", "commission_rate_1")
    b = M.rate_lookup(spine, r, "by_month", F.lit(d("2023-06-01"))).select("claim_month", "commission_rate_1")
    assert sorted(a.collect()) == sorted(b.collect())
    assert a.count() == 6 + 3


def test_null_usi_never_reported(spark):
    src = sources(spark, sales=[sale(None), sale("2")], postpay=[pay("2", "Feb-23", "0.00")])
    assert job.classified_months(src).where("usi is null").count() > 0
    assert job.reconcile(src).where("usi is null").count() == 0


def test_non_billed_month_becomes_disconnected_label(spark):
    bm = [("1", "01/01/2020 00:00", "x", "BASE ON", 202302, "NON BILLED")]
    src = sources(spark, sales=[sale("1")], postpay=[pay("1", "Mar-23", "1.00")], bm=bm)
    r = job.classified_months(src).where("claim_month = date'2023-02-01'").first()
    assert r.final_expected_commission == 0 and r.claim_type == "Customer Disconnected"


def test_upgrade_rules(spark):
    late = [("1", "15/10/2024 10:00", "web", "BASE OFF", 202401, "BILLED")]  # 21 months after Jan-23
    early = [("1", "15/03/2023 10:00", "web", "BASE OFF", 202401, "BILLED")]
    p = [pay("1", "Jan-23", "0.00")]
    r = job.classified_months(sources(spark, sales=[sale("1")], postpay=p, bm=late)).first()
    assert r.expected_commission_after_upgrade == 0 and r.ftu_flag is None
    r = job.classified_months(sources(spark, sales=[sale("1")], postpay=p, bm=early)).first()
    assert r.ftu_flag == "FTU" and r.expected_commission_after_upgrade == r.expected_commission_after_disconnection


@pytest.fixture(scope="module")
def small(spark):
    return fixture_sources(spark, SMALL_SF)


def _rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_span_strategies_agree(spark, small):
    base = _rows(job.reconcile(small, span_strategy="window"))
    assert base
    assert _rows(job.reconcile(small, span_strategy="join")) == base
    assert _rows(job.reconcile(small)) == base


def test_staged_report_is_computed_once_from_two_files(spark, small, tmp_path):
    """The report's plan reads the staged claims for both branches: no month is
    generated and no feed scanned again; the folder goes with its stage."""
    with Stage(spark, str(tmp_path)) as stage:
        report = job.reconcile(small, stage=stage)
        plan = _plan(report)
        assert "Generate" not in plan and all(f"{stage.path}/claims/" in f for f in report.inputFiles())
        assert sorted(x.name for x in next(tmp_path.iterdir()).iterdir()) == ["claims", "payments"]
        assert report.count() > 0
    assert list(tmp_path.iterdir()) == []


def test_a_run_leaves_no_stage(spark, tmp_path, monkeypatch):
    src = sources(spark, sales=[sale("1")], postpay=[pay("1", "Mar-23", "1.00")])
    monkeypatch.setattr("monthledger.sources.stage.shared_base", lambda _: str(tmp_path / "shared"))
    job.run_reconciliation(spark, src, "report", path=str(tmp_path / "out"))
    assert list((tmp_path / "shared").iterdir()) == []
    with pytest.raises(ValueError, match="rate lookup"):
        job.run_reconciliation(spark, src, "report", path=str(tmp_path / "out"), rate_strategy="none")
    assert list((tmp_path / "shared").iterdir()) == []


def test_a_feed_that_grows_cannot_show_in_half_a_report(spark, tmp_path):
    src = sources(spark, sales=[sale("1"), sale("2")])
    path = str(tmp_path / "postpay")
    first = conform(spark.createDataFrame([pay("1", "Mar-23", "1.00")], S.POSTPAY), S.POSTPAY)
    first.write.parquet(path)
    grown = ReconSources(**{**src.__dict__, "postpay": spark.read.parquet(path)})
    report = job.reconcile(grown)
    want = _rows(job.reconcile(ReconSources(**{**src.__dict__, "postpay": first})))
    conform(spark.createDataFrame([pay("2", "Sep-23", "99.00")], S.POSTPAY), S.POSTPAY).write.mode("append").parquet(path)
    assert _rows(report) == want and want


def test_payment_feeds_are_scanned_once(spark, tmp_path):
    src = sources(spark, postpay=[pay("1", "Mar-23", "1.00")], ftu=[("1", "Apr-23", Decimal("2.00"), "m", "5L1", "R1")])
    reads = spark.sparkContext.accumulator(0)
    counted = src.postpay.mapInPandas(lambda it: (reads.add(len(x)) or x for x in it), src.postpay.schema)
    with Stage(spark, str(tmp_path)) as stage:
        snap = job.payment_snapshot(ReconSources(**{**src.__dict__, "postpay": counted}), stage)
        assert snap.by_month.count() == 2 and reads.value == 1
        assert spark.range(1).select(snap.horizon).first()[0] == d("2023-04-01")
        none = job.payment_snapshot(sources(spark), Stage(spark, str(tmp_path)))
        assert none.by_month.count() == 0 and spark.range(1).select(none.horizon).first()[0] is None


def test_all_networks_equal_the_runs_of_each(spark, small):
    every = job.reconcile(small, network=job.ALL_NETWORKS)
    single = Counter((n, *r) for n in job.ALL_NETWORKS for r in job.reconcile(small, network=n).collect())
    assert _rows(every) == single and len({k[0] for k in single}) == 2


def test_no_method_of_the_pricing_is_too_long_to_compile(spark, small, tmp_path):
    """The JVM interprets methods of over 8000 bytes, and gave up on some of 7000 too."""
    with Stage(spark, str(tmp_path)) as stage:
        rows = job.claims_with_spans(small, stage, job.ALL_NETWORKS)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            stages = rows._jdf.queryExecution().debug().codegenToSeq()
            sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size()) if "uplifted_mrc" in stages.apply(i)._1()]
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sizes and max(sizes) < 7500, sizes


def test_a_network_with_the_default_rules_has_no_branch_of_its_own(spark):
    row = "'{}' as net, cast(30 as decimal(18,2)) as mrc, date'2021-06-10' as conn, date'2024-04-01' as fy"
    rows = reduce(lambda a, b: a.union(b), [spark.sql("select " + row.format(n)) for n in ("O2", "Vodafone", "Other")])
    rows = rows.union(spark.sql("select " + row.format("x").replace("'x'", "cast(null as string)")))
    got = {r.net: r.v for r in rows.select("net", price_rise_by_network("net", "mrc", "conn", "fy").alias("v")).collect()}
    own = rows.select("net", price_rise("mrc", "conn", "fy", O2).alias("o2"), price_rise("mrc", "conn", "fy", VODAFONE).alias("v")).first()
    assert own.o2 != own.v and got == {"O2": own.o2, "Vodafone": own.v, "Other": own.v, None: own.v}
    assert str(price_rise_by_network("net", "mrc", "conn", "fy")).count("Vodafone") == 0
    assert rows.select(price_rise_by_network("net", "mrc", "conn", "fy", {"Vodafone": VODAFONE}).alias("v")).first().v == own.v


def _awkward(spark) -> ReconSources:
    """Months on every side of what may be a claim: disconnections in, before and after the contract and on a month's
    last day, early and late upgrades, months without a rate, unbilled ones, copies, no contract id."""
    sales = [sale(str(i), "2023-01-10", mrc=f"{20 + i}.00") for i in range(12)] + [sale("3"), sale("3"), sale(None), sale("12", "2017-06-30"), sale("13", "2025-01-01", mrc="-5.00"), sale("14", mrc="0.00")]
    off = lambda u, day: (u, f"{day} 09:00", "c", "BASE OFF", 202303, "NON BILLED")
    return sources(
        spark,
        sales=sales,
        postpay=[pay("0", "Mar-23", "1.00"), pay("2", "May-23", "9.00"), pay("3", "Apr-24", "1.00"), pay("5", "Feb-24", "50.00"), pay(None, "Dec-25", "1.00")],
        ftu=[("4", "Jun-23", Decimal("0.01"), "m", "5L1", "R1"), ("6", "Jan-23", Decimal("-3.00"), "m", "5L1", "R1")],
        disc=[(u, day and d(day), "r") for u, day in (("1", "2023-05-31"), ("2", "2023-05-01"), ("3", "2022-12-31"), ("3", "2024-02-29"), ("4", "2030-01-01"), ("5", None), ("6", "2023-01-10"), (None, "2023-02-01"))],
        bm=[off("7", "01/10/2024"), off("7", "01/02/2023"), off("8", "30/09/2024"), off("9", "10/01/2022"), off("2", "01/11/2024"), off(None, "01/11/2024")],
        rates=RATE_CARD + [("O2", Decimal("0.20"), Decimal("0.60"), Decimal("0.30"), d("2023-03-01"), d("2023-05-31"))],
    )


@pytest.mark.parametrize("collapse, strategy", [(True, "auto"), (True, "range"), (False, "auto")])
def test_months_that_cannot_be_claims_are_not_priced(spark, collapse, strategy):
    src = _awkward(spark)
    every = job.classified_months(src, rate_strategy=strategy, collapse=collapse)
    fewer = job.classified_months(src, rate_strategy=strategy, collapse=collapse, claims_only=True)
    assert _rows(claim_rows(fewer)) == _rows(claim_rows(every))
    assert _rows(claim_rows(fewer)) and fewer.count() < every.count()
    disconnected = (F.col("disconnection_date") <= F.last_day("claim_month")) | F.col("usi").isNull() | (F.col("last_upgrade_date") >= d("2024-10-01"))
    assert fewer.where(disconnected).count() == 0 and every.where(disconnected).count() > 0


@pytest.mark.parametrize("latest", [False, True])
def test_the_report_of_fewer_months_is_whole(spark, latest):
    src = _awkward(spark)
    whole = _rows(job.reconcile(src, span_strategy="join", latest=latest))
    assert whole and _rows(job.reconcile(src, span_strategy="attached", latest=latest)) == whole
    assert _rows(job.reconcile(src, latest=latest)) == whole


@pytest.mark.parametrize("name", ["reconcile_all_networks", "reconcile_repeated", "reconcile_skewed"])
def test_large_reports_are_not_written_to_be_written_again(spark, name):
    report = queries()[name](spark, SMALL_SF)
    assert not any("/claims/" in f for f in report.inputFiles()) and any("/payments/" in f for f in report.inputFiles())


def test_one_contract_id_in_two_networks(spark):
    src = sources(
        spark,
        sales=[sale("1", "2023-01-10"), sale("1", "2023-06-10", net="Vodafone"), sale("3", net="Other"), sale("4", net=None)],
        postpay=[pay("1", "Sep-23", "0.00")],
    )
    every = job.reconcile(src, network=("O2", "Vodafone"))
    single = Counter((n, *r) for n in ("O2", "Vodafone") for r in job.reconcile(src, network=n).collect())
    assert _rows(every) == single
    first = {(r.network, r.first_missing_revenue_share_month) for r in every.collect()}
    assert first == {("O2", d("2023-01-01")), ("Vodafone", d("2023-06-01"))}


def test_interval_index_over_a_million_rates(spark):
    """10^6 rate rows of 5,000 networks, each with 200 windows of half a month."""
    one = "cast(0.2 as decimal(6,4))"
    rates = spark.range(10**6).selectExpr(
        "concat('n', id % 5000) as network", f"{one} as vat", "cast(id / 5000 as int) as commission_rate_1", f"{one} as commission_rate_2",
        "date_add(date'2018-01-01', cast(id / 5000 as int) * 15) as active_date", "date_add(date'2018-01-01', cast(id / 5000 as int) * 15 + 14) as end_date",
    )
    spine = spark.range(20_000).selectExpr("concat('n', id % 6000) as network", "add_months(date'2017-11-01', cast(id % 120 as int)) as claim_month")
    got = M.rate_lookup(spine, rates, "range", F.lit(d("2027-12-01")))
    assert "NestedLoop" not in _plan(got) and "Cartesian" not in _plan(got)
    window = F.floor(F.datediff("claim_month", F.lit(d("2018-01-01"))) / 15)
    known = (F.substring("network", 2, 9).cast("int") < 5000) & window.between(0, 199)
    assert got.count() == 20_000
    assert got.where(~F.col("commission_rate_1").eqNullSafe(F.when(known, window))).count() == 0


@pytest.mark.parametrize("cap", [d("2024-06-01"), None])
def test_interval_index_keeps_long_open_and_partial_windows(spark, cap):
    def row(rate, a, e):
        return ("n", Decimal("0.2"), Decimal(rate), Decimal("0.1"), a and d(a), e and d(e))

    rates = spark.createDataFrame(
        [row("0.1", "1900-01-01", "9999-12-31"), row("0.2", "2023-03-02", "2023-05-01"), row("0.3", "2023-12-01", "2024-01-01"), row("0.4", "2024-02-01", "2023-02-01"), row("0.5", None, "2024-01-01")],
        "network string, vat decimal(6,4), commission_rate_1 decimal(6,4), commission_rate_2 decimal(6,4), active_date date, end_date date",
    )
    spine = spark.range(24).selectExpr("'n' as network", "add_months(date'2022-07-01', cast(id as int)) as claim_month")
    got = M.rate_lookup(spine, rates, "range", None if cap is None else F.lit(cap)).groupBy("claim_month").agg(F.sort_array(F.collect_list("commission_rate_1")).alias("r"))
    for r in got.collect():
        want = [x.commission_rate_1 for x in rates.collect() if x.active_date and x.active_date <= r.claim_month <= x.end_date]
        assert r.r == sorted(want)
    assert M.rate_lookup(spine.limit(0), rates, "range").count() == 0


def test_rate_lookup_forms_agree(spark, small):
    h = job.payment_horizon_value(small)
    spine = M.month_spine(job.contracts(small), h)
    r = M.rates_for(small.rates, "O2")
    cols = ["usi", "claim_month", "vat", "commission_rate_1", "commission_rate_2"]
    assert _rows(M.rate_lookup(spine, r, "range").select(cols)) == _rows(
        M.rate_lookup(spine, r, "by_month", h).select(cols)
    )


def test_report_invariants(spark, small):
    rep = job.reconcile(small)
    assert {r.claim_type for r in rep.select("claim_type").distinct().collect()} <= {"Missing Payment", "Underpaid"}
    bad = rep.where(
        (F.col("first_missing_revenue_share_month") > F.col("revenuesharemonthmissingto"))
        | (F.col("firstmissingftucompensationmonth") < F.col("first_missing_revenue_share_month"))
        | (F.col("ftucompensationmonthmissingto") > F.col("revenuesharemonthmissingto"))
        | (F.col("payment_status").isNotNull() != (F.col("claim_type") == "Missing Payment"))
    )
    assert bad.count() == 0


def test_spans_match_groupby(spark, small):
    claims = claim_rows(job.classified_months(small))
    spans = {r.usi: (r.first_missing_revenue_share_month, r.revenuesharemonthmissingto) for r in missing_spans(claims).collect()}
    rep = job.reconcile(small).select("usi", "first_missing_revenue_share_month", "revenuesharemonthmissingto").distinct()
    assert {r.usi: (r[1], r[2]) for r in rep.collect()} == spans


def _exchanges_above_generate(plan: str) -> list[str]:
    """Exchange lines of a plan tree that have a Generate (the month explode)
    somewhere below them."""
    lines = plan.splitlines()

    def depth(line: str) -> int:
        return len(line) - len(line.lstrip(" :+-"))

    bad = []
    for i, line in enumerate(lines):
        if "Exchange" not in line or "BroadcastExchange" in line:
            continue
        d = depth(line)
        for below in lines[i + 1 :]:
            if depth(below) <= d:
                break
            if "Generate" in below and "explode(sequence(0" in below:
                bad.append(line.strip())
                break
    return bad


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_month_rows_are_shuffled_once_on_contract_and_month(spark, small):
    """Both month joins and the 25-key aggregate use one exchange of the month
    rows, whose keys hold the month, so a contract is not one task."""
    own = spark.newSession()
    own.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as at scale
    src = fixture_sources(own, SMALL_SF)
    above = _exchanges_above_generate(_plan(job.classified_months(src)))
    keyed = [x for x in above if "hashpartitioning(usi" in x]
    assert len(keyed) == 1 and "claim_month" in keyed[0], above


def test_plans_do_not_depend_on_what_ran_before(spark):
    own = spark.newSession()
    src = fixture_sources(own, SMALL_SF)
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    shape = lambda: Counter(re.findall(r"[A-Z]\w+", x)[0] for x in _plan(job.classified_months(src)).splitlines() if x.strip())
    before, setting = shape(), own.conf.get(name)
    job.reconcile(src).count()
    assert shape() == before and own.conf.get(name) == setting


def test_a_hot_contract_spreads_over_its_months(spark):
    hot = [sale("hot", mrc=f"{10 + i}.00") for i in range(200)]
    even = [sale(str(i)) for i in range(200)]
    src = sources(spark, sales=hot + even, postpay=[pay("hot", "Dec-24", "1.00")])
    months = job.adjusted_months(src).where("usi = 'hot'")
    held = months.repartition(64, "usi", "claim_month").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(held) > 8 and sum(r["count"] for r in held) == 200 * 24


def test_report_tables_in_two_targets_and_view(spark, tmp_path):
    """K1-K3: the report as two tables of the declared schema, and as a view."""
    from monthledger.sources.tables import register_view

    p = [pay("1", "Jan-23", "0.00"), pay("1", "Mar-23", "2.00")]
    src = sources(spark, sales=[sale("1")], postpay=p)
    for name in ("reports_a", "reports_b"):
        spark.sql(f"create schema {name} location '{tmp_path / name}'")
        written = job.run_reconciliation(spark, src, f"{name}.claims")
        assert [(f.name, f.dataType) for f in written.schema] == [(f.name, f.dataType) for f in S.CLAIM_REPORT]
        assert _rows(written) == _rows(job.reconcile(src)) and written.count() > 0
        register_view(written, "claims_view")
        assert _rows(spark.table("claims_view")) == _rows(written)
        spark.sql(f"drop schema {name} cascade")


def _published(spark, tmp_path, name="claims", **kw):
    p = [pay("1", "Jan-23", "0.00"), pay("1", "Mar-23", "2.00")]
    src = sources(spark, sales=[sale("1")], postpay=p)
    path = str(tmp_path / name)
    return src, path, job.run_reconciliation(spark, src, name, path=path, by_month=True, **kw)


def test_published_months_are_well_compressed(spark, tmp_path):
    _, path, _ = _published(spark, tmp_path)
    files = spark.read.parquet(path).inputFiles()
    assert files and all(f.endswith(".zstd.parquet") for f in files)


def test_published_by_month_and_pruned(spark, tmp_path):
    src, path, written = _published(spark, tmp_path)
    assert _rows(written) == _rows(job.reconcile(src)) and written.columns == [f.name for f in S.CLAIM_REPORT]
    assert sorted(x.name for x in (tmp_path / "claims").glob("input_filter=*")) == [f"input_filter=2023-0{m}-01" for m in (1, 2, 3)]
    feb = read_published(spark, path, S.CLAIM_REPORT, "input_filter", "2023-02-01", "2023-02-28")
    assert _rows(feb) == _rows(job.reconcile(src, period=("2023-02-01", "2023-02-28"))) and feb.count() == 1
    assert re.search(r"PartitionFilters: \[[^]]*input_filter", _plan(feb))
    scan = feb._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.relation().location().listFiles(scan.partitionFilters(), scan.dataFilters()).size() == 1


def test_a_period_run_replaces_its_months_only(spark, tmp_path):
    src, path, before = _published(spark, tmp_path)
    old = before.collect()
    dearer = ReconSources(**{**src.__dict__, "sales": conform(spark.createDataFrame([sale("1", mrc="60.00")], S.SALES), S.SALES)})
    now = job.run_reconciliation(spark, dearer, "claims", path=path, by_month=True, period=("2023-02-01", "2023-02-28")).collect()
    other = lambda rows: Counter(tuple(r) for r in rows if r.claim_month != d("2023-02-01"))
    assert other(now) == other(old) and len(now) == len(old)
    value = lambda rows: next(r.expectedtotalvalue for r in rows if r.claim_month == d("2023-02-01"))
    assert value(now) == 2 * value(old)


def test_a_failed_write_leaves_the_old_result(spark, tmp_path):
    src, path, before = _published(spark, tmp_path)
    old = _rows(before)
    broken = spark.range(0, 3, 1, 1).selectExpr("id as x", "raise_error('no') as y")
    with pytest.raises(Exception, match="no"):
        write_result(broken, "claims", path=path)
    assert _rows(spark.read.schema(S.CLAIM_REPORT).parquet(path).select(*before.columns)) == old
    assert [x.name for x in tmp_path.iterdir()] == ["claims"]
    spark.sql(f"create schema kept location '{tmp_path / 'kept'}'")
    write_result(spark.range(2), "kept.t")
    with pytest.raises(Exception, match="no"):
        write_result(broken, "kept.t")
    assert spark.table("kept.t").count() == 2
    write_result(spark.range(5), "kept.t")
    assert spark.table("kept.t").count() == 5 and [r.tableName for r in spark.sql("show tables in kept").collect()] == ["t"]
    spark.sql("drop schema kept cascade")


def test_rejected_payments_have_a_reason_each(spark, tmp_path):
    p = [pay("1", "Jan-23", "1.00"), pay(None, "Jan-23", "2.00"), pay("1", "someday", "3.00"), pay(None, None, "4.00"), pay("9", "Jan-23", "5.00"), pay("9", "Jan-23", "5.00"), pay("1", "Dec-22", "6.00"), pay("1", "Jan-26", "7.00"), pay("1", "Dec-25", "8.00"), pay("2", "Jan-23", "9.00")]
    src = sources(spark, sales=[sale("1"), sale("1", "2023-05-05"), sale("1", "2022-12-31", net="Vodafone"), sale("2", status="Cancelled"), sale(None)], postpay=p)
    judged = R.with_rejection(job.payments_union(src.postpay, src.ftu), job.sales_clean(src.sales))
    assert {r.commission_value: r.reason for r in judged.collect()} == {
        Decimal("1.00"): None, Decimal("2.00"): R.NO_ID, Decimal("3.00"): R.UNREADABLE, Decimal("4.00"): R.NO_ID, Decimal("5.00"): R.UNKNOWN,
        Decimal("6.00"): R.OUTSIDE, Decimal("7.00"): None, Decimal("8.00"): None, Decimal("9.00"): R.UNKNOWN,
    }
    counts = {r.reason: (r.payment_lines, r.commission_value) for r in R.rejection_counts(judged).collect()}
    assert counts[R.UNKNOWN] == (3, Decimal("19.00")) and counts["accepted"] == (3, Decimal("16.00"))
    out = str(tmp_path / "rejects")
    job.run_reconciliation(spark, src, "r", path=str(tmp_path / "report"), rejects=out)
    assert _rows(spark.read.parquet(out)) == _rows(judged.where("reason is not null"))


def test_latest_rows_win(spark):
    disc = [("1", d("2023-02-01"), "a"), ("1", d("2023-03-01"), "b"), ("1", d("2023-03-01"), "c"), ("1", None, "z"), ("2", None, "x"), ("2", None, None), (None, d("2023-01-01"), "n")]
    got = L.latest_disconnections(sources(spark, disc=disc).disconnections)
    assert _rows(got) == Counter([("1", d("2023-03-01"), "c"), ("2", None, "x"), (None, d("2023-01-01"), "n")])
    bm = [("1", "15/03/2023 10:00", "w", "BASE OFF", 202302, "NON BILLED"), ("1", "16/03/2023 10:00", "v", "BASE ON", 202302, "BILLED"), ("1", "15/04/2023 10:00", "u", "BASE OFF", 202303, "BILLED")]
    src = sources(spark, sales=[sale("1")], postpay=[pay("1", "Mar-23", "1.00")], disc=disc[:4], bm=bm)
    latest = L.latest_feeds(src)
    assert _rows(latest.billing) == Counter([("1", 202302, "BILLED"), ("1", 202303, "BILLED")])
    assert [tuple(r)[:3] for r in latest.upgrades.collect()] == [("1", d("2023-04-15"), "u")]
    assert job.classified_months(latest).count() == 3 < job.classified_months(src).count()
    assert L.latest_disconnections(sources(spark).disconnections).count() == 0
    plan = _plan(L.latest_disconnections(sources(spark, disc=disc).disconnections))
    assert "partial_max" in plan


def test_read_feeds_and_write_report(spark, small, tmp_path):
    """Readers (declared schemas, edge casts) and the materialised output."""
    names = {
        "ao_internal": small.sales,
        "postpay_revshare": small.postpay,
        "mpd_ftu_compensation": small.ftu,
        "mpd_disconnection_report": small.disconnections,
        "mpd_base_movement_report": small.base_movements,
        "commission_reconciliation_rate": small.rates,
    }
    locations = {}
    for name, df in names.items():
        path = str(tmp_path / name)
        df.write.parquet(path)
        locations[name] = path
    src = ReconSources.read(spark, locations)
    out = str(tmp_path / "o2final")
    written = job.run_reconciliation(spark, src, "report", path=out)
    assert _rows(written) == _rows(job.reconcile(small))


def test_spine_invariants_on_fixture(spark, small):
    spine = M.month_spine(job.contracts(small), job.payment_horizon_value(small))
    per_sale = spine.groupBy("usi").count().agg(F.max("count")).first()[0]
    assert 0 < per_sale <= 36
    assert spine.where(F.dayofmonth("claim_month") != 1).count() == 0
    assert spine.where(~F.col("month_number").between(1, 36)).count() == 0


@pytest.mark.parametrize("strategy", ["auto", "by_month", "range"])
def test_rate_rows_without_an_end_or_start_match_nothing(spark, strategy):
    spine = spark.createDataFrame([(d("2023-01-01"),), (d("2023-02-01"),)], "claim_month date")
    from decimal import Decimal as D

    one = D("0.20")
    rows = [(one, one, one, d("2022-01-01"), None), (one, one, one, None, d("2024-01-01")), (one, D("0.30"), one, d("2023-02-01"), d("2023-02-28"))]
    rates = spark.createDataFrame(rows, "vat decimal(10,4), commission_rate_1 decimal(10,4), commission_rate_2 decimal(10,4), active_date date, end_date date")
    got = M.rate_lookup(spine, rates, strategy, F.lit(d("2023-06-01"))).select("claim_month", "commission_rate_1").collect()
    assert {(str(r[0]), None if r[1] is None else float(r[1])) for r in got} == {("2023-01-01", None), ("2023-02-01", 0.3)} and len(got) == 2


def test_only_months_that_meet_a_feed_are_shuffled(spark, monkeypatch):
    """Months by broadcast, by shuffle and left alone give the rows of the
    uncollapsed plan, also with overlapping rates and null contracts."""
    sales = [sale("hot", mrc=f"{10 + i}.00") for i in range(60)] + [sale(str(i)) for i in range(9)] + [sale("1"), sale(None)]
    p = [pay("hot", "Mar-23", "1.00"), pay("1", "Mar-23", "2.00"), pay("1", "Mar-23", "2.00", sos="R2"), pay("2", "Feb-24", "0.50"), pay("3", "Dec-17", "5.00"), pay(None, "Jun-24", "1.00")]
    bm = [(u, "10/01/2024 00:00", "c", "BASE ON", m, "NON BILLED") for u, m in (("hot", 202305), ("hot", 202305), ("2", 202306), (None, 202306), ("4", None))]
    rates = [*RATE_CARD, ("O2", Decimal("0.2"), Decimal("0.5"), Decimal("0.3"), d("2023-05-01"), d("2023-06-30"))]
    for card in (None, rates):
        src = sources(spark, sales=sales, postpay=p, bm=bm, rates=card)
        want = _rows(job.classified_months(src, collapse=False).drop("_copies"))
        for least in (10_000, 10):
            monkeypatch.setattr(job, "HOT_SALES", least)
            monkeypatch.setattr(job, "HOT_SHARE", 2)
            assert _rows(job.classified_months(src).drop("_copies")) == want
    far = job.meeting(src, "O2", True, None).marks.where("_met <> 0")
    assert {r.usi for r in far.collect()} == {"2"}


def test_claim_rows_are_not_shuffled_to_their_spans(spark, small):
    own = spark.newSession()
    own.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as at scale
    plan = _plan(job.reconcile(fixture_sources(own, SMALL_SF)))
    assert "Exchange" not in plan and "Join" not in plan


def test_claims_are_filtered_after_the_months_are_priced(spark):
    """The filter on claim types is not pushed below the pricing (which it would repeat)."""
    df = spark.range(4).withColumn("price", F.col("id") * 3 + 1)
    kept = job.settled(df).where("price > 4")
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter") < plan.index("Generate inline")
    assert sorted(tuple(r) for r in kept.collect()) == [(2, 7), (3, 10)]


def test_classified_months_are_settled(spark):
    src = sources(spark, sales=[sale("1"), sale(None)], postpay=[pay("1", "Mar-23", "1.00")])
    plan = job.classified_months(src)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate inline") == 2  # months that meet a feed, and the others
    kept = ["usi", "claim_month", "payment_status", "expected_commission"]
    a, b = [sorted(map(str, job.classified_months(src, settle=s).select(*kept).collect())) for s in (True, False)]
    assert a == b and len(a) == 6


def test_marks_are_read_by_the_number_of_the_month(spark):
    """No month row computes its place in the calendar to find whether it meets a feed."""
    sales = [sale(str(i), f"{2019 + i // 12}-{i % 12 + 1:02d}-15") for i in range(70)]
    payments = [pay(str(i), f"{(d('2019-01-01').replace(year=2019 + (i + n) // 12, month=(i + n) % 12 + 1)):%b-%y}", "1.00") for i in range(70) for n in (0, i % 36, 35)]
    src = sources(spark, sales=sales, postpay=payments)
    paid = job.classified_months(src).where("commission_paid is not null").select("usi", "month_number").collect()
    assert {(int(r.usi), r.month_number - 1) for r in paid} == {(i, n) for i in range(70) for n in (0, i % 36, 35)}
    met = job.meeting(src, "O2", True, job.payments_by_month(job.monthly_payments(src)))
    spine = job._spine(src, "O2", True, job.payment_horizon_value(src), met, None)
    far = job._ways(spine, met)[1][0]
    assert {(int(r.usi), r.month_number - 1) for r in far.collect()} == {(int(r.usi), r.month_number - 1) for r in paid}
    conditions = re.findall(r"Filter \(*shiftright\(_met.*", far._jdf.queryExecution().optimizedPlan().toString())
    assert conditions and not any("year(" in c for c in conditions)


def test_months_of_a_year_are_written_by_one_task(spark, tmp_path):
    """So a contract's rows stay neighbours in the shuffle, which compresses them together."""
    own = spark.newSession()
    own.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    own.conf.set("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "false")
    rows = own.range(240).selectExpr("id", "add_months(date'2021-01-01', cast(id % 24 as int)) as m")
    path = str(tmp_path / "t")
    for kw in ({}, {"mode": "append"}):
        write_result(rows, "t", path=path, partition="m", **kw)
    refresh = rows.where("m < date'2022-01-01'")
    refresh_partitions(refresh, path, "m")
    kept = own.read.parquet(path)
    assert sorted(r.id for r in kept.collect()) == sorted([*range(240), *[i for i in range(240) if i % 24 >= 12]])
    tasks = kept.selectExpr("year(m) as y", "regexp_extract(input_file_name(), 'part-([0-9]+)', 1) as task").distinct()
    assert all(r["count"] == 1 for r in tasks.groupBy("y").count().collect()) and len(kept.columns) == 2
    write_result(rows.selectExpr("id", "cast(m as string) as m"), "s", path=str(tmp_path / "s"), partition="m")
    assert own.read.parquet(str(tmp_path / "s")).count() == 240


@pytest.mark.parametrize("name", ["rate_lookup_by_month", "ftu_flag", "payment_status"])
def test_months_are_not_planned_to_be_shuffled_to_meet_the_rate_card(spark, name):
    from monthledger.plans.queries import REGISTRY

    plan = REGISTRY[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [claim_month" in plan and "hashpartitioning(claim_month" not in plan
