"""Column functions: calendar, money and price-rise golden cases."""

from __future__ import annotations

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from monthledger.functions import dates as D
from monthledger.functions import pricing as P
from monthledger.functions.money import dec, prorate, round_money


def one(spark, col, schema="x int", row=(1,)):
    return spark.createDataFrame([row], schema).select(col.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "a,b,expected",
    [
        ("2024-01-31", "2024-02-01", 1),  # boundary counted, not whole months
        ("2024-02-01", "2024-01-31", -1),
        ("2021-06-15", "2023-03-01", 21),
        ("2021-06-15", "2023-02-28", 20),
        ("2024-03-05", "2024-03-31", 0),
    ],
)
def test_month_diff_counts_boundaries(spark, a, b, expected):
    assert one(spark, D.month_diff(F.to_date(F.lit(a)), F.to_date(F.lit(b)))) == expected


@pytest.mark.parametrize(
    "d,expected",
    [("2024-03-05", "2023-04-01"), ("2024-04-01", "2024-04-01"), ("2024-12-31", "2024-04-01"), ("2025-01-01", "2024-04-01")],
)
def test_fiscal_year_start(spark, d, expected):
    assert one(spark, D.fiscal_year_start(F.to_date(F.lit(d)))) == dt.date.fromisoformat(expected)


def test_fiscal_year_start_null(spark):
    assert one(spark, D.fiscal_year_start(F.lit(None).cast("date"))) is None


def test_days_in_month(spark):
    assert one(spark, D.days_in_month(F.to_date(F.lit("2024-02-01")))) == 29
    assert one(spark, D.days_in_month(F.to_date(F.lit("2023-02-01")))) == 28


@pytest.mark.parametrize("text", ["Apr-24", "APR-24", "apr-24"])
def test_period_text_any_case(spark, text):
    assert one(spark, D.parse_period_month(F.lit(text))) == dt.date(2024, 4, 1)


def test_period_text_junk_is_null(spark):
    assert one(spark, D.parse_period_month(F.lit("unknown"))) is None


def test_yyyymm_is_month_not_minutes(spark):
    assert one(spark, D.parse_yyyymm(F.lit(202403))) == dt.date(2024, 3, 1)


def test_day_month_year_time(spark):
    assert one(spark, D.parse_day_month_year_time(F.lit("10/04/2024 13:45"))) == dt.date(2024, 4, 10)
    assert one(spark, D.parse_day_month_year_time(F.lit("garbage"), strict=False)) is None


def test_malformed_upgrade_date_raises_when_strict(spark):
    with pytest.raises(Exception):
        one(spark, D.parse_day_month_year_time(F.lit("garbage"), strict=True))


def test_add_months_clamps_month_end(spark):
    assert one(spark, F.add_months(F.to_date(F.lit("2024-01-31")), 1)) == dt.date(2024, 2, 29)


def test_round_money_half_up(spark):
    assert one(spark, round_money(F.lit(Decimal("2.345")))) == Decimal("2.35")
    assert one(spark, round_money(F.lit(Decimal("-2.345")))) == Decimal("-2.35")


def test_prorate_multiplies_first(spark):
    # 30.00 for 21 of 30 days
    assert one(spark, round_money(prorate(dec("30.00"), F.lit(21), F.lit(30)))) == Decimal("21.00")


def price(spark, rules, base, conn, fy):
    col = P.price_rise(dec(base), F.to_date(F.lit(conn)), F.to_date(F.lit(fy)), rules)
    return one(spark, col)


@pytest.mark.parametrize(
    "rules,base,conn,fy,expected",
    [
        (P.O2, "20.50", "2021-06-15", "2025-04-01", "31.02"),
        (P.O2, "20.50", "2021-06-15", "2026-04-01", "32.82"),
        (P.O2, "20.50", "2025-06-01", "2025-04-01", "22.30"),
        (P.VODAFONE, "20.50", "2021-06-15", "2025-04-01", "29.43"),
        (P.O2, "20.50", "2021-06-15", "2021-04-01", "20.50"),
    ],
)
def test_price_rise_golden(spark, rules, base, conn, fy, expected):
    assert price(spark, rules, base, conn, fy) == Decimal(expected)


def test_vodafone_late_contract_gets_both(spark):
    # connected 2024-07-02 .. 2025-01-30: 2025 percentage and the fixed add
    v = price(spark, P.VODAFONE, "10.00", "2024-08-01", "2025-04-01")
    assert v == Decimal("12.44")  # 10.00 * 1.064 + 1.80


def test_exclusive_variant(spark):
    def excl(net, conn, fy):
        col = P.price_rise_exclusive(F.lit(net), dec("10.00"), F.to_date(F.lit(conn)), F.to_date(F.lit(fy)))
        return one(spark, col)

    # late Vodafone: fixed add only, percentages skipped
    assert excl("Vodafone", "2024-08-01", "2025-04-01") == Decimal("11.80")
    # O2 must agree with the live rule
    assert excl("O2", "2021-06-15", "2025-04-01") == price(spark, P.O2, "10.00", "2021-06-15", "2025-04-01")
    # early Vodafone uses 1.069 for 2025 in this variant
    exact = Decimal("10.00") * Decimal("1.093") * Decimal("1.144") * Decimal("1.079") * Decimal("1.069")
    assert excl("Vodafone", "2021-06-15", "2025-04-01") == exact.quantize(Decimal("0.01"), ROUND_HALF_UP)


def test_simple_accrual_before_and_after(spark):
    def acc(conn, month, fy):
        col = P.price_rise_simple_accrual(
            dec("12.00"), F.to_date(F.lit(conn)), F.to_date(F.lit(month)), F.to_date(F.lit(fy))
        )
        return one(spark, col)

    # first accrual year: k = 0 -> base + base*0.117/12
    assert acc("2021-01-01", "2022-05-01", "2022-04-01") == Decimal("12.117000")
    # flat add from April 2025: 0.15
    assert acc("2025-06-01", "2025-06-01", "2025-04-01") == Decimal("12.150000")


def test_simple_accrual_by_network(spark):
    df = spark.createDataFrame([("O2",), ("Three",), (None,), ("Vodafone",)], "n string")
    day = lambda x: F.to_date(F.lit(x))
    col = P.price_rise_simple_accrual(dec("12.00"), day("2021-01-01"), day("2022-05-01"), day("2022-04-01"), network="n")
    got = {r["n"]: r["v"] for r in df.select("n", col.alias("v")).collect()}
    assert got == {"O2": Decimal("12.117000"), "Three": Decimal("12.000000"), None: Decimal("12.000000"), "Vodafone": None}


def test_apply_factor(spark):
    assert one(spark, P.apply_factor(dec("10.00"), F.lit(True), "1.5")) == Decimal("15.000")
    assert one(spark, P.apply_factor(dec("10.00"), F.lit(False), "1.5")) == Decimal("10.000")


def test_price_rise_by_network(spark):
    df = spark.createDataFrame([("O2",), ("Vodafone",)], "n string")
    col = P.price_rise_by_network(
        "n", dec("20.50"), F.to_date(F.lit("2021-06-15")), F.to_date(F.lit("2025-04-01"))
    )
    got = {r["n"]: r["v"] for r in df.select("n", col.alias("v")).collect()}
    assert got == {"O2": Decimal("31.02"), "Vodafone": Decimal("29.43")}
