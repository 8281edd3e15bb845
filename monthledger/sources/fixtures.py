"""Derive the six reconciliation feeds from the TPC-H-style test tables.

The upstream feeds are not public, so the tests and the benchmark derive them
from ``orders``, ``customer`` and ``lineitem`` with one fixed rule set, shared
with the DuckDB oracle (``plans.oracle.FIXTURE_CTES``).  Dates move forward
288 months so every price-rise year is exercised.  The derivation is lazy:
each feed is a DataFrame over the Parquet scans, so it grows with the tables.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthledger.plans.job import ReconSources
from monthledger.sources.schemas import RATES
from monthledger.sources.tables import conform

# Fixed values of the derivation (shared with the oracle text).
DATE_SHIFT_MONTHS = 288
RATE_CARD = [
    ("O2", Decimal("0.20"), Decimal("0.71"), Decimal("0.35"), dt.date(2018, 1, 1), dt.date(2021, 12, 31)),
    ("O2", Decimal("0.20"), Decimal("0.70"), Decimal("0.30"), dt.date(2022, 1, 1), dt.date(2025, 9, 15)),
    ("Vodafone", Decimal("0.20"), Decimal("0.50"), Decimal("0.25"), dt.date(2018, 1, 1), dt.date(2030, 12, 31)),
]


def _rate_card(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """The card as literals, whose size Spark knows when it plans.

    Rows handed over from Python count as endless: every month row was then
    planned to be shuffled by month to meet them, and was, unless the card's
    own stage ended before the months' began.
    """
    names = [f.name for f in RATES.fields]
    each = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]).cast(RATES) for row in rows]
    return conform(spark.range(1, numPartitions=1).select(F.inline(F.array(*each))), RATES)


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_orderpriority",
        F.add_months(F.col("o_orderdate").cast("date"), DATE_SHIFT_MONTHS).alias("d"),
        (F.col("o_totalprice").cast("decimal(14,2)") * F.expr("0.0001")).alias("mrc"),
    )


def _payment_lines(spark: SparkSession, sf_dir: str, orders: DataFrame) -> DataFrame:
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus"
    )
    o = orders.select(F.col("o_orderkey").alias("l_orderkey"), "d", "mrc")
    p = F.add_months(F.trunc("d", "MM"), (F.col("l_partkey") % 36).cast("int"))
    return (
        li.join(o, "l_orderkey")
        .withColumn("p", p)
        .withColumn(
            "cv", (F.col("mrc") * F.col("l_quantity").cast("decimal(4,0)") * F.expr("0.02")).cast("decimal(18,2)")
        )
    )


def fixture_sources(spark: SparkSession, sf_dir: str) -> ReconSources:
    """All six feeds, derived from the test tables under ``sf_dir``."""
    o = _orders(spark, sf_dir)
    cust = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.col("c_custkey").alias("o_custkey"), "c_mktsegment"
    )
    key = F.col("o_orderkey")

    sales = o.join(cust, "o_custkey").select(
        key.cast("string").alias("opportunitynumber"),
        key.cast("string").alias("usi"),
        F.col("o_custkey").cast("string").alias("ctn"),
        F.when(key % 50 == 0, F.lit(None).cast("date")).otherwise(F.col("d")).alias("activated_date"),
        F.col("mrc").cast("decimal(18,4)").alias("monthly_recurring_charge"),
        F.when(key % 4 < 3, "O2").otherwise("Vodafone").alias("network"),
        F.when(F.col("o_orderstatus") == "F", "Activated")
        .when(F.col("o_orderstatus") == "O", "Exchange")
        .when(F.col("o_orderpriority") == "1-URGENT", "Exchange Received")
        .otherwise("Cancelled")
        .alias("currentorderstatus"),
        F.when(F.col("c_mktsegment") == "BUILDING", "New Contract")
        .when(F.col("c_mktsegment") == "MACHINERY", "Upgrade")
        .otherwise(F.col("c_mktsegment"))
        .alias("product_segment"),
    )

    lines = _payment_lines(spark, sf_dir, o)
    lvl5 = F.concat(F.lit("5L"), (F.col("l_suppkey") % 5).cast("string"))
    sos = F.concat(F.lit("R"), F.col("l_linenumber").cast("string"))
    postpay = lines.select(
        F.col("l_orderkey").cast("string").alias("usi"),
        F.when(F.col("l_partkey") % 97 == 0, "unknown").otherwise(F.date_format("p", "MMM-yy")).alias("period_date"),
        F.col("cv").alias("commission_value"),
        F.col("l_partkey").cast("string").alias("mpn"),
        lvl5.alias("lvl5"),
        sos.alias("sos_code"),
        F.when(F.col("l_returnflag").isin("A", "N"), "Line Rental").otherwise("Handset").alias(
            "revenue_feature_group_name"
        ),
        F.when(F.col("l_linestatus") == "F", "In Contract-71%").otherwise("Out of Contract").alias("description"),
    )
    ftu = lines.where((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")).select(
        F.col("l_orderkey").cast("string").alias("usi"),
        F.date_format("p", "MMM-yy").alias("periodname"),
        F.col("cv").alias("commissionvalue"),
        F.col("l_partkey").cast("string").alias("mpn"),
        lvl5.alias("level5"),
        sos.alias("soscode"),
    )

    disconnections = o.where(key % 7 == 0).select(
        key.cast("string").alias("usi"),
        F.date_add(F.add_months("d", (key % 40).cast("int")), (key % 20).cast("int")).alias("disconnection_date"),
        F.col("o_orderpriority").alias("disconnection_reason"),
    )
    base_movements = o.where(key % 5 == 0).select(
        key.cast("string").alias("usi"),
        F.date_format(F.add_months("d", (key % 36).cast("int")), "dd/MM/yyyy HH:mm").alias("last_upgrade_date"),
        F.col("o_orderpriority").alias("upgrade_channel"),
        F.when(key % 10 == 0, "BASE OFF").otherwise("BASE ON").alias("base_indicator"),
        F.date_format(F.add_months("d", (key % 11).cast("int")), "yyyyMM").cast("int").alias("period"),
        F.when(key % 15 == 0, "NON BILLED").otherwise("BILLED").alias("billed_status"),
    )
    rates = _rate_card(spark, RATE_CARD)
    return ReconSources(
        sales=sales,
        postpay=postpay,
        ftu=ftu,
        disconnections=disconnections,
        base_movements=base_movements,
        rates=rates,
    )


def repeated_sources(spark: SparkSession, sf_dir: str) -> ReconSources:
    """The feeds with several disconnections and base movements a contract.

    One row per order line instead of one per order.  Lines 1 and 4 disconnect
    on the same day for different reasons; movements of a contract share
    periods and, at times, dates.
    """
    src = fixture_sources(spark, sf_dir)
    line, key = F.col("l_linenumber").cast("int"), F.col("l_orderkey")
    lines = _payment_lines(spark, sf_dir, _orders(spark, sf_dir)).select("l_orderkey", "l_linenumber", "d")
    disconnections = lines.where(key % 7 == 0).select(
        key.cast("string").alias("usi"),
        F.date_add(F.add_months("d", (key % 40).cast("int")), (line * 10) % 30).alias("disconnection_date"),
        F.concat(F.lit("line "), line.cast("string")).alias("disconnection_reason"),
    )
    base_movements = lines.where(key % 5 == 0).select(
        key.cast("string").alias("usi"),
        F.date_format(F.add_months("d", (key % 33 + line % 3).cast("int")), "dd/MM/yyyy HH:mm").alias("last_upgrade_date"),
        F.concat(F.lit("channel "), line.cast("string")).alias("upgrade_channel"),
        F.when(key % 10 == 0, "BASE OFF").otherwise("BASE ON").alias("base_indicator"),
        F.date_format(F.add_months("d", (key % 11 + line % 2).cast("int")), "yyyyMM").cast("int").alias("period"),
        F.when((key + line) % 3 == 0, "NON BILLED").otherwise("BILLED").alias("billed_status"),
    )
    return replace(src, disconnections=disconnections, base_movements=base_movements)


HOT_CONTRACT = "HOT"
#: Rate rows that overlap the card: another rate, and one that prices alike.
OVERLAPPING_RATES = [
    ("O2", Decimal("0.20"), Decimal("0.60"), Decimal("0.30"), dt.date(2023, 3, 1), dt.date(2023, 5, 31)),
    ("O2", Decimal("0.20"), Decimal("0.70"), Decimal("0.30"), dt.date(2023, 9, 1), dt.date(2023, 10, 31)),
]


def skewed_sources(spark: SparkSession, sf_dir: str) -> ReconSources:
    """The feeds with a hot contract, copies and overlapping rates.

    Every fifth order's sale and payments belong to one contract, ``HOT``,
    whose payments carry one pair of codes; it also has the disconnections and
    movements of the few orders below 64.  A third of the sales and of the
    disconnections stand there twice.
    """
    src = fixture_sources(spark, sf_dir)
    hot = F.col("usi").cast("long") % 5 == 0

    def with_hot(df: DataFrame, *codes: str) -> DataFrame:
        own = {"usi": F.when(hot, HOT_CONTRACT).otherwise(F.col("usi"))}
        return df.withColumns({**{c: F.when(hot, "H1").otherwise(F.col(c)) for c in codes}, **own})

    def doubled(df: DataFrame) -> DataFrame:
        third = F.col("usi").cast("long") % 3 == 0
        return df.withColumn("_n", F.explode(F.when(third, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))).drop("_n")

    def few_hot(df: DataFrame) -> DataFrame:
        number = F.col("usi").cast("long")
        return with_hot(df.where((number % 5 != 0) | (number < 64)))

    return replace(
        src,
        sales=with_hot(doubled(src.sales)),
        postpay=with_hot(src.postpay, "lvl5", "sos_code"),
        ftu=with_hot(src.ftu, "level5", "soscode"),
        disconnections=few_hot(doubled(src.disconnections)),
        base_movements=few_hot(src.base_movements),
        rates=_rate_card(spark, RATE_CARD + OVERLAPPING_RATES),
    )
