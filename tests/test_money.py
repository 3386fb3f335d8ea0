import random
from decimal import ROUND_HALF_EVEN, Decimal

from pyspark.sql import functions as F

from tallybook.functions.money import (buyer_region, file_date, greatest_or_null, minor_to_text,
                                       to_minor_units, to_usd_minor)


def _expected(m, ccy, rate):
    if ccy == "USD":
        return m
    scale = 100 if ccy == "JPY" else 1
    return int((Decimal(m) * scale / rate).quantize(Decimal(1), rounding=ROUND_HALF_EVEN))


def test_half_even_matches_decimal_including_ties(spark):
    random.seed(7)
    rows = []
    for _ in range(2000):
        rows.append((random.randint(-10**9, 10**9), random.choice(["EUR", "JPY", "GBP", "USD"]),
                     Decimal(random.randint(1, 5 * 10**6)) / Decimal(10**6)))
    # exact ties: 0.5, 1.5, 2.5 cents either sign
    for m in (5, 15, 25, -5, -15, -25):
        rows.append((m, "EUR", Decimal("10.000000")))
    df = spark.createDataFrame(rows, "m long, ccy string, rate decimal(18,6)")
    out = df.select("m", "ccy", "rate", to_usd_minor("m", "ccy", "rate").alias("u")).collect()
    bad = [r for r in out if r.u != _expected(r.m, r.ccy, r.rate)]
    assert not bad
    ties = {r.m: r.u for r in out if r.rate == Decimal("10.000000")}
    assert ties == {5: 0, 15: 2, 25: 2, -5: 0, -15: -2, -25: -2}


def test_missing_rate_stays_null(spark):
    df = spark.createDataFrame([(100, "EUR", None)], "m long, ccy string, rate decimal(18,6)")
    assert df.select(to_usd_minor("m", "ccy", "rate").alias("u")).first().u is None


def test_to_minor_units_formats(spark):
    cases = [("12.34", "USD", 1234), ("3736", "JPY", 3736), ("12.3", "EUR", None), ("N/A", "USD", None),
             ("12,34", "EUR", None), ("12.34\n", "USD", None), ("-0.05", "eur", -5), (None, "USD", None),
             ("3736.00", "JPY", None)]
    df = spark.createDataFrame([(a, c) for a, c, _ in cases], "a string, c string")
    got = [r.m for r in df.select(to_minor_units("a", "c").alias("m")).collect()]
    assert got == [e for _, _, e in cases]


def test_minor_to_text_round_trips(spark):
    df = spark.range(-250, 250).select((F.col("id") * 7).alias("m"))
    back = df.select("m", to_minor_units(minor_to_text("m"), F.lit("USD")).alias("b"))
    assert back.filter("m != b").count() == 0


def test_greatest_keeps_null_and_file_date_and_region(spark):
    df = spark.createDataFrame([(None, "processor_a/balance_transactions_2025-07-10.csv", "DE"),
                                (-5, "app_db/orders.csv", "ZZ")], "x long, f string, c string")
    r = df.select(greatest_or_null("x", F.lit(0)).alias("g"), file_date("f").alias("d"),
                  buyer_region("c").alias("r")).collect()
    assert r[0].g is None and str(r[0].d) == "2025-07-10" and r[0].r == "EU"
    assert r[1].g == 0 and r[1].d is None and r[1].r == "Other"
