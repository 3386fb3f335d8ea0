"""Large amounts, fine rates, ties and CSV quoting: exact at any size."""

import csv
import io
from decimal import ROUND_HALF_EVEN, Decimal

from pyspark.sql import functions as F

from tallybook.functions.money import to_minor_units, to_usd_minor
from tallybook.operators.fx import fx_rates_daily
from tallybook.operators.staging import keep_first, stg_fx


def test_conversion_beyond_int64_products(spark):
    cases = [(10**13, "EUR", "0.9"), (-(10**13) - 1, "EUR", "0.923456789"), (10**12, "JPY", "149.123456789"), (5, "EUR", "2"), (15, "EUR", "2"), (-5, "EUR", "2"), (9 * 10**18, "USD", "1")]
    df = spark.createDataFrame([(m, c, Decimal(r)) for m, c, r in cases], "m long, c string, r decimal(38,9)")
    got = [x[0] for x in df.select(to_usd_minor("m", "c", "r")).collect()]
    want = [m if c == "USD" else int((Decimal(m) * (100 if c == "JPY" else 1) / Decimal(r)).quantize(Decimal(1), ROUND_HALF_EVEN)) for m, c, r in cases]
    assert got == want


def test_long_amounts(spark):
    df = spark.createDataFrame([("12345678901234567.89", "EUR"), ("123456789012345678", "JPY"), ("9" * 30 + ".00", "EUR"), ("-0.01", "USD")], "a string, c string")
    assert [x[0] for x in df.select(to_minor_units("a", "c")).collect()] == [1234567890123456789, 123456789012345678, None, -1]


def test_ties_leave_one_row(spark):
    df = spark.createDataFrame([("x", "2025-01-01", 3, "a"), ("x", "2025-01-01", 3, "b"), (None, None, 1, "c"), (None, None, 1, "c")], "k string, d string, n int, v string")
    got = sorted(map(tuple, keep_first(df, ["k"], ["d", "n"]).collect()), key=str)
    assert got == sorted([("x", "2025-01-01", 3, "a"), (None, None, 1, "c")], key=str)
    assert df.columns == keep_first(df, ["k"], ["d", "n"], descending=True).columns


def test_csv_quoting_as_the_csv_module(spark):
    lines = ['"a ""x"" b",c', '"back\\",d', 'plain,"x,y"', '"",z', '"' + "q" * 1_000_000 + '",end']
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, line string")
    size = F.size(F.split(F.regexp_replace("line", r'"[^"]*+(?:""[^"]*+)*+"', "q"), ",", -1))
    parsed = F.from_csv("line", "a string, b string", {"mode": "PERMISSIVE", "escape": '"', "maxCharsPerColumn": "-1"})
    rows = df.select("i", size.alias("n"), parsed.alias("r")).orderBy("i").collect()
    for x, r in zip(lines, rows):
        want = next(csv.reader(io.StringIO(x)))if len(x) < 100_000 else ["q" * 1_000_000, "end"]
        assert r.n == 2 and [r.r.a or "", r.r.b or ""] == want


def test_rates_of_nine_decimals_reach_the_conversion(spark):
    raw = spark.createDataFrame([("USD", "EUR", "0.923456789", "2025-03-03", "f", 1), ("USD", "JPY", "149.1234565", "2025-03-03", "f", 2)], "base_currency string, quote_currency string, rate string, rate_date string, _source_file string, _source_line int")
    rates = fx_rates_daily(stg_fx(raw)).where("rate_date = DATE'2025-03-04'")
    got = {r.currency: (r.units_per_usd, r.usd) for r in rates.withColumn("usd", to_usd_minor(F.lit(10**13), F.col("currency"), F.col("units_per_usd"))).collect()}
    for ccy, rate, scale in (("EUR", "0.923456789", 1), ("JPY", "149.1234565", 100)):
        assert got[ccy] == (Decimal(rate), int((Decimal(10**13) * scale / Decimal(rate)).quantize(Decimal(1), ROUND_HALF_EVEN)))
    assert got["USD"] == (1, 10**13)


def test_64_bit_path_equals_decimal_path_at_its_edges(spark):
    from decimal import ROUND_HALF_EVEN, Decimal

    from pyspark.sql import functions as F

    from tallybook.functions.money import LARGEST_AMOUNT, LARGEST_SCALED, to_usd_minor
    rates = ["0.000000001", "0.923456789", "1", "2", "8", "157.5", "3999999999.999999999", str(LARGEST_SCALED), "4000000000.000000001", "9999999999"]
    amounts = [0, 1, -1, 3, 5, -5, 12345, LARGEST_AMOUNT // 100, LARGEST_AMOUNT // 100 + 1, LARGEST_AMOUNT, -LARGEST_AMOUNT, LARGEST_AMOUNT + 1, 10**15 + 7]
    rows = [(m, c, Decimal(r)) for m in amounts for c in ("EUR", "JPY") for r in rates if abs(m) * (100 if c == "JPY" else 1) / Decimal(r) < 2**62]
    df = spark.createDataFrame(rows, "m long, c string, r decimal(38,9)")
    for row in df.withColumn("usd", to_usd_minor("m", "c", F.col("r"))).collect():
        exact = Decimal(row.m) * (100 if row.c == "JPY" else 1) / row.r
        n, d = row.m * (100 if row.c == "JPY" else 1) * 10**9, int(row.r * 10**9)
        q, rest = divmod(abs(n), d)
        q += 2 * rest > d or (2 * rest == d and q % 2 == 1)
        assert row.usd == (q if n >= 0 else -q), (row, exact.to_integral_value(ROUND_HALF_EVEN))
