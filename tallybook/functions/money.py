"""Money, FX and calendar helpers as Spark Column expressions.

Everything here is built from ``pyspark.sql.functions`` so it stays inside
whole-stage codegen and never leaves the JVM.  Money is integer minor units
(``bigint``) everywhere; FX rates are decimals quoted as units of currency per
1 USD.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Currency minor-unit exponents (JPY has no minor unit).
ZERO_DECIMAL_CURRENCIES = ("JPY",)

# Buyer country -> reporting region.
REGION_BY_COUNTRY = {
    "US": "North America", "CA": "North America",
    "DE": "EU", "FR": "EU", "NL": "EU", "ES": "EU", "IT": "EU",
    "GB": "UK",
    "BR": "LATAM",
    "JP": "APAC",
}

RATE_SCALE = 1_000_000_000  # rates carry up to 9 decimals


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def to_minor_units(amount, currency) -> Column:
    """Decimal string -> integer minor units, null when the string is not
    exactly in the currency's format ('12.34' USD -> 1234, '3736' JPY ->
    3736, 'N/A' / '12,34' / '12.3' -> null).  ``\\z`` (not ``$``) so a
    trailing newline never slips through."""
    amount, currency = _c(amount), _c(currency)
    zero_dec = F.upper(currency).isin(*ZERO_DECIMAL_CURRENCIES)
    return (
        F.when(zero_dec,
               F.when(amount.rlike(r"^-?\d+\z"), amount.try_cast("bigint")))
        .otherwise(
            F.when(amount.rlike(r"^-?\d+\.\d{2}\z"),
                   F.replace(amount, F.lit("."), F.lit("")).try_cast("bigint")))
    )


def scaled_rate(units_per_usd) -> Column:
    """A rate times 10^9 as a bigint, null if it has no room there (see :func:`to_usd_minor`)."""
    rate = _c(units_per_usd)
    return F.when(rate.between(0, LARGEST_SCALED), (rate.cast("decimal(25,9)") * F.lit(RATE_SCALE)).cast("bigint"))


#: Rates and amounts up to these convert in 64-bit arithmetic, with the same result.
LARGEST_SCALED, LARGEST_AMOUNT = 4_000_000_000, 9_000_000_000


def to_usd_minor(amount_minor, currency, units_per_usd, scaled=None) -> Column:
    """Minor units of ``currency`` -> USD minor units, banker's rounding once.

    Exact integer form: with R = rate * 10^9, n = m * 10^9 (m * 10^11 for a
    zero-decimal currency), q = n div R and r = n % R (both truncate toward
    zero); step q away from zero when 2|r| > R, or 2|r| = R and q is odd.  In
    decimal(38,0) every bigint m fits (|n| < 10^31); where n and 2R fit a bigint
    the same steps run in 64 bits.  ``scaled``: the rate as from :func:`scaled_rate`,
    if it is at hand.
    """
    m, ccy = _c(amount_minor), _c(currency)
    zero_dec = ccy.isin(*ZERO_DECIMAL_CURRENCIES)
    scaled = scaled_rate(units_per_usd) if scaled is None else _c(scaled)

    def convert(n: Column, big_r: Column, of: str) -> Column:
        q, r = _int_div(n, big_r), (n % big_r).cast(of)
        twice = (F.abs(r) * F.lit(2)).cast(of)
        bump = F.when((twice > big_r) | ((twice == big_r) & (q % 2 != 0)),
                      F.signum(n).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
        return q + bump

    whole = "decimal(38,0)"
    wide = convert((m.cast("decimal(20,0)") * F.when(zero_dec, F.lit(100 * RATE_SCALE)).otherwise(F.lit(RATE_SCALE)).cast("decimal(12,0)")).cast(whole),
                   (_c(units_per_usd).cast("decimal(25,9)") * F.lit(RATE_SCALE)).cast(whole), whole)
    narrow = convert(m.cast("bigint") * F.when(zero_dec, F.lit(100 * RATE_SCALE)).otherwise(F.lit(RATE_SCALE)).cast("bigint"), scaled, "bigint")
    most = F.when(zero_dec, F.lit(LARGEST_AMOUNT // 100)).otherwise(F.lit(LARGEST_AMOUNT))
    fits = scaled.isNotNull() & (scaled > 0) & m.between(-most, most)
    return F.when(ccy == "USD", m.cast("bigint")).when(fits, narrow).otherwise(wide)


def _int_div(a: Column, b: Column) -> Column:
    """Integer division truncating toward zero (SQL ``div``)."""
    return F.call_function("div", a, b)


int_div = _int_div


def greatest_or_null(*cols) -> Column:
    """BigQuery-style greatest: null if any input is null (Spark skips nulls)."""
    cols = [_c(c) for c in cols]
    any_null = cols[0].isNull()
    for c in cols[1:]:
        any_null = any_null | c.isNull()
    return F.when(any_null, F.lit(None)).otherwise(F.greatest(*cols))


def file_date(source_file) -> Column:
    """Business date embedded in a raw file name (``..._2025-07-10.csv``)."""
    s = F.regexp_extract(_c(source_file), r"(\d{4}-\d{2}-\d{2})", 1)
    return F.try_to_date(F.nullif(s, F.lit("")), "yyyy-MM-dd")


def buyer_region(country) -> Column:
    country = _c(country)
    expr = None
    for code, region in REGION_BY_COUNTRY.items():
        expr = (F.when(country == code, region) if expr is None
                else expr.when(country == code, region))
    return expr.otherwise("Other")


def minor_to_text(amount_minor, currency=None) -> Column:
    """Integer minor units -> the decimal string a processor file carries
    ('-0.05', '1234.00'); zero-decimal currencies print as integers."""
    m = _c(amount_minor)
    a = F.abs(m)
    body = F.concat(
        F.when(m < 0, F.lit("-")).otherwise(F.lit("")),
        _int_div(a, F.lit(100)).cast("string"), F.lit("."),
        F.lpad((a % 100).cast("string"), 2, "0"),
    )
    if currency is None:
        return body
    return F.when(F.upper(_c(currency)).isin(*ZERO_DECIMAL_CURRENCIES),
                  m.cast("string")).otherwise(body)


def month_start(d) -> Column:
    return F.trunc(_c(d), "MM")


def time_spine(spark, start: str = "2023-01-01", end: str = "2027-12-31"):
    """Daily calendar for the metric layer: one row per day (generated, no data read)."""
    return spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end))))
                                 .alias("date_day"))
