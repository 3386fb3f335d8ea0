"""Daily booking rates: forward/back fill over a calendar spine."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def fx_rates_daily(published: DataFrame) -> DataFrame:
    """One row per (currency, day): the latest published rate on or before the
    day (weekends and gaps carry the last rate); days before the first
    publication use the first rate; USD is 1.

    The spine is days x currencies, both tiny (a few thousand days, a
    handful of currencies), so the fill windows are per-currency and cheap.
    """
    bounds = published.agg(F.min("rate_date").alias("first_date"),
                           F.max("rate_date").alias("last_date"))
    days = bounds.select(F.explode(F.sequence(
        F.date_sub("first_date", 7), F.date_add("last_date", 7))).alias("rate_date"))
    # Every currency meets the one row of bounds, and its days are generated beside it.
    currencies = published.select("currency").distinct()
    spine = currencies.crossJoin(bounds).select("currency", F.explode(F.sequence(
        F.date_sub("first_date", 7), F.date_add("last_date", 7))).alias("rate_date"))
    pub = published.select("currency", "rate_date", "units_per_usd",
                           F.lit(True).alias("_published"))
    w = Window.partitionBy("currency").orderBy("rate_date")
    fwd = w.rowsBetween(Window.unboundedPreceding, 0)
    back = w.rowsBetween(0, Window.unboundedFollowing)
    filled = spine.join(pub, ["currency", "rate_date"], "left").select(
        "currency", "rate_date",
        F.coalesce(F.last("units_per_usd", ignorenulls=True).over(fwd),
                   F.first("units_per_usd", ignorenulls=True).over(back)).alias("units_per_usd"),
        F.col("_published").isNotNull().alias("is_published"))
    usd = days.select(F.lit("USD").alias("currency"), "rate_date",
                      F.lit(1).cast("decimal(38,9)").alias("units_per_usd"),
                      F.lit(True).alias("is_published"))
    return filled.unionByName(usd)
