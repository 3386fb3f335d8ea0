"""Table operators re-aimed from the reference's simulator and checks:
late-arriving rows, local-vs-UTC date boundaries, FX gap days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.money import file_date


def late_row_report(base_a: DataFrame) -> DataFrame:
    """Transactions first seen in a file dated after the event's own date.

    One aggregation per id (min file date); lag in days.  Works on every
    landed row, valid or not, so restatements and duplicates count once.
    """
    rows = base_a.filter(F.col("balance_transaction_id").isNotNull() & F.col("created_at").isNotNull())
    g = rows.groupBy("balance_transaction_id").agg(
        F.min("file_date").alias("first_file_date"),
        F.min(F.to_date("created_at")).alias("event_date"))
    return (g.withColumn("lag_days", F.datediff("first_file_date", "event_date"))
            .filter(F.col("lag_days") > 0))


def local_vs_utc_date(base_b: DataFrame) -> DataFrame:
    """Settlement lines whose local (CET/CEST) date differs from the UTC date."""
    return (base_b.filter(F.col("created_at").isNotNull())
            .select("settlement_line_id", "record_type", "created_at_local", "source_timezone",
                    F.to_date(F.substring("created_at_local", 1, 10)).alias("local_date"),
                    F.to_date("created_at").alias("utc_date"))
            .filter(F.col("local_date") != F.col("utc_date")))


def fx_gap_days(rates_daily: DataFrame) -> DataFrame:
    """Unpublished (filled) currency-days per currency and month."""
    return (rates_daily.filter(~F.col("is_published"))
            .groupBy("currency", F.trunc("rate_date", "MM").alias("month"))
            .agg(F.count(F.lit(1)).alias("filled_days")))


def events_by_file_date(base_a: DataFrame) -> DataFrame:
    """Rows landed per file date (restatement and duplicate volume)."""
    return base_a.groupBy(file_date(F.col("_source_file")).alias("file_date")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("invalid_reason").isNotNull()).alias("invalid_rows"))
