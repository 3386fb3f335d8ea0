"""Published books: lookback posting, partition pruning, fixed schema, equality with a full build."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tallybook.plans.models import Models
from tallybook.sources.sinks import SchemaChanged, stored_months, write_general_ledger, write_ledger

LINE = "ledger_line_id string, posting_date date, account_code string, source_system string, amount_usd_minor long"


@pytest.fixture(scope="module")
def books(spark):
    m = Models(spark, SF_SMALL, books=tempfile.mkdtemp(prefix="books-", dir="/tmp"))
    return m, m.publish()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_published_books_equal_a_full_build(spark, books, models_small):
    m, first = books
    assert first["cutoff"] is None
    assert rows(m.ledger_entries.select(*models_small.ledger_entries.columns)) == rows(models_small.ledger_entries)
    again = m.publish()
    assert again["cutoff"] is not None and again["months_emptied"] == [] and min(again["months_rebuilt"]) == again["cutoff"]
    assert again["general_ledger"]["months_rebuilt"] == again["months_rebuilt"]
    assert rows(m.ledger_entries.select(*models_small.ledger_entries.columns)) == rows(models_small.ledger_entries)
    assert rows(m.general_ledger) == rows(models_small.general_ledger)
    assert rows(m.trial_balance) == rows(models_small.trial_balance)


def test_second_run_posts_lookback_months_only(spark, books):
    m, _ = books
    cutoff = stored_months(spark, f"{m.books}/ledger_entries")[-1]
    posted = m.posted_since(cutoff)
    scans = [line for line in plan(posted).splitlines() if "FileScan parquet" in line and "event_month" in line]
    assert any("PartitionFilters: [isnotnull(event_month" in s for s in scans)
    full = m.posted_since(None).filter(F.col("posting_date") >= F.lit(cutoff))
    assert rows(posted) == rows(full) and posted.count() > 0


def test_readers_of_one_month_read_one_partition(spark, books):
    m, _ = books
    month = stored_months(spark, f"{m.books}/general_ledger")[2]
    one = m.general_ledger_month(month)
    assert "PartitionFilters: [isnotnull(posting_month" in plan(one) and f"= {month}" in plan(one)
    assert rows(one) == rows(m.general_ledger.filter(F.trunc("posting_date", "MM") == F.lit(month)))


def test_a_changed_schema_is_refused_before_anything_is_written(spark):
    path = tempfile.mkdtemp(prefix="ledger-", dir="/tmp") + "/t"
    lines = spark.createDataFrame([("a", dt.date(2025, 1, 5), "1000", "p", 10)], LINE)
    write_ledger(spark, lines, path)
    for other in (lines.withColumn("extra", F.lit(1)), lines.drop("source_system"), lines.withColumn("amount_usd_minor", F.col("amount_usd_minor").cast("string"))):
        with pytest.raises(SchemaChanged):
            write_ledger(spark, other, path)
    assert spark.read.parquet(path).count() == 1
    write_ledger(spark, lines.select(*reversed(lines.columns)), path)   # order does not count
    write_ledger(spark, lines.withColumn("extra", F.lit(1)), path, full_refresh=True)
    assert "extra" in spark.read.parquet(path).columns


def test_general_ledger_keeps_untouched_months_and_renews_close_lines(spark):
    path = tempfile.mkdtemp(prefix="gl-", dir="/tmp") + "/t"
    def frame(x):
        return spark.createDataFrame(x, LINE)
    jan, feb = dt.date(2025, 1, 5), dt.date(2025, 2, 5)
    write_general_ledger(spark, frame([("a", jan, "1000", "p", 1), ("b", feb, "1000", "p", 2)]), frame([("ca", jan, "5200", "c", 5), ("cb", feb, "5200", "c", 6)]), path)
    info = write_general_ledger(spark, frame([("a2", jan, "1000", "p", 1), ("b2", feb, "1000", "p", 2)]), frame([("ca2", jan, "5200", "c", 7)]), path, dt.date(2025, 2, 1))
    assert {r.ledger_line_id for r in spark.read.parquet(path).collect()} == {"a", "b2", "ca2"}
    assert info["months_rebuilt"] == [dt.date(2025, 2, 1)]
    with pytest.raises(SchemaChanged):
        write_general_ledger(spark, frame([("a", jan, "1000", "p", 1)]), frame([("c", jan, "1", "c", 5)]).drop("source_system"), path, dt.date(2025, 2, 1))
