"""The reference's three hand-checked unit cases, with their exact numbers."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tallybook.operators.accounting import month_ends, seller_balance_aging
from tallybook.operators.journal import journal_settlements
from tallybook.sources.contracts import Policy

EVENT_SCHEMA = ("settlement_event_id string, processor string, event_type string, occurred_at timestamp, "
                "processor_reference string, payout_reference string, batch_number long, order_id long, "
                "presentment_currency string, presentment_amount_minor long, settlement_currency string, "
                "gross_settlement_minor long, fee_minor long, net_settlement_minor long, _source_file string, "
                "event_date date")


def _charge(spark, order_id):
    d = dt.date(2025, 7, 10)
    return spark.createDataFrame([(
        "txn_1", "processor_a", "charge", dt.datetime(2025, 7, 10, 12), "ch_1", None, None, order_id,
        "EUR", 10000, "USD", 10700, 340, 10360, "f.csv", d)], EVENT_SCHEMA)


def _orders(spark):
    return spark.createDataFrame([(1, 7, "EUR", 730)],
                                 "order_id long, seller_id long, currency string, platform_fee_minor long")


def _rates(spark):
    d = dt.date(2025, 7, 10)
    return spark.createDataFrame([("EUR", d, Decimal("0.925000")), ("USD", d, Decimal("1.000000"))],
                                 "currency string, rate_date date, units_per_usd decimal(18,6)")


def _lines(df):
    return {r.account_code: r.amount_usd_minor for r in df.collect()}


def test_charge_books_realized_fx(spark):
    out = journal_settlements(_charge(spark, 1), _orders(spark), _rates(spark))
    assert _lines(out) == {"1000": 10360, "5000": 340, "2000": -10022, "4000": -789, "5200": 111}
    assert sum(_lines(out).values()) == 0


def test_charge_without_order_goes_to_suspense(spark):
    out = journal_settlements(_charge(spark, 999), _orders(spark), _rates(spark))
    assert _lines(out) == {"1000": 10360, "5000": 340, "2100": -10700}


def test_reserve_and_release(spark):
    rows = [("2000", 7, dt.date(2025, 1, 5), -5000), ("2000", 7, dt.date(2025, 1, 10), 5000),
            ("2000", 7, dt.date(2025, 1, 20), 3000), ("2000", 7, dt.date(2025, 3, 15), -3000),
            ("4000", 7, dt.date(2025, 2, 1), -999)]
    ledger = spark.createDataFrame(rows, "account_code string, seller_id long, posting_date date, "
                                         "amount_usd_minor long")
    me = month_ends(ledger)
    aging = seller_balance_aging(ledger, me, Policy(bad_debt_aging_days=30)).orderBy("month_end").collect()
    got = [(str(r.month_end), r.payable_balance_usd_minor, r.days_negative, r.is_reserved,
            r.allowance_usd_minor) for r in aging]
    assert got == [("2025-01-31", -3000, 11, False, 0),
                   ("2025-02-28", -3000, 39, True, 3000),
                   ("2025-03-31", 0, None, False, 0)]


def test_missing_rate_keeps_null_line(spark):
    rates = _rates(spark).filter(F.col("currency") == "USD")
    out = journal_settlements(_charge(spark, 1), _orders(spark), rates)
    lines = _lines(out)
    assert lines["1000"] == 10360 and lines["2000"] is None and lines["4000"] is None
