"""Timestamps in every ISO form, unreadable ones and bad rates as exceptions, nine-decimal rates from file to ledger."""

import datetime as dt
from decimal import Decimal

import pytest

from tallybook.operators import staging
from tallybook.operators.fx import fx_rates_daily
from tallybook.operators.journal import journal_settlements

AT = dt.datetime(2025, 7, 10, 9, 30)
FORMS = [("2025-07-10T09:30:00Z", AT), ("2025-07-10T09:30:00.250Z", AT.replace(microsecond=250000)), ("2025-07-10T09:30:00.123456789Z", AT.replace(microsecond=123456)), ("2025-07-10 09:30:00", AT),
         ("2025-07-10T11:30:00+02:00", AT), ("2025-07-10T11:30:00+0200", AT), ("2025-07-10T04:30:00-05", AT), ("  2025-07-10T09:30:00Z ", AT), ("2025-07-10 09:30:00 UTC", AT),
         ("2025-07-10", dt.datetime(2025, 7, 10)), ("", None), (None, None), ("   ", None)]
JUNK = ["yesterday", "2025-07-10T09:30Z", "2025-13-40T00:00:00Z", "2025-07-10T25:00:00Z", "2025", "T09:30", "2025-07-10T09:30:00Z extra", "10/07/2025"]


@pytest.mark.parametrize("stage,raw,column", [
    (staging.stg_orders, "order_id string, seller_id string, product_id string, buyer_id string, buyer_country string, currency string, amount_minor string, platform_fee_minor string, plan_id string, processor string, processor_charge_ref string, order_type string, status string, created_at string", "created_at"),
    (staging.stg_products, "product_id string, seller_id string, name string, product_type string, price_usd_minor string, created_at string", "created_at"),
    (staging.stg_refunds, "refund_id string, order_id string, amount_minor string, currency string, processor_refund_ref string, created_at string", "created_at"),
    (staging.stg_seller_payouts, "payout_id string, seller_id string, amount_minor string, currency string, status string, initiated_at string, settled_at string, returned_at string", "returned_at"),
    (staging.stg_plan_changes, "seller_id string, plan_id string, effective_from string", "effective_from"),
    (staging.stg_sellers, "seller_id string, name string, country string, plan_id string, status string, created_at string, churned_at string", "churned_at")])
def test_iso_forms_of_every_app_table(spark, stage, raw, column):
    n = raw.count(",")
    times = [x for x, _ in FORMS] + JUNK
    df = spark.createDataFrame([(str(i), *["1"] * (n - 1), t) for i, t in enumerate(times)], raw)
    key = stage(df).columns[0]
    got = {r[key]: r[column] for r in stage(df).collect()}
    assert [got[i] for i in range(len(times))] == [at for _, at in FORMS] + [None] * len(JUNK)


def test_unreadable_times_and_rates_are_exceptions(spark):
    refunds = spark.createDataFrame([(str(i), t) for i, t in enumerate([x for x, _ in FORMS] + JUNK)], "refund_id string, created_at string")
    sellers = spark.createDataFrame([("1", "soon", "never", "f.csv", 2), ("2", "2025-07-10", "", "f.csv", 3)], "seller_id string, created_at string, churned_at string, _source_file string, _source_line long")
    got = sorted(tuple(r) for r in staging.app_exceptions({"app_db_refunds": refunds, "app_db_sellers": sellers}).collect() if r.source_table != "app_db_refunds")
    assert got == [("app_db_sellers", "1", "unparseable churned_at", "f.csv", 2), ("app_db_sellers", "1", "unparseable created_at", "f.csv", 2)]
    assert staging.app_exceptions({"app_db_refunds": refunds}).count() == len(JUNK)
    fx = spark.createDataFrame([("2025-07-10", "USD", "eur", "0.9", "a.csv", 2), ("2025-07-10", "usd", "EUR", "n/a", "b.csv", 2), ("2025-07-10", "GBP", "EUR", "x", "b.csv", 3)],
                               "rate_date string, base_currency string, quote_currency string, rate string, _source_file string, _source_line long")
    assert [tuple(r) for r in staging.fx_exceptions(fx).collect()] == [("fx_reference_rates", "2025-07-10/EUR", "unparseable rate", "b.csv", 2)]
    assert [r.units_per_usd for r in staging.stg_fx(fx).collect()] == [Decimal("0.900000000")]   # the bad rate hides no earlier one


def test_a_nine_decimal_rate_reaches_the_ledger(spark):
    fx = spark.createDataFrame([("2025-07-10", "USD", "EUR", "0.923456789", "a.csv", 2)], "rate_date string, base_currency string, quote_currency string, rate string, _source_file string, _source_line long")
    rates = fx_rates_daily(staging.stg_fx(fx))
    assert {r.units_per_usd for r in rates.where("currency = 'EUR'").collect()} == {Decimal("0.923456789")}
    amount = 1_000_000_000_000
    events = spark.createDataFrame([("e", "processor_b", "payout", AT, "p", None, None, None, None, "EUR", amount, 0, amount, "f", AT.date())],
                                   "settlement_event_id string, processor string, event_type string, occurred_at timestamp, processor_reference string, payout_reference string, order_id long, presentment_currency string, presentment_amount_minor long, settlement_currency string, gross_settlement_minor long, fee_minor long, net_settlement_minor long, _source_file string, event_date date")
    orders = spark.createDataFrame([], "order_id long, seller_id long, currency string, platform_fee_minor long")
    got = {r.account_code: r.amount_usd_minor for r in journal_settlements(events, orders, rates).collect()}
    want = round(amount * 10**9 / Decimal(923456789))
    assert got == {"1010": want, "1060": -want} and want != round(amount * 10**6 / Decimal(923457))
