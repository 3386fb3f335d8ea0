"""Semantic traps from the survey, each pinned by a small fixture."""

import datetime as dt

from pyspark.sql import functions as F

from tallybook.operators.metrics import seller_ltv_cohorts
from tallybook.operators.staging import base_processor_b
from tallybook.sources.contracts import CONTRACTS

B_COLS = CONTRACTS["processor_b_settlement_details"].columns


def _b_row(**kw):
    row = {c: "" for c in B_COLS}
    row.update(kw)
    row.update(_source_file="processor_b/settlement_detail_report_batch_0001.csv", _source_line=2,
               _loaded_at=dt.datetime(2025, 11, 1))
    return row


def test_repeated_autumn_hour_uses_row_zone_label(spark):
    """T12: 02:30 on the night clocks go back is 00:30 UTC in CEST, 01:30 UTC in CET."""
    rows = [_b_row(creation_date="2025-10-26 02:30:00", timezone=tz, type="Settled", psp_reference=f"P{tz}",
                   modification_reference="M", merchant_reference="ORD-7", net_currency="EUR",
                   net_credit_nc="1.00", batch_number="1", gross_currency="EUR", gross_credit_gc="1.00")
            for tz in ("CEST", "CET")]
    df = spark.createDataFrame(rows)
    got = {r.source_timezone: r.created_at for r in base_processor_b(df).collect()}
    assert got == {"CEST": dt.datetime(2025, 10, 26, 0, 30), "CET": dt.datetime(2025, 10, 26, 1, 30)}


def test_unmatched_reference_is_null_not_empty(spark):
    """T2: regexp_extract gives '' on no match; the order id must be null."""
    df = spark.createDataFrame([_b_row(creation_date="2025-07-01 10:00:00", timezone="CEST", type="Fee",
                                       merchant_reference="manual adjustment", modification_reference="F1",
                                       net_currency="EUR", net_debit_nc="15.00", batch_number="1")])
    r = base_processor_b(df).first()
    assert r.order_id is None and r.invalid_reason is None


def test_cohort_after_window_yields_no_rows_not_an_error(spark):
    """T8: sequence(start, stop) with start > stop must drop the row, not raise."""
    sm = spark.createDataFrame([(1, dt.date(2025, 1, 1), dt.date(2025, 1, 1), 10, 5),
                                (1, dt.date(2025, 2, 1), dt.date(2025, 1, 1), 10, 5)],
                               "seller_id long, activity_month date, cohort_month date, "
                               "net_revenue_usd_minor long, contribution_usd_minor long")
    sellers = spark.createDataFrame([(1, dt.datetime(2025, 1, 5)), (2, dt.datetime(2025, 6, 3))],
                                    "seller_id long, created_at timestamp")
    out = seller_ltv_cohorts(sm, sellers).orderBy("activity_month").collect()
    assert [(str(r.cohort_month), str(r.activity_month), r.cumulative_contribution_usd_minor) for r in out] == \
        [("2025-01-01", "2025-01-01", 5), ("2025-01-01", "2025-02-01", 10)]
