"""The driver contract: a sample of queries against their DuckDB oracle on sf0.001."""

import duckdb
import pytest

import __spark_entry__ as se
from conftest import SF_SMALL

KEYS = ["stg_processor_b_lines", "stg_exceptions", "fx_rates_daily", "journal_settlements", "ledger_entries",
        "seller_balance_aging", "trial_balance", "close_package", "order_economics", "seller_months",
        "seller_ltv_cohorts", "payout_reconciliation", "daily_reconciliation", "dash_ltv_cohort",
        "dq_losses_non_negative", "late_row_report", "batch_payout_carry", "metric_by_region"]


def _norm(v):
    if isinstance(v, float):
        return float(f"{v:.12g}")
    if hasattr(v, "isoformat"):
        return v.isoformat().replace("+00:00", "")
    return v


def _rows(cols, rows):
    idx = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in idx) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["customer", "part", "orders", "lineitem", "events"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    df = se.queries()[key](spark, SF_SMALL)
    cur = con.execute(se.oracle_sql()[key])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(dcols, cur.fetchall())


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.count() > 0 and "closing_balance_usd_minor" in df.columns
