"""Registered queries: one per model / operator, each with its oracle SQL.

Every query reads the driver tables (through the landed raw feeds), so its
work grows with them.  Staging models expose their business columns (the
lineage columns are internal to the warehouse).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .oracle import duckdb_sql as osql
from .plans.models import Models

# Column projections for models whose full width includes internal columns.
PROJECTIONS: dict[str, list[str]] = {
    "stg_processor_a_txns": [
        "balance_transaction_id", "created_at", "settlement_currency", "gross_minor", "fee_minor",
        "net_minor", "reporting_category", "source_id", "presentment_currency",
        "presentment_amount_minor", "automatic_payout_id", "order_id", "_source_file",
        "_source_line", "file_date"],
    "stg_processor_b_lines": [
        "settlement_line_id", "psp_reference", "order_id", "created_at", "record_type",
        "modification_reference", "gross_currency", "gross_minor", "net_currency", "net_minor",
        "commission_minor", "markup_minor", "scheme_fees_minor", "interchange_minor",
        "batch_number", "_source_file", "_source_line"],
    "stg_processor_a_payouts": [
        "payout_id", "created_at", "arrival_date", "amount_minor", "currency", "status",
        "failure_code", "status_changed_at"],
    "stg_bank": [
        "bank_transaction_id", "account_number", "booking_date", "value_date", "amount_minor",
        "currency", "counterparty_name", "end_to_end_reference", "_source_file"],
    "settlement_events": [
        "settlement_event_id", "processor", "event_type", "occurred_at", "processor_reference",
        "payout_reference", "batch_number", "order_id", "presentment_currency",
        "presentment_amount_minor", "settlement_currency", "gross_settlement_minor", "fee_minor",
        "net_settlement_minor", "_source_file", "event_date"],
}

MODEL_KEYS = [
    # staging
    "stg_orders", "stg_plans", "stg_products", "stg_refunds", "stg_seller_payouts",
    "stg_plan_changes", "stg_sellers", "stg_bank", "stg_fx", "stg_processor_a_txns",
    "stg_processor_a_payouts", "stg_processor_b_lines", "stg_exceptions",
    # intermediate
    "fx_rates_daily", "settlement_events", "journal_settlements", "journal_cash",
    "ledger_entries", "month_ends", "seller_balance_aging", "fx_remeasurement",
    "bad_debt_allowance", "journal_close",
    # marts
    "general_ledger", "trial_balance", "close_package", "dim_sellers", "order_economics",
    "unit_economics_monthly", "metrics_monthly", "seller_cohorts", "seller_months",
    "seller_churn_monthly", "seller_ltv_cohorts", "order_settlement_match",
    "payout_reconciliation", "daily_reconciliation", "orphan_dispute_reversals", "batch_gaps",
]


def as_wall_time(df: DataFrame) -> DataFrame:
    """Present timestamps as UTC wall time (TIMESTAMP_NTZ): collected values
    then never depend on the client's local time zone."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import TimestampType
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name)
                       if isinstance(f.dataType, TimestampType) else F.col(f.name)
                       for f in df.schema.fields])


def _model_query(key: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = getattr(Models(spark, sf_dir), key)
        cols = PROJECTIONS.get(key)
        return as_wall_time(df.select(*cols) if cols else df)
    run.__name__ = key
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: _model_query(k) for k in MODEL_KEYS}


def _model_sql(key: str) -> str:
    cols = PROJECTIONS.get(key)
    sel = ", ".join(cols) if cols else "*"
    return osql.with_ctes(f"SELECT {sel} FROM {key}", (key,))


def oracle_statements() -> dict[str, str]:
    out = {k: _model_sql(k) for k in MODEL_KEYS}
    from . import extra_queries
    out.update(extra_queries.ORACLE)
    return {k: v for k, v in out.items() if k in all_queries()}


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from . import extra_queries
    q = dict(QUERIES)
    q.update(extra_queries.QUERIES)
    return q
