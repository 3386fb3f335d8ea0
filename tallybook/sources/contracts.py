"""Source contracts, chart of accounts and accounting policy."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class Policy:
    """Accounting policy: change a value, rebuild, and the ledger restates."""

    bad_debt_aging_days: int = 90
    recon_tolerance_minor: int = 100
    ledger_lookback_days: int = 10
    fx_rate_source: str = "reference"


DEFAULT_POLICY = Policy()


@dataclass(frozen=True)
class SourceContract:
    """A raw feed: target table, file glob, ordered header, how files are dated."""

    table: str
    pattern: str          # glob relative to the raw root
    header: tuple         # header exactly as delivered, in order
    dated_by: str         # 'filename' | 'rows' | 'none'

    @property
    def columns(self) -> list[str]:
        return [sanitize(h) for h in self.header]

    def raw_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType(), True) for c in self.columns])


def sanitize(name: str) -> str:
    """lower-case, runs of non-alphanumerics -> '_', trimmed."""
    return re.sub(r"[^0-9a-z]+", "_", name.lower()).strip("_")


# The delivered headers of every feed, in order.
CONTRACTS = {
    c.table: c for c in [
        SourceContract("app_db_plans", "app_db/plans.csv", ("plan_id", "name", "fee_bps"), "none"),
        SourceContract("app_db_plan_fixed_fees", "app_db/plan_fixed_fees.csv",
                       ("plan_id", "currency", "fixed_fee_minor"), "none"),
        SourceContract("app_db_sellers", "app_db/sellers.csv",
                       ("seller_id", "name", "country", "plan_id", "status", "created_at",
                        "churned_at"), "none"),
        SourceContract("app_db_seller_plan_changes", "app_db/seller_plan_changes.csv",
                       ("seller_id", "plan_id", "effective_from"), "none"),
        SourceContract("app_db_products", "app_db/products.csv",
                       ("product_id", "seller_id", "name", "product_type", "price_usd_minor",
                        "created_at"), "none"),
        SourceContract("app_db_orders", "app_db/orders.csv",
                       ("order_id", "seller_id", "product_id", "buyer_id", "buyer_country",
                        "currency", "amount_minor", "platform_fee_minor", "plan_id", "processor",
                        "processor_charge_ref", "order_type", "status", "created_at"), "none"),
        SourceContract("app_db_refunds", "app_db/refunds.csv",
                       ("refund_id", "order_id", "amount_minor", "currency",
                        "processor_refund_ref", "created_at"), "none"),
        SourceContract("app_db_seller_payouts", "app_db/seller_payouts.csv",
                       ("payout_id", "seller_id", "amount_minor", "currency", "status",
                        "initiated_at", "settled_at", "returned_at"), "none"),
        SourceContract("processor_a_balance_transactions",
                       "processor_a/balance_transactions_*.csv",
                       ("balance_transaction_id", "created_utc", "available_on_utc", "currency",
                        "gross", "fee", "net", "reporting_category", "source_id", "description",
                        "customer_facing_amount", "customer_facing_currency",
                        "automatic_payout_id", "payment_metadata[order_id]"), "filename"),
        SourceContract("processor_a_payouts", "processor_a/payouts_*.csv",
                       ("payout_id", "created_utc", "arrival_date", "amount", "currency",
                        "status", "failure_code", "status_changed_utc"), "filename"),
        SourceContract("processor_b_settlement_details",
                       "processor_b/settlement_detail_report_batch_*.csv",
                       ("Company Account", "Merchant Account", "Psp Reference",
                        "Merchant Reference", "Payment Method", "Creation Date", "TimeZone",
                        "Type", "Modification Reference", "Gross Currency", "Gross Debit (GC)",
                        "Gross Credit (GC)", "Exchange Rate", "Net Currency", "Net Debit (NC)",
                        "Net Credit (NC)", "Commission (NC)", "Markup (NC)", "Scheme Fees (NC)",
                        "Interchange (NC)", "Batch Number"), "rows"),
        SourceContract("bank_statements", "bank/bank_statement_*.csv",
                       ("bank_transaction_id", "account_number", "booking_date", "value_date",
                        "amount", "currency", "counterparty_name", "end_to_end_reference",
                        "description"), "filename"),
        SourceContract("fx_reference_rates", "fx/reference_rates_*.csv",
                       ("rate_date", "base_currency", "quote_currency", "rate"), "filename"),
    ]
}

# Chart of accounts (code, name, type, normal balance).
CHART_OF_ACCOUNTS = [
    ("1000", "cash_at_processor_a", "asset", "debit"),
    ("1010", "cash_at_processor_b", "asset", "debit"),
    ("1050", "cash_in_transit_usd", "asset", "debit"),
    ("1060", "cash_in_transit_eur", "asset", "debit"),
    ("1100", "cash_in_bank_usd", "asset", "debit"),
    ("1110", "cash_in_bank_eur", "asset", "debit"),
    ("1300", "allowance_for_doubtful_accounts", "contra_asset", "credit"),
    ("2000", "seller_payable", "liability", "credit"),
    ("2100", "unmatched_settlements", "liability", "credit"),
    ("4000", "platform_fee_revenue", "revenue", "credit"),
    ("5000", "processing_fee_expense", "expense", "debit"),
    ("5100", "dispute_losses", "expense", "debit"),
    ("5200", "realized_fx_gain_loss", "expense", "debit"),
    ("5210", "unrealized_fx_remeasurement", "expense", "debit"),
    ("5300", "bad_debt_expense", "expense", "debit"),
]

CHART_SCHEMA = "account_code string, account_name string, account_type string, normal_balance string"


def chart_of_accounts(spark: SparkSession) -> DataFrame:
    """The 15-account seed; ``account_code`` stays a string."""
    return spark.createDataFrame(CHART_OF_ACCOUNTS, CHART_SCHEMA)
