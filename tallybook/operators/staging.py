"""Staging: type every raw row, flag invalid ones, de-duplicate.

Each function is DataFrame -> DataFrame over the raw STRING feeds.  Parsing
uses ``try_*`` functions (ANSI mode is on) so a bad value becomes null and
an ``invalid_reason``, never an exception.  De-duplication is a
``row_number() = 1`` window with a total order (file, line) so results are
deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import file_date, to_minor_units


def _nullif_empty(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.nullif(c, F.lit(""))


#: A date, with a time or not, with a fraction or not, with a zone (none: UTC) or not, blanks around it or not.
_ISO = r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}:\d{2}(?:\.\d{1,9})?\s*(?:Z|UTC|[+-]\d{2}(?::?\d{2})?)?)?$"


def _iso_ts(c: str) -> Column:
    """ISO-8601 timestamps in any of their usual forms; empty or unreadable -> null
    (the unreadable ones are rows of :func:`app_exceptions`)."""
    text = F.trim(F.col(c))
    return F.when(text.rlike(_ISO), F.try_to_timestamp(text))


# The key and the timestamps of every app-database feed.
APP_TIMES = {
    "app_db_orders": ("order_id", ("created_at",)), "app_db_products": ("product_id", ("created_at",)),
    "app_db_refunds": ("refund_id", ("created_at",)), "app_db_seller_payouts": ("payout_id", ("initiated_at", "settled_at", "returned_at")),
    "app_db_seller_plan_changes": ("seller_id", ("effective_from",)), "app_db_sellers": ("seller_id", ("created_at", "churned_at")),
}


def _exception_rows(raw: DataFrame, table: str, key: Column, reasons: Column) -> DataFrame:
    file = F.col("_source_file") if "_source_file" in raw.columns else F.lit(None).cast("string")
    line = F.col("_source_line") if "_source_line" in raw.columns else F.lit(None)
    return raw.select(F.lit(table).alias("source_table"), key.cast("string").alias("record_key"), F.explode(F.array_compact(reasons)).alias("invalid_reason"),
                      file.alias("_source_file"), line.cast("bigint").alias("_source_line"))


def app_exceptions(feeds: dict[str, DataFrame]) -> DataFrame:
    """One row per timestamp that holds text but cannot be read, of every app-database feed."""
    out = None
    for table, raw in feeds.items():
        key, times = APP_TIMES[table]
        reasons = F.array(*[F.when((F.trim(F.col(c)) != "") & _iso_ts(c).isNull(), F.lit(f"unparseable {c}")) for c in times])
        rows = _exception_rows(raw, table, F.col(key), reasons)
        out = rows if out is None else out.unionByName(rows)
    return out


def fx_exceptions(raw: DataFrame) -> DataFrame:
    """USD-based rates that are not numbers."""
    reason = F.array(F.when((F.upper("base_currency") == "USD") & _rate().isNull(), F.lit("unparseable rate")))
    return _exception_rows(raw, "fx_reference_rates", F.concat_ws("/", "rate_date", F.upper("quote_currency")), reason)


def _rate() -> Column:
    return F.col("rate").try_cast("decimal(38,9)")


def _once(df: DataFrame) -> DataFrame:
    """``df``, with its columns computed once a row: a filter on them is not pushed below, where it would parse again."""
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def keep_first(df: DataFrame, keys: list[str], order: list[str], descending: bool = False) -> DataFrame:
    """``qualify row_number() over (partition by keys order by order) = 1``,
    skew-proof and in one pass.

    A window would send every copy of one key to one task; a key holding a
    third of all rows (a flood of re-sent copies) would stall it.  The winner
    is the smallest (largest) struct of the order columns and then all others:
    a partial aggregate leaves one row per key and task before the shuffle,
    the input is read once, and a tie still gives exactly one row.
    """
    pick = F.max if descending else F.min
    rest = [c for c in df.columns if c not in order and c not in keys]
    ranked = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest])
    win = df.groupBy(*keys).agg(pick(ranked).alias("_w"))
    return win.select(*[F.col(c) if c in keys else F.col(f"_w.{c}").alias(c) for c in df.columns])


# -- app database --------------------------------------------------------------
def stg_orders(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("order_id").cast("bigint").alias("order_id"),
        F.col("seller_id").cast("bigint").alias("seller_id"),
        F.col("product_id").cast("bigint").alias("product_id"),
        F.col("buyer_id").cast("bigint").alias("buyer_id"),
        "buyer_country", "currency",
        F.col("amount_minor").cast("bigint").alias("amount_minor"),
        F.col("platform_fee_minor").cast("bigint").alias("platform_fee_minor"),
        F.col("plan_id").cast("bigint").alias("plan_id"),
        "processor", "processor_charge_ref", "order_type", "status",
        _iso_ts("created_at").alias("created_at"),
    )


def stg_plans(raw_plans: DataFrame, raw_fees: DataFrame) -> DataFrame:
    """One row per plan and currency: percentage fee plus that currency's fixed fee."""
    plans = raw_plans.select(F.col("plan_id").cast("bigint").alias("plan_id"),
                             F.col("name").alias("plan_name"),
                             F.col("fee_bps").cast("bigint").alias("fee_bps"))
    fees = raw_fees.select("currency", F.col("plan_id").cast("bigint").alias("plan_id"),
                           F.col("fixed_fee_minor").cast("bigint").alias("fixed_fee_minor"))
    return plans.join(fees, "plan_id", "inner") \
        .select("plan_id", "plan_name", "fee_bps", "currency", "fixed_fee_minor")


def stg_products(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("product_id").cast("bigint").alias("product_id"),
        F.col("seller_id").cast("bigint").alias("seller_id"),
        F.col("name").alias("product_name"), "product_type",
        F.col("price_usd_minor").cast("bigint").alias("price_usd_minor"),
        _iso_ts("created_at").alias("created_at"))


def stg_refunds(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("refund_id").cast("bigint").alias("refund_id"),
        F.col("order_id").cast("bigint").alias("order_id"),
        F.col("amount_minor").cast("bigint").alias("amount_minor"),
        "currency", "processor_refund_ref",
        _iso_ts("created_at").alias("created_at"))


def stg_seller_payouts(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("payout_id").cast("bigint").alias("seller_payout_id"),
        F.col("seller_id").cast("bigint").alias("seller_id"),
        F.col("amount_minor").cast("bigint").alias("amount_minor"),
        "currency", "status",
        _iso_ts("initiated_at").alias("initiated_at"),
        _iso_ts("settled_at").alias("settled_at"),
        _iso_ts("returned_at").alias("returned_at"))


def stg_plan_changes(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("seller_id").cast("bigint").alias("seller_id"),
        F.col("plan_id").cast("bigint").alias("plan_id"),
        _iso_ts("effective_from").alias("effective_from"))


def stg_sellers(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("seller_id").cast("bigint").alias("seller_id"),
        F.col("name").alias("seller_name"),
        F.col("country").alias("seller_country"),
        F.col("plan_id").cast("bigint").alias("current_plan_id"),
        "status",
        _iso_ts("created_at").alias("created_at"),
        _iso_ts("churned_at").alias("churned_at"))


# -- bank and FX ---------------------------------------------------------------
def stg_bank(raw: DataFrame) -> DataFrame:
    """Typed statement lines; a line re-sent in a later statement keeps the first."""
    typed = raw.select(
        "bank_transaction_id", "account_number",
        F.try_to_date("booking_date", "yyyy-MM-dd").alias("booking_date"),
        F.try_to_date("value_date", "yyyy-MM-dd").alias("value_date"),
        to_minor_units(F.col("amount"), F.col("currency")).alias("amount_minor"),
        F.upper("currency").alias("currency"),
        "counterparty_name", "end_to_end_reference", "description",
        "_source_file", "_source_line")
    return keep_first(typed, ["bank_transaction_id"], ["_source_file", "_source_line"])


def stg_fx(raw: DataFrame) -> DataFrame:
    """USD-based rates only; the latest file wins per (date, currency).

    A rate that is no number is a row of :func:`fx_exceptions` and hides no earlier one."""
    typed = raw.filter((F.upper("base_currency") == "USD") & _rate().isNotNull()).select(
        _rate().alias("units_per_usd"),
        F.upper("quote_currency").alias("currency"),
        F.try_to_date("rate_date", "yyyy-MM-dd").alias("rate_date"),
        "_source_file", "_source_line")
    return keep_first(typed, ["rate_date", "currency"], ["_source_file", "_source_line"],
                      descending=True).select("units_per_usd", "currency", "rate_date")


# -- processor A ---------------------------------------------------------------
def base_processor_a(raw: DataFrame) -> DataFrame:
    """Every raw row typed, with the first rule it breaks (null when valid)."""
    parsed = raw.select(
        _nullif_empty("balance_transaction_id").alias("balance_transaction_id"),
        F.try_to_timestamp("created_utc", F.lit("yyyy-MM-dd HH:mm:ss")).alias("created_at"),
        F.col("created_utc").alias("created_at_source"),
        F.try_to_date(F.substring("available_on_utc", 1, 10), "yyyy-MM-dd")
        .alias("available_on_date"),
        F.upper("currency").alias("settlement_currency"),
        to_minor_units(F.col("gross"), F.col("currency")).alias("gross_minor"),
        to_minor_units(F.col("fee"), F.col("currency")).alias("fee_minor"),
        to_minor_units(F.col("net"), F.col("currency")).alias("net_minor"),
        "reporting_category",
        _nullif_empty("source_id").alias("source_id"),
        "description",
        F.upper(_nullif_empty("customer_facing_currency")).alias("presentment_currency"),
        to_minor_units(F.col("customer_facing_amount"), F.col("customer_facing_currency"))
        .alias("presentment_amount_minor"),
        _nullif_empty("automatic_payout_id").alias("automatic_payout_id"),
        _nullif_empty("payment_metadata_order_id").try_cast("bigint").alias("order_id"),
        "_source_file", "_source_line", "_loaded_at",
        file_date(F.col("_source_file")).alias("file_date"),
    )
    reason = (
        F.when(F.col("balance_transaction_id").isNull(), "missing balance_transaction_id")
        .when(F.col("created_at").isNull(), "unparseable created_utc")
        .when(F.col("gross_minor").isNull(), "unparseable gross")
        .when(F.col("fee_minor").isNull(), "unparseable fee")
        .when(F.col("net_minor").isNull(), "unparseable net")
        .when(F.col("gross_minor") - F.col("fee_minor") != F.col("net_minor"), "gross - fee != net")
    )
    return _once(parsed).withColumn("invalid_reason", reason)


def stg_processor_a_txns(base: DataFrame) -> DataFrame:
    """Valid rows, one per id; a restatement in a later file wins."""
    valid = base.filter(F.col("invalid_reason").isNull()).drop("invalid_reason")
    return keep_first(valid, ["balance_transaction_id"], ["file_date", "_source_line"], descending=True)


def stg_processor_a_payouts(raw: DataFrame) -> DataFrame:
    """The payout file is a status log: keep each payout's latest status."""
    parsed = raw.select(
        "payout_id",
        F.try_to_timestamp("created_utc", F.lit("yyyy-MM-dd HH:mm:ss")).alias("created_at"),
        F.try_to_date("arrival_date", "yyyy-MM-dd").alias("arrival_date"),
        to_minor_units(F.col("amount"), F.col("currency")).alias("amount_minor"),
        F.upper("currency").alias("currency"),
        "status",
        _nullif_empty("failure_code").alias("failure_code"),
        F.try_to_timestamp("status_changed_utc", F.lit("yyyy-MM-dd HH:mm:ss")).alias("status_changed_at"),
        "_source_file", "_source_line")
    return keep_first(parsed, ["payout_id"], ["status_changed_at", "_source_file", "_source_line"],
                      descending=True)


# -- processor B ---------------------------------------------------------------
# Fixed value: merchant reference format carrying our order id.
ORDER_REFERENCE_PATTERN = r"^ORD-(\d+)$"


def base_processor_b(raw: DataFrame) -> DataFrame:
    """Typed settlement lines.  Local CET/CEST wall time becomes UTC using the
    row's own zone label, which also settles the repeated autumn hour."""
    offset = F.when(F.col("timezone") == "CET", "+01:00").when(F.col("timezone") == "CEST", "+02:00")
    order_ref = F.nullif(F.regexp_extract("merchant_reference", ORDER_REFERENCE_PATTERN, 1), F.lit(""))

    def minor(c, ccy):
        return to_minor_units(_nullif_empty(c), F.col(ccy))

    parsed = raw.select(
        _nullif_empty("psp_reference").alias("psp_reference"),
        _nullif_empty("merchant_reference").alias("merchant_reference"),
        order_ref.try_cast("bigint").alias("order_id"),
        _nullif_empty("payment_method").alias("payment_method"),
        F.col("creation_date").alias("created_at_local"),
        F.col("timezone").alias("source_timezone"),
        F.try_to_timestamp(F.concat("creation_date", offset), F.lit("yyyy-MM-dd HH:mm:ssXXX"))
        .alias("created_at"),
        F.col("type").alias("record_type"),
        "modification_reference",
        F.upper("gross_currency").alias("gross_currency"),
        (F.coalesce(minor("gross_credit_gc", "gross_currency"), F.lit(0))
         - F.coalesce(minor("gross_debit_gc", "gross_currency"), F.lit(0))).alias("gross_minor"),
        _nullif_empty("exchange_rate").try_cast("decimal(38,9)").alias("exchange_rate"),
        F.upper("net_currency").alias("net_currency"),
        minor("net_credit_nc", "net_currency").alias("net_credit_minor"),
        minor("net_debit_nc", "net_currency").alias("net_debit_minor"),
        F.coalesce(F.col("net_credit_nc"), F.lit("")).alias("net_credit_nc"),
        F.coalesce(F.col("net_debit_nc"), F.lit("")).alias("net_debit_nc"),
        F.coalesce(minor("commission_nc", "net_currency"), F.lit(0)).alias("commission_minor"),
        F.coalesce(minor("markup_nc", "net_currency"), F.lit(0)).alias("markup_minor"),
        F.coalesce(minor("scheme_fees_nc", "net_currency"), F.lit(0)).alias("scheme_fees_minor"),
        F.coalesce(minor("interchange_nc", "net_currency"), F.lit(0)).alias("interchange_minor"),
        F.col("batch_number").try_cast("bigint").alias("batch_number"),
        "_source_file", "_source_line", "_loaded_at",
    )
    reason = (
        F.when(F.col("created_at").isNull(), "unparseable Creation Date / TimeZone")
        .when(F.col("batch_number").isNull(), "unparseable Batch Number")
        .when((F.col("net_credit_nc") != "") & F.col("net_credit_minor").isNull(),
              "unparseable Net Credit (NC)")
        .when((F.col("net_debit_nc") != "") & F.col("net_debit_minor").isNull(),
              "unparseable Net Debit (NC)")
        .when((F.col("net_credit_nc") == "") & (F.col("net_debit_nc") == ""), "no net amount")
    )
    line_id = F.md5(F.concat_ws("|", F.coalesce(F.col("psp_reference"), F.lit("")),
                                F.col("record_type"), F.col("modification_reference")))
    return (_once(parsed)
            .withColumn("net_minor", F.coalesce(F.col("net_credit_minor"), F.lit(0))
                        - F.coalesce(F.col("net_debit_minor"), F.lit(0)))
            .withColumn("settlement_line_id", line_id)
            .withColumn("invalid_reason", reason)
            .drop("net_credit_minor", "net_debit_minor", "net_credit_nc", "net_debit_nc"))


def stg_processor_b_lines(base: DataFrame) -> DataFrame:
    """Valid lines, one per line id; an exact re-send keeps the earliest file."""
    valid = base.filter(F.col("invalid_reason").isNull()).drop("invalid_reason")
    return keep_first(valid, ["settlement_line_id"], ["_source_file", "_source_line"])


# -- exceptions ----------------------------------------------------------------
def stg_exceptions(base_a: DataFrame, base_b: DataFrame, load_exceptions: DataFrame, *others: DataFrame) -> DataFrame:
    """Everything that arrived but cannot be trusted, with the reason; ``others``: as from
    :func:`app_exceptions` and :func:`fx_exceptions`."""
    a = base_a.filter(F.col("invalid_reason").isNotNull()).select(
        F.lit("processor_a_balance_transactions").alias("source_table"),
        F.coalesce("balance_transaction_id", "source_id").alias("record_key"),
        "invalid_reason", "_source_file", "_source_line")
    b = base_b.filter(F.col("invalid_reason").isNotNull()).select(
        F.lit("processor_b_settlement_details").alias("source_table"),
        F.col("settlement_line_id").alias("record_key"),
        "invalid_reason", "_source_file", "_source_line")
    loader = load_exceptions.select(
        F.lit("loader").alias("source_table"),
        F.col("line_number").cast("string").alias("record_key"),
        F.col("reason").alias("invalid_reason"), "_source_file",
        F.col("line_number").alias("_source_line"))
    out = a.unionByName(b).unionByName(loader)
    for o in others:
        out = out.unionByName(o)
    return out
