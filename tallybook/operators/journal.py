"""Settlement events and double-entry journal lines.

Signs: a journal amount is debit-positive; a settlement event's net is
positive when money moves into the processor balance.  Each journal entry
nets to zero.  Lines are generated per row with ``inline(array(struct))``
(a lateral unnest, no join), so posting is a narrow, codegen'd projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import scaled_rate, to_usd_minor

EVENT_TYPE_BY_B_RECORD = {
    "Settled": "charge", "Refunded": "refund", "Chargeback": "dispute", "Fee": "dispute_fee",
    "ChargebackReversed": "dispute_reversal", "MerchantPayout": "payout",
}
A_CATEGORIES = ("charge", "refund", "dispute", "dispute_reversal", "payout", "payout_reversal")

LEDGER_COLUMNS = [
    "ledger_line_id", "journal_entry_id", "posting_date", "occurred_at", "account_code",
    "amount_usd_minor", "source_system", "source_event_type", "source_reference",
    "processor_reference", "order_id", "seller_id", "original_currency", "original_amount_minor",
]


def _line(account, amount) -> Column:
    account = F.lit(account) if isinstance(account, str) else account
    return F.struct(account.alias("account_code"), amount.cast("bigint").alias("amount_usd_minor"))


def settlement_events(stg_a: DataFrame, stg_b: DataFrame) -> DataFrame:
    """Both processors' rows in one shape: one row per money movement."""
    cat = F.col("reporting_category")
    a = stg_a.select(
        F.col("balance_transaction_id").alias("settlement_event_id"),
        F.lit("processor_a").alias("processor"),
        F.when(cat.isin(*A_CATEGORIES), cat).alias("event_type"),
        F.col("created_at").alias("occurred_at"),
        F.col("source_id").alias("processor_reference"),
        F.col("automatic_payout_id").alias("payout_reference"),
        F.lit(None).cast("bigint").alias("batch_number"),
        "order_id", "presentment_currency", "presentment_amount_minor", "settlement_currency",
        F.col("gross_minor").alias("gross_settlement_minor"), "fee_minor",
        F.col("net_minor").alias("net_settlement_minor"), "_source_file")
    rt = F.col("record_type")
    etype = None
    for k, v in EVENT_TYPE_BY_B_RECORD.items():
        etype = F.when(rt == k, v) if etype is None else etype.when(rt == k, v)
    is_fee = rt == "Fee"
    fees = F.when(is_fee, -F.col("net_minor")).otherwise(
        F.col("commission_minor") + F.col("markup_minor") + F.col("scheme_fees_minor")
        + F.col("interchange_minor"))
    b = stg_b.withColumn("_fees", fees).select(
        F.col("settlement_line_id").alias("settlement_event_id"),
        F.lit("processor_b").alias("processor"),
        etype.alias("event_type"),
        F.col("created_at").alias("occurred_at"),
        F.coalesce("psp_reference", "modification_reference").alias("processor_reference"),
        F.when(rt == "MerchantPayout", F.col("modification_reference")).alias("payout_reference"),
        "batch_number", "order_id",
        F.when(is_fee, F.lit(None)).otherwise(F.col("gross_currency")).alias("presentment_currency"),
        F.when(is_fee, F.lit(None)).otherwise(F.col("gross_minor")).alias("presentment_amount_minor"),
        F.col("net_currency").alias("settlement_currency"),
        (F.col("net_minor") + F.col("_fees")).alias("gross_settlement_minor"),
        F.col("_fees").alias("fee_minor"),
        F.col("net_minor").alias("net_settlement_minor"), "_source_file")
    return a.unionByName(b).withColumn("event_date", F.to_date("occurred_at"))


def _rate_lookup(rates: DataFrame, prefix: str) -> DataFrame:
    return rates.select(F.col("currency").alias(f"{prefix}_ccy"),
                        F.col("rate_date").alias(f"{prefix}_date"),
                        F.col("units_per_usd").alias(f"{prefix}_rate"),
                        scaled_rate("units_per_usd").alias(f"{prefix}_scaled"))   # once per rate, not per line


def journal_settlements(events: DataFrame, orders: DataFrame, rates: DataFrame) -> DataFrame:
    """2-5 signed lines per settlement event, as :func:`settlement_postings` books them."""
    return settlement_lines(settlement_postings(events, orders, rates))


def settlement_postings(events: DataFrame, orders: DataFrame, rates: DataFrame) -> DataFrame:
    """One row per settlement event with its ``lines`` (five posting rules, first match wins).

    This is how the journal is stored: the columns that an entry's lines share once, and no ids
    that follow from them.

    ``rates`` is the daily FX calendar (days x currencies).  No hint: AQE
    measures it at runtime and broadcasts it when under the broadcast
    threshold, else falls back to a sort-merge join.
    """
    o = orders.select(F.col("order_id").alias("_oid"), "seller_id",
                      F.col("currency").alias("order_currency"), "platform_fee_minor")
    sr = _rate_lookup(rates, "sr")
    pr = _rate_lookup(rates, "pr")
    conv = (events
            .join(o, events["order_id"] == o["_oid"], "left")
            .join(sr, (F.col("settlement_currency") == F.col("sr_ccy"))
                  & (F.col("event_date") == F.col("sr_date")), "left")
            .join(pr, (F.col("presentment_currency") == F.col("pr_ccy"))
                  & (F.col("event_date") == F.col("pr_date")), "left")
            .select(
                events["*"], "seller_id",
                F.col("_oid").isNotNull().alias("is_matched"),
                to_usd_minor(F.col("net_settlement_minor"), F.col("settlement_currency"),
                             F.col("sr_rate"), "sr_scaled").alias("net_usd"),
                to_usd_minor(F.col("fee_minor"), F.col("settlement_currency"),
                             F.col("sr_rate"), "sr_scaled").alias("fee_usd"),
                to_usd_minor(F.col("presentment_amount_minor"), F.col("presentment_currency"),
                             F.col("pr_rate"), "pr_scaled").alias("booked_usd"),
                to_usd_minor(F.col("platform_fee_minor"), F.col("order_currency"),
                             F.col("pr_rate"), "pr_scaled").alias("platform_fee_usd")))
    is_a = F.col("processor") == "processor_a"
    cash = F.when(is_a, "1000").otherwise("1010")
    transit = F.when(is_a, "1050").otherwise("1060")
    et = F.col("event_type")
    net, fee, booked, pfee = (F.col("net_usd"), F.col("fee_usd"), F.col("booked_usd"),
                              F.col("platform_fee_usd"))
    lines = (
        F.when(et.isin("payout", "payout_reversal"),
               F.array(_line(cash, net), _line(transit, -net)))
        .when(~F.col("is_matched"),
              F.array(_line(cash, net),
                      _line(F.when(et == "charge", "5000").otherwise("5100"), fee),
                      _line("2100", -(net + fee))))
        .when(et == "charge",
              F.array(_line(cash, net), _line("5000", fee), _line("2000", -(booked - pfee)),
                      _line("4000", -pfee), _line("5200", -(net + fee - booked))))
        .when(et == "dispute_fee", F.array(_line(cash, net), _line("2000", fee)))
        .otherwise(F.array(_line(cash, net), _line("2000", -(booked - fee)),
                           _line("5200", -(net - booked + fee))))
    )
    return conv.select(
        F.col("event_date").alias("posting_date"), "occurred_at",
        F.col("processor").alias("source_system"),
        F.col("event_type").alias("source_event_type"),
        F.col("settlement_event_id").alias("source_reference"),
        "processor_reference", "order_id", "seller_id",
        F.col("settlement_currency").alias("original_currency"),
        F.col("net_settlement_minor").alias("original_amount_minor"),
        lines.alias("lines"))


def settlement_lines(postings: DataFrame) -> DataFrame:
    """The journal lines of :func:`settlement_postings`."""
    out = postings.select("*", F.inline("lines")).drop("lines").select(
        "*",
        F.md5(F.concat_ws("|", "source_system", "source_reference")).alias("journal_entry_id"),
        F.md5(F.concat_ws("|", "source_system", "source_reference", "account_code"))
        .alias("ledger_line_id"))
    # Zero lines are noise; a null amount (missing rate) is kept so checks see it.
    return out.filter((F.col("amount_usd_minor") != 0) | F.col("amount_usd_minor").isNull()).select(
        "posting_date", "occurred_at", "account_code", "amount_usd_minor", "source_system",
        "source_event_type", "source_reference", "processor_reference", "order_id", "seller_id",
        "original_currency", "original_amount_minor", "journal_entry_id", "ledger_line_id")


def payout_transit(events: DataFrame, rates: DataFrame) -> DataFrame:
    """The transit amount that each payout event books (its second journal line), by payout reference.

    From payout events and rates alone: payouts have no order, so no order is read.
    """
    r = _rate_lookup(rates, "pt")
    booked = -to_usd_minor(F.col("net_settlement_minor"), F.col("settlement_currency"), F.col("pt_rate"), "pt_scaled")
    out = (events.filter(F.col("event_type") == "payout")
           .join(r, (F.col("settlement_currency") == F.col("pt_ccy")) & (F.col("event_date") == F.col("pt_date")), "left")
           .select(F.col("processor_reference").alias("_ref"), booked.cast("bigint").alias("transit_usd_minor")))
    return out.filter((F.col("transit_usd_minor") != 0) | F.col("transit_usd_minor").isNull())


COUNTERPARTIES = ("PROCESSOR A PAYOUTS", "PROCESSOR B SETTLEMENT")


def journal_cash(bank: DataFrame, booked: DataFrame, rates: DataFrame,
                 seller_payouts: DataFrame) -> DataFrame:
    """Bank receipts clear transit; seller payouts and their returns."""
    return cash_lines(cash_postings(bank, booked, rates, seller_payouts))


def cash_postings(bank: DataFrame, booked: DataFrame, rates: DataFrame,
                  seller_payouts: DataFrame) -> DataFrame:
    """One row per bank receipt, seller payout and return, with its ``lines``.

    A receipt matched to a booked payout clears transit at the booked USD so
    the payout nets to zero; an unmatched one converts at the booking rate
    and leaves transit negative: the break stays visible on purpose.
    ``booked``: as from :func:`payout_transit`.
    """
    r = _rate_lookup(rates, "br")
    receipts = (bank.filter(F.col("counterparty_name").isin(*COUNTERPARTIES))
                .join(booked, F.col("end_to_end_reference") == F.col("_ref"), "left")
                .join(r, (F.col("currency") == F.col("br_ccy"))
                      & (F.col("booking_date") == F.col("br_date")), "left"))
    is_usd = F.col("currency") == "USD"
    amt = F.coalesce(F.col("transit_usd_minor"),
                     to_usd_minor(F.col("amount_minor"), F.col("currency"), F.col("br_rate"), "br_scaled"))
    receipts = receipts.withColumn("_amt", amt)
    rlines = F.array(_line(F.when(is_usd, "1100").otherwise("1110"), F.col("_amt")),
                     _line(F.when(is_usd, "1050").otherwise("1060"), -F.col("_amt")))
    receipt_rows = receipts.select(
        F.col("booking_date").alias("posting_date"),
        F.col("booking_date").cast("timestamp").alias("occurred_at"),
        F.lit("bank").alias("source_system"),
        F.lit("processor_payout_receipt").alias("source_event_type"),
        F.col("bank_transaction_id").alias("source_reference"),
        F.col("end_to_end_reference").alias("processor_reference"),
        F.lit(None).cast("bigint").alias("order_id"),
        F.lit(None).cast("bigint").alias("seller_id"),
        F.col("currency").alias("original_currency"),
        F.col("amount_minor").alias("original_amount_minor"), rlines.alias("lines"))

    sp = seller_payouts
    initiated = sp.select("seller_payout_id", "seller_id", F.lit("seller_payout").alias("event_type"),
                          F.to_date("initiated_at").alias("posting_date"),
                          F.col("initiated_at").alias("occurred_at"), "amount_minor")
    returned = sp.filter(F.col("returned_at").isNotNull()).select(
        "seller_payout_id", "seller_id", F.lit("seller_payout_return").alias("event_type"),
        F.to_date("returned_at").alias("posting_date"), F.col("returned_at").alias("occurred_at"),
        (-F.col("amount_minor")).alias("amount_minor"))
    spe = initiated.unionByName(returned)
    splines = F.array(_line("2000", F.col("amount_minor")), _line("1100", -F.col("amount_minor")))
    payout_id = F.col("seller_payout_id").cast("string")
    seller_rows = spe.select(
        "posting_date", "occurred_at",
        F.lit("app_db").alias("source_system"),
        F.col("event_type").alias("source_event_type"),
        payout_id.alias("source_reference"),
        F.concat(F.lit("SP-"), payout_id).alias("processor_reference"),
        F.lit(None).cast("bigint").alias("order_id"), "seller_id",
        F.lit("USD").alias("original_currency"),
        F.col("amount_minor").alias("original_amount_minor"), splines.alias("lines"))
    return receipt_rows.unionByName(seller_rows)


def cash_lines(postings: DataFrame) -> DataFrame:
    """The journal lines of :func:`cash_postings`."""
    entry = F.when(F.col("source_system") == "bank", F.concat(F.lit("bank|"), F.col("source_reference"))) \
        .otherwise(F.concat_ws("|", "source_system", "source_event_type", "source_reference"))
    return postings.select("*", F.inline("lines")).drop("lines") \
        .withColumn("journal_entry_id", F.md5(entry)) \
        .withColumn("ledger_line_id", F.md5(F.concat_ws("|", "journal_entry_id", "account_code"))) \
        .select("journal_entry_id", "posting_date", "occurred_at", "account_code", "amount_usd_minor",
                "source_system", "source_event_type", "source_reference", "processor_reference",
                "order_id", "seller_id", "original_currency", "original_amount_minor", "ledger_line_id")


def ledger_entries(settlement_lines: DataFrame, cash_lines: DataFrame) -> DataFrame:
    """The transaction ledger with debit/credit columns.

    ``greatest`` here must keep nulls (a missing rate stays visible), so it is
    spelled as a null-preserving ``when``.
    """
    lines = settlement_lines.select(*LEDGER_COLUMNS).unionByName(cash_lines.select(*LEDGER_COLUMNS))
    amt = F.col("amount_usd_minor")
    return lines.select(
        "*",
        F.when(amt.isNull(), None).when(amt > 0, amt).otherwise(F.lit(0)).cast("bigint")
        .alias("debit_usd_minor"),
        F.when(amt.isNull(), None).when(amt < 0, -amt).otherwise(F.lit(0)).cast("bigint")
        .alias("credit_usd_minor"))
