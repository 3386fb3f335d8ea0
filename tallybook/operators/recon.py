"""Reconciliations: orders vs processors, processors vs bank, daily
three-way, orphan dispute reversals, missing batch files, batch carry."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.contracts import DEFAULT_POLICY, Policy
from .journal import COUNTERPARTIES


def order_settlement_match(orders: DataFrame, events: DataFrame) -> DataFrame:
    """Full outer match of orders and charges on order id.

    Charges without an order id match nothing and stay out of the join; the others look their
    order up (a left join, whose charge side the adaptive skew join splits), and orders without a
    charge are found by an anti join with the distinct order ids of the charges.
    """
    o = orders.select(F.col("order_id").alias("o_id"), F.col("currency").alias("order_currency"),
                      F.col("amount_minor").alias("order_amount_minor"),
                      F.col("processor").alias("o_proc"), "processor_charge_ref",
                      F.to_date("created_at").alias("o_date"))
    c = events.filter(F.col("event_type") == "charge").select(
        "settlement_event_id", F.col("order_id").alias("c_oid"),
        F.col("presentment_currency").alias("settled_currency"),
        F.col("presentment_amount_minor").alias("settled_amount_minor"),
        F.col("processor").alias("c_proc"), "processor_reference", "event_date")
    known = c.filter(F.col("c_oid").isNotNull())
    paired = known.join(o, F.col("c_oid") == F.col("o_id"), "left")
    lone = o.join(known.select(F.col("c_oid").alias("_id")).distinct(), F.col("o_id") == F.col("_id"), "left_anti")
    j = (paired.unionByName(c.filter(F.col("c_oid").isNull()), allowMissingColumns=True)
         .unionByName(lone, allowMissingColumns=True))
    status = (F.when(F.col("settlement_event_id").isNull(), "order_without_settlement")
              .when(F.col("o_id").isNull(), "settlement_without_order")
              .when((F.col("order_currency") != F.col("settled_currency"))
                    | (F.col("order_amount_minor") != F.col("settled_amount_minor")), "amount_mismatch")
              .otherwise("matched"))
    return j.select(
        "settlement_event_id", "order_currency", "order_amount_minor", "settled_currency",
        "settled_amount_minor", F.coalesce("o_id", "c_oid").alias("order_id"),
        F.coalesce("c_proc", "o_proc").alias("processor"),
        F.coalesce("processor_reference", "processor_charge_ref").alias("charge_reference"),
        F.coalesce("o_date", "event_date").alias("match_date"), status.alias("match_status"))


def payout_reconciliation(events: DataFrame, bank: DataFrame,
                          policy: Policy = DEFAULT_POLICY) -> DataFrame:
    payouts = events.filter(F.col("event_type") == "payout").select(
        F.col("processor").alias("p_proc"), F.col("processor_reference").alias("p_ref"),
        F.col("settlement_currency").alias("p_ccy"), F.col("event_date").alias("payout_date"),
        (-F.col("net_settlement_minor")).alias("payout_amount_minor"))
    failures = events.filter(F.col("event_type") == "payout_reversal") \
        .select(F.col("processor_reference").alias("f_ref")).distinct()
    receipts = (bank.filter(F.col("counterparty_name").isin(*COUNTERPARTIES))
                .groupBy(F.col("end_to_end_reference").alias("r_ref"),
                         F.when(F.col("counterparty_name") == COUNTERPARTIES[0], "processor_a")
                         .otherwise("processor_b").alias("r_proc"),
                         F.col("currency").alias("r_ccy"))
                .agg(F.min("booking_date").alias("bank_booking_date"),
                     F.sum("amount_minor").alias("bank_amount_minor")))
    j = (payouts.join(receipts, payouts["p_ref"] == receipts["r_ref"], "full_outer")
         .join(failures, F.col("p_ref") == F.col("f_ref"), "left"))
    status = (F.when(F.col("p_ref").isNull(), "bank_receipt_without_report")
              .when(F.col("f_ref").isNotNull() & F.col("r_ref").isNull(), "failed_and_returned")
              .when(F.col("r_ref").isNull(), "in_transit")
              .when(F.abs(F.col("bank_amount_minor") - F.col("payout_amount_minor"))
                    > policy.recon_tolerance_minor, "amount_break")
              .otherwise("matched"))
    return j.select(
        "payout_date", "bank_booking_date", "payout_amount_minor", "bank_amount_minor",
        F.coalesce("p_ref", "r_ref").alias("payout_reference"),
        F.coalesce("p_proc", "r_proc").alias("processor"),
        F.coalesce("p_ccy", "r_ccy").alias("currency"),
        (F.coalesce("bank_amount_minor", F.lit(0)) - F.coalesce("payout_amount_minor", F.lit(0)))
        .alias("difference_minor"),
        status.alias("recon_status"))


def daily_reconciliation(events: DataFrame, ledger: DataFrame, payout_recon: DataFrame,
                         policy: Policy = DEFAULT_POLICY) -> DataFrame:
    """(date, processor, currency): processor net vs ledger cash, payouts vs bank.

    The three daily aggregates are stacked into one frame and summed in a
    single aggregation (one shuffle) instead of key-union + three joins.
    """
    zero = F.lit(0).cast("bigint")
    proc = events.select(F.col("event_date").alias("recon_date"), "processor",
                         F.col("settlement_currency").alias("currency"),
                         F.col("net_settlement_minor").alias("pn"), zero.alias("lc"),
                         zero.alias("pr"), zero.alias("br"), zero.alias("pm"), zero.alias("pt"),
                         zero.alias("pf"), zero.alias("pb"))
    led = ledger.filter(F.col("account_code").isin("1000", "1010")).select(
        F.col("posting_date").alias("recon_date"), F.col("source_system").alias("processor"),
        F.col("original_currency").alias("currency"), zero.alias("pn"),
        F.col("original_amount_minor").alias("lc"), zero.alias("pr"), zero.alias("br"),
        zero.alias("pm"), zero.alias("pt"), zero.alias("pf"), zero.alias("pb"))
    s = F.col("recon_status")
    flag = lambda c: F.when(c, 1).otherwise(0).cast("bigint")
    pay = payout_recon.select(
        F.coalesce("payout_date", "bank_booking_date").alias("recon_date"), "processor", "currency",
        zero.alias("pn"), zero.alias("lc"),
        F.coalesce("payout_amount_minor", zero).alias("pr"),
        F.coalesce("bank_amount_minor", zero).alias("br"),
        flag(s == "matched").alias("pm"), flag(s == "in_transit").alias("pt"),
        flag(s == "failed_and_returned").alias("pf"),
        flag(s.isin("amount_break", "bank_receipt_without_report")).alias("pb"))
    stacked = proc.unionByName(led).unionByName(pay)
    g = stacked.groupBy("recon_date", "processor", "currency").agg(
        F.sum("pn").alias("processor_net_minor"), F.sum("lc").alias("ledger_cash_minor"),
        F.sum("pr").alias("payouts_reported_minor"), F.sum("br").alias("bank_received_minor"),
        F.sum("pm").alias("payouts_matched"), F.sum("pt").alias("payouts_in_transit"),
        F.sum("pf").alias("payouts_failed"), F.sum("pb").alias("payout_breaks"))
    diff = F.col("ledger_cash_minor") - F.col("processor_net_minor")
    return g.select(
        "recon_date", "processor", "currency",
        F.coalesce("processor_net_minor", zero).alias("processor_net_minor"),
        F.coalesce("ledger_cash_minor", zero).alias("ledger_cash_minor"),
        diff.alias("ledger_vs_processor_minor"),
        "payouts_reported_minor", "bank_received_minor", "payouts_matched", "payouts_in_transit",
        "payouts_failed", "payout_breaks",
        F.when((F.abs(diff) > policy.recon_tolerance_minor) | (F.col("payout_breaks") > 0), "break")
        .otherwise("ok").alias("break_status"))


def orphan_dispute_reversals(ledger: DataFrame) -> DataFrame:
    et = F.col("source_event_type")
    g = (ledger.filter(F.col("order_id").isNotNull() & et.isin("dispute", "dispute_reversal"))
         .groupBy("order_id", F.col("source_system").alias("processor"))
         .agg(F.count_distinct(F.when(et == "dispute", F.col("journal_entry_id"))).alias("disputes_reported"),
              F.count_distinct(F.when(et == "dispute_reversal", F.col("journal_entry_id")))
              .alias("reversals_reported"),
              F.min(F.when(et == "dispute_reversal", F.col("posting_date"))).alias("first_reversal_date"),
              F.sum(F.when((F.col("account_code") == "2000") & (et == "dispute_reversal"),
                           -F.col("amount_usd_minor")).otherwise(0))
              .alias("reversal_credited_to_seller_usd_minor")))
    return g.filter(F.col("reversals_reported") > F.col("disputes_reported"))


BATCH_FILE_PATTERN = r"settlement_detail_report_batch_(\d+)\.csv$"


def batch_gaps(manifest: DataFrame) -> DataFrame:
    """Batch numbers with no received file (from the manifest, not rows: a
    header-only file is not a gap)."""
    received = (manifest.filter(F.col("source") == "processor_b_settlement_details")
                .select(F.nullif(F.regexp_extract("file_name", BATCH_FILE_PATTERN, 1), F.lit(""))
                        .try_cast("bigint").alias("batch_number")).distinct())
    b = received.agg(F.min("batch_number").alias("f"), F.max("batch_number").alias("l"))
    expected = b.select(F.explode(F.when(F.col("f") <= F.col("l"), F.sequence("f", "l")))
                        .alias("batch_number"))
    missing = expected.join(received, "batch_number", "left_anti")
    return missing.select(
        F.col("batch_number").alias("missing_batch_number"),
        F.concat(F.lit("PAYOUT-"), F.format_string("%04d", F.col("batch_number")))
        .alias("expected_payout_reference"))


def batch_payout_carry(nets: DataFrame, key: str = "merchant", order: str = "batch",
                       value: str = "net") -> DataFrame:
    """Payout per batch = positive running net; a negative batch carries to
    the next one.  Closed form: S = running net, M = max(0, running max S),
    payout = M - lag(M), carry = S - M.  Two window passes per key."""
    w = Window.partitionBy(key).orderBy(order)
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    s = nets.withColumn("_s", F.sum(value).over(run))
    s = s.withColumn("_m", F.greatest(F.lit(0), F.max("_s").over(run)))
    return s.select(*nets.columns,
                    (F.col("_m") - F.coalesce(F.lag("_m").over(w), F.lit(0))).alias("payout"),
                    (F.col("_s") - F.col("_m")).alias("carry"))
