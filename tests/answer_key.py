"""Answer-key coverage report: planted issues vs what the pipeline caught.

The expected side is derived from the *base facts* of the driver feeds (the
rules that planted each problem), independently of staging and the ledger;
the observed side reads the pipeline's outputs.  One row per check:
(check, passed, expected, got).  Every input is a DataFrame; each check is
one or two aggregations, nothing is collected row-wise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.sources.driver import MISSING_B_BATCH


def _row(name: str, expected: DataFrame, got: DataFrame, equal: bool = True) -> DataFrame:
    """Both inputs are one-row frames with a single bigint column."""
    e = expected.select(F.col(expected.columns[0]).cast("bigint").alias("expected"))
    g = got.select(F.col(got.columns[0]).cast("bigint").alias("got"))
    j = e.crossJoin(g)   # one row x one row
    passed = (F.col("expected") == F.col("got")) if equal else (F.col("got") == 0)
    return j.select(F.lit(name).alias("check"), F.coalesce(passed, F.lit(False)).alias("passed"),
                    "expected", "got")


def _count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def _sym_diff(a: DataFrame, b: DataFrame, name: str, expected_size: DataFrame) -> DataFrame:
    """Set equality: got = |a xor b| must be 0; expected = |a|."""
    diff = a.join(b, a.columns, "left_anti").unionByName(b.join(a, a.columns, "left_anti"))
    return _row(name, expected_size, _count(diff), equal=False)


def coverage_report(m) -> DataFrame:
    raw = m.raw
    ev = raw.base_events
    key = F.col("order_id")
    a_ev = ev.filter(F.col("processor") == "processor_a")
    b_ev = ev.filter((F.col("processor") == "processor_b"))
    landed_b = b_ev.filter(F.col("m") + 1 != MISSING_B_BATCH)
    stg_a, stg_b, exc = m.stg_processor_a_txns, m.stg_processor_b_lines, m.stg_exceptions
    rows = []

    # Processor A file mess.
    dup = a_ev.filter((F.col("kind") == "charge") & (key % 43 == 0) & (key % 41 != 0)) \
        .select(F.concat(F.lit("txn_ch_"), F.col("ekey")).alias("balance_transaction_id"))
    raw_a = raw.raw_processor_a_landed.join(dup, "balance_transaction_id", "left_semi")
    rows.append(_row("processor_a_duplicate_rows", _count(dup).select((F.col("n") * 3).alias("n")),
                     _count(raw_a).crossJoin(_count(stg_a.join(dup, "balance_transaction_id", "left_semi"))
                                             .withColumnRenamed("n", "s"))
                     .select((F.col("n") + F.col("s")).alias("x"))))
    late = a_ev.filter((F.col("kind") == "refund") & (key % 29 == 0) & (key % 50 != 0) & (key % 53 != 0)) \
        .select(F.concat(F.lit("txn_re_"), F.col("ekey")).alias("balance_transaction_id"))
    rows.append(_row("processor_a_late_rows", _count(late),
                     _count(stg_a.join(late, "balance_transaction_id", "left_semi"))))
    restated = a_ev.filter((F.col("kind") == "charge") & (key % 41 == 0)).select(
        F.concat(F.lit("txn_ch_"), F.col("ekey")).alias("balance_transaction_id"),
        (F.col("sfee") + 1).alias("fee_minor"))
    rows.append(_row("processor_a_restated_rows", _count(restated),
                     _count(stg_a.join(restated, ["balance_transaction_id", "fee_minor"], "left_semi"))))
    malformed_a = a_ev.filter(((F.col("kind") == "dispute") & (key % 47 == 0))
                              | ((F.col("kind") == "refund") & (key % 50 == 0) & (key % 53 != 0)))
    rows.append(_row("processor_a_malformed_rows", _count(malformed_a),
                     _count(exc.filter(F.col("source_table") == "processor_a_balance_transactions"))))
    truncated = a_ev.filter((F.col("kind") == "refund") & (key % 53 == 0))
    rows.append(_row("processor_a_truncated_rows", _count(truncated),
                     _count(raw.load_exceptions)))

    # Processor B file mess.
    b_line = lambda prefix: F.md5(F.concat_ws("|", F.concat(F.lit("PSP"), key.cast("string")),
                                              F.lit(prefix[0]), F.concat(F.lit(prefix[1]), F.col("ekey"))))
    b_dup = landed_b.filter((F.col("kind") == "charge") & (key % 43 == 0) & (key % 59 != 0)) \
        .select(b_line(("Settled", "MOD-CH-")).alias("settlement_line_id"))
    rows.append(_row("processor_b_duplicate_rows", _count(b_dup),
                     _count(stg_b.join(b_dup, "settlement_line_id", "left_semi"))))
    b_bad = landed_b.filter((F.col("kind") == "refund") & (key % 51 == 0)) \
        .select(b_line(("Refunded", "MOD-RE-")).alias("record_key"))
    rows.append(_row("processor_b_malformed_rows", _count(b_bad),
                     _count(exc.join(b_bad, "record_key", "left_semi"))))
    gaps = m.batch_gaps
    status = m.payout_reconciliation.filter(
        (F.col("payout_reference") == F.format_string("PAYOUT-%04d", F.lit(MISSING_B_BATCH)))
        & (F.col("recon_status") == "bank_receipt_without_report"))
    rows.append(_row("processor_b_missing_batch_file",
                     gaps.sparkSession.range(1).select(F.lit(2).alias("n")),
                     _count(gaps.filter(F.col("missing_batch_number") == MISSING_B_BATCH))
                     .crossJoin(_count(status).withColumnRenamed("n", "s"))
                     .select((F.col("n") + F.col("s")).alias("x"))))

    # Orphan reversals: landed reversals outnumber landed disputes per (order, processor).
    landed = ev.filter(~((F.col("processor") == "processor_b") & (F.col("m") + 1 == MISSING_B_BATCH))
                       & ~((F.col("processor") == "processor_a") & (F.col("kind") == "dispute") & (key % 47 == 0)))
    per = (landed.filter(F.col("kind").isin("dispute", "dispute_reversal"))
           .groupBy("order_id", "processor")
           .agg(F.count_if(F.col("kind") == "dispute").alias("d"),
                F.count_if(F.col("kind") == "dispute_reversal").alias("r")))
    want = per.filter(F.col("r") > F.col("d")).select("order_id", "processor")
    got = m.orphan_dispute_reversals.select("order_id", "processor")
    rows.append(_sym_diff(want, got, "orphaned_dispute_reversals", _count(want)))

    # System mismatches.
    app_orders = raw.orders_all.filter(key % 97 != 0).select("order_id")
    landed_charges = landed.filter((F.col("kind") == "charge")
                                   & ~((F.col("processor") == "processor_b") & (key % 59 == 0)))
    unsettled = app_orders.join(landed_charges.select("order_id"), "order_id", "left_anti")
    flagged = m.order_settlement_match.filter(F.col("match_status") == "order_without_settlement") \
        .select("order_id")
    rows.append(_sym_diff(unsettled, flagged, "orders_without_settlement", _count(unsettled)))
    orphan_charges = landed_charges.filter(key % 97 == 0).select("order_id")
    rows.append(_sym_diff(orphan_charges, m.order_settlement_match.filter(
        F.col("match_status") == "settlement_without_order").select("order_id"),
        "settlements_without_order", _count(orphan_charges)))
    mism = landed_charges.filter((key % 101 == 0) & (key % 97 != 0)).select("order_id")
    rows.append(_sym_diff(mism, m.order_settlement_match.filter(
        F.col("match_status") == "amount_mismatch").select("order_id"),
        "amount_mismatches_all_planted", _count(mism)))

    # Time and FX.
    b_charges = landed_charges.filter(F.col("processor") == "processor_b").select(
        "order_id", F.to_date("occurred_at").alias("utc_date"))
    got_dates = m.settlement_events.filter((F.col("processor") == "processor_b")
                                           & (F.col("event_type") == "charge")) \
        .select("order_id", F.col("event_date").alias("utc_date")).distinct()
    rows.append(_sym_diff(b_charges.distinct(), got_dates, "timezone_boundary_utc_dates", _count(b_charges)))
    pub = m.stg_fx.select("currency", "rate_date").distinct()
    span = pub.agg(F.datediff(F.max("rate_date"), F.min("rate_date")).alias("d"),
                   F.count_distinct("currency").alias("c"))
    fills = span.crossJoin(_count(pub)).select(((F.col("d") + 15) * F.col("c") - F.col("n")).alias("x"))
    rows.append(_row("fx_filled_currency_days", fills,
                     _count(m.fx_rates_daily.filter((F.col("currency") != "USD") & ~F.col("is_published")))))

    # Payouts.
    failed = raw.payouts.filter(F.col("failed") & ~F.col("unreported"))
    rows.append(_row("processor_a_payouts_failed", _count(failed), _count(m.payout_reconciliation.filter(
        (F.col("processor") == "processor_a") & (F.col("recon_status") == "failed_and_returned")))))
    returns = m.stg_seller_payouts.filter(F.col("returned_at").isNotNull())
    rows.append(_row("seller_payouts_returned", _count(returns), m.ledger_entries.filter(
        F.col("source_event_type") == "seller_payout_return").agg(F.count_distinct("journal_entry_id"))))

    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out
