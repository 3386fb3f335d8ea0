"""Whole-pipeline invariants on the smallest driver dataset."""

import pytest

from tallybook.registry import all_queries

EMPTY_CHECKS = ["dq_sums_to_zero_entry", "dq_sums_to_zero_month", "dq_gl_sums_to_zero_entry",
                "dq_tb_closing_nets_to_zero", "dq_tb_period_nets_to_zero", "dq_balance_sheet",
                "dq_event_posted_once", "dq_metrics_tie", "dq_churn_flows", "dq_recon_tolerance",
                "dq_unique_ledger_line", "dq_not_null_journal_entry", "dq_accepted_event_types",
                "dq_account_relationship", "dq_a_landed_once"]


@pytest.mark.parametrize("key", EMPTY_CHECKS)
def test_invariant_holds(spark, key):
    from conftest import SF_SMALL
    assert all_queries()[key](spark, SF_SMALL).count() == 0


def test_every_status_value_occurs(spark):
    from conftest import SF_MID
    q = all_queries()
    recon = {r.recon_status for r in q["payout_reconciliation"](spark, SF_MID).select("recon_status").distinct().collect()}
    assert recon == {"matched", "amount_break", "failed_and_returned", "in_transit", "bank_receipt_without_report"}
    match = {r.match_status for r in q["order_settlement_match"](spark, SF_MID).select("match_status").distinct().collect()}
    assert match == {"matched", "amount_mismatch", "order_without_settlement", "settlement_without_order"}
    dep = {r.departure for r in q["seller_months"](spark, SF_MID).select("departure").distinct().collect()}
    assert dep == {"retained", "paused", "churned", "undetermined"}
    gaps = [r.missing_batch_number for r in q["batch_gaps"](spark, SF_MID).collect()]
    assert gaps == [41]


def test_planted_bad_rows_land_in_exceptions(spark, models_small):
    reasons = {r.invalid_reason for r in models_small.stg_exceptions.select("invalid_reason").distinct().collect()}
    assert {"missing balance_transaction_id", "unparseable gross", "expected 14 fields, got 9"} <= reasons


def test_mutation_is_caught(spark, models_small):
    """Drop one ledger line: the double-entry check must report its entry."""
    from pyspark.sql import functions as F
    from tallybook.operators.quality import sums_to_zero
    led = models_small.ledger_entries
    victim = led.select("ledger_line_id").orderBy("ledger_line_id").first().ledger_line_id
    broken = led.filter(F.col("ledger_line_id") != victim)
    assert sums_to_zero(broken, "amount_usd_minor", "journal_entry_id").count() == 1


def test_answer_key_coverage_all_pass(spark):
    from conftest import SF_SMALL
    from answer_key import coverage_report
    from tallybook.plans.models import Models
    rows = coverage_report(Models(spark, SF_SMALL)).collect()
    assert len(rows) == 16
    assert [r.check for r in rows if not r.passed] == []


def test_sign_flip_is_caught(spark, models_small):
    """Flip the sign of one revenue line: double entry and the metric tie-out both break."""
    from pyspark.sql import functions as F
    from tallybook.operators.quality import sums_to_zero
    led = models_small.ledger_entries
    victim = led.filter(F.col("account_code") == "4000").select("ledger_line_id") \
        .orderBy("ledger_line_id").first().ledger_line_id
    flipped = led.withColumn("amount_usd_minor", F.when(F.col("ledger_line_id") == victim,
                                                        -F.col("amount_usd_minor"))
                             .otherwise(F.col("amount_usd_minor")))
    assert sums_to_zero(flipped, "amount_usd_minor", "journal_entry_id").count() == 1
    from tallybook.operators.quality import metrics_tie_to_ledger
    tie = metrics_tie_to_ledger(flipped, models_small.stg_orders, models_small.metrics_monthly)
    assert [r.metric for r in tie.collect()] == ["net_revenue"]
