"""Loader contract on hand-written CSV drops (the reference's loader tests, re-aimed)."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tallybook.sources.contracts import CONTRACTS
from tallybook.sources.ingest import Warehouse, ingest, verify_load

A_HEADER = ",".join(CONTRACTS["processor_a_balance_transactions"].header)
B_HEADER = ",".join(CONTRACTS["processor_b_settlement_details"].header)
BANK_HEADER = ",".join(CONTRACTS["bank_statements"].header)
FX_HEADER = ",".join(CONTRACTS["fx_reference_rates"].header)


def _write(root, rel, text):
    path = os.path.join(root, rel)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def _drop(root):
    a_row = "txn_1,2025-07-10 10:00:00,2025-07-12 00:00:00,usd,10.00,0.59,9.41,charge,ch_1,\"a, b\",10.00,usd,po_1,1"
    a_row2 = "txn_2,2025-07-10 11:00:00,2025-07-12 00:00:00,usd,N/A,0.59,9.41,charge,ch_2,x,10.00,usd,po_1,2"
    short = "txn_3,2025-07-10 12:00:00,x,usd,1.00,0.00,1.00,refund,re_3"
    _write(root, "processor_a/balance_transactions_2025-07-10.csv", "\n".join([A_HEADER, a_row, short, a_row2]) + "\n")
    _write(root, "processor_a/balance_transactions_2025-07-11.csv",
           A_HEADER + "\ntxn_4,2025-07-11 10:00:00,2025-07-13 00:00:00,usd,5.00,0.30,4.70,charge,ch_4,,5.00,usd,,4\n")
    b_rows = ["ACME,SHOP,PSP1,ORD-1,visa,2025-07-10 09:00:00,CEST,Settled,M1,EUR,,10.00,,EUR,,9.50,0.25,0.25,,,1",
              "ACME,SHOP,,,,2025-07-10 23:30:00,CEST,MerchantPayout,PAYOUT-0001,,,,,EUR,9.50,,,,,,1"]
    _write(root, "processor_b/settlement_detail_report_batch_0001.csv", "\n".join([B_HEADER] + b_rows) + "\n")
    bad_bank = BANK_HEADER.replace("end_to_end_reference", "e2e_ref")
    _write(root, "bank/bank_statement_2025-07-12.csv", bad_bank + "\nBT1,NL,2025-07-12,2025-07-12,9.50,eur,X,PAYOUT-0001,d\n")
    _write(root, "fx/reference_rates_2025-07-10.csv", FX_HEADER + "\n2025-07-10,USD,EUR,0.925000\n")


@pytest.fixture()
def dirs():
    raw = tempfile.mkdtemp(prefix="raw-", dir="/tmp")
    wh = tempfile.mkdtemp(prefix="wh-", dir="/tmp")
    _drop(raw)
    return raw, wh


def _status(results):
    return {r.file_name: r.status for r in results.collect()}


def test_first_load_rerun_and_replace(spark, dirs):
    raw, wh_root = dirs
    wh = Warehouse(spark, wh_root)
    st = _status(ingest(spark, raw, wh))
    assert st["bank/bank_statement_2025-07-12.csv"] == "rejected"
    assert {v for k, v in st.items() if not k.startswith("bank/")} == {"loaded"}

    a = wh.raw_table("processor_a_balance_transactions")
    assert a.count() == 3
    r1 = a.filter(F.col("balance_transaction_id") == "txn_1").first()
    assert r1.description == "a, b" and r1._source_line == 2          # quoted comma kept, header = line 1
    assert a.filter(F.col("balance_transaction_id") == "txn_4").first().automatic_payout_id == ""  # verbatim ''
    exc = {(r.line_number, r.reason) for r in wh.exceptions().collect()}
    assert (3, "expected 14 fields, got 9") in exc
    assert any(reason.startswith("header mismatch; missing=['end_to_end_reference'] unexpected=['e2e_ref']")
               for _, reason in exc)
    man = {r.file_name: r for r in wh.latest_manifest().collect()}
    assert man["processor_a/balance_transactions_2025-07-10.csv"].row_count == 2
    assert man["processor_a/balance_transactions_2025-07-10.csv"].exception_count == 1
    assert str(man["processor_b/settlement_detail_report_batch_0001.csv"].file_date) == "2025-07-10"
    assert verify_load(wh).count() == 0

    # re-run: a no-op
    assert set(_status(ingest(spark, raw, wh)).values()) == {"skipped"}
    assert wh.raw_table("processor_a_balance_transactions").count() == 3

    # a changed file replaces only itself
    _write(raw, "processor_a/balance_transactions_2025-07-11.csv",
           A_HEADER + "\ntxn_4,2025-07-11 10:00:00,2025-07-13 00:00:00,usd,6.00,0.30,5.70,charge,ch_4,,6.00,usd,,4\n")
    st = _status(ingest(spark, raw, wh))
    assert st["processor_a/balance_transactions_2025-07-11.csv"] == "replaced"
    assert st["processor_a/balance_transactions_2025-07-10.csv"] == "skipped"
    a = wh.raw_table("processor_a_balance_transactions")
    assert a.count() == 3
    assert a.filter(F.col("balance_transaction_id") == "txn_4").first().gross == "6.00"
    assert verify_load(wh).count() == 0


def test_backfill_range_skips_undated_and_out_of_range(spark, dirs):
    raw, wh_root = dirs
    wh = Warehouse(spark, wh_root)
    st = _status(ingest(spark, raw, wh, start=dt.date(2025, 7, 10), end=dt.date(2025, 7, 10)))
    assert set(st) == {"processor_a/balance_transactions_2025-07-10.csv",
                       "processor_b/settlement_detail_report_batch_0001.csv",
                       "fx/reference_rates_2025-07-10.csv"}


def test_crashed_load_is_invisible_and_reported(spark, dirs):
    raw, wh_root = dirs
    wh = Warehouse(spark, wh_root)
    ingest(spark, raw, wh)
    ghost = wh.raw_table("processor_a_balance_transactions").limit(1).withColumn("_load_id", F.lit("crashed"))
    ghost.write.mode("append").partitionBy("_load_id").parquet(wh.path("processor_a_balance_transactions"))
    assert wh.raw_table("processor_a_balance_transactions").count() == 3
    problems = [r.problem for r in verify_load(wh).collect()]
    assert any("no manifest entry" in p for p in problems)


def test_non_utf8_file_is_rejected(spark):
    raw = tempfile.mkdtemp(prefix="raw-", dir="/tmp")
    path = os.path.join(raw, "fx", "reference_rates_2025-07-10.csv")
    os.makedirs(os.path.dirname(path))
    with open(path, "wb") as fh:
        fh.write(FX_HEADER.encode() + b"\n2025-07-10,USD,EUR,0.9\x80\n")
    wh = Warehouse(spark, tempfile.mkdtemp(prefix="wh-", dir="/tmp"))
    res = ingest(spark, raw, wh).collect()
    assert [(r.status) for r in res] == ["rejected"]
    assert [r.reason for r in wh.exceptions().collect()] == ["file is not valid UTF-8"]


def test_small_blocks_equal_whole_files(spark, dirs):
    raw, _ = dirs
    whole = Warehouse(spark, tempfile.mkdtemp(prefix="wh-", dir="/tmp"))
    split = Warehouse(spark, tempfile.mkdtemp(prefix="wh-", dir="/tmp"))
    st = _status(ingest(spark, raw, whole))
    names = {"spark.sql.files.maxPartitionBytes": "100", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        assert _status(ingest(spark, raw, split)) == st      # every file in blocks of 100 bytes
        assert set(_status(ingest(spark, raw, split)).values()) == {"skipped"}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    for t in ["processor_a_balance_transactions", "processor_b_settlement_details", "fx_reference_rates"]:
        cols = [c for c in whole.raw_table(t).columns if c not in ("_load_id", "_loaded_at")]
        assert sorted(split.raw_table(t).select(*cols).collect()) == sorted(whole.raw_table(t).select(*cols).collect())
    key = ["_source_file", "line_number", "reason", "raw_line"]
    assert sorted(split.exceptions().select(*key).collect()) == sorted(whole.exceptions().select(*key).collect())
    key = ["file_name", "checksum_sha256", "size_bytes", "row_count", "exception_count", "status", "file_date"]
    assert sorted(split.manifest().select(*key).collect()) == sorted(whole.manifest().select(*key).collect())


def test_out_of_order_header_is_rejected(spark):
    raw = tempfile.mkdtemp(prefix="raw-", dir="/tmp")
    cols = list(CONTRACTS["fx_reference_rates"].header)
    cols[0], cols[1] = cols[1], cols[0]
    _write(raw, "fx/reference_rates_2025-07-10.csv", ",".join(cols) + "\nUSD,2025-07-10,EUR,0.925000\n")
    wh = Warehouse(spark, tempfile.mkdtemp(prefix="wh-", dir="/tmp"))
    assert [r.status for r in ingest(spark, raw, wh).collect()] == ["rejected"]
    assert [r.reason for r in wh.exceptions().collect()] == ["header columns out of order"]
    assert wh.raw_table("fx_reference_rates").count() == 0
