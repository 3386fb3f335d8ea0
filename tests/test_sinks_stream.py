import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from tallybook.sources.ingest import Warehouse, WarehouseFeeds, ingest
from tallybook.sources.sinks import write_ledger
from tallybook.sources.lines import Files
from tallybook.streaming.file_stream import incremental_file_ingest, load_batch

from test_ingest import A_HEADER, _drop, _write

SCHEMA = "ledger_line_id string, posting_date date, account_code string, source_system string, amount_usd_minor long"


def _ledger(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_lookback_rebuild_replaces_touched_months_only(spark):
    path = tempfile.mkdtemp(prefix="ledger-", dir="/tmp") + "/ledger_table"
    v1 = [("a", dt.date(2025, 1, 5), "1000", "p", 10), ("b", dt.date(2025, 2, 5), "1000", "p", 20),
          ("c", dt.date(2025, 3, 20), "1000", "p", 30)]
    write_ledger(spark, _ledger(spark, v1), path)
    # Upstream changes in January (outside the lookback) and March (inside).
    v2 = [("a", dt.date(2025, 1, 5), "1000", "p", 11), ("b", dt.date(2025, 2, 5), "1000", "p", 20),
          ("c2", dt.date(2025, 3, 21), "1000", "p", 31)]
    info = write_ledger(spark, _ledger(spark, v2), path)
    assert str(info["cutoff"]) == "2025-03-01"
    got = {r.ledger_line_id: r.amount_usd_minor for r in spark.read.parquet(path).collect()}
    assert got == {"a": 10, "b": 20, "c2": 31}   # January keeps its old line until a full refresh

    # A touched month that became empty upstream is deleted, not left stale.
    info = write_ledger(spark, _ledger(spark, v2[:2]), path)
    assert [str(m) for m in info["months_emptied"]] == ["2025-03-01"]
    got = {r.ledger_line_id for r in spark.read.parquet(path).collect()}
    assert got == {"a", "b"}


def test_stream_ingest_equals_batch_and_is_incremental(spark):
    raw = tempfile.mkdtemp(prefix="raw-", dir="/tmp")
    _drop(raw)
    batch_wh = Warehouse(spark, tempfile.mkdtemp(prefix="wh-", dir="/tmp"))
    ingest(spark, raw, batch_wh)
    stream_wh = Warehouse(spark, tempfile.mkdtemp(prefix="wh-", dir="/tmp"))
    ckpt = tempfile.mkdtemp(prefix="ck-", dir="/tmp")
    incremental_file_ingest(spark, raw, stream_wh, checkpoint=ckpt).awaitTermination()
    t = "processor_a_balance_transactions"
    cols = ["balance_transaction_id", "gross", "_source_file", "_source_line"]
    assert sorted(stream_wh.raw_table(t).select(*cols).collect()) == sorted(batch_wh.raw_table(t).select(*cols).collect())

    _write(raw, "processor_a/balance_transactions_2025-07-12.csv",
           A_HEADER + "\ntxn_9,2025-07-12 10:00:00,2025-07-14 00:00:00,usd,1.00,0.00,1.00,charge,ch_9,,1.00,usd,,9\n")
    incremental_file_ingest(spark, raw, stream_wh, checkpoint=ckpt).awaitTermination()
    m = stream_wh.manifest().groupBy("file_name").count().collect()
    assert all(r["count"] == 1 for r in m)          # earlier files not re-loaded
    assert stream_wh.raw_table(t).count() == 4


def test_replaced_file_under_a_fresh_checkpoint_has_no_old_rows(spark):
    raw = tempfile.mkdtemp(prefix="raw-", dir="/tmp")
    wh = Warehouse(spark, tempfile.mkdtemp(prefix="wh-", dir="/tmp"))
    name, t = "processor_a/balance_transactions_2025-07-12.csv", "processor_a_balance_transactions"
    row = "txn_{0},2025-07-12 10:00:00,2025-07-14 00:00:00,usd,1.00,0.00,1.00,charge,ch_{0},,1.00,usd,,{0}\n"
    keys = []
    for ids in ((1,), (2, 3)):
        _write(raw, name, A_HEADER + "\n" + "".join(row.format(i) for i in ids))
        incremental_file_ingest(spark, raw, wh, checkpoint=tempfile.mkdtemp(prefix="ck-", dir="/tmp")).awaitTermination()
        keys.append(WarehouseFeeds(wh).cache_key)
        assert sorted(r[0] for r in wh.raw_table(t).select("balance_transaction_id").collect()) == [f"txn_{i}" for i in ids]
    assert keys[0] != keys[1]   # stored model tables of the first load are not read for the second


def test_publish_pipeline_ledger_twice_is_stable(spark, models_small):
    path = tempfile.mkdtemp(prefix="ledger-", dir="/tmp") + "/ledger_table"
    first = models_small.publish_ledger(path)
    assert first["cutoff"] is None
    n1 = spark.read.parquet(path).count()
    again = models_small.publish_ledger(path)          # incremental: only the lookback months
    assert again["cutoff"] is not None and again["months_emptied"] == []
    stored = spark.read.parquet(path)
    assert stored.count() == n1 == models_small.ledger_entries.count()
    assert stored.groupBy().sum("amount_usd_minor").first()[0] == 0


def test_replayed_batch_adds_nothing_and_large_files_are_split(spark):
    raw = tempfile.mkdtemp(prefix="raw-", dir="/tmp")
    wh = Warehouse(spark, tempfile.mkdtemp(prefix="wh-", dir="/tmp"))
    name, t = "processor_a/balance_transactions_2025-07-12.csv", "processor_a_balance_transactions"
    row = "txn_{0},2025-07-12 10:00:00,2025-07-14 00:00:00,usd,1.00,0.00,1.00,charge,ch_{0},,1.00,usd,,{0}\n"
    _write(raw, name, A_HEADER + "\n" + "".join(row.format(i) for i in range(400)))
    names = spark.createDataFrame([(f"file:{raw}/{name}",)], "path string")
    wide = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        assert load_batch(spark, raw, wh, names, "s1", 0)
        assert Files.read(spark, raw, [f"{raw}/{name}"]).lines.rdd.getNumPartitions() > 5
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", wide)
    files = sorted(os.listdir(f"{wh.path(t)}"))
    assert not load_batch(spark, raw, wh, names, "s1", 0)      # the same batch again
    assert sorted(os.listdir(f"{wh.path(t)}")) == files and wh.manifest().count() == 1
    assert load_batch(spark, raw, wh, names, "s2", 0)          # another stream: its files are known already
    assert wh.manifest().count() == 1 and wh.raw_table(t).count() == 400
