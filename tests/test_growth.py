"""What must not grow faster than the input: rows moved twice, lines stored with their ids, tasks of a fixed number."""

import contextlib
import glob
import io
import time
from collections import Counter
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from tallybook import session
from tallybook.operators import journal, metrics, staging
from tallybook.operators.checks import CHECKS, Check, failures
from tallybook.operators.quality import relationships
from tallybook.plans.models import TABLE_MODELS, Models
from tallybook.session import fit_partitions
from tallybook.sources.contracts import Policy
from tallybook.sources.driver import DriverFeeds
from tallybook.sources.lines import Files

SMALL = "/root/testdata/sf0.001"


def plan(df, mode="formatted"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def test_journal_is_stored_one_row_an_entry(models_small):
    assert "ledger_entries" not in TABLE_MODELS
    stored = models_small.settlement_postings
    assert not [c for c in stored.columns if c.endswith("_id") and c not in ("order_id", "seller_id")]
    assert stored.count() == models_small.settlement_events.count()
    assert "settlement_postings" in models_small.journal_settlements.inputFiles()[0]


def test_lines_of_stored_postings_are_those_of_the_journal(spark):
    rows = [("processor_a", "t1", [("1000", 5), ("2000", -5), ("5200", 0)]), ("processor_b", "t2", [("1010", None)])]
    postings = spark.createDataFrame(rows, "source_system string, source_reference string, lines array<struct<account_code string, amount_usd_minor bigint>>")
    for c in ("posting_date", "occurred_at", "source_event_type", "processor_reference", "order_id", "seller_id", "original_currency", "original_amount_minor"):
        postings = postings.withColumn(c, F.lit(None).cast("string"))
    got = journal.settlement_lines(postings)
    md5 = lambda text: F.md5(F.lit(text).cast("binary"))
    want = spark.range(1).select(F.inline(F.array(*[F.struct(md5(e).alias("e"), md5(f"{e}|{a}").alias("l"), F.lit(a).alias("a")) for e, a in
                                                   (("processor_a|t1", "1000"), ("processor_a|t1", "2000"), ("processor_b|t2", "1010"))])))
    assert sorted(map(tuple, got.select("journal_entry_id", "ledger_line_id", "account_code").collect())) == sorted(map(tuple, want.collect()))


def test_cash_line_ids_follow_from_their_posting(spark):
    rows = [("bank", "processor_payout_receipt", "b1"), ("app_db", "seller_payout", "7"), ("bank", "processor_payout_receipt", None)]
    postings = spark.createDataFrame(rows, "source_system string, source_event_type string, source_reference string")
    for c in ("posting_date", "occurred_at", "processor_reference", "order_id", "seller_id", "original_currency", "original_amount_minor"):
        postings = postings.withColumn(c, F.lit(None).cast("string"))
    postings = postings.withColumn("lines", F.array(F.struct(F.lit("1100").alias("account_code"), F.lit(0).cast("bigint").alias("amount_usd_minor"))))
    got = journal.cash_lines(postings)
    md5 = {t: spark.range(1).select(F.md5(F.lit(t).cast("binary"))).first()[0] for t in ("bank|b1", "app_db|seller_payout|7")}
    assert {r.journal_entry_id for r in got.collect()} == {*md5.values(), None}


def test_line_items_meet_their_orders_once(spark):
    text = plan(DriverFeeds(spark, SMALL, land=False)._build_base_events())
    assert text.count("lineitem.parquet") == 2   # their events, and which orders have any


def test_line_events_are_all_kinds_of_a_line(spark, tmp_path):
    o = spark.createDataFrame([(22, 1, 100.0)], "o_orderkey long, o_custkey long, o_totalprice double")
    o.withColumn("o_orderdate", F.lit("1996-01-01").cast("timestamp")).write.parquet(f"{tmp_path}/orders.parquet")
    lines = [(22, 1, "R", "F"), (22, 7, "A", "F"), (22, 7, "N", "O"), (22, 7, "R", "F"), (22, 2, "A", "F"), (22, 1, None, "F")]
    li = spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_returnflag string, l_linestatus string")
    li.select("*", F.lit(3).cast("long").alias("l_partkey"), F.lit(4).cast("long").alias("l_suppkey"), F.lit(12.0).alias("l_extendedprice"), F.lit("1996-02-01").cast("timestamp").alias("l_shipdate")) \
        .write.parquet(f"{tmp_path}/lineitem.parquet")
    got = Counter((r.kind, r.pamt, r.src_line) for r in DriverFeeds(spark, str(tmp_path), land=False)._build_base_events().collect() if r.kind != "charge")
    assert got == Counter({("refund", -300, 222): 2, ("dispute", -400, 223): 1, ("dispute_reversal", 400, 224): 2})


def test_shuffles_begin_with_partitions_in_proportion_to_the_input(spark, tmp_path, monkeypatch):
    spark.range(100_000).write.parquet(f"{tmp_path}/t.parquet")
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(key, None)
    monkeypatch.setattr(session, "PARTITIONS_PER_GB", 10**6)
    fit_partitions(spark, [f"{tmp_path}/t.parquet", f"{tmp_path}/none.parquet"])
    assert int(spark.conf.get(key)) > 100
    monkeypatch.setattr(session, "PARTITIONS_PER_GB", 1)
    fit_partitions(spark, [f"{tmp_path}/t.parquet"])
    assert spark.conf.get(key, None) == before


def test_sums_of_orders_move_once_beside_the_dispute_count(spark):
    rows = [(1, "1000", "dispute", 5, "a"), (1, "2000", "dispute", -5, "a"), (1, "2000", "dispute", 3, "b"), (1, "4000", "charge", -9, "c"), (2, "2000", "refund", 4, "d"), (None, "2000", "dispute", 4, "e")]
    got = metrics.order_ledger_rollup(spark.createDataFrame(rows, "order_id long, account_code string, source_event_type string, amount_usd_minor long, journal_entry_id string"))
    assert {r.order_id: (r.dispute_count, r.dispute_loss_to_seller_usd_minor, r.refunded_usd_minor, r.platform_fee_revenue_usd_minor) for r in got.collect()} == {1: (2, -2, 0, 9), 2: (0, 0, 4, 0)}
    aggregates = [line for line in plan(got).splitlines() if line.startswith("Functions")]
    assert not [a for a in aggregates if "distinct" in a and "sum(" in a]


def test_rows_are_parsed_before_they_are_filtered(spark):
    raw = DriverFeeds(spark, SMALL).raw_processor_a_landed
    text = plan(staging.stg_processor_a_txns(staging.base_processor_a(raw)), "extended").split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert text.count("gettimestamp(created_utc") == 1


def test_lines_meet_their_blocks_without_a_shuffle(spark, tmp_path):
    (tmp_path / "fx").mkdir()
    (tmp_path / "fx" / "reference_rates_2024-01-01.csv").write_text("rate_date,base_currency,quote_currency,rate\n2024-01-01,USD,eur,0.9\n")
    files = Files.read(spark, str(tmp_path))
    text = plan(files.records(files.table()), "simple")
    assert files.few and "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_child_rows_are_filtered_before_they_move_to_the_orphans(spark):
    child = spark.createDataFrame([(i, None if i % 7 == 0 else f"v{i % 50}") for i in range(2000)], "id int, code string")
    parent = spark.createDataFrame([(f"v{i}",) for i in range(40)] + [(None,)], "code string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = relationships(child, "code", parent, "code")
        lines = got._jdf.queryExecution().executedPlan().toString().splitlines()
        assert sorted(r.id for r in got.collect()) == [i for i in range(2000) if i % 7 and i % 50 >= 40]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    moved = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning(code" in line)
    scan = next(i for i, line in enumerate(lines) if "Scan ExistingRDD[id" in line)
    assert any("BroadcastHashJoin" in line and "LeftSemi" in line for line in lines[moved:scan])


def shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for f in glob.glob(f"{d}/*/shuffle_*.data")}


def left_after(spark, before):
    """The shuffle files made since, once Spark's cleaner has had its time."""
    end = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < end:
        time.sleep(0.2)
    return left


def test_a_landed_table_is_small_and_leaves_no_shuffle_files(spark):
    feeds = DriverFeeds(spark, SMALL)
    before = shuffle_files(spark)
    landed = feeds._landed(f"moved_{time.time_ns()}", lambda: spark.range(100_000).repartition(7, "id"))
    assert left_after(spark, before) == set()
    assert landed.count() == 100_000 and landed.inputFiles()[0].endswith(".zstd.parquet")


def test_a_stored_model_is_small_and_leaves_no_shuffle_files(spark):
    models = Models(spark, SMALL, policy=Policy(recon_tolerance_minor=time.time_ns()))   # tables of its own
    before = shuffle_files(spark)
    stored = models._m("cash_postings", lambda: spark.range(100_000).repartition(7, "id"))
    assert left_after(spark, before) == set()
    assert stored.count() == 100_000 and stored.inputFiles()[0].endswith(".zstd.parquet")


def test_storing_at_once_leaves_the_callers_setting(spark, tmp_path):
    before = spark.conf.get(session._CLEAN, "false")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: session.store(spark.range(1000 * i).repartition(3, "id"), f"{tmp_path}/{i}"), range(1, 9)))
    assert spark.conf.get(session._CLEAN) == before and not session._STORING
    assert [spark.read.parquet(f"{tmp_path}/{i}").count() for i in range(1, 9)] == [1000 * i for i in range(1, 9)]


def test_checks_run_one_model_after_the_other(spark, models_small):
    checks = tuple(c for c in CHECKS if c.model in ("stg_orders", "seller_months", "journal_cash", "general_ledger"))
    lazy = failures({m: getattr(models_small, m) for m in ("stg_orders", "seller_months", "journal_cash", "general_ledger", "chart_of_accounts")}, checks)
    before = shuffle_files(spark)
    got = failures(models_small, checks)
    assert left_after(spark, before) == set()
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert len(checks) == 11 and sorted(got.collect()) == sorted(lazy.collect())
    whole = Models(spark, SMALL, tables=False)
    assert "Exchange" in failures(whole, (Check("stg_orders", "unique", ("order_id",)),))._jdf.queryExecution().executedPlan().toString()


def test_ids_move_as_bytes_and_stay_apart(spark):
    texts = ["ab", "AB", "aB", "abc", "0abc", "", "\0", "\x01", "00", "01", "0001", "zz", "ab\n", " ab", "\u00ab", None, "d41d8cd98f00b204e9800998ecf8427e"]
    rows = [(k, i % 3 - 1) for i, k in enumerate(texts + texts[::2] + texts[::3])]
    df = spark.createDataFrame(rows, "k string, v long")
    got = failures({"t": df}, (Check("t", "unique", ("k",)), Check("t", "sums_to_zero", ("k", "v"))))
    counts, sums = Counter(k for k, _ in rows), Counter()
    for k, v in rows:
        sums[k] += v
    assert {r.kind: r.failures for r in got.collect()} == {"unique": sum(n > 1 for k, n in counts.items() if k is not None), "sums_to_zero": sum(s != 0 for s in sums.values())}
    assert "unhex" in plan(got)
