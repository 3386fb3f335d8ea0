"""Lines, records and fingerprints of CSV files against Python's csv, at several block sizes."""

import contextlib
import csv
import io
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from tallybook.sources.ingest import Warehouse, ingest, list_files, verify_load
from tallybook.sources.lines import FIELD_LIMIT, Files, bare_return, chomp, fields, quoting

from test_ingest import A_HEADER, BANK_HEADER, FX_HEADER, _write

PIECES = ["a", "b,", ",", '"', '""', "\n", "\r\n", '"x', 'y"', '"p,q"', '"l\nm"', "é", "\n\n", ' "', "long word ", '","', '"\r\n"']


@contextlib.contextmanager
def blocks(spark, size):
    names = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def by_csv(text):
    """(line number, fields) of every record."""
    reader = csv.reader(io.StringIO(text, newline="\n"))
    return [(reader.line_num, row) for row in reader]


def texts():
    r = random.Random(8)
    out = ['h1,h2\n1,"two\nlines"\n3,4\n', 'a"b,c"d\n"e"f,"g""h"\n', "x,y\r\n1,2\r\n", 'a\n"never closed\nto the end\n', 'a\n"never closed', "\n\na\n", "one", 'q,"r\r\ns"\r\nt,u\r\n', '"a","b\n\n\nc"\n', "é,ü\n" * 40]
    while len(out) < 70:
        t = "".join(r.choice(PIECES) for _ in range(r.randrange(1, 120)))
        try:
            by_csv(t)
        except csv.Error:
            continue  # a bare carriage return
        if t:
            out.append(t)
    return out


def test_records_equal_python_csv_at_every_block_size(spark):
    root, cases = tempfile.mkdtemp(prefix="raw-", dir="/tmp"), texts()
    for i, t in enumerate(cases):
        _write(root, f"processor_a/payouts_{i}.csv", "")
        with open(f"{root}/processor_a/payouts_{i}.csv", "wb") as fh:
            fh.write(t.encode())
    prints = []
    for size in (40, 1 << 28):
        with blocks(spark, size):
            files = Files.read(spark, root)
            table = files.table().checkpoint()
            prints.append(sorted((r.file_name, r.fingerprint, r.lines, r.valid) for r in table.collect()))
            members = files.members(table)
            assert members is not None
            rows = files.records(table, members).select("file_name", "last", fields(F.col("record")).alias("f"), "first").collect()
            if size == 40:
                assert files.blocks.count() > 2 * len(cases)
        got = {}
        for r in sorted(rows, key=lambda r: r.first):
            got.setdefault(r.file_name, []).append((r.last + 1, r.f))
        for i, t in enumerate(cases):
            assert got.get(f"processor_a/payouts_{i}.csv", []) == by_csv(t), repr(t)
    assert prints[0] == prints[1] and len({p[1] for p in prints[0]}) == len(set(cases))


@pytest.mark.parametrize("line,opens,stays", [("a,b", False, True), ('"a', True, False), ('a"', False, False), ('"a""', True, False), ('x,"', True, False), ('","', False, True), ('"a"b"', False, False), ('""', False, True), (' "a', False, False)])
def test_quote_states(spark, line, opens, stays):
    df = spark.createDataFrame([(line,)], "line string")
    assert tuple(df.select(*quoting(F.col("line"))).first()) == (opens, stays)


def test_line_ends_and_bare_returns(spark):
    df = spark.createDataFrame([("a\r",), ("a\r\r",), ("a\rb",), ('"a\rb",c',), ('"a"\r,c',)], "r string")
    assert [tuple(r) for r in df.select(chomp(F.col("r")), bare_return(chomp(F.col("r")))).collect()] == [("a", False), ("a", False), ("a\rb", True), ('"a\rb",c', False), ('"a"\r,c', True)]


def test_fingerprint_follows_the_bytes(spark):
    root = tempfile.mkdtemp(prefix="raw-", dir="/tmp")
    body = {"a": "x,1\ny,2\n", "b": "y,2\nx,1\n", "c": "x,1\ny,2", "d": "x,1\r\ny,2\n", "e": "﻿x,1\ny,2\n", "f": "x,1\ny,2\n", "g": "x,1\ny,3\n"}
    for k, v in body.items():
        _write(root, f"processor_a/payouts_{k}.csv", "")
        with open(f"{root}/processor_a/payouts_{k}.csv", "wb") as fh:
            fh.write(v.encode())
    got = {r.file_name[-5]: r for r in list_files(spark, root).collect()}
    assert got["a"].fingerprint == got["f"].fingerprint and len({r.fingerprint for r in got.values()}) == 6
    assert [k for k, r in got.items() if r.bom] == ["e"]


def test_quoted_newlines_load_as_one_row(spark):
    raw, rows = tempfile.mkdtemp(prefix="raw-", dir="/tmp"), []
    bank = "BT{0},NL,2025-07-12,2025-07-12,9.50,eur,X,P{0},{1}"
    for i in range(60):
        rows.append(bank.format(i, '"two\nlines, really"' if i % 7 == 3 else "plain"))
    rows.insert(30, '"short\nrecord",x')
    rows.insert(40, "BT99,NL,2025-07-12,2025-07-12,9.50,eur,X,P99,a\rb")
    _write(raw, "bank/bank_statement_2025-07-12.csv", "")
    with open(f"{raw}/bank/bank_statement_2025-07-12.csv", "wb") as fh:
        fh.write(("\n".join([BANK_HEADER, *rows]) + "\n").encode())
    want = [(n, f) for n, f in by_csv("\n".join([BANK_HEADER, *rows[:40]]) + "\n")][1:]
    with blocks(spark, 150):
        wh = Warehouse(spark, tempfile.mkdtemp(prefix="wh-", dir="/tmp"))
        res = ingest(spark, raw, wh).collect()
    assert [(r.status, r.rows, r.exceptions) for r in res] == [("loaded", 60, 2)]
    t = wh.raw_table("bank_statements")
    got = sorted((r._source_line, list(r)[: len(BANK_HEADER.split(","))]) for r in t.collect())
    assert [g for g in got if g[0] <= want[-1][0]] == [w for w in want if len(w[1]) == 9]
    exc = sorted((r.line_number, r.reason, r.raw_line) for r in wh.exceptions().collect())
    assert exc[0][1:] == ("expected 9 fields, got 2", 'record",x') and exc[1][1] == "carriage return outside quotes"
    assert verify_load(wh).count() == 0


def test_restated_file_of_equal_size_and_time_is_read_again(spark):
    raw, name = tempfile.mkdtemp(prefix="raw-", dir="/tmp"), "fx/reference_rates_2025-07-10.csv"
    wh = Warehouse(spark, tempfile.mkdtemp(prefix="wh-", dir="/tmp"))
    for rate, status in (("0.925000", "loaded"), ("0.925001", "replaced"), ("0.925001", "skipped")):
        _write(raw, name, FX_HEADER + f"\n2025-07-10,USD,EUR,{rate}\n")
        os.utime(f"{raw}/{name}", (1_700_000_000, 1_700_000_000))
        assert [r.status for r in ingest(spark, raw, wh).collect()] == [status]
        assert [r.rate for r in wh.raw_table("fx_reference_rates").collect()] == [rate]
    # only a caller who trusts metadata leaves such a file unread
    _write(raw, name, FX_HEADER + "\n2025-07-10,USD,EUR,0.925002\n")
    os.utime(f"{raw}/{name}", (1_700_000_000, 1_700_000_000))
    _write(raw, "fx/reference_rates_2025-07-11.csv", FX_HEADER + "\n2025-07-11,USD,EUR,0.93\n")
    assert sorted(r.status for r in ingest(spark, raw, wh, trust_metadata=True).collect()) == ["loaded", "skipped"]
    assert sorted(r.rate for r in wh.raw_table("fx_reference_rates").collect()) == ["0.925001", "0.93"]


def test_odd_files(spark):
    raw = tempfile.mkdtemp(prefix="raw-", dir="/tmp")
    fx = "fx/reference_rates_2025-07-1{}.csv"
    _write(raw, fx.format(0), FX_HEADER + "\n2025-07-10,USD,EUR,0.9�\n")  # a replacement character is valid UTF-8
    _write(raw, fx.format(1), "﻿" + FX_HEADER + "\n2025-07-11,USD,EUR,0.9\n")  # a byte order mark is part of the header
    _write(raw, fx.format(2), FX_HEADER + '\n2025-07-12,USD,EUR,"' + "x" * (4 * FIELD_LIMIT + 20) + "\n")
    _write(raw, fx.format(3), FX_HEADER)
    _write(raw, fx.format(4), ",".join(f'"{c}"' for c in FX_HEADER.split(",")) + "\n2025-07-14,USD,EUR,1\n")
    wh = Warehouse(spark, tempfile.mkdtemp(prefix="wh-", dir="/tmp"))
    res = {r.file_name[-5]: (r.status, r.rows) for r in ingest(spark, raw, wh).collect()}
    assert res == {"0": ("loaded", 1), "1": ("rejected", 0), "2": ("rejected", 0), "3": ("loaded", 0), "4": ("loaded", 1)}
    why = {r._source_file[-5]: r.reason for r in wh.exceptions().collect()}
    first = FX_HEADER.split(",")[0]
    assert why["1"] == f"header mismatch; missing=['{first}'] unexpected=['﻿{first}']" and why["2"].startswith("field larger")


def test_backfill_lists_unchanged_files_of_the_range(spark):
    raw = tempfile.mkdtemp(prefix="raw-", dir="/tmp")
    for d in ("10", "11"):
        _write(raw, f"fx/reference_rates_2025-07-{d}.csv", FX_HEADER + f"\n2025-07-{d},USD,EUR,0.9\n")
    wh = Warehouse(spark, tempfile.mkdtemp(prefix="wh-", dir="/tmp"))
    ingest(spark, raw, wh, start="2025-07-11")
    assert [r.status for r in ingest(spark, raw, wh, start="2025-07-11", end="2025-07-12").collect()] == ["skipped"]
    assert sorted(r.status for r in ingest(spark, raw, wh).collect()) == ["loaded", "skipped"]


def test_compaction_leaves_one_copy_and_survives_a_crash(spark):
    raw, name = tempfile.mkdtemp(prefix="raw-", dir="/tmp"), "processor_a/balance_transactions_2025-07-12.csv"
    wh, t = Warehouse(spark, tempfile.mkdtemp(prefix="wh-", dir="/tmp")), "processor_a_balance_transactions"
    row = "txn_{0},2025-07-12 10:00:00,2025-07-14 00:00:00,usd,{1}.00,0.00,1.00,charge,ch_{0},,1.00,usd,,{0}\n"
    for n in range(4):
        _write(raw, name, A_HEADER + "\n" + row.format(1, n) + row.format(2, n) + "short\n")
        ingest(spark, raw, wh)
    seen = lambda: sorted((r.balance_transaction_id, r.gross) for r in wh.raw_table(t).collect())
    want = [("txn_1", "3.00"), ("txn_2", "3.00")]
    assert seen() == want and wh.stored().count() == 12
    # a compaction that dies before its last step changes nothing
    wh.stored().write.partitionBy("kind", "source").parquet(f"{wh.root}/raw/packed/version=1")
    assert seen() == want and wh.version() == 0
    assert wh.compact() == 2 and wh.version() == 2
    assert seen() == want and wh.stored().count() == 3 and wh.exceptions().count() == 1
    assert len(wh.vacuum()) == 1 + 2 * 4  # the dead version; rows and exceptions of four loads
    assert seen() == want and spark.read.parquet(f"{wh.root}/raw/packed/version=2").count() == 3
    # later loads append beside the version, and are folded by the next
    _write(raw, name, A_HEADER + "\n" + row.format(5, 9))
    assert [r.status for r in ingest(spark, raw, wh).collect()] == ["replaced"]
    assert seen() == [("txn_5", "9.00")] and wh.exceptions().count() == 0 and verify_load(wh).count() == 0
    assert wh.compact() == 3 and wh.stored().count() == 1 and len(wh.vacuum()) == 2 and seen() == [("txn_5", "9.00")]
