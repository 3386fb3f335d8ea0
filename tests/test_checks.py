"""Every column test and book invariant fails on a row that breaks it, and only then."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallybook.operators import quality as dq
from tallybook.operators.checks import CHECKS, RAW_CHECKS, Check, failures

NUMBERS = {c.columns[-1] for c in CHECKS if c.kind in ("within_tolerance", "sums_to_zero")}


def sound(checks):
    """By model, rows that pass all its checks."""
    out = {}
    for c in checks:
        cols = out.setdefault(c.model, {})
        for x in c.columns:
            cols.setdefault(x, None)
        if c.kind == "accepted_values":
            cols[c.columns[0]] = c.arg[0]
        if c.kind == "relationships":
            cols[c.columns[0]] = "1000"
    rows = {}
    for model, cols in out.items():
        empty = any(c.kind == "is_empty" for c in checks if c.model == model)
        rows[model] = [] if empty else [{x: 0 if x in NUMBERS else v or f"{x}{i}" for x, v in cols.items()} for i in range(3)]
    return rows


def broken(c, rows):
    """The rows of its model with one fault."""
    rows = [dict(r) for r in rows]
    if c.kind == "is_empty":
        return [{x: "a" for x in cols_of(c.model)}]
    if c.kind == "unique":
        return rows + [dict(rows[0])]
    value = {"not_null": None, "accepted_values": "bogus", "relationships": "9999", "within_tolerance": -10_000, "sums_to_zero": 5}[c.kind]
    model = rows[0] if rows else {x: None for x in cols_of(c.model)}
    rows.append({**{x: 0 if x in NUMBERS else f"{x}z" for x in model}, **{x: v for x, v in model.items() if v in ("1000",) or any(k.kind == "accepted_values" and k.columns == (x,) for k in CHECKS)}, c.columns[-1]: value})
    return rows


def cols_of(model):
    return list(dict.fromkeys(x for c in CHECKS if c.model == model for x in c.columns)) or ["x"]


def frames(spark, rows):
    out = {}
    for model, own in rows.items():
        cols = cols_of(model)
        schema = ", ".join(f"{x} {'long' if x in NUMBERS else 'string'}" for x in cols)
        out[model] = spark.createDataFrame([tuple(r.get(x) for x in cols) for r in own], schema)
    out["chart_of_accounts"] = spark.createDataFrame([("1000",), ("2000",)], "account_code string")
    return out


def test_sound_rows_pass_every_check(spark):
    got = failures(frames(spark, sound(CHECKS)), CHECKS).collect()
    assert len(got) == len(CHECKS) == len({r.check_name for r in got}) and {r.failures for r in got} == {0}


@pytest.mark.parametrize("kind", ["unique", "not_null", "accepted_values", "relationships", "within_tolerance", "is_empty", "sums_to_zero"])
def test_each_check_counts_its_fault(spark, kind):
    rows = sound(CHECKS)
    now = [c for c in CHECKS if c.kind == kind]
    bad = {m: list(r) for m, r in rows.items()}
    for c in now:   # each fault is a row of its own
        bad[c.model] += broken(c, rows[c.model])[len(rows[c.model]):]
    models = {c.model for c in now}
    got = {r.check_name: r.failures for r in failures(frames(spark, bad), tuple(c for c in CHECKS if c.model in models)).collect()}
    for c in now:
        assert got[c.name] == 1, c.name
    others = {n: f for n, f in got.items() if n not in {c.name for c in now} and not n.startswith(("is_empty", "unique"))}
    assert all(f == 0 for f in others.values()), others


def test_null_keys_are_no_duplicates_and_two_unique_checks_work(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("a", 3), ("a", 4)], "k string, n int")
    got = {r.check_name: r.failures for r in failures({"t": df}, (Check("t", "unique", ("k",)), Check("t", "unique", ("k", "n")), Check("t", "not_null", ("k",)))).collect()}
    assert got == {"unique_t_k": 1, "unique_t_k_n": 1, "not_null_t_k": 2}


def test_one_scan_per_model(spark, models_small):
    checks = tuple(c for c in CHECKS if c.model == "ledger_entries" and c.kind != "relationships")
    plan = failures(models_small, checks)._jdf.queryExecution().executedPlan().toString()
    assert len(checks) == 5 and plan.count("FileScan parquet") == 1


def test_registered_raw_checks_do_fail(models_small):
    got = failures(models_small, RAW_CHECKS).collect()
    assert sum(r.failures > 0 for r in got) >= 10


# -- invariants of the books: each sees a broken row ---------------------------------
def test_balance_sheet_sees_a_month_off_by_one(models_small):
    good = models_small.close_package
    assert dq.balance_sheet_imbalance(good).count() == 0
    first = good.agg(F.min("month_end")).first()[0]
    bad = good.withColumn("amount_usd_minor", F.col("amount_usd_minor") + F.when((F.col("month_end") == first) & (F.col("line_item") == "retained_earnings"), 1).otherwise(0))
    assert [(r.month_end, r.imbalance_usd_minor) for r in dq.balance_sheet_imbalance(bad).collect()] == [(first, -1)]


def test_event_posted_once_sees_missing_and_double_entries(spark):
    events = spark.createDataFrame([("p", "processor_a", x) for x in "abc"], "i string, processor string, settlement_event_id string")
    lines = spark.createDataFrame([("processor_a", "a", "j1"), ("processor_a", "a", "j1"), ("processor_a", "b", "j2"), ("processor_a", "b", "j3"), ("bank", "c", "j4")], "source_system string, source_reference string, journal_entry_id string")
    assert sorted((r.settlement_event_id, r.entries) for r in dq.event_posted_once(events, lines).collect()) == [("b", 2), ("c", 0)]


def test_landed_once_sees_lost_and_double_rows(spark):
    raw = spark.createDataFrame([("t1",), ("t1",), ("t2",), ("t3",), ("",)], "balance_transaction_id string")
    staged = spark.createDataFrame([("t1",), ("t2",)], "balance_transaction_id string")
    exc = spark.createDataFrame([("processor_a_balance_transactions", "t2"), ("loader", "t3")], "source_table string, record_key string")
    assert sorted((r.record_key, r.times_landed) for r in dq.a_landed_once(raw, staged, exc).collect()) == [("t2", 2), ("t3", 0)]


def test_churn_flows_see_each_identity_broken(spark):
    cols = ["active_sellers", "new_sellers", "first_seen_sellers", "retained_sellers", "reactivated_sellers", "sellers_at_start", "retained_from_start", "paused_sellers", "churned_sellers", "undetermined_sellers"]
    good = dict(zip(cols, (10, 1, 2, 4, 3, 9, 4, 2, 3, 0)))
    rows = [good, {**good, "new_sellers": 2}, {**good, "paused_sellers": 1}, {**good, "retained_sellers": 5, "reactivated_sellers": 2}]
    df = spark.createDataFrame([(i, *[r[c] for c in cols], 0.3) for i, r in enumerate(rows)] + [(9, *good.values(), 1.5)], "i int, " + ", ".join(f"{c} int" for c in cols) + ", seller_churn_rate double")
    assert sorted(r.i for r in dq.churn_flows_unbalanced(df).collect()) == [1, 2, 3, 9]


def test_tolerance_and_sums_see_their_faults(spark):
    daily = spark.createDataFrame([(1, 100), (2, -100), (3, 101), (4, -101), (5, None)], "i int, ledger_vs_processor_minor long")
    assert sorted(r.i for r in dq.recon_outside_tolerance(daily).collect()) == [3, 4]
    lines = spark.createDataFrame([("a", 5), ("a", -5), ("b", 5), ("b", -4), ("c", 1), ("c", None)], "e string, v long")
    assert sorted(r.group_key for r in dq.sums_to_zero(lines, "v", "e").collect()) == ["b", "c"]


def test_generic_checks_see_their_faults(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, i int")
    assert [r.n_records for r in dq.unique(df, "k").collect()] == [2]
    assert [r.i for r in dq.not_null(df, "k").collect()] == [4]
    assert sorted(r.i for r in dq.accepted_values(df, "k", ["a"]).collect()) == [3, 4]
    assert dq.metrics_tie_to_ledger(
        spark.createDataFrame([("4000", -100, 1), ("5000", 7, 1), ("5000", 9, None)], "account_code string, amount_usd_minor long, order_id long"), spark.createDataFrame([(1,)], "order_id long"),
        spark.createDataFrame([(dt.date(2025, 1, 1), 100, 8)], "order_month date, net_revenue_usd_minor long, processing_cost_usd_minor long")).collect()[0].metric == "processing_cost"
