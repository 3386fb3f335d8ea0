"""Custom DataFrame rewrites checked against brute force on small fixtures."""

import datetime as dt
import random

from tallybook.operators.accounting import month_ends, seller_balance_aging
from tallybook.operators.recon import batch_payout_carry


def test_aging_interval_explode_equals_asof_brute_force(spark):
    random.seed(3)
    rows = []
    for seller in range(12):
        for _ in range(random.randint(1, 25)):
            d = dt.date(2024, 1, 1) + dt.timedelta(days=random.randint(0, 500))
            rows.append(("2000", seller, d, random.randint(-9000, 9000)))
    ledger = spark.createDataFrame(rows, "account_code string, seller_id long, posting_date date, "
                                         "amount_usd_minor long")
    got = {(str(r.month_end), r.seller_id): (r.payable_balance_usd_minor, r.negative_since)
           for r in seller_balance_aging(ledger, month_ends(ledger)).collect()}

    # brute force: per month end, latest daily balance on or before it
    me_rows = [r.month_end for r in month_ends(ledger).collect()]
    by_seller = {}
    for _, s, d, a in rows:
        by_seller.setdefault(s, {}).setdefault(d, 0)
        by_seller[s][d] += -a
    expected = {}
    for s, days in by_seller.items():
        bal, prev, since, hist = 0, 0, None, []
        for d in sorted(days):
            bal += days[d]
            if bal < 0 and prev >= 0:
                since = d
            hist.append((d, bal, since if bal < 0 else None))
            prev = bal
        for me in me_rows:
            past = [h for h in hist if h[0] <= me]
            if past:
                expected[(str(me), s)] = (past[-1][1], past[-1][2])
    assert got == expected


def test_batch_carry_closed_form_equals_loop(spark):
    random.seed(11)
    rows = []
    for merchant in range(20):
        for batch in range(30):
            rows.append((merchant, batch, random.randint(-500, 800)))
    df = spark.createDataFrame(rows, "merchant long, batch long, net long")
    got = {(r.merchant, r.batch): (r.payout, r.carry) for r in batch_payout_carry(df).collect()}
    for merchant in range(20):
        carry = 0
        for batch in range(30):
            net = [n for m, b, n in rows if m == merchant and b == batch][0]
            total = carry + net
            payout = total if total > 0 else 0
            carry = total - payout
            assert got[(merchant, batch)] == (payout, carry)


def test_next_after_with_hot_key_equals_brute_force(spark):
    from tallybook.operators.asof import next_after
    random.seed(5)
    left, right = [], []
    for i in range(1500):
        k = 0 if random.random() < 0.4 else random.randint(1, 30)      # key 0 holds 40% of rows
        left.append((i, k, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=random.randint(0, 50000))))
    for _ in range(1000):
        k = 0 if random.random() < 0.4 else random.randint(1, 30)
        right.append((k, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=random.randint(0, 50000))))
    ld = spark.createDataFrame(left, "id long, k long, t timestamp")
    rd = spark.createDataFrame(right, "k long, p timestamp")
    got = {r.id: r.next_at for r in next_after(ld, rd, "k", "t", "p").collect()}
    for i, k, t in left:
        later = [p for kk, p in right if kk == k and p > t]
        assert got[i] == (min(later) if later else None)


def test_next_after_keeps_large_ids_apart_and_stays_lazy(spark):
    from tallybook.operators.asof import next_after
    big, t0 = 2**53, dt.datetime(2024, 1, 1)
    left = spark.createDataFrame([(1, big, t0), (2, big + 1, t0), (3, None, t0), (4, big, None), (5, big, t0 + dt.timedelta(days=9))] + [(6, 7, t0)] * 50, "id long, k long, t timestamp")
    right = spark.createDataFrame([(big + 1, t0 + dt.timedelta(hours=30)), (big, t0), (7, t0 + dt.timedelta(microseconds=1)), (7, t0), (None, t0)], "k long, p timestamp")
    spark.sparkContext.setJobGroup("asof-plan", "plan")
    out = next_after(left, right, "k", "t", "p")
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("asof-plan")) == []   # nothing ran yet
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    rows = out.collect()
    assert len(rows) == 55
    assert {r.id: r.next_at for r in rows} == {1: None, 2: t0 + dt.timedelta(hours=30), 3: None, 4: None, 5: None, 6: t0 + dt.timedelta(microseconds=1)}


def test_order_match_spreads_charges_without_an_order(spark):
    from tallybook.operators.recon import order_settlement_match
    orders = spark.createDataFrame([(1, "USD", 100, "processor_a", "c1", dt.datetime(2025, 1, 1)), (2, "USD", 5, "processor_a", "c2", dt.datetime(2025, 1, 1)), (3, "EUR", 7, "processor_b", "c3", None)],
                                   "order_id long, currency string, amount_minor long, processor string, processor_charge_ref string, created_at timestamp")
    charge = "settlement_event_id string, event_type string, order_id long, presentment_currency string, presentment_amount_minor long, processor string, processor_reference string, event_date date"
    day = dt.date(2025, 1, 2)
    events = [("e1", "charge", 1, "USD", 100, "processor_a", "c1", day), ("e2", "charge", 2, "USD", 6, "processor_a", "c2", day), ("e3", "charge", 9, "USD", 6, "processor_a", "c9", day), ("e4", "refund", 3, "EUR", 7, "processor_b", "c3", day)]
    events += [(f"n{i}", "charge", None, "USD", 1, "processor_a", None, day) for i in range(200)]
    out = order_settlement_match(orders, spark.createDataFrame(events, charge))
    got = {r.settlement_event_id or f"o{r.order_id}": (r.match_status, r.order_id) for r in out.collect()}
    assert len(got) == 204 and got["e1"] == ("matched", 1) and got["e2"] == ("amount_mismatch", 2) and got["e3"] == ("settlement_without_order", 9)
    assert got["o3"] == ("order_without_settlement", 3) and got["n5"] == ("settlement_without_order", None)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" not in plan and "isnotnull(order_id" in plan


def test_relationships_move_only_distinct_values(spark):
    from tallybook.operators.quality import relationships
    child = spark.createDataFrame([(i, "a" if i % 3 else "b") for i in range(300)] + [(900, "zz"), (901, "zz"), (902, None)], "id int, code string")
    parent = spark.createDataFrame([("a",), ("b",), ("a",)], "code string")
    assert sorted(r.id for r in relationships(child, "code", parent, "code").collect()) == [900, 901]
    assert relationships(child.where("id < 900"), "code", parent, "code").count() == 0
