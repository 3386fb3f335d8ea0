"""Queries may be run from several threads: each feed/table is landed once."""

from concurrent.futures import ThreadPoolExecutor

from tallybook.registry import all_queries
from tallybook.sources import driver

from conftest import SF_SMALL


def test_parallel_queries_on_a_cold_dataset(spark):
    cold = SF_SMALL + "/"                       # same data, fresh cache key
    q = all_queries()
    keys = ["trial_balance", "payout_reconciliation", "order_economics", "dq_balance_sheet"]
    with ThreadPoolExecutor(max_workers=4) as pool:
        counts = list(pool.map(lambda k: q[k](spark, cold).count(), keys))
    assert counts == [q[k](spark, SF_SMALL).count() for k in keys]
    landed = [k for k in driver._LANDED if k[1] == cold]
    assert len(landed) == len(set(landed)) and len(landed) > 0
