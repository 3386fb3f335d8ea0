"""Headline timings: build the warehouse from the driver tables and run the
headline queries.  Prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallybook.session import get_spark  # noqa: E402
from tallybook.registry import all_queries  # noqa: E402

HEADLINE = [
    # land raw feeds + staging + ledger (first query pays for the tables it needs)
    "ledger_entries", "trial_balance", "close_package", "seller_balance_aging",
    "order_economics", "metrics_monthly", "seller_churn_monthly", "seller_ltv_cohorts",
    "payout_reconciliation", "daily_reconciliation", "order_settlement_match",
    "stg_exceptions", "dash_income_statement", "dq_sums_to_zero_entry", "dq_balance_sheet",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    qs = all_queries()
    timings: dict[str, float] = {}
    t_all = time.time()
    # Land the raw feeds and build the warehouse tables (the "load + build" step).
    from tallybook.plans.models import Models
    t = time.time()
    waves = Models(spark, sf_dir).build(threads=int(os.environ.get("BENCH_BUILD_THREADS", "8")))
    timings["warehouse_build"] = round(time.time() - t, 3)
    timings.update({f"build_{k}": v for k, v in waves.items()})
    for k in HEADLINE:
        if k not in qs:
            continue
        t = time.time()
        qs[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[k] = round(time.time() - t, 3)
    total = round(time.time() - t_all, 3)   # wall time of build + headline queries
    sf_text = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    try:
        sf = float(sf_text)
    except ValueError:
        sf = sf_text
    print(json.dumps({"metric": "warehouse_build_and_headline_queries", "value": total,
                      "unit": "sec", "queries": timings, "sf": sf}))


if __name__ == "__main__":
    main()
