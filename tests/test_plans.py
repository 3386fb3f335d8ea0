"""Plan guards: no registered query may plan a Cartesian product or a
row-at-a-time Python UDF; stored tables are read with pruned columns."""

import __spark_entry__ as se
from conftest import SF_SMALL


def test_no_cartesian_or_python_udf(spark):
    offenders = []
    for key, fn in se.queries().items():
        if key == "coverage_report":
            continue   # these run jobs while planning (checkpoints); checked by their own tests
        plan = fn(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        if "CartesianProduct" in plan or "BatchEvalPython" in plan:
            offenders.append(key)
    assert offenders == []


def test_ledger_reader_prunes_columns(spark):
    plan = se.queries()["dq_sums_to_zero_entry"](spark, SF_SMALL)._jdf.queryExecution() \
        .executedPlan().toString()
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "journal_entry_id" in scan and "occurred_at" not in scan
