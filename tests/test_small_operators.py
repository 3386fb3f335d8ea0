import datetime as dt

from tallybook.functions.money import time_spine
from tallybook.operators.quality import source_freshness


def test_source_freshness_thresholds(spark):
    mk = lambda ts: spark.createDataFrame([(ts,)], "_loaded_at timestamp")
    now = dt.datetime(2025, 7, 10, 12, 0)
    out = {r.source_table: r.status for r in source_freshness(
        {"a": mk(now - dt.timedelta(hours=2)), "b": mk(now - dt.timedelta(hours=30)),
         "c": mk(now - dt.timedelta(hours=60))}, "2025-07-10 12:00:00").collect()}
    assert out == {"a": "pass", "b": "warn", "c": "error"}


def test_time_spine_covers_range(spark):
    s = time_spine(spark)
    assert s.count() == (dt.date(2027, 12, 31) - dt.date(2023, 1, 1)).days + 1
