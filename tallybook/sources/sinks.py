"""Table sinks: the month-partitioned ledger and general ledger with a lookback rebuild.

Both tables are partitioned by ``posting_month`` and sorted by account inside each file, so
partition filters and Parquet min/max statistics let month and account filters skip data.

On an existing table only the months the lookback window touches are recomputed and replaced
whole (dynamic partition overwrite): a restated row that changes an entry's shape leaves no stale
lines behind.  Dynamic overwrite cannot empty a partition, so a touched month that has no rows any
more is deleted explicitly.  The schema of an existing table is fixed: other columns or types are
refused before anything is written.

Cutoffs, months and schemas come from partition folders and the newest month's rows; the input is
computed once, while it is written.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .contracts import DEFAULT_POLICY, Policy

MONTH = "posting_month"


class SchemaChanged(ValueError):
    """The lines to write do not have the columns of the stored table."""


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def table_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def stored_months(spark: SparkSession, path: str) -> list[dt.date]:
    """The months that have a partition, from the folder names."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(dt.date.fromisoformat(m.group(1)) for m in (re.fullmatch(rf"{MONTH}=(\d{{4}}-\d{{2}}-\d{{2}})", n) for n in names) if m)


def lookback_cutoff(spark: SparkSession, path: str, lookback_days: int) -> dt.date | None:
    """First day of the month of (max posting_date - lookback); only the newest month is read."""
    months = stored_months(spark, path)
    if not months:
        return None
    newest = spark.read.parquet(path).filter(F.col(MONTH) == F.lit(months[-1])).agg(F.max("posting_date").alias("m")).first().m
    return (newest - dt.timedelta(days=lookback_days)).replace(day=1)


def assert_schema(spark: SparkSession, out: DataFrame, path: str) -> None:
    """Refuse lines whose columns or types differ from those stored (order does not count)."""
    def shape(df: DataFrame) -> dict[str, str]:
        return {f.name: f.dataType.simpleString() for f in df.schema if f.name != MONTH}

    new, old = shape(out), shape(spark.read.parquet(path))
    if new != old:
        wrong = sorted(set(new.items()) ^ set(old.items()))
        raise SchemaChanged(f"schema of {path} is fixed; differs in {wrong}")


def _write_months(out: DataFrame, path: str, dynamic: bool, order: list[str], extra: tuple[str, ...] = ()) -> set[dt.date]:
    """Write by month; returns the months written, observed on the way.

    The rebalance splits a month that holds most lines over many tasks and leaves a small one in one file."""
    seen = Observation()
    parts = [MONTH, *extra]
    rows = out.hint("rebalance", *parts).observe(seen, F.collect_set(F.col(MONTH).cast("string")).alias("months"))
    (rows.sortWithinPartitions(*parts, *order).write.mode("overwrite").partitionBy(*parts)
     .option("partitionOverwriteMode", "dynamic" if dynamic else "static").parquet(path))
    return {dt.date.fromisoformat(m) for m in seen.get["months"] or []}


def _drop_months(spark: SparkSession, path: str, months: list[dt.date], below: str = "") -> None:
    fs, _ = _fs(spark, path)
    for month in months:
        fs.delete(_fs(spark, f"{path}/{MONTH}={month}{below}")[1], True)


def write_ledger(spark: SparkSession, ledger: DataFrame, path: str,
                 policy: Policy = DEFAULT_POLICY, full_refresh: bool = False) -> dict:
    """Create or incrementally rebuild the partitioned ledger table.

    ``ledger`` may hold all lines or just those since :func:`lookback_cutoff`."""
    out = ledger.withColumn(MONTH, F.trunc("posting_date", "MM"))
    before = [] if full_refresh else stored_months(spark, path)
    cutoff = lookback_cutoff(spark, path, policy.ledger_lookback_days) if before else None
    if cutoff is not None:
        assert_schema(spark, ledger, path)
        out = out.filter(F.col("posting_date") >= F.lit(cutoff))
    existing = {m for m in before if cutoff is not None and m >= cutoff}
    written = _write_months(out, path, cutoff is not None, ["account_code", "source_system"])
    emptied = sorted(existing - written)
    _drop_months(spark, path, emptied)   # months that became empty upstream
    return {"cutoff": cutoff, "months_rebuilt": sorted(written) if cutoff is not None else [], "months_emptied": emptied}


def write_general_ledger(spark: SparkSession, ledger: DataFrame, close_lines: DataFrame, path: str,
                         cutoff: dt.date | None = None) -> dict:
    """The general ledger as a table: ``posting_month``, then ``part`` (ledger or close lines).

    ``ledger``: the published ledger table.  Since ``cutoff`` its months are written anew, earlier ones stay as
    they are (without one, all are); the close lines, a few per month, are always written for all months."""
    before = stored_months(spark, path)
    columns = [c for c in ledger.columns if c in close_lines.columns]
    lines = ledger.select(*columns, F.trunc("posting_date", "MM").alias(MONTH), F.lit("ledger").alias("part"))
    close = close_lines.select(*columns, F.trunc("posting_date", "MM").alias(MONTH), F.lit("close").alias("part"))
    incremental = cutoff is not None and bool(before)
    if before:
        assert_schema(spark, close, path)
    if incremental:
        lines = ledger.filter(F.col(MONTH) >= F.lit(cutoff)).select(*columns, MONTH, F.lit("ledger").alias("part")) if MONTH in ledger.columns else lines.filter(F.col(MONTH) >= F.lit(cutoff))
    n = {"ledger": _write_months(lines, path, incremental, ["account_code"], ("part",))}
    n["close"] = _write_months(close, path, True, ["account_code"], ("part",))
    gone = {"ledger": sorted(m for m in before if incremental and m >= cutoff and m not in n["ledger"]),
            "close": sorted(m for m in before if incremental and m not in n["close"])}
    for part, months in gone.items():
        _drop_months(spark, path, months, f"/part={part}")
    return {"cutoff": cutoff, "months_rebuilt": sorted(n["ledger"]), "months_emptied": gone["ledger"]}
