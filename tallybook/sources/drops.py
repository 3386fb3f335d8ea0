"""The feeds as CSV drops, and a warehouse that loads them: the loader on the given tables.

``write_drop`` renders rows as the files they came from.  :class:`LoadedDrops` is one run of the
loader's life on them: a first load, the same drop again, and a drop in which the settlement files
of each January were restated (their descriptions now hold commas, quotes and line breaks, and a
short line follows the last row).  Daily feed files of a month are delivered as one file.
"""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .contracts import CONTRACTS
from .driver import DriverFeeds, landing_lock
from .ingest import Warehouse, ingest

SETTLED = "processor_a_balance_transactions"
JANUARY = r"balance_transactions_\d{4}-01-01\.csv$"
SHORT_LINE = "restated,short"
#: The range of the backfill.
BACKFILL = ("1995-02-01", "1995-04-30")
_LOADED: dict[tuple[str, str], LoadedDrops] = {}


def csv_line(columns: list[str]) -> Column:
    def cell(name: str) -> Column:
        text = F.coalesce(F.col(name), F.lit(""))
        return F.when(text.rlike('[",\\r\\n]'), F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(text)

    return F.concat_ws(",", *map(cell, columns))


def monthly(rows: DataFrame) -> DataFrame:
    """``rows`` with ``file``, the monthly file that holds their daily one."""
    return rows.withColumn("file", F.regexp_replace("_source_file", r"-\d{2}\.csv$", "-01.csv"))


def feed_lines(rows: DataFrame, table: str, extra: DataFrame | None = None) -> DataFrame:
    """file, day, at, line of a feed's files, header first; ``extra``: more lines (_source_file, line_number, raw_line)."""
    c = CONTRACTS[table]
    body = monthly(rows).select("file", F.col("_source_file").alias("day"), F.col("_source_line").cast("long").alias("at"), csv_line(c.columns).alias("line"))
    if extra is not None:
        body = body.unionByName(monthly(extra).select("file", F.col("_source_file").alias("day"), F.col("line_number").cast("long").alias("at"), F.col("raw_line").alias("line")))
    heads = body.select("file").distinct().select("file", F.lit("").alias("day"), F.lit(-1).cast("long").alias("at"), F.lit(",".join(c.header)).alias("line"))
    return heads.unionByName(body)


def write_drop(spark: SparkSession, lines: DataFrame, root: str) -> None:
    """Write ``lines`` (file, day, at, line) as the files they name, below ``root``."""
    parts = f"{root}-{uuid.uuid4().hex}"
    (lines.repartition("file").sortWithinPartitions("file", "day", "at", "line").select("line", "file")
     .write.option("maxRecordsPerFile", 0).partitionBy("file").text(parts))
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(parts).getFileSystem(spark._jsc.hadoopConfiguration())
    for folder in fs.listStatus(hadoop.Path(parts)):
        name = folder.getPath().getName()
        if name.startswith("file="):
            target = hadoop.Path(f"{root}/{unquote(name[5:])}")
            fs.mkdirs(target.getParent())
            fs.delete(target, False)
            fs.rename(fs.listStatus(folder.getPath())[0].getPath(), target)
    fs.delete(hadoop.Path(parts), True)


def restated(rows: DataFrame) -> DataFrame:
    return monthly(rows).filter(F.col("file").rlike(JANUARY)).drop("file").withColumn("description", F.concat(F.lit('said "'), F.col("description"), F.lit('",\nagain')))


class LoadedDrops:
    """``runs[i]``: the results of load i + 1; ``warehouse`` as it is after the last."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        feeds, root = DriverFeeds(spark, sf_dir, land=True), f"{ensure_checkpoint_dir(spark)}/drops-{uuid.uuid4().hex}"
        self.spark, self.drop, self.warehouse = spark, f"{root}/raw", Warehouse(spark, f"{root}/warehouse")
        settled, short = feeds.raw_processor_a_landed, feeds.load_exceptions
        lines = feed_lines(settled, SETTLED, short)
        for table, rows in (("processor_b_settlement_details", feeds.raw_processor_b), ("bank_statements", feeds.raw_bank), ("fx_reference_rates", feeds.raw_fx)):
            lines = lines.unionByName(feed_lines(rows, table))
        write_drop(spark, lines, self.drop)
        self.runs = [ingest(spark, self.drop, self.warehouse), ingest(spark, self.drop, self.warehouse)]
        first = monthly(short).filter(F.col("file").rlike(JANUARY)).drop("file")
        again = restated(settled)
        files = monthly(again.select("_source_file").unionByName(first.select("_source_file"))).groupBy("file").agg(F.max("_source_file").alias("_source_file"))
        last = files.select("_source_file", F.lit(2**40).alias("line_number"), F.lit(SHORT_LINE).alias("raw_line"))
        write_drop(spark, feed_lines(again, SETTLED, first.select("_source_file", "line_number", "raw_line").unionByName(last)), self.drop)
        self.runs.append(ingest(spark, self.drop, self.warehouse))

    def results(self) -> DataFrame:
        out = None
        for i, r in enumerate(self.runs, 1):
            one = r.select(F.lit(i).alias("run"), "*")
            out = one if out is None else out.unionByName(one)
        return out

    def backfill(self) -> DataFrame:
        """Results of a load of the restated drop into an empty warehouse, by date range."""
        return ingest(self.spark, self.drop, Warehouse(self.spark, f"{self.drop}-backfill-{uuid.uuid4().hex}"), *BACKFILL)


def loaded_drops(spark: SparkSession, sf_dir: str) -> LoadedDrops:
    """Loaded once per application and dataset."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with landing_lock(("drops", *key)):
        if key not in _LOADED:
            _LOADED[key] = LoadedDrops(spark, sf_dir)
        return _LOADED[key]
