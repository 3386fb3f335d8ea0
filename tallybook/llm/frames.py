"""Shared-folder staging and small DataFrame helpers for the corpus operators.

Iterative operators cut their lineage by writing a table into the folder named
by ``spark.checkpoint.dir`` and reading it back; a lost executor then re-reads
files instead of replaying earlier rounds.
"""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallybook.session import ensure_checkpoint_dir


class Scratch:
    """A private folder below the shared checkpoint folder for one operator run."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, table: str, partition_by: str | None = None) -> DataFrame:
        """Write ``df`` once and return a reader over the files."""
        path, schema = f"{self.root}/{table}", df.schema
        writer = df.write.mode("overwrite").option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(path)
        del df, writer
        self.release()
        return self.spark.read.schema(StructType([f for f in schema])).parquet(path)

    def release(self) -> None:
        """Let Spark's cleaner drop the shuffle files of plans nobody holds any more."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def drop(self, *tables: str) -> None:
        """Remove tables that no live DataFrame reads any more."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for t in tables:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{t}")
            path.getFileSystem(conf).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pick(df: DataFrame, **cols: str) -> DataFrame:
    """Only the named columns, under working names (``pick(df, doc_id="id", text="body")``):
    whatever else the input carries cannot clash with an operator's own columns."""
    return df.select(*[df[src].alias(dst) for dst, src in cols.items()])


def columns(df: DataFrame) -> list[Column]:
    """All columns by name, whatever signs the names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def packed(df: DataFrame, **keys: Column) -> DataFrame:
    """``df``'s rows as one column ``_row`` (``select("_row.*")`` gives them back) beside the given keys,
    which no column of the input can clash with."""
    return df.select(F.struct(*columns(df)).alias("_row"), *[value.alias(name) for name, value in keys.items()])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once: the planner cannot copy it into each use."""
    return F.get(F.transform(F.array(value), body), 0)


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Slots of the key filter: at most so many longs are broadcast.
SLOTS = 1 << 20


def apart(df: DataFrame, other: DataFrame, *keys: str) -> tuple[DataFrame, DataFrame]:
    """(rows of ``df`` that may have their keys in ``other``, rows that have not), without a shuffle of ``df``.

    Keys are dealt to ``SLOTS`` slots by hash, and the used slots of ``other`` are broadcast: ``SLOTS``
    longs at most, whatever the size of ``other``.  Rows in a used slot still need the join."""
    slot = F.pmod(F.xxhash64(*keys), F.lit(SLOTS)).alias("_slot")
    used, dealt = F.broadcast(other.select(slot).distinct()), df.select("*", slot)
    return dealt.join(used, "_slot", "left_semi").drop("_slot"), dealt.join(used, "_slot", "left_anti").drop("_slot")


def any_rows(df: DataFrame) -> bool:
    return len(df.limit(1).select(F.lit(1)).take(1)) > 0


def ranked(scratch: Scratch, df: DataFrame, name: str, *order: Column, column: str = "rank") -> DataFrame:
    """``df`` with its row number (from 0) in a total order, without a single-task window.

    Rows are range-partitioned and sorted, written once, and each partition's numbers are
    shifted by the rows of the partitions before it (a table of one row per partition)."""
    from pyspark.sql import Window

    n = shuffle_partitions(scratch.spark)
    sorted_ = scratch.save(df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_m", F.monotonically_increasing_id()), name)
    part = F.shiftright("_m", 33)
    counts = sorted_.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_n"))  # one row per partition
    before = counts.select("_p", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    out = sorted_.withColumn("_p", part).join(before, "_p")
    return out.withColumn(column, F.col("_before") + F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))).drop("_p", "_m", "_before")
