"""Strict as-of lookup: for each left row, the first right time strictly after the left time with
the same key.

Spark has no as-of join.  A window partitioned by key would put a hot key (a third of all rows)
into one task; a range join would emit all pairs in a group.  Instead, with built-in operators only:

1. the answer depends on (key, time) alone, so both sides are first reduced to their distinct pairs:
   repeated times, however many, are one row after the map-side aggregate;
2. time is cut into buckets, and a running minimum over (key, bucket), from the latest time to
   the earliest, finds the next right time inside the bucket; a hot key is as many tasks as it has
   buckets;
3. each (key, bucket) is one row with its first right time; a window over these rows, whose number
   is bounded by the time range and not by the rows, carries the first right time of the later
   buckets into the earlier ones;
4. left rows look their pair up; a pair that many rows share is split by the adaptive skew join.

Keys keep their type (no float passes a 64-bit id), nothing is collected and no job runs while the plan
is built.  Right rows at exactly the left time are not "after".  A null key or time finds nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

HOUR = 3_600_000_000


def next_after(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str,
               out_col: str = "next_at", bucket_micros: int = HOUR) -> DataFrame:
    def pairs(df: DataFrame, time: str) -> DataFrame:
        t = F.unix_micros(F.col(time).cast("timestamp"))
        both = df.select(F.col(key).alias("_k"), t.alias("_t")).filter(F.col("_k").isNotNull() & F.col("_t").isNotNull())
        return both.distinct().withColumn("_b", F.floor(F.col("_t") / F.lit(bucket_micros)).cast("bigint"))

    asked, rights = pairs(left, left_time), pairs(right, right_time)
    both = asked.withColumn("_asks", F.lit(True)).unionByName(rights.withColumn("_asks", F.lit(False)))
    right_t = F.when(~F.col("_asks"), F.col("_t"))

    # From the latest time back; of one time the left row comes first, so it does not see equal rights.
    back = Window.partitionBy("_k", "_b").orderBy(F.col("_t").desc(), F.col("_asks").desc()).rowsBetween(Window.unboundedPreceding, 0)
    inside = both.withColumn("_in", F.min(right_t).over(back)).filter("_asks")

    heads = both.groupBy("_k", "_b").agg(F.min(right_t).alias("_first"))
    later = Window.partitionBy("_k").orderBy(F.col("_b").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carried = heads.select("_k", "_b", F.min("_first").over(later).alias("_carry"))

    found = inside.join(carried, ["_k", "_b"], "left").select(
        "_k", "_t", F.timestamp_micros(F.coalesce("_in", "_carry")).alias(out_col))
    out = left.withColumn("_at", F.unix_micros(F.col(left_time).cast("timestamp")))
    return out.join(found, (F.col(key) == F.col("_k")) & (F.col("_at") == F.col("_t")), "left").drop("_at", "_k", "_t")


def after_payout_events(events: DataFrame, orders: DataFrame, seller_payouts: DataFrame) -> DataFrame:
    """Refunds and disputes that hit a seller who had already been paid:
    the seller's first paid or returned payout strictly after the order was
    created falls strictly before the event."""
    q = (events.filter(F.col("event_type").isin("refund", "dispute"))
         .join(orders.select("order_id", "seller_id", F.col("created_at").alias("order_created_at")), "order_id")
         .select("settlement_event_id", "processor", "event_type", "order_id", "seller_id",
                 "order_created_at", "occurred_at"))
    p = seller_payouts.filter(F.col("status").isin("paid", "returned")).select("seller_id", "initiated_at")
    out = next_after(q, p, "seller_id", "order_created_at", "initiated_at", out_col="next_payout_at")
    return out.filter(F.col("next_payout_at") < F.col("occurred_at"))
