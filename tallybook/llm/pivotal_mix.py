"""Mixing sources to target weights by pivotal dependent rounding.

A source with target ``t`` words out of ``s`` takes each of its documents
``f = t / s`` times on average (0 <= f <= 2): ``floor(f)`` copies for sure and one
more with probability ``p = f - floor(f)``.  Two open documents are paired and
words' worth of probability moves from one to the other, in the direction drawn so
that no expectation changes, until one of them is certain.  Total words
``sum(p * size)`` never change, so a source misses its target by less than its last
open document.

The pairing runs in groups of about ``GROUP`` documents of a source, dealt by hash;
each group leaves one open document at most, and the open documents of all groups
go up a reduction tree until a source has a single group.  A hot source is many
groups; no task holds a source.

All draws are hashes of the seed, the document and its number among equal rows, so reruns agree.  Defined cases:
a null text or a text without words has size 0 and is taken 0 times as words; a
null source is a source of its own, last in order; a null ``doc_id`` and repeated
rows are documents like any other; sources without words have target 0; no rows
give no rows; other columns are ignored.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import Scratch, any_rows, packed, pick, ranked, same, shuffle_partitions

GROUP = 4096
WEIGHTS = (5, 2, 1)


def settle(size: np.ndarray, p: np.ndarray, draw: np.ndarray) -> tuple[np.ndarray, int]:
    """Pivotal rounding of units in the given order: (probabilities, number of the open unit or -1)."""
    p = p.astype(float).tolist()
    size, draw = size.astype(float).tolist(), draw.tolist()
    i = -1
    for j in range(len(p)):
        if p[j] <= 0.0 or p[j] >= 1.0:
            continue
        if i < 0:
            i = j
            continue
        a, b = size[i], size[j]
        to_i, to_j = min((1 - p[i]) * a, p[j] * b), min(p[i] * a, (1 - p[j]) * b)
        if draw[j] * (to_i + to_j) < to_j:
            full, gone = (1 - p[i]) * a <= p[j] * b, (1 - p[i]) * a >= p[j] * b
            p[i], p[j] = (1.0 if full else p[i] + to_i / a), (0.0 if gone else p[j] - to_i / b)
        else:
            gone, full = p[i] * a <= (1 - p[j]) * b, p[i] * a >= (1 - p[j]) * b
            p[i], p[j] = (0.0 if gone else p[i] - to_j / a), (1.0 if full else p[j] + to_j / b)
        if not 0.0 < p[i] < 1.0:
            i = j if 0.0 < p[j] < 1.0 else -1
    return np.array(p, float), i


def _group(pdf: pd.DataFrame) -> pd.DataFrame:
    # large documents first: the one that stays open is a small one
    pdf = pdf.sort_values(["size", "u", "doc_id"], ascending=[False, True, True], kind="stable", na_position="first").reset_index(drop=True)
    p, open_ = settle(pdf["size"].to_numpy(), pdf["p"].to_numpy(), (pdf["v"].to_numpy().astype(np.uint64) >> np.uint64(11)) / float(1 << 53))
    if open_ >= 0 and pdf["groups"].iat[0] == 1:
        p[open_] = 1.0 if (int(pdf["u"].iat[open_]) & (2**53 - 1)) / 2**53 < p[open_] else 0.0
        open_ = -1
    pdf["p"] = p
    pdf["open"] = np.arange(len(pdf)) == open_
    return pdf


ROWS = "t long, doc_id long, size long, source string, groups long, whole long, u long, v long, p double, open boolean"


def targets(spark: SparkSession, sized: DataFrame, share: float, scratch: Scratch) -> DataFrame:
    """(source, source_size, n_docs, target): weights by code point order of the sources, null last;
    no target is above 2 x its source's size, what is cut off is shared again by weight."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    table = ranked(scratch, totals, "sources", F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("rank") % len(WEIGHTS)).cast("int") + 1)
    table = scratch.save(table.withColumn("weight", weight), "weighted")
    everything = table.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:  # scalars only: words still to share, weight that still takes some
        full = F.lit(level) * F.col("weight") >= 2.0 * F.col("source_size")
        row = table.agg(F.sum(F.when(full, F.col("source_size"))), F.sum(F.when(~full, F.col("weight")))).first()
        if not row[1]:
            break
        new = (share * everything - 2.0 * (row[0] or 0)) / row[1]
        if new <= level:
            break
        level = new
    return table.select("source", "source_size", "n_docs", F.least(F.lit(level) * F.col("weight"), 2.0 * F.col("source_size")).alias("target"))


def numbered(spark: SparkSession, sized: DataFrame) -> DataFrame:
    """``sized`` with ``copy``, the number of a row among equal ones from 0.  Equal rows are counted
    and written out again, many of them as blocks of ``GROUP`` in all tasks."""
    counted = sized.groupBy("doc_id", "t", "source", "size").agg(F.count(F.lit(1)).alias("n"))
    few = counted.where(F.col("n") <= GROUP).withColumn("first", F.lit(0).cast("long"))
    many = counted.where(F.col("n") > GROUP).withColumn("first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(GROUP).cast("long"))))
    blocks = few.unionAll(many.repartition(shuffle_partitions(spark), "doc_id", "t", "first"))
    last = F.least(F.col("first") + GROUP, F.col("n")) - 1
    return blocks.withColumn("copy", F.explode(F.sequence(F.col("first"), last))).drop("n", "first")


def mix(spark: SparkSession, docs: DataFrame, share: float = 1.5, seed: int = 0, scratch: Scratch | None = None, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, size, source_size, target, taken, copies, and t, a hash of text and source."""
    scratch = scratch or Scratch(spark, "mix")
    base = pick(docs, doc_id=doc_id, text=text, source=source)
    words = F.coalesce(F.regexp_count("text", F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")
    sized = scratch.save(base.select("doc_id", F.xxhash64("text", "source").alias("t"), "source", words.alias("size")), "sized")
    goal = scratch.save(targets(spark, sized, share, scratch), "targets")
    per = goal.select(F.col("source").alias("of"), (F.col("target") / F.greatest("source_size", F.lit(1))).alias("f"), "n_docs")
    sized = numbered(spark, sized)
    draw = lambda n: F.when(F.col("copy") == 0, F.xxhash64(F.lit(seed), F.lit(n), "doc_id", "t")).otherwise(F.xxhash64(F.lit(seed), F.lit(n), "doc_id", "t", "copy"))
    units = sized.join(per, same(sized["source"], per["of"])).select(
        "t", "doc_id", "size", "source", F.ceil(F.col("n_docs") / GROUP).alias("groups"), F.floor("f").alias("whole"), draw(1).alias("u"), draw(2).alias("v"),
        F.when(F.col("size") > 0, F.col("f") - F.floor("f")).otherwise(0.0).alias("p"), F.lit(False).alias("open"))
    done, level = None, 0
    while True:
        at = F.pmod(F.xxhash64(F.lit(3 + level), "u"), F.col("groups"))
        rows = scratch.save(units.groupBy("source", at.alias("at")).applyInPandas(_group, ROWS), f"level{level}")
        done = rows.where(~F.col("open")) if done is None else done.unionAll(rows.where(~F.col("open")))
        units = rows.where("open").withColumn("groups", F.ceil(F.col("groups") / GROUP).cast("long")).withColumn("open", F.lit(False))
        level += 1
        if not any_rows(units):
            break
    out = done.select("t", "doc_id", "size", "source", (F.col("whole") + F.col("p").cast("long")).alias("copies"))
    sizes = goal.select(F.col("source").alias("of"), "source_size", "target")
    out = out.join(sizes, same(out["source"], sizes["of"]))
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "t")


def mixed_rows(spark: SparkSession, docs: DataFrame, share: float = 1.5, seed: int = 0, scratch: Scratch | None = None, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it (documents without words: never).
    Rows equal in id, text and source stand together for the copies that all of them take."""
    scratch = scratch or Scratch(spark, "mix")
    taken = mix(spark, docs, share, seed, scratch, doc_id, text, source).groupBy(F.col("doc_id").alias("_d"), F.col("t").alias("_t")).agg(F.count(F.lit(1)).alias("_rows"), F.sum(F.when(F.col("size") > 0, F.col("copies")).otherwise(0)).cast("int").alias("_copies"))
    taken = scratch.save(taken, "taken")
    rows = packed(docs, _id=docs[doc_id], _key=F.xxhash64(docs[text], docs[source]))
    on = same(rows["_id"], taken["_d"]) & (rows["_key"] == taken["_t"])
    single = rows.join(taken.where("_rows = 1 AND _copies > 0"), on)
    double = rows.join(taken.where("_rows > 1 AND _copies > 0"), on).groupBy("_d", "_t").agg(F.first("_row").alias("_row"), F.first("_copies").alias("_copies"))
    times = F.explode(F.array_repeat(F.lit(0), F.col("_copies"))).alias("_copy")
    return single.select("_row", times).select("_row.*").unionAll(double.select("_row", times).select("_row.*"))
