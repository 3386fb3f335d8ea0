"""Quality rules: base counts of each text, and cross-document line frequency.

Lines are normalised (ASCII lower case, white space runs to one space, ends
stripped) and hashed.  A line that occurs in more than ``max_docs`` different
documents of one host is common; its first holder (smallest ``doc_id``) keeps it,
all other documents of that host lose it.  A document is depleted, and rejected,
when less than ``min_left`` of its words are left.

Documents of one host with the very same text count as one document: copies are
the business of deduplication, and a text always gets the same verdict whichever
copy is asked about.

Defined cases: a null or empty text has no words and fails the base rule; a null
host is a host of its own; a null ``doc_id`` holds a line first; repeated rows
give repeated result rows; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .frames import Scratch, columns, pick
from .words import LOWER, Words, pieces, text_bytes, windows

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
REPEAT_WINDOW = 8
FACTS = ("doc_id long, host string, t long, t1 long, t2 long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
         "n_repeat_words long, lines array<long>, line_words array<long>")


def repeat_words(w: Words, h0: np.ndarray, h1: np.ndarray, k: int = REPEAT_WINDOW) -> np.ndarray:
    """Per document: words in k-word windows whose word sequence is found twice or more in it."""
    at, a = windows(h0, w.doc, k)
    if not len(at):
        return np.zeros(w.n_docs, np.int64)
    _, b = windows(h1, w.doc, k)
    doc = w.doc[at]
    order = np.lexsort((b, a, doc))
    eq = (a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    twice = np.zeros(len(at), bool)
    twice[order[1:][eq]] = True
    twice[order[:-1][eq]] = True
    step = np.zeros(len(w) + 1, np.int64)
    np.add.at(step, at[twice], 1)
    np.add.at(step, at[twice] + k, -1)
    return np.bincount(w.doc[np.cumsum(step[:-1]) > 0], minlength=w.n_docs)


def normal_line(line: bytes) -> bytes:
    return b" ".join(line.translate(_LOWER).split())


_LOWER = LOWER.tobytes()


def line_hash(line: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(line, digest_size=8).digest(), "little", signed=True)


def _lines(text: bytes) -> tuple[int, list[int], list[int]]:
    """(lines equal to an earlier one, hashes of the different normal lines, their words in the text)."""
    seen: set[bytes] = set()
    words: dict[int, int] = {}
    dup = 0
    for line in text.split(b"\n"):
        n = len(line.split())
        if n:
            dup += line in seen
            seen.add(line)
            h = line_hash(normal_line(line))
            words[h] = words.get(h, 0) + n
    return dup, list(words), list(words.values())


def _sum_by(flag: np.ndarray, offs: np.ndarray) -> np.ndarray:
    c = np.concatenate([[0], np.cumsum(flag)])
    return c[offs[1:]] - c[offs[:-1]]


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data_all, offs_all = text_bytes(batch.column("text"))
        for lo, hi in pieces(offs_all):
            data, offs = data_all[offs_all[lo] : offs_all[hi]], offs_all[lo : hi + 1] - offs_all[lo]
            w = Words(data, offs)
            repeated = repeat_words(w, w.hashes(0), w.hashes(1))
            part = batch.slice(lo, hi - lo)
            raw = data.tobytes()
            texts = [raw[a:b] for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())]
            line = [_lines(t) for t in texts]
            name = np.frombuffer(b"".join(hashlib.blake2b(t, digest_size=16).digest() for t in texts), "<i8").reshape(-1, 2)
            # code points in words: bytes that are no continuation bytes
            points = np.cumsum(np.concatenate([[0], (data & 0xC0) != 0x80]))
            chars = np.bincount(w.doc, weights=points[w.ends] - points[w.starts], minlength=w.n_docs).astype(np.int64)
            yield pa.record_batch({
                "doc_id": part.column("doc_id"), "host": part.column("host"), "t": part.column("t"), "t1": pa.array(name[:, 0]), "t2": pa.array(name[:, 1]),
                "n_words": pa.array(w.counts.astype(np.int64)), "word_chars": pa.array(chars), "n_symbols": pa.array(_sum_by(SYMBOLS[data], offs).astype(np.int64)),
                "n_dup_lines": pa.array([x[0] for x in line], pa.int64()), "n_repeat_words": pa.array(repeated.astype(np.int64)),
                "lines": pa.array([x[1] for x in line], pa.list_(pa.int64())), "line_words": pa.array([x[2] for x in line], pa.list_(pa.int64())),
            })


def judge(spark: SparkSession, docs: DataFrame, max_docs: int = 50, min_left: float = 0.3, scratch: Scratch | None = None, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_common_words,
    base_failed, kept, and t, a hash of the text."""
    scratch = scratch or Scratch(spark, "lines")
    texts = pick(docs, doc_id=doc_id, text=text, host=host).withColumn("host", F.when(F.col("host").isNull(), "").otherwise(F.concat(F.lit("="), F.col("host")))).withColumn("t", F.xxhash64("text"))
    facts = scratch.save(texts.mapInArrow(_facts, FACTS), "facts")
    lost = lost_lines(spark, facts, max_docs, scratch)
    lost = scratch.save(lost.groupBy("host", "t1", "t2").agg(F.sum("words").alias("n_common_words")), "lost")
    out = facts.drop("lines", "line_words").join(lost, ["host", "t1", "t2"], "left").withColumn("n_common_words", F.coalesce("n_common_words", F.lit(0)))
    base_failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    depleted = F.col("n_words") - F.col("n_common_words") < min_left * F.col("n_words")
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed.alias("base_failed"), (~base_failed & ~depleted).alias("kept"), "n_common_words", "t")


def lost_lines(spark: SparkSession, facts: DataFrame, max_docs: int, scratch: Scratch) -> DataFrame:
    """(host, t1, t2, t, line, words): the common lines of all texts but their first holder's."""
    common = common_lines(spark, facts, max_docs, scratch)
    each = scratch.spark.read.parquet(f"{scratch.root}/different")
    each = each.select("host", "t1", "t2", "t", F.col("doc_id").alias("of"), F.explode(F.arrays_zip("lines", "line_words")).alias("l"))
    each = each.select("host", "t1", "t2", "t", "of", F.col("l.lines").alias("line"), F.col("l.line_words").alias("words"))
    return scratch.save(each.join(common, ["host", "line"]).where(~F.col("of").eqNullSafe(F.col("holder"))).select("host", "t1", "t2", "t", "line", "words"), "lost_lines")


def common_lines(spark: SparkSession, facts: DataFrame, max_docs: int, scratch: Scratch) -> DataFrame:
    """(host, line, n_docs, holder) of the lines above the limit; one count per different text."""
    different = scratch.save(facts.groupBy("host", "t1", "t2").agg(F.min("doc_id").alias("doc_id"), F.max(F.col("doc_id").isNull()).alias("nameless"), F.first("t").alias("t"), F.first("lines").alias("lines"), F.first("line_words").alias("line_words")).withColumn("doc_id", F.when(~F.col("nameless"), F.col("doc_id"))).drop("nameless"), "different")
    held = different.select("host", "doc_id", F.explode("lines").alias("line")).groupBy("host", "line").agg(F.count(F.lit(1)).alias("n_docs"), F.min(F.struct(F.col("doc_id").alias("id"))).alias("holder"))
    return scratch.save(held.where(F.col("n_docs") > max_docs).select("host", "line", "n_docs", F.col("holder.id").alias("holder")), "common")


def strip_common_lines(docs: DataFrame, lost: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """``docs`` without the lines that ``judge`` found lost (``lost_lines``), by host and hash of the
    text; only documents that lose a line are put together anew, other lines stay as they are."""
    gone = lost.groupBy(F.col("host").alias("lost_of"), F.col("t").alias("lost_by")).agg(F.collect_set("line").alias("gone"))
    key = F.when(docs[host].isNull(), "").otherwise(F.concat(F.lit("="), docs[host]))
    at, names = docs.columns.index(text), [f"c{i}" for i in range(len(docs.columns))]  # plain names on the way through Arrow
    keyed = docs.select(*[c.alias(n) for c, n in zip(columns(docs), names)], key.alias("of"), F.xxhash64(docs[text]).alias("by"))
    plain = StructType([StructField(n, f.dataType, f.nullable) for n, f in zip(names, docs.schema)])

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns = list(b.columns)
            texts, lines = columns[at].cast(pa.binary()).to_pylist(), columns.pop().to_pylist()
            left = [None if x is None else without(x, set(y)) if y else x for x, y in zip(texts, lines)]
            columns[at] = pa.array(left, pa.binary()).view(pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    def without(body: bytes, lines: set) -> bytes:
        return b"\n".join(x for x in body.split(b"\n") if not x.split() or line_hash(normal_line(x)) not in lines)

    on = (F.col("of") == F.col("lost_of")) & (F.col("by") == F.col("lost_by"))
    return keyed.join(gone, on, "left").select(*names, "gone").mapInArrow(strip, plain).toDF(*docs.columns)
