"""Benchmark decontamination by winnowing (DataFrame functions only).

Words are ASCII-lower-cased runs of letters, digits and non-ASCII characters.  For
a window of ``length`` words its k-gram hashes are taken and the smallest is kept;
equal windows keep the same hash, so every shared span of ``length`` words or more
leaves at least one fingerprint that the document and the benchmark have in common
(k + grams per window - 1 = length).  Items with fewer than ``length`` words are one
window of their own length and get the same treatment at that length.

Fingerprints of all documents are joined to the benchmark's; in documents with a
hit, the windows that kept a hit hash are compared word for word with the
benchmark's windows, and hit windows are extended to the words they cover.

Only aggregates move: a document contributes each fingerprint once, and a passage
that very many documents share is one benchmark row, not a group.  Which side is
broadcast is left to the planner's size check.

Defined cases: null or empty texts have no words and are clean; items without
words are skipped; a null ``item_id`` marks words and is listed as the empty
string; equal items count once by id; rows with equal ``doc_id`` are answered for
their own text; no documents give no rows, no benchmark leaves all clean; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import Scratch, let, pick, same

LENGTH = 13
GRAM = 5
#: Fixed value: what separates words (A-Z are lowered first; splitting does not depend on that).
WORD = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    plain = lambda w: F.when(F.octet_length(w) == F.length(w), F.lower(w)).otherwise(F.translate(w, _UPPER, _LOWER))
    return F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0)), plain)


def _spans(a: Column, n: Column) -> Column:
    """The first n elements; none if n is not positive."""
    return F.slice(a, 1, F.greatest(n, F.lit(0)))


def window_mins(words: Column, length: int) -> Column:
    """For each window of ``length`` words, in order: the smallest hash of its k-grams."""
    k = min(GRAM, (length + 1) // 2)
    span = length - k + 1
    # k-grams: one hash over the k word hashes
    grams = lambda h: F.transform(_spans(h, F.size(h) - (k - 1)), lambda x, i: F.xxhash64(x, *[F.get(h, i + j) for j in range(1, k)]))

    def widen(g: Column, have: int) -> Column:
        """Minimum over ``span`` neighbours by doubling."""
        if have == span:
            return g
        step = min(have, span - have)
        return let(F.transform(_spans(g, F.size(g) - step), lambda x, i: F.least(x, F.get(g, i + step))), lambda m: widen(m, have + step))

    return let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: let(grams(h), lambda g: widen(g, 1)))


def benchmark_windows(items: DataFrame, length: int = LENGTH) -> DataFrame:
    """(item_id, length, window, print): the windows of all items, each once per item."""
    w = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), words_of(F.col("text")).alias("w")).where(F.size("w") > 0)
    long = w.where(F.size("w") >= length).select("item_id", F.lit(length).alias("length"), F.explode(F.transform(window_mins(F.col("w"), length), lambda m, i: F.struct(m.alias("print"), F.array_join(F.slice(F.col("w"), i + 1, F.lit(length)), " ").alias("window")))).alias("x"))
    parts = [long]
    for n in range(1, length):
        short = w.where(F.size("w") == n)
        parts.append(short.select("item_id", F.lit(n).alias("length"), F.struct(F.get(window_mins(F.col("w"), n), 0).alias("print"), F.array_join("w", " ").alias("window")).alias("x")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out.select("item_id", "length", "x.window", "x.print").distinct()


def contamination(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, length: int = LENGTH, scratch: Scratch | None = None, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every row, and ``spans``:
    the hit word ranges [start, start + words) of the text."""
    scratch = scratch or Scratch(spark, "winnow")
    base = pick(docs, doc_id=doc_id, text=text).withColumn("t", F.xxhash64("text"))
    items = scratch.save(benchmark_windows(pick(benchmark, item_id=item_id, text=item_text), length), "items")
    lengths = sorted(r[0] for r in items.select("length").distinct().collect())  # at most ``length`` numbers
    hits = _hits(scratch, base, items, lengths)
    out = base.select("doc_id", "t", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("n_words"))
    hits = hits.select(F.col("doc_id").alias("d"), F.col("t").alias("s"), "spans", "n_hit", "items")
    out = out.join(hits, same(out["doc_id"], hits["d"]) & (out["t"] == hits["s"]), "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(listed).cast("long").alias("n_items"), F.sha2(F.array_join(listed, ",").cast("binary"), 256).alias("items_sha256"), ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"), "t", "spans")


def _hits(scratch: Scratch, base: DataFrame, items: DataFrame, lengths: list[int]) -> DataFrame:
    """(doc_id, t, spans, n_hit, items) of the texts with a hit."""
    found = None
    for n in lengths:
        of = items.where(F.col("length") == n)
        prints = scratch.save(of.select("print").distinct(), f"prints{n}")
        fingerprints = base.select("doc_id", "t", F.explode(F.array_distinct(window_mins(words_of(F.col("text")), n))).alias("print"))
        asked = scratch.save(fingerprints.join(prints, "print", "left_semi").groupBy("doc_id", "t").agg(F.collect_set("print").alias("prints")), f"asked{n}")
        asked = asked.select(F.col("doc_id").alias("d"), F.col("t").alias("s"), "prints")
        held = base.join(asked, same(base["doc_id"], asked["d"]) & (base["t"] == asked["s"])).select("doc_id", "t", "prints", words_of(F.col("text")).alias("w"))
        picked = let(F.col("w"), lambda w: F.filter(F.transform(window_mins(w, n), lambda m, i: F.when(F.array_contains(F.col("prints"), m), F.struct(i.alias("start"), F.array_join(F.slice(w, i + 1, F.lit(n)), " ").alias("window")))), lambda x: x.isNotNull()))
        near = held.select("doc_id", "t", F.explode(picked).alias("x")).select("doc_id", "t", "x.start", "x.window").distinct()
        hit = near.join(of.select("item_id", "window"), "window").select("doc_id", "t", "start", F.lit(n).alias("words"), "item_id")
        hit = scratch.save(hit, f"hit{n}")
        found = hit if found is None else found.unionAll(hit)
    if found is None:
        return base.limit(0).select("doc_id", "t", F.array(F.struct(F.lit(0).alias("start"), F.lit(0).alias("words"))).alias("spans"), F.lit(0).alias("n_hit"), F.array(F.lit("")).alias("items"))
    spans = found.select("doc_id", "t", F.struct("start", "words").alias("x")).distinct().groupBy("doc_id", "t").agg(F.array_sort(F.collect_set("x")).alias("spans"))
    listed = found.select("doc_id", "t", "item_id").distinct().groupBy("doc_id", "t").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    listed = listed.select(F.col("doc_id").alias("d"), F.col("t").alias("s"), "items")
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda a, x: F.struct(F.greatest(a["end"], x["start"] + x["words"]).alias("end"), (a["n"] + F.greatest(F.lit(0), x["start"] + x["words"] - F.greatest(a["end"], x["start"]))).alias("n")),
        lambda a: a["n"])
    out = spans.join(listed, same(spans["doc_id"], listed["d"]) & (spans["t"] == listed["s"])).select("doc_id", "t", "spans", covered.alias("n_hit"), "items")
    return scratch.save(out, "hits")
