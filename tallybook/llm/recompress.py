"""Substring deduplication by recompression.

A document is a string of words.  Rounds of recompression rename it: a run of one
symbol becomes a symbol named by (symbol, length), then every symbol is put on the
left or right side by a bit of its name and a left symbol followed by a right one
becomes a symbol named by the pair.  A name is a hash of what it stands for, so
all tasks give the same names and a round needs no dictionary.  Each symbol keeps
the range of words that its making depended on; inside that range equal words give
equal symbols wherever they stand.

For every window of ``width`` words, of the symbols of the highest round whose
ranges (of at most ``REACH`` words) lie inside the window the one with the smallest
hash is its anchor, and the words of that range name it (windows without one are
named whole).  Equal windows have equal anchors, so only
documents that share an anchor name with another document can share a window.
Names travel with the run of windows they stand for, so those windows are found
again by place; they are compared by 96-bit names over all their words (two
independent hashes).

Defined cases: null and empty texts have no words; fewer than ``width`` words
have no window; a null ``doc_id`` comes before all others; rows with equal
``doc_id`` never remove anything from each other, and each row is answered for
its own text; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import Scratch, pick
from .words import U, Words, mix, pieces, signed, text_bytes

WIDTH = 13
ROUNDS = 5
REACH = 8
#: Beyond all places: of a piece of usual length, of any.
FAR, FAR_LONG = 1 << 28, 1 << 40
_BASE = 0x9DDFEA08EB382D69
_INVERSE = pow(_BASE, -1, 1 << 64)
_KNOWN: dict[int, np.ndarray] = {}
#: Bytes of text whose arrays stay in a core's cache.
PIECE = 1 << 18


def rounds(h: np.ndarray, doc: np.ndarray, n_rounds: int = ROUNDS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """After each round: names, and the word ranges [low, high) the symbols depended on.
    A mark outside all ranges stands before each document and at the end."""
    n = len(h)
    if not n:
        return
    place, far = (np.int32, FAR) if n < FAR else (np.int64, FAR_LONG)
    heads = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    mark = np.append(np.insert(np.zeros(n, bool), heads, True), True)
    name = np.append(np.insert(h, heads, U(0)), U(0))
    low = np.append(np.insert(np.arange(n, dtype=place), heads, -far), place(-far))
    high = np.append(np.insert(np.arange(1, n + 1, dtype=place), heads, far), place(far))
    for r in range(n_rounds):
        if r % 2 == 0:
            head = np.ones(len(name), bool)
            head[1:] = (name[1:] != name[:-1]) | mark[1:] | mark[:-1]
            i = np.flatnonzero(head)
            k = np.diff(np.append(i, len(name)))
            new = name[i]
            long = np.flatnonzero(k > 1)
            new[long] = mix(new[long] * U(0x8EBC6AF09C88C6E3) + k[long].astype(U))
            # that a run ends here is known only with both neighbours
            low, high = low[np.maximum(i - 1, 0)], high[np.minimum(i + k, len(name) - 1)]
            mark, name = mark[i], new
            low[mark], high[mark] = -far, far
        right = (mix(name + U(0x632BE59BD9B4E019 * (r + 1) % 2**64)) & U(1)).astype(bool)
        left = ~right & ~mark
        right &= ~mark
        pair = np.zeros(len(name), bool)
        pair[:-1] = left[:-1] & right[1:]
        second = np.zeros(len(name), bool)
        second[1:] = pair[:-1]
        # a left symbol depends on what follows it, a single right symbol on what stands before it
        new_high, new_low = high.copy(), low.copy()
        np.copyto(new_high[:-1], high[1:], where=left[:-1])
        np.copyto(new_low[1:], low[:-1], where=(right & ~second)[1:])
        new = name.copy()
        p = np.flatnonzero(pair)
        new[p] = mix(name[p] * U(0xA0761D6478BD642F) + mix(name[p + 1] + U(r + 1)))
        keep = np.flatnonzero(~second)
        name, low, high, mark = new[keep], new_low[keep], new_high[keep], mark[keep]
        yield name, low, high


def window_names(h: np.ndarray, doc: np.ndarray, width: int = WIDTH, n_rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows and the name of each window's anchor."""
    last = len(h) - width + 1
    if last <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U)
    at = np.flatnonzero(doc[:last] == doc[width - 1 :])
    low, high, level = at.copy(), at + width, np.zeros(len(at), U)
    levels = []
    for symbol, lo, hi in rounds(h, doc, n_rounds):
        fits = np.flatnonzero(hi - lo <= min(REACH, width))
        if not len(fits):
            break
        levels.append((lo[fits], hi[fits], mix(symbol[fits])))
    left = np.arange(len(at))  # windows that no higher round has an anchor for
    for r in range(len(levels), 0, -1):
        lo, hi, order = levels[r - 1]
        # lo and hi ascend: symbols j..k-1 lie inside the window
        j = np.cumsum(np.bincount(lo + 1, minlength=len(h) + 1))[at[left]]
        k = np.cumsum(np.bincount(hi, minlength=len(h) + 1))[at[left] + width]
        ok = j < k
        best = _least(order, j[ok], k[ok])
        found = left[ok]
        low[found], high[found], level[found] = lo[best], hi[best], r
        left = left[~ok]
    return at, mix(grams(h, low, high) ^ mix((high - low).astype(U) * U(64) + level))


def _powers(base: int, n: int) -> np.ndarray:
    """The powers 0..n-1 of ``base``; those of usual lengths are kept."""
    if len(_KNOWN.get(base, ())) >= n:
        return _KNOWN[base][:n]
    out = np.full(max(n, 1 << 17), base, U)
    out[0] = 1
    out = np.multiply.accumulate(out)
    if n <= 1 << 21:
        _KNOWN[base] = out
    return out[:n]


def grams(h: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Of each range [low, high) the sum of h * power, the powers counted from the range's start."""
    total = np.zeros(len(h) + 1, U)
    np.cumsum(h * _powers(_BASE, len(h)), dtype=U, out=total[1:])
    return (total[high] - total[low]) * _powers(_INVERSE, len(h) + 1)[low]


def _least(x: np.ndarray, j: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Place of the smallest (leftmost of equals) of x[j:k] for each pair, by doubling; the last bits of a
    value give way to its place."""
    if not len(j):
        return np.zeros(0, np.int64)
    bits = len(x).bit_length()
    places = U((1 << bits) - 1)
    tables, span, most = [(x & ~places) | np.arange(len(x), dtype=U)], 1, int((k - j).max())
    while 2 * span <= most:
        t = tables[-1].copy()
        np.minimum(t[:-span], t[span:], out=t[:-span])
        tables.append(t)
        span *= 2
    e = (np.frexp(np.arange(most + 1, dtype=np.float64))[1] - 1)[k - j]
    flat, row = np.concatenate(tables), e * len(x)
    return (np.minimum(flat[row + j], flat[row + k - (1 << e)]) & places).astype(np.int64)


# ------------------------------------------------------------------- Spark
def _split(batch: pa.RecordBatch) -> Iterator[tuple[int, int, Words]]:
    data, offs = text_bytes(batch.column("text"))
    for lo, hi in pieces(offs, PIECE):
        yield lo, hi, Words(data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo])


def _ids(batch: pa.RecordBatch, lo: int, hi: int, name: str = "id") -> np.ndarray:
    return batch.column(name).slice(lo, hi - lo).to_numpy(zero_copy_only=False)


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """(values, offsets) of a column of arrays."""
    return column.flatten().to_numpy(), np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)


def _emit_names(width: int, runs: bool):
    """Names of the texts' anchors, with ``runs`` also which windows they stand for: (first << 32) | how many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, w in _split(batch):
                at, name = window_names(w.hashes(), w.doc, width)
                doc = w.doc[at]
                # neighbouring windows mostly share their anchor
                new = np.ones(len(at), bool)
                new[1:] = (name[1:] != name[:-1]) | (doc[1:] != doc[:-1])
                i = np.flatnonzero(new)
                out = {"name": signed(name[i]), "key": _ids(batch, lo, hi, "key")[doc[i]]}
                if runs:
                    out["run"] = ((at[i] - w.first[doc[i]]) << 32) | np.diff(np.append(i, len(at)))
                yield pa.record_batch({c: pa.array(v, pa.int64()) for c, v in out.items()})

    return run


def _emit_windows(width: int, places: bool):
    """The windows of documents (id, t, text, names) in the runs of ``names``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, offs = _lists(batch.column("names"))
            for lo, hi, w in _split(batch):
                asked, of = flat[offs[lo] : offs[hi]], np.repeat(np.arange(hi - lo), np.diff(offs[lo : hi + 1]))
                # two texts whose keys are equal by chance are asked for each other's runs: only what they have
                begin = np.minimum(w.first[of] + (asked >> 32), w.first[of + 1])
                end = np.minimum(begin + (asked & 0xFFFFFFFF), w.first[of + 1])
                step = np.bincount(begin, minlength=len(w) + 1) - np.bincount(end, minlength=len(w) + 1)
                at = np.flatnonzero(np.cumsum(step) > 0)
                at = at[at + width <= w.first[w.doc[at] + 1]]
                doc = w.doc[at]
                a, b = (mix(grams(w.hashes(lane), at, at + width)) for lane in (0, 1))
                out = {"w1": pa.array(signed(a), pa.int64()), "w2": pa.array((signed(b) >> 32).astype(np.int32), pa.int32()), "id": pa.array(_ids(batch, lo, hi)[doc], pa.int64())}
                if places:  # a text's mark and the window's place in one number
                    out["spot"] = pa.array(((_ids(batch, lo, hi, "t")[doc] & 0x7FFFFFFF) << 32) | (at - w.first[doc]), pa.int64())
                yield pa.record_batch(out)

    return run


def _keep(width: int, cut: bool, texts: bool):
    """doc words, removed words and what is left; ``cut``: a column ``places`` of window starts to remove."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if cut:
                flat, offs = _lists(batch.column("places"))
            for lo, hi, w in _split(batch):
                gone = np.zeros(len(w), bool)
                if cut:
                    of = np.repeat(np.arange(hi - lo), np.diff(offs[lo : hi + 1]))
                    start = flat[offs[lo] : offs[hi]] + w.first[of]
                    step = np.zeros(len(w) + 1, np.int64)
                    np.add.at(step, start, 1)
                    np.add.at(step, start + width, -1)
                    gone = np.cumsum(step[:-1]) > 0
                raw = w.data.tobytes()
                removed = np.bincount(w.doc[gone], minlength=hi - lo)
                left = []
                for d, (a, b) in enumerate(zip(w.offs[:-1].tolist(), w.offs[1:].tolist())):
                    words = raw[a:b].split()
                    if removed[d]:
                        words = [x for x, g in zip(words, gone[w.first[d] : w.first[d + 1]].tolist()) if not g]
                    left.append(b" ".join(words))
                out = {"id": pa.array(_ids(batch, lo, hi), pa.int64()), "t": pa.array(_ids(batch, lo, hi, "t"), pa.int64()), "n_words": pa.array(w.counts.astype(np.int64)), "n_removed": pa.array(removed.astype(np.int64)), "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in left])}
                if texts:
                    out["kept_text"] = pa.array([x.decode("utf-8") for x in left])
                yield pa.record_batch(out)

    return run


KEPT = "id long, t long, n_words long, n_removed long, kept_sha256 string"
NAMELESS = -(2**63)


def exact_copies(base: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, t) of the texts that a smaller id holds, too: their last symbol, the whole text, is equal."""
    whole = scratch.save(base.where("text IS NOT NULL").select("id", "t", F.md5("text").alias("whole")), "whole")
    first = scratch.save(whole.groupBy("whole").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("whole", "lo"), "wholes")
    return scratch.save(whole.join(first, "whole").where("lo < id").select("id", "t").distinct(), "copies")


def repeated_windows(spark: SparkSession, docs: DataFrame, width: int, scratch: Scratch, doc_id: str, text: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(base, copies, cuts): texts as (id, t, text), those that are whole copies of a smaller id's, and
    for the others that lose something (id, t, text, places)."""
    base = pick(docs, doc_id=doc_id, text=text).select(F.coalesce("doc_id", F.lit(NAMELESS).cast("long")).alias("id"), F.xxhash64("text").alias("t"), "text")
    copies = exact_copies(base, scratch)
    # Ids all of whose texts are copies: their windows are all held by a smaller id, so nobody else needs them.
    spent = base.select("id", "t").distinct().join(copies.withColumn("copy", F.lit(1)), ["id", "t"], "left").groupBy("id").agg(F.count("copy").alias("c"), F.count(F.lit(1)).alias("n")).where("c = n").select("id")
    spent = scratch.save(copies.join(spent, "id", "left_semi").select(F.xxhash64("id", "t").alias("key")), "spent")
    # texts are asked for one by one: those of one id or without one are told apart by their hash
    keyed = base.select("*", F.xxhash64("id", "t").alias("key"))
    texts = keyed.select("key", "text")
    shared = texts.mapInArrow(_emit_names(width, False), "name long, key long").groupBy("name").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).where("lo < hi").select("name")
    shared = scratch.save(shared, "shared")
    names = texts.mapInArrow(_emit_names(width, True), "name long, key long, run long")
    asked = scratch.save(names.join(shared, "name").groupBy("key").agg(F.collect_set("run").alias("names")), "asked")
    held = scratch.save(keyed.join(asked.join(spent, "key", "left_anti"), "key").select("id", "t", "text", "names"), "held")
    scratch.drop("shared", "asked", "whole", "wholes")
    seen = held.mapInArrow(_emit_windows(width, False), "w1 long, w2 int, id long")
    first = scratch.save(seen.groupBy("w1", "w2").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("w1", "w2", "lo"), "first")
    found = held.mapInArrow(_emit_windows(width, True), "w1 long, w2 int, id long, spot long")
    later = found.join(first, ["w1", "w2"]).where("lo < id").groupBy("id", F.shiftright("spot", 32).alias("mark")).agg(F.collect_set(F.col("spot").bitwiseAND(F.lit(0xFFFFFFFF))).alias("places"))
    later = scratch.save(later, "later")
    scratch.drop("first")
    mark = F.col("t").bitwiseAND(F.lit(0x7FFFFFFF)).alias("mark")
    return base, copies, held.select("id", "t", "text", mark).join(later, ["id", "mark"]).select("id", "t", "text", "places")


def remove_repeats(spark: SparkSession, docs: DataFrame, width: int = WIDTH, scratch: Scratch | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row."""
    scratch = scratch or Scratch(spark, "recompress")
    base, copies, cuts = repeated_windows(spark, docs, width, scratch, doc_id, text)
    changed = scratch.save(cuts.mapInArrow(_keep(width, True, False), KEPT).dropDuplicates(["id", "t"]), "changed")
    scratch.drop("held", "later")
    changed = changed.select("id", "t", F.col("n_removed").alias("r"), F.col("kept_sha256").alias("k"), F.lit(False).alias("copy"))
    gone = copies.select("id", "t", F.lit(None).cast("long").alias("r"), F.lit(None).cast("string").alias("k"), F.lit(True).alias("copy"))
    # an id may have one text that is a copy and be asked for another: the copy's line counts
    known = scratch.save(changed.join(copies, ["id", "t"], "left_anti").unionAll(gone), "known")
    whole = base.mapInArrow(_keep(width, False, False), KEPT)
    out = whole.join(known, ["id", "t"], "left")
    all_gone = F.col("copy") & (F.col("n_words") >= width)
    removed = F.when(all_gone, F.col("n_words")).otherwise(F.coalesce("r", "n_removed"))
    sha = F.when(all_gone, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.coalesce("k", "kept_sha256"))
    return out.select(F.when(F.col("id") != NAMELESS, F.col("id")).alias("doc_id"), "n_words", removed.alias("n_removed"), sha.alias("kept_sha256"))


def kept_texts(spark: SparkSession, docs: DataFrame, width: int = WIDTH, scratch: Scratch | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, kept_text): the texts that lose words, with the kept words joined by one space."""
    scratch = scratch or Scratch(spark, "recompress")
    _, copies, cuts = repeated_windows(spark, docs, width, scratch, doc_id, text)
    out = cuts.join(copies, ["id", "t"], "left_anti").mapInArrow(_keep(width, True, True), KEPT + ", kept_text string").select("id", "kept_text")
    out = out.unionAll(copies.join(pick(docs, doc_id=doc_id, text=text).select(F.coalesce("doc_id", F.lit(NAMELESS).cast("long")).alias("id"), F.xxhash64("text").alias("t"), "text"), ["id", "t"]).where(F.regexp_count("text", F.lit("[^\\x20\\x09-\\x0D]+")) >= width).select("id", F.lit("").alias("kept_text")))
    return out.select(F.when(F.col("id") != NAMELESS, F.col("id")).alias("doc_id"), "kept_text")
