"""Near-duplicate classes: SuperMinHash signatures, banding, verification, union-find.

Every element (word shingle) of a document deals the ranks 0, 1, 2, ... to the
signature's components in the order of a random permutation of its own and adds a
random fraction; a component keeps its minimum.  Ranks of one element are
correlated, which lowers the variance, and a document stops dealing as soon as no
component can improve.

Documents with the same word sequence form one class before anything is
compared.  Class representatives meet in band buckets.  No bucket emits all its
pairs: in each round a few hubs (1, 16, 256, ... by position) are compared with the
bucket's later members that are not yet in the hub's component, have met the hub in no
other bucket (each pair has one bucket: that of its smallest common key) and whose sizes and
sketches (four bits of each component) allow the link, exact Jaccard is computed on the full shingle sets, and the true links go into a distributed
union-find (large star / small star, one step a round, run to its end after the last).
Rounds go on until every pair of a bucket has been compared or has one label, so no
bucket and no candidate is capped.

Defined cases: null, empty and blank texts have an empty set and are linked with
nothing; fewer than ``k`` words count as one shingle; rows with equal ``doc_id``
are one node, and each row gets the component of its own text's class; a null
``doc_id`` is a node that sorts first; no rows give no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .frames import Scratch, any_rows, pick
from .words import U, Words, mix, pieces, signed, text_bytes

SIZE = 512  # components
ROWS = 7  # components of a band
BANDS = SIZE // ROWS
CHUNK = 1 << 15  # elements whose permutations are held at once


def shingles(w: Words, h: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, name) of all shingles; a document of fewer than k words is one shingle."""
    from .words import windows

    at, name = windows(h, w.doc, k)
    doc = w.doc[at]
    short = np.flatnonzero((w.counts > 0) & (w.counts < k))
    if len(short):
        acc = w.counts[short].astype(U) * U(0xE7037ED1A0B428DB)
        for j in range(k - 1):
            more = w.counts[short] > j
            acc[more] = mix(acc[more] * U(0x8EBC6AF09C88C6E3) + h[w.first[:-1][short][more] + j])
        doc, name = np.concatenate([doc, short]), np.concatenate([name, mix(acc)])
    return doc, name


def distinct_shingles(w: Words, h: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted by (document, name), each once."""
    doc, name = shingles(w, h, k)
    order = np.lexsort((name, doc))
    doc, name = doc[order], name[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (name[1:] != name[:-1])
    return doc[new], name[new]


def signatures(doc: np.ndarray, name: np.ndarray, n_docs: int, size: int = SIZE) -> np.ndarray:
    """n_docs x size SuperMinHash values as integers: rank << 32 | fraction."""
    worst = U(0xFFFFFFFFFFFFFFFF)
    sig = np.full((n_docs, size), worst, U)
    flat = sig.reshape(-1)
    # Documents are dealt in runs, so that an element's permutation (two bytes a component) stays in cache.
    first = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=n_docs))]) if n_docs else np.zeros(1, np.int64)
    lo = 0
    while lo < n_docs:
        hi = max(lo + 1, int(np.searchsorted(first, first[lo] + CHUNK, "right")) - 1)
        _deal(flat, doc[first[lo] : first[hi]], name[first[lo] : first[hi]], lo, hi, size)
        lo = hi
    return sig


def _deal(flat: np.ndarray, doc: np.ndarray, name: np.ndarray, lo: int, hi: int, size: int) -> None:
    sig = flat.reshape(-1, size)
    live, perm, state = np.arange(len(doc)), None, name.copy()
    for j in range(size):
        if not len(live):
            return
        state = mix(state + U(0x9E3779B97F4A7C15))
        k = (((state >> U(40)) * U(size - j)) >> U(24)).astype(np.int64) + j
        if perm is None:
            comp = k
        else:
            rows = np.arange(len(live))
            comp = perm[rows, k].astype(np.int64)
            perm[rows, k] = perm[rows, j]
        value = (U(j) << U(32)) | (state & U(0xFFFFFFFF))
        np.minimum.at(flat, doc[live] * size + comp, value)
        # A document goes on while some component is above all the next rank can give.
        open_ = sig[lo:hi].max(axis=1) >= (U(j + 1) << U(32))
        go = open_[doc[live] - lo]
        if perm is None:
            kept = np.flatnonzero(go)
            perm = np.empty((len(kept), size), np.uint16)
            perm[:] = np.arange(size, dtype=np.uint16)
            perm[np.arange(len(kept)), k[kept]] = 0
        elif not go.all():
            perm = perm[go]
        live, state = live[go], state[go]


def band_keys(sig: np.ndarray, rows: int = ROWS) -> np.ndarray:
    bands = sig.shape[1] // rows
    acc = np.broadcast_to(np.arange(1, bands + 1, dtype=U) * U(0xA0761D6478BD642F), (sig.shape[0], bands)).copy()
    for r in range(rows):
        acc = mix(acc * U(0x8EBC6AF09C88C6E3) + sig[:, r : bands * rows : rows])
    return acc


SIGNED = "doc_id long, t long, s1 long, s2 long, n_shingles long, bands array<long>, sketch array<long>"


def sketches(sig: np.ndarray) -> np.ndarray:
    """Four bits of each component, 16 components a word."""
    low = (mix(sig) & U(15)).reshape(len(sig), sig.shape[1] // 16, 16)
    return np.bitwise_or.reduce(low << (U(4) * np.arange(16, dtype=U)), axis=2)


def alike(a, b, percent: int):
    """Condition on two sketches: as many equal components as a pair at the limit has but for one in
    some hundred thousand (4.5 standard deviations below the mean); the full sets decide afterwards."""
    p = percent / 100 + (1 - percent / 100) / 16
    least = int(SIZE * p - 4.5 * (SIZE * p * (1 - p)) ** 0.5)

    def unequal(x, y):
        d = x.bitwiseXOR(y)
        d = d.bitwiseOR(F.shiftrightunsigned(d, 2))
        d = d.bitwiseOR(F.shiftrightunsigned(d, 1))
        return F.bit_count(d.bitwiseAND(F.lit(0x1111111111111111)))

    return F.aggregate(F.zip_with(a, b, unequal), F.lit(0), lambda n, x: n + x) <= SIZE - least


def _sign(k: int, lower: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = text_bytes(batch.column("text"))
            for lo, hi in pieces(offs):
                w = Words(data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo], lower=lower)
                doc, name = distinct_shingles(w, w.hashes(), k)
                sig = signatures(doc, name, hi - lo)
                keys = signed(band_keys(sig).reshape(-1))
                n = np.bincount(doc, minlength=hi - lo).astype(np.int64)
                counts = np.where(n > 0, BANDS, 0)
                raw = w.data.tobytes()
                ident = np.frombuffer(b"".join(hashlib.blake2b(b" ".join(raw[a:b].split()), digest_size=16).digest() for a, b in zip(w.offs[:-1].tolist(), w.offs[1:].tolist())), "<i8").reshape(-1, 2)
                yield pa.record_batch({
                    "doc_id": batch.column("doc_id").slice(lo, hi - lo), "t": batch.column("t").slice(lo, hi - lo), "s1": pa.array(ident[:, 0]), "s2": pa.array(ident[:, 1]), "n_shingles": pa.array(n),
                    "bands": pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(keys.reshape(-1, BANDS)[n > 0].reshape(-1))),
                    "sketch": pa.ListArray.from_arrays(pa.array(np.arange(hi - lo + 1) * (SIZE // 16), pa.int32()), pa.array(signed(sketches(sig).reshape(-1)))),
                })

    return run


def _verify(k: int, lower: bool, percent: int):
    """Pairs with both texts -> the pairs with 100 * |A & B| >= percent * |A | B|."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = []
            whole = [text_bytes(batch.column(c)) for c in ("text_a", "text_b")]
            for lo, hi in pieces(whole[0][1] + whole[1][1]):
                sides = []
                for data, offs in whole:
                    w = Words(data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo], lower=lower)
                    sides.append(distinct_shingles(w, w.hashes(), k))
                doc = np.concatenate([s[0] for s in sides])
                name = np.concatenate([s[1] for s in sides])
                order = np.lexsort((name, doc))
                doc, name = doc[order], name[order]
                both = np.bincount(doc[1:][(doc[1:] == doc[:-1]) & (name[1:] == name[:-1])], minlength=hi - lo)
                total = np.bincount(doc, minlength=hi - lo)
                ok = (100 * both >= percent * (total - both)) & (both > 0)
                yield pa.record_batch({c: batch.column(c).slice(lo, hi - lo).filter(pa.array(ok)) for c in ("a", "b")})

    return run


def star(edges: DataFrame, scratch: Scratch, tag: str) -> DataFrame:
    """One large-star and one small-star step on edges (u, v) with u > v; what was connected stays so.

    Each step is a partial aggregate (smallest neighbour) and a join with it; the aggregate is
    read back from the shared folder, so a node with very many links is split by the adaptive
    skew join."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = scratch.save(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), f"{tag}-m")
    large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = scratch.save(large.where("u != v").distinct(), f"{tag}-l")
    down = scratch.save(large.groupBy("u").agg(F.min("v").alias("m")), f"{tag}-d")
    small = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").unionAll(down.select("u", F.col("m").alias("v")))
    out = scratch.save(small.distinct(), f"{tag}-e")
    scratch.drop(f"{tag}-m", f"{tag}-l", f"{tag}-d")
    return out


def connected(edges: DataFrame, scratch: Scratch, tag: str) -> DataFrame:
    """(node, component) of the larger nodes on ``edges`` (u, v), u > v; component: smallest node.
    The smallest node of a component is not listed.  Steps go on until the edges stay as they are."""
    i, last = 0, _state(edges)
    while True:
        edges = star(edges, scratch, f"{tag}{i}")
        now = _state(edges)
        if i:
            scratch.drop(f"{tag}{i - 1}-e")
        if now == last:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        i, last = i + 1, now


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())


#: The node of a null id: before all others.
NAMELESS = -(2**63)


def classes(spark: SparkSession, docs: DataFrame, k: int = 5, percent: int = 75, lower: bool = True, scratch: Scratch | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row, and t, a hash of the text.  The true links between different texts stay in ``links<round>``."""
    scratch = scratch or Scratch(spark, "superminhash")
    node = F.coalesce("doc_id", F.lit(NAMELESS).cast("long"))
    base = pick(docs, doc_id=doc_id, text=text)
    marked = scratch.save(base.withColumn("t", F.xxhash64("text")).mapInArrow(_sign(k, lower), SIGNED), "signed")
    reps = scratch.save(marked.where("n_shingles > 0").groupBy("s1", "s2").agg(F.min(node).alias("id"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")), "reps")
    met = reps.select("id", "n", F.explode("bands").alias("key"))
    shared = scratch.save(met.groupBy("key").agg(F.count(F.lit(1)).alias("g")).where("g > 1").select("key"), "shared")
    members = scratch.save(met.join(shared, "key").select("key", "id", "n"), "members")
    asked = members.select("id").distinct()
    texts = scratch.save(base.withColumn("id", node).join(asked, "id", "left_semi").select("id", "text"), "texts")
    drawn = scratch.save(reps.join(asked, "id", "left_semi").groupBy("id").agg(*[F.when(F.count(F.lit(1)) == 1, F.first(c)).alias(c) for c in ("sketch", "bands")]), "drawn")  # an id with several texts has none
    todo, label, edges = members, None, None
    round_ = 0
    while True:
        cur = todo.withColumn("comp", F.col("id"))
        if label is not None:
            cur = todo.join(label, todo["id"] == label["node"], "left").select("key", "id", "n", F.coalesce("component", "id").alias("comp"))
        open_ = scratch.save(cur.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo != hi").select("key"), f"open{round_}")
        if not any_rows(open_):
            break
        live = scratch.save(cur.join(open_, "key").join(drawn, "id"), f"live{round_}")
        if round_:
            scratch.drop(f"live{round_ - 1}", f"hubs{round_ - 1}")
        # The first members of each bucket are its hubs; the limit is taken in each task before rows move.
        ranked = live.withColumn("r", F.row_number().over(Window.partitionBy("key").orderBy("id"))).where(F.col("r") <= (1 << 4 * round_))
        hubs = scratch.save(ranked.select("key", F.col("id").alias("hub"), F.col("n").alias("hub_n"), F.col("comp").alias("hub_comp"), F.col("sketch").alias("hub_sketch"), F.col("bands").alias("hub_bands")), f"hubs{round_}")
        # Two documents share many buckets; they are compared in the one of the smallest key only.
        here = F.coalesce(F.array_min(F.array_intersect("bands", "hub_bands")) == F.col("key"), F.lit(True))
        pairs = live.join(hubs, "key").where((F.col("id") > F.col("hub")) & (F.col("comp") != F.col("hub_comp")) & (100 * F.least("n", "hub_n") >= percent * F.greatest("n", "hub_n")) & F.coalesce(alike(F.col("sketch"), F.col("hub_sketch"), percent), F.lit(True)) & here)
        pairs = scratch.save(pairs.select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct(), f"pairs{round_}")
        with_a = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
        with_b = with_a.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
        new = scratch.save(with_b.select("a", "b", "text_a", "text_b").mapInArrow(_verify(k, lower, percent), "a long, b long").distinct(), f"links{round_}")
        if any_rows(new):
            # One step a round: nodes with one label are connected, which is all that pruning needs.
            new = new.select(F.col("b").alias("u"), F.col("a").alias("v"))
            edges = star(new if edges is None else edges.unionAll(new), scratch, f"round{round_}")
            label = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
        # Hubs have met every later member; the rest of the bucket goes on.
        todo = live.select("key", "id", "n").join(hubs.select("key", F.col("hub").alias("id")), ["key", "id"], "left_anti")
        scratch.drop(f"open{round_}", f"pairs{round_}", *([] if round_ else ["members", "shared"]))
        round_ += 1
    if edges is not None:
        label = connected(edges, scratch, "classes")
    own = reps.select("s1", "s2", "id")
    if label is not None:
        own = own.join(label, own["id"] == label["node"], "left").select("s1", "s2", F.coalesce("component", "id").alias("id"))
    own = scratch.save(own, "classes")
    scratch.drop("texts", "drawn")
    out = marked.select("doc_id", "t", "n_shingles", "s1", "s2").join(own, ["s1", "s2"], "left")
    component = F.when(F.col("id").isNull(), F.col("doc_id")).when(F.col("id") != NAMELESS, F.col("id"))
    out = out.withColumn("component_id", component)
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "t")
