"""Centroid clustering of vectors with a PCA-rotated filter and integer verification.

Vectors become integers, ``floor(scale * x)``.  One pass over all of them sums the second
moments, whose eigenvectors are the rotation; each vector is then stored once with its
integers, its leading rotated coordinates and its residual norm (what the left-out
coordinates hold).  For a vector ``v`` and a centroid ``c`` the squared distance is at least

    |lead(v) - lead(c)|^2 + (residual(v) - residual(c))^2

so a round takes the centroid of the smallest bound, computes its distance in 64-bit
integers, and computes those of the other centroids only where their bound, less a slack for
floating-point rounding, does not exceed it.  The result is that of comparing every vector
with every centroid in integers, ties to the smaller number; the rotation only decides how
much of that is skipped.

A round is one pass over the stored vectors: a task adds up its vectors of each cluster and
sends ``k * dims`` sums, which Spark adds up again.  Only ``k * dims`` numbers and the
``dims * dims`` moments come to the driver.  No step groups rows by a value of theirs, so
repeated vectors, however many, stay spread over the tasks of the scan.

Defined cases: a null or empty vector, one of another length and one with a null or
non-finite component are left out, and so is one with a component of 2**20 or more in size,
whose squared distance would not fit a long; repeated rows are vectors like any other; of
equal ids the first in component order starts as the earlier centroid; a null id never
starts one; with fewer than ``k`` vectors each starts a centroid; no vectors give no rows;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import Scratch, pick

LIMIT = 1 << 20
STORED = "vec_id long, q array<int>, lead array<float>, residual float"
#: Vectors handled at once inside a task.
BLOCK = 4096


class Rotation(NamedTuple):
    mean: np.ndarray
    basis: np.ndarray  # dims x leading coordinates

    def split(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leading rotated coordinates and residual norm, as stored (32 bits)."""
        x = q - self.mean
        lead = x @ self.basis
        rest = np.maximum((x * x).sum(axis=1) - (lead * lead).sum(axis=1), 0.0)
        return lead.astype(np.float32), np.sqrt(rest).astype(np.float32)


def _matrix(column: pa.Array, dtype: type) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(dtype, copy=False)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo in range(0, b.num_rows, BLOCK):
            yield b.slice(lo, BLOCK)


def quantise(vectors: DataFrame, dims: int = 64, scale: int = 64) -> DataFrame:
    """vec_id and q, the integers of every vector that is kept."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    fine = F.forall("embedding", lambda v: F.coalesce(F.abs(v.cast("double")) < LIMIT, F.lit(False)))
    ints = F.transform(x, lambda v: F.floor(v * F.lit(float(scale))).cast("int"))
    # null, NaN and infinite components fail the comparison with LIMIT (NaN is above all numbers)
    return vectors.where((F.size("embedding") == dims) & fine).select(F.col("vec_id").cast("long").alias("vec_id"), ints.alias("q"))


def moments(kept: DataFrame, dims: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Number, sum and summed outer products of all vectors: dims * (dims + 1) numbers at the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros((dims + 1, dims))
        for b in _blocks(batches):
            q = _matrix(b.column(0), np.float64)
            n += len(q)
            total[0] += q.sum(axis=0)
            total[1:] += q.T @ q
        if n:
            flat = np.append(total.ravel(), n)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], ["pos", "s"])

    rows = kept.select("q").mapInArrow(add, "pos int, s double").groupBy("pos").agg(F.sum("s").alias("s")).collect()
    flat = np.zeros((dims + 1) * dims + 1)
    for r in rows:
        flat[r.pos] = r.s
    return int(flat[-1]), flat[:dims], flat[dims:-1].reshape(dims, dims)


def rotation(n: int, total: np.ndarray, outer: np.ndarray, leading: int) -> Rotation:
    mean = total / max(n, 1)
    values, vectors = np.linalg.eigh(outer / max(n, 1) - np.outer(mean, mean))
    return Rotation(mean, np.ascontiguousarray(vectors[:, np.argsort(-values)[:leading]]))


def store(kept: DataFrame, turn: Rotation) -> DataFrame:
    """The filter's table: integers, leading rotated coordinates and residual norm of each vector."""

    def rotate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _blocks(batches):
            lead, residual = turn.split(_matrix(b.column(1), np.float64))
            at = pa.array(np.arange(len(lead) + 1, dtype=np.int32) * lead.shape[1])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.ListArray.from_arrays(at, pa.array(lead.ravel())), pa.array(residual)], ["vec_id", "q", "lead", "residual"])

    return kept.select("vec_id", "q").mapInArrow(rotate, STORED)


def nearest(q: np.ndarray, lead: np.ndarray, residual: np.ndarray, centroids: np.ndarray, turn: Rotation) -> tuple[np.ndarray, np.ndarray, int]:
    """(cluster, squared distance) of each row, and how many distances were computed in integers."""
    q = q.astype(np.int64)
    c_lead, c_residual = turn.split(centroids.astype(np.float64))
    a, b = lead.astype(np.float64), c_lead.astype(np.float64)
    bound = ((a[:, None, :] - b[None, :, :]) ** 2).sum(axis=2) + (residual.astype(np.float64)[:, None] - c_residual.astype(np.float64)[None, :]) ** 2
    # what 32-bit storage and the sums can be off by, relative to the lengths involved
    reach = (a * a).sum(axis=1) + residual.astype(np.float64) ** 2
    slack = 1e-5 * (reach[:, None] + (b * b).sum(axis=1) + c_residual.astype(np.float64) ** 2) + 1e-3 * (1 + np.abs(turn.mean).max(initial=0.0))
    row, guess = np.arange(len(q)), bound.argmin(axis=1)

    def exact(rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
        d = q[rows] - centroids[cols]
        return (d * d).sum(axis=1)

    first = exact(row, guess)
    open_ = bound - slack <= first[:, None]
    open_[row, guess] = False
    rows, cols = np.nonzero(open_)
    # the smallest distance, then the smallest number, of the guess and what survives
    best, cluster = first.copy(), guess.copy()
    done = len(q)
    if len(rows):
        d = exact(rows, cols)
        done += len(d)
        full = np.full(bound.shape, np.iinfo(np.int64).max)
        full[rows, cols], full[row, guess] = d, first
        cluster = full.argmin(axis=1)
        best = full[row, cluster]
    return cluster, best, done


def _read(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return _matrix(b.column("q"), np.int64), _matrix(b.column("lead"), np.float32), b.column("residual").to_numpy(zero_copy_only=False)


def moved(stored: DataFrame, centroids: np.ndarray, turn: Rotation) -> np.ndarray:
    """The centroids after one round over all vectors: exact floor(sum / count); empty ones stay."""
    k, dims = centroids.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k, dims + 1), np.int64)
        for b in _blocks(batches):
            q, lead, residual = _read(b)
            cluster, _, _ = nearest(q, lead, residual, centroids, turn)
            for c in np.unique(cluster):
                own = q[cluster == c]
                sums[c, :dims] += own.sum(axis=0)
                sums[c, dims] += len(own)
        pos = np.flatnonzero(sums.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(pos.astype(np.int32)), pa.array(sums.ravel()[pos])], ["pos", "s"])

    total = [0] * (k * (dims + 1))
    for r in stored.select("q", "lead", "residual").mapInArrow(add, "pos int, s long").groupBy("pos").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect():
        total[r.pos] = int(r.s)
    new = centroids.copy()
    for c in range(k):
        *own, n = total[c * (dims + 1) : (c + 1) * (dims + 1)]
        if n:
            new[c] = [s // n for s in own]
    return new


def seeds(kept: DataFrame, k: int, dims: int) -> np.ndarray:
    """The ``k`` vectors whose ``1:<vec_id>`` hashes first."""
    name = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    rows = kept.where("vec_id IS NOT NULL").select(name.alias("name"), "q").orderBy("name", "q").limit(k).collect()  # k rows
    return np.array([r.q for r in rows], np.int64).reshape(len(rows), dims)


def cluster(spark: SparkSession, vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, leading: int = 16, scratch: Scratch | None = None, vec_id: str = "vec_id", embedding: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance, n_exact) of every kept vector, and the final centroids.

    ``n_exact`` is the mean number of distances computed in integers a vector in its block, out of ``k``."""
    scratch = scratch or Scratch(spark, "centroids")
    kept = scratch.save(quantise(pick(vectors, vec_id=vec_id, embedding=embedding), dims, scale), "ints")
    centroids = seeds(kept, k, dims)
    turn = rotation(*moments(kept, dims), min(leading, dims))
    stored = scratch.save(store(kept, turn), "rotated")
    scratch.drop("ints")
    if not len(centroids):
        return stored.limit(0).selectExpr("vec_id", "0 AS cluster", "0L AS distance", "0D AS n_exact"), centroids
    for _ in range(rounds):
        centroids = moved(stored, centroids, turn)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _blocks(batches):
            number, distance, done = nearest(*_read(b), centroids, turn)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(number.astype(np.int32)), pa.array(distance), pa.array(np.full(len(number), done / max(len(number), 1)))], ["vec_id", "cluster", "distance", "n_exact"])

    return scratch.save(stored.mapInArrow(assign, "vec_id long, cluster int, distance long, n_exact double"), "assigned"), centroids


def digests(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """The vectors with their cluster's and the whole inertia and their centroid's hash."""
    inertia = {r.cluster: r.s for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # k rows
    if not inertia:
        return assigned.selectExpr("vec_id", "cluster", "distance", "0L AS cluster_inertia", "0L AS inertia", "'' AS centroid_sha256")
    of = [(c, int(s), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, s in sorted(inertia.items())]
    each = F.create_map(*[x for c, s, h in of for x in (F.lit(c), F.struct(F.lit(s).cast("long").alias("s"), F.lit(h).alias("h")))])
    mine = F.element_at(each, F.col("cluster"))
    return assigned.select("vec_id", "cluster", "distance", mine["s"].alias("cluster_inertia"), F.lit(sum(s for _, s, _ in of)).cast("long").alias("inertia"), mine["h"].alias("centroid_sha256"))
