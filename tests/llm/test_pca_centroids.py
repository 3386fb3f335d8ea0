"""Centroid clustering against brute force over awkward vectors."""

import hashlib
import math
import random

import numpy as np
from pyspark.sql.types import ArrayType, FloatType, LongType, StringType, StructField, StructType

from tallybook.llm import pca_centroids as pc

SCHEMA = StructType([StructField("vec_id", LongType()), StructField("embedding", ArrayType(FloatType())), StructField("cluster", StringType()), StructField("q", LongType())])


def brute(rows, k, rounds, dims):
    kept = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    named = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), q) for i, q in kept if i is not None)
    cents = [q for _, q in named[:k]]
    near = lambda q: min((sum((a - b) ** 2 for a, b in zip(q, c)), n) for n, c in enumerate(cents))
    for _ in range(rounds):
        of = {}
        for _, q in kept:
            of.setdefault(near(q)[1], []).append(q)
        cents = [[sum(col) // len(of[n]) for col in zip(*of[n])] if n in of else c for n, c in enumerate(cents)]
    last = [(i, *near(q)) for i, q in kept]
    own = {}
    for _, d, c in last:
        own[c] = own.get(c, 0) + d
    sha = lambda c: hashlib.sha256(",".join(map(str, cents[c])).encode()).hexdigest()
    return sorted(((i, c, d, own[c], sum(own.values()), sha(c)) for i, d, c in last), key=str)


def awkward(dims):
    r = random.Random(3)
    centre = [[r.gauss(0, 1) for _ in range(dims)] for _ in range(5)]
    rows = [(i, [x + r.gauss(0, 0.2) for x in centre[i % 5]]) for i in range(180)]
    rows += [(500 + i, rows[7][1]) for i in range(90)]  # a third of the rows are copies
    rows += [rows[3], rows[3], (None, rows[4][1]), (None, [0.5] * dims), (600, [0.0] * dims), (601, [-1e-30] * dims), (602, [1000.0] * dims)]
    return rows + [(700, None), (701, []), (702, [1.0] * (dims - 1)), (703, [1.0] * (dims - 1) + [None]), (704, [float("nan")] + [0.0] * (dims - 1)), (705, [float("inf")] + [0.0] * (dims - 1))]


def got(spark, rows, **how):
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA).repartition(3)
    assigned, cents = pc.cluster(spark, df, **how)
    return sorted((tuple(r) for r in pc.digests(assigned, cents).collect()), key=str), assigned


def test_equals_brute_force(spark):
    for dims, leading in ((64, 16), (6, 2)):
        rows = awkward(dims)
        for k in (16, 4):
            assert got(spark, rows, k=k, dims=dims, leading=leading)[0] == brute(rows, k, 3, dims)


def test_filter_skips_most_distances(spark):
    out, assigned = got(spark, awkward(64))
    assert assigned.agg({"n_exact": "avg"}).first()[0] < 8


def test_few_and_no_vectors(spark):
    rows = awkward(64)[:5]
    assert got(spark, rows)[0] == brute(rows, 16, 3, 64)
    assert got(spark, [])[0] == []
    assert got(spark, [(None, [1.0] * 64)])[0] == []


def test_bound_holds_for_any_rotation():
    r = np.random.default_rng(2)
    q, cents = r.integers(-500, 500, (400, 8)), r.integers(-500, 500, (7, 8))
    for basis in (np.eye(8)[:, :3], np.linalg.qr(r.normal(size=(8, 8)))[0][:, :2]):
        turn = pc.Rotation(r.normal(size=8) * 100, basis)
        lead, residual = turn.split(q.astype(float))
        number, distance, _ = pc.nearest(q, lead, residual, cents, turn)
        full = ((q[:, None, :] - cents[None]) ** 2).sum(axis=2)
        assert (number == full.argmin(axis=1)).all() and (distance == full.min(axis=1)).all()
