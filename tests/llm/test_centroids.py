"""Operator 11 against a plain version: all distances in Python integers."""

from __future__ import annotations

import hashlib
import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakebars.llm import centroids
from tests.llm.test_operators import SF, data, same

VECTORS = "vec_id long, embedding array<float>, cluster long, distance string"


def plain(rows, k=40, rounds=5, dim=64):
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in e]) for i, e in rows
            if e is not None and len(e) == dim and all(x is not None and math.isfinite(x) for x in e)]
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    order = sorted(kept, key=lambda r: (r[0] is None, digest(f"2:{r[0]}"), r[1]))
    at = [v for _, v in order[:k]]

    def assign():
        return [min((sum((x - y) ** 2 for x, y in zip(v, c)), j) for j, c in enumerate(at)) for _, v in kept]

    for _ in range(rounds):
        members: dict = {}
        for (_, j), (_, v) in zip(assign(), kept):
            members.setdefault(j, []).append(v)
        at = [[sum(x) // len(members[j]) for x in zip(*members[j])] if j in members else c for j, c in enumerate(at)]
    found = assign()
    inertia: dict = {}
    for d, j in found:
        inertia[j] = inertia.get(j, 0) + d
    return [(i, j, d, inertia[j], sum(inertia.values()), digest(",".join(map(str, at[j]))))
            for (i, _), (d, j) in zip(kept, found)]


def got(spark, rows, **params):
    frame = spark.createDataFrame([(i, e, 7, "x") for i, e in rows], VECTORS)
    out = centroids.cluster_vectors(frame, **params)
    return [tuple(r) for r in out.withColumn("c", centroids.centroid_digest(F.col("centroid"))).drop("centroid").collect()]


def clustered(n=300, dim=64, seed=4):
    rng = np.random.default_rng(seed)
    around = rng.normal(size=(12, dim))
    return [(int(i), (around[rng.integers(12)] + 0.2 * rng.normal(size=dim)).astype(np.float32).tolist()) for i in range(n)]


@pytest.mark.parametrize("k, rounds", [(40, 5), (3, 2)])
def test_clusters(spark, k, rounds):
    rows = clustered()
    bad = [None, [], [1.0] * 63, [1.0] * 65, [None] + [1.0] * 63, [float("nan")] * 64, [float("inf")] + [0.0] * 63]
    rows += [(500 + i, e) for i, e in enumerate(bad)]
    rows += rows[:5] + [(rows[6][0], rows[7][1]), (None, rows[8][1]), (None, [0.0] * 64), (600, [0.0] * 64)]
    rows += [(700 + i, rows[9][1]) for i in range(100)]          # a group of copies
    same(got(spark, rows, k=k, rounds=rounds), plain(rows, k=k, rounds=rounds))


def test_ties_and_few_vectors(spark):
    corner = [[float(x == j) for x in range(64)] for j in range(4)]
    rows = [(i, corner[i % 4]) for i in range(9)] + [(20, [0.0] * 64)]
    same(got(spark, rows, k=6, rounds=3), plain(rows, k=6, rounds=3))
    same(got(spark, rows[:2]), plain(rows[:2]))
    assert got(spark, []) == [] and got(spark, [(1, None)]) == []


def test_other_sizes(spark):
    rows = [(i, e[:5]) for i, e in clustered(60)]
    same(got(spark, rows, k=4, dim=5), plain(rows, k=4, dim=5))
    with pytest.raises(Exception, match="too large"):
        got(spark, [(1, [1e30] * 64)])


def test_filter_is_a_lower_bound_and_filters():
    """Bounds never exceed a distance, and most centroids of clustered vectors are never verified."""
    v = np.floor(256 * np.array([e for _, e in clustered(2000)])).astype(np.int64)
    turn = centroids.Rotation(v.mean(0), np.cov(v.T, bias=True))
    at = v[:40]
    lead, rest = turn(v)
    exact = ((v[:, None, :] - at) ** 2).sum(2)
    assert (centroids.lower_bounds(lead, rest, *turn(at)) <= exact).all()
    best, least, verified = centroids.nearest(v, lead, rest, at, *turn(at))
    assert (best == exact.argmin(1)).all() and (least == exact.min(1)).all()
    assert 1 <= turn.lead < 20 and verified < 0.25 * exact.size


@data
def test_tables(spark):
    rows = [(r[0], r[1]) for r in spark.read.parquet(os.path.join(SF, "embeddings.parquet")).select("vec_id", "embedding").collect()]
    same(got(spark, rows), plain(rows))
