"""Centroid clustering against a plain Lloyd loop in Python integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from arcweave.llm import centroids
from arcweave.llm.queries import op11_centroids

SF = "/root/testdata/sf0.001"


def brute(rows, k=40, rounds=5, dims=64):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(256 * float(x)) for x in v]))
    digest = {i: hashlib.sha256(f"2:{i}".encode()).hexdigest() if i is not None else "~" for i, _ in kept}
    centers = [v for _, v in sorted(kept, key=lambda r: (digest[r[0]], r[1]))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centers))

    for _ in range(rounds):
        own = {}
        for _, v in kept:
            own.setdefault(nearest(v)[1], []).append(v)
        centers = [[sum(x) // len(own[j]) for x in zip(*own[j], strict=True)] if j in own else c for j, c in enumerate(centers)]
    placed = [(i, *nearest(v)[::-1]) for i, v in kept]
    inertia = {}
    for _, j, d in placed:
        inertia[j] = inertia.get(j, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return [(i, j, d, inertia[j], sum(inertia.values()), sha[j]) for i, j, d in placed]


def same(got, wanted):
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(wanted, key=key)


def test_query_matches_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    same(op11_centroids(spark, SF).collect(), brute(rows))


def test_odd_rows(spark, scratch):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) for _ in range(4)], "x", 0.5) for i in range(60)]
    rows += rows[:7] + [(3, [9.0, 9.0, 9.0, 9.0], "x", 0.5), (None, [1.0, 2.0, 3.0, 4.0], "x", 0.5)]
    rows += [(70, None, "x", 0.5), (71, [1.0], "x", 0.5), (72, [1.0, None, 2.0, 3.0], "x", 0.5), (73, [], "x", 0.5)]
    rows += [(74, [float("nan"), 0.0, 0.0, 0.0], "x", 0.5), (75, [float("-inf"), 0.0, 0.0, 0.0], "x", 0.5)]
    rows += [(76, [5e6, -3e6, 0.0, 1.0], "x", 0.5), (77, [0.0] * 4, "x", 0.5)]
    schema = "vec_id long, embedding array<double>, cluster string, distance double"
    frame = spark.createDataFrame(rows, schema)
    for k in (1, 5, 200):
        got = centroids.cluster(frame, scratch, centroids=k, rounds=3, dimensions=4)
        same(got.collect(), brute([r[:2] for r in rows], k, 3, 4))
    assert centroids.cluster(frame.where("false"), scratch).collect() == []
    unnamed = spark.createDataFrame([(None, [1.0] * 4), (None, [2.0] * 4)], "vec_id long, embedding array<double>")
    same(centroids.cluster(unnamed, scratch, 2, 1, 4).collect(), brute([(None, [1.0] * 4), (None, [2.0] * 4)], 2, 1, 4))
    far = spark.createDataFrame([(1, [1e30, 0.0, 0.0, 0.0]), (2, [0.0] * 4)], "vec_id long, embedding array<double>")
    assert {r.distance for r in centroids.cluster(far, scratch, 2, 1, 4).collect()} == {0}
    with pytest.raises(Exception, match="64 bits"):
        centroids.cluster(far, scratch, 1, 0, 4).collect()


def test_search_is_exact_on_ties_and_rejects_most():
    rng = np.random.default_rng(2)
    for spread in (1, 4, 200):
        centers = rng.integers(-spread, spread + 1, (60, 16))
        centers[30:40] = centers[:10]
        points = np.concatenate([rng.integers(-spread, spread + 1, (500, 16)), centers]).astype(np.int64)
        table = ((points[:, None, :] - centers[None]) ** 2).sum(2)
        found, distance, _ = centroids.Codebook(centers.tolist()).nearest(points)
        assert (found == table.argmin(1)).all() and (distance == table.min(1)).all()
        wide = centroids.Codebook(centers.tolist()).nearest(points.astype(object))
        assert (wide[0] == found).all() and (wide[1] == distance).all()
    apart = rng.integers(-1000, 1000, (100, 1)) + rng.integers(-9, 10, (100, 16))
    points = np.repeat(apart, 20, 0) + rng.integers(-3, 4, (2000, 16))
    _, _, measured = centroids.Codebook(apart.tolist()).nearest(points.astype(np.int64))
    assert measured < 0.1 * len(points) * len(apart)
