"""Centroid clustering: the curve, the bounds, and whole results against a plain version."""

import hashlib
import itertools
import math

import numpy as np
import pytest

from roompulse.llm import zone_clusters


@pytest.mark.parametrize("dims, bits", [(1, 3), (2, 3), (3, 2), (5, 2), (2, 1)])
def test_hilbert_curve_visits_all_cells_in_single_steps(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    keys = [bytes(k) for k in zone_clusters.hilbert_keys(cells, bits)]
    assert len(set(keys)) == len(cells)
    path = cells[sorted(range(len(cells)), key=keys.__getitem__)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("size", [1, 1 << 26])
def test_bounds_never_lose_the_nearest(size):
    draw = np.random.default_rng(3)
    left = 0
    for _ in range(30):
        centre = draw.integers(-9, 9, 4)
        vectors = (draw.integers(-2, 3, (40, 4)) + centre) * size
        centroids = draw.integers(-9, 9, (25, 4)) * size
        place, distance, candidates = zone_clusters.nearest(vectors, vectors.min(axis=0), vectors.max(axis=0), centroids)
        whole = ((vectors[:, None, :] - centroids[None]) ** 2).sum(axis=2)
        assert (place == whole.argmin(axis=1)).all() and (distance == whole.min(axis=1)).all()
        left += candidates
    assert left < 30 * 25  # boxes of near vectors exclude centroids


def plain(rows, k, rounds, seed, dims):
    """Lloyd's rounds in plain whole numbers."""
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]

    def home(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(home(v)[1], []).append(v)
        for n, vs in groups.items():
            centroids[n] = [sum(c) // len(vs) for c in zip(*vs)]
    return sorted((-1 if i is None else i, home(v)[1], home(v)[0]) for i, v in kept), centroids


def test_clusters_against_a_plain_version(spark, monkeypatch):
    monkeypatch.setattr(zone_clusters, "BLOCK", 16)
    draw = np.random.default_rng(8)
    rows = [(i, [float(x) for x in draw.normal(i % 5, 0.4, 8)]) for i in range(300)]
    rows += [(i % 7, rows[0][1]) for i in range(200)]  # a hot vector, repeated ids
    odd = [None, float("nan"), float("inf"), float("-inf")]
    rows += [(None, rows[1][1]), (None, rows[2][1]), (900, None), (901, []), (902, [1.0] * 7), (903, [1.0] * 9)]
    rows += [(910 + i, [x] + [0.5] * 7) for i, x in enumerate(odd)] + [(950, [-0.0] * 8), (951, [-100.25] * 8)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5).selectExpr(
        "*", "1 AS cluster", "'x' AS key", "2 AS place", "3 AS vector", "4 AS distance", "5 AS `a.b`")
    assigned, centroids = zone_clusters.clustered(table, 12, 4, "s", dims=8)
    found = sorted((-1 if r["vec_id"] is None else r["vec_id"], r["cluster"], r["distance"]) for r in assigned.collect())
    expected, last = plain(rows, 12, 4, "s", 8)
    assert found == expected and centroids.tolist() == last
    out = zone_clusters.with_inertia(assigned, centroids).collect()
    assert len(out) == len(expected) and {r["inertia"] for r in out} == {sum(e[2] for e in expected)}
    for r in out:
        assert r["cluster_inertia"] == sum(e[2] for e in expected if e[1] == r["cluster"])
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, last[r["cluster"]])).encode()).hexdigest()


def test_clusters_of_few_vectors(spark):
    few = spark.createDataFrame([(1, [0.5, 0.5]), (2, [0.25, 1.0])], "vec_id long, embedding array<float>")
    assigned, centroids = zone_clusters.clustered(few, 40, 2, "2", dims=2)
    assert len(centroids) == 2 and {r["distance"] for r in assigned.collect()} == {0}
    assigned, centroids = zone_clusters.clustered(few.limit(0), 40, 2, "2", dims=2)
    assert len(centroids) == 0 and zone_clusters.with_inertia(assigned, centroids).count() == 0
    far = spark.createDataFrame([(1, [1e9, 0.5])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="64 bits"):
        zone_clusters.clustered(far, 1, 1, "2", dims=2)
