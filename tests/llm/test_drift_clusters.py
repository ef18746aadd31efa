from __future__ import annotations

import hashlib

import numpy as np
import pytest

from demandspark.llm import drift_clusters as dc


def brute(vectors, k, rounds, scale=1024, seed="3:"):
    """Plain rounds over (id, integer vector); centroids start by hash."""
    q = [(i, [int(np.floor(scale * float(np.float32(x)))) for x in v]) for i, v in vectors]
    order = sorted(q, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centroids = [np.array(v, dtype=object) for _, v in order[:k]]

    def assign():
        out = []
        for _, v in q:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        found = assign()
        for c in range(len(centroids)):
            own = [np.array(v, dtype=object) for (_, v), (at, _) in zip(q, found) if at == c]
            if own:
                centroids[c] = np.array([s // len(own) for s in sum(own)], dtype=object)
    found = assign()
    inertia = [sum(d for at, d in found if at == c) for c in range(len(centroids))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted([(i, c, d, inertia[c], sum(inertia), digest[c]) for (i, _), (c, d) in zip(q, found)], key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 7) for i, v in rows], "vec_id long, embedding array<float>, cluster string, block int")


def drawn(n, dim, seed, groups=4):
    rng = np.random.default_rng(seed)
    means = rng.normal(size=(groups, dim))
    return [(int(i), (means[rng.integers(groups)] + 0.4 * rng.normal(size=dim)).astype(np.float32).tolist()) for i in range(n)]


@pytest.mark.parametrize("dim,k", [(3, 4), (5, 1)])
def test_equals_plain_rounds(spark, dim, k):
    rows = drawn(300, dim, 1)
    rows += [rows[0], (5, rows[7][1]), (None, rows[9][1]), (None, [0.0] * dim), (900, [0.0] * dim), (901, [-0.0] * dim), (902, [-0.0001] * dim)]
    bad = [(1000, None), (1001, []), (1002, [1.0] * (dim - 1) + [None]), (1003, [float("nan")] * dim), (1004, [float("inf")] * dim), (1005, [1.0] * (dim + 1))]
    got = dc.cluster_vectors(frame(spark, rows + bad).repartition(3), k=k, rounds=6, dim=dim, block_rows=64).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, k, 6)


def test_few_equal_and_no_vectors(spark):
    same = [(i, [0.5, 0.25]) for i in range(6)]
    assert sorted(map(tuple, dc.cluster_vectors(frame(spark, same), k=3, rounds=2, dim=2).collect())) == brute(same, 3, 2)
    two = [(1, [0.5, 0.25]), (2, [1.0, 2.0])]
    assert sorted(map(tuple, dc.cluster_vectors(frame(spark, two), k=5, rounds=2, dim=2).collect())) == brute(two, 5, 2)
    none = dc.cluster_vectors(frame(spark, [(1, [1.0])]), dim=2)
    assert none.count() == 0 and none.columns == dc.cluster_vectors(frame(spark, two), k=1, rounds=1, dim=2).columns


def test_parts_too_large_raise(spark):
    with pytest.raises(Exception, match="beyond"):
        dc.cluster_vectors(frame(spark, [(1, [1e6, 0.0])]), dim=2).collect()


def test_bounds_settle_most_vectors(spark):
    rows = dc.integer_vectors(frame(spark, drawn(2000, 8, 3, groups=6)), dim=8)
    start = dc.first_centroids(rows, 6)
    _, _, scanned = dc.lloyd(rows, start, rounds=8, block_rows=256)
    assert scanned[0] == 2000 and scanned[-1] < 200


def test_no_point_of_the_sphere_gains_more_than_the_loosening():
    rng = np.random.default_rng(4)
    tighter = 0
    for _ in range(300):
        dim = int(rng.integers(2, 6))
        old = rng.normal(size=(3, dim)) * 5
        new = old + rng.normal(size=(3, dim)) * rng.choice([0.1, 1, 4])
        radius = rng.uniform(0.01, 6, 3)
        loose, drift = dc.loosening(old, new, radius), np.linalg.norm(new - old, axis=1)
        for i in range(3):
            rays = rng.normal(size=(400, dim))
            x = old[i] + rays / np.linalg.norm(rays, axis=1)[:, None] * radius[i] * rng.uniform(0, 1, (400, 1)) ** (1 / dim)
            for j in set(range(3)) - {i}:
                gain = np.linalg.norm(x - old[j], axis=1) - np.linalg.norm(x - new[j], axis=1)
                assert gain.max() <= loose[i] + 1e-9
            others = np.delete(drift, i).max()
            assert loose[i] <= others + 1e-12
            tighter += loose[i] < 0.9 * others
    assert tighter > 200


def test_same_result_twice_and_no_tables_left(spark):
    rows = drawn(100, 4, 9)
    a, b = (sorted(map(tuple, dc.cluster_vectors(frame(spark, rows), k=3, rounds=3, dim=4).collect())) for _ in range(2))
    assert a == b and not [t for t in spark.catalog.listTables() if t.name.startswith("drift_")]
