from __future__ import annotations

import numpy as np

from demandspark.llm.embedding_dedup import THRESHOLD, close_pairs, near_duplicates, rotations, unit


def brute(rows, threshold=THRESHOLD):
    """Links and components by comparing every pair."""
    def ok(v):
        return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    vec = [np.array(v, dtype=np.float32).astype(float) if ok(v) else None for _, v, _ in rows]
    linked = {i: set() for i in range(len(rows))}
    for i in range(len(rows)):
        for j in range(i):
            if vec[i] is None or vec[j] is None or rows[i][2] is None or rows[i][2] != rows[j][2] or len(vec[i]) != len(vec[j]):
                continue
            if vec[i] @ vec[j] / (np.linalg.norm(vec[i]) * np.linalg.norm(vec[j])) >= threshold - 1e-15:
                linked[i].add(j), linked[j].add(i)
    out, seen = {}, set()
    for i in linked:
        if i in seen:
            continue
        part, todo = {i}, [i]
        while todo:
            new = linked[todo.pop()] - part
            part |= new
            todo += new
        seen |= part
        for k in part:
            out[rows[k][0]] = (len(linked[k]), min(rows[j][0] for j in part))
    return out


SCHEMA = "vec_id long, embedding array<float>, label int, dim string"


def check(spark, rows, **options):
    got = near_duplicates(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA), **options).collect()
    assert len(got) == len(rows)
    expected = brute(rows)
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == expected
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def clusters(n, dim=24, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    rows = []
    for i in range(n):
        v = centres[rng.integers(12)] + rng.normal(size=dim) * rng.choice([0.0, 0.15, 0.3, 1.0])
        rows.append((i, [float(x) for x in v * rng.uniform(0.1, 9)], int(rng.integers(3))))
    return rows


def test_matches_brute_force_over_many_tiles(spark):
    check(spark, clusters(240), tile_rows=16)


def test_odd_vectors_ties_and_labels(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(9, [1.0, 0.0], 1), (3, [2.0, 0.0], 1), (4, [2.0, 0.0], 2), (5, None, 1), (6, [0.0, 0.0], 1), (7, [nan, 1.0], 1),
            (8, [1.0, None], 1), (10, [inf, 1.0], 1), (11, [], 1), (12, [1.0, 0.0], None), (13, [1.0, 0.0], None),
            (14, [1.0, 0.0, 0.0], 1), (15, [1.0, 0.0], 1), (16, [1.0, -0.0], 1), (17, [-1.0, 0.0], 1), (18, [1e-30, 0.0], 1)]
    check(spark, rows)


def test_long_chain_is_one_component(spark):
    angles = np.arange(40) * 0.3
    check(spark, [(i, [float(np.cos(a)), float(np.sin(a))], 0) for i, a in enumerate(angles)], tile_rows=4)


def test_no_rows(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_bound_never_loses_a_pair():
    rng = np.random.default_rng(5)
    x = unit(rng.normal(size=(90, 32)) * np.linspace(3, 0.1, 32))
    axes = {32: np.linalg.eigh(x.T @ x)[1][:, ::-1]}
    for threshold in (0.3, 0.8, 0.93):
        assert (close_pairs(x, x, axes, threshold, step=8) == (np.einsum("id,jd->ij", x, x) >= threshold)).all()


def test_axes_need_only_a_sample(spark):
    df = spark.createDataFrame([(8, [float(i == j) + 0.01 for j in range(8)]) for i in range(8)], "dim int, vector array<double>")
    assert rotations(df, sample=3)[8].shape == (8, 8)
