"""Exact quantiles against numpy."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandspark.functions import describe
from demandspark.functions.quantiles import exact_quantiles

PROBS = [0.0, 0.05, 0.25, 0.5, 0.75, 0.99, 1.0]
CASES = {
    "continuous": lambda rng: rng.normal(size=30_011),
    "hot value": lambda rng: np.where(rng.random(25_000) < 0.4, 7.0, rng.normal(size=25_000)),
    "heavy tail": lambda rng: rng.pareto(0.7, size=20_005),
    "few values": lambda rng: rng.integers(0, 5, size=15_000).astype(float),
    "tiny": lambda rng: np.array([4.0, 1.0, 9.0]),
    "single": lambda rng: np.array([2.5]),
}


@pytest.mark.parametrize("case", CASES)
def test_exact(spark, case):
    x = CASES[case](np.random.default_rng(5))
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    row = exact_quantiles(df, ["x"], PROBS).first()
    assert row["q"] == pytest.approx(list(np.quantile(x, PROBS)), rel=1e-12, abs=1e-12)


def test_groups_of_unequal_size(spark):
    rng = np.random.default_rng(1)
    groups = {"hot": rng.normal(size=40_000), "cold": rng.normal(size=3), "mid": rng.random(500)}
    rows = [(g, float(v)) for g, values in groups.items() for v in values]
    df = spark.createDataFrame(rows, "g string, x double").withColumn("y", F.col("x") * 2)
    out = exact_quantiles(df, ["x", "y"], [0.25, 0.5], ["g"]).collect()
    assert len(out) == 6
    for r in out:
        want = np.quantile(groups[r["g"]] * (2 if r["column"] == "y" else 1), [0.25, 0.5])
        assert r["q"] == pytest.approx(list(want), rel=1e-12)


def test_nulls_are_left_out(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "x double")
    assert exact_quantiles(df, ["x"], [0.5]).first()["q"] == [2.0]


def test_every_column_and_group_has_a_row(spark):
    """A column or group without values keeps its row, beside few or very many distinct values."""
    for n in (50, 120_000):
        df = spark.range(n).select(F.col("id").cast("double").alias("x"), F.lit(None).cast("double").alias("y"),
                                   F.when(F.col("id") % 2 == 0, "a").alias("g"))
        got = {r["column"]: r["q"] for r in exact_quantiles(df, ["x", "y"], [0.5]).collect()}
        assert got == {"x": [(n - 1) / 2], "y": [None]}
        grouped = {(r["g"], r["column"]): r["q"][0] for r in exact_quantiles(df, ["x", "y"], [0.5], ["g"]).collect()}
        assert grouped == {("a", "x"): n / 2 - 1, (None, "x"): n / 2, ("a", "y"): None, (None, "y"): None}
    empty = spark.createDataFrame([], "x double, y double")
    assert {r["column"]: r["q"] for r in exact_quantiles(empty, ["x", "y"], [0.5]).collect()} == {"x": [None], "y": [None]}


def test_signs_zeros_and_infinities(spark):
    x = [-1e300, -2.0, -1.5, -1e-300, -0.0, 0.0, 1e-300, 1e-5, 3.0, float("inf")]
    df = spark.createDataFrame([(v,) for v in x], "x double")
    q = exact_quantiles(df, ["x"], [i / 9 for i in range(10)]).first()["q"]
    assert q == sorted(x)


def test_correlations_of_pairwise_complete_rows(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 3)) @ rng.normal(size=(3, 3)) + [1e6, 0, -50]
    known = rng.random((400, 3)) < 0.8
    rows = [tuple(float(v) if k else None for v, k in zip(a, b)) + (7.0, None) for a, b in zip(x, known)]
    df = spark.createDataFrame(rows, "a double, b double, c double, flat double, none double").repartition(5)
    got = {(r.row_name, r.col_name): r["corr"] for r in describe.correlations(df, df.columns).collect()}
    assert len(got) == 10
    for i, j in ((0, 1), (0, 2), (1, 2)):
        both = known[:, i] & known[:, j]
        assert got["abc"[j], "abc"[i]] == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-9)
    assert got["flat", "a"] is None and got["none", "b"] is None
    odd = spark.createDataFrame([(1.0, 2.0, 1.0), (2.0, float("nan"), 3.0), (None, float("nan"), 2.0), (4.0, 1.0, None), (5.0, 3.0, 9.0)], "a double, b double, c double")
    nan = {(r.row_name, r.col_name): r["corr"] for r in describe.correlations(odd, ["a", "b", "c"]).collect()}
    assert math.isnan(nan["b", "a"]) and nan["c", "a"] == pytest.approx(np.corrcoef([1, 2, 5], [1, 3, 9])[0, 1])
    assert [r["corr"] for r in describe.correlations(odd.limit(0), ["a", "b"]).collect()] == [None]
