"""The twins of models, forecasts, decompositions and clusters turn red when what they check is wrong."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from twins import compare, connect

from demandspark.catalog import QUERIES, SQL_TWINS, learning
from demandspark.operators import anomaly, cluster, decompose, folds, models, rollout

SF_DIR = os.environ.get("TWIN_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def zero_units(_):
    return F.lit(0).cast("bigint")


def constant_scores(monkeypatch):
    monkeypatch.setattr(models, "to_units", zero_units)


def constant_folds(monkeypatch):
    monkeypatch.setattr(folds, "to_units", zero_units)


def wrong_prefixes(monkeypatch):
    solve = folds.solve_prefixes
    monkeypatch.setattr(folds, "solve_prefixes", lambda *a: {v: (n, b * 1.001, c) for v, (n, b, c) in solve(*a).items()})


def constant_model(monkeypatch):
    def flat(*_):
        return rollout.linear_arrays({"lag_1w": 0.0}, 3.0)
    monkeypatch.setattr(rollout, "export_model", flat)
    monkeypatch.setattr(learning, "linear_arrays", flat)


def no_trend(monkeypatch):
    right = decompose.stl_decompose
    monkeypatch.setattr(decompose, "stl_decompose", lambda *a, **k: right(*a, **k).withColumns(
        {"residual": F.col("residual") + F.col("trend"), "trend": F.col("trend") * 0}))


def random_flags(monkeypatch):
    def scored(panel, **_):
        score = F.percent_rank().over(W.orderBy(F.xxhash64("store_id", "product_id", "week_start"))) - 0.05
        return panel.withColumn("if_score", score).withColumn("anomaly_if", F.col("if_score") < 0)
    monkeypatch.setattr(anomaly, "isolation_forest", scored)


def shuffled_labels(monkeypatch):
    monkeypatch.setattr(cluster, "_assign", lambda table, centres, name: table.withColumn(
        name, F.pmod(F.xxhash64("x"), F.lit(len(centres))).cast("int")))


def constant_forest(monkeypatch):
    right = models.random_forest
    monkeypatch.setattr(models, "random_forest", lambda columns, **k: right(columns, numTrees=1, maxDepth=1, featureSubsetStrategy="1"))


def stubborn_models(monkeypatch):
    monkeypatch.setattr(models, "default_models", lambda columns: {n: models.linear_regression(["month"]) for n in (
        "LinearRegression", "RandomForest", "GradientBoosting", "GradientBoostingColsample")})


@pytest.mark.parametrize("name,wrong", [
    ("scored_test_set", constant_scores), ("first_200_scored", constant_scores), ("model_metrics", constant_scores),
    ("expanding_cv_metrics", constant_folds), ("expanding_cv_coefficients", wrong_prefixes),
    ("recursive_forecast", constant_model), ("recursive_forecast_model", constant_model), ("model_inventory_chain", constant_model),
    ("stl_decompose", no_trend), ("stl_all_series", no_trend), ("isolation_forest", random_flags),
    ("product_segments", shuffled_labels), ("segment_chain", shuffled_labels), ("store_clusters", shuffled_labels),
    ("feature_importance_top15", constant_forest), ("select_best_model", stubborn_models)])
def test_twin_is_red(spark, con, monkeypatch, name, wrong):
    wrong(monkeypatch)
    _, problems = compare(QUERIES[name](spark, SF_DIR), SQL_TWINS[name], con, tolerance=1.1e-6)
    assert problems
