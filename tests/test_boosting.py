"""Boosting with columns drawn once per tree."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandspark.operators import boosting, models
from demandspark.operators.boosting import ColumnBoosting
from demandspark.operators.rollout import export_model


def frame(spark, n=3000, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 10))
    y = 10 * (x[:, 0] > 0.3) + 3 * x[:, 1] + x[:, 2] * x[:, 3] + rng.normal(0, 0.1, n)
    rows = [tuple(map(float, r)) + (float(v),) for r, v in zip(x, y)]
    return spark.createDataFrame(rows, ", ".join(f"c{i} double" for i in range(10)) + ", units_sold double").repartition(3).persist(), x, y


COLUMNS = [f"c{i}" for i in range(10)]


def used(model):
    """The columns that each tree splits on."""
    trees = model.arrays.trees
    ends = [*trees.root[1:], len(trees.feature)]
    inner = trees.left != np.arange(len(trees.left))
    return [set(trees.feature[a:b][inner[a:b]]) for a, b in zip(trees.root, ends)]


def test_two_hundred_trees_use_four_fifths_of_the_columns_each(spark):
    df, _, y = frame(spark, 800)
    model = ColumnBoosting(COLUMNS, maxDepth=3).fit(df)
    trees = used(model)
    assert len(trees) == 200 and max(map(len, trees)) <= 8 and len({frozenset(t) for t in trees}) > 50
    error = model.transform(df).select(F.avg((F.col("prediction") - F.col("units_sold")) ** 2)).first()[0]
    assert error < 0.02 * y.var()
    assert model.importances().sum() == pytest.approx(1) and model.importances()[:4].sum() > 0.6


def test_one_split_is_the_best_of_all(spark, monkeypatch):
    df, x, y = frame(spark, 500)
    model = ColumnBoosting(COLUMNS, maxIter=1, maxDepth=1, stepSize=1.0, subsamplingRate=1.0, columnRate=1.0).fit(df)
    trees = model.arrays.trees
    column, cut = int(trees.feature[0]), trees.threshold[0]
    best = 0.0
    for j in range(10):
        for c in np.quantile(x[:, j], np.arange(1, 32) / 32):
            left = x[:, j] <= c
            best = max(best, left.sum() * (y[left].mean() - y.mean()) ** 2 + (~left).sum() * (y[~left].mean() - y.mean()) ** 2)
    left = x[:, column] <= cut
    gain = left.sum() * (y[left].mean() - y.mean()) ** 2 + (~left).sum() * (y[~left].mean() - y.mean()) ** 2
    assert gain == pytest.approx(best, rel=0.02)
    got = {round(r.prediction, 6) for r in model.transform(df).select("prediction").distinct().collect()}
    assert got == {round(y[left].mean(), 6), round(y[~left].mean(), 6)}


def test_stagings_partitions_and_reruns_do_not_matter(spark, monkeypatch):
    df, _, _ = frame(spark, 1500)
    options = dict(maxIter=7, maxDepth=3, subsamplingRate=0.7)
    one = ColumnBoosting(COLUMNS, **options).fit(df).arrays.trees
    monkeypatch.setattr(boosting, "STAGE_EVERY", 2)
    monkeypatch.setattr(boosting, "DRIVER_PARTS", 2)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 100)
    two = ColumnBoosting(COLUMNS, **options).fit(df).arrays.trees
    assert (one.feature == two.feature).all() and np.allclose(one.value, two.value, atol=1e-9)
    assert np.allclose(one.threshold, two.threshold)


def test_saved_model_predicts_the_same_and_is_exported(spark, tmp_path):
    df, _, _ = frame(spark, 400)
    model = models.gradient_boosting_colsample(COLUMNS, maxIter=5, maxDepth=3).fit(df)
    models.save_model(model, f"{tmp_path}/m")
    again = models.load_model(f"{tmp_path}/m")
    assert again.transform(df).exceptAll(model.transform(df)).count() == 0
    rows = model.transform(df).toPandas()
    assert np.allclose(export_model(again, spark).predict(rows), rows["prediction"])
    names = [r.feature for r in models.feature_importance(model, COLUMNS, spark, 3).collect()]
    assert "c0" in names or "c1" in names


def test_nulls_constants_and_no_rows(spark):
    rows = [(None if i % 5 == 0 else float(i % 7), 3.0, 100.0 if i % 5 == 0 else float(i % 7)) for i in range(300)] + [(1.0, 3.0, None)]
    df = spark.createDataFrame(rows, "a double, flat double, units_sold double")
    fitted = ColumnBoosting(["a", "flat"], maxIter=60, stepSize=0.3, columnRate=1.0, subsamplingRate=1.0).fit(df)
    worst = fitted.transform(df.where("units_sold IS NOT NULL")).agg(F.max(F.abs(F.col("prediction") - F.col("units_sold")))).first()[0]
    assert worst < 0.1
    with pytest.raises(ValueError):
        ColumnBoosting(["a"]).fit(df.limit(0))
