"""Invariants of the models, the forecast, decomposition, anomalies and clusters."""

from __future__ import annotations

import numpy as np
import pytest
from conftest import week
from pyspark.sql import functions as F

from demandspark.functions.stl import loess, stl, stl_batch
from demandspark.operators import anomaly, cluster, decompose, features, models
from demandspark.operators.forecast import append_forecast, naive_forecast, recursive_forecast
from demandspark.operators.regression import grouped_ols


@pytest.fixture(scope="module")
def panel(make_weekly):
    rng = np.random.default_rng(3)
    rows = []
    for s in ("S001", "S002", "S003", "S004"):
        for p, level in (("P001", 40), ("P002", 90), ("P003", 15)):
            scale = 1 + int(s[-1]) / 10
            for i in range(130):
                season = 10 * np.sin(2 * np.pi * i / 52)
                units = max(0, int(level * scale + season + rng.normal(0, 3)))
                rows.append((s, p, i, units, {"promo": int(i % 9 == 0), "price": 10.0 + i % 5, "category": f"CAT{int(p[-1]) % 2}"}))
    return features.build_features(make_weekly(rows), ["CAT0", "CAT1"]).persist()


def test_splits(panel):
    n = panel.count()
    marked = models.split_positional(panel).persist()
    assert marked.where("is_train").count() == int(n * 0.8)
    order = F.concat_ws("|", "store_id", "product_id", "week_start")
    last = marked.where("is_train").agg(F.max(order)).first()[0]
    assert marked.where(~F.col("is_train")).agg(F.min(order)).first()[0] > last
    by_week = models.split_by_week(panel)
    ends = by_week.groupBy("is_train").agg(F.min("week_start").alias("a"), F.max("week_start").alias("b")).collect()
    spans = {r.is_train: (r.a, r.b) for r in ends}
    assert spans[True][1] < spans[False][0]
    folds = {r.fold: r.n for r in models.expanding_folds(panel).groupBy("fold").agg(F.countDistinct("week_start").alias("n")).collect()}
    weeks = panel.select("week_start").distinct().count()
    assert set(folds) == set(range(6)) and all(folds[v] == weeks // 6 for v in range(1, 6))


def test_metrics_formula(spark):
    df = spark.createDataFrame([(10, 12), (20, 18), (30, 33)], "units_sold bigint, predicted bigint")
    row = models.regression_metrics(df).first()
    y, p = np.array([10.0, 20, 30]), np.array([12.0, 18, 33])
    assert row.MAE == pytest.approx(np.abs(y - p).mean())
    assert row.RMSE == pytest.approx(np.sqrt(((y - p) ** 2).mean()))
    assert row.R2 == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert row.MAPE == pytest.approx(np.abs((y - p) / (y + 1e-6)).mean() * 100)


def test_train_select_save_and_forecast(spark, panel, tmp_path):
    columns = features.feature_columns(panel)
    trained = models.train_models(panel, {"LinearRegression": models.linear_regression(columns),
                                          "RandomForest": models.random_forest(columns, numTrees=5)})
    metrics = {r.model: r.RMSE for r in trained.metrics.collect()}
    assert trained.best_name == min(metrics, key=metrics.get)
    assert trained.scored.where("predicted < 0").count() == 0
    models.save_model(trained.best_model, f"{tmp_path}/model")
    again = models.score(models.load_model(f"{tmp_path}/model"), trained.scored.drop("predicted"))
    assert again.exceptAll(trained.scored).count() == 0

    forecast = recursive_forecast(panel, trained.best_model.transform, checkpoint_every=5).persist()
    assert forecast.count() == 12 * 12
    assert forecast.where("predicted_units < 0 OR predicted_units IS NULL").count() == 0
    a, b = forecast.alias("a"), forecast.alias("b")
    pairs = a.join(b, (F.col("a.store_id") == F.col("b.store_id")) & (F.col("a.product_id") == F.col("b.product_id"))
                   & (F.col("a.horizon_week") + 1 == F.col("b.horizon_week")))
    assert pairs.count() == 12 * 11
    assert pairs.where("b.lag_1w <> a.predicted_units").count() == 0
    assert set(columns) <= set(forecast.columns)
    assert append_forecast(panel, forecast).count() == panel.count() + forecast.count()
    assert naive_forecast(panel).count() == 12 * 12


def test_forecast_of_a_short_history(make_weekly):
    panel = make_weekly([("S001", "P001", 0, 4), ("S001", "P001", 1, 8), ("S001", "P001", 2, 6)])
    panel = panel.withColumn("cat_CAT1", F.lit(0))
    out = recursive_forecast(panel, lambda df: df.withColumn("prediction", F.col("lag_12w") + 0.5), weeks=2)
    first, second = out.orderBy("horizon_week").collect()
    assert (first.lag_1w, first.lag_3w, first.lag_4w, first.lag_12w, first.predicted_units) == (6, 4, 6, 6, 6)
    assert (first.roll_mean_2w, first.roll_max_12w, first.roll_std_12w) == (7.0, 8.0, 2.0)
    assert (second.lag_1w, second.lag_12w, second.week_start) == (6, 6.0, week(4))


def test_tree_importance(spark, panel):
    columns = features.feature_columns(panel)
    trained = models.train_models(panel, {"GradientBoosting": models.gradient_boosting(columns, maxIter=3)})
    top = models.feature_importance(trained.best_model, columns, spark).collect()
    assert len(top) == 15 and [r.importance for r in top] == sorted((r.importance for r in top), reverse=True)


def test_cross_validation(panel):
    row = models.cross_validate(panel, models.linear_regression(["lag_1w", "roll_mean_4w"])).first()
    assert row.RMSE > 0 and row.R2 > 0.5


def test_grouped_ols_equals_least_squares(spark):
    rng = np.random.default_rng(0)
    rows, want = [], {}
    for g, constant in (("a", False), ("b", True)):
        x = rng.normal(size=(60, 3)) + [0, 0, 2024]
        if constant:
            x[:, 2] = 2024
        y = x @ [-1.5, 0.3, 0.1] + rng.normal(0, 0.1, 60)
        centred = x - x.mean(0)
        beta = np.linalg.lstsq(centred, y - y.mean(), rcond=1e-10)[0]
        rest = y - y.mean() - centred @ beta
        want[g] = (beta, 1 - rest @ rest / ((y - y.mean()) ** 2).sum())
        rows += [(g, *map(float, r), float(v)) for r, v in zip(x, y)]
    df = spark.createDataFrame(rows, "g string, x1 double, x2 double, x3 double, y double")
    for r in grouped_ols(df, ["g"], "y", ["x1", "x2", "x3"], 20).collect():
        assert r.coef == pytest.approx(list(want[r.g][0]), abs=1e-8)
        assert r.r2 == pytest.approx(want[r.g][1], abs=1e-8)


def test_loess_reproduces_a_line():
    y = 3 + 0.5 * np.arange(40)
    got = loess(y[None], 9, np.arange(-1, 41), np.ones((1, 40)))[0]
    assert got == pytest.approx(3 + 0.5 * np.arange(-1, 41))


def test_stl_recovers_trend_and_season():
    i = np.arange(208)
    y = 100 + 0.5 * i + 20 * np.sin(2 * np.pi * i / 52)
    y[60] += 500
    trend, seasonal, residual = stl(y, 52)
    assert trend + seasonal + residual == pytest.approx(y)
    assert np.polyfit(i, trend, 1)[0] == pytest.approx(0.5, abs=0.02)
    assert residual[60] == pytest.approx(500, abs=5) and np.abs(np.delete(residual, 60)).max() < 5
    with pytest.raises(ValueError):
        stl(y[:100], 52)


def test_stl_in_batches_equals_one_by_one():
    rng = np.random.default_rng(2)
    for n, period in ((208, 52), (157, 52), (104, 52), (31, 7), (14, 7)):
        i = np.arange(n)
        y = 50 + rng.normal(0, 0.3, (6, 1)) * i + 9 * np.sin(2 * np.pi * i / period) + rng.normal(0, 2, (6, n))
        y[1, n // 2] += 300
        y[2] = 7.0
        y[3] = np.where(i % 5 == 0, 40.0, 0.0)
        for got, want in zip(zip(*stl_batch(y, period)), (stl(row, period) for row in y)):
            for a, b in zip(got, want):
                assert np.abs(a - b).max() < 1e-9
    with pytest.raises(ValueError):
        stl_batch(np.zeros((2, 100)), 52)


def test_series_of_many_lengths_and_a_gap(make_weekly):
    rows = [("S001", f"P{k:03d}", i, 100 + i % (7 + k)) for k in range(6) for i in range(104 + k // 2)]
    filled = decompose.gap_fill(make_weekly(rows))
    broken = filled.withColumn("units_sold", F.when((F.col("product_id") == "P003") & (F.col("week_start") == F.lit(week(9))), F.lit(None)).otherwise(F.col("units_sold")))
    parts = decompose.stl_decompose(broken).toPandas()
    assert set(parts[parts.error.notna()].product_id) == {"P003"} and "missing" in parts.error.dropna().iloc[0]
    values = filled.toPandas()
    for product, own in parts[parts.error.isna()].groupby("product_id"):
        own = own.sort_values("idx")
        want = stl(values[values.product_id == product].sort_values("week_start").units_sold.to_numpy(), 52)
        assert (own.idx == np.arange(len(own))).all() and np.abs(own.trend.to_numpy() - want[0]).max() < 1e-9


def test_stl_all_series_and_errors(make_weekly):
    rows = [("S001", "P001", i, int(100 + i / 2 + 20 * np.sin(2 * np.pi * i / 52))) for i in range(156)]
    panel = make_weekly(rows + [("S001", "P002", i, 5) for i in range(90)])
    row, = decompose.stl_all_series(panel).collect()
    assert (row.product_id, row.growth_direction) == ("P001", "Growing")
    assert row.seasonal_strength > 0.9 and row.trend_strength > 0.9 and row.trend_slope == pytest.approx(0.5, abs=0.05)
    failed = decompose.stl_decompose(decompose.gap_fill(panel)).where("error IS NOT NULL").collect()
    assert [r.product_id for r in failed] == ["P002"] and "fewer than two periods" in failed[0].error
    parts = decompose.stl_decompose(decompose.long_series(decompose.gap_fill(panel)))
    future = decompose.component_forecast(parts).orderBy("horizon_week").collect()
    truth = [100 + i / 2 + 20 * np.sin(2 * np.pi * i / 52) for i in range(156, 168)]
    assert [r.forecast for r in future] == pytest.approx(truth, abs=4)
    assert future[0].week_start == week(156)


def test_spike_is_flagged(make_weekly):
    rows = [("S001", "P001", i, 50 + i % 3) for i in range(60)]
    rows[40] = ("S001", "P001", 40, 400)
    flagged = anomaly.series_zscore(make_weekly(rows)).withColumns({"anomaly_if": F.lit(False), "if_score": F.lit(0.1)})
    row, = anomaly.combine_anomalies(flagged).where("anomaly_any").collect()
    assert (row.week_start, row.anomaly_type, row.anomaly_direction) == (week(40), "Z-Score", "Spike")
    normal = anomaly.combine_anomalies(flagged).where("NOT anomaly_any").first()
    assert normal.anomaly_type == "Normal" and normal.anomaly_direction is None


def test_isolation_forest_flags_its_share_and_the_outlier(panel):
    odd = (F.col("store_id") == "S002") & (F.col("product_id") == "P003") & (F.col("week_start") == F.lit(week(77)))
    data = panel.withColumn("units_sold", F.when(odd, 5000).otherwise(F.col("units_sold")))
    scored = anomaly.isolation_forest(data, sample_size=1024).persist()
    assert scored.count() == panel.count() and set(panel.columns) < set(scored.columns)
    assert scored.agg(F.avg(F.col("anomaly_if").cast("int"))).first()[0] == pytest.approx(0.05, abs=0.01)
    assert scored.where("units_sold = 5000").first().anomaly_if
    again = anomaly.isolation_forest(data, sample_size=1024)
    keys = ["store_id", "product_id", "week_start", "if_score"]
    assert again.select(keys).exceptAll(scored.select(keys)).count() == 0


def test_forest_sample_deals_equal_shares(spark):
    for n, size in ((5000, 64), (40, 64)):
        data = spark.range(n).withColumnRenamed("id", "k")
        drawn = anomaly.forest_sample(data, ["k"], 10, size)
        counts = drawn.groupBy("tree").agg(F.count("*").alias("n"), F.countDistinct("k").alias("d")).collect()
        assert len(counts) == 10 and all(r.n == r.d == min(size, n) for r in counts)


def test_clusters(panel):
    stores = cluster.cluster_stores(cluster.store_features(panel), tries=2).collect()
    assert len(stores) == 4 and len({r.store_id for r in stores}) == 4
    assert len({r.silhouette_score for r in stores}) == 1 and {r.cluster_label for r in stores} <= {"Cluster-1", "Cluster-2", "Cluster-3"}
    products = cluster.segment_products(cluster.product_features(panel), k=3, tries=2).collect()
    by_demand = sorted(products, key=lambda r: r.avg_demand)
    assert [r.segment_name for r in by_demand] == ["Slow Movers", "Stable Core", "High Velocity"]
    flat = cluster.pca_2d(cluster.store_features(panel)).collect()
    assert sum(r.pc1 for r in flat) == pytest.approx(0, abs=1e-9)
    assert flat[0].pc1_variance >= flat[0].pc2_variance


def test_silhouette_against_all_pairs(spark):
    rng = np.random.default_rng(8)
    x, label = rng.normal(size=(25, 2)), rng.integers(0, 3, 25)
    label[24] = 3
    distance = ((x[:, None] - x[None]) ** 2).sum(2)
    want = []
    for i in range(25):
        mine = (label == label[i]) & (np.arange(25) != i)
        if not mine.any():
            want.append(0.0)
            continue
        a = distance[i, mine].mean()
        b = min(distance[i, label == o].mean() for o in set(label) - {label[i]})
        want.append((b - a) / max(a, b))
    df = spark.createDataFrame([(i, float(p[0]), float(p[1]), int(l)) for i, (p, l) in enumerate(zip(x, label))],
                               "id int, x double, y double, label int")
    got = cluster.silhouette(df, ["x", "y"], "label").first()[0]
    assert got == pytest.approx(np.mean(want))


def test_clusters_of_known_groups(spark):
    """Well separated groups come out whole, with the silhouette of the plain operator."""
    rng = np.random.default_rng(3)
    rows = [(f"S{i}", f"n{i}", float(g * 20 + e[0]), float(g % 2 * 30 + e[1])) for i, (g, e) in
            enumerate(zip(rng.integers(0, 4, 300), rng.normal(size=(300, 2))))]
    df = spark.createDataFrame(rows, "store_id string, store_name string, a double, b double").repartition(5)
    got = cluster.cluster_stores(df, ["a", "b"], max_k=5, tries=3)
    groups = {}
    for r in got.collect():
        groups.setdefault(r.demand_cluster, set()).add(round(r.a / 20))
    assert len(groups) == 4 and sorted(min(g) for g in groups.values()) == [0, 1, 2, 3] and all(len(g) == 1 for g in groups.values())
    scaled = cluster.standardise(got, ["a", "b"])
    assert got.first().silhouette_score == pytest.approx(cluster.silhouette(scaled, ["a_z", "b_z"], "demand_cluster").first()[0])


def test_sums_of_few_and_of_many_partitions_agree(spark, monkeypatch):
    rng = np.random.default_rng(4)
    table = spark.createDataFrame([([float(a), float(b)],) for a, b in rng.normal(size=(200, 2))], "x array<double>").repartition(6)
    centres = [rng.normal(size=(k, 2)) for k in (2, 3)]
    few = cluster._sums(table, centres)
    monkeypatch.setattr(cluster, "DRIVER_PARTS", 2)
    for one, two in zip(few, cluster._sums(table, centres)):
        assert all(np.allclose(a, b) for a, b in zip(one, two))


def test_standardise_constant_column(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    assert [(r.a_z, r.b_z) for r in cluster.standardise(df, ["a", "b"]).orderBy("a").collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def test_prefix_folds_equal_separate_fits(panel):
    """Coefficients by plain least squares on each fold's training rows, predictions and metrics as the pipelines give."""
    from demandspark.operators import folds

    columns = ["lag_1w", "roll_mean_4w", "avg_price", "month_sin", "is_promo_week"]
    table, scored = folds.linear_folds(panel, columns)
    rows = models.expanding_folds(panel).select("fold", "units_sold", *columns).toPandas()
    for r in table.collect():
        train = rows[rows.fold < r.fold]
        x = np.column_stack([train[columns].to_numpy(float), np.ones(len(train))])
        want = np.linalg.lstsq(x, train.units_sold.to_numpy(float), rcond=None)[0]
        assert r.n_train == len(train)
        assert np.allclose([*r.coefficients, r.intercept], want, rtol=1e-8, atol=1e-8)
    one, two = (df.first() for df in (models.cross_validate(panel, models.linear_regression(columns)), models.regression_metrics(scored)))
    assert tuple(one) == pytest.approx(tuple(two), rel=1e-6)


def test_prefix_folds_with_dependent_inputs(spark, panel):
    from demandspark.operators import folds

    wide = panel.withColumns({"twice": F.col("lag_1w") * 2, "same": F.lit(3)})
    two, four = (folds.linear_folds(wide, c)[1].select("store_id", "product_id", "week_start", "predicted") for c in
                 (["lag_1w", "avg_price"], ["lag_1w", "twice", "avg_price", "same"]))
    assert two.exceptAll(four).count() == 0
    assert folds.linear_folds(wide.limit(0), ["lag_1w"])[0].count() == 0


def test_least_squares_facts_where_every_week_has_a_promotion(spark, make_weekly):
    """A constant input correlates with nothing, and its products repeat other inputs."""
    from demandspark.catalog import learning
    from demandspark.catalog.base import Retail
    rng = np.random.default_rng(5)
    rows = [("S001", p, i, int(rng.integers(20, 90)), {"promo": 1, "price": 10.0 + i % 5}) for p in ("P001", "P002") for i in range(90)]
    r = Retail(spark, "")
    r.panel = features.build_features(make_weekly(rows), ["CAT0"])
    got = learning.linear_regression(r).first()
    assert got.n_train + got.n_test == r.panel.count() and got.is_unbiased and got.is_orthogonal


def test_boosting_is_fitted_to_the_demand_too(spark, make_weekly, monkeypatch):
    from demandspark.catalog import learning
    from demandspark.catalog.base import Retail
    build, targets = models.gradient_boosting, []
    rng = np.random.default_rng(6)
    rows = [("S001", p, i, int(rng.integers(20, 90))) for p in ("P001", "P002") for i in range(60)]
    r = Retail(spark, "")
    r.panel = features.build_features(make_weekly(rows), ["CAT0"])
    train = models.train_models

    def watched(panel, *args):
        targets.append(panel.agg(F.sum("units_sold")).first()[0])
        return train(panel, *args)

    monkeypatch.setattr(models, "train_models", watched)
    monkeypatch.setattr(models, "gradient_boosting", lambda columns: build(columns, maxIter=3, maxDepth=2))
    got = learning.gradient_boosting(r).first()
    test = models.split_by_week(r.panel).where("NOT is_train").select("units_sold", "lag_1w").toPandas()
    assert got.n_test == len(test) and got.beats_lag
    assert got.lag_rmse == pytest.approx(float(np.sqrt(((test.units_sold - test.lag_1w) ** 2).mean())), abs=1e-4)
    assert r.panel.agg(F.sum("units_sold")).first()[0] in targets and len(targets) == 2
