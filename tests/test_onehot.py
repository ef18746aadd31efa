"""One-hot features for domains of any size."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from demandspark.functions.calendar import add_week_calendar, festival_flag
from demandspark.operators import features, models
from demandspark.operators.forecast import recursive_forecast


def slots(df):
    rows = df.select("category", F.col(features.CATEGORY_VECTOR).alias("v")).collect()
    return {r.category: (r.v.size, r.v.indices.tolist(), r.v.values.tolist()) if r.v.size else (0, [], []) for r in rows}


def test_vectors_match_the_columns(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("zz",), (None,), ("é",), ("b",)], "category string")
    known = df.where("category IS NULL OR category <> 'zz'")
    domain = features.category_table(known)
    assert [r.value for r in domain.orderBy("rank").collect()] == ["a", "b", "c", "é"] == features.category_domain(known)
    got = slots(features.add_category_vector(features.add_category_index(df, domain), domain.count()))
    wide = features.add_category_onehot(df, ["a", "b", "c", "é"])
    for r in wide.collect():
        dense = [r.cat_b, r["cat_c"], r["cat_é"]]
        assert got[r.category] == (3, [i for i, x in enumerate(dense) if x], [1.0] * sum(dense))


@pytest.mark.parametrize("n", [0, 1, 2])
def test_tiny_domains(spark, n):
    domain = features.category_table(spark.createDataFrame([(f"c{i}",) for i in range(n)], "category string"))
    df = spark.createDataFrame([("c0",), ("c1",), (None,)], "category string")
    got = slots(features.add_category_vector(features.add_category_index(df, domain), domain.count()))
    assert got["c1"] == ((1, [0], [1.0]) if n == 2 else (max(n - 1, 0), [], [])) and got["c0"][1] == []


def test_ranks_over_many_partitions(spark):
    df = spark.range(20_000).select(F.concat(F.lit("k"), F.hash("id").cast("string")).alias("category")).repartition(7)
    want = sorted(r.category for r in df.distinct().collect())
    assert [(r.value, r["rank"]) for r in features.category_table(df).orderBy("rank").collect()] == [(v, i) for i, v in enumerate(want)]
    assert not isinstance(features.category_domain(df), list)


def test_five_thousand_categories_fit_models_and_forecast(spark):
    """A category's level shows in the coefficients, and the forecast carries the vectors on."""
    n = 5000
    series = spark.range(n).select(F.format_string("P%05d", "id").alias("product_id"), (F.col("id") % 97).alias("level"))
    weeks = spark.range(14).select(F.expr("date_add(date'2023-01-02', cast(7 * id as int))").alias("week_start"), F.col("id").alias("w"))
    weekly = series.crossJoin(weeks).select(
        F.lit("S1").alias("store_id"), F.lit("Store").alias("store_name"), "product_id", F.col("product_id").alias("product_name"),
        F.col("product_id").alias("category"), "week_start", (100 + 3 * F.col("level") + F.col("w") % 2).alias("units_sold"),
        F.lit(1.0).alias("revenue"), F.lit(10.0).alias("avg_price"), F.lit(0).cast("bigint").alias("promo_days"), F.lit(0).cast("bigint").alias("stockout_days"),
        F.lit(7).alias("lead_time_days"), F.lit(0.2).alias("holding_cost_pct"), F.lit(5.0).alias("base_price"))
    weekly = add_week_calendar(weekly.withColumn("is_festival_season", festival_flag(F.month("week_start")))).withColumn("is_promo_week", F.lit(0))
    domain = features.category_domain(weekly)
    panel = features.build_features(weekly, domain)
    assert panel.columns.count(features.CATEGORY_VECTOR) == 1 and features.CATEGORY_VECTOR in features.feature_columns(panel)
    assert panel.count() == 2 * n
    columns = ["is_promo_week", features.CATEGORY_VECTOR]
    fitted = models.linear_regression(columns).fit(panel)
    worst = fitted.transform(panel).groupBy("category").agg(F.max("prediction").alias("p"), F.avg("units_sold").alias("m"))
    assert worst.agg(F.max(F.abs(F.col("p") - F.col("m")))).first()[0] < 0.01
    ahead = recursive_forecast(panel, fitted.transform, weeks=2)
    assert ahead.count() == 2 * n and ahead.where(F.abs(F.col("predicted_units") - 100 - 3 * (F.substring("product_id", 2, 5).cast("int") % 97)) > 1).count() == 0
    grown = models.gradient_boosting(["lag_1w", features.CATEGORY_VECTOR], maxIter=1, maxDepth=2).fit(panel.limit(2000))
    names = [r.feature for r in models.feature_importance(grown, ["lag_1w", features.CATEGORY_VECTOR], spark).collect()]
    assert sorted(names) == [features.CATEGORY_VECTOR, "lag_1w"]


def test_sparse_least_squares_solve_all_columns_at_once(spark, tmp_path):
    """Numbers that go with the categories, one that repeats them, rows of the first category or none; saved and read back."""
    import numpy as np
    rng = np.random.default_rng(4)
    c = rng.integers(0, 5, 300)
    a, b, level = rng.normal(size=300) + c, rng.normal(size=300) * 1000, np.array([3.0, -5.0, 0.0, 8.0, 1.0])
    y = 2 * a - 0.01 * b + level[c] + rng.normal(size=300)
    rows = spark.createDataFrame([(f"c{i}", float(u), float(v), float(level[i]), float(t)) for i, u, v, t in zip(c, a, b, y)],
                                 "category string, a double, b double, base double, units_sold double").repartition(3)
    domain = features.category_table(rows)
    rows = features.add_category_vector(features.add_category_index(rows, domain), domain.count())
    assert not rows.schema[features.CATEGORY_VECTOR].metadata
    inputs = ["a", features.CATEGORY_VECTOR, "b", "base"]
    for part in (rows, rows.where("category <> 'c0'")):
        fitted = models.linear_regression(inputs).fit(part)
        got = {(r.a, r.b): r.prediction for r in fitted.transform(part).collect()}
        keep = np.array([(u, v) in got for u, v in zip(a, b)])
        x = np.column_stack([a, b, *[c == i for i in range(5)]])[keep].astype(float)
        want = x @ np.linalg.lstsq(x, y[keep], rcond=None)[0]
        assert len(got) == keep.sum() and np.allclose([got[u, v] for u, v in zip(a[keep], b[keep])], want, atol=1e-8)
        assert np.allclose(fitted.weights[2], 0) and not hasattr(fitted, "coefficients")  # the table of categories stays in Spark
    models.save_model(fitted, f"{tmp_path}/m")
    again = models.load_model(f"{tmp_path}/m").transform(rows.where("category <> 'c0'"))
    assert {(r.a, r.b): r.prediction for r in again.collect()} == got
