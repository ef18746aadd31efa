"""Demand models and the recursive forecast."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from demandspark.catalog.base import Retail, he, query
from demandspark.catalog.features import FEATURES
from demandspark.catalog.sql import SERIES
from demandspark.catalog.sql import he as sql_he
from demandspark.functions.numeric import to_units
from demandspark.operators import folds, models
from demandspark.operators.features import feature_columns
from demandspark.operators.rollout import forecast_with, linear_arrays, roll_forecast
from demandspark.session import staged

KEYS = ["store_id", "product_id", "week_start"]


#: The inputs of the models whose least squares the twins solve themselves.
TWO_INPUTS = ["lag_1w", "roll_mean_4w"]


def two_input_sql(rows: str, group: str = "") -> str:
    """Least squares of the units on the two inputs by variances and covariances, one row a group."""
    keys, by = (f"{group}, ", f"GROUP BY {group}") if group else ("", "")
    return f"""
        SELECT {keys}n, b1, b2, my - b1 * m1 - b2 * m2 AS b0
        FROM (SELECT *, (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) AS b1, (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) AS b2
              FROM (SELECT {keys}count(*) AS n, var_pop(lag_1w) AS s11, var_pop(roll_mean_4w) AS s22, covar_pop(lag_1w, roll_mean_4w) AS s12,
                      covar_pop(lag_1w, units_sold) AS s1y, covar_pop(roll_mean_4w, units_sold) AS s2y,
                      avg(lag_1w) AS m1, avg(roll_mean_4w) AS m2, avg(units_sold) AS my FROM ({rows}) {by}))"""


PREDICTED = f"CAST(greatest(0, {sql_he('b0 + b1 * lag_1w + b2 * roll_mean_4w', 0)}) AS BIGINT)"


def two_input_model(r: Retail) -> models.TrainedModels:
    return models.train_models(r.panel, {"TwoInputs": models.linear_regression(TWO_INPUTS)})


def one_model(r: Retail, build) -> models.TrainedModels:
    columns = feature_columns(r.panel)
    return models.train_models(r.panel, {build.__name__: build(columns)})


@query("regression_metrics", f"""
    SELECT store_id, {sql_he('avg(abs(e))')} AS MAE, {sql_he('sqrt(avg(e * e))')} AS RMSE,
      {sql_he('1 - avg(e * e) / var_pop(units_sold)')} AS R2,
      {sql_he('avg(abs(e / (units_sold + 1e-6))) * 100', 4)} AS MAPE
    FROM (SELECT *, units_sold - {sql_he('greatest(roll_mean_4w, 0)', 0)} AS e FROM v_panel) GROUP BY store_id""")
def regression_metrics(r: Retail):
    scored = r.panel.withColumn("predicted", to_units(F.col("roll_mean_4w")))
    metrics = models.regression_metrics(scored, by=["store_id"])
    return metrics.select("store_id", he("MAE"), he("RMSE"), he("R2"), he("MAPE", 4))


INPUTS = FEATURES


@query("standardise_features", f"SELECT {', '.join(KEYS)}, is_train, " + ", ".join(
    sql_he(f"(c - m) / coalesce(nullif(d, 0), 1)").replace("c - m", f"{c} - avg({c}) FILTER (is_train) OVER ()")
    .replace("nullif(d, 0)", f"nullif(stddev_samp({c}) FILTER (is_train) OVER (), 0)") + f" AS {c}_z" for c in INPUTS) + " FROM v_split")
def standardise_features(r: Retail):
    r.staged()
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    columns = feature_columns(r.panel)
    marked = staged(models.split_by_week(r.panel))
    scaler = Pipeline(stages=models.linear_regression(columns).getStages()[:2]).fit(marked.where("is_train"))
    scaled = scaler.transform(marked).withColumn("scaled", vector_to_array("features"))
    return scaled.select(*KEYS, "is_train", *[he(F.col("scaled")[i]).alias(f"{c}_z") for i, c in enumerate(columns)])


#: The models' target here is a sum of two of their inputs, so that a model that learns nothing shows.
TEST_FACTS = f"""
    SELECT count(*) AS n_test, {sql_he('stddev_pop(lag_1w + lag_2w)', 4)} AS spread, TRUE AS explains FROM v_split WHERE NOT is_train"""


def echoing(panel):
    """The panel with a target that is known from two inputs."""
    return panel.withColumn("units_sold", (F.col("lag_1w") + F.col("lag_2w")).cast("bigint"))


def rmse(predicted: str = "predicted"):
    error = F.col("units_sold") - F.col(predicted)
    return F.sqrt(F.avg(error * error))


def correlation(one: str, two: str):
    """Pearson's r; null where a column is constant, for which ``corr`` divides by zero."""
    x, y = F.col(one).cast("double"), F.col(two).cast("double")
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def test_facts(r: Retail, build):
    """Size of the test weeks, the target's spread on them, and whether the model's error is below half of that."""
    r.staged()
    columns = feature_columns(r.panel)
    trained = models.train_models(echoing(r.panel), {build.__name__: build(columns)})
    spread = F.stddev_pop("units_sold")
    return trained.scored.agg(F.count("*").alias("n_test"), he(spread, 4).alias("spread"), (rmse() < spread / 2).alias("explains"))


@query("linear_regression", """
    SELECT CAST(count_if(is_train) AS BIGINT) AS n_train, CAST(count_if(NOT is_train) AS BIGINT) AS n_test, TRUE AS is_unbiased, TRUE AS is_orthogonal FROM v_split""")
def linear_regression(r: Retail):
    """On the training weeks the residuals of least squares have mean zero and go with no input."""
    r.staged()
    trained = one_model(r, models.linear_regression)
    marked = models.split_by_week(r.panel)
    fitted = trained.best_model.transform(marked).withColumn("rest", F.col("units_sold") - F.col("prediction"))
    train = fitted.where("is_train")
    alike = [F.abs(F.coalesce(F.nanvl(correlation("rest", c), F.lit(0.0)), F.lit(0.0))) for c in trained.feature_cols]
    facts = train.agg(F.count("*").alias("n_train"), (F.abs(F.avg("rest")) < 1e-6 * F.avg("units_sold")).alias("is_unbiased"),
                      (F.greatest(*alike) < 1e-3).alias("is_orthogonal"))
    return facts.select("n_train", trained.scored.agg(F.count("*")).scalar().alias("n_test"), "is_unbiased", "is_orthogonal")


@query("random_forest", TEST_FACTS)
def random_forest(r: Retail):
    return test_facts(r, models.random_forest)


@query("gradient_boosting", f"""
    SELECT n_test, lag_rmse, beats_lag, spread, explains
    FROM ({TEST_FACTS}), (SELECT {sql_he('sqrt(avg((units_sold - lag_1w) * (units_sold - lag_1w)))', 4)} AS lag_rmse, TRUE AS beats_lag FROM v_split WHERE NOT is_train)""")
def gradient_boosting(r: Retail):
    """Fitted to the demand, where it beats last week's error, and to the sum of two inputs, which it explains."""
    explained = test_facts(r, models.gradient_boosting)
    demand = one_model(r, models.gradient_boosting).scored
    beaten = demand.agg(he(rmse("lag_1w"), 4).alias("lag_rmse"), (rmse() < rmse("lag_1w")).alias("beats_lag"))
    return explained.crossJoin(F.broadcast(beaten)).select("n_test", "lag_rmse", "beats_lag", "spread", "explains")  # one row each


@query("gradient_boosting_colsample", TEST_FACTS)
def gradient_boosting_colsample(r: Retail):
    return test_facts(r, models.gradient_boosting_colsample)


@query("select_best_model", f"""
    SELECT model, model = 'LinearRegression' AS is_best, n_test, spread, explains
    FROM ({TEST_FACTS}), (SELECT unnest(['GradientBoosting', 'GradientBoostingColsample', 'LinearRegression', 'RandomForest']) AS model)""")
def select_best_model(r: Retail):
    """All four models on a sum of two inputs: each explains it, and least squares, which can say it, is the best."""
    r.staged()
    trained = models.train_models(echoing(r.panel), models.default_models(feature_columns(r.panel)))
    facts = trained.scored.agg(F.count("*").alias("n_test"), F.stddev_pop("units_sold").alias("s"))
    return trained.metrics.crossJoin(F.broadcast(facts)).select(  # one row
        "model", (F.col("model") == trained.best_name).alias("is_best"), "n_test", he(F.col("s"), 4).alias("spread"), (F.col("RMSE") < F.col("s") / 2).alias("explains"))


SCORED = f"""
    SELECT {', '.join(KEYS)}, units_sold, {PREDICTED} AS predicted
    FROM v_split, ({two_input_sql("SELECT * FROM v_split WHERE is_train")}) WHERE NOT is_train"""


@query("scored_test_set", SCORED)
def scored_test_set(r: Retail):
    r.staged()
    return two_input_model(r).scored.select(*KEYS, "units_sold", "predicted")


@query("first_200_scored", f"{SCORED} ORDER BY {', '.join(KEYS)} LIMIT 200")
def first_200_scored(r: Retail):
    r.staged()
    return two_input_model(r).scored.select(*KEYS, "units_sold", "predicted").orderBy(*KEYS).limit(200)


@query("model_metrics", f"""
    SELECT 'TwoInputs' AS model, {sql_he('avg(abs(e))', 4)} AS MAE, {sql_he('sqrt(avg(e * e))', 4)} AS RMSE,
      {sql_he('1 - avg(e * e) / var_pop(units_sold)', 4)} AS R2, {sql_he('avg(abs(e / (units_sold + 1e-6))) * 100', 2)} AS MAPE
    FROM (SELECT *, units_sold - predicted AS e FROM ({SCORED}))""")
def model_metrics(r: Retail):
    """The metrics table of a trained model."""
    r.staged()
    return two_input_model(r).metrics.select("model", he("MAE", 4), he("RMSE", 4), he("R2", 4), he("MAPE", 2))


@query("feature_importance_top15", """
    SELECT CAST(unnest(range(1, 16)) AS INT) AS place, CASE WHEN place = 1 THEN 'lag_2w' END AS first_feature, place = 1 AS leads, TRUE AS is_input,
      TRUE AS falls""")
def feature_importance_top15(r: Retail):
    """Where the target is one of the inputs, that input comes first and leads; the other places fall."""
    r.staged()
    copied = r.panel.withColumn("units_sold", F.col("lag_2w").cast("bigint"))
    columns = feature_columns(r.panel)
    fitted = models.random_forest(columns, numTrees=40).fit(copied)
    top = models.feature_importance(fitted, columns, r.spark)
    # Fifteen rows.
    by_place = W.orderBy(F.desc("importance"), "feature")
    before = F.lag("importance").over(by_place)
    place = F.row_number().over(by_place)
    return top.select(place.alias("place"), F.when(place == 1, F.col("feature")).alias("first_feature"),
                      ((place == 1) & (F.col("importance") > F.lead("importance").over(by_place))).alias("leads"),
                      F.col("feature").isin(INPUTS).alias("is_input"), (F.col("importance") <= F.coalesce(before, F.lit(1.0))).alias("falls"))


FOLDS = """
    SELECT * FROM v_panel JOIN (
      SELECT week_start, CASE WHEN rank < total - 5 * (total // 6) THEN 0 ELSE (rank - (total - 5 * (total // 6))) // (total // 6) + 1 END AS fold
      FROM (SELECT week_start, row_number() OVER (ORDER BY week_start) - 1 AS rank, count(*) OVER () AS total FROM (SELECT DISTINCT week_start FROM v_panel)))
    USING (week_start)"""
FOLD_FITS = two_input_sql(f"SELECT v AS fold, f.* EXCLUDE (fold) FROM ({FOLDS}) f JOIN range(1, 6) t(v) ON f.fold < v", "fold")


@query("expanding_cv_coefficients", f"""
    SELECT CAST(fold AS INT) AS fold, n AS n_train, {sql_he('b1')} AS lag_1w, {sql_he('b2')} AS roll_mean_4w, {sql_he('b0', 4)} AS intercept FROM ({FOLD_FITS})""")
def expanding_cv_coefficients(r: Retail):
    """Each fold's least squares from the prefix of the normal equations."""
    table, _ = folds.linear_folds(r.panel, TWO_INPUTS)
    b = F.col("coefficients")
    return table.select("fold", "n_train", he(b[0]).alias("lag_1w"), he(b[1]).alias("roll_mean_4w"), he("intercept", 4))


@query("expanding_cv_metrics", f"""
    SELECT {sql_he('avg(abs(e))', 4)} AS MAE, {sql_he('sqrt(avg(e * e))', 4)} AS RMSE, {sql_he('1 - avg(e * e) / var_pop(units_sold)', 4)} AS R2,
      {sql_he('avg(abs(e / (units_sold + 1e-6))) * 100', 2)} AS MAPE
    FROM (SELECT units_sold, units_sold - {PREDICTED} AS e FROM ({FOLDS}) JOIN ({FOLD_FITS}) USING (fold))""")
def expanding_cv_metrics(r: Retail):
    return folds.cross_validate_linear(r.panel, TWO_INPUTS).select(he("MAE", 4), he("RMSE", 4), he("R2", 4), he("MAPE", 2))


@query("recursive_forecast", f"""
    WITH RECURSIVE start AS (
      SELECT store_id, product_id, max(week_start) AS last_week,
        list(CAST(units_sold AS DOUBLE) ORDER BY week_start) AS hist
      FROM (SELECT *, row_number() OVER ({SERIES} ORDER BY week_start DESC) AS back FROM v_panel)
      WHERE back <= 12 GROUP BY store_id, product_id),
    steps AS (
      SELECT store_id, product_id, last_week, 0 AS h, hist, CAST(0 AS DOUBLE) AS units,
        CAST(0 AS DOUBLE) AS lag_1w, CAST(0 AS DOUBLE) AS roll_mean_4w FROM start
      UNION ALL
      SELECT store_id, product_id, last_week, h + 1, list_append(hist, u), u, l, m
      FROM (SELECT *, greatest(0, round_even(0.6e0 * l + 0.4e0 * m, 0)) AS u
            FROM (SELECT *, hist[-1] AS l, list_avg(hist[-4:]) AS m FROM steps WHERE h < 12)))
    SELECT store_id, product_id, h AS horizon_week, CAST(last_week + 7 * h AS DATE) AS week_start, lag_1w,
      {sql_he('roll_mean_4w')} AS roll_mean_4w, CAST(units AS BIGINT) AS predicted_units
    FROM steps WHERE h > 0""")
def closed_form_forecast(r: Retail):
    """A weighted sum of two features, rolled over all weeks in one pass."""
    out = roll_forecast(r.panel, linear_arrays({"lag_1w": 0.6, "roll_mean_4w": 0.4}))
    return out.select("store_id", "product_id", "horizon_week", "week_start", "lag_1w", he("roll_mean_4w"),
                      "predicted_units")


#: The fitted two-input model fed back week by week: the rows of ``steps`` with h > 0.
FORECAST_CTES = f"""
    WITH RECURSIVE fit AS ({two_input_sql("SELECT * FROM v_split WHERE is_train")}),
    start AS (
      SELECT store_id, product_id, max(week_start) AS last_week, list(CAST(units_sold AS DOUBLE) ORDER BY week_start) AS hist
      FROM (SELECT *, row_number() OVER ({SERIES} ORDER BY week_start DESC) AS back FROM v_panel) WHERE back <= 12 GROUP BY store_id, product_id),
    steps AS (
      SELECT store_id, product_id, last_week, 0 AS h, hist, CAST(0 AS DOUBLE) AS units, b0, b1, b2 FROM start, fit
      UNION ALL
      SELECT store_id, product_id, last_week, h + 1, list_append(hist, u), u, b0, b1, b2
      FROM (SELECT *, greatest(0, round_even(b0 + b1 * hist[-1] + b2 * list_avg(hist[-4:]), 0)) AS u FROM steps WHERE h < 12))"""


@query("recursive_forecast_model", f"""{FORECAST_CTES}
    SELECT store_id, product_id, h AS horizon_week, CAST(last_week + 7 * h AS DATE) AS week_start, CAST(units AS BIGINT) AS predicted_units
    FROM steps WHERE h > 0""")
def model_forecast(r: Retail):
    """The fitted model's own forecast, each week fed back."""
    r.staged()
    return forecast_with(r.panel, two_input_model(r).best_model).select("store_id", "product_id", "horizon_week", "week_start", "predicted_units")
