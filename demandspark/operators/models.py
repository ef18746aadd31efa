"""Demand models on Spark ML."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from itertools import accumulate
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from demandspark.constants import BOOSTING_COLUMN_SHARE, BOOSTING_SETTINGS, EPSILON, FOREST_SETTINGS, SERIES_KEYS
from demandspark.functions.numeric import to_units
from demandspark.operators.boosting import ArraysModel, ColumnBoosting
from demandspark.operators.categories import CategoryModel, CategoryRegression
from demandspark.operators.features import CATEGORY_VECTOR, feature_columns
from demandspark.session import staged

TARGET = "units_sold"
PARALLEL_FITS = 4


# --- splits -----------------------------------------------------------------------------------

def _first_past(counts: DataFrame, key: str, offset: int) -> tuple:
    """The key, in order, whose rows hold position ``offset``, and the rows before it."""
    upto = counts.withColumn("upto", F.sum("n").over(W.orderBy(key)))
    row = upto.where(F.col("upto") > offset).orderBy(key).first()
    return row[key], row["upto"] - row["n"]


def split_positional(panel: DataFrame, share: float = 0.8, keys: Sequence[str] = SERIES_KEYS,
                     time: str = "week_start") -> DataFrame:
    """First rows in (store, product, week) order train, the rest test: the last stores' series.

    Only the row at the cut is looked for: among the stores, then the products of its store, then
    the weeks of its series. Every row then compares its own key with that one.
    """
    outer, inner = keys
    counts = staged(panel.groupBy(outer, inner).agg(F.count("*").alias("n")))
    cut = int((counts.agg(F.sum("n")).first()[0] or 0) * share)
    if cut == 0:
        return panel.withColumn("is_train", F.lit(False))
    store, before = _first_past(counts.groupBy(outer).agg(F.sum("n").alias("n")), outer, cut)
    product, earlier = _first_past(counts.where(F.col(outer) == store), inner, cut - before)
    series = panel.where((F.col(outer) == store) & (F.col(inner) == product))
    # One series has a row per calendar week.
    week, _ = _first_past(series.groupBy(time).agg(F.count("*").alias("n")), time, cut - before - earlier)
    first_test = F.struct(F.lit(store).alias("s"), F.lit(product).alias("p"), F.lit(week).alias("w"))
    own = F.struct(F.col(outer).alias("s"), F.col(inner).alias("p"), F.col(time).alias("w"))
    return panel.withColumn("is_train", own < first_test)


def split_by_week(panel: DataFrame, share: float = 0.8, time: str = "week_start") -> DataFrame:
    """Weeks up to the one where the row share reaches ``share`` train, later weeks test."""
    weeks = panel.groupBy(time).agg(F.count("*").alias("n"))
    # One row per calendar week.
    upto = F.sum("n").over(W.orderBy(time))
    total = F.sum("n").over(W.partitionBy())
    cut = (weeks.select(time, (upto / total).alias("part")).where(F.col("part") <= share)
           .agg(F.max(time))).scalar()
    return panel.withColumn("is_train", F.coalesce(F.col(time) <= cut, F.lit(False)))


def expanding_folds(panel: DataFrame, folds: int = 5, time: str = "week_start") -> DataFrame:
    """Fold number per row by week; fold v is validated on a model of all earlier folds."""
    weeks = panel.select(time).distinct()
    # One row per calendar week, which also bounds what is broadcast.
    rank = F.row_number().over(W.orderBy(time)) - 1
    total = F.count("*").over(W.partitionBy())
    size = F.floor(F.col("total") / (folds + 1))
    start = F.col("total") - folds * size
    fold = F.when(F.col("rank") < start, F.lit(0)).otherwise(
        F.floor((F.col("rank") - start) / size).cast("int") + 1)
    numbered = weeks.withColumns({"rank": rank, "total": total}).select(time, fold.alias("fold"))
    return panel.join(F.broadcast(numbered), time)


# --- estimators -------------------------------------------------------------------------------

def _pipeline(columns: Sequence[str], regressor, scaled: bool) -> Pipeline:
    assembled = "raw_features" if scaled else "features"
    stages = [VectorAssembler(inputCols=list(columns), outputCol=assembled)]
    if scaled:
        stages.append(StandardScaler(inputCol=assembled, outputCol="features", withMean=True, withStd=True))
    return Pipeline(stages=[*stages, regressor])


def linear_regression(columns: Sequence[str], **settings) -> CategoryRegression | Pipeline:
    """Least squares on standardised inputs; with sparse categories these are eliminated first, or with settings solved by steps."""
    if CATEGORY_VECTOR in columns and not settings:
        return CategoryRegression(columns, TARGET)
    if CATEGORY_VECTOR in columns:
        settings = {"solver": "l-bfgs", "maxIter": 500, "tol": 1e-10, **settings}
        return _pipeline(columns, LinearRegression(labelCol=TARGET, **settings), scaled=False)
    return _pipeline(columns, LinearRegression(labelCol=TARGET, **{"solver": "normal", **settings}), scaled=True)


def random_forest(columns: Sequence[str], **settings) -> Pipeline:
    return _pipeline(columns, RandomForestRegressor(labelCol=TARGET, **{**FOREST_SETTINGS, **settings}), scaled=False)


def gradient_boosting(columns: Sequence[str], **settings) -> Pipeline:
    return _pipeline(columns, GBTRegressor(labelCol=TARGET, **{**BOOSTING_SETTINGS, **settings}), scaled=False)


def gradient_boosting_colsample(columns: Sequence[str], **settings) -> ColumnBoosting | Pipeline:
    """Boosting that draws its columns once per tree; with sparse categories Spark's own, which draws them at every node."""
    if CATEGORY_VECTOR in columns:
        return gradient_boosting(columns, **{"featureSubsetStrategy": BOOSTING_COLUMN_SHARE, **settings})
    return ColumnBoosting(columns, TARGET, **{**BOOSTING_SETTINGS, "columnRate": float(BOOSTING_COLUMN_SHARE), **settings})


def default_models(columns: Sequence[str]) -> dict[str, Pipeline]:
    return {
        "LinearRegression": linear_regression(columns),
        "RandomForest": random_forest(columns),
        "GradientBoosting": gradient_boosting(columns),
        "GradientBoostingColsample": gradient_boosting_colsample(columns),
    }


# --- evaluation -------------------------------------------------------------------------------

def regression_metrics(scored: DataFrame, actual: str = TARGET, predicted: str = "predicted",
                       by: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE, R2 and MAPE (percent, with a small term against zero actuals)."""
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    error = y - p
    # R2 is 1 less the squared error over the squared spread, both as means.
    return scored.groupBy(*by).agg(
        F.avg(F.abs(error)).alias("MAE"),
        F.sqrt(F.avg(error * error)).alias("RMSE"),
        (1 - F.try_divide(F.avg(error * error), F.var_pop(y))).alias("R2"),
        (F.avg(F.abs(error / (y + EPSILON))) * 100).alias("MAPE"))


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Rows with the predicted unit count."""
    scored = model.transform(rows).withColumn("predicted", to_units(F.col("prediction")))
    return scored.select(*rows.columns, "predicted")


def side_by_side(spark, fits: Sequence[Callable], rows: DataFrame) -> list:
    """Run independent fits at once; each is many small jobs that leave cores idle."""
    with ThreadPool(min(len(fits), PARALLEL_FITS)) as pool:
        return pool.map(inheritable_thread_target(spark)(lambda fit: fit(rows)), fits)


@dataclass
class TrainedModels:
    best_name: str
    best_model: PipelineModel
    feature_cols: list[str]
    metrics: DataFrame
    scored: DataFrame


def train_models(panel: DataFrame, models: Mapping[str, Pipeline] | None = None,
                 split: Callable[[DataFrame], DataFrame] = split_by_week) -> TrainedModels:
    """Fit every model on the training rows and keep the one with the lowest test RMSE."""
    columns = feature_columns(panel)
    models = models or default_models(columns)
    marked = staged(split(panel))
    train = marked.where("is_train").drop("is_train")
    test = marked.where("NOT is_train").drop("is_train")
    fitted = dict(zip(models, side_by_side(train.sparkSession, [p.fit for p in models.values()], train)))
    tables = [regression_metrics(score(model, test)).withColumn("model", F.lit(name))
              for name, model in fitted.items()]
    metrics = tables[0]
    for table in tables[1:]:
        metrics = metrics.unionByName(table)
    rows = metrics.select("model", "MAE", "RMSE", "R2", "MAPE").collect()
    best = min(rows, key=lambda r: (r["RMSE"], r["model"]))["model"]
    table = panel.sparkSession.createDataFrame(rows, "model string, MAE double, RMSE double, R2 double, MAPE double")
    return TrainedModels(best, fitted[best], columns, table, score(fitted[best], test))


def cross_validate(panel: DataFrame, pipeline: Pipeline, folds: int = 5) -> DataFrame:
    """Metrics over the validation rows of all expanding folds."""
    marked = staged(expanding_folds(panel, folds))
    fits = [lambda rows, v=v: pipeline.fit(rows.where(F.col("fold") < v)) for v in range(1, folds + 1)]
    fitted = side_by_side(panel.sparkSession, fits, marked)
    parts = [score(model, marked.where(F.col("fold") == v)) for v, model in enumerate(fitted, 1)]
    scored = parts[0]
    for part in parts[1:]:
        scored = scored.unionByName(part)
    return regression_metrics(scored)


def feature_importance(model: PipelineModel, columns: Sequence[str], spark, n: int = 15) -> DataFrame:
    """The largest importances of a tree model; sparse categories count as one feature."""
    values = model.importances() if isinstance(model, ArraysModel) else model.stages[-1].featureImportances.toArray()
    width = {CATEGORY_VECTOR: len(values) - len(columns) + 1}
    ends = list(accumulate(width.get(c, 1) for c in columns))
    rows = [(c, float(values[end - width.get(c, 1):end].sum())) for c, end in zip(columns, ends)]
    return (spark.createDataFrame(rows, "feature string, importance double")
            .orderBy(F.desc("importance"), "feature").limit(n))


def save_model(model: PipelineModel | ArraysModel | CategoryModel, path: str) -> None:
    if isinstance(model, ArraysModel | CategoryModel):
        model.save(SparkSession.active(), path)
    else:
        model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel | ArraysModel | CategoryModel:
    spark = SparkSession.active()
    for part, kind in (("arrays", ArraysModel), ("categories", CategoryModel)):
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{part}")
        if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
            return kind.load(spark, path)
    return PipelineModel.load(path)
