"""The core run: clean, roll up, build features, fit, forecast, plan inventory."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession

from demandspark.functions.calendar import add_time_features
from demandspark.operators import features, inventory, models, quality, reports
from demandspark.operators.cleaning import clean_daily
from demandspark.operators.rollout import forecast_with
from demandspark.operators.rollup import weekly_rollup
from demandspark.sources import stages


@dataclass
class CoreTables:
    clean: DataFrame
    panel: DataFrame
    forecast: DataFrame
    metrics: DataFrame | None
    inventory: DataFrame
    alerts: DataFrame
    category_forecast: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return {k: v for k, v in vars(self).items() if v is not None}


def build_panel(clean: DataFrame, categories: Sequence[str] | DataFrame | None = None) -> DataFrame:
    return features.build_features(weekly_rollup(clean), features.category_domain(clean) if categories is None else categories)


def run_core(spark: SparkSession, raw: DataFrame, stock: DataFrame, root: str,
             categories: Sequence[str] | DataFrame | None = None, models_of: Callable[[Sequence[str]], Mapping[str, Pipeline]] | None = None,
             split: Callable[[DataFrame], DataFrame] = models.split_by_week, weeks: int = 12) -> CoreTables:
    """Run all stages. Clean rows and panel are written below ``root`` and read back, so the later
    stages neither repeat the work nor depend on cached blocks of one executor. They hold together: a run
    that breaks off between them leaves the former pair.
    """
    # Clustered by day, so a date range reads few files; the hint also splits a busy day by size.
    daily = add_time_features(clean_daily(raw)).hint("rebalance", "date")
    with stages.StageStore(spark, root).begin() as stage:
        clean = stage.write("clean", daily)
        stage.write("features", build_panel(clean, categories))
    return resume_core(spark, stock, root, models_of, split, weeks)


def resume_core(spark: SparkSession, stock: DataFrame, root: str,
                models_of: Callable[[Sequence[str]], Mapping[str, Pipeline]] | None = None,
                split: Callable[[DataFrame], DataFrame] = models.split_by_week, weeks: int = 12, fmt: str = "parquet",
                retrain: bool = True) -> CoreTables:
    """Go on from the clean rows and the panel stored below ``root``.

    Without ``retrain`` the stored model forecasts, and the tables have no metrics. Model and results are
    stored in one step.
    """
    stage = stages.StageStore(spark, root).begin()
    clean, panel = stages.read_stage(spark, f"{root}/clean", fmt=fmt), stages.read_stage(spark, f"{root}/features", fmt=fmt)
    if not features.feature_columns(panel):  # text keeps no marks
        panel = features.mark_inputs(panel)
    metrics = None
    if retrain:
        trained = models.train_models(panel, (models_of or models.default_models)(features.feature_columns(panel)), split)
        models.save_model(trained.best_model, stage.folder("model", "model"))
        model, metrics = trained.best_model, trained.metrics
    else:
        model = models.load_model(stage.store.path("model"))
    forecast = forecast_with(panel, model, weeks)
    report = inventory.inventory_report(panel, stock, forecast)
    tables = CoreTables(clean, panel, forecast, metrics, report, inventory.reorder_alerts(report),
                        reports.category_forecast_summary(forecast))
    for name, table in tables.as_dict().items():
        if name not in ("clean", "panel"):
            stage.write(name, table)
    stage.commit()
    if metrics is not None:
        stages.write_text_report(stages.metrics_report(metrics), f"{root}/model_comparison")
    return tables


def data_quality(raw: DataFrame) -> dict[str, DataFrame]:
    return {"profile": quality.profile(raw), "nulls": quality.null_counts(raw),
            "duplicates": quality.duplicate_count(raw), "describe": quality.describe(raw)}
