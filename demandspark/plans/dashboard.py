"""The dashboard's tables for one choice of filters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.functions import describe, labels
from demandspark.operators import anomaly, cluster, reports
from demandspark.operators.quality import filter_domains
from demandspark.plans.cube import SalesCube


def daily_kpis(sales: DataFrame, alerts: DataFrame) -> DataFrame:
    """Revenue, units, active days and stockout days of the chosen sales, and the alerts, as one row."""
    return sales.agg(
        F.sum("revenue").alias("total_revenue"), F.sum("units_sold").cast("bigint").alias("total_units"),
        F.countDistinct("date").alias("days"), F.count_if(F.col("stockout_flag") == 1).alias("stockout_days"),
    ).withColumn("n_alerts", alerts.agg(F.count("*")).scalar())


def sales_tables(daily: DataFrame, alerts: DataFrame, store: str | None, category: str | None, start: dt.date | None, end: dt.date | None) -> dict[str, DataFrame]:
    """The tables over the chosen daily sales, read directly."""
    sales = reports.dashboard_filter(daily, store, category, start, end)
    return {
        "filters": filter_domains(daily),
        "kpis": daily_kpis(sales, alerts),
        "monthly_revenue": reports.monthly_revenue(sales),
        "category_revenue": reports.revenue_by(sales, "category"),
        "top_stores": reports.top_by_sum(sales, "store_name", "revenue", 50),
        "season": reports.season_pivot(sales),
    }


def cube_tables(cube: SalesCube, alerts: DataFrame, store: str | None, category: str | None, start: dt.date | None, end: dt.date | None) -> dict[str, DataFrame]:
    """The same tables from the stored cube; the sales are not read."""
    chosen = cube.slice(store, category, start, end)
    return {
        "filters": cube.slice().filters(),
        "kpis": chosen.kpis().withColumn("n_alerts", alerts.agg(F.count("*")).scalar()),
        "monthly_revenue": chosen.monthly_revenue(),
        "category_revenue": chosen.category_revenue(),
        "top_stores": chosen.top_stores(50),
        "season": chosen.season(),
    }


def dashboard(daily: DataFrame | SalesCube, forecast: DataFrame, report: DataFrame, alerts: DataFrame,
              store: str | None = None, category: str | None = None, start: dt.date | None = None,
              end: dt.date | None = None, uplift: DataFrame | None = None, weather_impact: DataFrame | None = None,
              flagged: DataFrame | None = None, stl_summary: DataFrame | None = None, segments: DataFrame | None = None) -> dict[str, DataFrame]:
    """Lazy tables; the filters reach the scans of each. The analyses that are given add theirs.

    ``daily`` is the daily table or its stored cube, from which every choice of filters is answered.
    """
    chosen = [reports.dashboard_filter(t, store, category) for t in (forecast, report, alerts)]
    forecast, report, alerts = chosen
    of_sales = cube_tables if isinstance(daily, SalesCube) else sales_tables
    tables = of_sales(daily, alerts, store, category, start, end) | {
        "category_forecast": reports.forecast_by(forecast, "week_start", "category"),
        "top_products": reports.top_by_sum(forecast, "product_name", "predicted_units", 10),
        "status": reports.status_breakdown(report),
        "stock_levels": reports.category_means(report, "safety_stock", "reorder_point", "current_stock"),
        "alert_kpis": reports.alert_kpis(alerts),
        "top_reorders": alerts.orderBy(F.desc("recommended_order_qty"), "store_id", "product_id").limit(15),
    }
    if uplift is not None:
        tables["uplift_histogram"] = describe.histogram(uplift, "uplift_pct", -50, 100, 40)
    if weather_impact is not None:
        tables["temperature_signs"] = weather_impact.withColumn("direction", labels.sign_label(F.col("temp_coefficient")))
    if flagged is not None:
        found = anomaly.anomaly_report(flagged)
        tables |= {"anomaly_counts": anomaly.anomaly_counts(found), "anomaly_share": anomaly.anomaly_share(flagged),
                   "anomalies": found.limit(50)}
    if stl_summary is not None:
        tables["strengths"] = describe.box_stats(stl_summary, "seasonal_strength", "category")
        tables["strength_ranking"] = stl_summary.orderBy(F.desc_nulls_last("seasonal_strength"), "store_id", "product_id")
    if segments is not None:
        tables["segment_summary"] = cluster.segment_summary(segments)
    return tables
