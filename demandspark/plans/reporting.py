"""Report chains: exploration of the daily table, the executive report, and the exchange with the ERP system."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from demandspark.functions import describe
from demandspark.operators import inventory, reports
from demandspark.plans.extensions import net_open_orders
from demandspark.sources import erp, stages

#: Columns of the correlation report.
NUMBERS = ("units_sold", "unit_price", "revenue", "is_promotion", "stockout_flag", "lead_time_days", "holding_cost_pct", "base_price")


def exploration(daily: DataFrame, years: Sequence[int], top: int = 10) -> dict[str, DataFrame]:
    """Trend, mix, stores, products, season, promotions, stockouts and correlations of the daily table."""
    return {
        "monthly_trend": reports.monthly_revenue(daily),
        "category_revenue": reports.revenue_by(daily, "category"),
        "store_years": reports.store_year_matrix(daily, years),
        "top_products": reports.top_by_sum(daily, "product_name", "revenue", top),
        "season": reports.season_pivot(daily),
        "promotion_boxes": describe.box_stats(daily, "units_sold", "is_promotion"),
        "stockouts": reports.stockouts_by_category(daily),
        "correlations": describe.correlations(daily, list(NUMBERS)),
    }


def executive(panel: DataFrame, report: DataFrame, forecast: DataFrame, alerts: DataFrame, metrics: DataFrame | None = None,
              anomalies: DataFrame | None = None) -> dict[str, DataFrame]:
    """Headline numbers, category demand by week, month ends, best products, status and category forecast."""
    tables = {
        "kpis": reports.executive_kpis(panel, report, alerts, anomalies, metrics),
        "category_weeks": reports.forecast_by(forecast, "week_start", "category"),
        "month_ends": reports.month_end_revenue(panel),
        "top_products": reports.top_by_sum(forecast, "product_name", "predicted_units", 10),
        "status": reports.status_breakdown(report),
        "category_forecast": reports.category_forecast_summary(forecast),
    }
    return tables


def write_report(tables: dict[str, DataFrame], root: str, metrics: DataFrame | None = None) -> dict[str, str]:
    """Write the tables of a chain, which hold in one step, and the model comparison as text."""
    paths = stages.write_stages(tables, root)
    if metrics is not None:
        stages.write_text_report(stages.metrics_report(metrics), f"{root}/model_comparison")
    return paths


def erp_exchange(spark: SparkSession, stock_path: str, orders_path: str, panel: DataFrame, forecast: DataFrame, run_date: dt.date,
                 root: str, plants: DataFrame | None = None) -> dict[str, DataFrame]:
    """From the ERP stock snapshot to new orders: what is already on order is not ordered again."""
    stock = erp.stock_snapshot(erp.read_erp_stock(spark, stock_path))
    waiting = erp.open_orders_by_item(erp.read_erp_orders(spark, orders_path))
    report = inventory.inventory_report(panel, stock.select("store_id", "product_id", "current_stock"), forecast)
    alerts = inventory.reorder_alerts(report, ordered=False)
    tables = {"stock": stock, "open_orders": waiting, "inventory": report,
              "purchase_orders": inventory.purchase_orders(net_open_orders(alerts, waiting), run_date, plants)}
    paths = stages.write_stages(tables, root)
    return {name: stages.read_stage(spark, path) for name, path in paths.items()}
