"""Inventory policy: safety stock, reorder point, order quantity, status and alerts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.constants import (
    ITEM_KEYS, ORDERING_COST, SERIES_KEYS, SERVICE_LEVEL_Z, STATUS_OK, STATUS_OVERSTOCK,
    STATUS_REORDER, STORE_PLANT, UNKNOWN_PLANT, WEEKS_PER_YEAR,
)
from demandspark.functions.labels import alert_line, urgency
from demandspark.functions.lookup import literal_table, look_up
from demandspark.functions.numeric import round_half_even

ITEM_ATTRIBUTES = [*ITEM_KEYS, "lead_time_days", "holding_cost_pct", "base_price"]


def demand_stats(panel: DataFrame) -> DataFrame:
    """Weekly demand mean, sample deviation and yearly projection per item."""
    stats = panel.groupBy(*ITEM_ATTRIBUTES).agg(
        F.avg("units_sold").alias("avg_weekly_demand"),
        F.coalesce(F.stddev_samp("units_sold"), F.lit(0.0)).alias("std_weekly_demand"),
        F.count("units_sold").alias("obs_weeks"))
    return stats.withColumn("annual_demand", F.col("avg_weekly_demand") * WEEKS_PER_YEAR)


def safety_stock(stats: DataFrame, z: float = SERVICE_LEVEL_Z) -> DataFrame:
    weeks = F.col("lead_time_days") / 7
    return stats.withColumns({
        "lead_time_weeks": weeks,
        "safety_stock": round_half_even(F.lit(z) * F.col("std_weekly_demand") * F.sqrt(weeks), 1),
    })


def reorder_point(stats: DataFrame) -> DataFrame:
    """Lead-time demand plus the already rounded safety stock."""
    demand = F.col("avg_weekly_demand") * F.col("lead_time_weeks")
    return stats.withColumn("reorder_point", round_half_even(demand + F.col("safety_stock"), 1))


def order_quantity(stats: DataFrame, ordering_cost: float = ORDERING_COST) -> DataFrame:
    """Economic order quantity; zero where holding costs nothing."""
    holding = F.col("base_price") * F.col("holding_cost_pct")
    squared = F.try_divide(F.lit(2) * F.col("annual_demand") * F.lit(ordering_cost), holding)
    return stats.withColumns({
        "holding_cost_per_unit": holding,
        "EOQ": round_half_even(F.coalesce(F.sqrt(squared), F.lit(0.0)), 1),
    })


def stock_position(stats: DataFrame, stock: DataFrame) -> DataFrame:
    """Attach the stock table (store, product, current_stock); an unknown item holds nothing."""
    levels = stock.select(*SERIES_KEYS, "current_stock")
    return (stats.join(levels, SERIES_KEYS, "left")
            .withColumn("current_stock", F.coalesce("current_stock", F.lit(0)).cast("bigint")))


def assign_status(stats: DataFrame) -> DataFrame:
    stock, point = F.col("current_stock"), F.col("reorder_point")
    return stats.withColumn(
        "inventory_status",
        F.when(stock <= point, STATUS_REORDER)
        .when(stock > point + 2 * F.col("EOQ"), STATUS_OVERSTOCK)
        .otherwise(STATUS_OK))


def join_forecast_demand(stats: DataFrame, forecast: DataFrame) -> DataFrame:
    """Add the summed forecast per item; zero where there is none."""
    totals = forecast.groupBy(*SERIES_KEYS).agg(F.sum("predicted_units").alias("total"))
    demand = F.rint(F.coalesce(F.col("total"), F.lit(0)).cast("double")).cast("bigint")
    return (stats.join(totals, SERIES_KEYS, "left")
            .withColumn("forecast_12w_demand", demand).drop("total"))


def policy(panel: DataFrame) -> DataFrame:
    """Demand statistics with safety stock, reorder point and order quantity."""
    return order_quantity(reorder_point(safety_stock(demand_stats(panel))))


def inventory_report(panel: DataFrame, stock: DataFrame, forecast: DataFrame) -> DataFrame:
    return join_forecast_demand(assign_status(stock_position(policy(panel), stock)), forecast)


def reorder_alerts(report: DataFrame, ordered: bool = True) -> DataFrame:
    """Items to reorder with quantity and cost, most expensive first."""
    wanted = F.col("EOQ") + F.col("reorder_point") - F.col("current_stock")
    alerts = (report.where(F.col("inventory_status") == STATUS_REORDER)
              .withColumn("recommended_order_qty", F.greatest(F.rint(wanted), F.lit(0.0)).cast("bigint"))
              .withColumn("estimated_order_cost",
                          round_half_even(F.col("recommended_order_qty") * F.col("base_price"), 2)))
    return alerts.orderBy(F.desc("estimated_order_cost"), *SERIES_KEYS) if ordered else alerts


def alert_digest(alerts: DataFrame, report: DataFrame, rows: int = 15, lines: int = 10) -> DataFrame:
    """The costliest alerts with urgency, text line and the overall counts on each row."""
    counts = report.agg(F.struct(
        F.count_if(F.col("inventory_status") == STATUS_REORDER).alias("reorder"),
        F.count_if(F.col("inventory_status") == STATUS_OVERSTOCK).alias("overstock")).alias("s")).scalar()
    value = alerts.agg(F.sum("estimated_order_cost")).scalar()
    top = alerts.orderBy(F.desc("estimated_order_cost"), *SERIES_KEYS).limit(rows)
    # At most `rows` rows are left, so numbering them in one partition is safe.
    ranked = top.select("*", F.expr("row_number() over (order by estimated_order_cost desc, store_id, product_id)")
                        .alias("position"))
    return ranked.select(
        "position", "store_name", "product_name", "category", "current_stock", "reorder_point",
        "recommended_order_qty", "estimated_order_cost",
        urgency(F.col("recommended_order_qty")).alias("urgency"),
        F.when(F.col("position") <= lines, alert_line()).alias("line"),
        counts["reorder"].alias("n_reorder"), counts["overstock"].alias("n_overstock"),
        value.alias("total_value"))


def lookup_plant(df: DataFrame, plants: DataFrame | None = None) -> DataFrame:
    """Add the plant of the store, UNKNOWN where there is none."""
    table = plants if plants is not None else literal_table(df.sparkSession, STORE_PLANT, "store_id", "plant")
    return look_up(df, table, "store_id", {"plant": UNKNOWN_PLANT})


def purchase_orders(alerts: DataFrame, run_date: dt.date, plants: DataFrame | None = None,
                    supplier: str = "AUTO-SELECT") -> DataFrame:
    """One order per alert. Number and delivery follow from item, run date and lead time."""
    day = F.lit(run_date)
    digest = F.md5(F.concat_ws("|", "store_id", "product_id", F.lit(run_date.isoformat())))
    return lookup_plant(alerts, plants).select(
        F.concat(F.lit("PO-"), F.upper(F.substring(digest, 1, 12))).alias("po_number"),
        "store_id", "plant", F.col("product_id").alias("material_id"),
        F.col("recommended_order_qty").alias("quantity"), F.col("base_price").alias("unit_price"),
        round_half_even(F.col("recommended_order_qty") * F.col("base_price"), 2).alias("total_value"),
        F.lit(supplier).alias("supplier"), F.lit("AWAITING_APPROVAL").alias("status"),
        day.alias("created_at"), F.date_add(day, F.col("lead_time_days")).alias("expected_delivery"))
