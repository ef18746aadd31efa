"""Summary reports over the daily table, the weekly panel, forecasts and inventory."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from demandspark.constants import SERIES_KEYS, STATUS_REORDER
from demandspark.functions.calendar import month_label, month_period
from demandspark.functions.numeric import round_half_even

DAY_NAMES = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]


def dashboard_filter(df: DataFrame, store: str | None = None, category: str | None = None,
                     start: dt.date | None = None, end: dt.date | None = None,
                     date: str = "date") -> DataFrame:
    """Optional store, category and inclusive date range; unset means all."""
    if store is not None:
        df = df.where(F.col("store_name") == store)
    if category is not None:
        df = df.where(F.col("category") == category)
    if start is not None:
        df = df.where(F.col(date) >= F.lit(start))
    if end is not None:
        df = df.where(F.col(date) <= F.lit(end))
    return df


def revenue_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum("revenue").alias("revenue"))


def monthly_revenue(daily: DataFrame) -> DataFrame:
    """Revenue by month with the month as date and as text."""
    monthly = daily.groupBy(F.year("date").alias("year"), F.month("date").alias("month")).agg(
        F.sum("revenue").alias("revenue"))
    return monthly.select("year", "month", month_period(F.col("year"), F.col("month")).alias("period"),
                          month_label(F.col("year"), F.col("month")).alias("period_label"), "revenue")


def month_end_revenue(panel: DataFrame, week: str = "week_start") -> DataFrame:
    """Revenue by month end of the week's Monday; months without sales are zero.

    Each month unfolds into the months up to the next one with sales, so the panel is read once.
    """
    sums = panel.groupBy(F.trunc(week, "month").alias("first_day")).agg(F.sum("revenue").alias("revenue"))
    # The window covers one row per calendar month.
    following = F.lead("first_day").over(W.orderBy("first_day"))
    until = F.coalesce(F.add_months("following", -1), F.col("first_day"))
    return (sums.where(F.col("first_day").isNotNull()).withColumn("following", following)
            .withColumn("m", F.explode(F.sequence("first_day", until, F.expr("interval 1 month"))))
            .select(F.last_day("m").alias("month_end"),
                    F.when(F.col("m") == F.col("first_day"), F.col("revenue")).otherwise(0.0).alias("revenue")))


def store_year_matrix(daily: DataFrame, years: Sequence[int]) -> DataFrame:
    """Revenue by store and year, one column per year; a year without sales is null."""
    return daily.groupBy("store_name").pivot("year", list(years)).agg(F.sum("revenue"))


def stockouts_by_category(daily: DataFrame) -> DataFrame:
    return (daily.where(F.col("stockout_flag") == 1).groupBy("category")
            .agg(F.sum("stockout_flag").cast("bigint").alias("stockout_days"))
            .orderBy(F.desc("stockout_days"), "category"))


def season_pivot(daily: DataFrame) -> DataFrame:
    """Mean units by month and day of week, one column per day."""
    wide = (daily.groupBy(F.month("date").alias("month"))
            .agg(*[F.avg(F.when(F.weekday("date") == i, F.col("units_sold"))).alias(name)
                   for i, name in enumerate(DAY_NAMES)]))
    return wide


def status_breakdown(report: DataFrame) -> DataFrame:
    """Items per inventory status and their share."""
    counts = report.groupBy("inventory_status").agg(F.count("*").alias("n"))
    # The window covers one row per status.
    total = F.sum("n").over(W.partitionBy())
    return counts.select("inventory_status", "n", round_half_even(F.col("n") / total, 6).alias("share"))


def category_means(report: DataFrame, *columns: str) -> DataFrame:
    return report.groupBy("category").agg(*[F.avg(c).alias(f"avg_{c}") for c in columns])


def forecast_by(forecast: DataFrame, *keys: str) -> DataFrame:
    return forecast.groupBy(*keys).agg(F.sum("predicted_units").cast("bigint").alias("predicted_units"))


def category_forecast_summary(forecast: DataFrame) -> DataFrame:
    return forecast.groupBy("store_name", "category").agg(
        F.sum("predicted_units").cast("bigint").alias("total_predicted_12w"),
        round_half_even(F.avg("predicted_units"), 1).alias("avg_weekly_predicted"),
        F.max("predicted_units").alias("peak_weekly_demand"))


def executive_kpis(panel: DataFrame, report: DataFrame, alerts: DataFrame | None = None,
                   anomalies: DataFrame | None = None, mape: DataFrame | None = None) -> DataFrame:
    """Headline numbers, one row; each input is aggregated once and read as a scalar."""
    row = panel.agg(F.sum("revenue").alias("total_revenue"),
                    F.sum("units_sold").cast("bigint").alias("total_units"),
                    F.count_if(F.col("stockout_days") > 0).alias("stockout_weeks"))
    extra = {"reorder_items": report.agg(F.count_if(F.col("inventory_status") == STATUS_REORDER)).scalar()}
    if alerts is not None:
        extra["n_alerts"] = alerts.agg(F.count("*")).scalar()
    if anomalies is not None:
        extra["n_anomalies"] = anomalies.agg(F.count("*")).scalar()
    if mape is not None:
        extra["forecast_mape"] = mape.agg(F.first("MAPE")).scalar()
    return row.withColumns(extra)


def alert_kpis(alerts: DataFrame) -> DataFrame:
    """Number, quantity and value of the alerts, overall (category null) and per category."""
    return alerts.rollup("category").agg(F.count("*").alias("n_alerts"),
                                         F.sum("recommended_order_qty").alias("total_qty"),
                                         F.sum("estimated_order_cost").alias("total_value"))


def best_series(panel: DataFrame, keys: Sequence[str] = SERIES_KEYS, value: str = "units_sold") -> DataFrame:
    """The series with the highest mean, smallest key on ties, as one row."""
    means = panel.groupBy(*keys).agg(F.avg(value).alias("mean_value"))
    return means.orderBy(F.desc("mean_value"), *keys).limit(1)


def tail_weeks(panel: DataFrame, weeks: int = 52, keys: Sequence[str] = SERIES_KEYS) -> DataFrame:
    """Last weeks of the best series. Its key is a scalar, so only that series is read and sorted."""
    key = best_series(panel, keys).select(F.struct(*keys).alias("k")).scalar()
    series = panel
    for k in keys:
        series = series.where(F.col(k) == key[k])
    per_week = series.groupBy(*keys, "week_start").agg(F.sum("units_sold").cast("bigint").alias("units_sold"))
    return per_week.orderBy(F.desc("week_start")).limit(weeks)


def last_of_series(panel: DataFrame, keys: Sequence[str] = SERIES_KEYS, time: str = "week_start",
                   carried: Sequence[str] = ()) -> DataFrame:
    """First and last week of each series with the attributes of the last row."""
    latest = F.max_by(F.struct(*carried), F.col(time))
    out = panel.groupBy(*keys).agg(F.min(time).alias("first_week"), F.max(time).alias("last_week"),
                                   latest.alias("latest"))
    return out.select(*keys, "first_week", "last_week", "latest.*")


def future_calendar(last: DataFrame, horizon: int = 12, last_week: str = "last_week") -> DataFrame:
    """Each series with its next weeks."""
    return (last.withColumn("horizon_week", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
            .withColumn("week_start", F.date_add(last_week, 7 * F.col("horizon_week"))))


def top_by_sum(df: DataFrame, key: str, value: str, n: int) -> DataFrame:
    """The n keys with the largest sum; ties go to the smaller key."""
    return df.groupBy(key).agg(F.sum(value).alias(value)).orderBy(F.desc(value), key).limit(n)


def stable_sample(df: DataFrame, n: int, keys: Sequence[str] = SERIES_KEYS) -> DataFrame:
    """A repeatable sample of n rows, chosen by key hash."""
    return df.orderBy(F.md5(F.concat_ws("|", *keys)), *keys).limit(n)


def week_store_spine(panel: DataFrame, week: str = "week_start", store: str = "store_name") -> DataFrame:
    """Every week of the panel for every store.

    The weeks form one array of calendar length, unfolded on the store list: no join is needed.
    """
    weeks = panel.agg(F.collect_set(week)).scalar()
    return panel.select(store).distinct().withColumn(week, F.explode(weeks))
