"""Daily to weekly roll-up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.constants import ITEM_KEYS
from demandspark.functions.calendar import add_week_calendar, festival_flag, week_start
from demandspark.functions.numeric import money


#: Measures of a week that add up, and those of which the largest counts.
SUMS = ("units_sold", "revenue", "price_sum", "price_n", "promo_days", "stockout_days")
LARGEST = ("lead_time_days", "holding_cost_pct", "base_price", "is_festival_season")


def week_cells(daily: DataFrame, date: str = "date") -> DataFrame:
    """One row per store, product and Monday week with measures that merge: sums, counts and maxima."""
    return (daily.withColumn("week_start", week_start(F.col(date)))
            .groupBy(*ITEM_KEYS, "week_start")
            .agg(F.sum("units_sold").cast("bigint").alias("units_sold"),
                 F.sum(money(F.col("revenue"))).alias("revenue"),
                 F.sum(money(F.col("unit_price"))).alias("price_sum"),
                 F.count(money(F.col("unit_price"))).alias("price_n"),
                 F.sum("is_promotion").cast("bigint").alias("promo_days"),
                 F.sum("stockout_flag").cast("bigint").alias("stockout_days"),
                 F.max("lead_time_days").alias("lead_time_days"),
                 F.max("holding_cost_pct").alias("holding_cost_pct"),
                 F.max("base_price").alias("base_price"),
                 F.max(festival_flag(F.month(date))).alias("is_festival_season")))


def merge_cells(cells: DataFrame) -> DataFrame:
    """Cells of the same week merged into one; decimals keep their scale."""
    types = dict(cells.dtypes)
    return cells.groupBy(*ITEM_KEYS, "week_start").agg(
        *[F.sum(c).cast(types[c]).alias(c) for c in SUMS], *[F.max(c).alias(c) for c in LARGEST])


def finish_weeks(cells: DataFrame) -> DataFrame:
    """The weekly table from its cells. A week whose values are all missing sold nothing, so no units are null."""
    def total(column):
        return F.coalesce(column, F.lit(0))

    weekly = cells.select(
        *ITEM_KEYS, "week_start", total(F.col("units_sold")).alias("units_sold"), total(F.col("revenue").cast("double")).alias("revenue"),
        (F.col("price_sum").cast("double") / F.col("price_n")).alias("avg_price"), total(F.col("promo_days")).alias("promo_days"),
        total(F.col("stockout_days")).alias("stockout_days"), *LARGEST)
    return add_week_calendar(weekly).withColumn("is_promo_week", (F.col("promo_days") > 0).cast("int"))


def weekly_rollup(daily: DataFrame, date: str = "date", pre_shuffle: bool = False) -> DataFrame:
    """One row per store, product and Monday week.

    The partial aggregate runs before the shuffle, so a hot series shrinks to its weeks first.
    ``pre_shuffle`` instead moves the raw rows once by series, which lets the series windows reuse
    that exchange; it pays only where a series has few rows per week.
    """
    if pre_shuffle:
        daily = daily.repartition("store_id", "product_id")
    return finish_weeks(week_cells(daily, date))
