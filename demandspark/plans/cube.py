"""A stored cube of the daily sales: dashboard reports for any filter without reading the sales again."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark.functions.calendar import month_label
from demandspark.functions.numeric import money
from demandspark.operators.reports import DAY_NAMES
from demandspark.sources.stages import StageStore

KEYS = ["store_name", "category"]
DAYS, MONTHS = "cube_days", "cube_months"
#: Measures that add up when cells are merged.
SUMS = ["n_rows", "revenue", "units", "stockout_rows", "stockout_units", *[f"{m}_{d}" for d in DAY_NAMES for m in ("units", "n")]]


def _merged() -> list[Column]:
    """Measures of merged cells: sums, the days that occur as bits of the month, and the first and last of them."""
    return [*[F.sum(c).cast("decimal(38,8)" if c == "revenue" else "bigint").alias(c) for c in SUMS],
            F.bit_or("days").alias("days"), F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day")]


def day_cells(daily: DataFrame) -> DataFrame:
    """One row per store, category and day; partial sums shrink the rows before the shuffle."""
    units, weekday = F.col("units_sold").cast("bigint"), F.weekday("date")
    rows = daily.select(
        *KEYS, F.col("date").alias("day"), F.lit(1).cast("bigint").alias("n_rows"), money(F.col("revenue")).alias("revenue"), units.alias("units"),
        (F.col("stockout_flag") == 1).cast("bigint").alias("stockout_rows"),
        F.when(F.col("stockout_flag") == 1, F.col("stockout_flag").cast("bigint")).alias("stockout_units"),
        *[c for i, d in enumerate(DAY_NAMES) for c in (F.when(weekday == i, units).alias(f"units_{d}"),
                                                       F.when(weekday == i, units.isNotNull().cast("bigint")).alias(f"n_{d}"))],
        F.call_function("shiftleft", F.lit(1).cast("bigint"), F.dayofmonth("date")).alias("days"), F.col("date").alias("first_day"), F.col("date").alias("last_day"))
    return rows.groupBy(*KEYS, "day").agg(*_merged())


def month_cells(cells: DataFrame) -> DataFrame:
    """Day cells merged by month, under the month's first day."""
    return cells.withColumn("day", F.trunc("day", "month")).groupBy(*KEYS, "day").agg(*_merged())


@dataclass
class CubeSlice:
    """Reports over chosen cells."""
    cells: DataFrame

    def kpis(self) -> DataFrame:
        """Revenue, units, days with sales and rows without stock, as one row."""
        per_month = self.cells.groupBy(F.trunc("day", "month").alias("month")).agg(
            *[F.sum(c).alias(c) for c in ("revenue", "units", "stockout_rows")], F.bit_or("days").alias("days"))
        return per_month.agg(F.sum("revenue").cast("double").alias("total_revenue"), F.sum("units").cast("bigint").alias("total_units"),
                             F.coalesce(F.sum(F.bit_count("days")), F.lit(0)).cast("bigint").alias("days"),
                             F.coalesce(F.sum("stockout_rows"), F.lit(0)).cast("bigint").alias("stockout_days"))

    def _revenue(self, *keys) -> DataFrame:
        return self.cells.groupBy(*keys).agg(F.sum("revenue").cast("double").alias("revenue"))

    def monthly_revenue(self) -> DataFrame:
        sums = self._revenue(F.trunc("day", "month").alias("period")).withColumns({"year": F.year("period"), "month": F.month("period")})
        return sums.select("year", "month", "period", month_label(F.col("year"), F.col("month")).alias("period_label"), "revenue")

    def category_revenue(self) -> DataFrame:
        return self._revenue("category")

    def store_years(self, years: Sequence[int]) -> DataFrame:
        return self.cells.withColumn("year", F.year("day")).groupBy("store_name").pivot("year", list(years)).agg(F.sum("revenue").cast("double"))

    def top_stores(self, n: int = 50) -> DataFrame:
        return self._revenue("store_name").orderBy(F.desc("revenue"), "store_name").limit(n)

    def season(self) -> DataFrame:
        """Mean units by month and day of week, from their sums and numbers."""
        return self.cells.groupBy(F.month("day").alias("month")).agg(
            *[F.try_divide(F.sum(f"units_{d}").cast("double"), F.sum(f"n_{d}")).alias(d) for d in DAY_NAMES])

    def stockouts(self) -> DataFrame:
        sums = self.cells.groupBy("category").agg(F.sum("stockout_rows").alias("n"), F.sum("stockout_units").cast("bigint").alias("stockout_days"))
        return sums.where("n > 0").select("category", "stockout_days").orderBy(F.desc("stockout_days"), "category")

    def filters(self) -> DataFrame:
        """Choices of the filters with their first and last date."""
        ends = self.cells.groupBy(*KEYS).agg(F.min("first_day").alias("a"), F.max("last_day").alias("b"))
        one, two = (ends.groupBy(F.lit(c).alias("domain"), F.col(c).alias("value")).agg(F.min("a").alias("date_min"), F.max("b").alias("date_max"))
                    for c in KEYS)
        return one.unionByName(two)


class SalesCube:
    """Day cells and month cells below a root; both hold together.

    All measures merge by addition, so new sales are added without the old ones, and a slice reads whole months
    from the month cells and only the days at the ends of its range from the day cells.
    """

    def __init__(self, spark, root: str):
        self.store = StageStore(spark, root)

    def _write(self, cells: DataFrame) -> SalesCube:
        with self.store.begin() as stage:
            days = stage.write(DAYS, cells.repartitionByRange("day").sortWithinPartitions("day", *KEYS))
            stage.write(MONTHS, month_cells(days))
        return self

    def build(self, daily: DataFrame) -> SalesCube:
        return self._write(day_cells(daily))

    def add(self, daily: DataFrame) -> SalesCube:
        """Merge further sales in, of old or new days, categories and stores."""
        if DAYS not in self.store.newest()[1]:
            return self.build(daily)
        both = self.store.read(DAYS).unionByName(day_cells(daily))
        return self._write(both.groupBy(*KEYS, "day").agg(*_merged()))

    def slice(self, store: str | None = None, category: str | None = None, start: dt.date | None = None, end: dt.date | None = None) -> CubeSlice:
        """Cells of a store, a category and an inclusive range of days; unset means all."""
        days, months = self.store.read(DAYS), self.store.read(MONTHS)
        whole, single = F.lit(True), F.lit(False)
        if start is not None:
            first_whole = start if start.day == 1 else (start.replace(day=1) + dt.timedelta(days=32)).replace(day=1)
            whole, single = whole & (F.col("day") >= F.lit(first_whole)), single | (F.col("day") < F.lit(first_whole))
        if end is not None:
            after = end + dt.timedelta(days=1)
            last_open = after.replace(day=1)  # months from here on are not whole
            whole, single = whole & (F.col("day") < F.lit(last_open)), single | (F.col("day") >= F.lit(last_open))
        picked = months.where(whole)
        if start is not None or end is not None:
            inside = single
            if start is not None:
                inside = inside & (F.col("day") >= F.lit(start))
            if end is not None:
                inside = inside & (F.col("day") <= F.lit(end))
            picked = picked.unionByName(days.where(inside))
        for column, value in (("store_name", store), ("category", category)):
            if value is not None:
                picked = picked.where(F.col(column) == value)
        return CubeSlice(picked)
