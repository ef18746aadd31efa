"""Calendar column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark.constants import FESTIVAL_MONTHS


def week_start(date: Column) -> Column:
    """Monday of the week."""
    return F.date_trunc("week", date).cast("date")


def festival_flag(month: Column) -> Column:
    return month.isin(FESTIVAL_MONTHS).cast("int")


def weekend_flag(date: Column) -> Column:
    return (F.weekday(date) >= 5).cast("int")


def cyclic(value: Column, period: int) -> tuple[Column, Column]:
    """Sine and cosine of a value on a circle of ``period`` steps."""
    angle = F.lit(2 * math.pi) * value / F.lit(period)
    return F.sin(angle), F.cos(angle)


def month_period(year: Column, month: Column) -> Column:
    """First day of the month."""
    return F.make_date(year, month, F.lit(1))


def month_label(year: Column, month: Column) -> Column:
    """``YYYY-MM`` text."""
    return F.concat_ws("-", year.cast("string"), F.lpad(month.cast("string"), 2, "0"))


def add_time_features(df: DataFrame, date: str = "date") -> DataFrame:
    """Calendar columns of the daily table; the week number is the ISO week."""
    d = F.col(date)
    return df.withColumns({
        "year": F.year(d),
        "month": F.month(d),
        "day": F.dayofmonth(d),
        "day_of_week": F.weekday(d),
        "week_number": F.weekofyear(d),
        "quarter": F.quarter(d),
        "day_of_year": F.dayofyear(d),
        "month_name": F.date_format(d, "MMM"),
        "is_month_start": (F.dayofmonth(d) == 1).cast("int"),
        "is_month_end": (d == F.last_day(d)).cast("int"),
        "is_festival_season": festival_flag(F.month(d)),
        "is_weekend": weekend_flag(d),
    })


def add_week_calendar(df: DataFrame, week: str = "week_start") -> DataFrame:
    """Calendar columns of a weekly table: calendar year of the Monday beside the ISO week."""
    w = F.col(week)
    return df.withColumns({
        "year": F.year(w),
        "month": F.month(w),
        "week_num": F.weekofyear(w),
        "quarter": F.quarter(w),
    })


def add_cyclic_features(df: DataFrame) -> DataFrame:
    month_sin, month_cos = cyclic(F.col("month"), 12)
    week_sin, week_cos = cyclic(F.col("week_num"), 52)
    return df.withColumns({
        "month_sin": month_sin, "month_cos": month_cos,
        "week_num_sin": week_sin, "week_num_cos": week_cos,
    })
