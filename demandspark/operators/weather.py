"""Weather join, weather-adjusted demand and weather impact."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.constants import (
    CATEGORY_SENSITIVITY, DEFAULT_CLIMATE, RAINY_WEEK_MM, REFERENCE_TEMP, STORE_CLIMATE,
)
from demandspark.functions.lookup import literal_table, look_up
from demandspark.functions.numeric import round_half_even


def rainy_flag(rain_mm):
    return (rain_mm > RAINY_WEEK_MM).cast("int")


def climate_baseline(spine: DataFrame, climate: DataFrame | None = None) -> DataFrame:
    """Seasonal temperature of each week and store, a sine around the store's mean."""
    table = climate if climate is not None else literal_table(
        spine.sparkSession, STORE_CLIMATE, "store_name", "base_temp", "temp_amp")
    joined = look_up(spine, table, "store_name",
                     {"base_temp": DEFAULT_CLIMATE[0], "temp_amp": DEFAULT_CLIMATE[1]})
    phase = F.lit(2 * math.pi) * (F.dayofyear("week_start") - 80) / 365
    temperature = F.col("base_temp") + F.col("temp_amp") * F.sin(phase)
    return (joined.withColumn("temperature_c", round_half_even(temperature, 1))
            .drop("base_temp", "temp_amp"))


def join_weather(panel: DataFrame, weather: DataFrame) -> DataFrame:
    """Panel with weather; a missing week reads as reference temperature without rain."""
    joined = panel.join(weather.select("week_start", "store_name", "temperature_c", "rainfall_mm", "is_rainy_week"),
                        ["week_start", "store_name"], "left")
    return joined.withColumns({
        "temperature_c": F.coalesce("temperature_c", F.lit(REFERENCE_TEMP)),
        "rainfall_mm": F.coalesce("rainfall_mm", F.lit(0.0)),
        "is_rainy_week": F.coalesce("is_rainy_week", F.lit(0)),
    })


def _sensitivity(df: DataFrame, table: DataFrame | None) -> DataFrame:
    table = table if table is not None else literal_table(
        df.sparkSession, CATEGORY_SENSITIVITY, "category", "sensitivity")
    return look_up(df, table, "category", {"sensitivity": 0.0})


def weather_multiplier(merged: DataFrame, sensitivity: DataFrame | None = None) -> DataFrame:
    """Demand multiplier of the category at the week's temperature, and adjusted units."""
    factor = 1.0 + F.col("sensitivity") * (F.col("temperature_c") - REFERENCE_TEMP) / 10
    return (_sensitivity(merged, sensitivity)
            .withColumn("weather_multiplier", factor)
            .withColumn("weather_adjusted_units",
                        round_half_even(F.col("units_sold") * F.col("weather_multiplier"), 1))
            .drop("sensitivity"))


def weather_adjusted_demand(panel: DataFrame, weather: DataFrame, sensitivity: DataFrame | None = None) -> DataFrame:
    return weather_multiplier(join_weather(panel, weather), sensitivity)


def weather_impact(merged: DataFrame, sensitivity: DataFrame | None = None, min_rows: int = 30,
                   ordered: bool = True) -> DataFrame:
    """Units on temperature and rain per category: the two-regressor closed form.

    Dependent or constant regressors get the minimum-norm solution.
    """
    x1, x2, y = (F.col(c).cast("double") for c in ["temperature_c", "is_rainy_week", "units_sold"])
    m = (merged.groupBy("category")
         .agg(F.count("*").alias("n"), F.var_pop(x1).alias("s11"), F.var_pop(x2).alias("s22"),
              F.covar_pop(x1, x2).alias("s12"), F.covar_pop(x1, y).alias("s1y"),
              F.covar_pop(x2, y).alias("s2y"), F.var_pop(y).alias("syy"))
         .where(F.col("n") >= min_rows))
    s11, s22, s12, s1y, s2y = (F.col(c) for c in ["s11", "s22", "s12", "s1y", "s2y"])
    det = s11 * s22 - s12 * s12
    full = det > 1e-12 * s11 * s22
    zero = F.lit(0.0)
    # With one dimension left, the pseudo-inverse of the moment matrix is itself over its squared trace.
    trace = s11 + s22
    b1 = F.when(full, F.try_divide(s1y * s22 - s2y * s12, det)).otherwise(
        F.coalesce(F.try_divide(s11 * s1y + s12 * s2y, trace * trace), zero))
    b2 = F.when(full, F.try_divide(s2y * s11 - s1y * s12, det)).otherwise(
        F.coalesce(F.try_divide(s12 * s1y + s22 * s2y, trace * trace), zero))
    fit = m.withColumns({"b1": b1, "b2": b2})
    r2 = F.try_divide(F.col("b1") * s1y + F.col("b2") * s2y, F.col("syy"))
    out = _sensitivity(fit, sensitivity).select(
        "category",
        round_half_even(F.col("b1"), 4).alias("temp_coefficient"),
        round_half_even(F.col("b2"), 4).alias("rain_coefficient"),
        round_half_even(F.coalesce(r2, F.lit(1.0)), 4).alias("r2_weather"),
        "sensitivity")
    return out.orderBy(F.desc("temp_coefficient"), "category") if ordered else out


def temperature_trend_line(merged: DataFrame, category: str = "Beverages", points: int = 100) -> DataFrame:
    """Regression line of one category's units on temperature over an even grid."""
    fit = merged.where(F.col("category") == category).agg(
        F.regr_slope("units_sold", "temperature_c").alias("slope"),
        F.regr_intercept("units_sold", "temperature_c").alias("intercept"),
        F.min("temperature_c").alias("low"), F.max("temperature_c").alias("high"))
    step = (F.col("high") - F.col("low")) / (points - 1)
    return (fit.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
            .withColumn("temperature_c", F.col("low") + F.col("point") * step)
            .select("point", "temperature_c",
                    (F.col("intercept") + F.col("slope") * F.col("temperature_c")).alias("predicted_units")))


def monthly_city_temperature(merged: DataFrame) -> DataFrame:
    return merged.groupBy("store_name", F.month("week_start").alias("month")).agg(
        F.avg("temperature_c").alias("avg_temperature"))
