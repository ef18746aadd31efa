"""Gap filling, decomposition and the forecasts built on it."""

from __future__ import annotations

import math

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from demandspark.catalog.base import STORE_NAMES, Retail, he, query
from demandspark.catalog.dashboard import BOX_SQL
from demandspark.catalog.sql import ITEM, SERIES
from demandspark.catalog.sql import he as sql_he
from demandspark.functions import describe
from demandspark.operators import decompose
from demandspark.session import staged

ITEMS = ITEM.split(", ")
PARTS = ["observed", "trend", "seasonal", "residual"]


def long_filled(r: Retail):
    return decompose.long_series(decompose.gap_fill(r.panel))


def components(r: Retail):
    return decompose.classical_decompose(long_filled(r))


def summary(r: Retail):
    return decompose.decomposition_summary(components(r))


@query("gap_fill_interpolate", f"SELECT {ITEM}, week_start, {sql_he('units_sold')} AS units_sold FROM v_filled")
def gap_fill_interpolate(r: Retail):
    return decompose.gap_fill(r.panel).withColumn("units_sold", he("units_sold"))


@query("classical_decompose", f"SELECT {ITEM}, week_start, idx, " + ", ".join(f"{sql_he(c, 7)} AS {c}" for c in PARTS)
       + " FROM v_components")
def classical_decompose(r: Retail):
    return components(r).select(*ITEMS, "week_start", "idx", *[he(c, 7) for c in PARTS])


@query("trend_slope", "SELECT store_id, product_id, trend_slope FROM v_summary")
def trend_slope(r: Retail):
    return summary(r).select("store_id", "product_id", "trend_slope")


@query("component_strength", "SELECT store_id, product_id, trend_strength, seasonal_strength FROM v_summary")
def component_strength(r: Retail):
    return summary(r).select("store_id", "product_id", "trend_strength", "seasonal_strength")


@query("residual_std", "SELECT store_id, product_id, residual_std, growth_direction FROM v_summary")
def residual_std(r: Retail):
    return summary(r).select("store_id", "product_id", "residual_std", "growth_direction")


@query("growth_direction", "SELECT growth_direction, count(*) AS n FROM v_summary GROUP BY growth_direction")
def growth_direction(r: Retail):
    return summary(r).groupBy("growth_direction").agg(F.count("*").alias("n"))


@query("seasonal_strength_matrix", "SELECT product_name, " + ", ".join(
    f"coalesce({sql_he(f'''avg(CASE WHEN store_name = '{s}' THEN seasonal_strength END)''')}, 0) "
    f"AS {s.lower().replace(' ', '_')}" for s in STORE_NAMES) + " FROM v_summary GROUP BY product_name")
def seasonal_strength_matrix(r: Retail):
    matrix = decompose.strength_matrix(summary(r), STORE_NAMES)
    return matrix.select("product_name", *[he(F.col(f"`{s}`")).alias(s.lower().replace(" ", "_")) for s in STORE_NAMES])


@query("seasonal_strength_box", "SELECT category, " + ", ".join(
    f"{sql_he(c)} AS {c}" for c in ["q1", "median", "q3", "whisker_low", "whisker_high"])
    + f", outliers, n FROM ({BOX_SQL.format(by='category', value='seasonal_strength', view='v_summary')})")
def seasonal_strength_box(r: Retail):
    r.staged()
    box = describe.box_stats(summary(r), "seasonal_strength", "category")
    return box.select("category", *[he(c) for c in ["q1", "median", "q3", "whisker_low", "whisker_high"]],
                      "outliers", "n")


@query("stl_forecast", f"""
    SELECT {ITEM}, CAST(h AS INT) AS horizon_week, CAST(last_week + CAST(7 * h AS INT) AS DATE) AS week_start,
      {sql_he('greatest(0, last_trend + slope * h + cycle[(h - 1) % len(cycle) + 1])', 4)} AS forecast
    FROM (SELECT {ITEM}, regr_slope(trend, idx) AS slope, arg_max(trend, idx) AS last_trend,
            max(week_start) AS last_week, list(seasonal ORDER BY idx) FILTER (WHERE back <= 52) AS cycle
          FROM (SELECT *, row_number() OVER ({SERIES} ORDER BY idx DESC) AS back FROM v_components)
          GROUP BY {ITEM}), range(1, 13) r(h)""")
def stl_forecast(r: Retail):
    return decompose.component_forecast(components(r)).withColumn("forecast", he("forecast", 4))


@query("linear_trend_baseline", f"""
    SELECT store_id, product_id, CAST(h AS INT) AS horizon_week,
      CAST(last_week + CAST(7 * h AS INT) AS DATE) AS week_start, {sql_he('slope')} AS slope,
      {sql_he('intercept')} AS intercept, {sql_he('intercept + slope * (n - 1 + h)', 4)} AS forecast
    FROM (SELECT store_id, product_id, regr_slope(units_sold, idx) AS slope, regr_intercept(units_sold, idx) AS intercept,
            count(*) AS n, max(week_start) AS last_week
          FROM (SELECT *, row_number() OVER ({SERIES} ORDER BY week_start) - 1 AS idx FROM v_panel)
          GROUP BY store_id, product_id), range(1, 13) r(h)""")
def linear_trend_baseline(r: Retail):
    line = decompose.linear_trend_baseline(r.panel)
    return line.select("store_id", "product_id", "horizon_week", "week_start", he("slope"), he("intercept"),
                       he("forecast", 4))


LONG = f"SELECT *, count(*) OVER ({SERIES}) AS series_rows FROM v_filled"


#: Made series: the mean of each, a line and a yearly wave by the week since its first.
SLOPE, WAVE = 0.5, 20.0
WEEK_NO = f"CAST(date_diff('day', min(week_start) OVER ({SERIES}), week_start) // 7 AS INT)"
MADE_SQL = f"""
    SELECT {ITEM}, week_start, w, level + {SLOPE}e0 * w AS line, {WAVE}e0 * sin(CAST({2 * math.pi!r} AS DOUBLE) * w / 52) AS wave
    FROM (SELECT *, {WEEK_NO} AS w, avg(units_sold) OVER ({SERIES}) AS level, count(*) OVER ({SERIES}) AS series_rows FROM v_filled) WHERE series_rows >= 104"""


def made_series(filled):
    """The weeks of every series with values whose trend and season are known."""
    series = W.partitionBy("store_id", "product_id")
    w = F.datediff("week_start", F.min("week_start").over(series)) / 7
    line = F.avg("units_sold").over(series) + SLOPE * w
    wave = WAVE * F.sin(2 * math.pi * w / 52)
    return filled.withColumns({"line": line, "wave": wave}).withColumn("units_sold", F.col("line") + F.col("wave"))


@query("stl_decompose", f"""
    SELECT {ITEM}, week_start, {sql_he('line + wave', 4)} AS observed, TRUE AS trend_is_the_line, TRUE AS season_is_the_wave, TRUE AS adds_up FROM ({MADE_SQL})""")
def stl_decompose(r: Retail):
    """A line and a wave over the weeks of every series are found again within a hundredth of the wave."""
    made = staged(made_series(long_filled(r)))
    parts = decompose.stl_decompose(made).join(made.select("store_id", "product_id", "week_start", "line", "wave"), ["store_id", "product_id", "week_start"])
    near = lambda a, b: F.abs(F.col(a) - F.col(b)) < WAVE / 100
    whole = F.abs(F.col("trend") + F.col("seasonal") + F.col("residual") - F.col("observed")) < 1e-9
    return parts.select(*ITEMS, "week_start", he("observed", 4), near("trend", "line").alias("trend_is_the_line"),
                        near("seasonal", "wave").alias("season_is_the_wave"), whole.alias("adds_up"))


@query("stl_all_series", f"""
    SELECT DISTINCT {ITEM}, TRUE AS is_fitted, TRUE AS slope_is_known, TRUE AS strengths_are_high, 'Growing' AS growth_direction FROM ({MADE_SQL})""")
def stl_all_series(r: Retail):
    """Every long series once, of the made values: their slope, strong parts and direction."""
    made = made_series(decompose.gap_fill(r.panel))
    found = decompose.stl_all_series(made)
    return found.select(*ITEMS, F.col("error").isNull().alias("is_fitted"), (F.abs(F.col("trend_slope") - SLOPE) < 0.01).alias("slope_is_known"),
                        ((F.col("trend_strength") > 0.99) & (F.col("seasonal_strength") > 0.99)).alias("strengths_are_high"), "growth_direction")
