"""Gap filling, trend and seasonality per series."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql import types as T

from demandspark.constants import EPSILON, ITEM_KEYS, SERIES_KEYS
from demandspark.functions.numeric import round_half_even
from demandspark.session import spread_by

PERIOD = 52
MIN_WEEKS = 104


def gap_fill(panel: DataFrame, value: str = "units_sold", keys: Sequence[str] = ITEM_KEYS,
             time: str = "week_start") -> DataFrame:
    """Every week between a series' first and last, missing values interpolated linearly.

    Each known week unfolds into the weeks up to the next known one, so neither a calendar nor a
    join is needed. Missing values at the ends take the nearest known one.
    """
    sums = panel.groupBy(*keys, time).agg(F.sum(value).cast("double").alias(value))
    series = W.partitionBy(*keys)
    ordered = series.orderBy(time)
    known = (sums.withColumns({"first_t": F.min(time).over(series), "last_t": F.max(time).over(series)})
             .where(F.col(value).isNotNull())
             .withColumns({"prev_t": F.lag(time).over(ordered), "next_t": F.lead(time).over(ordered),
                           "next_v": F.lead(value).over(ordered)}))
    start = F.when(F.col("prev_t").isNull(), F.col("first_t")).otherwise(F.col(time))
    end = F.when(F.col("next_t").isNull(), F.col("last_t")).otherwise(F.date_sub("next_t", 7))
    step = F.datediff("t", time) / F.datediff("next_t", time)
    filled = F.when(F.col("next_t").isNull() | (F.col("t") <= F.col(time)), F.col(value)).otherwise(
        F.col(value) + (F.col("next_v") - F.col(value)) * step)
    return (known.withColumn("t", F.explode(F.sequence(start, end, F.expr("interval 7 days"))))
            .select(*keys, F.col("t").alias(time), filled.alias(value)))


def row_index(df: DataFrame, keys: Sequence[str] = SERIES_KEYS, time: str = "week_start") -> DataFrame:
    """Position in the series, from zero."""
    return df.withColumn("idx", F.row_number().over(W.partitionBy(*keys).orderBy(time)) - 1)


def long_series(df: DataFrame, min_rows: int = MIN_WEEKS, keys: Sequence[str] = ITEM_KEYS) -> DataFrame:
    """Only series with enough rows."""
    counted = df.withColumn("series_rows", F.count("*").over(W.partitionBy(*keys)))
    return counted.where(F.col("series_rows") >= min_rows).drop("series_rows")


def classical_decompose(filled: DataFrame, value: str = "units_sold", keys: Sequence[str] = ITEM_KEYS,
                        time: str = "week_start", period: int = PERIOD) -> DataFrame:
    """Centred moving average, mean deviation per phase and the rest, as window expressions."""
    half = period // 2
    ordered = W.partitionBy(*keys).orderBy(time)
    phase = W.partitionBy(*keys, "phase")
    # Partitioned by series first, the phase windows sort within the same exchange.
    return (filled.repartition(*keys)
            .withColumns({"idx": F.row_number().over(ordered) - 1,
                          "trend": F.avg(value).over(ordered.rowsBetween(-half, half))})
            .withColumn("phase", F.col("idx") % period)
            .withColumn("seasonal", F.avg(F.col(value) - F.col("trend")).over(phase))
            .withColumn("residual", F.col(value) - F.col("trend") - F.col("seasonal"))
            .select(*keys, F.col(time), "idx", F.col(value).cast("double").alias("observed"),
                    "trend", "seasonal", "residual"))


def _decompose_batch(period: int, keys: Sequence[str], most_cells: int = 200_000):
    """Series of one length are decomposed together, at most ``most_cells`` values at once."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from demandspark.functions.stl import stl_batch

        for rows in batches:
            values = [np.asarray(v, dtype=float) for v in rows["observed"]]
            parts = {c: [None] * len(rows) for c in ("trend", "seasonal", "residual", "error")}
            for group in _alike(values, most_cells):
                try:
                    found = stl_batch(np.stack([values[i] for i in group]), period)
                except (ValueError, ArithmeticError) as error:
                    for i in group:
                        parts["error"][i] = str(error)
                    continue
                for name, matrix in zip(("trend", "seasonal", "residual"), found):
                    for i, line in zip(group, matrix):
                        parts[name][i] = line
            out = rows[[*keys, "weeks", "observed"]]
            yield out.assign(**{c: pd.Series(v, index=rows.index, dtype=object) for c, v in parts.items()})
    return run


def _alike(values: list[np.ndarray], most_cells: int) -> Iterator[list[int]]:
    """Positions of equally long series without gaps, in groups of bounded size; others are alone."""
    places: dict[tuple, list[int]] = {}
    for i, v in enumerate(values):
        places.setdefault((len(v), -1 if np.isfinite(v).all() else i), []).append(i)
    for (n, _), own in places.items():
        step = max(1, most_cells // max(n, 1))
        for lo in range(0, len(own), step):
            yield own[lo:lo + step]


def stl_decompose(filled: DataFrame, value: str = "units_sold", keys: Sequence[str] = ITEM_KEYS,
                  time: str = "week_start", period: int = PERIOD) -> DataFrame:
    """Robust STL of every series; equally long series of an Arrow batch are decomposed together.

    A series is one row while it is decomposed, with an array of calendar length. One that cannot be
    decomposed yields one row with the error text.
    """
    keys = list(keys)
    # A fit costs far more than its few rows weigh, so the tasks are spread by count, not by size.
    spread = spread_by(filled.select(*keys, time, F.col(value).cast("double").alias("value")), *keys)
    ordered = F.array_sort(F.collect_list(F.struct(F.col(time).alias("t"), F.coalesce("value", F.lit(float("nan"))).alias("v"))))
    series = spread.groupBy(*keys).agg(ordered.alias("s")).select(*keys, F.col("s.t").alias("weeks"), F.col("s.v").alias("observed"))
    arrays = [T.StructField(c, T.ArrayType(T.DoubleType())) for c in ("observed", "trend", "seasonal", "residual")]
    schema = T.StructType([*[filled.schema[k] for k in keys], T.StructField("weeks", T.ArrayType(filled.schema[time].dataType)),
                           *arrays, T.StructField("error", T.StringType())])
    parts = series.mapInPandas(_decompose_batch(period, keys), schema)
    names = ["observed", "trend", "seasonal", "residual"]
    # A failed series has no components, whose zip is null and unfolds to one row of nulls.
    fitted = parts.select(*keys, "error", F.posexplode_outer(F.arrays_zip("weeks", *names)).alias("idx", "x"))
    return fitted.select(*keys, F.col("x.weeks").alias(time), "idx", *[F.col(f"x.{c}").alias(c) for c in names], "error")


def decomposition_summary(components: DataFrame, keys: Sequence[str] = ITEM_KEYS,
                          epsilon: float = EPSILON) -> DataFrame:
    """Slope of the trend, strengths, residual deviation and growth direction per series.

    Components with an ``error`` keep a row for every series: a failed one has its text and nulls.
    """
    def strength(part: str):
        share = F.try_divide(F.var_pop("residual"), F.var_pop(F.col(part) + F.col("residual")) + epsilon)
        return F.greatest(F.lit(0.0), 1 - share)

    has_error = "error" in components.columns
    rows = components if has_error else components.where(F.col("trend").isNotNull())
    stats = rows.groupBy(*keys).agg(
        F.count("trend").alias("known"),
        F.regr_slope("trend", "idx").alias("slope"),
        strength("trend").alias("trend_strength"),
        strength("seasonal").alias("seasonal_strength"),
        F.stddev_samp("residual").alias("residual_std"),
        *([F.max("error").alias("error")] if has_error else []))
    fitted = F.col("known") > 0
    return stats.select(
        *keys,
        round_half_even(F.col("slope"), 4).alias("trend_slope"),
        F.when(fitted, round_half_even(F.col("trend_strength"), 4)).alias("trend_strength"),
        F.when(fitted, round_half_even(F.col("seasonal_strength"), 4)).alias("seasonal_strength"),
        round_half_even(F.col("residual_std"), 4).alias("residual_std"),
        F.when(fitted, growth_direction(F.col("slope"))).alias("growth_direction"),
        *(["error"] if has_error else []))


def growth_direction(slope):
    return F.when(slope > 0, "Growing").otherwise("Declining")


def stl_all_series(panel: DataFrame) -> DataFrame:
    """Decomposition summary of every series of two years or more; a failed one has a row with its error."""
    return decomposition_summary(stl_decompose(long_series(gap_fill(panel))))


def component_forecast(components: DataFrame, horizon: int = 12, period: int = PERIOD,
                       keys: Sequence[str] = ITEM_KEYS, time: str = "week_start") -> DataFrame:
    """Last trend continued by its slope plus the last cycle's seasonal, not below zero."""
    data = components.where(F.col("trend").isNotNull())
    recent = data.withColumn("back", F.row_number().over(W.partitionBy(*keys).orderBy(F.desc(time))))
    # Only the last cycle is gathered: at most `period` values per series.
    cycle = F.collect_list(F.when(F.col("back") <= period, F.struct("idx", "seasonal")))
    series = recent.groupBy(*keys).agg(
        F.regr_slope("trend", "idx").alias("slope"),
        F.max_by("trend", "idx").alias("last_trend"), F.max(time).alias("last_week"),
        F.transform(F.array_sort(cycle), lambda s: s["seasonal"]).alias("cycle"))
    h = F.col("horizon_week")
    seasonal = F.get("cycle", ((h - 1) % F.size("cycle")).cast("int"))
    return (series.withColumn("horizon_week", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
            .select(*keys, "horizon_week", F.date_add("last_week", 7 * h).alias(time),
                    F.greatest(F.lit(0.0), F.col("last_trend") + F.col("slope") * h + seasonal).alias("forecast")))


def linear_trend_baseline(panel: DataFrame, horizon: int = 12, value: str = "units_sold",
                          keys: Sequence[str] = SERIES_KEYS, time: str = "week_start") -> DataFrame:
    """Straight line through each series, continued over the horizon."""
    fit = row_index(panel, keys, time).groupBy(*keys).agg(
        F.regr_slope(value, "idx").alias("slope"), F.regr_intercept(value, "idx").alias("intercept"),
        F.max("idx").alias("last_idx"), F.max(time).alias("last_week"))
    h = F.col("horizon_week")
    return (fit.withColumn("horizon_week", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
            .select(*keys, "horizon_week", F.date_add("last_week", 7 * h).alias(time), "slope", "intercept",
                    (F.col("intercept") + F.col("slope") * (F.col("last_idx") + h)).alias("forecast")))


def strength_matrix(summary: DataFrame, stores: Sequence[str]) -> DataFrame:
    """Mean seasonal strength by product and store, zero where there is none."""
    return (summary.groupBy("product_name").pivot("store_name", list(stores))
            .agg(F.avg("seasonal_strength")).na.fill(0.0))
