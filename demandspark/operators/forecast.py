"""Recursive demand forecast."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from demandspark.constants import EPSILON, ITEM_KEYS, LAGS, ROLL_WINDOWS, SERIES_KEYS
from demandspark.functions.calendar import add_cyclic_features, add_week_calendar, festival_flag
from demandspark.functions.numeric import to_units
from demandspark.operators.features import CATEGORY_VECTOR
from demandspark.session import ensure_checkpoint_dir

HISTORY = max(*LAGS, *ROLL_WINDOWS)
CARRIED = ["store_name", "product_name", "category", "avg_price", "lead_time_days",
           "holding_cost_pct", "base_price"]


def category_features(panel: DataFrame) -> list[str]:
    """The one-hot columns, or the column of sparse vectors."""
    return [c for c in panel.columns if c.startswith("cat_") or c == CATEGORY_VECTOR]


def last_state(panel: DataFrame, onehot: Sequence[str]) -> DataFrame:
    """One row per series: its last units (at most twelve) and the attributes carried forward."""
    recent = W.partitionBy(*SERIES_KEYS).orderBy(F.desc("week_start"))
    rows = panel.withColumn("back", F.row_number().over(recent)).where(F.col("back") <= HISTORY)
    ordered = F.array_sort(F.collect_list(F.struct("week_start", F.col("units_sold").cast("double").alias("u"))))
    return rows.groupBy(*SERIES_KEYS).agg(
        F.max("week_start").alias("last_week"),
        F.max_by(F.struct(*CARRIED, *onehot), "week_start").alias("carried"),
        F.transform(ordered, lambda s: s["u"]).alias("hist")
    ).select(*SERIES_KEYS, "last_week", "hist", "carried.*")


def _array_mean(values):
    return F.aggregate(values, F.lit(0.0), lambda t, v: t + v) / F.size(values)


def _array_std(values, mean):
    """Sample deviation, zero for a single value."""
    total = F.aggregate(values, F.lit(0.0), lambda t, v: t + (v - mean) * (v - mean))
    return F.when(F.size(values) > 1, F.sqrt(total / (F.size(values) - 1))).otherwise(0.0)


def _tail(values, n: int):
    return F.when(F.size(values) > n, F.slice(values, F.size(values) - n + 1, n)).otherwise(values)


def next_week_features(state: DataFrame, horizon: int) -> DataFrame:
    """Feature columns of the week ``horizon`` weeks after the last, without promotion."""
    hist = F.col("hist")
    df = state.withColumn("week_start", F.date_add("last_week", 7 * horizon))
    df = add_cyclic_features(add_week_calendar(df))
    df = df.withColumns({
        "is_promo_week": F.lit(0), "promo_days": F.lit(0).cast("bigint"),
        "stockout_days": F.lit(0).cast("bigint"), "is_festival_season": festival_flag(F.col("month")),
        # A history shorter than the lag answers with its mean.
        **{f"lag_{k}w": F.when(F.size(hist) >= k, F.get(hist, F.size(hist) - k)).otherwise(_array_mean(hist))
           for k in LAGS},
        **{f"tail_{w}": _tail(hist, w) for w in ROLL_WINDOWS},
    })
    df = df.withColumns({f"roll_mean_{w}w": _array_mean(F.col(f"tail_{w}")) for w in ROLL_WINDOWS})
    rolling = {}
    for w in ROLL_WINDOWS:
        values = F.col(f"tail_{w}")
        rolling[f"roll_std_{w}w"] = _array_std(values, F.col(f"roll_mean_{w}w"))
        rolling[f"roll_max_{w}w"] = F.array_max(values)
    df = df.withColumns(rolling)
    df = df.withColumns({
        "promo_x_festival": F.col("is_promo_week") * F.col("is_festival_season"),
        "price_x_promo": F.col("avg_price") * F.col("is_promo_week"),
        "demand_cv_4w": F.col("roll_std_4w") / (F.col("roll_mean_4w") + EPSILON),
    })
    return df.drop(*[f"tail_{w}" for w in ROLL_WINDOWS])


def recursive_forecast(panel: DataFrame, predict: Callable[[DataFrame], DataFrame], weeks: int = 12,
                       checkpoint_every: int = 4) -> DataFrame:
    """Forecast each series week by week, feeding every prediction back as history.

    ``predict`` adds a ``prediction`` column, as a fitted pipeline's ``transform`` does. The state
    is one row per series and bounded in width: twelve history values and the weeks forecast so
    far, unfolded once at the end. Checkpoints keep the plan from growing with the horizon.
    """
    ensure_checkpoint_dir(panel.sparkSession)
    onehot = category_features(panel)
    state = last_state(panel, onehot)
    carried = [c for c in state.columns if c != "hist"]
    state = state.checkpoint()
    for horizon in range(1, weeks + 1):
        rows = next_week_features(state, horizon)
        emitted = [c for c in rows.columns if c not in state.columns]
        scored = predict(rows).withColumn("units", to_units(F.col("prediction")))
        week = F.struct(*emitted, F.col("units").alias("predicted_units"), F.lit(horizon).alias("horizon_week"))
        done = F.concat(F.col("done"), F.array(week)) if horizon > 1 else F.array(week)
        grown = F.concat(F.col("hist"), F.array(F.col("units").cast("double")))
        state = scored.withColumns({"done": done, "grown": grown}).select(
            *carried, _tail(F.col("grown"), HISTORY).alias("hist"), "done")
        if horizon % checkpoint_every == 0 or horizon == weeks:
            state = state.checkpoint()
    out = state.select(*SERIES_KEYS, *CARRIED, *onehot, F.explode("done").alias("w"))
    return out.select(*SERIES_KEYS, *CARRIED, *onehot, "w.*").withColumn("units_sold", F.col("predicted_units"))


def append_forecast(panel: DataFrame, forecast: DataFrame) -> DataFrame:
    """History and forecast as one table; history has no horizon."""
    return panel.unionByName(forecast, allowMissingColumns=True)


def naive_forecast(panel: DataFrame, weeks: int = 12, mean_of: int = 4) -> DataFrame:
    """Mean of the last weeks, repeated: a closed-form baseline for reports without a model."""
    recent = W.partitionBy(*SERIES_KEYS).orderBy(F.desc("week_start"))
    last = (panel.withColumn("back", F.row_number().over(recent)).where(F.col("back") <= mean_of)
            .groupBy(*ITEM_KEYS).agg(F.max("week_start").alias("last_week"), F.avg("units_sold").alias("m")))
    return (last.withColumn("horizon_week", F.explode(F.sequence(F.lit(1), F.lit(weeks))))
            .select(*ITEM_KEYS, "horizon_week", F.date_add("last_week", 7 * F.col("horizon_week")).alias("week_start"),
                    to_units(F.col("m")).alias("predicted_units")))
