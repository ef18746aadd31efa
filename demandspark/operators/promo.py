"""Promotion uplift, return and treatment effects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from demandspark.constants import (
    AB_TREATED_SHARE, EPSILON, ITEM_KEYS, PROMO_COST_PER_EVENT, SERIES_KEYS,
)
from demandspark.functions.numeric import round_half_even, student_two_sided_p


def promo_uplift(panel: DataFrame, weeks: int = 4, min_weeks: int = 2) -> DataFrame:
    """Each promotion week against the mean of the last earlier weeks without promotion.

    The trailing mean over the non-promotion rows is carried forward to the promotion rows, which
    is linear in the rows. Partitioning once by series serves both windows.
    """
    rows = panel.select(*ITEM_KEYS, "week_start", "units_sold", "avg_price", "is_promo_week")
    rows = rows.repartition(*SERIES_KEYS)
    recent = (W.partitionBy(*SERIES_KEYS, "is_promo_week").orderBy("week_start")
              .rowsBetween(-(weeks - 1), W.currentRow))
    earlier = (W.partitionBy(*SERIES_KEYS).orderBy("week_start")
               .rowsBetween(W.unboundedPreceding, -1))
    quiet = F.col("is_promo_week") == 0
    state = F.struct(F.avg("units_sold").over(recent).alias("mean"), F.count("*").over(recent).alias("n"))
    carried = (rows.withColumn("state", F.when(quiet, state))
               .withColumn("base", F.last("state", ignorenulls=True).over(earlier))
               .where((F.col("is_promo_week") == 1) & (F.col("base.n") >= min_weeks)))
    baseline = F.col("base.mean")
    extra = F.col("units_sold") - baseline
    return carried.select(
        "week_start", *ITEM_KEYS,
        round_half_even(baseline, 1).alias("baseline_units"),
        F.col("units_sold").alias("promo_units"),
        round_half_even(extra / (baseline + EPSILON) * 100, 2).alias("uplift_pct"),
        round_half_even(extra, 1).alias("incremental_units"),
        round_half_even(extra * F.col("avg_price"), 2).alias("incremental_revenue"))


def uplift_totals(uplift: DataFrame) -> DataFrame:
    return uplift.agg(F.count("*").alias("n_events"), F.avg("uplift_pct").alias("avg_uplift_pct"),
                      F.sum("incremental_revenue").alias("total_incremental_rev"))


def promo_roi(uplift: DataFrame, cost_per_event: float = PROMO_COST_PER_EVENT, ordered: bool = True) -> DataFrame:
    """Return on promotion cost per category."""
    roi = uplift.groupBy("category").agg(
        F.count("promo_units").alias("total_promo_events"),
        F.avg("uplift_pct").alias("avg_uplift_pct"),
        F.sum("incremental_revenue").alias("total_incremental_rev"))
    roi = roi.withColumn("assumed_promo_cost", F.col("total_promo_events") * F.lit(float(cost_per_event)))
    gain = F.col("total_incremental_rev") - F.col("assumed_promo_cost")
    roi = roi.withColumn("ROI_pct", round_half_even(F.try_divide(gain, F.col("assumed_promo_cost")) * 100, 1))
    return roi.orderBy(F.desc("ROI_pct"), "category") if ordered else roi


def ab_assignment(panel: DataFrame, share: float = AB_TREATED_SHARE, order_key: str | None = None) -> DataFrame:
    """Arm per store: the first share of the stores in a fixed order is treated.

    The order is a hash of the store unless a column is given. The window covers the store list.
    """
    stores = panel.select("store_id").distinct()
    order = [F.col(order_key)] if order_key else [F.xxhash64("store_id"), F.col("store_id")]
    position = F.row_number().over(W.orderBy(*order))
    total = F.count("*").over(W.partitionBy())
    return stores.withColumns({"position": position, "total": total}).select(
        "store_id",
        F.when(F.col("position") <= F.floor(F.col("total") * share), "Treatment").otherwise("Control").alias("ab_group"))


def ab_effect(panel: DataFrame, groups: DataFrame, min_rows: int = 5, ordered: bool = True) -> DataFrame:
    """Mean of the treated promotion weeks less the mean of all control weeks, per product.

    Significance is Welch's statistic on the two-sided tail of Student's t with Welch's degrees of freedom. Rows are reduced to sums per
    product and store before they meet the store's arm, so a hot store is never shuffled whole.
    """
    x = F.col("units_sold")
    promo_x = F.when(F.col("is_promo_week") == 1, x)

    def sums(name, v):
        return [F.count(v).alias(f"{name}_n"), F.sum(v).alias(f"{name}_sum"), F.sum(v * v).alias(f"{name}_sq")]

    cells = panel.groupBy("product_id", "product_name", "category", "store_id").agg(*sums("p", promo_x), *sums("a", x))
    treated, control = F.col("ab_group") == "Treatment", F.col("ab_group") == "Control"

    def arm(name, source, condition):
        return [F.sum(F.when(condition, F.col(f"{source}_{part}"))).alias(f"{name}_{part}") for part in ("n", "sum", "sq")]

    totals = (cells.join(groups, "store_id").groupBy("product_id", "product_name", "category")
              .agg(*arm("t", "p", treated), *arm("c", "a", control))
              .where((F.col("t_n") >= min_rows) & (F.col("c_n") >= min_rows)))

    def moments(name):
        n, total, squares = (F.col(f"{name}_{part}") for part in ("n", "sum", "sq"))
        return {f"{name}_mean": total / n, f"{name}_var": F.greatest((squares - total / n * total) / (n - 1), F.lit(0.0))}

    stats = totals.withColumns({**moments("t"), **moments("c")})
    ate = F.col("t_mean") - F.col("c_mean")
    t_part, c_part = F.col("t_var") / F.col("t_n"), F.col("c_var") / F.col("c_n")
    error = F.sqrt(t_part + c_part)
    degrees = (t_part + c_part) ** 2 / (t_part ** 2 / (F.col("t_n") - 1) + c_part ** 2 / (F.col("c_n") - 1))
    # Without spread any difference is certain and no difference is none.
    p = F.when(error > 0, student_two_sided_p(ate / error, degrees)).otherwise(
        F.when(ate == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    out = stats.withColumn("p", p).select(
        "product_id", "product_name", "category",
        round_half_even(F.col("t_mean"), 2).alias("treatment_avg"),
        round_half_even(F.col("c_mean"), 2).alias("control_avg"),
        round_half_even(ate, 2).alias("ATE"),
        round_half_even(ate / (F.col("c_mean") + EPSILON) * 100, 2).alias("ATE_pct"),
        round_half_even(F.col("p"), 4).alias("p_value"),
        (F.col("p") < 0.05).alias("significant"))
    return out.orderBy(F.desc("ATE_pct"), "product_id") if ordered else out
