"""Price elasticity and price scenarios."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from demandspark.constants import PRICE_DELTAS
from demandspark.functions.labels import elasticity_label, percent_label
from demandspark.functions.numeric import round_half_even
from demandspark.operators.regression import grouped_ols

PRODUCT_KEYS = ["product_id", "product_name", "category"]
CONTROLS = ["is_promo_week", "is_festival_season", "month", "year"]


def positive_demand(panel: DataFrame) -> DataFrame:
    return panel.where(F.col("units_sold") > 0)


def add_log_columns(panel: DataFrame) -> DataFrame:
    return panel.withColumns({"ln_quantity": F.log1p(F.col("units_sold").cast("double")),
                              "ln_price": F.log1p("avg_price")})


def price_elasticity(panel: DataFrame, min_rows: int = 20, ordered: bool = True) -> DataFrame:
    """Log-log slope of demand on price per product, beside promotion and calendar controls."""
    data = add_log_columns(positive_demand(panel))
    fit = grouped_ols(data, PRODUCT_KEYS, "ln_quantity", ["ln_price", *CONTROLS], min_rows)
    out = fit.select(*PRODUCT_KEYS,
                     round_half_even(F.col("coef")[0], 4).alias("price_elasticity"),
                     round_half_even(F.col("r2"), 4).alias("r2_score"),
                     elasticity_label(F.col("coef")[0]).alias("interpretation"))
    return out.orderBy("price_elasticity", "product_id") if ordered else out


def simple_elasticity(panel: DataFrame, min_rows: int = 20) -> DataFrame:
    """The one-regressor form."""
    fit = (add_log_columns(positive_demand(panel)).groupBy(*PRODUCT_KEYS)
           .agg(F.count("*").alias("n"),
                F.regr_slope("ln_quantity", "ln_price").alias("slope"),
                F.regr_r2("ln_quantity", "ln_price").alias("r2"))
           .where(F.col("n") >= min_rows))
    return fit.select(*PRODUCT_KEYS,
                      round_half_even(F.col("slope"), 4).alias("price_elasticity"),
                      round_half_even(F.col("r2"), 4).alias("r2_score"),
                      elasticity_label(F.col("slope")).alias("interpretation"))


def price_demand_base(elasticity: DataFrame, panel: DataFrame) -> DataFrame:
    """Elasticities with the product's mean price and mean weekly units."""
    base = panel.groupBy("product_id").agg(F.avg("avg_price").alias("avg_price"),
                                           F.avg("units_sold").alias("units_sold"))
    return elasticity.join(base, "product_id")


def price_scenarios(base: DataFrame, deltas: Sequence[float] = PRICE_DELTAS) -> DataFrame:
    """Each product under each price change, units by constant elasticity."""
    p0, q0, p1 = F.col("avg_price"), F.col("units_sold"), F.col("raw_price")
    units = F.when(p0 > 0, q0 * F.pow(p1 / p0, F.col("price_elasticity"))).otherwise(q0)
    return (base.withColumn("delta", F.explode(F.array(*[F.lit(float(d)) for d in deltas])))
            .withColumn("raw_price", p0 * (1 + F.col("delta")))
            .withColumn("raw_units", units)
            .select("product_id", "product_name", "delta",
                    round_half_even(p0, 2).alias("base_price"),
                    round_half_even(p1, 2).alias("test_price"),
                    percent_label(F.col("delta")).alias("price_change_pct"),
                    round_half_even(F.greatest(F.lit(0.0), F.col("raw_units")), 1).alias("predicted_units"),
                    round_half_even(F.greatest(F.lit(0.0), p1 * F.col("raw_units")), 2).alias("predicted_revenue")))


def optimal_price(scenarios: DataFrame) -> DataFrame:
    """The scenario with the largest rounded revenue per product, lowest change on ties.

    A constant elasticity makes revenue monotone in price, so the answer is an end of the grid
    unless the elasticity is -1.
    """
    best = W.partitionBy("product_id").orderBy(F.desc("predicted_revenue"), "delta")
    return (scenarios.withColumn("position", F.row_number().over(best)).where("position = 1")
            .select("product_id", "product_name", "base_price", "test_price", "price_change_pct",
                    "predicted_revenue"))
