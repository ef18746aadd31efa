"""The registry and the shared inputs of the registered queries."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.catalog.sql import CLIMATE, SENSITIVITY, with_views
from demandspark.constants import ITEM_KEYS
from demandspark.functions.calendar import add_time_features
from demandspark.functions.lookup import literal_table
from demandspark.functions.numeric import round_half_even
from demandspark.operators import anomaly, cleaning, features, forecast, inventory, pricing, promo, reports, weather
from demandspark.operators.rollup import weekly_rollup
from demandspark.session import staged
from demandspark.sources.tables import retail_sales

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL_TWINS: dict[str, str] = {}

CATEGORIES = [f"CAT{i}" for i in range(5)]
STORE_NAMES = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


def query(name: str, sql: str | None = None):
    """Register a query over the retail inputs; ``sql`` may use the views of ``catalog.sql``."""
    def register(fn: Callable[[Retail], DataFrame]):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Retail(spark, sf_dir))

        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            SQL_TWINS[name] = with_views(sql)
        return fn
    return register


def he(column: str | Column, digits: int = 6) -> Column:
    """Rounded result column; a named column keeps its name."""
    if isinstance(column, str):
        return round_half_even(F.col(column), digits).alias(column)
    return round_half_even(column, digits)


def number_of(column: str) -> Column:
    """The digits of a store or product id."""
    return F.substring(column, 2, 10).cast("bigint")


class Retail:
    """Lazy inputs over one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.panel_written = False

    @cached_property
    def lines(self) -> DataFrame:
        return retail_sales(self.spark, self.sf_dir)

    @cached_property
    def sales(self) -> DataFrame:
        return self.lines.drop("l_orderkey", "l_linenumber")

    @cached_property
    def dirty(self) -> DataFrame:
        """Sales with copies, missing and negative units."""
        units = (F.when(F.col("l_orderkey") % 17 == 0, F.lit(None).cast("bigint"))
                 .when(F.col("l_orderkey") % 19 == 0, -F.col("units_sold"))
                 .otherwise(F.col("units_sold")))
        # A row with line number 1 appears twice.
        copies = F.when(F.col("l_linenumber") == 1, F.lit(2)).otherwise(F.lit(1))
        return (self.lines.withColumn("units_sold", units)
                .withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
                .drop("l_orderkey", "l_linenumber", "copy"))

    @cached_property
    def clamped(self) -> DataFrame:
        return cleaning.clamp_negative(cleaning.dedupe_exact(self.dirty))

    @cached_property
    def daily(self) -> DataFrame:
        return add_time_features(self.sales)

    @cached_property
    def weekly(self) -> DataFrame:
        return weekly_rollup(self.sales)

    @cached_property
    def panel_full(self) -> DataFrame:
        return features.build_features(self.weekly, CATEGORIES, keep_warmup=True)

    @cached_property
    def panel(self) -> DataFrame:
        return features.build_features(self.weekly, CATEGORIES)

    def staged(self) -> Retail:
        """Write the panel once, for queries that read it several times: one scan of the sales."""
        if not self.panel_written:
            self.panel, self.panel_written = staged(self.panel), True
        return self

    @cached_property
    def policy(self) -> DataFrame:
        return inventory.policy(self.panel)

    @cached_property
    def stock(self) -> DataFrame:
        """Deterministic stand-in for a stock table: 0.4 to 2.479 times reorder point plus half an order."""
        factor = (400 + 21 * ((number_of("store_id") * 31 + number_of("product_id") * 17) % 100)) / 1000
        level = F.rint((F.col("reorder_point") + F.col("EOQ") / 2) * factor).cast("bigint")
        return self.policy.select("store_id", "product_id", level.alias("current_stock"))

    @cached_property
    def naive(self) -> DataFrame:
        return forecast.naive_forecast(self.panel)

    @cached_property
    def report(self) -> DataFrame:
        self.staged()
        return inventory.inventory_report(self.panel, self.stock, self.naive)

    @cached_property
    def alerts(self) -> DataFrame:
        return inventory.reorder_alerts(self.report, ordered=False)

    @cached_property
    def sensitivity(self) -> DataFrame:
        return literal_table(self.spark, SENSITIVITY, "category", "sensitivity")

    @cached_property
    def climate(self) -> DataFrame:
        return literal_table(self.spark, CLIMATE, "store_name", "base_temp", "temp_amp")

    @cached_property
    def weather(self) -> DataFrame:
        """Seasonal temperature with rain by arithmetic; every tenth week is missing."""
        self.staged()
        stores = self.panel.select("store_name", "store_id").distinct()
        spine = reports.week_store_spine(self.panel).join(stores, "store_name")
        rain = ((F.weekofyear("week_start") * 7 + number_of("store_id") * 13) % 40).cast("double")
        table = weather.climate_baseline(spine, self.climate).withColumn("rainfall_mm", rain)
        return (table.withColumn("is_rainy_week", weather.rainy_flag(F.col("rainfall_mm")))
                .where(F.weekofyear("week_start") % 10 != 0).drop("store_id"))

    @cached_property
    def merged(self) -> DataFrame:
        return weather.weather_adjusted_demand(self.panel, self.weather, self.sensitivity)

    @cached_property
    def uplift(self) -> DataFrame:
        return promo.promo_uplift(self.panel)

    @cached_property
    def elasticity(self) -> DataFrame:
        return pricing.simple_elasticity(self.panel)

    @cached_property
    def scenarios(self) -> DataFrame:
        self.staged()
        return pricing.price_scenarios(pricing.price_demand_base(self.elasticity, self.panel))

    @cached_property
    def zscored(self) -> DataFrame:
        return anomaly.series_zscore(self.panel)

    @cached_property
    def flagged(self) -> DataFrame:
        """Z-scores beside an arithmetic stand-in for the forest's flag and score."""
        self.staged()
        return anomaly.combine_anomalies(self.zscored.withColumns({
            "anomaly_if": F.col("units_sold") % 20 == 0,
            "if_score": -F.col("units_sold") / 1000}))

    @cached_property
    def anomalies(self) -> DataFrame:
        return anomaly.anomaly_report(self.flagged, ordered=False)


ITEM = ITEM_KEYS
