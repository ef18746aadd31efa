"""The flagship query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from demandspark.catalog.base import Retail
from demandspark.operators.forecast import naive_forecast
from demandspark.operators.inventory import inventory_report


def flagship_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inventory report from the weekly roll-up, which also covers series shorter than the warm-up."""
    retail = Retail(spark, sf_dir)
    retail.panel = retail.weekly
    retail.staged()
    report = inventory_report(retail.panel, retail.stock, naive_forecast(retail.panel))
    return report.orderBy("store_id", "product_id")
