"""ERP stock and purchase order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.constants import OPEN_PO_STATUSES
from demandspark.sources.schemas import ERP_OPEN_PO, ERP_STOCK
from demandspark.sources.tables import read_table


def read_erp_stock(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, ERP_STOCK)


def read_erp_orders(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, ERP_OPEN_PO)


def stock_snapshot(erp_stock: DataFrame) -> DataFrame:
    """ERP stock rows as the stock table of the inventory report.

    Free stock is the current stock; several plants of one store and material add up.
    """
    return (erp_stock.withColumnRenamed("material_id", "product_id")
            .groupBy("store_id", "product_id")
            .agg(F.sum("unrestricted_stock").cast("bigint").alias("current_stock"),
                 F.sum("in_transit_qty").cast("bigint").alias("in_transit_qty"),
                 F.sum("reserved_qty").cast("bigint").alias("reserved_qty")))


def open_orders_by_item(orders: DataFrame) -> DataFrame:
    """Open quantity and next delivery per store and product."""
    return (orders.where(F.col("status").isin(OPEN_PO_STATUSES))
            .groupBy("store_id", F.col("material_id").alias("product_id"))
            .agg(F.count("*").alias("open_orders"),
                 F.sum("quantity").cast("bigint").alias("open_qty"),
                 F.min("expected_delivery").alias("next_delivery")))
