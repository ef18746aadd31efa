"""Scans of the sales inputs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from demandspark.functions.numeric import round_half_even
from demandspark.sources.schemas import DAILY_SALES
from demandspark.sources.stages import current_folder


def read_table(spark: SparkSession, path: str, schema: StructType | None = None,
               fmt: str | None = None) -> DataFrame:
    """CSV or Parquet scan of files or of a stage table; a CSV needs a declared schema. A missing path raises on analysis."""
    fmt = fmt or ("csv" if path.rstrip("/").endswith(".csv") else "parquet")
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if fmt == "csv":
        if schema is None:
            raise ValueError("a CSV scan needs a declared schema")
        return reader.option("header", True).csv(current_folder(spark, path))
    return reader.format(fmt).load(current_folder(spark, path))


def read_daily_sales(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """Daily sales rows, one per store, product and day."""
    return read_table(spark, path, DAILY_SALES, fmt)


def retail_sales(spark: SparkSession, sf_dir: str, start: dt.date | None = None,
                 end: dt.date | None = None) -> DataFrame:
    """The driver's order lines in the shape of the daily sales table.

    Stores are regions, products are brands, prices have two decimals. Joins carry no hint: sizes decide, and AQE splits
    the partitions of a hot part or supplier. An inclusive date range is compared with the stored
    column, so it reaches the Parquet filters.
    """
    def table(name: str, *columns: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)

    brand_no = F.substring("p_brand", 7, 10).cast("int")
    lines = table("lineitem", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                  "l_quantity", "l_extendedprice", "l_discount")
    if start is not None:
        lines = lines.where(F.col("l_shipdate") >= F.lit(start).cast(lines.schema["l_shipdate"].dataType))
    if end is not None:
        after = F.lit(end + dt.timedelta(days=1))
        lines = lines.where(F.col("l_shipdate") < after.cast(lines.schema["l_shipdate"].dataType))
    parts = table("part", "p_partkey", "p_brand").withColumn("brand_no", brand_no)
    def numbered(prefix: str, number):
        return F.concat(F.lit(prefix), F.lpad(number.cast("string"), 3, "0"))

    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    price = round_half_even(net / F.col("l_quantity"), 2)
    units = F.col("l_quantity").cast("bigint")
    # One dimension at a time: each is then judged, and broadcast, by the size of its own files.
    return (lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
            .join(table("supplier", "s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
            .join(table("nation", "n_nationkey", "n_name", "n_regionkey"),
                  F.col("s_nationkey") == F.col("n_nationkey"))
            .join(table("region", "r_regionkey", "r_name"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.col("l_shipdate").cast("date").alias("date"),
                numbered("S", F.col("r_regionkey") + 1).alias("store_id"),
                F.col("r_name").alias("store_name"),
                F.col("n_name").alias("state"),
                numbered("P", F.col("brand_no")).alias("product_id"),
                F.col("p_brand").alias("product_name"),
                F.concat(F.lit("CAT"), (F.col("brand_no") % 5).cast("string")).alias("category"),
                units.alias("units_sold"),
                price.alias("unit_price"),
                round_half_even(units * price, 2).alias("revenue"),
                (F.col("l_discount") >= 0.095).cast("int").alias("is_promotion"),
                ((F.col("l_orderkey") + F.col("l_linenumber")) % 25 == 0).cast("int").alias("stockout_flag"),
                (2 + F.col("brand_no") % 6).cast("int").alias("lead_time_days"),
                ((15 + 5 * (F.col("brand_no") % 4)) / 100).alias("holding_cost_pct"),
                (20 + 10 * F.col("brand_no")).cast("double").alias("base_price"),
                "l_orderkey", "l_linenumber",
            ))
