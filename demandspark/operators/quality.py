"""Data quality report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.functions.numeric import round_half_even
from demandspark.functions.quantiles import exact_quantiles
from demandspark.session import staged


def profile(df: DataFrame, date: str = "date",
            keys: Sequence[str] = ("store_id", "product_id", "category")) -> DataFrame:
    """Row count, date range and distinct keys.

    The rows shrink to their key combinations first, so distinct counting does not multiply them.
    """
    combinations = df.groupBy(*keys).agg(F.count("*").alias("n"), F.min(date).alias("a"), F.max(date).alias("b"))
    return combinations.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.min("a").alias("date_min"), F.max("b").alias("date_max"),
                            *[F.countDistinct(k).alias(f"n_{k}") for k in keys])


def null_counts(df: DataFrame) -> DataFrame:
    """Columns that hold nulls, with their number."""
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_nulls")) for c in df.columns]
    return row.select(F.inline(F.array(*cells))).where("n_nulls > 0")


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each group of equal rows.

    A hash of each row is counted first; only rows whose hash occurs again are compared whole.
    """
    hashed = df.select(F.struct(*df.columns).alias("row"), F.xxhash64(*df.columns).alias("hash"))
    again = hashed.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
    copies = hashed.join(again, "hash", "left_semi").groupBy("row").agg(F.count("*").alias("copies"))
    return copies.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("n_duplicates"))


def describe(df: DataFrame, columns: Sequence[str] = ("units_sold", "unit_price", "revenue"),
             digits: int = 2) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles, one row per column.

    The columns are stored once, so the passes of the quartiles read neither ``df`` nor its inputs again.
    """
    df = staged(df.select(*columns))
    cells = [F.struct(F.lit(c).alias("column"), F.struct(
        F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.min(c).cast("double").alias("min"),
        F.max(c).cast("double").alias("max")).alias("s")) for c in columns]
    stats = F.broadcast(df.agg(F.array(*cells).alias("cells")).select(F.inline("cells")))
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])

    def out(col, name):
        return round_half_even(col, digits).alias(name)

    return quartiles.join(stats, "column").select(
        F.col("column").alias("column_name"), F.col("s.n").alias("n"),
        out(F.col("s.mean"), "mean"), out(F.col("s.std"), "std"), out(F.col("s.min"), "min"),
        out(F.col("q")[0], "q1"), out(F.col("q")[1], "median"), out(F.col("q")[2], "q3"),
        out(F.col("s.max"), "max"))


def filter_domains(df: DataFrame, date: str = "date") -> DataFrame:
    """Choices of the dashboard filters: every store and category with its first and last date."""
    # Both lists come from the same few combinations, whose exchange is reused.
    cells = df.groupBy("store_name", "category").agg(F.min(date).alias("a"), F.max(date).alias("b"))

    def domain(column: str) -> DataFrame:
        return cells.groupBy(F.lit(column).alias("domain"), F.col(column).alias("value")).agg(
            F.min("a").alias("date_min"), F.max("b").alias("date_max"))

    return domain("store_name").unionByName(domain("category"))
