"""Cleaning of the daily table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandspark.functions.numeric import floor_at_zero, round_half_even
from demandspark.functions.quantiles import exact_quantiles
from demandspark.session import staged

CLAMPED = ("units_sold", "revenue", "unit_price")
FLAGS = ("is_promotion", "is_weekend", "stockout_flag")


def dedupe_exact(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def clamp_negative(df: DataFrame, columns: Sequence[str] = CLAMPED) -> DataFrame:
    types = dict(df.dtypes)
    return df.withColumns({c: floor_at_zero(F.col(c)).cast(types[c]) for c in columns})


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def columns_with_nulls(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns to fill, from one pass and one row."""
    row = df.agg(*[F.max(F.col(c).isNull()).alias(c) for c in columns]).first()
    return [c for c in columns if row[c]]


def median_impute(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Fill nulls with the column's exact median; a filled column becomes double.

    Reads ``df`` several times: pass a stage table where it is dear to compute. A column without any
    value stays null.
    """
    found = columns_with_nulls(df, list(columns if columns is not None else numeric_columns(df)))
    if not found:
        return df
    medians = exact_quantiles(df, found, [0.5])
    table = medians.agg(F.map_from_entries(F.collect_list(F.struct("column", F.col("q")[0]))).alias("m")).scalar()
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), table[F.lit(c)]) for c in found})


def cast_flags(df: DataFrame, date: str = "date", flags: Sequence[str] = FLAGS) -> DataFrame:
    present = [c for c in flags if c in df.columns]
    return df.withColumns({date: F.col(date).cast("date"), **{c: F.col(c).cast("int") for c in present}})


def recompute_revenue(df: DataFrame) -> DataFrame:
    return df.withColumn("revenue", round_half_even(F.col("units_sold") * F.col("unit_price"), 2))


def clean_daily(df: DataFrame) -> DataFrame:
    """All cleaning steps in order: negatives become zero before nulls take the median."""
    df = staged(clamp_negative(dedupe_exact(df)))
    return recompute_revenue(cast_flags(median_impute(df)))
