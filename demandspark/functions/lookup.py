"""Small lookup tables from Python mappings, and lookups over them."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_LITERAL_ROWS = 10_000


def literal_table(spark: SparkSession, mapping: Mapping[str, Any], key: str, *values: str) -> DataFrame:
    """A mapping as a table to broadcast. The rows sit in the plan, so their number is checked."""
    if len(mapping) > MAX_LITERAL_ROWS:
        raise ValueError(f"{len(mapping)} rows are a table, not a literal: read them from storage")
    rows = []
    for k, v in mapping.items():
        parts = v if isinstance(v, tuple) else (v,)
        rows.append(F.struct(F.lit(k).alias(key), *[F.lit(p).alias(n) for n, p in zip(values, parts)]))
    return F.broadcast(spark.range(1).select(F.inline(F.array(*rows))))


def look_up(df: DataFrame, table: DataFrame, on: str, defaults: Mapping[str, Any] | None = None,
            unmapped: str = "keep") -> DataFrame:
    """Left join to a lookup table with one row per key.

    ``unmapped="drop"`` removes rows without an entry. A literal table is broadcast; one from
    storage carries no hint, so Spark broadcasts it while its size is under the threshold.
    """
    if unmapped not in ("keep", "drop"):
        raise ValueError("unmapped is 'keep' or 'drop'")
    joined = df.join(table, on, "inner" if unmapped == "drop" else "left")
    fills: dict[str, Column] = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in (defaults or {}).items()}
    return joined.withColumns(fills) if fills else joined
