"""Exact quantiles by counting value bins; no task gathers an unbounded set of values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Bins per power of two on the first level, bins of a chosen bin on the second.
BINS_PER_OCTAVE = 1024
INNER_BINS = 65_536
# Above any scaled logarithm of a double, so that bins of numbers below one stay on their side of zero.
_OFFSET = 2.0 ** 22


def _bin(value: Column) -> Column:
    """An integer that rises with the value; zero, the infinities and NaN have their own."""
    size = F.when(F.abs(value) == float("inf"), 2 * _OFFSET).otherwise(F.floor(F.log2(F.abs(value)) * BINS_PER_OCTAVE))
    return (F.when(F.isnan(value), 4 * _OFFSET).when(value == 0, 0.0)
            .otherwise(F.signum(value) * (size + _OFFSET))).cast("bigint")


def _inner_bin(value: Column, low: Column, high: Column) -> Column:
    return F.floor((value - low) / (high - low) * (INNER_BINS - 1)).cast("int")


def _holding(bins: DataFrame, within: Sequence[str], order: str) -> DataFrame:
    """The bins that hold a wanted rank, with ``ranks`` counted from each bin's own start."""
    upto = F.sum("n").over(W.partitionBy(*within).orderBy(order).rowsBetween(W.unboundedPreceding, 0))
    before = F.col("upto") - F.col("n")
    held = F.filter("ranks", lambda r: (r["rank"] >= before) & (r["rank"] < F.col("upto")))
    moved = F.transform(held, lambda r: F.struct(r["i"].alias("i"), (r["rank"] - before).alias("rank")))
    return bins.withColumn("upto", upto).withColumn("ranks", moved).where(F.size("ranks") > 0).drop("upto", "n")


def _match(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", small: bool = False) -> DataFrame:
    """Join by keys that may be null."""
    renamed = right.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return left.join(F.broadcast(renamed) if small else renamed, same, how).drop(*[f"_{k}" for k in keys])


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Interpolated quantiles: one row per group and column with ``q``, an array along ``probs``.

    A group or column without values has nulls in ``q``, and without ``by`` every column has a row.
    Rows are counted by bins of the logarithm, partially before the shuffle. The few bins that hold a
    wanted rank are counted again by finer bins, and of those that hold one the values themselves.
    The running counts see one row per bin. All sizes take this path.
    """
    keys = [*by, "column"]
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    values = df.select(*by, F.inline(F.array(*cells))).withColumn("bin", _bin(F.col("value")))
    bins = values.groupBy(*keys, "bin").agg(F.count("value").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
    everyone = bins.groupBy(*keys).agg(F.sum("n").alias("total"))
    if not by:
        spark = df.sparkSession
        names = spark.range(1).select(F.explode(F.array(*map(F.lit, columns))).alias("column"))
        everyone = names.join(everyone, "column", "left").withColumn("total", F.coalesce("total", F.lit(0)))
    total = F.sum("n").over(W.partitionBy(*keys))
    places = [(i, end(F.lit(float(p)) * (F.col("total") - 1))) for i, p in enumerate(probs) for end in (F.floor, F.ceil)]
    ranks = F.array(*[F.struct(F.lit(2 * i + k % 2).alias("i"), r.cast("bigint").alias("rank")) for k, (i, r) in enumerate(places)])
    first = _holding(bins.where("n > 0").withColumn("total", total).withColumn("ranks", ranks).drop("total"), keys, "bin")

    # Without groups the chosen bins are a few per column and broadcast; with groups their size decides.
    wide = first.where("low < high")
    near = _match(values, wide, [*keys, "bin"], small=not by)
    near = near.withColumn("inner", _inner_bin(F.col("value"), F.col("low"), F.col("high")))
    finer = near.groupBy(*keys, "bin", "inner").agg(F.count("*").alias("n"), F.any_value("ranks").alias("ranks"),
                                                    F.any_value("low").alias("low"), F.any_value("high").alias("high"))
    second = _holding(finer, [*keys, "bin"], "inner").withColumnRenamed("inner", "chosen")
    last = (_match(values, second, [*keys, "bin"], small=not by)
            .where(_inner_bin(F.col("value"), F.col("low"), F.col("high")) == F.col("chosen"))
            .groupBy(*keys, "bin", "chosen", "value").agg(F.count("*").alias("n"), F.any_value("ranks").alias("ranks")))
    exact = _holding(last, [*keys, "bin", "chosen"], "value").select(*keys, "value", "ranks")
    found = first.where("NOT low < high").select(*keys, F.col("low").alias("value"), "ranks").unionByName(exact)
    by_place = found.select(*keys, "value", F.explode("ranks").alias("r")).groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("r.i"), F.col("value")))).alias("at"))
    joined = _match(everyone, by_place, keys, "left")
    out = []
    for i, p in enumerate(probs):
        a, b = F.col("at")[2 * i], F.col("at")[2 * i + 1]
        place = F.lit(float(p)) * (F.col("total") - 1)
        out.append(F.when(a == b, a).otherwise(a + (place - F.floor(place)) * (b - a)))
    return joined.select(*keys, F.array(*out).alias("q"))

