"""Distribution summaries: box plot numbers, histograms and correlations."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.functions.numeric import clip
from demandspark.functions.quantiles import exact_quantiles
from demandspark.session import staged


def box_stats(df: DataFrame, value: str, by: str) -> DataFrame:
    """Quartiles, 1.5-IQR whiskers and outlier count per group.

    The two columns are stored once, so the passes over them read neither ``df`` nor its inputs again.
    """
    data = staged(df.where(F.col(value).isNotNull() & F.col(by).isNotNull()).select(by, F.col(value).cast("double").alias("x")))
    quartiles = exact_quantiles(data, ["x"], [0.25, 0.5, 0.75], [by]).select(
        by, F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))
    spread = F.col("q3") - F.col("q1")
    inside = (F.col("x") >= F.col("q1") - 1.5 * spread) & (F.col("x") <= F.col("q3") + 1.5 * spread)
    return (data.join(quartiles, by)
            .groupBy(by, "q1", "median", "q3")
            .agg(F.min(F.when(inside, F.col("x"))).alias("whisker_low"),
                 F.max(F.when(inside, F.col("x"))).alias("whisker_high"),
                 F.count_if(~inside).alias("outliers"),
                 F.count("*").alias("n")))


def histogram(df: DataFrame, value: str, low: float, high: float, bins: int) -> DataFrame:
    """Equal-width bins between the smallest and largest clipped value; empty bins are absent.

    The last bin is closed on the right. A single distinct value gets a range of width one.
    """
    data = df.where(F.col(value).isNotNull()).select(clip(F.col(value), low, high).alias("x"))
    # The range rides along as scalar subqueries, so no row is shuffled before it is binned.
    ends = data.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi")).alias("ends")).scalar()
    flat = ends["lo"] == ends["hi"]
    start = F.when(flat, ends["lo"] - 0.5).otherwise(ends["lo"])
    width = F.when(flat, F.lit(1.0)).otherwise(ends["hi"] - ends["lo"]) / bins
    return (data.select(F.least(F.floor((F.col("x") - start) / width), F.lit(bins - 1)).cast("int").alias("bin"),
                        start.alias("start"), width.alias("width"))
            .groupBy("bin", "start", "width").agg(F.count("*").alias("n"))
            .select("bin", (F.col("start") + F.col("bin") * F.col("width")).alias("bin_start"), "n"))


def _pair_sums(origin: np.ndarray):
    """One row per task: for each pair of columns, over the rows where both are known, the number, and the sums of
    the first, of its square, and of the product."""
    def of_batch(x: np.ndarray, known: np.ndarray) -> np.ndarray:
        if np.isnan(x).any():  # NaN counts as known and stays in its own pairs
            k = x.shape[1]
            both = [[known[:, i] & known[:, j] for j in range(k)] for i in range(k)]
            return np.array([[[both[i][j].sum(), x[both[i][j], i].sum(), (x[both[i][j], i] ** 2).sum(), (x[both[i][j], i] * x[both[i][j], j]).sum()]
                              for j in range(k)] for i in range(k)]).transpose(2, 0, 1)
        mask = known.astype(float)
        return np.stack([mask.T @ mask, x.T @ mask, (x * x).T @ mask, x.T @ x])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((4, len(origin), len(origin)))
        for rows in batches:
            known = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in rows.columns])
            x = np.column_stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in rows.columns])
            total += of_batch(np.where(known, x - origin, 0.0), known)
        yield pa.RecordBatch.from_arrays([pa.array([total.reshape(-1)], pa.list_(pa.float64()))], ["sums"])
    return run


def correlations(df: DataFrame, columns: Sequence[str], sample: int = 1000) -> DataFrame:
    """Pearson correlation of every pair (lower triangle) on the pair's complete rows, one row per pair.

    All pairs come from one pass. Values are taken from the mean of at most ``sample`` rows, which only keeps
    digits. A pair without two complete rows or without spread has a null; a NaN makes its pairs NaN.
    """
    columns = list(columns)
    k = len(columns)
    data = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    near = data.limit(sample).agg(*[F.avg(F.nanvl(c, F.lit(None).cast("double"))).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    origin = np.array([m if m is not None and np.isfinite(m) else 0.0 for m in near])
    sums = (data.mapInArrow(_pair_sums(origin), "sums array<double>").select(F.posexplode("sums").alias("at", "x"))
            .groupBy("at").agg(F.sum("x").alias("x")))
    table = sums.agg(F.map_from_entries(F.collect_list(F.struct("at", "x"))).alias("s"))  # four entries per pair of columns
    pairs = [F.struct(F.lit(columns[j]).alias("row_name"), F.lit(columns[i]).alias("col_name"), F.lit(i).alias("i"), F.lit(j).alias("j"))
             for i, j in combinations(range(k), 2)]
    i, j = F.col("i"), F.col("j")

    def cell(part: int, a, b):
        return F.coalesce(F.col("s")[part * k * k + a * k + b], F.lit(0.0))

    known = table.select("s", F.inline(F.array(*pairs))).select(
        "row_name", "col_name", cell(0, i, j).alias("n"), cell(1, i, j).alias("x"), cell(1, j, i).alias("y"),
        cell(2, i, j).alias("xx"), cell(2, j, i).alias("yy"), cell(3, i, j).alias("xy"))
    vx, vy = (F.col(q) - F.try_divide(F.col(v) * F.col(v), "n") for v, q in (("x", "xx"), ("y", "yy")))
    r = (F.col("xy") - F.try_divide(F.col("x") * F.col("y"), "n")) / F.sqrt(F.col("vx") * F.col("vy"))
    limited = F.when(F.isnan(r), r).otherwise(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))
    # What is left of a constant column is rounding.
    spread = (F.col("vx") > 1e-13 * F.col("xx")) & (F.col("vy") > 1e-13 * F.col("yy"))
    return known.withColumns({"vx": vx, "vy": vy}).select("row_name", "col_name", F.when((F.col("n") >= 2) & (spread | F.isnan("vx") | F.isnan("vy")), limited).alias("corr"))
