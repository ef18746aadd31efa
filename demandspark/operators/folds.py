"""Expanding-window validation of least squares from prefix sums of normal equations."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.functions.numeric import to_units
from demandspark.operators.models import TARGET, expanding_folds, regression_metrics
from demandspark.session import staged

#: Singular values below this share of the largest count as zero.
RANK = 1e-12


def _moments(columns: Sequence[str], target: str, origin: np.ndarray, scale: np.ndarray) -> Callable:
    """One row per task and fold: the products of all scaled inputs, a one and the target, added up."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for rows in batches:
            fold = rows.column(0).to_numpy()
            z = np.column_stack([(rows.column(i + 1).to_numpy(zero_copy_only=False) - origin[i]) / scale[i] for i in range(len(origin))])
            z = np.column_stack([z[:, :-1], np.ones(len(z)), z[:, -1]])
            for v in np.unique(fold):
                part = z[fold == v]
                sums[int(v)] = sums.get(int(v), 0) + part.T @ part
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()), pa.array([s.reshape(-1) for s in sums.values()], pa.list_(pa.float64()))], ["fold", "products"])
    return run


def fold_products(marked: DataFrame, columns: Sequence[str], target: str = TARGET) -> tuple[dict[int, np.ndarray], np.ndarray, np.ndarray]:
    """The normal equations of every fold, added up in one scan, with the origin and scale they are taken in.

    Columns are shifted by their mean and divided by their spread, so that sums of products lose no digits.
    A task sends one matrix a fold; folds times squared columns reach the driver.
    """
    used = [*columns, target]
    one = marked.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(used)], *[F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(used)]).first()
    origin = np.array([one[f"m{i}"] or 0.0 for i in range(len(used))], float)
    scale = np.array([one[f"s{i}"] or 1.0 for i in range(len(used))], float)
    rows = marked.select("fold", *[F.col(c).cast("double") for c in used])
    sums = (rows.mapInArrow(_moments(columns, target, origin, scale), "fold int, products array<double>")
            .select("fold", F.posexplode("products").alias("at", "x")).groupBy("fold", "at").agg(F.sum("x").alias("x")).collect())
    size, out = len(used) + 1, {}
    for r in sums:
        out.setdefault(r.fold, np.zeros(size * size))[r.at] = r.x
    return {v: m.reshape(size, size) for v, m in out.items()}, origin, scale


def solve_prefixes(products: dict[int, np.ndarray], origin: np.ndarray, scale: np.ndarray, folds: int) -> dict[int, tuple[int, np.ndarray, float]]:
    """For each fold after the first: training rows, coefficients and intercept of all rows before it.

    Inputs that do not vary, or depend on others, get the solution of least norm in scaled units.
    """
    out, total = {}, 0
    for v in range(1, folds + 1):
        total = total + products.get(v - 1, 0)
        if np.ndim(total) == 0:
            continue
        p = len(origin) - 1
        n, sums, y = total[p, p], total[p, :p], total[p, p + 1]
        xx = total[:p, :p] - np.outer(sums, sums) / n
        xy = total[:p, p + 1] - sums * y / n
        b = np.linalg.pinv(xx, rcond=RANK, hermitian=True) @ xy
        coefficients = b * scale[-1] / scale[:-1]
        intercept = origin[-1] + scale[-1] * (y - b @ sums) / n - coefficients @ origin[:-1]
        out[v] = (int(round(n)), coefficients, float(intercept))
    return out


def linear_folds(panel: DataFrame, columns: Sequence[str], folds: int = 5, target: str = TARGET) -> tuple[DataFrame, DataFrame]:
    """Coefficients by fold, and the validation rows with their ``fold`` and ``predicted``.

    Fold v is predicted by least squares on all earlier folds. The normal equations are added up once and
    every fold solves its prefix; the coefficients equal those of separate fits. Coefficients are
    ``fold, n_train, coefficients, intercept``; a panel without rows gives none.
    """
    spark, columns = panel.sparkSession, list(columns)
    marked = staged(expanding_folds(panel, folds))
    solved = solve_prefixes(*fold_products(marked, columns, target), folds)
    rows = [(v, n, [float(c) for c in b], a) for v, (n, b, a) in solved.items()]
    table = spark.createDataFrame(rows, "fold int, n_train bigint, coefficients array<double>, intercept double")
    terms = F.zip_with(F.array(*[F.col(c).cast("double") for c in columns]), "coefficients", lambda x, b: x * b)
    scored = marked.join(F.broadcast(table), "fold")  # as many rows as folds
    predicted = to_units(F.aggregate(terms, F.lit(0.0), lambda s, t: s + t) + F.col("intercept"))
    return table, scored.withColumn("predicted", predicted).drop("n_train", "coefficients", "intercept")


def cross_validate_linear(panel: DataFrame, columns: Sequence[str], folds: int = 5) -> DataFrame:
    """Metrics over the validation rows of all expanding folds, as ``cross_validate`` gives for a pipeline."""
    return regression_metrics(linear_folds(panel, columns, folds)[1])
