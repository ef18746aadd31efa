"""Least squares with one sparse category column of any width: the categories are eliminated group by group."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.operators.features import CATEGORY_VECTOR
from demandspark.session import staged

_SLOT, _EFFECT = "_slot", "_effect"
#: Share of a column's squares that must lie within the categories for it to have a coefficient of its own.
LEAST_WITHIN = 1e-12


def _slot() -> Column:
    """The place of the one in the sparse vector, -1 where there is none."""
    v = F.unwrap_udt(CATEGORY_VECTOR)
    return F.when(v["type"] == 0, F.coalesce(F.get(v["indices"], 0), F.lit(-1))).otherwise(F.array_position(v["values"], 1.0) - 1).cast("int")


def _number(column: str) -> Column:
    """The value as a double; a missing one fails, as in Spark's own models."""
    x = F.col(column).cast("double")
    return F.when(x.isNull() | F.isnan(x), F.raise_error(F.lit(f"{column} is missing in a row to learn from")).cast("double")).otherwise(x)


@dataclass
class CategoryRegression:
    """Least squares on numbers and the sparse category vector.

    Within a category, rows and target are taken less their means; the normal equations of these differences give the
    coefficients of the numbers, and the means then give each category its own. This is the solution over all columns at
    once, but no vector as wide as the domain comes together anywhere: the categories stay a table. A number that does
    not vary within categories says what these say already and gets zero.
    """
    columns: Sequence[str]
    label: str = "units_sold"

    def fit(self, rows: DataFrame) -> CategoryModel:
        numbers = [c for c in self.columns if c != CATEGORY_VECTOR]
        xs = [f"x{i}" for i in range(len(numbers))]
        data = rows.select(_slot().alias(_SLOT), _number(self.label).alias("y"), *[_number(c).alias(x) for c, x in zip(numbers, xs)])
        if xs:
            data = staged(data)
        groups = staged(data.groupBy(_SLOT).agg(F.count("*").alias("n"), *[F.avg(c).alias(f"m_{c}") for c in ("y", *xs)]))
        weights = _within(data, groups, xs) if xs else np.zeros(0)
        own = F.col("m_y")
        for x, w in zip(xs, weights):
            own = own - F.lit(float(w)) * F.col(f"m_{x}")
        effects = groups.select(_SLOT, "n", own.alias(_EFFECT))
        total = effects.agg(F.sum("n")).first()[0]
        if total is None:
            raise ValueError("no rows to learn from")
        # Without a row of the first category any level will do; this one keeps the scaled coefficients smallest.
        scaled = F.col("n") / total * (1 - F.col("n") / total)
        first, mean, only = effects.agg(F.max(F.when(F.col(_SLOT) == -1, F.col(_EFFECT))), F.try_divide(F.sum(scaled * F.col(_EFFECT)), F.sum(scaled)), F.avg(_EFFECT)).first()
        intercept = next(v for v in (first, mean, only) if v is not None)
        return CategoryModel(numbers, [float(w) for w in weights], float(intercept),
                             staged(effects.where(F.col(_SLOT) >= 0).select(_SLOT, (F.col(_EFFECT) - F.lit(float(intercept))).alias(_EFFECT))))


def _within(data: DataFrame, groups: DataFrame, xs: Sequence[str]) -> np.ndarray:
    """The coefficients of the numbers from the differences to the means of their categories."""
    k = len(xs)
    off = data.join(groups, _SLOT).select(*[(F.col(c) - F.col(f"m_{c}")).alias(c) for c in (*xs, "y")])
    sums = off.mapInPandas(_products(k + 1), "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()
    square = np.zeros((k + 1) ** 2)
    for r in sums:
        square[r["at"]] = r["value"]
    square = square.reshape(k + 1, k + 1)
    n = F.col("n")
    centres = groups.agg(*[(F.sum(n * F.col(f"m_{x}")) / F.sum(n)).alias(x) for x in xs]).first()
    between = np.array([0.0 if v is None else v for v in groups.agg(*[F.sum(n * (F.col(f"m_{x}") - F.lit(centres[x])) ** 2) for x in xs]).first()])
    own = np.diag(square)[:k]
    varies = own > LEAST_WITHIN * (own + between)
    scale = np.where(varies, np.sqrt(np.where(varies, own, 1.0)), np.inf)
    return np.linalg.pinv(square[:k, :k] / np.outer(scale, scale), rcond=1e-12, hermitian=True) @ (square[:k, k] / scale) / scale


def _products(width: int) -> Callable:
    """Sums of the products of all pairs of columns, one row a pair and partition."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width, width))
        for rows in batches:
            x = rows.to_numpy(float)
            total += x.T @ x
        yield pd.DataFrame({"at": np.arange(width * width, dtype=np.int32), "value": total.ravel()})
    return run


@dataclass
class CategoryModel:
    """A weighted sum of numbers, an intercept and a table of what each category adds; unknown categories add nothing."""
    numbers: list[str]
    weights: list[float]
    intercept: float
    effects: DataFrame

    def transform(self, rows: DataFrame) -> DataFrame:
        total = F.lit(self.intercept)
        for c, w in zip(self.numbers, self.weights):
            total = total + F.lit(w) * F.col(c).cast("double")
        placed = rows.withColumn(_SLOT, _slot()).join(self.effects, _SLOT, "left")
        return placed.select(*rows.columns, (total + F.coalesce(_EFFECT, F.lit(0.0))).alias("prediction"))

    def save(self, spark: SparkSession, path: str) -> None:
        self.effects.write.mode("overwrite").parquet(f"{path}/effects")
        head = [(self.numbers, self.weights, self.intercept)]
        spark.createDataFrame(head, "numbers array<string>, weights array<double>, intercept double").write.mode("overwrite").parquet(f"{path}/categories")

    @staticmethod
    def load(spark: SparkSession, path: str) -> CategoryModel:
        head = spark.read.parquet(f"{path}/categories").first()
        return CategoryModel(list(head["numbers"]), list(head["weights"]), head["intercept"], spark.read.parquet(f"{path}/effects"))
