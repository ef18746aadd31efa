"""Ordinary least squares per group from distributed co-moments."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def grouped_ols(df: DataFrame, keys: Sequence[str], y: str, xs: Sequence[str], min_rows: int) -> DataFrame:
    """Coefficients, intercept and R2 per group.

    One aggregate gathers means and centred co-moments, with partial sums before the shuffle, so
    the rows of a hot group never meet. Only the small normal equations of each group reach Python.
    A constant regressor gets the minimum-norm coefficient, zero.
    """
    cols = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in xs}
    k = len(xs)
    xx = [F.covar_pop(cols[xs[i]], cols[xs[j]]) for i in range(k) for j in range(i, k)]
    xy = [F.covar_pop(cols[x], F.col(y)) for x in xs]
    moments = (df.groupBy(*keys)
               .agg(F.count("*").alias("n"),
                    F.array(*xx).alias("xx"), F.array(*xy).alias("xy"),
                    F.array(*[F.avg(cols[x]) for x in xs]).alias("mx"),
                    F.avg(y).alias("my"), F.var_pop(y).alias("yy"))
               .where(F.col("n") >= min_rows))
    upper = np.triu_indices(k)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if pdf.empty:
                continue
            flat, rhs = np.stack(pdf["xx"]), np.stack(pdf["xy"])
            a = np.zeros((len(pdf), k, k))
            a[:, upper[0], upper[1]] = flat
            a[:, upper[1], upper[0]] = flat
            coef = np.einsum("nij,nj->ni", np.linalg.pinv(a, rcond=1e-12, hermitian=True), rhs)
            yy = pdf["yy"].to_numpy()
            explained = 2 * (coef * rhs).sum(1) - np.einsum("ni,nij,nj->n", coef, a, coef)
            # A constant target counts as perfectly fitted.
            r2 = np.where(yy > 0, explained / np.where(yy > 0, yy, 1.0), 1.0)
            out = pdf[list(keys)].copy()
            out["n"] = pdf["n"]
            out["coef"] = list(coef)
            out["intercept"] = pdf["my"].to_numpy() - (coef * np.stack(pdf["mx"])).sum(1)
            out["r2"] = r2
            yield out

    schema = T.StructType([*[df.schema[c] for c in keys],
                           T.StructField("n", T.LongType()),
                           T.StructField("coef", T.ArrayType(T.DoubleType())),
                           T.StructField("intercept", T.DoubleType()),
                           T.StructField("r2", T.DoubleType())])
    return moments.mapInPandas(solve, schema)
