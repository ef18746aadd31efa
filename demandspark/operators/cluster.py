"""Store clusters and product segments."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from demandspark.constants import (
    PRODUCT_SEGMENT_FEATURES, SEGMENT_NAMES, STORE_CLUSTER_FEATURES, STORE_REGION,
)
from demandspark.functions.labels import cluster_label
from demandspark.functions.lookup import literal_table, look_up
from demandspark.functions.numeric import round_half_even
from demandspark.session import staged

#: Entities from which the fits take their first centres; all entities fit and are scored.
START_SAMPLE = 10_000
MAX_ROUNDS = 50
#: Partitions whose sums may come to the driver one by one.
DRIVER_PARTS = 32
SEED = 42


def lookup_region(df: DataFrame, regions: DataFrame | None = None, unmapped: str = "keep") -> DataFrame:
    """Add the region of the store; rows without one are kept or dropped."""
    table = regions if regions is not None else literal_table(df.sparkSession, STORE_REGION, "store_id", "region")
    return look_up(df, table, "store_id", unmapped=unmapped)


def store_features(panel: DataFrame, regions: DataFrame | None = None, unmapped: str = "keep") -> DataFrame:
    """Demand behaviour per store. The region joins the aggregate, not the panel; without one it is null."""
    stats = panel.groupBy("store_id", "store_name").agg(
        F.avg("units_sold").alias("avg_weekly_demand"),
        F.coalesce(F.stddev_samp("units_sold"), F.lit(0.0)).alias("demand_std"),
        F.avg("revenue").alias("avg_revenue_per_week"),
        F.avg("is_promo_week").alias("promo_sensitivity"),
        F.avg("stockout_days").alias("stockout_rate"),
        F.avg("demand_cv_4w").alias("demand_cv"),
        F.countDistinct("product_id").alias("n_products"))
    return lookup_region(stats, regions, unmapped)


def product_features(panel: DataFrame) -> DataFrame:
    return panel.groupBy("product_id", "product_name", "category").agg(
        F.avg("units_sold").alias("avg_demand"),
        F.coalesce(F.stddev_samp("units_sold"), F.lit(0.0)).alias("demand_std"),
        F.coalesce(F.avg("demand_cv_4w"), F.lit(0.0)).alias("demand_cv"),
        F.avg("is_promo_week").alias("promo_lift"),
        F.avg("stockout_days").alias("stockout_rate"),
        F.avg("revenue").alias("avg_revenue"))


def standardise(df: DataFrame, columns: Sequence[str], suffix: str = "_z") -> DataFrame:
    """Mean zero and population deviation one; a constant column is only centred.

    The statistics are one aggregate row read as a scalar, so no window spans the table.
    """
    stats = df.agg(F.struct(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c)
                              for c in columns]).alias("stats")).scalar()

    def scaled(c: str):
        s = stats[c]["s"]
        return (F.col(c) - stats[c]["m"]) / F.when(s > 0, s).otherwise(F.lit(1.0))

    return df.withColumns({f"{c}{suffix}": scaled(c) for c in columns})


def _vectors(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    filled = df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns})
    scaled = standardise(filled, columns)
    return VectorAssembler(inputCols=[f"{c}_z" for c in columns], outputCol="vector").transform(scaled)


def _entity_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Standardised vectors, staged for the passes of the fits."""
    return staged(_vectors(df, columns).withColumn("x", vector_to_array("vector")).drop("vector"))


def silhouette(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Mean silhouette with squared distances, as one row.

    The mean squared distance to a cluster follows from its size, sum and sum of squares, so every
    point meets one row per cluster. A point alone in its cluster counts as zero.
    """
    points = df.select(F.col(label).alias("own"), F.array(*[F.col(c).cast("double") for c in columns]).alias("x"))
    square = F.aggregate("x", F.lit(0.0), lambda t, v: t + v * v)
    points = points.withColumn("square", square)
    clusters = points.groupBy("own").agg(
        F.count("*").alias("n"), F.sum("square").alias("squares"),
        F.array(*[F.sum(F.col("x")[i]) for i in range(len(columns))]).alias("total"))
    table = clusters.agg(F.collect_list(F.struct("own", "n", "squares", "total"))).scalar()

    def spread(c):
        """Sum of the squared distances from the point to the cluster's points."""
        product = F.aggregate(F.zip_with("x", c["total"], lambda p, q: p * q), F.lit(0.0), lambda t, v: t + v)
        return F.greatest(F.lit(0.0), c["n"] * F.col("square") - 2 * product + c["squares"])

    mine = F.filter("clusters", lambda c: c["own"] == F.col("own"))[0]
    others = F.filter("clusters", lambda c: c["own"] != F.col("own"))
    a = spread(mine) / (mine["n"] - 1)
    b = F.array_min(F.transform(others, lambda c: spread(c) / c["n"]))
    scored = points.withColumn("clusters", table).select(
        F.when(mine["n"] > 1, F.coalesce(F.try_divide(b - a, F.greatest(a, b)), F.lit(0.0))).otherwise(F.lit(0.0)).alias("s"))
    return scored.agg(F.avg("s").alias("silhouette"))


def _first_centres(sample: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Centres drawn one after another with chances by squared distance to those drawn."""
    rng = np.random.default_rng(seed)
    centres = [sample[rng.integers(len(sample))]]
    near = ((sample - centres[0]) ** 2).sum(1)
    for _ in range(1, k):
        total = near.sum()
        at = rng.choice(len(sample), p=near / total) if total > 0 else rng.integers(len(sample))
        centres.append(sample[at])
        near = np.minimum(near, ((sample - centres[-1]) ** 2).sum(1))
    return np.array(centres)


def _nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    far = ((x[:, None, :] - centres[None]) ** 2).sum(2)
    at = far.argmin(1)
    return at, far[np.arange(len(x)), at]


def _sums(table: DataFrame, candidates: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, float]]:
    """For each set of centres the clusters' sizes, sums, sums of squares, and the cost, in one pass.

    A partition returns one row per set of centres; those of more than DRIVER_PARTS partitions are added up in Spark.
    """
    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = [np.zeros((len(c), c.shape[1] + 2)) for c in candidates]
        costs = np.zeros(len(candidates))
        for rows in batches:
            x = np.array(rows["x"].tolist(), dtype=float)
            for i, centres in enumerate(candidates):
                at, far = _nearest(x, centres)
                np.add.at(sums[i], at, np.column_stack([np.ones(len(x)), (x ** 2).sum(1), x]))
                costs[i] += far.sum()
        yield pd.DataFrame({"i": range(len(candidates)), "sums": [s.ravel() for s in sums], "cost": costs})

    parts = table.select("x").mapInPandas(part, "i int, sums array<double>, cost double")
    parts = parts.select("i", F.array_append("sums", F.col("cost")).alias("sums"))
    out = [np.zeros(len(c) * (c.shape[1] + 2) + 1) for c in candidates]
    if table.rdd.getNumPartitions() <= DRIVER_PARTS:
        for r in parts.collect():
            out[r["i"]] += r["sums"]
    else:
        cells = parts.select("i", F.posexplode("sums").alias("at", "value")).groupBy("i", "at").agg(F.sum("value").alias("value"))
        for r in cells.collect():
            out[r["i"]][r["at"]] = r["value"]
    tables = [(o[:-1].reshape(len(c), -1), o[-1]) for o, c in zip(out, candidates)]
    return [(t[:, 0], t[:, 2:], t[:, 1], cost) for t, cost in tables]


def fit_centres(table: DataFrame, ks: Sequence[int], tries: int) -> dict[int, np.ndarray]:
    """The cheapest centres of several starts for every number of clusters.

    All starts of all numbers move on in one pass over the entities per round, until none moves. An
    empty cluster keeps its centre.
    """
    sample = np.array([r["x"] for r in table.select("x", F.xxhash64("x").alias("h")).orderBy("h").limit(START_SAMPLE).collect()])
    plans = [(k, _first_centres(sample, k, SEED + t)) for k in ks for t in range(tries)]
    moving = list(range(len(plans)))
    cost = {}
    for _ in range(MAX_ROUNDS):
        still = []
        for i, (n, total, _, c) in zip(moving, _sums(table, [plans[i][1] for i in moving])):
            cost[i] = c
            k, old = plans[i]
            new = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], old)
            if not np.allclose(new, old, rtol=0, atol=1e-6):
                plans[i] = (k, new)
                still.append(i)
        moving = still
        if not moving:
            break
    return {k: plans[min((i for i in range(len(plans)) if plans[i][0] == k), key=lambda i: (cost[i], i))][1] for k in ks}


def _silhouettes(table: DataFrame, fits: dict[int, np.ndarray]) -> dict[int, float | None]:
    """Mean silhouette of every number of clusters, in two passes; None with fewer than two used clusters."""
    known = _sums(table, list(fits.values()))

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, rows_seen = np.zeros(len(known)), 0
        for rows in batches:
            x = np.array(rows["x"].tolist(), dtype=float)
            rows_seen += len(x)
            for i, ((n, sums, squares, _), centres) in enumerate(zip(known, fits.values())):
                at, _ = _nearest(x, centres)
                spread = np.maximum(0, n * (x ** 2).sum(1)[:, None] - 2 * x @ sums.T + squares)
                own = np.arange(len(x)), at
                a = spread[own] / np.maximum(n[at] - 1, 1)
                mean = np.where(n > 0, spread / np.maximum(n, 1), np.inf)
                mean[own] = np.inf
                b = mean.min(1)
                top = np.maximum(a, b)
                total[i] += np.where((n[at] > 1) & (top > 0) & np.isfinite(b), (b - a) / np.where(top > 0, top, 1), 0.0).sum()
        yield pd.DataFrame({"total": [total], "n": [rows_seen]})

    parts = table.select("x").mapInPandas(part, "total array<double>, n long")
    row = parts.agg(*[F.sum(F.col("total")[i]).alias(f"t{i}") for i in range(len(known))], F.sum("n").alias("n")).first()
    return {k: row[f"t{i}"] / row["n"] if (known[i][0] > 0).sum() > 1 else None for i, k in enumerate(fits)}


def _assign(table: DataFrame, centres: np.ndarray, name: str) -> DataFrame:
    """The nearest centre of every entity, as an expression."""
    far = [F.aggregate(F.zip_with("x", F.array(*map(F.lit, c.tolist())), lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda t, v: t + v)
           for c in centres]
    all_far = F.array(*far)
    return table.withColumn(name, (F.array_position(all_far, F.array_min(all_far)) - 1).cast("int"))


def cluster_stores(features: DataFrame, columns: Sequence[str] = STORE_CLUSTER_FEATURES, max_k: int = 5,
                   tries: int = 10) -> DataFrame:
    """K-means on standardised store features, with the k of the best silhouette."""
    table = _entity_table(features, columns)
    ks = range(2, min(max_k, table.count() - 1) + 1)
    if not ks:
        raise ValueError("clustering needs at least three stores")
    fits = fit_centres(table, ks, tries)
    scores = {k: s for k, s in _silhouettes(table, fits).items() if s is not None}
    if not scores:
        raise ValueError("all stores are alike")
    best = max(scores, key=lambda k: (scores[k], -k))
    out = _assign(table, fits[best], "demand_cluster")
    return out.select(*features.columns, "demand_cluster",
                      cluster_label(F.col("demand_cluster")).alias("cluster_label"),
                      F.lit(float(scores[best])).alias("silhouette_score"))


def pca_2d(features: DataFrame, columns: Sequence[str] = STORE_CLUSTER_FEATURES) -> DataFrame:
    """Two principal components of the standardised features; their signs are arbitrary."""
    table = _entity_table(features, columns).withColumn("vector", array_to_vector("x"))
    model = PCA(k=2, inputCol="vector", outputCol="pc").fit(table)
    share = model.explainedVariance.toArray()
    xy = vector_to_array(F.col("pc"))
    return model.transform(table).select(
        "store_id", "store_name", xy[0].alias("pc1"), xy[1].alias("pc2"),
        F.lit(float(share[0])).alias("pc1_variance"), F.lit(float(share[1])).alias("pc2_variance"))


def name_segments(products: DataFrame, segment: str = "segment", value: str = "avg_demand",
                  names: Sequence[str] = SEGMENT_NAMES) -> DataFrame:
    """Name the clusters from lowest to highest mean demand."""
    means = products.groupBy(segment).agg(F.avg(value).alias("mean_value"))
    # The window covers one row per cluster.
    rank = F.row_number().over(W.orderBy("mean_value", segment))
    named = means.withColumn("rank", rank).select(
        segment, F.get(F.array(*[F.lit(n) for n in names]), F.col("rank") - 1).alias("segment_name"))
    return products.join(F.broadcast(named), segment)


def segment_products(features: DataFrame, k: int = 4, columns: Sequence[str] = PRODUCT_SEGMENT_FEATURES,
                     tries: int = 10) -> DataFrame:
    table = _entity_table(features, columns)
    labelled = _assign(table, fit_centres(table, [k], tries)[k], "segment")
    return name_segments(labelled.select(*features.columns, "segment"))


def region_revenue(stores: DataFrame) -> DataFrame:
    return (stores.where(F.col("region").isNotNull()).groupBy("region")
            .agg(F.avg("avg_revenue_per_week").alias("avg_revenue_per_week")))


def segment_summary(products: DataFrame) -> DataFrame:
    return products.groupBy("segment_name").agg(
        F.count("product_name").alias("products"),
        round_half_even(F.avg("avg_demand"), 1).alias("avg_demand"),
        round_half_even(F.avg("avg_revenue"), 1).alias("avg_revenue"))
