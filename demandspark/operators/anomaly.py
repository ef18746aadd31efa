"""Demand anomalies: z-scores, quartile fences and an isolation forest."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from demandspark.constants import EPSILON, FOREST_FEATURES, SERIES_KEYS
from demandspark.functions.numeric import round_half_even
from demandspark.functions.quantiles import exact_quantiles
from demandspark.operators.cleaning import median_impute
from demandspark.operators.cluster import standardise
from demandspark.session import spread_by, staged


def series_zscore(panel: DataFrame, value: str = "units_sold", keys: Sequence[str] = SERIES_KEYS,
                  threshold: float = 3.0) -> DataFrame:
    """Distance from the series mean in sample deviations; a one-row series is never flagged."""
    series = W.partitionBy(*keys)
    z = (F.col(value) - F.avg(value).over(series)) / (F.stddev_samp(value).over(series) + EPSILON)
    return panel.withColumn("z_score", z).withColumn(
        "anomaly_zscore", F.coalesce(F.abs("z_score") > threshold, F.lit(False)))


def iqr_anomalies(panel: DataFrame, value: str = "units_sold", keys: Sequence[str] = SERIES_KEYS,
                  factor: float = 1.5) -> DataFrame:
    """Weeks outside the quartile fences of their series, which has one row per week."""
    series = W.partitionBy(*keys)
    q = F.percentile(F.col(value), F.array(F.lit(0.25), F.lit(0.75))).over(series)
    spread = F.col("q")[1] - F.col("q")[0]
    return (panel.withColumn("q", q)
            .withColumn("fence_low", F.col("q")[0] - factor * spread)
            .withColumn("fence_high", F.col("q")[1] + factor * spread)
            .withColumn("anomaly_iqr", (F.col(value) < F.col("fence_low")) | (F.col(value) > F.col("fence_high")))
            .drop("q"))


def mean_path(n) -> np.ndarray:
    """Mean path length of an unsuccessful search among n points (Liu, Ting, Zhou 2008)."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 3)
    return np.select([n <= 1, n <= 2], [0.0, 1.0],
                     2 * (np.log(safe - 1) + np.euler_gamma) - 2 * (safe - 1) / safe)


def _grow_tree(x: np.ndarray, rng: np.random.Generator) -> list[tuple[int, int, float, int, float]]:
    """Nodes (id, feature, threshold, left child, path length); feature -1 marks a leaf."""
    limit = int(np.ceil(np.log2(max(len(x), 2))))
    nodes, queue, used = [], [(0, np.arange(len(x)), 0)], 1
    while queue:
        node, rows, depth = queue.pop()
        low, high = x[rows].min(0), x[rows].max(0)
        varying = np.flatnonzero(high > low)
        if depth >= limit or len(rows) <= 1 or not len(varying):
            nodes.append((node, -1, 0.0, -1, depth + float(mean_path(len(rows)))))
            continue
        feature = int(rng.choice(varying))
        # Rounding may reach the upper end, which would leave the right side empty.
        cut = rng.uniform(low[feature], high[feature])
        threshold = float(min(cut, np.nextafter(high[feature], low[feature])))
        goes_left = x[rows, feature] <= threshold
        nodes.append((node, feature, threshold, used, 0.0))
        queue += [(used, rows[goes_left], depth + 1), (used + 1, rows[~goes_left], depth + 1)]
        used += 2
    return nodes


def forest_sample(data: DataFrame, keys: Sequence[str], trees: int, size: int) -> DataFrame:
    """``size`` rows for each tree, drawn without replacement by key hash.

    A first cut by hash value keeps a few times the wanted rows, so the exact top-n stays small
    whatever the table's size.
    """
    wanted = trees * size
    total = data.agg(F.count("*")).scalar()
    unit = F.pmod(F.xxhash64(*keys), F.lit(1 << 30)) / float(1 << 30)
    pool = (data.withColumn("draw", unit).where(F.col("draw") * total < 4 * wanted)
            .orderBy("draw", *keys).limit(wanted))
    # At most `wanted` rows are left; dealt round, each tree takes the next `size` of them.
    order = W.orderBy("draw", *keys)
    dealt = pool.withColumns({"position": F.row_number().over(order) - 1, "pool": F.count("*").over(W.partitionBy())})
    return (dealt.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
            .where(F.pmod(F.col("position") - F.col("tree") * size, F.col("pool")) < size))


def isolation_forest(panel: DataFrame, features: Sequence[str] = FOREST_FEATURES,
                     keys: Sequence[str] = (*SERIES_KEYS, "week_start"), contamination: float = 0.05,
                     trees: int = 100, sample_size: int = 256, seed: int = 42) -> DataFrame:
    """Isolation forest score per row; the most isolated share is flagged.

    Trees grow in parallel from their own samples of at most ``sample_size`` rows. The forest has
    at most ``trees * 2 * sample_size`` nodes, which is the size of what is broadcast.
    """
    names = {f"forest_{c}": c for c in features if c in panel.columns}
    inputs = list(names)
    data = panel.withColumns({f: F.col(c).cast("double") for f, c in names.items()})
    data = standardise(median_impute(data, inputs), inputs, suffix="")

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        x = pdf.sort_values(list(keys))[inputs].to_numpy(dtype=float)
        out = pd.DataFrame(_grow_tree(x, np.random.default_rng([seed, tree])),
                           columns=["node", "feature", "threshold", "left", "path"])
        return out.assign(tree=tree, sampled=len(x))

    schema = "node int, feature int, threshold double, left int, path double, tree int, sampled int"
    samples = spread_by(forest_sample(data.select(*keys, *inputs), keys, trees, sample_size), "tree")
    nodes = samples.groupBy("tree").applyInPandas(grow, schema).toPandas()
    if nodes.empty:
        raise ValueError("the panel has no rows")
    forest = [g.sort_values("node") for _, g in nodes.groupby("tree")]
    scale = float(mean_path(forest[0]["sampled"].iloc[0]))
    shared = panel.sparkSession.sparkContext.broadcast(
        [tuple(g[c].to_numpy() for c in ["feature", "threshold", "left", "path"]) for g in forest])

    @F.pandas_udf("double")
    def score(rows: pd.DataFrame) -> pd.Series:
        x = rows.to_numpy(dtype=float)
        at = np.arange(len(x))
        depth = np.zeros(len(x))
        for feature, threshold, left, path in shared.value:
            node = np.zeros(len(x), dtype=int)
            while (feature[node] >= 0).any():
                f = feature[node]
                right = x[at, np.maximum(f, 0)] > threshold[node]
                node = np.where(f >= 0, left[node] + right, node)
            depth += path[node]
        # A sample of one row isolates nothing.
        mean = depth / len(shared.value)
        return pd.Series(-(2.0 ** (-mean / scale)) if scale > 0 else np.full(len(x), -0.5))

    # Staged, so the quantile passes below read one column and do not score the rows again.
    scored = staged(data.withColumn("raw_score", score(F.struct(*inputs))).drop(*inputs))
    offset = exact_quantiles(scored, ["raw_score"], [contamination]).select(F.col("q")[0]).scalar()
    return (scored.withColumn("if_score", F.col("raw_score") - offset).drop("raw_score")
            .withColumn("anomaly_if", F.col("if_score") < 0))


def combine_anomalies(df: DataFrame) -> DataFrame:
    """Agreement of the two methods, type and direction; the direction of a normal row is null."""
    z, forest = F.col("anomaly_zscore"), F.col("anomaly_if")
    return df.withColumns({
        "anomaly_both": z & forest,
        "anomaly_any": z | forest,
        "anomaly_type": F.when(z & forest, "HIGH CONFIDENCE").when(z, "Z-Score")
        .when(forest, "IsoForest").otherwise("Normal"),
        "anomaly_direction": F.when((z | forest) & (F.col("z_score") > 0), "Spike")
        .when((z | forest) & (F.col("z_score") <= 0), "Drop"),
    })


def anomaly_report(df: DataFrame, ordered: bool = True) -> DataFrame:
    """Anomalous weeks with their expected units, largest distance first."""
    rows = df.where("anomaly_any")
    fallback = rows.agg(F.avg("units_sold")).scalar()
    out = (rows.withColumn("expected_units", F.coalesce(F.col("roll_mean_4w"), fallback))
           .withColumn("deviation_units", round_half_even(F.col("units_sold") - F.col("expected_units"), 1))
           .select("week_start", "store_name", "product_name", "category", "units_sold", "expected_units",
                   "deviation_units", "anomaly_type", "z_score", "if_score"))
    if not ordered:
        return out
    return out.orderBy(F.desc(F.abs("z_score")), "week_start", "store_name", "product_name")


def anomaly_counts(report: DataFrame) -> DataFrame:
    """Anomalies by type and by category."""
    cells = report.groupBy("anomaly_type", "category").agg(F.count("*").alias("n"))

    def counts(kind: str):
        return cells.groupBy(F.lit(kind).alias("kind"), F.col(kind).alias("value")).agg(F.sum("n").alias("n"))

    return counts("anomaly_type").unionByName(counts("category"))


def anomaly_share(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_weeks"),
                  *[F.avg(F.col(c).cast("double")).alias(f"{c}_share") for c in ["anomaly_zscore", "anomaly_if"]])
