"""Column expressions, grouping of links and row helpers that several operators share."""

from __future__ import annotations

import pickle
from collections.abc import Callable
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.session import staged

#: The contracts' white space and words.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def sent(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """Broadcast a value of bounded size with the code of its class, so executors need no installed package."""
    packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(packed.value)


def components(links: DataFrame, max_rounds: int = 200) -> DataFrame:
    """Smallest id reachable from every id that has a link.

    ``links`` has the columns ``a`` and ``b``; self links are allowed, nulls are not. Each round
    takes the smallest label of the neighbours, then the label of that label, so the rounds follow
    the logarithm of a component's width. All steps are joins and partial minima: a hub with very
    many neighbours is summed before the shuffle or split by the skew join, and no component is
    brought together in one task. Returns ``id, component_id``; no links give no rows.
    """
    both = staged(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = staged(both.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("label")))
    for _ in range(max_rounds):
        near = (both.join(labels, both.b == labels.id).groupBy("a").agg(F.min("label").alias("near")))
        lower = labels.join(near, labels.id == near.a).select("id", "label", F.least("label", "near").alias("next"))
        roots = lower.select(F.col("id").alias("root"), F.col("next").alias("root_label"))
        jumped = staged(lower.join(roots, lower.next == roots.root)
                        .select("id", "label", F.least("next", "root_label").alias("next")))
        changed = jumped.filter("next < label").limit(1).count()
        labels = jumped.select("id", F.col("next").alias("label"))
        if not changed:
            return labels.select("id", F.col("label").alias("component_id"))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
