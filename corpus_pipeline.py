"""Documents through the text operators, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from demandspark.llm import quality
from demandspark.llm.exact_dedup import drop_exact_duplicates
from demandspark.llm.jaccard_join import one_of_each_group
from demandspark.llm.mixing import mix
from demandspark.llm.queries import byte_bpe
from demandspark.session import shared_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep_good(docs, quality.fit(docs))


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the smallest id stays."""
    return drop_exact_duplicates(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by a Jaccard similarity of 0.8 or more one stays, that with the smallest id."""
    return one_of_each_group(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded texts."""
    return byte_bpe(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_exact),
    ("n-gram Jaccard join", drop_near),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE", encode),
]

#: The classifier's posterior cannot be said in SQL; a test compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each writes Parquet to the shared folder for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        path = shared_path(spark, "pipeline")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
