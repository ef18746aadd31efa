"""Exact duplicates by tree-merge of sorted digest runs (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.llm.common import SPACE, whole_text
from demandspark.session import staged

#: Runs that one merge brings together, and the rows a leaf run holds on average.
FAN = 4
ROWS_PER_RUN = 100_000
#: What must agree before two texts count as equal.
KEY = ("text_sha256", "n_norm", "check")


def _digests(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One short row per document: digest, length and a second hash of the normalised text."""
    norm = F.regexp_replace(whole_text(text), SPACE, " ")
    rows = docs.select(F.col(doc_id).alias("doc_id"), norm.alias("norm"))
    return rows.select("doc_id", F.sha2("norm", 256).alias("text_sha256"), F.length("norm").alias("n_norm"),
                       F.xxhash64("norm").alias("check"), F.monotonically_increasing_id().alias("row"))


def merge_runs(leaf: DataFrame, runs: int, fan: int = FAN) -> DataFrame:
    """Merge digest runs in rounds until one run is left.

    In a round, run r goes to run r mod (runs / fan), so ``fan`` runs meet. The smallest row is a
    struct, which Spark aggregates by sorting: each side of the exchange is a sorted run, merged by
    key. A digest has one row per run, so a group of any size is at most ``runs`` rows, and less
    after each round.
    """
    while runs > 1:
        runs //= fan
        leaf = (leaf.groupBy((F.col("run") % runs).alias("run"), *KEY)
                .agg(F.min("first").alias("first"), F.sum("n").alias("n")))
    return leaf.drop("run")


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``docs``.

    Texts are equal when they agree after each run of white space became one space; null counts as
    empty. Digest, length and a second hash must all agree. Of equal texts the smallest id stays; of
    repeated rows with that id, one. A null id stays only where no row of the group has an id. An
    empty table gives no rows; other columns are not read.

    The copies of one text spread over all leaf runs, and the answer goes back to a document by (run,
    digest), so a text with a third of all rows is never one key.
    """
    rows = staged(_digests(docs, doc_id, text))
    runs = FAN * FAN
    while runs * ROWS_PER_RUN < rows.count():
        runs *= FAN
    rows = rows.withColumn("run", F.pmod(F.xxhash64("row"), F.lit(runs)).cast("int"))
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    leaf = rows.groupBy("run", *KEY).agg(F.min(first).alias("first"), F.count("*").alias("n"))
    merged = merge_runs(leaf, runs)
    back = leaf.select("run", *KEY).join(merged, list(KEY))
    return (rows.join(back, ["run", *KEY])
            .select("doc_id", F.col("first.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
                    (F.col("row") == F.col("first.row")).alias("kept"), "text_sha256"))


def drop_exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns whatever their names; one of repeated rows."""
    kept = exact_duplicates(docs, doc_id, text).filter("kept").select("doc_id", "text_sha256")
    sha = F.sha2(F.regexp_replace(whole_text(text), SPACE, " "), 256)
    rows = docs.select(F.struct("*").alias("doc"), F.col(doc_id).alias("id"), sha.alias("sha"))
    stay = rows.join(kept, rows.id.eqNullSafe(kept.doc_id) & (rows.sha == kept.text_sha256), "left_semi")
    return stay.dropDuplicates(["id", "sha"]).select("doc.*")
