"""Entropy balancing of sources to target weights (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandspark.llm.common import WORD, whole_text
from demandspark.session import staged

#: Weights in the order of the sources, how often a source may be repeated, Newton steps.
WEIGHTS = (5.0, 2.0, 1.0)
MOST_COPIES = 3
NEWTON_STEPS = 64
#: Short rows in a range, and the shares into which one group of equal rows is dealt.
RANGE_ROWS, SHARES = 200_000, 256


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """``source, source_size, target``, one row per source.

    ``sizes`` has ``source`` and ``size``. Sources take the weights in code point order, null last.
    Filling stops a source at ``most`` times its size; the level that the others reach is the largest
    of the levels reached after each stop, as stopping one more source below the level only raises it.
    The unpartitioned windows see one row per source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    cap = F.col("source_size").cast("double") * most
    ranked = totals.withColumn("weight", weight).withColumn("cap", cap)
    everyone = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    stopped = F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    level = (F.sum(F.col("source_size").cast("double")).over(everyone) - stopped) / open_weight
    return (ranked.withColumn("level", level)
            .withColumn("target", F.least("cap", F.col("weight") * F.max("level").over(everyone)))
            .select("source", "source_size", "target"))


def _tilt(size: Column, target: Column) -> Column:
    """Rate exp(lambda) at the root of the dual, by Newton's method.

    With words as the base measure the dual of one source is size * exp(l) - target * l. Its gradient
    and curvature need the documents only through the source's size. The first step from 0 lands at
    or above the root, and the rest fall to it without overshooting.
    """
    steps = F.sequence(F.lit(1), F.lit(NEWTON_STEPS))
    root = F.aggregate(steps, F.lit(0.0), lambda x, _: x - (size * F.exp(x) - target) / (size * F.exp(x)))
    return F.when(target > 0, F.round(F.exp(root), 12)).otherwise(0.0)


def _order(doc_id: str, text: str) -> Column:
    """A hash of id and text; rows that share it are alike."""
    return F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(" "), F.md5(whole_text(text))))


def _decisions(docs: DataFrame, weights: tuple[float, ...], most: int, doc_id: str, text: str, source: str) -> DataFrame:
    """``doc_id, source, order, size, source_size, target, rate, copies`` for every row, short columns only."""
    size = F.regexp_count(whole_text(text), F.lit(WORD)).cast("long")
    rows = staged(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), size.alias("size"),
                              _order(doc_id, text).alias("order"), F.monotonically_increasing_id().alias("row")))
    ranges = rows.count() // RANGE_ROWS + 1
    ranged = staged(rows.repartitionByRange(ranges, "source", "order", "row").withColumn("part", F.spark_partition_id()))
    parts = ranged.groupBy("source", "part").agg(F.sum("size").alias("part_size"))
    targets = source_targets(parts.select("source", F.col("part_size").alias("size")), weights, most)
    rate = _tilt(F.col("source_size").cast("double"), F.col("target"))
    targets = targets.select(F.col("source").alias("of"), "source_size", "target", rate.alias("rate"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (parts.withColumn("before", F.coalesce(F.sum("part_size").over(before), F.lit(0)))
             .join(targets, F.col("source").eqNullSafe(F.col("of")))
             .select(F.col("source").alias("of"), F.col("part").alias("at"), "before", "source_size", "target", "rate"))
    within = Window.partitionBy("source", "part").orderBy("order", "row").rowsBetween(Window.unboundedPreceding, 0)
    placed = ranged.withColumn("upto", F.sum("size").over(within)).join(
        parts, ranged.source.eqNullSafe(F.col("of")) & (F.col("part") == F.col("at")))
    middle = F.col("before") + F.col("upto") - F.col("size") / 2
    more = (middle <= (F.col("rate") - F.floor("rate")) * F.col("source_size")).cast("long")
    copies = F.when(F.col("size") > 0, F.least(F.floor("rate") + more, F.lit(most))).otherwise(F.lit(0)).cast("long")
    return placed.select("doc_id", "source", "order", "size", "source_size", "target", "rate", copies.alias("copies"))


def balance(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_COPIES,
            doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken, rate`` for every row of ``docs``.

    The rate, equal for all words of a source, is rounded to whole copies: its whole part for every
    document, and one more for documents in the order of a hash of their id and text until the words of the
    fraction are used up, counting a document when its middle is. So a source misses its target by
    half its longest document at most, and a rerun takes the same documents. Null or empty texts have
    size 0 and take nothing; a source without words has target 0; an empty table gives no rows.
    Repeated rows, and rows with null or repeated ids, are decided each.

    Rows are ranged by source, hash and their number, so that neither a source with a third of all rows nor
    as many equal rows are one task. Running sums go over ranges and then within a range.
    """
    found = _decisions(docs, weights, most, doc_id, text, source)
    return found.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), "rate")


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_COPIES,
        doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of ``docs`` with all their columns, each as often as the mix takes it.

    Rows alike in id, text and source form a cell, which takes ``low`` copies of all and one more of ``extra``
    of them. Where these are some but not all, which is one cell a source at most, its rows are numbered, by
    shares and then within a share.
    """
    cells = _decisions(docs, weights, most, doc_id, text, source).groupBy(F.col("source").alias("of"), F.col("order").alias("cell")).agg(
        F.min("copies").alias("low"), F.count("*").alias("n"), (F.sum("copies") - F.min("copies") * F.count("*")).alias("extra"))
    cells = staged(cells.filter("low > 0 OR extra > 0"))
    rows = docs.select(F.struct("*").alias("doc"), F.col(source).cast("string").alias("from"), _order(doc_id, text).alias("order"))
    joined = rows.join(cells, F.col("from").eqNullSafe(F.col("of")) & (F.col("order") == F.col("cell")))
    whole, some = "extra = 0 OR extra = n", "extra > 0 AND extra < n"
    taken = joined.filter(whole).select("doc", (F.col("low") + (F.col("extra") > 0).cast("long")).alias("copies"))
    if cells.filter(some).limit(1).count():
        cut = staged(joined.filter(some).withColumn("row", F.monotonically_increasing_id()).withColumn("share", F.pmod(F.xxhash64("row"), F.lit(SHARES))))
        own = Window.partitionBy("of", "cell").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
        shares = cut.groupBy("of", "cell", "share").count().withColumn("before", F.coalesce(F.sum("count").over(own), F.lit(0)))
        shares = shares.select(F.col("of").alias("s_of"), F.col("cell").alias("s_cell"), F.col("share").alias("s_share"), "before")
        place = F.row_number().over(Window.partitionBy("of", "cell", "share").orderBy("row"))
        placed = cut.withColumn("place", place).join(shares, F.col("of").eqNullSafe(F.col("s_of")) & (F.col("cell") == F.col("s_cell"))
                                                     & (F.col("share") == F.col("s_share")))
        taken = taken.unionByName(placed.select("doc", (F.col("low") + (F.col("before") + F.col("place") <= F.col("extra")).cast("long")).alias("copies")))
    return taken.filter("copies > 0").withColumn("_", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("doc.*")
