"""Scans that set broken rows aside instead of reading them as missing values."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandspark.sources.schemas import DAILY_SALES
from demandspark.sources.stages import StageStore, current_folder

#: What a row of sales cannot be without.
REQUIRED = ("date", "store_id", "product_id")
_RECORD = "_record"


class BrokenInput(RuntimeError):
    """More of the input is broken than was allowed."""


@dataclass
class CheckedScan:
    """Sound rows, and ``file, record, reason`` of those set aside."""
    rows: DataFrame
    broken: DataFrame


def _reason(schema: T.StructType, separator: str) -> Column:
    """The number of fields if it is wrong, else the columns whose text is not of their type."""
    record = F.col(_RECORD)
    cells = F.from_csv(record, ", ".join(f"`{f.name}` string" for f in schema), {"sep": separator})
    # Quoted stretches may hold separators.
    bare = F.regexp_replace(record, '"[^"]*"', "")
    n_fields = F.length(bare) - F.length(F.replace(bare, F.lit(separator), F.lit(""))) + 1

    def named(cell: Column) -> Column:
        wrong = [F.when(cell[f.name].isNotNull() & cell[f.name].try_cast(f.dataType).isNull(), F.lit(f.name)) for f in schema]
        return F.array_join(F.array_compact(F.array(*wrong)), ", ")

    # The variables of the transforms hold cells and names, so a record is taken apart once and not once for every column.
    names = F.transform(F.array(cells), named)
    typed = F.transform(names, lambda n: F.when(n != "", F.concat(F.lit("type: "), n)).otherwise(F.lit("unreadable")))
    return F.when(n_fields != len(schema), F.concat(F.lit("fields: "), n_fields.cast("string"))).otherwise(F.get(typed, 0))


def scan_checked(spark: SparkSession, path: str, schema: T.StructType = DAILY_SALES, fmt: str = "csv", header: bool = True,
                 separator: str = ",", required: Sequence[str] = REQUIRED) -> CheckedScan:
    """Read a table and part sound rows from broken ones; both are lazy and read the files once each.

    Of CSV a row is broken when a field is not of its column's type or the number of fields is wrong. Of any
    format a row is broken when a required column is null. ``record`` is the text of a CSV row, else the row
    as JSON. A missing path raises on analysis; missing values of other columns are sound.
    """
    path = current_folder(spark, path)
    file = F.col("_metadata.file_path").alias("file")
    is_complete = reduce(and_, [F.col(c).isNotNull() for c in required], F.lit(True))
    missing = F.array_join(F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required])), ", ")
    if fmt == "csv":
        full = T.StructType([*schema.fields, T.StructField(_RECORD, T.StringType())])
        read = (spark.read.schema(full).option("header", header).option("sep", separator).option("mode", "PERMISSIVE")
                .option("columnNameOfCorruptRecord", _RECORD).csv(path)).select("*", file)
        text = F.coalesce(_RECORD, F.to_csv(F.struct(*schema.names), {"sep": separator}))
        is_broken = F.col(_RECORD).isNotNull()
        # Only columns that a plan needs are parsed, and so judged: the comparison never holds but needs them all.
        every = F.nullif(F.xxhash64(*schema.names), F.lit(0))
        is_sound = F.when(is_broken, every == 0).otherwise(is_complete)
        reason = F.when(is_broken, _reason(schema, separator)).otherwise(F.concat(F.lit("missing: "), missing))
    else:
        read = spark.read.schema(schema).format(fmt).load(path).select("*", file)
        text = F.to_json(F.struct(*schema.names))
        is_sound, reason = is_complete, F.concat(F.lit("missing: "), missing)
    # The reason is found for broken rows only, after they were told from the others.
    is_sound = F.coalesce(is_sound, F.lit(False))
    return CheckedScan(read.where(is_sound).select(*schema.names), read.where(~is_sound).select("file", text.alias("record"), reason.alias("reason")))


def ingest(spark: SparkSession, path: str, root: str, schema: T.StructType = DAILY_SALES, fmt: str = "csv", most_broken: float = 0.05,
           **options) -> DataFrame:
    """Store the sound rows as ``raw`` and the others as ``quarantine`` below ``root``; the sound rows read back.

    Both hold in one step. If more than the share ``most_broken`` of all rows is broken, only the quarantine
    holds, the rows of the run before stay, and ``BrokenInput`` names the commonest reasons.
    """
    scan, store = scan_checked(spark, path, schema, fmt, **options), StageStore(spark, root)
    stage = store.begin()
    broken = stage.write("quarantine", scan.broken)
    n_broken = broken.count()
    sound = store.begin()
    rows = sound.write("raw", scan.rows)
    total = n_broken + rows.count()
    if n_broken > most_broken * total:
        stage.commit()
        top = broken.groupBy("reason").count().orderBy(F.desc("count"), "reason").limit(3).collect()
        raise BrokenInput(f"{n_broken} of {total} rows are broken: " + "; ".join(f"{r['reason']} ({r['count']})" for r in top))
    stage.changed |= sound.changed
    stage.commit()
    return rows
