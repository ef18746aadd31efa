"""The weekly table and the feature panel kept up to date from a stream of daily sales, late rows included."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import StructType

from demandspark.constants import LAGS, ROLL_WINDOWS, SERIES_KEYS
from demandspark.operators.features import build_features
from demandspark.operators.rollup import finish_weeks, merge_cells, week_cells
from demandspark.session import staged
from demandspark.sources.schemas import schema
from demandspark.sources.stages import StageStore

WEEKS, PANEL, LATE, MARK = "weeks", "panel", "late", "stream"
#: Rows of a series that look back to a week.
REACH = max(*LAGS, *ROLL_WINDOWS)
MONTH = "month_part"
_LATE = schema("batch:bigint, week_start:date, n_rows:bigint")


def _with_month(df: DataFrame) -> DataFrame:
    return df.withColumn(MONTH, F.date_format("week_start", "yyyy-MM"))


def _months(df: DataFrame) -> list[str]:
    """The months of some rows: a value per calendar month."""
    return sorted(r[MONTH] for r in df.select(MONTH).distinct().collect())


class LivePanel:
    """Weeks and panel below a root, in parts by month.

    A batch of sales is reduced to weekly cells, whose measures merge with the stored ones, so rows may come in any
    order and late by any time. Of the series that a batch touches, the panel's rows from the first touched week to the
    twelfth after the last are computed anew; only the months that hold such rows get new versions. Weeks,
    panel and the batch's number switch in one step, so a batch that breaks off leaves no trace, and one that is
    delivered again is skipped.

    The watermark trails the newest day by ``lateness_days``. Rows of weeks that ended before it count as all others,
    and are also listed as late by week, for those who read such weeks as final.
    """

    def __init__(self, spark: SparkSession, root: str, domain: Sequence[str], lateness_days: int = 28):
        self.spark, self.store, self.domain, self.lateness = spark, StageStore(spark, root), list(domain), lateness_days
        self._shapes: tuple[StructType, StructType] | None = None

    def _schemas(self, daily: DataFrame) -> tuple[StructType, StructType]:
        if self._shapes is None:
            cells = merge_cells(week_cells(daily))
            self._shapes = cells.schema, build_features(finish_weeks(cells), self.domain).schema
        return self._shapes

    def mark(self) -> dict:
        """Number of the last batch, its newest day and the watermark."""
        return self.store.newest()[1].get(MARK, {"batch": -1, "newest": None, "watermark": None})

    def weekly(self, daily: DataFrame) -> DataFrame:
        """The weekly table so far; ``daily`` gives the shape of the sales."""
        return finish_weeks(self.store.read_parts(WEEKS, self._schemas(daily)[0]))

    def panel(self, daily: DataFrame) -> DataFrame:
        return self.store.read_parts(PANEL, self._schemas(daily)[1])

    def late(self) -> DataFrame:
        """Rows by batch and week that came after the watermark had passed their week."""
        return self.store.read_parts(LATE, _LATE)

    def fold(self, daily: DataFrame, batch: int) -> None:
        """Take one batch in."""
        before = self.mark()
        if batch <= before["batch"]:
            return
        cell_shape, panel_shape = self._schemas(daily)
        daily = staged(daily)
        cells = staged(_with_month(week_cells(daily)))
        newest = daily.agg(F.max("date")).first()[0]
        stage = self.store.begin()
        touched_months = _months(cells)
        if touched_months:
            stored = self.store.read_parts(WEEKS, cell_shape, touched_months)
            merged = _with_month(merge_cells(stored.unionByName(cells.drop(MONTH).select(stored.columns))))
            stage.write_parts(WEEKS, merged, MONTH, touched_months)
            self._renew_panel(stage, cells, cell_shape, panel_shape)
            self._list_late(stage, daily, before["watermark"], batch)
        ends = [d for d in (before["newest"], newest.isoformat() if newest else None) if d]
        mark = None if not ends else (dt.date.fromisoformat(max(ends)) - dt.timedelta(days=self.lateness)).isoformat()
        stage.note(MARK, batch=batch, newest=max(ends, default=None), watermark=mark)
        stage.commit()

    def _renew_panel(self, stage, cells: DataFrame, cell_shape: StructType, panel_shape: StructType) -> None:
        touched = staged(cells.groupBy(*SERIES_KEYS).agg(F.min("week_start").alias("first_week"), F.max("week_start").alias("last_week")))
        entries = {**self.store.newest()[1], **stage.changed}
        own = staged(self.store.read_parts(WEEKS, cell_shape, entries=entries).join(touched.select(*SERIES_KEYS), SERIES_KEYS, "left_semi"))
        series = W.partitionBy(*SERIES_KEYS)
        placed = own.join(touched, SERIES_KEYS).withColumn("at", F.row_number().over(series.orderBy("week_start")))
        until = F.max(F.when(F.col("week_start") <= F.col("last_week"), F.col("at"))).over(series) + REACH
        reached = staged(placed.withColumn("until", until).where((F.col("week_start") >= F.col("first_week")) & (F.col("at") <= F.col("until")))
                         .select(*SERIES_KEYS, "week_start"))
        keys = [*SERIES_KEYS, "week_start"]
        fresh = staged(_with_month(build_features(finish_weeks(own), self.domain).join(reached, keys, "left_semi").select(panel_shape.names)))
        months = _months(_with_month(reached))
        old = self.store.read_parts(PANEL, panel_shape, months).join(reached, keys, "left_anti").select(panel_shape.names)
        rows = _with_month(old).unionByName(fresh)
        stage.write_parts(PANEL, rows, MONTH, sorted({*_months(fresh), *[m for m in months if f"{PANEL}/{m}" in entries]}))

    def _list_late(self, stage, daily: DataFrame, watermark: str | None, batch: int) -> None:
        if watermark is None:
            return
        week = F.date_trunc("week", "date").cast("date")
        late = daily.where(F.date_add(week, 7) <= F.lit(dt.date.fromisoformat(watermark))).groupBy(week.alias("week_start")).agg(F.count("*").alias("n_rows"))
        path = stage.folder(f"{LATE}/{batch}", "parquet")
        late.select(F.lit(batch).cast("bigint").alias("batch"), "week_start", "n_rows").coalesce(1).write.parquet(path)  # a row per week


def follow_sales(spark: SparkSession, source: str, shape: StructType, live: LivePanel, checkpoint: str, files_per_batch: int | None = 100) -> None:
    """Take in all sales files below ``source`` that were not taken in before, batch by batch, and stop.

    Without ``files_per_batch`` they are one batch, whatever their number.
    The stream's checkpoint names the files of each batch; a batch that broke off is delivered again with its number.
    """
    reader = spark.readStream.schema(shape)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    sales = reader.parquet(source)
    query = (sales.writeStream.foreachBatch(live.fold).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
