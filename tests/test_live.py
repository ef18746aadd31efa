"""A panel that follows batches equals the panel of all sales at once."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from demandspark.operators.features import build_features
from demandspark.operators.rollup import weekly_rollup
from demandspark.sources.schemas import DAILY_SALES
from demandspark.streaming.panel import LivePanel, follow_sales

DOMAIN = ["A", "B"]


@pytest.fixture(scope="module")
def daily(spark):
    rng, rows = random.Random(8), []
    for s in ("S1", "S2"):
        for p in ("P1", "P2", "P3"):
            for day in range(0, 300, 3):
                if rng.random() < 0.8:
                    date = dt.date(2023, 1, 2) + dt.timedelta(days=day)
                    rows.append((date, s, f"Store {s}", "x", p, f"Product {p}", "AB"[int(p[1]) % 2], rng.choice([None, rng.randint(0, 30)]), 5.25, rng.choice([None, 9.75]),
                                 rng.randint(0, 1), 0, date.month, date.year, 0, 1, rng.randint(0, 1), 3, 0.2, 50.0))
    return spark.createDataFrame(rows, DAILY_SALES).persist()


def same(one, two):
    assert one.columns == two.columns
    assert one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0


def check(live, daily):
    weekly = weekly_rollup(daily)
    same(live.weekly(daily), weekly.select(live.weekly(daily).columns))
    same(live.panel(daily), build_features(weekly, DOMAIN))


def test_batches_with_late_rows_equal_one_run(spark, daily, tmp_path):
    live = LivePanel(spark, f"{tmp_path}/live", DOMAIN)
    late = (F.col("product_id") == "P2") & (F.col("date") < dt.date(2023, 3, 1)) | (F.dayofmonth("date") == 11)
    batches = [daily.where((F.col("date") < dt.date(2023, 7, 1)) & ~late), daily.where(F.col("date") >= dt.date(2023, 7, 1)).where(~late), daily.where(late)]
    for i, batch in enumerate(batches):
        live.fold(batch, i)
    check(live, daily)
    assert live.mark()["batch"] == 2 and live.mark()["watermark"] < live.mark()["newest"]
    assert live.late().where("batch = 2").agg(F.sum("n_rows")).first()[0] > 20
    live.fold(batches[2], 2)  # delivered again
    live.fold(daily.limit(0), 3)
    check(live, daily)


def test_untouched_months_keep_their_files(spark, daily, tmp_path):
    live = LivePanel(spark, f"{tmp_path}/live", DOMAIN)
    live.fold(daily.where(F.col("date") < dt.date(2023, 10, 1)), 0)
    before = live.store.newest()[1]
    live.fold(daily.where(F.col("date") >= dt.date(2023, 10, 1)), 1)
    after = live.store.newest()[1]
    assert before["panel/2023-06"] == after["panel/2023-06"] and before["weeks/2023-06"] == after["weeks/2023-06"]
    assert "panel/2023-10" in after and "panel/2023-10" not in before
    check(live, daily)
    assert live.store.clean(keep=1, idle_hours=0) == [] or live.panel(daily).count() > 0
    check(live, daily)


def test_a_broken_batch_leaves_no_trace(spark, daily, tmp_path):
    live = LivePanel(spark, f"{tmp_path}/live", DOMAIN)
    live.fold(daily.where("product_id <> 'P3'"), 0)
    broken = daily.where("product_id = 'P3'").withColumn("units_sold", F.when(F.col("date") > dt.date(2023, 9, 1), F.raise_error(F.lit("lost")).cast("bigint")).otherwise(F.col("units_sold")))
    with pytest.raises(Exception, match="lost"):
        live.fold(broken, 1)
    check(live, daily.where("product_id <> 'P3'"))
    live.fold(daily.where("product_id = 'P3'"), 1)
    check(live, daily)


def test_stream_of_files(spark, daily, tmp_path):
    source, live = f"{tmp_path}/in", LivePanel(spark, f"{tmp_path}/live", DOMAIN)
    daily.where("store_id = 'S1'").coalesce(1).write.parquet(source)
    follow_sales(spark, source, DAILY_SALES, live, f"{tmp_path}/progress", 1)
    check(live, daily.where("store_id = 'S1'"))
    daily.where("store_id = 'S2'").coalesce(2).write.mode("append").parquet(source)
    follow_sales(spark, source, DAILY_SALES, live, f"{tmp_path}/progress", 1)
    check(live, daily)


def test_all_files_are_one_batch_and_no_task_writes_them_all(spark, daily, tmp_path, monkeypatch):
    from demandspark.catalog import live as queries
    from demandspark.catalog.base import Retail
    monkeypatch.setattr(queries, "CATEGORIES", DOMAIN)
    monkeypatch.setattr(queries, "shared_path", lambda _, kind: f"{tmp_path}/{kind}")
    r = Retail(spark, "")
    r.lines = daily.withColumns({"l_orderkey": F.monotonically_increasing_id(), "l_linenumber": F.lit(1)}).repartition(5)
    live = queries.followed(r)
    assert len(list((tmp_path / "arrivals").glob("*.parquet"))) == 10 and live.mark()["batch"] == 1
    check(live, daily)
