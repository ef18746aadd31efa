"""The stored cube answers every filter as the daily table does, without reading it."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from demandspark.functions.calendar import add_time_features
from demandspark.operators import reports
from demandspark.operators.quality import filter_domains
from demandspark.plans import dashboard
from demandspark.plans.cube import SalesCube


@pytest.fixture(scope="module")
def daily(spark):
    rng = random.Random(4)
    rows = [(dt.date(2023, 1, 20) + dt.timedelta(days=rng.randrange(400)), rng.choice(["N", "S", "é", None]), rng.choice(["A", "B"]),
             rng.choice([None, *range(9)]), rng.choice([None, round(rng.random() * 100, 2)]), rng.randint(0, 1), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "date date, store_name string, category string, units_sold bigint, revenue double, stockout_flag int, i int")
    return add_time_features(df).persist()


def same(one, two):
    got, want = (sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str) for df in (one, two.select(one.columns)))
    assert got == want


RANGES = [(None, None), (dt.date(2023, 3, 14), dt.date(2023, 8, 9)), (dt.date(2023, 3, 1), dt.date(2023, 3, 31)), (dt.date(2023, 5, 5), dt.date(2023, 5, 20)),
          (dt.date(2023, 4, 2), None), (None, dt.date(2023, 12, 30)), (dt.date(2023, 2, 1), dt.date(2023, 1, 1)), (dt.date(2023, 6, 30), dt.date(2023, 7, 1))]


def test_slices_equal_the_direct_reports(spark, daily, tmp_path):
    cube = SalesCube(spark, f"{tmp_path}/cube").build(daily)
    alerts = spark.range(3)
    for i, (start, end) in enumerate(RANGES):
        store, category = [(None, None), ("N", None), (None, "A"), ("é", "B")][i % 4]
        rows = reports.dashboard_filter(daily, store, category, start, end)
        part = cube.slice(store, category, start, end)
        same(part.kpis(), dashboard.daily_kpis(rows, alerts).drop("n_alerts"))
        same(part.monthly_revenue(), reports.monthly_revenue(rows))
        same(part.category_revenue(), reports.revenue_by(rows, "category"))
    same(part.season(), reports.season_pivot(rows))
    same(part.stockouts(), reports.stockouts_by_category(rows))
    same(cube.slice().store_years([2023, 2024]), reports.store_year_matrix(daily, [2023, 2024]))
    same(cube.slice().top_stores(2), reports.top_by_sum(daily, "store_name", "revenue", 2))
    same(cube.slice().filters(), filter_domains(daily))


def test_added_sales_give_the_cube_of_all(spark, daily, tmp_path):
    whole = SalesCube(spark, f"{tmp_path}/a").build(daily)
    grown = SalesCube(spark, f"{tmp_path}/b")
    for third in range(3):
        grown.add(daily.where(F.col("i") % 3 == third))
    for table in ("cube_days", "cube_months"):
        one, two = (c.store.read(table) for c in (whole, grown))
        assert one.exceptAll(two.select(one.columns)).count() == 0 and one.count() == two.count()
    with pytest.raises(Exception):
        grown.add(daily.withColumn("revenue", F.when(F.col("i") < 5, F.raise_error(F.lit("lost"))).otherwise(F.col("revenue"))))
    assert grown.store.read("cube_days").count() == whole.store.read("cube_days").count()


def test_a_filter_change_does_not_read_the_sales(spark, daily, tmp_path):
    daily.drop("i").write.parquet(f"{tmp_path}/sales_rows")
    cube = SalesCube(spark, f"{tmp_path}/cube").build(spark.read.parquet(f"{tmp_path}/sales_rows"))
    report = spark.createDataFrame([("N", "A", 1, 1.0, 2.0, 3, "OK", "x", dt.date(2024, 1, 1), 5, 1.0, "S", "P")],
                                   "store_name string, category string, recommended_order_qty int, safety_stock double, reorder_point double, current_stock int, "
                                   "inventory_status string, product_name string, week_start date, predicted_units int, estimated_order_cost double, "
                                   "store_id string, product_id string")
    tables = dashboard.dashboard(cube, report, report, report, store="N", start=dt.date(2023, 3, 14))
    for name in ("kpis", "monthly_revenue", "category_revenue", "top_stores", "season", "filters"):
        files = tables[name].inputFiles()  # plans shorten paths
        assert files and all("/cube/cube_" in f and "/sales_rows/" not in f for f in files)
    read = tables["monthly_revenue"]._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in read and "2023-04-01" in read
