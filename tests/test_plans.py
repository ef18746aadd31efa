"""Physical plans, and the chained runs end to end."""

from __future__ import annotations

import datetime as dt
import os
import re
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from demandspark.catalog.base import CATEGORIES, Retail
from demandspark.functions import describe
from demandspark.operators import features, inventory, models, promo, quality
from demandspark.plans.core import data_quality, resume_core, run_core
from demandspark.plans.dashboard import dashboard
from demandspark.plans import extensions
from demandspark.plans.extensions import ExtensionInputs, run_extensions
from demandspark.sources.tables import read_table, retail_sales

SF_DIR = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the driver's tables")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(text: str) -> int:
    return len(re.findall(r"Exchange hashpartitioning", text))


def test_feature_panel_has_one_exchange_for_the_rollup_and_one_for_all_windows(spark):
    text = plan(Retail(spark, SF_DIR).panel_full)
    assert shuffles(text) == 2 and text.count("Window ") >= 1
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_reports_do_not_read_the_sales_again(spark):
    """Quartile reports and correlations read stored columns, or the sales once."""
    r = Retail(spark, SF_DIR)
    for df, scans in ((quality.describe(r.dirty), 0), (describe.box_stats(r.sales, "units_sold", "is_promotion"), 0),
                      (describe.correlations(r.sales, ["units_sold", "unit_price", "revenue"]), 1)):
        assert plan(df).count("/lineitem.parquet") == scans


def test_dimensions_are_broadcast_by_size(spark):
    text = plan(Retail(spark, SF_DIR).sales)
    assert text.count("BroadcastHashJoin") == 4 and shuffles(text) == 0


def test_policy_computes_only_the_lag_it_needs(spark):
    text = plan(Retail(spark, SF_DIR).policy)
    assert "lag_12w" in text and "roll_std_8w" not in text and "month_sin" not in text


def test_uplift_adds_one_exchange_to_the_panel(spark):
    assert shuffles(plan(promo.promo_uplift(Retail(spark, SF_DIR).panel))) <= shuffles(plan(Retail(spark, SF_DIR).panel)) + 1


def test_filters_and_columns_reach_the_scan(spark):
    sales = retail_sales(spark, SF_DIR, dt.date(1997, 1, 1), dt.date(1998, 12, 31))
    text = plan(sales.groupBy("category").agg(F.sum("units_sold")))
    assert "GreaterThanOrEqual(l_shipdate" in text and "LessThan(l_shipdate" in text
    assert "l_tax" not in text and "l_extendedprice" not in text


def test_no_cross_join_in_lookups(spark):
    retail = Retail(spark, SF_DIR)
    for df in (inventory.lookup_plant(retail.report), retail.weather, retail.scenarios):
        text = plan(df)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_core_extensions_and_dashboard(spark, tmp_path):
    retail = Retail(spark, "/root/testdata/sf0.01")
    raw = retail.dirty.where(F.col("product_id").isin("P001", "P002", "P003", "P004", "P005"))
    raw = raw.withColumn("is_weekend", (F.weekday("date") >= 5).cast("int"))
    stock = raw.select("store_id", "product_id").distinct().withColumn("current_stock", F.lit(60).cast("bigint"))
    tables = run_core(spark, raw, stock, str(tmp_path), CATEGORIES,
                      models_of=lambda c: {"LinearRegression": models.linear_regression(c)})
    assert tables.forecast.count() == 25 * 12 and tables.inventory.count() == 25
    assert tables.metrics.first().model == "LinearRegression"
    assert read_table(spark, f"{tmp_path}/inventory").count() == 25
    assert spark.read.text(f"{tmp_path}/model_comparison").count() == 1
    assert data_quality(raw)["duplicates"].first()[0] > 0

    again = resume_core(spark, stock, str(tmp_path), retrain=False)
    assert again.metrics is None and again.forecast.exceptAll(tables.forecast).count() == 0

    given = ExtensionInputs(retail.weather, dt.date(2002, 1, 7))
    report = read_table(spark, f"{tmp_path}/inventory")
    results = run_extensions(tables.panel, report, given, f"{tmp_path}/more")
    assert results.errors == {}
    assert results.tables["price_elasticity"].count() == 5
    assert results.tables["stl_summary"].count() == 25
    assert spark.read.text(f"{tmp_path}/more/alert_log").count() == min(10, tables.alerts.count())

    # An error that only rows show: the step is recorded, the others' tables are there.
    late = report.withColumn("EOQ", F.when(F.col("store_id") == "S001", F.raise_error(F.lit("bad row")).cast("double")).otherwise(F.col("EOQ")))
    broken = run_extensions(tables.panel, late, given, f"{tmp_path}/broken", ["alerts", "orders", "promotions"])
    assert set(broken.errors) == {"alerts", "orders"} and "bad row" in broken.errors["orders"]
    assert read_table(spark, f"{tmp_path}/broken/promo_uplift").count() > 0
    assert spark.read.text(f"{tmp_path}/broken/errors").count() == 2

    orders = results.tables["purchase_orders"].where("quantity > 1")
    first = orders.orderBy("po_number").first()
    open_orders = spark.createDataFrame([(first.store_id, first.material_id, first.quantity - 1)], "store_id string, product_id string, open_qty long")
    left = extensions.net_open_orders(tables.alerts, open_orders).where((F.col("store_id") == first.store_id) & (F.col("product_id") == first.material_id))
    assert left.first().recommended_order_qty == 1

    views = dashboard(tables.clean, tables.forecast, tables.inventory, tables.alerts, store="ASIA")
    assert views["status"].agg(F.sum("n")).first()[0] == 5
    assert {r.store_name for r in views["top_stores"].collect()} == {"ASIA"}


def test_python_workers_need_no_installed_package(tmp_path):
    code = (f"import sys; sys.path.insert(0, {ROOT!r})\n"
            "from demandspark.session import local_session\n"
            "from demandspark.catalog import QUERIES\n"
            "spark = local_session(2)\n"
            f"print('rows', QUERIES['price_elasticity'](spark, {'/root/testdata/sf0.01'!r}).count())\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 25" in done.stdout, done.stderr[-2000:]
