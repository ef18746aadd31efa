from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from demandspark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g",
                                           "spark.ui.showConsoleProgress": "false"})
    yield session
    session.stop()


MONDAY = dt.date(2023, 1, 2)


def week(i: int) -> dt.date:
    return MONDAY + dt.timedelta(weeks=i)


@pytest.fixture(scope="session")
def make_weekly(spark):
    """A weekly table from (store, product, week number, units) and overrides by column name."""
    from demandspark.functions.calendar import add_week_calendar, festival_flag
    from pyspark.sql import functions as F

    defaults = {"price": 10.0, "promo": 0, "stockout": 0, "lead": 7, "holding": 0.2, "base": 50.0, "category": "CAT0"}

    def make(rows):
        full = []
        for store, product, number, units, *rest in rows:
            o = {**defaults, **(rest[0] if rest else {})}
            full.append((store, f"Store {store}", product, f"Product {product}", o["category"], week(number),
                         units, float(units or 0) * o["price"], o["price"], o["promo"], o["stockout"], o["lead"],
                         o["holding"], o["base"]))
        df = spark.createDataFrame(full, (
            "store_id string, store_name string, product_id string, product_name string, category string, "
            "week_start date, units_sold bigint, revenue double, avg_price double, promo_days bigint, "
            "stockout_days bigint, lead_time_days int, holding_cost_pct double, base_price double"))
        df = add_week_calendar(df.withColumn("is_festival_season", festival_flag(F.month("week_start"))))
        return df.withColumn("is_promo_week", (F.col("promo_days") > 0).cast("int"))
    return make
