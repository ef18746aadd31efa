"""Worked rows with known results."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from demandspark.functions import labels
from demandspark.operators import inventory, promo


def policy_row(spark, mean, std, lead, hold, price, stock):
    stats = spark.createDataFrame(
        [("S001", "P001", mean, std, mean * 52, lead, hold, price)],
        "store_id string, product_id string, avg_weekly_demand double, std_weekly_demand double, "
        "annual_demand double, lead_time_days int, holding_cost_pct double, base_price double")
    levels = spark.createDataFrame([("S001", "P001", stock)], "store_id string, product_id string, current_stock bigint")
    full = inventory.order_quantity(inventory.reorder_point(inventory.safety_stock(stats)))
    return inventory.assign_status(inventory.stock_position(full, levels)).first()


def test_policy_ok(spark):
    row = policy_row(spark, 806.5288888888889, 148.01957613989754, 2, 0.25, 55.0, 421)
    assert (row.safety_stock, row.reorder_point, row.EOQ, row.inventory_status) == (130.5, 360.9, 781.0, "OK")


def test_policy_overstock(spark):
    row = policy_row(spark, 515.04, 106.80215019237336, 5, 0.2, 320.0, 1348)
    assert (row.reorder_point, row.EOQ, row.inventory_status) == (516.8, 289.3, "OVERSTOCK")


def test_zero_holding_cost_orders_nothing(spark):
    assert policy_row(spark, 100.0, 10.0, 7, 0.0, 50.0, 10).EOQ == 0.0


def report(spark, rows):
    return spark.createDataFrame(rows, (
        "store_id string, store_name string, product_id string, product_name string, category string, "
        "lead_time_days int, base_price double, reorder_point double, EOQ double, current_stock bigint, "
        "inventory_status string"))


def test_alert_and_purchase_order(spark):
    df = report(spark, [("S001", "Mumbai Central", "P008", "Tata Tea Premium 500g", "Beverages", 5, 250.0, 464.1,
                         318.5, 344, "REORDER"),
                        ("S009", "Other", "P001", "X", "Dairy", 2, 10.0, 5.0, 5.0, 100, "OK")])
    alerts = inventory.reorder_alerts(df)
    row = alerts.first()
    assert alerts.count() == 1
    assert (row.recommended_order_qty, row.estimated_order_cost) == (439, 109750.0)
    order = inventory.purchase_orders(alerts, dt.date(2026, 4, 14)).first()
    assert (order.plant, order.total_value, order.status) == ("PLANT_MUM", 109750.0, "AWAITING_APPROVAL")
    assert order.expected_delivery == dt.date(2026, 4, 19)


def test_half_order_quantities_round_to_even(spark):
    df = report(spark, [("S001", "A", "P001", "a", "c", 1, 1.0, 438.5, 0.0, 0, "REORDER"),
                        ("S001", "A", "P002", "b", "c", 1, 1.0, 437.5, 0.0, 0, "REORDER")])
    assert [r.recommended_order_qty for r in inventory.reorder_alerts(df).collect()] == [438, 438]


def test_status_bounds(spark):
    rows = spark.createDataFrame([(10.0, 5.0, 10), (10.0, 5.0, 20), (10.0, 5.0, 21)],
                                 "reorder_point double, EOQ double, current_stock bigint")
    got = [r.inventory_status for r in inventory.assign_status(rows).orderBy("current_stock").collect()]
    assert got == ["REORDER", "OK", "OVERSTOCK"]


def test_alert_line(spark):
    row = spark.createDataFrame([("Mumbai Central", "Tata Tea Premium 500g", 317, 421.9, 413, 103250.0)],
                                "store_name string, product_name string, current_stock bigint, reorder_point double, "
                                "recommended_order_qty bigint, estimated_order_cost double")
    assert row.select(labels.alert_line()).first()[0] == (
        "[Mumbai Central] Tata Tea Premium 500g | Stock: 317 | ROP: 422 | Order: 413 units | Cost: Rs 103,250")


def test_roi(spark):
    events = spark.range(680).select(F.lit("Ready Meals").alias("category"), F.lit(1).alias("promo_units"),
                                     F.lit(6.3).alias("uplift_pct"),
                                     (F.lit(4987590.94) / 680).alias("incremental_revenue"))
    row = promo.promo_roi(events).first()
    assert (row.assumed_promo_cost, row.ROI_pct) == (3400000.0, 46.7)


def test_treatment_effect_percent(spark):
    rows = [("S001", 755.06, 1)] * 6 + [("S002", 720.42, 0)] * 6
    panel = spark.createDataFrame([("P014", "Namkeen", "Snacks", s, u, p) for s, u, p in rows],
                                  "product_id string, product_name string, category string, store_id string, "
                                  "units_sold double, is_promo_week int")
    groups = spark.createDataFrame([("S001", "Treatment"), ("S002", "Control")], "store_id string, ab_group string")
    row = promo.ab_effect(panel, groups).first()
    assert (row.ATE, row.ATE_pct, row.significant) == (34.64, 4.81, True)
