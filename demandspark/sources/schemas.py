"""Declared schemas of the inputs."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(), "date": T.DateType(), "int": T.IntegerType(),
    "bigint": T.LongType(), "double": T.DoubleType(), "timestamp": T.TimestampType(),
}


def schema(spec: str) -> T.StructType:
    """``"name:type, name:type"`` as a StructType."""
    fields = [part.strip().split(":") for part in spec.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


DAILY_SALES = schema(
    "date:date, store_id:string, store_name:string, state:string, product_id:string, "
    "product_name:string, category:string, units_sold:bigint, unit_price:double, revenue:double, "
    "is_promotion:int, is_weekend:int, month:int, year:int, day_of_week:int, week_number:int, "
    "stockout_flag:int, lead_time_days:int, holding_cost_pct:double, base_price:double")

STOCK_LEVELS = schema("store_id:string, product_id:string, current_stock:bigint")

WEATHER = schema(
    "week_start:date, store_name:string, temperature_c:double, rainfall_mm:double, is_rainy_week:int")

ERP_STOCK = schema(
    "plant:string, store_id:string, material_id:string, unrestricted_stock:int, in_transit_qty:int, "
    "reserved_qty:int, last_updated:timestamp, unit:string")

ERP_OPEN_PO = schema(
    "po_number:string, material_id:string, store_id:string, quantity:int, unit_price:double, "
    "status:string, expected_delivery:date, supplier:string")

MODEL_METRICS = schema("model:string, MAE:double, RMSE:double, R2:double, MAPE:double")
