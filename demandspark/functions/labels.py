"""Text labels and enum columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from demandspark.constants import ELASTICITY_LABELS, ELASTICITY_OTHER, URGENT_ORDER_QTY


def elasticity_label(elasticity: Column) -> Column:
    label = F
    for upper, text in ELASTICITY_LABELS:
        label = label.when(elasticity < upper, text)
    return label.otherwise(ELASTICITY_OTHER)


def percent_label(share: Column) -> Column:
    """Signed whole percent, ``+10%``."""
    return F.format_string("%+d%%", F.rint(share * 100).cast("int"))


def parse_percent(label: Column) -> Column:
    return F.regexp_replace(label, "%", "").cast("double")


def promo_day_label(flag: Column) -> Column:
    return F.when(flag == 1, "Promo Day").when(flag == 0, "Normal Day")


def cluster_label(cluster: Column) -> Column:
    return F.concat(F.lit("Cluster-"), (cluster + 1).cast("string"))


def urgency(order_qty: Column) -> Column:
    return F.when(order_qty > URGENT_ORDER_QTY, "URGENT").otherwise("NORMAL")


def sign_label(value: Column) -> Column:
    return F.when(value >= 0, "pos").when(value < 0, "neg")


def item_label(product: Column, store: Column) -> Column:
    return F.concat(product, F.lit("\n("), store, F.lit(")"))


def truncate_label(text: Column, length: int) -> Column:
    return F.substring(text, 1, length)


def alert_line() -> Column:
    """One text line per reorder alert; whole numbers, thousands separated in the cost."""
    whole = {c: F.rint(F.col(c)).cast("bigint")
             for c in ["current_stock", "reorder_point", "recommended_order_qty"]}
    return F.format_string(
        "[%s] %s | Stock: %d | ROP: %d | Order: %d units | Cost: Rs %,d",
        F.col("store_name"), F.col("product_name"),
        whole["current_stock"], whole["reorder_point"], whole["recommended_order_qty"],
        F.rint(F.col("estimated_order_cost")).cast("bigint"),
    )
