"""Tables that follow a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from demandspark.catalog.base import CATEGORIES, Retail, he, query
from demandspark.catalog.sql import he as sql_he
from demandspark.session import shared_path
from demandspark.streaming.panel import LivePanel, follow_sales

KEYS = ["store_id", "product_id", "week_start"]


def followed(r: Retail) -> LivePanel:
    """Even and odd orders arrive as two batches, so that the second brings late rows for nearly all weeks."""
    source, progress = shared_path(r.spark, "arrivals"), shared_path(r.spark, "progress")
    live = LivePanel(r.spark, shared_path(r.spark, "live"), CATEGORIES)
    for half in (0, 1):
        r.lines.where(F.col("l_orderkey") % 2 == half).drop("l_orderkey", "l_linenumber").write.mode("append").parquet(source)
        follow_sales(r.spark, source, r.sales.schema, live, progress, files_per_batch=None)
    return live


@query("live_panel", f"SELECT {', '.join(KEYS)}, units_sold, lag_1w, lag_12w, {sql_he('roll_mean_4w')} AS roll_mean_4w, {sql_he('roll_std_12w')} AS roll_std_12w "
                     "FROM v_panel")
def live_panel(r: Retail):
    return followed(r).panel(r.sales).select(*KEYS, "units_sold", "lag_1w", "lag_12w", he("roll_mean_4w"), he("roll_std_12w"))
