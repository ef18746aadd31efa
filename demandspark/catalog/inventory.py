"""Inventory policy, alerts, purchase orders and the reports over them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from demandspark.catalog.base import Retail, he, query
from demandspark.catalog.sql import ITEM
from demandspark.catalog.sql import he as sql_he
from demandspark.functions import labels
from demandspark.operators import cluster, inventory, promo, reports
from demandspark.operators.forecast import append_forecast

KEYS = ["store_id", "product_id"]
RUN_DATE = dt.date(2002, 1, 7)
POLICY = ["safety_stock", "reorder_point", "EOQ"]
STATS = ["avg_weekly_demand", "std_weekly_demand", "annual_demand"]
REPORT = [*ITEM.split(", "), "lead_time_days", "holding_cost_pct", "base_price", "obs_weeks", *POLICY,
          "current_stock", "inventory_status", "forecast_12w_demand"]


def report_columns(df, *extra: str):
    return df.select(*REPORT, *[he(c) for c in STATS], he("lead_time_weeks"), he("holding_cost_per_unit"), *extra)


def report_sql(view: str, *extra: str) -> str:
    rounded = [f"{sql_he(c)} AS {c}" for c in [*STATS, "lead_time_weeks", "holding_cost_per_unit"]]
    return f"SELECT {', '.join([*REPORT, *rounded, *extra])} FROM {view}"


@query("demand_stats", f"SELECT {ITEM}, lead_time_days, holding_cost_pct, base_price, obs_weeks, "
                       + ", ".join(f"{sql_he(c)} AS {c}" for c in STATS) + " FROM v_stats")
def demand_stats(r: Retail):
    return inventory.demand_stats(r.panel).select(
        *ITEM.split(", "), "lead_time_days", "holding_cost_pct", "base_price", "obs_weeks", *[he(c) for c in STATS])


@query("safety_stock", "SELECT store_id, product_id, safety_stock FROM v_safety")
def safety_stock(r: Retail):
    return inventory.safety_stock(inventory.demand_stats(r.panel)).select(*KEYS, "safety_stock")


@query("reorder_point", "SELECT store_id, product_id, safety_stock, reorder_point FROM v_point")
def reorder_point(r: Retail):
    return r.policy.select(*KEYS, "safety_stock", "reorder_point")


@query("eoq", "SELECT store_id, product_id, EOQ FROM v_policy")
def eoq(r: Retail):
    return r.policy.select(*KEYS, "EOQ")


@query("stock_position", "SELECT store_id, product_id, reorder_point, EOQ, current_stock FROM v_stocked")
def stock_position(r: Retail):
    r.staged()
    return inventory.stock_position(r.policy, r.stock).select(*KEYS, "reorder_point", "EOQ", "current_stock")


@query("inventory_status", "SELECT store_id, product_id, current_stock, inventory_status FROM v_status")
def inventory_status(r: Retail):
    r.staged()
    stocked = inventory.stock_position(r.policy, r.stock)
    return inventory.assign_status(stocked).select(*KEYS, "current_stock", "inventory_status")


@query("join_forecast_demand", "SELECT store_id, product_id, forecast_12w_demand FROM v_report")
def join_forecast_demand(r: Retail):
    r.staged()
    return inventory.join_forecast_demand(r.policy, r.naive).select(*KEYS, "forecast_12w_demand")


@query("inventory_report", report_sql("v_report"))
def inventory_report(r: Retail):
    return report_columns(r.report)


@query("reorder_alerts", report_sql("v_alerts", "recommended_order_qty", "estimated_order_cost"))
def reorder_alerts(r: Retail):
    return report_columns(inventory.reorder_alerts(r.report), "recommended_order_qty", "estimated_order_cost")


@query("alert_digest", f"""
    SELECT position, store_name, product_name, category, current_stock, reorder_point, recommended_order_qty,
      estimated_order_cost, CASE WHEN recommended_order_qty > 200 THEN 'URGENT' ELSE 'NORMAL' END AS urgency,
      CASE WHEN position <= 10 THEN format('[{{}}] {{}} | Stock: {{}} | ROP: {{}} | Order: {{}} units | Cost: Rs {{:,}}',
        store_name, product_name, current_stock, CAST({sql_he('reorder_point', 0)} AS BIGINT),
        recommended_order_qty, CAST({sql_he('estimated_order_cost', 0)} AS BIGINT)) END AS line,
      (SELECT count(*) FROM v_report WHERE inventory_status = 'REORDER') AS n_reorder,
      (SELECT count(*) FROM v_report WHERE inventory_status = 'OVERSTOCK') AS n_overstock,
      (SELECT sum(estimated_order_cost) FROM v_alerts) AS total_value
    FROM (SELECT *, CAST(row_number() OVER (ORDER BY estimated_order_cost DESC, store_id, product_id) AS INT) AS position
          FROM v_alerts) WHERE position <= 15""")
def alert_digest(r: Retail):
    r.staged()
    return inventory.alert_digest(r.alerts, r.report)


@query("urgency_level", """
    SELECT store_id, product_id, recommended_order_qty,
      CASE WHEN recommended_order_qty > 200 THEN 'URGENT' ELSE 'NORMAL' END AS urgency FROM v_alerts""")
def urgency_level(r: Retail):
    return r.alerts.select(*KEYS, "recommended_order_qty", labels.urgency(F.col("recommended_order_qty")).alias("urgency"))


@query("alert_line_format", f"""
    SELECT store_id, product_id,
      format('[{{}}] {{}} | Stock: {{}} | ROP: {{}} | Order: {{}} units | Cost: Rs {{:,}}',
        store_name, product_name, current_stock, CAST({sql_he('reorder_point', 0)} AS BIGINT),
        recommended_order_qty, CAST({sql_he('estimated_order_cost', 0)} AS BIGINT)) AS line FROM v_alerts""")
def alert_line_format(r: Retail):
    return r.alerts.select(*KEYS, labels.alert_line().alias("line"))


@query("item_label", "SELECT store_id, product_id, product_name || chr(10) || '(' || store_name || ')' AS label "
                     "FROM v_report")
def item_label(r: Retail):
    return r.report.select(*KEYS, labels.item_label(F.col("product_name"), F.col("store_name")).alias("label"))


@query("truncate_label", "SELECT product_id, store_name, substr(product_name, 1, 6) AS product_label, "
                         "substr(store_name, 1, 9) AS store_label FROM v_report")
def truncate_label(r: Retail):
    return r.report.select("product_id", "store_name",
                           labels.truncate_label(F.col("product_name"), 6).alias("product_label"),
                           labels.truncate_label(F.col("store_name"), 9).alias("store_label"))


@query("lookup_region", """
    SELECT store_id, region, count(*) AS n FROM v_panel JOIN (VALUES ('S001', 'West'), ('S002', 'North'),
      ('S003', 'South')) t(store_id, region) USING (store_id) GROUP BY ALL""")
def lookup_region(r: Retail):
    from demandspark.functions.lookup import literal_table
    regions = literal_table(r.spark, {"S001": "West", "S002": "North", "S003": "South"}, "store_id", "region")
    found = cluster.lookup_region(r.panel, regions, unmapped="drop")
    return found.groupBy("store_id", "region").agg(F.count("*").alias("n"))


@query("lookup_plant", """
    SELECT store_id, product_id, coalesce(plant, 'UNKNOWN') AS plant FROM v_report
    LEFT JOIN (VALUES ('S001', 'PLANT_MUM'), ('S002', 'PLANT_DEL')) t(store_id, plant) USING (store_id)""")
def lookup_plant(r: Retail):
    from demandspark.functions.lookup import literal_table
    plants = literal_table(r.spark, {"S001": "PLANT_MUM", "S002": "PLANT_DEL"}, "store_id", "plant")
    return inventory.lookup_plant(r.report, plants).select(*KEYS, "plant")


@query("purchase_order_batch", f"""
    SELECT 'PO-' || upper(substr(md5(store_id || '|' || product_id || '|{RUN_DATE}'), 1, 12)) AS po_number, store_id,
      coalesce(plant, 'UNKNOWN') AS plant, product_id AS material_id, recommended_order_qty AS quantity,
      base_price AS unit_price, {sql_he('recommended_order_qty * base_price', 2)} AS total_value,
      'AUTO-SELECT' AS supplier, 'AWAITING_APPROVAL' AS status, DATE '{RUN_DATE}' AS created_at,
      CAST(DATE '{RUN_DATE}' + lead_time_days AS DATE) AS expected_delivery
    FROM v_alerts LEFT JOIN (VALUES ('S001', 'PLANT_MUM'), ('S002', 'PLANT_DEL'), ('S003', 'PLANT_BLR'),
      ('S004', 'PLANT_PUN'), ('S005', 'PLANT_CHN')) t(store_id, plant) USING (store_id)""")
def purchase_order_batch(r: Retail):
    return inventory.purchase_orders(r.alerts, RUN_DATE)


@query("status_breakdown", f"""
    SELECT inventory_status, count(*) AS n, {sql_he('count(*) / sum(count(*)) OVER ()')} AS share
    FROM v_report GROUP BY inventory_status""")
def status_breakdown(r: Retail):
    return reports.status_breakdown(r.report)


@query("safety_stock_by_category", f"SELECT category, {sql_he('avg(safety_stock)')} AS avg_safety_stock "
                                   "FROM v_report GROUP BY category")
def safety_stock_by_category(r: Retail):
    return reports.category_means(r.policy, "safety_stock").select("category", he("avg_safety_stock"))


@query("stock_levels_by_category", "SELECT category, " + ", ".join(
    f"{sql_he(f'avg({c})')} AS avg_{c}" for c in ("safety_stock", "reorder_point", "current_stock"))
    + " FROM v_report GROUP BY category")
def stock_levels_by_category(r: Retail):
    columns = ["safety_stock", "reorder_point", "current_stock"]
    means = reports.category_means(r.report, *columns)
    return means.select("category", *[he(f"avg_{c}") for c in columns])


@query("category_week_forecast", "SELECT week_start, category, CAST(sum(predicted_units) AS BIGINT) AS predicted_units "
                                 "FROM v_naive GROUP BY ALL")
def category_week_forecast(r: Retail):
    return reports.forecast_by(r.naive, "week_start", "category")


@query("category_forecast_summary", f"""
    SELECT store_name, category, CAST(sum(predicted_units) AS BIGINT) AS total_predicted_12w,
      {sql_he('avg(predicted_units)', 1)} AS avg_weekly_predicted, max(predicted_units) AS peak_weekly_demand
    FROM v_naive GROUP BY ALL""")
def category_forecast_summary(r: Retail):
    return reports.category_forecast_summary(r.naive)


@query("executive_kpis", f"""
    SELECT {sql_he('sum(revenue)', 2)} AS total_revenue, CAST(sum(units_sold) AS BIGINT) AS total_units,
      count(*) FILTER (WHERE stockout_days > 0) AS stockout_weeks,
      (SELECT count(*) FROM v_report WHERE inventory_status = 'REORDER') AS reorder_items,
      (SELECT count(*) FROM v_alerts) AS n_alerts, (SELECT count(*) FROM v_anomalies) AS n_anomalies,
      (SELECT {sql_he('avg(abs((units_sold - lag_1w) / (units_sold + 1e-6))) * 100')} FROM v_panel) AS forecast_mape
    FROM v_panel""")
def executive_kpis(r: Retail):
    r.staged()
    from demandspark.operators.models import regression_metrics
    scored = r.panel.withColumn("predicted", F.col("lag_1w"))
    kpis = reports.executive_kpis(r.panel, r.report, r.alerts, r.anomalies, regression_metrics(scored))
    return kpis.withColumns({"total_revenue": he("total_revenue", 2), "forecast_mape": he("forecast_mape")})


@query("alert_kpis", """
    SELECT category, count(*) AS n_alerts, CAST(sum(recommended_order_qty) AS BIGINT) AS total_qty,
      sum(estimated_order_cost) AS total_value
    FROM v_alerts GROUP BY GROUPING SETS ((), (category))""")
def alert_kpis(r: Retail):
    r.staged()
    return reports.alert_kpis(r.alerts)


@query("top10_products_forecast", """
    SELECT product_name, CAST(sum(predicted_units) AS BIGINT) AS predicted_units FROM v_naive GROUP BY product_name
    ORDER BY predicted_units DESC, product_name LIMIT 10""")
def top10_products_forecast(r: Retail):
    return reports.top_by_sum(r.naive, "product_name", "predicted_units", 10)


@query("top15_reorders_by_qty", """
    SELECT store_id, product_id, recommended_order_qty FROM v_alerts
    ORDER BY recommended_order_qty DESC, store_id, product_id LIMIT 15""")
def top15_reorders_by_qty(r: Retail):
    return (r.alerts.orderBy(F.desc("recommended_order_qty"), *KEYS).limit(15)
            .select(*KEYS, "recommended_order_qty"))


@query("sorted_reports", """
    SELECT 'alerts' AS report, store_id || '/' || product_id AS item, estimated_order_cost AS sort_value FROM v_alerts
    UNION ALL SELECT 'elasticity', product_id, price_elasticity FROM v_elasticity
    UNION ALL SELECT 'stl', store_id || '/' || product_id, seasonal_strength FROM v_summary""")
def sorted_reports(r: Retail):
    r.staged()
    from demandspark.operators import decompose
    alerts = r.alerts.select(F.lit("alerts").alias("report"), F.concat_ws("/", *KEYS).alias("item"),
                             F.col("estimated_order_cost").alias("sort_value"))
    elasticity = r.elasticity.select(F.lit("elasticity").alias("report"), F.col("product_id").alias("item"),
                                     F.col("price_elasticity").alias("sort_value"))
    long = decompose.long_series(decompose.gap_fill(r.panel))
    strength = decompose.decomposition_summary(decompose.classical_decompose(long)).select(
        F.lit("stl").alias("report"), F.concat_ws("/", *KEYS).alias("item"),
        F.col("seasonal_strength").alias("sort_value"))
    ascending = F.when(F.col("report") == "elasticity", F.col("sort_value")).otherwise(-F.col("sort_value"))
    return alerts.unionByName(elasticity).unionByName(strength).orderBy("report", ascending, "item")


@query("sample_60", f"SELECT {', '.join(KEYS)}, EOQ, current_stock, inventory_status FROM v_report ORDER BY md5(concat_ws('|', store_id, product_id)), store_id, product_id LIMIT 60")
def sample_60(r: Retail):
    return reports.stable_sample(r.report, 60).select(*KEYS, "EOQ", "current_stock", "inventory_status")


@query("append_forecast_rows", f"""
    SELECT {ITEM}, week_start, units_sold, CAST(NULL AS BIGINT) AS predicted_units, CAST(NULL AS INT) AS horizon_week
    FROM v_panel UNION ALL
    SELECT {ITEM}, week_start, predicted_units, predicted_units, horizon_week FROM v_naive""")
def append_forecast_rows(r: Retail):
    r.staged()
    history = r.panel.select(*ITEM.split(", "), "week_start", "units_sold")
    return append_forecast(history, r.naive.withColumn("units_sold", F.col("predicted_units")))


@query("clip_round_prediction", f"""
    SELECT store_id, product_id, week_start,
      CAST(greatest(0, {sql_he('units_sold / 2e0 - 25', 0)}) AS BIGINT) AS predicted FROM v_panel""")
def clip_round_prediction(r: Retail):
    from demandspark.functions.numeric import to_units
    # Half units and negatives on purpose.
    return r.panel.select(*KEYS, "week_start", to_units(F.col("units_sold") / 2 - 25).alias("predicted"))


@query("ab_assignment", """
    SELECT store_id, CASE WHEN row_number() OVER (ORDER BY store_id) <= floor(count(*) OVER () * 0.6e0)
                          THEN 'Treatment' ELSE 'Control' END AS ab_group
    FROM (SELECT DISTINCT store_id FROM v_panel)""")
def ab_assignment(r: Retail):
    return promo.ab_assignment(r.panel, order_key="store_id")
