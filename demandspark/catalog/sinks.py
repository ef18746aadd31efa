"""Stage tables, text reports, saved models and ERP tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from demandspark.catalog.base import Retail, number_of, query
from demandspark.catalog.inventory import RUN_DATE
from demandspark.catalog.learning import KEYS, one_model
from demandspark.functions import labels
from demandspark.functions.calendar import add_time_features
from demandspark.operators import inventory, models
from demandspark.session import shared_path
from demandspark.sources import erp, quarantine, stages
from demandspark.sources.schemas import DAILY_SALES


@query("scan_stage_outputs", "SELECT store_id, product_id, week_start, units_sold, promo_days FROM v_weekly")
def scan_stage_outputs(r: Retail):
    path = shared_path(r.spark, "weekly")
    stages.write_stage(r.weekly.withColumn("week_start", F.col("week_start").cast("string")), path)
    return stages.read_stage(r.spark, path).select("store_id", "product_id", "week_start", "units_sold", "promo_days")


@query("write_stage_tables", """
    SELECT 'weekly' AS stage, count(*) AS n_rows FROM v_weekly
    UNION ALL SELECT 'inventory', count(*) FROM v_report UNION ALL SELECT 'uplift', count(*) FROM v_uplift""")
def write_stage_tables(r: Retail):
    r.staged()
    paths = stages.write_stages({"weekly": r.weekly, "inventory": r.report, "uplift": r.uplift}, shared_path(r.spark, "stages"))
    counts = [r.spark.read.parquet(path).agg(F.lit(name).alias("stage"), F.count("*").alias("n_rows"))
              for name, path in paths.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("write_text_reports", "SELECT count(*) AS n_lines FROM v_alerts")
def write_text_reports(r: Retail):
    path = stages.write_text_report(r.alerts.select(labels.alert_line().alias("line")), shared_path(r.spark, "alerts"))
    return r.spark.read.text(path).agg(F.count("*").alias("n_lines"))


@query("save_load_model", "SELECT store_id, product_id, week_start, units_sold, TRUE AS predicts_the_same FROM v_split WHERE NOT is_train")
def save_load_model(r: Retail):
    """The test weeks, on which the model read back predicts what the one written did."""
    r.staged()
    trained = one_model(r, models.linear_regression)
    path = shared_path(r.spark, "model")
    models.save_model(trained.best_model, path)
    before = trained.scored.withColumnRenamed("predicted", "before")
    again = models.score(models.load_model(path), before)
    return again.select(*KEYS, "units_sold", F.col("predicted").eqNullSafe(F.col("before")).alias("predicts_the_same"))


@query("stock_snapshot_normalise", """
    SELECT store_id, product_id, current_stock, CAST(1 AS BIGINT) * in_transit_qty AS in_transit_qty,
      CAST(1 AS BIGINT) * reserved_qty AS reserved_qty
    FROM (SELECT store_id, product_id, current_stock, 2 * (current_stock % 50) AS in_transit_qty,
            2 * (current_stock % 20) AS reserved_qty FROM v_stocked)""")
def stock_snapshot_normalise(r: Retail):
    # Two plants per item hold the halves of the stand-in stock.
    half = F.floor(F.col("current_stock") / 2)
    base = r.stock.withColumn("plant", F.explode(F.array(F.lit("A"), F.lit("B"))))
    rows = base.select(
        "plant", "store_id", F.col("product_id").alias("material_id"),
        F.when(F.col("plant") == "A", half).otherwise(F.col("current_stock") - half).cast("int").alias("unrestricted_stock"),
        (F.col("current_stock") % 50).cast("int").alias("in_transit_qty"),
        (F.col("current_stock") % 20).cast("int").alias("reserved_qty"))
    path = stages.write_stage(rows.withColumns({"last_updated": F.lit(dt.datetime(2002, 1, 7)), "unit": F.lit("EA")}), shared_path(r.spark, "stock"))
    return erp.stock_snapshot(erp.read_erp_stock(r.spark, path))


@query("open_po_by_item", f"""
    SELECT store_id, product_id, count(*) AS open_orders, CAST(sum(recommended_order_qty) AS BIGINT) AS open_qty,
      CAST(min(DATE '{RUN_DATE}' + lead_time_days) AS DATE) AS next_delivery
    FROM v_alerts WHERE (CAST(substr(product_id, 2) AS BIGINT)) % 4 <> 3 GROUP BY ALL""")
def open_po_by_item(r: Retail):
    orders = inventory.purchase_orders(r.alerts, RUN_DATE)
    # Every fourth product's orders are closed.
    status = F.get(F.array(*[F.lit(s) for s in ["AWAITING_APPROVAL", "APPROVED", "IN_TRANSIT", "CLOSED"]]),
                   (number_of("material_id") % 4).cast("int"))
    rows = orders.withColumns({"status": status, "quantity": F.col("quantity").cast("int")}).select(
        "po_number", "material_id", "store_id", "quantity", "unit_price", "status", "expected_delivery", "supplier")
    path = stages.write_stage(rows, shared_path(r.spark, "orders"))
    return erp.open_orders_by_item(erp.read_erp_orders(r.spark, path))


@query("stage_versions", """
    SELECT 'weekly' AS stage, 1 AS version, count(*) AS n_rows, CAST(sum(units_sold) AS BIGINT) AS units_sold FROM v_weekly
    UNION ALL SELECT 'weekly', 2, count(*), CAST(sum(units_sold) AS BIGINT) FROM v_weekly WHERE units_sold > 100
    UNION ALL SELECT 'items', 2, count(*), CAST(sum(units_sold) AS BIGINT) FROM (SELECT sum(units_sold) AS units_sold FROM v_weekly GROUP BY store_id, product_id)""")
def stage_versions(r: Retail):
    """A second run replaces one table and adds another in one step; a third breaks off and changes nothing."""
    store = stages.StageStore(r.spark, shared_path(r.spark, "versions"))
    facts = lambda df, name, version: df.agg(
        F.lit(name).alias("stage"), F.lit(version).alias("version"), F.count("*").alias("n_rows"), F.sum("units_sold").alias("units_sold"))
    with store.begin() as stage:
        stage.write("weekly", r.weekly)
    first = store.read("weekly")
    with store.begin() as stage:
        items = first.groupBy("store_id", "product_id").agg(F.sum("units_sold").alias("units_sold"))
        stage.write("weekly", first.where("units_sold > 100"))
        stage.write("items", items)
    broken = store.begin()
    broken.write("weekly", first.limit(0))  # written, but never committed
    return (facts(first, "weekly", 1).unionByName(facts(store.read("weekly"), "weekly", 2))
            .unionByName(facts(store.read("items"), "items", 2)))


@query("quarantine_broken_rows", """
    SELECT reason, count(*) AS n_rows, CAST(sum(CASE WHEN reason = 'sound' THEN units_sold END) AS BIGINT) AS units_sold
    FROM (SELECT CASE WHEN l_orderkey % 31 = 0 THEN 'fields: 3' WHEN l_orderkey % 23 = 0 AND l_orderkey % 29 = 0 THEN 'type: date, units_sold'
                   WHEN l_orderkey % 23 = 0 THEN 'type: units_sold' WHEN l_orderkey % 29 = 0 THEN 'type: date'
                   WHEN l_orderkey % 37 = 0 THEN 'missing: store_id' ELSE 'sound' END AS reason, units_sold FROM v_lines) GROUP BY reason""")
def quarantine_broken_rows(r: Retail):
    """Sales lines as text, some cut short, with a word for a number, an impossible date or no store: by reason, beside the sound rows."""
    key = F.col("l_orderkey")
    rows = add_time_features(r.lines).withColumns({
        "date": F.when(key % 29 == 0, "2024-13-45").otherwise(F.col("date").cast("string")),
        "units_sold": F.when(key % 23 == 0, "many").otherwise(F.col("units_sold").cast("string")),
        "store_id": F.when(key % 37 != 0, F.col("store_id"))})
    fields = F.array(*[F.coalesce(F.col(f.name).cast("string"), F.lit("")) for f in DAILY_SALES])
    line = F.array_join(F.when(key % 31 == 0, F.slice(fields, 1, 3)).otherwise(fields), ",")
    path, root = shared_path(r.spark, "lines"), shared_path(r.spark, "ingested")
    rows.select(line.alias("value")).write.text(path)
    sound = quarantine.ingest(r.spark, path, root, header=False, most_broken=0.5)
    broken = stages.read_stage(r.spark, f"{root}/quarantine")
    return (broken.groupBy("reason").agg(F.count("*").alias("n_rows"), F.lit(None).cast("bigint").alias("units_sold"))
            .unionByName(sound.agg(F.lit("sound").alias("reason"), F.count("*").alias("n_rows"), F.sum("units_sold").alias("units_sold"))))
