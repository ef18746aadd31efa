"""The extension analyses over the weekly panel, each independent of the others."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.functions.numeric import round_half_even
from demandspark.operators import anomaly, cluster, decompose, inventory, pricing, promo, weather
from demandspark.sources import stages


@dataclass
class ExtensionInputs:
    """Tables and choices besides the panel and the inventory report; lookups default to the fixed values."""
    weather: DataFrame
    run_date: dt.date
    regions: DataFrame | None = None
    plants: DataFrame | None = None
    sensitivity: DataFrame | None = None
    climate: DataFrame | None = None
    open_orders: DataFrame | None = None


@dataclass
class ExtensionResults:
    tables: dict[str, DataFrame] = field(default_factory=dict)
    errors: dict[str, str] = field(default_factory=dict)


def _clustering(panel, report, given):
    stores = cluster.store_features(panel, given.regions)
    return {"store_clusters": cluster.cluster_stores(stores), "product_segments": cluster.segment_products(cluster.product_features(panel)),
            "region_revenue": cluster.region_revenue(stores)}


def _pricing(panel, report, given):
    elasticity = pricing.price_elasticity(panel)
    scenarios = pricing.price_scenarios(pricing.price_demand_base(elasticity, panel))
    return {"price_elasticity": elasticity, "optimal_pricing": pricing.optimal_price(scenarios)}


def _weather(panel, report, given):
    merged = weather.weather_adjusted_demand(panel, given.weather, given.sensitivity)
    return {"weather_demand": merged, "weather_impact": weather.weather_impact(merged, given.sensitivity)}


def _alerts(panel, report, given):
    return {"alert_digest": inventory.alert_digest(inventory.reorder_alerts(report), report)}


def _decomposition(panel, report, given):
    return {"stl_summary": decompose.stl_all_series(panel)}


def _orders(panel, report, given):
    alerts = inventory.reorder_alerts(report, ordered=False)
    if given.open_orders is not None:
        alerts = net_open_orders(alerts, given.open_orders)
    return {"purchase_orders": inventory.purchase_orders(alerts, given.run_date, given.plants)}


def _promotions(panel, report, given):
    uplift = promo.promo_uplift(panel)
    return {"promo_uplift": uplift, "promo_roi": promo.promo_roi(uplift), "ab_test": promo.ab_effect(panel, promo.ab_assignment(panel))}


def _anomalies(panel, report, given):
    scored = anomaly.isolation_forest(anomaly.series_zscore(panel))
    return {"anomaly_report": anomaly.anomaly_report(anomaly.combine_anomalies(scored))}


STEPS: dict[str, Callable[..., dict[str, DataFrame]]] = {
    "clustering": _clustering, "pricing": _pricing, "weather": _weather, "alerts": _alerts, "decomposition": _decomposition,
    "orders": _orders, "promotions": _promotions, "anomalies": _anomalies,
}


def net_open_orders(alerts: DataFrame, open_orders: DataFrame) -> DataFrame:
    """Alerts with the quantity already on order taken off; what is covered is not ordered again.

    ``open_orders`` has a row per store and product, as ``sources.erp.open_orders_by_item`` gives.
    """
    joined = alerts.join(open_orders.select("store_id", "product_id", "open_qty"), ["store_id", "product_id"], "left")
    left = F.greatest(F.col("recommended_order_qty") - F.coalesce("open_qty", F.lit(0)), F.lit(0)).cast("bigint")
    cost = round_half_even(F.col("recommended_order_qty") * F.col("base_price"), 2)
    return (joined.withColumn("recommended_order_qty", left).where("recommended_order_qty > 0")
            .withColumn("estimated_order_cost", cost).drop("open_qty"))


def run_extensions(panel: DataFrame, report: DataFrame, given: ExtensionInputs, root: str,
                   steps: Sequence[str] = tuple(STEPS)) -> ExtensionResults:
    """Run and write every analysis below ``root``; a failing one is recorded and the others go on.

    A step executes inside its own guard, so an error that shows only on rows is caught too. Its tables hold
    in one step after the last is written, so a failed one leaves the versions of the run before. The alert
    lines and the errors are written as text. ``panel`` should be a stage table, since every analysis reads
    it; ``steps`` names a part to run again.
    """
    results, store = ExtensionResults(), stages.StageStore(panel.sparkSession, root)
    for name in steps:
        try:
            with store.begin() as stage:
                written = {table: stage.write(table, df) for table, df in STEPS[name](panel, report, given).items()}
            results.tables |= written
            if name == "alerts":
                lines = written["alert_digest"].where("line IS NOT NULL").orderBy("position").select("line")
                stages.write_text_report(lines, f"{root}/alert_log")
        except Exception as error:  # one analysis must not stop the others
            results.errors[name] = str(error)
    if results.errors:
        said = [(f"{name}: {text.splitlines()[0] if text else 'failed'}",) for name, text in results.errors.items()]
        stages.write_text_report(panel.sparkSession.createDataFrame(said, "line string"), f"{root}/errors")
    return results
