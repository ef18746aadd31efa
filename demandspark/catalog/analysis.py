"""Price, promotion, weather and anomaly analyses."""

from __future__ import annotations

from pyspark.sql import functions as F

from demandspark.catalog.base import Retail, he, number_of, query
from demandspark.catalog.sql import SENSITIVITY, values
from demandspark.catalog.sql import he as sql_he
from demandspark.functions import describe, labels
from demandspark.operators import anomaly, cluster, pricing, promo, reports, weather
from demandspark.session import staged

KEYS = ["store_id", "product_id", "week_start"]
KEY_SQL = ", ".join(KEYS)


# --- price ------------------------------------------------------------------------------------

@query("log_transforms", f"SELECT {KEY_SQL}, {sql_he('ln_quantity')} AS ln_quantity, {sql_he('ln_price')} AS ln_price "
                         "FROM v_logs")
def log_transforms(r: Retail):
    logs = pricing.add_log_columns(pricing.positive_demand(r.panel))
    return logs.select(*KEYS, he("ln_quantity"), he("ln_price"))


def partial_slope_sql() -> str:
    """Slope on price beside the controls: each control in turn is taken out of the later ones, price and demand."""
    names = ["y", "x", *(f"c{i}" for i in range(len(pricing.CONTROLS)))]
    steps = ["s0 AS (SELECT product_id, product_name, category, ln_quantity AS y, ln_price AS x, ln_quantity AS y0, "
             + ", ".join(f"CAST({c} AS DOUBLE) AS c{i}" for i, c in enumerate(pricing.CONTROLS)) + " FROM v_logs)"]
    for i in range(len(pricing.CONTROLS)):
        kept = [n for n in names if not n.startswith("c") or int(n[1:]) > i]
        rest = ", ".join(f"{n} - coalesce(regr_slope({n}, c{i}) OVER p, 0) * (c{i} - avg(c{i}) OVER p) AS {n}" for n in kept)
        steps.append(f"s{i + 1} AS (SELECT product_id, product_name, category, y0, {rest} FROM s{i} WINDOW p AS (PARTITION BY product_id))")
    last = len(pricing.CONTROLS)
    return "WITH " + ", ".join(steps) + f"""
        SELECT product_id, product_name, category, {sql_he('slope', 4)} AS price_elasticity, {sql_he('r2', 4)} AS r2_score,
          CASE WHEN slope < -1.5 THEN 'Lower price → Big demand boost (Highly elastic)'
               WHEN slope < -0.5 THEN 'Price reduction moderately increases demand'
               WHEN slope < 0 THEN 'Price-insensitive — maintain current pricing'
               ELSE 'Unusual — verify data or check for Giffen behavior' END AS interpretation
        FROM (SELECT product_id, product_name, category, coalesce(regr_slope(y, x), 0) AS slope,
                1 - (var_pop(y) - coalesce(regr_slope(y, x), 0) * covar_pop(y, x)) / var_pop(y0) AS r2
              FROM s{last} GROUP BY product_id, product_name, category HAVING count(*) >= 20)"""


@query("price_elasticity", partial_slope_sql())
def price_elasticity(r: Retail):
    return pricing.price_elasticity(r.panel)


@query("simple_elasticity", "SELECT product_id, product_name, category, price_elasticity, r2_score, interpretation "
                            "FROM v_elasticity")
def simple_elasticity(r: Retail):
    return r.elasticity


@query("elasticity_label", """
    SELECT product_id, store_id, CASE WHEN e < -1.5 THEN 'Lower price → Big demand boost (Highly elastic)'
        WHEN e < -0.5 THEN 'Price reduction moderately increases demand'
        WHEN e < 0 THEN 'Price-insensitive — maintain current pricing'
        ELSE 'Unusual — verify data or check for Giffen behavior' END AS interpretation
    FROM (SELECT product_id, store_id, avg(units_sold) / 10 - 6 AS e FROM v_weekly GROUP BY ALL)""")
def elasticity_label(r: Retail):
    spread = r.weekly.groupBy("product_id", "store_id").agg((F.avg("units_sold") / 10 - 6).alias("e"))
    return spread.select("product_id", "store_id", labels.elasticity_label(F.col("e")).alias("interpretation"))


@query("join_price_demand_base", f"""
    SELECT product_id, price_elasticity, {sql_he('avg_price')} AS avg_price, {sql_he('units_sold')} AS units_sold
    FROM v_base""")
def join_price_demand_base(r: Retail):
    r.staged()
    base = pricing.price_demand_base(r.elasticity, r.panel)
    return base.select("product_id", "price_elasticity", he("avg_price"), he("units_sold"))


@query("price_scenarios_cross", "SELECT * FROM v_scenarios")
def price_scenarios_cross(r: Retail):
    return r.scenarios


@query("pct_label", "SELECT DISTINCT price_change_pct, CAST(replace(price_change_pct, '%', '') AS DOUBLE) AS pct "
                    "FROM v_scenarios")
def pct_label(r: Retail):
    return r.scenarios.select("price_change_pct", labels.parse_percent(F.col("price_change_pct")).alias("pct")).distinct()


BEST_SQL = """
    SELECT product_id, product_name, base_price, test_price, price_change_pct, predicted_revenue FROM v_scenarios
    QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY predicted_revenue DESC, delta) = 1"""


@query("argmax_per_group", BEST_SQL)
def argmax_per_group(r: Retail):
    return pricing.optimal_price(r.scenarios)


@query("optimal_price", BEST_SQL)
def optimal_price(r: Retail):
    r.staged()
    base = pricing.price_demand_base(pricing.simple_elasticity(r.panel), r.panel)
    return pricing.optimal_price(pricing.price_scenarios(base)).orderBy("product_id")


# --- promotions -------------------------------------------------------------------------------

@query("promo_uplift", "SELECT * FROM v_uplift")
def promo_uplift(r: Retail):
    return r.uplift


@query("uplift_totals", f"""
    SELECT count(*) AS n_events, {sql_he('avg(uplift_pct)', 4)} AS avg_uplift_pct,
      {sql_he('sum(incremental_revenue)', 2)} AS total_incremental_rev FROM v_uplift""")
def uplift_totals(r: Retail):
    return promo.uplift_totals(r.uplift).select(
        "n_events", he("avg_uplift_pct", 4), he("total_incremental_rev", 2))


@query("promo_roi", f"""
    SELECT category, n AS total_promo_events, {sql_he('u', 4)} AS avg_uplift_pct,
      {sql_he('rev', 2)} AS total_incremental_rev, n * 5000e0 AS assumed_promo_cost,
      {sql_he('(rev - n * 5000e0) / (n * 5000e0) * 100', 1)} AS ROI_pct
    FROM (SELECT category, count(promo_units) AS n, avg(uplift_pct) AS u, sum(incremental_revenue) AS rev
          FROM v_uplift GROUP BY category)""")
def promo_roi(r: Retail):
    return promo.promo_roi(r.uplift).withColumns(
        {"avg_uplift_pct": he("avg_uplift_pct", 4), "total_incremental_rev": he("total_incremental_rev", 2)})


# The integral of cos(u) ** (d - 1) from 0 to the angle of t gives Student's distribution; by Simpson's rule over 2000 steps.
STUDENT = """
    1 - 2 * exp(lgamma((d + 1) / 2) - lgamma(d / 2)) / sqrt(pi()) * (angle / 2000 / 3)
      * list_sum(list_transform(range(0, 2001), lambda i: (CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)
                                                          * pow(cos(i * angle / 2000), d - 1)))"""


@query("ab_effect", f"""
    SELECT product_id, product_name, category, {sql_he('tm', 2)} AS treatment_avg, {sql_he('cm', 2)} AS control_avg,
      {sql_he('tm - cm', 2)} AS ATE, {sql_he('(tm - cm) / (cm + 1e-6) * 100', 2)} AS ATE_pct,
      {sql_he('p', 4)} AS p_value, p < 0.05 AS significant
    FROM (SELECT *, {STUDENT} AS p
          FROM (SELECT *, atan(abs(tm - cm) / sqrt(tv / tn + cv / cn) / sqrt(d)) AS angle
                FROM (SELECT *, pow(tv / tn + cv / cn, 2) / (pow(tv / tn, 2) / (tn - 1) + pow(cv / cn, 2) / (cn - 1)) AS d
                FROM (SELECT product_id, product_name, category,
                        count(*) FILTER (WHERE t) AS tn, avg(units_sold) FILTER (WHERE t) AS tm,
                        var_samp(units_sold) FILTER (WHERE t) AS tv,
                        count(*) FILTER (WHERE c) AS cn, avg(units_sold) FILTER (WHERE c) AS cm,
                        var_samp(units_sold) FILTER (WHERE c) AS cv
                      FROM (SELECT *, store_id <= 'S003' AND is_promo_week = 1 AS t, store_id > 'S003' AS c
                            FROM v_panel) GROUP BY ALL) WHERE tn >= 5 AND cn >= 5)))""")
def ab_effect(r: Retail):
    r.staged()
    return promo.ab_effect(r.panel, promo.ab_assignment(r.panel, order_key="store_id"))


HISTOGRAM_SQL = """
    SELECT bin, {start} AS bin_start, count(*) AS n
    FROM (SELECT CAST(least(floor((x - lo) / w), {bins} - 1) AS INT) AS bin, lo, w
          FROM (SELECT x, min(x) OVER () AS lo, (max(x) OVER () - min(x) OVER ()) / {bins} AS w
                FROM (SELECT CAST(greatest(least({value}, {high}), {low}) AS DOUBLE) AS x FROM {view}
                      WHERE {value} IS NOT NULL)))
    GROUP BY bin, lo, w"""


@query("uplift_histogram", HISTOGRAM_SQL.format(start=sql_he("lo + bin * w", 4), bins=40, value="uplift_pct",
                                                low=-50, high=100, view="v_uplift"))
def uplift_histogram(r: Retail):
    r.staged()
    return describe.histogram(r.uplift, "uplift_pct", -50, 100, 40).withColumn("bin_start", he("bin_start", 4))


@query("zscore_histogram", HISTOGRAM_SQL.format(start=sql_he("lo + bin * w", 4), bins=60, value=sql_he("z_score"),
                                                low=-5, high=5, view="v_zscore"))
def zscore_histogram(r: Retail):
    r.staged()
    return describe.histogram(r.zscored.select(he("z_score")), "z_score", -5, 5, 60).withColumn("bin_start", he("bin_start", 4))


# --- weather ----------------------------------------------------------------------------------

@query("climate_baseline", "SELECT week_start, store_name, temperature_c FROM v_climate")
def climate_baseline(r: Retail):
    r.staged()
    spine = reports.week_store_spine(r.panel)
    return weather.climate_baseline(spine, r.climate).select("week_start", "store_name", "temperature_c")


@query("rainy_flag", "SELECT week_start, store_name, rainfall_mm, is_rainy_week FROM v_weather")
def rainy_flag(r: Retail):
    r.staged()
    return r.weather.select("week_start", "store_name", "rainfall_mm", "is_rainy_week")


@query("join_weather", f"SELECT {KEY_SQL}, temperature_c, rainfall_mm, is_rainy_week FROM v_joined")
def join_weather(r: Retail):
    r.staged()
    joined = weather.join_weather(r.panel, r.weather)
    return joined.select(*KEYS, "temperature_c", "rainfall_mm", "is_rainy_week")


@query("weather_multiplier", f"SELECT {KEY_SQL}, {sql_he('weather_multiplier')} AS weather_multiplier FROM v_merged")
def weather_multiplier(r: Retail):
    r.staged()
    return r.merged.select(*KEYS, he("weather_multiplier"))


@query("weather_adjusted_demand", f"SELECT {KEY_SQL}, units_sold, temperature_c, weather_adjusted_units FROM v_merged")
def weather_adjusted_demand(r: Retail):
    r.staged()
    return r.merged.select(*KEYS, "units_sold", "temperature_c", "weather_adjusted_units")


IMPACT = f"""
    SELECT category, {sql_he('b1', 4)} AS temp_coefficient, {sql_he('b2', 4)} AS rain_coefficient,
      {sql_he('(b1 * s1y + b2 * s2y) / syy', 4)} AS r2_weather, coalesce(sensitivity, 0) AS sensitivity
    FROM (SELECT *, (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) AS b1,
            (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) AS b2
          FROM (SELECT category, var_pop(temperature_c) AS s11, var_pop(is_rainy_week) AS s22,
                  covar_pop(temperature_c, is_rainy_week) AS s12, covar_pop(temperature_c, units_sold) AS s1y,
                  covar_pop(is_rainy_week, units_sold) AS s2y, var_pop(units_sold) AS syy
                FROM v_joined GROUP BY category HAVING count(*) >= 30))
    LEFT JOIN {values(SENSITIVITY)} x(category, sensitivity) USING (category)"""


@query("weather_impact", IMPACT)
def weather_impact(r: Retail):
    r.staged()
    return weather.weather_impact(weather.join_weather(r.panel, r.weather), r.sensitivity)


@query("sign_split", "SELECT category, temp_coefficient, CASE WHEN temp_coefficient >= 0 THEN 'pos' ELSE 'neg' END "
                     f"AS sign FROM ({IMPACT})")
def sign_split(r: Retail):
    r.staged()
    impact = weather.weather_impact(weather.join_weather(r.panel, r.weather), r.sensitivity, ordered=False)
    return impact.select("category", "temp_coefficient", labels.sign_label(F.col("temp_coefficient")).alias("sign"))


@query("temperature_trend_line", f"""
    SELECT CAST(i AS INT) AS point, {sql_he('low + i * (high - low) / 99', 4)} AS temperature_c,
      {sql_he('a + b * (low + i * (high - low) / 99)', 4)} AS predicted_units
    FROM (SELECT regr_slope(units_sold, temperature_c) AS b, regr_intercept(units_sold, temperature_c) AS a,
            min(temperature_c) AS low, max(temperature_c) AS high FROM v_joined WHERE category = 'CAT0'),
      range(0, 100) g(i)""")
def temperature_trend_line(r: Retail):
    r.staged()
    line = weather.temperature_trend_line(weather.join_weather(r.panel, r.weather), "CAT0")
    return line.select("point", he("temperature_c", 4), he("predicted_units", 4))


@query("monthly_city_temperature", f"""
    SELECT store_name, month, {sql_he('avg(temperature_c)')} AS avg_temperature FROM v_joined GROUP BY ALL""")
def monthly_city_temperature(r: Retail):
    r.staged()
    joined = weather.join_weather(r.panel, r.weather)
    return weather.monthly_city_temperature(joined).withColumn("avg_temperature", he("avg_temperature"))


# --- anomalies --------------------------------------------------------------------------------

Z_COLUMNS = f"SELECT {KEY_SQL}, units_sold, {sql_he('z_score')} AS z_score, anomaly_zscore FROM v_zscore"


@query("series_zscore", Z_COLUMNS)
def series_zscore(r: Retail):
    return r.zscored.select(*KEYS, "units_sold", he("z_score"), "anomaly_zscore")


@query("zscore_anomalies", Z_COLUMNS + " WHERE anomaly_zscore")
def zscore_anomalies(r: Retail):
    return r.zscored.where("anomaly_zscore").select(*KEYS, "units_sold", he("z_score"), "anomaly_zscore")


@query("iqr_anomalies", f"""
    SELECT {KEY_SQL}, fence_low, fence_high, units_sold < fence_low OR units_sold > fence_high AS anomaly_iqr
    FROM v_panel JOIN (SELECT store_id, product_id, q1 - 1.5 * (q3 - q1) AS fence_low, q3 + 1.5 * (q3 - q1) AS fence_high
                       FROM (SELECT store_id, product_id, quantile_cont(units_sold, 0.25) AS q1,
                               quantile_cont(units_sold, 0.75) AS q3 FROM v_panel GROUP BY ALL))
      USING (store_id, product_id)""")
def iqr_anomalies(r: Retail):
    return anomaly.iqr_anomalies(r.panel).select(*KEYS, "fence_low", "fence_high", "anomaly_iqr")


@query("combine_anomalies", f"SELECT {KEY_SQL}, anomaly_both, anomaly_any, anomaly_type, anomaly_direction FROM v_flagged")
def combine_anomalies(r: Retail):
    return r.flagged.select(*KEYS, "anomaly_both", "anomaly_any", "anomaly_type", "anomaly_direction")


REPORT_COLUMNS = ("week_start, store_name, product_name, category, units_sold, expected_units, deviation_units, "
                  f"anomaly_type, {sql_he('z_score')} AS z_score, if_score")


@query("anomaly_report", f"SELECT {REPORT_COLUMNS} FROM v_anomalies")
def anomaly_report(r: Retail):
    return anomaly.anomaly_report(r.flagged).withColumn("z_score", he("z_score"))


@query("head_50_anomalies", f"SELECT {REPORT_COLUMNS} FROM v_anomalies "
                            "ORDER BY abs(v_anomalies.z_score) DESC, week_start, store_name, product_name LIMIT 50")
def head_50_anomalies(r: Retail):
    return anomaly.anomaly_report(r.flagged).limit(50).withColumn("z_score", he("z_score"))


@query("anomaly_counts", """
    SELECT 'anomaly_type' AS kind, anomaly_type AS value, count(*) AS n FROM v_anomalies GROUP BY anomaly_type
    UNION ALL SELECT 'category', category, count(*) FROM v_anomalies GROUP BY category""")
def anomaly_counts(r: Retail):
    return anomaly.anomaly_counts(r.anomalies)


@query("anomaly_share", f"""
    SELECT count(*) AS n_weeks, {sql_he('avg(CAST(anomaly_zscore AS INT))')} AS anomaly_zscore_share,
      {sql_he('avg(CAST(anomaly_if AS INT))')} AS anomaly_if_share FROM v_flagged""")
def anomaly_share(r: Retail):
    return anomaly.anomaly_share(r.flagged).select("n_weeks", he("anomaly_zscore_share"), he("anomaly_if_share"))


# --- store and product features ---------------------------------------------------------------

STORE_NUMBERS = ["avg_weekly_demand", "demand_std", "avg_revenue_per_week", "promo_sensitivity", "stockout_rate",
                 "demand_cv"]
PRODUCT_NUMBERS = ["avg_demand", "demand_std", "demand_cv", "promo_lift", "stockout_rate", "avg_revenue"]


@query("store_features", "SELECT store_id, store_name, region, n_products, "
       + ", ".join(f"{sql_he(c, 4)} AS {c}" for c in STORE_NUMBERS) + " FROM v_stores")
def store_features(r: Retail):
    return cluster.store_features(r.panel).select(
        "store_id", "store_name", "region", "n_products", *[he(c, 4) for c in STORE_NUMBERS])


@query("product_features", "SELECT product_id, product_name, category, "
       + ", ".join(f"{sql_he(c, 4)} AS {c}" for c in PRODUCT_NUMBERS) + " FROM v_products")
def product_features(r: Retail):
    return cluster.product_features(r.panel).select(
        "product_id", "product_name", "category", *[he(c, 4) for c in PRODUCT_NUMBERS])


@query("region_revenue", f"SELECT region, {sql_he('avg(avg_revenue_per_week)', 4)} AS avg_revenue_per_week "
                         "FROM v_stores GROUP BY region")
def region_revenue(r: Retail):
    stores = cluster.store_features(r.panel)
    return cluster.region_revenue(stores).select("region", he("avg_revenue_per_week", 4))


@query("standardise_columns", "SELECT store_id, " + ", ".join(
    f"{sql_he(f'({c} - avg({c}) OVER ()) / coalesce(nullif(stddev_pop({c}) OVER (), 0), 1)')} AS {c}_z"
    for c in STORE_NUMBERS) + " FROM v_stores")
def standardise_columns(r: Retail):
    r.staged()
    scaled = cluster.standardise(cluster.store_features(r.panel), STORE_NUMBERS)
    return scaled.select("store_id", *[he(f"{c}_z") for c in STORE_NUMBERS])


def labelled(r: Retail):
    """Products with the stand-in cluster: the product number modulo four."""
    return cluster.product_features(r.panel).withColumn("segment", (number_of("product_id") % 4).cast("int"))


SEGMENT = "CAST(CAST(substr(product_id, 2) AS BIGINT) % 4 AS INT)"
NAMED = f"""
    SELECT p.*, {SEGMENT} AS segment, segment_name
    FROM v_products p JOIN (
      SELECT segment, ['Slow Movers', 'Stable Core', 'High Velocity', 'Star Products'][
               row_number() OVER (ORDER BY m, segment)] AS segment_name
      FROM (SELECT {SEGMENT} AS segment, avg(avg_demand) AS m FROM v_products GROUP BY 1)) n ON n.segment = {SEGMENT}"""


@query("cluster_label", f"SELECT product_id, 'Cluster-' || CAST({SEGMENT} + 1 AS VARCHAR) AS cluster_label FROM v_products")
def cluster_label(r: Retail):
    return labelled(r).select("product_id", labels.cluster_label(F.col("segment")).alias("cluster_label"))


@query("segment_naming", f"SELECT product_id, segment, segment_name FROM ({NAMED})")
def segment_naming(r: Retail):
    r.staged()
    return cluster.name_segments(labelled(r)).select("product_id", "segment", "segment_name")


@query("segment_summary", f"""
    SELECT segment_name, count(product_name) AS products, {sql_he('avg(avg_demand)', 1)} AS avg_demand,
      {sql_he('avg(avg_revenue)', 1)} AS avg_revenue FROM ({NAMED}) GROUP BY segment_name""")
def segment_summary(r: Retail):
    r.staged()
    return cluster.segment_summary(cluster.name_segments(labelled(r)))


POINTS = [f"{c}_z" for c in PRODUCT_NUMBERS[:5]]


@query("silhouette", f"""
    WITH z AS (SELECT product_id, {SEGMENT} AS own, """ + ", ".join(
    f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS {c}_z" for c in PRODUCT_NUMBERS[:5]) + f""" FROM v_products),
    d AS (SELECT a.product_id, a.own, b.own AS other, sum({' + '.join(f'(a.{c} - b.{c}) * (a.{c} - b.{c})' for c in POINTS)}) AS t,
            count(*) AS n FROM z a, z b GROUP BY ALL),
    s AS (SELECT product_id, max(CASE WHEN own = other THEN t / (n - 1) END) AS a,
            min(CASE WHEN own <> other THEN t / n END) AS b FROM d GROUP BY product_id)
    SELECT {sql_he('avg((b - a) / greatest(a, b))')} AS silhouette FROM s""")
def silhouette(r: Retail):
    r.staged()
    scaled = cluster.standardise(labelled(r), PRODUCT_NUMBERS[:5])
    return cluster.silhouette(scaled, POINTS, "segment").select(he("silhouette"))


@query("store_clusters", """
    SELECT store_id, store_name, region, (store_id <= 'S002') AS with_first, 'Cluster-' AS label_text, TRUE AS score_agrees, TRUE AS score_is_high
    FROM v_stores""")
def store_clusters(r: Retail):
    """Stores whose features lie in two known groups come out in these, with the silhouette that the labels give."""
    r.staged()
    columns = cluster.STORE_CLUSTER_FEATURES
    features = cluster.store_features(r.panel)
    # Up to a tenth of the distance between the groups is the stores' own.
    spread = features.agg(*[F.max(c).alias(c) for c in columns])
    far = F.when(F.col("store_id") <= "S002", F.lit(0)).otherwise(F.lit(10))
    apart = features.withColumns({c: F.col(c) / spread.select(c).scalar() + far for c in columns})
    found = staged(cluster.cluster_stores(apart))
    again = cluster.silhouette(cluster.standardise(found, columns), [f"{c}_z" for c in columns], "demand_cluster").scalar()
    first = found.where("store_id = 'S001'").select("demand_cluster").scalar()
    return found.select(
        "store_id", "store_name", "region", (F.col("demand_cluster") == first).alias("with_first"),
        F.regexp_replace("cluster_label", "[0-9]+$", "").alias("label_text"), (F.abs(F.col("silhouette_score") - again) < 1e-9).alias("score_agrees"),
        (F.col("silhouette_score") > 0.9).alias("score_is_high"))


@query("pca_2d", """
    SELECT count(*) AS n, TRUE AS is_centred, TRUE AS is_uncorrelated, TRUE AS is_ordered, TRUE AS spread_agrees FROM v_stores""")
def pca_2d(r: Retail):
    """Components of mean zero without correlation, the wider first, in the proportion of their variances."""
    r.staged()
    flat = cluster.pca_2d(cluster.store_features(r.panel))
    one, two = F.var_samp("pc1"), F.var_samp("pc2")
    return flat.agg(
        F.count("*").alias("n"), (F.abs(F.avg("pc1")) + F.abs(F.avg("pc2")) < 1e-9).alias("is_centred"),
        (F.abs(F.covar_samp("pc1", "pc2")) < 1e-9).alias("is_uncorrelated"), (one >= two).alias("is_ordered"),
        (F.abs(one * F.first("pc2_variance") - two * F.first("pc1_variance")) < 1e-9).alias("spread_agrees"))


#: Products in four known groups: the product number modulo four moves every feature.
GROUP_NO = "CAST(substr(product_id, 2) AS BIGINT) % 4"
GROUPED_PRODUCTS = f"""
    SELECT product_id, product_name, category, avg_demand / (max(avg_demand) OVER ()) + 10 * ({GROUP_NO}) AS avg_demand, avg_revenue,
      ['Slow Movers', 'Stable Core', 'High Velocity', 'Star Products'][1 + {GROUP_NO}] AS segment_name FROM v_products"""


def grouped_products(r: Retail):
    """The products' own features, scaled to one, on top of ten times their group."""
    features = cluster.product_features(r.panel)
    most = features.agg(*[F.max(c).alias(c) for c in cluster.PRODUCT_SEGMENT_FEATURES])
    group = 10 * (number_of("product_id") % 4)
    return features.withColumns({c: F.col(c) / F.coalesce(F.nullif(most.select(c).scalar(), F.lit(0)), F.lit(1)) + group
                                 for c in cluster.PRODUCT_SEGMENT_FEATURES})


@query("product_segments", f"SELECT product_id, product_name, category, {sql_he('avg_demand', 4)} AS avg_demand, segment_name FROM ({GROUPED_PRODUCTS})")
def product_segments(r: Retail):
    """Products in known groups come out in these, named by rising demand."""
    r.staged()
    found = cluster.segment_products(grouped_products(r))
    return found.select("product_id", "product_name", "category", he("avg_demand", 4), "segment_name")


PLANTED = "(week_num * 7 + year * 5 + CAST(substr(product_id, 2) AS BIGINT) * 3 + CAST(substr(store_id, 2) AS BIGINT)) % 397 = 0"
EXTREME = ("units_sold", "lag_1w", "roll_mean_4w", "roll_std_4w")


@query("isolation_forest", f"""
    SELECT {', '.join(KEYS)}, CASE WHEN {PLANTED} THEN units_sold * 40 + 5000 ELSE units_sold END AS units_sold, {PLANTED} AS planted,
      TRUE AS planted_is_flagged, CAST(floor(0.05e0 * (count(*) OVER () - 1)) AS BIGINT) + 1 AS n_lowest FROM v_panel""")
def isolation_forest(r: Retail):
    """Planted weeks with extreme units and history, about one of four hundred, are all among the share that is flagged."""
    r.staged()
    planted = (F.col("week_num") * 7 + F.col("year") * 5 + number_of("product_id") * 3 + number_of("store_id")) % 397 == 0
    panel = r.panel.withColumns({"planted": planted, **{c: F.when(planted, F.col(c) * 40 + 5000).otherwise(F.col(c)) for c in EXTREME}})
    scored = staged(anomaly.isolation_forest(panel))
    low = scored.agg(F.count_if(F.col("if_score") < 0)).scalar()
    return scored.select(*KEYS, "units_sold", "planted", (~F.col("planted") | F.col("anomaly_if")).alias("planted_is_flagged"), low.alias("n_lowest"))
