"""SQL views shared by the twins of the registered queries."""

from __future__ import annotations

import math
import re

# Stand-ins for the lookup tables, on the categories and stores of the driver's data.
SENSITIVITY = {"CAT0": 0.8, "CAT1": -0.3, "CAT2": 0.2, "CAT3": 0.0}
CLIMATE = {"ASIA": (28.0, 5.0), "EUROPE": (25.0, 15.0), "AFRICA": (22.0, 4.0), "AMERICA": (26.0, 7.0)}


def he(expr: str, digits: int = 6) -> str:
    """Round half to even, as the Spark side does."""
    if digits == 0:
        return f"round_even(CAST({expr} AS DOUBLE), 0)"
    return f"(round_even(CAST({expr} AS DOUBLE) * 1e{digits}, 0) / 1e{digits})"


def values(mapping: dict) -> str:
    rows = []
    for key, value in mapping.items():
        parts = value if isinstance(value, tuple) else (value,)
        cells = [f"'{p}'" if isinstance(p, str) else f"CAST({p} AS DOUBLE)" for p in (key, *parts)]
        rows.append("(" + ", ".join(cells) + ")")
    return "(VALUES " + ", ".join(rows) + ")"


def money(column: str) -> str:
    """Sum of an amount, exact to eight decimals."""
    return f"CAST(sum(CAST({column} AS DECIMAL(28, 8))) AS DOUBLE)"


SERIES = "PARTITION BY store_id, product_id"
ITEM = "store_id, store_name, product_id, product_name, category"
SALES_COLUMNS = (
    "date, store_id, store_name, state, product_id, product_name, category, units_sold, unit_price, "
    "revenue, is_promotion, stockout_flag, lead_time_days, holding_cost_pct, base_price")
LAGS = [1, 2, 3, 4, 8, 12]
WINDOWS = [2, 4, 8, 12]


def lag_sql() -> str:
    return ", ".join(f"lag(units_sold, {k}) OVER s AS lag_{k}w" for k in LAGS)


def rolling_sql() -> str:
    parts = []
    for w in WINDOWS:
        frame = f"({SERIES} ORDER BY week_start ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)"
        parts += [f"avg(units_sold) OVER {frame} AS roll_mean_{w}w",
                  f"coalesce(stddev_samp(units_sold) OVER {frame}, 0) AS roll_std_{w}w",
                  f"max(units_sold) OVER {frame} AS roll_max_{w}w"]
    return ", ".join(parts)


PRICE = he("l_extendedprice * (1 - l_discount) / l_quantity", 2)

VIEWS = {
    "v_lines": f"""
        SELECT CAST(l_shipdate AS DATE) AS date,
          'S' || lpad(CAST(r_regionkey + 1 AS VARCHAR), 3, '0') AS store_id,
          r_name AS store_name, n_name AS state,
          'P' || lpad(CAST(bn AS VARCHAR), 3, '0') AS product_id, p_brand AS product_name,
          'CAT' || CAST(bn % 5 AS VARCHAR) AS category,
          CAST(l_quantity AS BIGINT) AS units_sold,
          {PRICE} AS unit_price, {he(f"CAST(l_quantity AS BIGINT) * {PRICE}", 2)} AS revenue,
          CASE WHEN l_discount >= 0.095 THEN 1 ELSE 0 END AS is_promotion,
          CASE WHEN (l_orderkey + l_linenumber) % 25 = 0 THEN 1 ELSE 0 END AS stockout_flag,
          CAST(2 + bn % 6 AS INT) AS lead_time_days,
          (15 + 5 * (bn % 4)) / 1e2 AS holding_cost_pct,
          CAST(20 + 10 * bn AS DOUBLE) AS base_price, l_orderkey, l_linenumber
        FROM (SELECT *, CAST(substr(p_brand, 7) AS INT) AS bn
              FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
              JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)""",
    "v_sales": "SELECT * EXCLUDE (l_orderkey, l_linenumber) FROM v_lines",
    "v_dirty": """
        SELECT * EXCLUDE (l_orderkey, l_linenumber) REPLACE (
            CASE WHEN l_orderkey % 17 = 0 THEN NULL WHEN l_orderkey % 19 = 0 THEN -units_sold
                 ELSE units_sold END AS units_sold)
        FROM (SELECT * FROM v_lines UNION ALL SELECT * FROM v_lines WHERE l_linenumber = 1)""",
    "v_clamped": """
        SELECT * REPLACE (CASE WHEN units_sold < 0 THEN 0 ELSE units_sold END AS units_sold,
            CASE WHEN revenue < 0 THEN 0 ELSE revenue END AS revenue,
            CASE WHEN unit_price < 0 THEN 0 ELSE unit_price END AS unit_price)
        FROM (SELECT DISTINCT * FROM v_dirty)""",
    "v_imputed": """
        SELECT * REPLACE (coalesce(CAST(units_sold AS DOUBLE),
                                   (SELECT median(units_sold) FROM v_clamped)) AS units_sold)
        FROM v_clamped""",
    "v_daily": """
        SELECT *, CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month,
          CAST(day(date) AS INT) AS day, CAST(isodow(date) - 1 AS INT) AS day_of_week,
          CAST(week(date) AS INT) AS week_number, CAST(quarter(date) AS INT) AS quarter,
          CAST(dayofyear(date) AS INT) AS day_of_year, strftime(date, '%b') AS month_name,
          CAST(day(date) = 1 AS INT) AS is_month_start, CAST(date = last_day(date) AS INT) AS is_month_end,
          CAST(month(date) IN (10, 11, 12) AS INT) AS is_festival_season,
          CAST(isodow(date) >= 6 AS INT) AS is_weekend
        FROM v_sales""",
    "v_weekly": f"""
        SELECT *, CAST(year(week_start) AS INT) AS year, CAST(month(week_start) AS INT) AS month,
          CAST(week(week_start) AS INT) AS week_num, CAST(quarter(week_start) AS INT) AS quarter,
          CASE WHEN promo_days > 0 THEN 1 ELSE 0 END AS is_promo_week
        FROM (SELECT {ITEM}, CAST(date_trunc('week', date) AS DATE) AS week_start,
                CAST(sum(units_sold) AS BIGINT) AS units_sold, {money("revenue")} AS revenue,
                {money("unit_price")} / count(unit_price) AS avg_price, CAST(sum(is_promotion) AS BIGINT) AS promo_days,
                CAST(sum(stockout_flag) AS BIGINT) AS stockout_days,
                max(lead_time_days) AS lead_time_days, max(holding_cost_pct) AS holding_cost_pct,
                max(base_price) AS base_price,
                max(CAST(month(date) IN (10, 11, 12) AS INT)) AS is_festival_season
              FROM v_sales GROUP BY {ITEM}, CAST(date_trunc('week', date) AS DATE))""",
    "v_full": f"""
        SELECT *, is_promo_week * is_festival_season AS promo_x_festival,
          avg_price * is_promo_week AS price_x_promo,
          roll_std_4w / (roll_mean_4w + 1e-6) AS demand_cv_4w
        FROM (SELECT *, {lag_sql()}, {rolling_sql()},
                sin({2 * math.pi!r} * month / 12) AS month_sin, cos({2 * math.pi!r} * month / 12) AS month_cos,
                sin({2 * math.pi!r} * week_num / 52) AS week_num_sin,
                cos({2 * math.pi!r} * week_num / 52) AS week_num_cos,
                {', '.join(f"CAST(category = 'CAT{i}' AS INT) AS cat_CAT{i}" for i in range(1, 5))}
              FROM v_weekly WINDOW s AS ({SERIES} ORDER BY week_start))""",
    "v_panel": "SELECT * FROM v_full WHERE lag_12w IS NOT NULL",
    "v_split": """
        SELECT *, coalesce(week_start <= (
            SELECT max(week_start) FROM (
              SELECT week_start, sum(n) OVER (ORDER BY week_start) / sum(n) OVER () AS part
              FROM (SELECT week_start, count(*) AS n FROM v_panel GROUP BY week_start)) WHERE part <= 0.8e0), FALSE) AS is_train
        FROM v_panel""",
    "v_stats": f"""
        SELECT {ITEM}, lead_time_days, holding_cost_pct, base_price,
          avg(units_sold) AS avg_weekly_demand, coalesce(stddev_samp(units_sold), 0) AS std_weekly_demand,
          count(units_sold) AS obs_weeks, avg(units_sold) * 52 AS annual_demand
        FROM v_panel GROUP BY {ITEM}, lead_time_days, holding_cost_pct, base_price""",
    "v_safety": f"""
        SELECT *, lead_time_days / 7 AS lead_time_weeks,
          {he("1.65 * std_weekly_demand * sqrt(lead_time_days / 7)", 1)} AS safety_stock
        FROM v_stats""",
    "v_point": f"""
        SELECT *, {he("avg_weekly_demand * lead_time_weeks + safety_stock", 1)} AS reorder_point
        FROM v_safety""",
    "v_policy": f"""
        SELECT *, base_price * holding_cost_pct AS holding_cost_per_unit,
          {he("coalesce(sqrt(2 * annual_demand * 100e0 / nullif(base_price * holding_cost_pct, 0)), 0)", 1)} AS EOQ
        FROM v_point""",
    "v_stocked": f"""
        SELECT *, CAST({he('''(reorder_point + EOQ / 2) * ((400 + 21 * ((CAST(substr(store_id, 2) AS BIGINT) * 31
              + CAST(substr(product_id, 2) AS BIGINT) * 17) % 100)) / 1e3)''', 0)} AS BIGINT) AS current_stock
        FROM v_policy""",
    "v_status": """
        SELECT *, CASE WHEN current_stock <= reorder_point THEN 'REORDER'
                       WHEN current_stock > reorder_point + 2 * EOQ THEN 'OVERSTOCK' ELSE 'OK' END AS inventory_status
        FROM v_stocked""",
    "v_naive": f"""
        SELECT {ITEM}, CAST(h AS INT) AS horizon_week, CAST(last_week + CAST(7 * h AS INT) AS DATE) AS week_start,
          CAST(greatest(0, {he("m", 0)}) AS BIGINT) AS predicted_units
        FROM (SELECT {ITEM}, max(week_start) AS last_week, avg(units_sold) AS m
              FROM (SELECT *, row_number() OVER ({SERIES} ORDER BY week_start DESC) AS back FROM v_panel)
              WHERE back <= 4 GROUP BY {ITEM}), range(1, 13) AS r(h)""",
    "v_report": """
        SELECT s.*, CAST(coalesce(f.total, 0) AS BIGINT) AS forecast_12w_demand
        FROM v_status s LEFT JOIN (SELECT store_id, product_id, sum(predicted_units) AS total FROM v_naive
                                   GROUP BY store_id, product_id) f USING (store_id, product_id)""",
    "v_alerts": f"""
        SELECT *, {he("recommended_order_qty * base_price", 2)} AS estimated_order_cost
        FROM (SELECT *, CAST(greatest({he("EOQ + reorder_point - current_stock", 0)}, 0) AS BIGINT)
                AS recommended_order_qty
              FROM v_report WHERE inventory_status = 'REORDER')""",
    "v_spine": """
        SELECT week_start, store_name, store_id
        FROM (SELECT DISTINCT week_start FROM v_panel), (SELECT DISTINCT store_name, store_id FROM v_panel)""",
    "v_climate": f"""
        SELECT week_start, store_name, store_id,
          {he(f'''coalesce(base_temp, 27) + coalesce(temp_amp, 8)
                * sin({2 * math.pi!r} * (dayofyear(week_start) - 80) / 365)''', 1)} AS temperature_c
        FROM v_spine LEFT JOIN {values(CLIMATE)} c(store_name, base_temp, temp_amp) USING (store_name)""",
    "v_weather": """
        SELECT week_start, store_name, temperature_c, rainfall_mm, CAST(rainfall_mm > 20 AS INT) AS is_rainy_week
        FROM (SELECT *, CAST((week(week_start) * 7 + CAST(substr(store_id, 2) AS BIGINT) * 13) % 40 AS DOUBLE)
                AS rainfall_mm FROM v_climate)
        WHERE week(week_start) % 10 <> 0""",
    "v_joined": """
        SELECT p.*, coalesce(w.temperature_c, 27) AS temperature_c, coalesce(w.rainfall_mm, 0) AS rainfall_mm,
          coalesce(w.is_rainy_week, 0) AS is_rainy_week
        FROM v_panel p LEFT JOIN v_weather w USING (week_start, store_name)""",
    "v_merged": f"""
        SELECT *, {he("units_sold * weather_multiplier", 1)} AS weather_adjusted_units
        FROM (SELECT j.*, coalesce(sensitivity, 0) AS sensitivity,
                1e0 + coalesce(sensitivity, 0) * (temperature_c - 27) / 10 AS weather_multiplier
              FROM v_joined j LEFT JOIN {values(SENSITIVITY)} x(category, sensitivity) USING (category))""",
    "v_uplift": f"""
        SELECT week_start, {ITEM}, {he("base", 1)} AS baseline_units, units_sold AS promo_units,
          {he("(units_sold - base) / (base + 1e-6) * 100", 2)} AS uplift_pct,
          {he("units_sold - base", 1)} AS incremental_units,
          {he("(units_sold - base) * avg_price", 2)} AS incremental_revenue
        FROM (SELECT p.*, avg(b.units_sold) AS base, count(b.units_sold) AS n
              FROM v_panel p JOIN (SELECT *, row_number() OVER ({SERIES} ORDER BY week_start) AS qn
                                   FROM v_panel WHERE is_promo_week = 0) b
                ON b.store_id = p.store_id AND b.product_id = p.product_id AND b.week_start < p.week_start
              JOIN (SELECT store_id, product_id, week_start AS pw,
                      sum(1 - is_promo_week) OVER ({SERIES} ORDER BY week_start) AS quiet FROM v_panel) q
                ON q.store_id = p.store_id AND q.product_id = p.product_id AND q.pw = p.week_start
              WHERE p.is_promo_week = 1 AND b.qn > q.quiet - 4
              GROUP BY ALL) WHERE n >= 2""",
    "v_logs": """
        SELECT *, ln(units_sold + 1) AS ln_quantity, ln(avg_price + 1) AS ln_price
        FROM v_panel WHERE units_sold > 0""",
    "v_slopes": """
        SELECT product_id, product_name, category, regr_slope(ln_quantity, ln_price) AS slope,
          regr_r2(ln_quantity, ln_price) AS r2
        FROM v_logs GROUP BY product_id, product_name, category HAVING count(*) >= 20""",
    "v_elasticity": f"""
        SELECT product_id, product_name, category, {he("slope", 4)} AS price_elasticity, {he("r2", 4)} AS r2_score,
          CASE WHEN slope < -1.5 THEN 'Lower price → Big demand boost (Highly elastic)'
               WHEN slope < -0.5 THEN 'Price reduction moderately increases demand'
               WHEN slope < 0 THEN 'Price-insensitive — maintain current pricing'
               ELSE 'Unusual — verify data or check for Giffen behavior' END AS interpretation
        FROM v_slopes""",
    "v_base": """
        SELECT e.*, b.avg_price, b.units_sold
        FROM v_elasticity e JOIN (SELECT product_id, avg(avg_price) AS avg_price, avg(units_sold) AS units_sold
                                  FROM v_panel GROUP BY product_id) b USING (product_id)""",
    "v_scenarios": f"""
        SELECT product_id, product_name, delta, {he("avg_price", 2)} AS base_price, {he("p1", 2)} AS test_price,
          printf('%+d%%', CAST({he("delta * 100", 0)} AS INT)) AS price_change_pct,
          {he("greatest(0e0, q1)", 1)} AS predicted_units, {he("greatest(0e0, p1 * q1)", 2)} AS predicted_revenue
        FROM (SELECT *, CASE WHEN avg_price > 0 THEN units_sold * pow(p1 / avg_price, price_elasticity)
                             ELSE units_sold END AS q1
              FROM (SELECT *, avg_price * (1 + delta) AS p1
                    FROM v_base, (SELECT unnest([-0.15e0, -0.1e0, -0.05e0, 0e0, 0.05e0, 0.1e0, 0.15e0]) AS delta)))""",
    "v_zscore": f"""
        SELECT *, (units_sold - avg(units_sold) OVER s) / (stddev_samp(units_sold) OVER s + 1e-6) AS z_score,
          coalesce(abs((units_sold - avg(units_sold) OVER s) / (stddev_samp(units_sold) OVER s + 1e-6)) > 3, false)
            AS anomaly_zscore
        FROM v_panel WINDOW s AS ({SERIES})""",
    "v_flagged": """
        SELECT *, anomaly_zscore AND anomaly_if AS anomaly_both, anomaly_zscore OR anomaly_if AS anomaly_any,
          CASE WHEN anomaly_zscore AND anomaly_if THEN 'HIGH CONFIDENCE' WHEN anomaly_zscore THEN 'Z-Score'
               WHEN anomaly_if THEN 'IsoForest' ELSE 'Normal' END AS anomaly_type,
          CASE WHEN (anomaly_zscore OR anomaly_if) AND z_score > 0 THEN 'Spike'
               WHEN (anomaly_zscore OR anomaly_if) AND z_score <= 0 THEN 'Drop' END AS anomaly_direction
        FROM (SELECT *, units_sold % 20 = 0 AS anomaly_if, -units_sold / 1e3 AS if_score FROM v_zscore)""",
    "v_anomalies": f"""
        SELECT week_start, store_name, product_name, category, units_sold,
          coalesce(roll_mean_4w, avg(units_sold) OVER ()) AS expected_units,
          {he("units_sold - coalesce(roll_mean_4w, avg(units_sold) OVER ())", 1)} AS deviation_units,
          anomaly_type, z_score, if_score
        FROM v_flagged WHERE anomaly_any""",
    "v_stores": """
        SELECT store_id, store_name, region, avg(units_sold) AS avg_weekly_demand,
          coalesce(stddev_samp(units_sold), 0) AS demand_std, avg(revenue) AS avg_revenue_per_week,
          avg(is_promo_week) AS promo_sensitivity, avg(stockout_days) AS stockout_rate,
          avg(demand_cv_4w) AS demand_cv, count(DISTINCT product_id) AS n_products
        FROM v_panel JOIN (VALUES ('S001', 'West'), ('S002', 'North'), ('S003', 'South'), ('S004', 'West'),
                                  ('S005', 'South')) r(store_id, region) USING (store_id)
        GROUP BY store_id, store_name, region""",
    "v_products": """
        SELECT product_id, product_name, category, avg(units_sold) AS avg_demand,
          coalesce(stddev_samp(units_sold), 0) AS demand_std, coalesce(avg(demand_cv_4w), 0) AS demand_cv,
          avg(is_promo_week) AS promo_lift, avg(stockout_days) AS stockout_rate, avg(revenue) AS avg_revenue
        FROM v_panel GROUP BY product_id, product_name, category""",
    "v_weeks": f"""
        SELECT {ITEM}, week_start, CAST(units_sold AS DOUBLE) AS units_sold,
          lead(week_start) OVER s AS next_t, lead(units_sold) OVER s AS next_v
        FROM v_panel WINDOW s AS ({SERIES} ORDER BY week_start)""",
    "v_filled": f"""
        SELECT {ITEM}, CAST(t AS DATE) AS week_start,
          CASE WHEN next_t IS NULL OR t = week_start THEN units_sold
               ELSE units_sold + (next_v - units_sold)
                    * (date_diff('day', week_start, CAST(t AS DATE)) / date_diff('day', week_start, next_t))
          END AS units_sold
        FROM (SELECT *, unnest(generate_series(CAST(week_start AS TIMESTAMP),
                CAST(coalesce(next_t - 7, week_start) AS TIMESTAMP), INTERVAL 7 DAY)) AS t FROM v_weeks)""",
    "v_components": f"""
        SELECT {ITEM}, week_start, idx, units_sold AS observed, trend, seasonal,
          units_sold - trend - seasonal AS residual
        FROM (SELECT *, avg(units_sold - trend) OVER ({SERIES}, idx % 52) AS seasonal
              FROM (SELECT *, CAST(row_number() OVER ({SERIES} ORDER BY week_start) - 1 AS INT) AS idx,
                      avg(units_sold) OVER ({SERIES} ORDER BY week_start ROWS BETWEEN 26 PRECEDING
                                            AND 26 FOLLOWING) AS trend,
                      count(*) OVER ({SERIES}) AS series_rows FROM v_filled) WHERE series_rows >= 104)""",
    "v_summary": f"""
        SELECT {ITEM}, {he("slope", 4)} AS trend_slope, {he("trend_strength", 4)} AS trend_strength,
          {he("seasonal_strength", 4)} AS seasonal_strength, {he("residual_std", 4)} AS residual_std,
          CASE WHEN slope > 0 THEN 'Growing' ELSE 'Declining' END AS growth_direction
        FROM (SELECT {ITEM}, regr_slope(trend, idx) AS slope,
                greatest(0, 1 - var_pop(residual) / (var_pop(trend + residual) + 1e-6)) AS trend_strength,
                greatest(0, 1 - var_pop(residual) / (var_pop(seasonal + residual) + 1e-6)) AS seasonal_strength,
                stddev_samp(residual) AS residual_std FROM v_components GROUP BY {ITEM})""",
}


def with_views(select: str) -> str:
    """Prefix a statement with the views it uses, in dependency order."""
    needed: list[str] = []

    def add(text: str) -> None:
        for name in re.findall(r"\bv_[a-z]+\b", text):
            if name not in needed:
                add(VIEWS[name])
                if name not in needed:
                    needed.append(name)

    add(select)
    views = ",\n".join(f"{n} AS MATERIALIZED ({VIEWS[n]})" for n in needed)
    own = re.match(r"\s*WITH\s+(RECURSIVE\s+)?", select)
    if not needed:
        return select
    if own:
        return f"WITH {own[1] or ''}{views},\n{select[own.end():]}"
    return f"WITH {views}\n{select}"
