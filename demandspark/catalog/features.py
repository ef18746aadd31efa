"""Weekly roll-up, window features and series lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from demandspark.catalog.base import CATEGORIES, Retail, he, query
from demandspark.catalog.sql import ITEM, LAGS, SERIES, WINDOWS, lag_sql
from demandspark.catalog.sql import he as sql_he
from demandspark.constants import WEEKLY_INPUTS
from demandspark.functions import calendar
from demandspark.operators import features, models, reports
from demandspark.session import staged

KEYS = ["store_id", "product_id", "week_start"]
CYCLIC = ["month_sin", "month_cos", "week_num_sin", "week_num_cos"]
WEEKLY = ("store_id, store_name, product_id, product_name, category, week_start, units_sold, promo_days, "
          "stockout_days, lead_time_days, holding_cost_pct, base_price, is_festival_season, year, month, week_num, "
          "quarter, is_promo_week")


@query("weekly_rollup", f"SELECT {WEEKLY}, {sql_he('revenue', 2)} AS revenue, {sql_he('avg_price')} AS avg_price "
                        "FROM v_weekly")
def weekly_rollup(r: Retail):
    return r.weekly.select(*WEEKLY.split(", "), he("revenue", 2), he("avg_price"))


@query("lag_features", f"SELECT {', '.join(KEYS)}, units_sold, {lag_sql()} FROM v_weekly "
                       f"WINDOW s AS ({SERIES} ORDER BY week_start)")
def lag_features(r: Retail):
    return features.add_lag_features(r.weekly.select(*KEYS, "units_sold"))


def rolling(stat: str):
    names = [f"roll_{stat}_{w}w" for w in WINDOWS]
    picked = [n if stat == "max" else f"{sql_he(n)} AS {n}" for n in names]

    @query(f"rolling_{stat}", f"SELECT {', '.join(KEYS)}, {', '.join(picked)} FROM v_full")
    def run(r: Retail):
        df = features.add_rolling_features(r.weekly.select(*KEYS, "units_sold"))
        return df.select(*KEYS, *[n if stat == "max" else he(n) for n in names])


for _stat in ("mean", "std", "max"):
    rolling(_stat)


@query("cyclic_encoding", "SELECT month, week_num, " + ", ".join(
    f"{sql_he(f'any_value({c})')} AS {c}" for c in CYCLIC) + " FROM v_full GROUP BY month, week_num")
def cyclic_encoding(r: Retail):
    # The encoding depends on month and week only, so distinct pairs are encoded.
    pairs = r.weekly.select("month", "week_num").distinct()
    return calendar.add_cyclic_features(pairs).select("month", "week_num", *[he(c) for c in CYCLIC])


ONEHOT = [f"cat_{c}" for c in CATEGORIES[1:]]


@query("category_onehot", f"SELECT product_id, category, {', '.join(ONEHOT)} FROM v_full GROUP BY ALL")
def category_onehot(r: Retail):
    products = r.weekly.select("product_id", "category").distinct()
    return features.add_category_onehot(products, features.category_domain(products))


@query("category_onehot_wide", f"""
    SELECT category, CAST(count(*) OVER () AS BIGINT) AS n_values, CASE WHEN rank > 1 THEN CAST(rank - 2 AS INT) END AS slot, n_rows,
      {sql_he('mean_units')} AS mean_units, TRUE AS predicts_mean
    FROM (SELECT category, row_number() OVER (ORDER BY category) AS rank, n_rows, mean_units
          FROM (SELECT 'P' || l_partkey AS category, count(*) AS n_rows, avg(l_quantity) AS mean_units FROM lineitem GROUP BY 1))""")
def category_onehot_wide(r: Retail):
    """Every part as a category, beyond any number of columns: least squares on the sparse vectors gives each its mean."""
    lines = staged(r.spark.read.parquet(f"{r.sf_dir}/lineitem.parquet").select(
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("category"), F.col("l_quantity").cast("double").alias("units_sold")))
    domain = features.category_table(lines)
    n = domain.count()
    rows = features.add_category_vector(features.add_category_index(lines, domain), n)
    fitted = models.linear_regression([features.CATEGORY_VECTOR]).fit(rows)
    scored = fitted.transform(rows).withColumn("at", F.col(features.CATEGORY_INDEX).cast("int"))
    mean = F.avg("units_sold")
    return scored.groupBy("category").agg(
        F.lit(n).cast("bigint").alias("n_values"), F.when(F.max("at") < n - 1, F.max("at")).alias("slot"), F.count("*").alias("n_rows"),
        he(mean).alias("mean_units"), ((F.abs(F.max("prediction") - mean) < 1e-3) & (F.abs(F.min("prediction") - mean) < 1e-3)).alias("predicts_mean"))


@query("column_concat_dummies", f"SELECT {WEEKLY}, {', '.join(ONEHOT)} FROM v_full")
def column_concat_dummies(r: Retail):
    return features.add_category_onehot(r.weekly.select(*WEEKLY.split(", ")), CATEGORIES)


@query("interaction_features", f"SELECT {', '.join(KEYS)}, promo_x_festival, {sql_he('price_x_promo')} AS price_x_promo, "
                               f"{sql_he('demand_cv_4w')} AS demand_cv_4w FROM v_full")
def interaction_features(r: Retail):
    return r.panel_full.select(*KEYS, "promo_x_festival", he("price_x_promo"), he("demand_cv_4w"))


@query("drop_warmup_rows", f"SELECT {', '.join(KEYS)}, units_sold, "
                           f"{', '.join(f'lag_{k}w' for k in LAGS)} FROM v_panel")
def drop_warmup_rows(r: Retail):
    return features.drop_warmup(r.panel_full).select(*KEYS, "units_sold", *[f"lag_{k}w" for k in LAGS])


FEATURES = [*(f"lag_{k}w" for k in LAGS), *(f"roll_{s}_{w}w" for w in WINDOWS for s in ("mean", "std", "max")), *CYCLIC,
            "promo_x_festival", "price_x_promo", "demand_cv_4w", *WEEKLY_INPUTS, *ONEHOT]


@query("feature_projection", f"SELECT {', '.join(KEYS)}, "
                             + ", ".join(f"{sql_he(c)} AS {c}" for c in FEATURES) + " FROM v_panel")
def feature_projection(r: Retail):
    columns = features.feature_columns(r.panel)
    return r.panel.select(*KEYS, *[he(F.col(c).cast("double")).alias(c) for c in columns])


@query("positive_demand", f"SELECT {', '.join(KEYS)}, units_sold FROM v_panel WHERE units_sold > 0")
def positive_demand(r: Retail):
    from demandspark.operators.pricing import positive_demand as keep
    return keep(r.panel).select(*KEYS, "units_sold")


@query("min_group_size", """
    SELECT product_id, count(*) AS n FROM v_panel WHERE is_promo_week = 1 GROUP BY product_id HAVING count(*) >= 20""")
def min_group_size(r: Retail):
    counts = r.panel.where("is_promo_week = 1").groupBy("product_id").agg(F.count("*").alias("n"))
    return counts.where("n >= 20")


@query("first_last_of_series", f"""
    SELECT {ITEM}, min(week_start) AS first_week, max(week_start) AS last_week,
      {sql_he('arg_max(avg_price, week_start)')} AS avg_price, arg_max(units_sold, week_start) AS units_sold
    FROM v_panel GROUP BY {ITEM}""")
def first_last_of_series(r: Retail):
    last = reports.last_of_series(r.panel, carried=["store_name", "product_name", "category", "avg_price", "units_sold"])
    return last.select(*ITEM.split(", "), "first_week", "last_week", he("avg_price"), "units_sold")


@query("tail_52_weeks", f"""
    SELECT store_id, product_id, week_start, units_sold FROM v_panel
    JOIN (SELECT store_id, product_id FROM v_panel GROUP BY ALL
          ORDER BY avg(units_sold) DESC, store_id, product_id LIMIT 1) USING (store_id, product_id)
    ORDER BY week_start DESC LIMIT 52""")
def tail_52_weeks(r: Retail):
    r.staged()
    return reports.tail_weeks(r.panel)


@query("row_index", f"SELECT {', '.join(KEYS)}, CAST(row_number() OVER ({SERIES} ORDER BY week_start) - 1 AS INT) "
                    "AS idx FROM v_panel")
def row_index(r: Retail):
    from demandspark.operators.decompose import row_index as number
    return number(r.panel.select(*KEYS))


@query("future_calendar_cross", f"""
    SELECT store_id, product_id, CAST(h AS INT) AS horizon_week,
      CAST(max(week_start) + CAST(7 * h AS INT) AS DATE) AS week_start
    FROM v_panel, range(1, 13) r(h) GROUP BY store_id, product_id, h""")
def future_calendar_cross(r: Retail):
    last = reports.last_of_series(r.panel, carried=["category"])
    return reports.future_calendar(last).select("store_id", "product_id", "horizon_week", "week_start")


@query("week_store_spine", "SELECT week_start, store_name FROM v_spine")
def week_store_spine(r: Retail):
    r.staged()
    return reports.week_store_spine(r.panel)


@query("train_test_split_80", f"""
    SELECT {', '.join(KEYS)}, row_number() OVER (ORDER BY store_id, product_id, week_start) - 1
      < floor((SELECT count(*) FROM v_panel) * 0.8e0) AS is_train FROM v_panel""")
def train_test_split_80(r: Retail):
    r.staged()
    return models.split_positional(r.panel.select(*KEYS))


@query("train_test_split_by_week", f"""
    SELECT {', '.join(KEYS)}, week_start <= (
      SELECT max(week_start) FROM (SELECT week_start, sum(count(*)) OVER (ORDER BY week_start)
                                     / sum(count(*)) OVER () AS part FROM v_panel GROUP BY week_start)
      WHERE part <= 0.8e0) AS is_train FROM v_panel""")
def train_test_split_by_week(r: Retail):
    r.staged()
    return models.split_by_week(r.panel.select(*KEYS))


@query("expanding_cv_splits", f"""
    SELECT {', '.join(KEYS)}, CAST(CASE WHEN rank < total - 5 * size THEN 0
                                   ELSE (rank - (total - 5 * size)) // size + 1 END AS INT) AS fold
    FROM v_panel JOIN (SELECT *, total // 6 AS size
                       FROM (SELECT week_start, row_number() OVER (ORDER BY week_start) - 1 AS rank,
                               count(*) OVER () AS total FROM (SELECT DISTINCT week_start FROM v_panel)))
      USING (week_start)""")
def expanding_cv_splits(r: Retail):
    r.staged()
    return models.expanding_folds(r.panel.select(*KEYS))
