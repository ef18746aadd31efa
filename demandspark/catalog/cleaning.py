"""Scans, cleaning, calendar columns and the data quality report."""

from __future__ import annotations

from pyspark.sql import functions as F

from demandspark.catalog.base import Retail, he, query
from demandspark.catalog.sql import SALES_COLUMNS
from demandspark.catalog.sql import he as sql_he
from demandspark.functions import calendar, labels, numeric
from demandspark.operators import cleaning, quality
from demandspark.session import staged

DQ_COLUMNS = SALES_COLUMNS.split(", ")


@query("scan_daily_sales", f"SELECT {SALES_COLUMNS} FROM v_sales")
def scan_daily_sales(r: Retail):
    return r.sales.select(*DQ_COLUMNS)


@query("dedupe_exact", "SELECT DISTINCT * FROM v_dirty")
def dedupe_exact(r: Retail):
    return cleaning.dedupe_exact(r.dirty)


@query("clamp_negative", "SELECT * FROM v_clamped")
def clamp_negative(r: Retail):
    return r.clamped


@query("median_impute", "SELECT * FROM v_imputed")
def median_impute(r: Retail):
    return cleaning.median_impute(staged(r.clamped))


@query("cast_flags", "SELECT date, is_promotion, stockout_flag, CAST(isodow(date) >= 6 AS INT) AS is_weekend "
                     "FROM v_sales")
def cast_flags(r: Retail):
    raw = r.sales.select(F.col("date").cast("string").alias("date"), F.col("is_promotion").cast("double"),
                         F.col("stockout_flag").cast("boolean"),
                         (F.weekday("date") >= 5).alias("is_weekend"))
    return cleaning.cast_flags(raw)


@query("recompute_revenue",
       f"SELECT * REPLACE ({sql_he('units_sold * unit_price', 2)} AS revenue) FROM v_imputed")
def recompute_revenue(r: Retail):
    return cleaning.clean_daily(r.dirty)


@query("time_features", "SELECT * FROM v_daily")
def time_features(r: Retail):
    return r.daily


@query("weekend_flag", "SELECT is_weekend, count(*) AS n, CAST(sum(units_sold) AS BIGINT) AS units_sold "
                       "FROM v_daily GROUP BY is_weekend")
def weekend_flag(r: Retail):
    flagged = r.sales.withColumn("is_weekend", calendar.weekend_flag(F.col("date")))
    return flagged.groupBy("is_weekend").agg(F.count("*").alias("n"), F.sum("units_sold").alias("units_sold"))


@query("week_start", "SELECT CAST(date_trunc('week', date) AS DATE) AS week_start, count(*) AS n, "
                     "min(date) AS first_day, max(date) AS last_day FROM v_sales GROUP BY 1")
def week_start(r: Retail):
    return (r.sales.groupBy(calendar.week_start(F.col("date")).alias("week_start"))
            .agg(F.count("*").alias("n"), F.min("date").alias("first_day"), F.max("date").alias("last_day")))


@query("month_period_string", """
    SELECT strftime(date, '%Y-%m') AS period_label, CAST(date_trunc('month', date) AS DATE) AS period, count(*) AS n
    FROM v_sales GROUP BY ALL""")
def month_period_string(r: Retail):
    year, month = F.year("date"), F.month("date")
    return r.sales.groupBy(calendar.month_label(year, month).alias("period_label"),
                           calendar.month_period(year, month).alias("period")).agg(F.count("*").alias("n"))


@query("flag_label", """
    SELECT CASE WHEN is_promotion = 1 THEN 'Promo Day' ELSE 'Normal Day' END AS promotion, count(*) AS n
    FROM v_sales GROUP BY 1""")
def flag_label(r: Retail):
    return (r.sales.groupBy(labels.promo_day_label(F.col("is_promotion")).alias("promotion"))
            .agg(F.count("*").alias("n")))


@query("to_millions", f"SELECT product_id, {sql_he('sum(revenue) / 1e6')} AS revenue_millions "
                      "FROM v_sales GROUP BY product_id")
def to_millions(r: Retail):
    return r.sales.groupBy("product_id").agg(
        he(numeric.to_millions(F.sum("revenue"))).alias("revenue_millions"))


@query("dq_profile", """
    SELECT count(*) AS n_rows, min(date) AS date_min, max(date) AS date_max,
      count(DISTINCT store_id) AS n_store_id, count(DISTINCT product_id) AS n_product_id,
      count(DISTINCT category) AS n_category FROM v_dirty""")
def dq_profile(r: Retail):
    return quality.profile(r.dirty)


@query("dq_null_counts", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_nulls FROM v_dirty" for c in DQ_COLUMNS)
    + ") WHERE n_nulls > 0")
def dq_null_counts(r: Retail):
    return quality.null_counts(r.dirty)


@query("dq_duplicate_count", """
    SELECT CAST((SELECT count(*) FROM v_dirty) - (SELECT count(*) FROM (SELECT DISTINCT * FROM v_dirty)) AS BIGINT)
      AS n_duplicates""")
def dq_duplicate_count(r: Retail):
    return quality.duplicate_count(r.dirty)


@query("dq_describe", " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count({c}) AS n, {sql_he(f'avg({c})', 2)} AS mean,
        {sql_he(f'stddev_samp({c})', 2)} AS std, {sql_he(f'min({c})', 2)} AS min,
        {sql_he(f'quantile_cont({c}, 0.25)', 2)} AS q1, {sql_he(f'quantile_cont({c}, 0.5)', 2)} AS median,
        {sql_he(f'quantile_cont({c}, 0.75)', 2)} AS q3, {sql_he(f'max({c})', 2)} AS max FROM v_dirty"""
    for c in ("units_sold", "unit_price", "revenue")))
def dq_describe(r: Retail):
    return quality.describe(r.dirty)


@query("filter_domains", " UNION ALL ".join(
    f"SELECT '{c}' AS domain, {c} AS value, min(date) AS date_min, max(date) AS date_max FROM v_sales GROUP BY {c}"
    for c in ("store_name", "category")))
def filter_domains(r: Retail):
    return quality.filter_domains(r.sales)
