"""Reports over the daily table: revenue, seasons, promotions and top lists."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from demandspark.catalog.base import Retail, he, query
from demandspark.catalog.sql import SALES_COLUMNS
from demandspark.catalog.sql import he as sql_he
from demandspark.functions import describe
from demandspark.operators import reports
from demandspark.sources.tables import retail_sales

YEARS = list(range(1995, 2002))
CORRELATED = ["units_sold", "revenue", "unit_price", "is_promotion", "is_weekend", "month", "day_of_week",
              "is_festival_season"]


@query("dashboard_filter", f"""
    SELECT {SALES_COLUMNS} FROM v_sales
    WHERE store_name = 'ASIA' AND category = 'CAT1' AND date BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'""")
def dashboard_filter(r: Retail):
    start, end = dt.date(1997, 1, 1), dt.date(1998, 12, 31)
    sales = retail_sales(r.spark, r.sf_dir, start, end)
    return reports.dashboard_filter(sales, "ASIA", "CAT1", start, end).select(*SALES_COLUMNS.split(", "))


@query("monthly_revenue", f"""
    SELECT year, month, make_date(year, month, 1) AS period,
      year || '-' || lpad(CAST(month AS VARCHAR), 2, '0') AS period_label, {sql_he('sum(revenue)', 2)} AS revenue
    FROM v_daily GROUP BY year, month""")
def monthly_revenue(r: Retail):
    return reports.monthly_revenue(r.sales).withColumn("revenue", he("revenue", 2))


@query("month_end_revenue", f"""
    SELECT last_day(m) AS month_end, {sql_he('coalesce(sum(revenue), 0)', 2)} AS revenue
    FROM (SELECT CAST(unnest(generate_series((SELECT date_trunc('month', min(week_start)) FROM v_weekly),
                                             (SELECT date_trunc('month', max(week_start)) FROM v_weekly),
                                             INTERVAL 1 MONTH)) AS DATE) AS m)
    LEFT JOIN v_weekly ON last_day(week_start) = last_day(m) GROUP BY 1""")
def month_end_revenue(r: Retail):
    return reports.month_end_revenue(r.weekly).withColumn("revenue", he("revenue", 2))


@query("category_revenue", f"SELECT category, {sql_he('sum(revenue)', 2)} AS revenue FROM v_sales GROUP BY category")
def category_revenue(r: Retail):
    return reports.revenue_by(r.sales, "category").withColumn("revenue", he("revenue", 2)).orderBy("revenue", "category")


@query("store_year_revenue", f"""
    SELECT store_name, year, {sql_he('sum(revenue)', 2)} AS revenue FROM v_daily GROUP BY store_name, year""")
def store_year_revenue(r: Retail):
    by_year = r.sales.select("store_name", F.year("date").alias("year"), "revenue")
    return reports.revenue_by(by_year, "store_name", "year").withColumn("revenue", he("revenue", 2))


@query("align_missing_cells", "SELECT store_name, " + ", ".join(
    f"{sql_he(f'sum(CASE WHEN year = {y} THEN revenue END)', 2)} AS y{y}" for y in [*YEARS, 2002])
    + " FROM v_daily GROUP BY store_name")
def align_missing_cells(r: Retail):
    years = [*YEARS, 2002]
    wide = reports.store_year_matrix(r.sales.select("store_name", F.year("date").alias("year"), "revenue"), years)
    return wide.select("store_name", *[he(F.col(str(y)), 2).alias(f"y{y}") for y in years])


@query("stockouts_by_category", """
    SELECT category, CAST(sum(stockout_flag) AS BIGINT) AS stockout_days FROM v_sales WHERE stockout_flag = 1
    GROUP BY category""")
def stockouts_by_category(r: Retail):
    return reports.stockouts_by_category(r.sales)


@query("season_pivot", "SELECT month, " + ", ".join(
    f"{sql_he(f'avg(CASE WHEN day_of_week = {i} THEN units_sold END)')} AS {d}"
    for i, d in enumerate(reports.DAY_NAMES)) + " FROM v_daily GROUP BY month")
def season_pivot(r: Retail):
    return reports.season_pivot(r.sales).select("month", *[he(d) for d in reports.DAY_NAMES])


BOX_SQL = """
    SELECT {by}, q1, median, q3, min(CASE WHEN x BETWEEN lo AND hi THEN x END) AS whisker_low,
      max(CASE WHEN x BETWEEN lo AND hi THEN x END) AS whisker_high,
      count(*) FILTER (WHERE x NOT BETWEEN lo AND hi) AS outliers, count(*) AS n
    FROM (SELECT {by}, CAST({value} AS DOUBLE) AS x FROM {view}) JOIN
         (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi
          FROM (SELECT {by}, quantile_cont(CAST({value} AS DOUBLE), 0.25) AS q1,
                  quantile_cont(CAST({value} AS DOUBLE), 0.5) AS median,
                  quantile_cont(CAST({value} AS DOUBLE), 0.75) AS q3 FROM {view} GROUP BY {by}))
      USING ({by}) GROUP BY {by}, q1, median, q3"""


@query("promo_box_stats", BOX_SQL.format(by="is_promotion", value="units_sold", view="v_sales"))
def promo_box_stats(r: Retail):
    return describe.box_stats(r.sales, "units_sold", "is_promotion")


@query("correlation_matrix", " UNION ALL ".join(
    f"SELECT '{b}' AS row_name, '{a}' AS col_name, {sql_he(f'corr({b}, {a})')} AS corr FROM v_daily"
    for i, b in enumerate(CORRELATED) for a in CORRELATED[:i]))
def correlation_matrix(r: Retail):
    return describe.correlations(r.daily, CORRELATED).withColumn("corr", he("corr"))


@query("top10_products_revenue", f"""
    SELECT product_name, {sql_he('sum(revenue)', 2)} AS revenue FROM v_sales GROUP BY product_name
    ORDER BY sum(revenue) DESC, product_name LIMIT 10""")
def top10_products_revenue(r: Retail):
    return reports.top_by_sum(r.sales, "product_name", "revenue", 10).withColumn("revenue", he("revenue", 2))


@query("top50_stores_revenue", f"""
    SELECT store_name, {sql_he('sum(revenue)', 2)} AS revenue FROM v_sales GROUP BY store_name
    ORDER BY sum(revenue) DESC, store_name LIMIT 50""")
def top50_stores_revenue(r: Retail):
    return reports.top_by_sum(r.sales, "store_name", "revenue", 50).withColumn("revenue", he("revenue", 2))
