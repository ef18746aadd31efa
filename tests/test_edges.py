"""Small inputs with an awkward corner each."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import week
from pyspark.sql import functions as F

from demandspark.functions import calendar, describe, lookup, numeric
from demandspark.operators import anomaly, cleaning, cluster, decompose, features, inventory, pricing, promo, quality, reports
from demandspark.operators.rollup import weekly_rollup
from demandspark.sources import stages, tables
from demandspark.sources.schemas import DAILY_SALES


def test_half_even(spark):
    got = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.5,)], "x double").select(numeric.round_half_even(F.col("x")))
    assert [r[0] for r in got.collect()] == [0.0, 2.0, 2.0, 0.0]


def test_negative_becomes_zero_before_nulls_take_the_median(spark):
    df = spark.createDataFrame([(None,), (-5,), (4,), (6,)], "units_sold bigint")
    out = cleaning.median_impute(cleaning.clamp_negative(df, ["units_sold"]))
    assert sorted(r[0] for r in out.collect()) == [0.0, 4.0, 4.0, 6.0]


def test_clean_daily(spark):
    row = (dt.date(2024, 3, 4), 2, 1.25, 9.0, 1, 0, 0)
    rows = [row, row, (dt.date(2024, 3, 5), None, 2.0, 1.0, 0, 0, 0), (dt.date(2024, 3, 6), -3, 2.0, 1.0, 0, 0, 1)]
    df = spark.createDataFrame(rows, "date date, units_sold bigint, unit_price double, revenue double, "
                                     "is_promotion int, is_weekend int, stockout_flag int")
    out = {r.date.day: (r.units_sold, r.revenue) for r in cleaning.clean_daily(df).collect()}
    assert out == {4: (2.0, 2.5), 5: (1.0, 2.0), 6: (0.0, 0.0)}
    assert quality.duplicate_count(df).first()[0] == 1
    assert {r.column_name: r.n_nulls for r in quality.null_counts(df).collect()} == {"units_sold": 1}


def test_year_edges(spark):
    days = [dt.date(2024, 12, 30), dt.date(2025, 1, 1), dt.date(2023, 1, 1)]
    df = spark.createDataFrame([(d,) for d in days], "date date")
    starts = {r.date: r.w for r in df.withColumn("w", calendar.week_start(F.col("date"))).collect()}
    assert starts == {days[0]: days[0], days[1]: days[0], days[2]: dt.date(2022, 12, 26)}
    first = calendar.add_week_calendar(df.withColumnRenamed("date", "week_start")).orderBy(F.desc("week_start")).collect()
    assert (first[1].year, first[1].week_num) == (2024, 1)


def test_one_row_series(spark, make_weekly):
    panel = make_weekly([("S001", "P001", 0, 5)])
    full = features.build_features(panel, ["CAT0", "CAT1"], keep_warmup=True).first()
    assert full.lag_1w is None and full.roll_mean_2w is None and full.roll_std_2w == 0.0
    assert features.build_features(panel, ["CAT0"]).count() == 0
    assert inventory.demand_stats(panel).first().std_weekly_demand == 0.0
    assert anomaly.series_zscore(panel).first().anomaly_zscore is False


def test_lags_go_by_row_and_gaps_fill_linearly(spark, make_weekly):
    panel = make_weekly([("S001", "P001", i, u) for i, u in [(0, 10), (1, 20), (4, 50), (5, 60)]])
    lags = features.add_lag_features(panel, lags=[1]).orderBy("week_start").collect()
    assert [r.lag_1w for r in lags] == [None, 10, 20, 50]
    filled = decompose.gap_fill(panel).orderBy("week_start").collect()
    assert [r.units_sold for r in filled] == [10, 20, 30, 40, 50, 60]
    assert [r.week_start for r in filled] == [week(i) for i in range(6)]


def test_gap_fill_takes_nearest_at_the_ends(spark, make_weekly):
    panel = make_weekly([("S001", "P001", 0, None), ("S001", "P001", 2, 7), ("S001", "P001", 3, None)])
    assert [r.units_sold for r in decompose.gap_fill(panel).orderBy("week_start").collect()] == [7.0] * 4


def test_fast_warmup_drop_equals_dropping_any_null(spark, make_weekly):
    panel = make_weekly([("S001", "P001", i, i % 7) for i in range(20)] + [("S001", "P002", i, 1) for i in range(12)])
    full = features.build_features(panel, ["CAT0", "CAT1"], keep_warmup=True)
    fast = features.build_features(panel, ["CAT0", "CAT1"])
    assert sorted(map(str, fast.collect())) == sorted(map(str, features.drop_warmup(full).collect()))
    assert fast.count() == 8


def test_weekly_rollup_of_missing_values(spark):
    rows = [("S001", dt.date(2024, 1, 1), None, 2.0), ("S001", dt.date(2024, 1, 8), 3, 2.0),
            ("S001", dt.date(2024, 1, 14), 4, 4.0)]
    df = spark.createDataFrame(rows, "store_id string, date date, units_sold bigint, unit_price double").selectExpr(
        "*", "'n' store_name", "'P001' product_id", "'p' product_name", "'c' category", "units_sold * unit_price revenue",
        "1 is_promotion", "0 stockout_flag", "2 lead_time_days", "0.2 holding_cost_pct", "5.0 base_price")
    got = [(r.units_sold, r.avg_price, r.promo_days) for r in weekly_rollup(df).orderBy("week_start").collect()]
    assert got == [(0, 2.0, 1), (7, 3.0, 2)]
    again = [(r.units_sold, r.avg_price, r.promo_days)
             for r in weekly_rollup(df, pre_shuffle=True).orderBy("week_start").collect()]
    assert again == got


def test_onehot_drops_first_value(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "category string")
    assert features.category_domain(df) == ["a", "b"]
    out = features.add_category_onehot(df, ["b", "a"])
    assert out.columns == ["category", "cat_b"] and [r.cat_b for r in out.collect()] == [1, 0, 0]


def test_unmapped_store(spark):
    df = spark.createDataFrame([("S001",), ("S006",)], "store_id string")
    assert cluster.lookup_region(df, unmapped="drop").count() == 1
    assert {r.store_id: r.region for r in cluster.lookup_region(df).collect()} == {"S001": "West", "S006": None}
    assert {r.store_id: r.plant for r in inventory.lookup_plant(df).collect()} == {"S001": "PLANT_MUM", "S006": "UNKNOWN"}
    with pytest.raises(ValueError):
        lookup.look_up(df, df, "store_id", unmapped="other")
    with pytest.raises(ValueError):
        lookup.literal_table(spark, {i: i for i in range(lookup.MAX_LITERAL_ROWS + 1)}, "k", "v")


def uplift_of(make_weekly, units, promos):
    rows = [("S001", "P001", i, u, {"promo": p}) for i, (u, p) in enumerate(zip(units, promos))]
    return [(r.promo_units, r.baseline_units) for r in promo.promo_uplift(make_weekly(rows)).orderBy("week_start").collect()]


def test_uplift_needs_two_earlier_quiet_weeks(make_weekly):
    assert uplift_of(make_weekly, [9], [1]) == []
    assert uplift_of(make_weekly, [4, 9], [0, 1]) == []
    assert uplift_of(make_weekly, [4, 6, 9], [0, 0, 1]) == [(9, 5.0)]
    assert uplift_of(make_weekly, [100, 1, 2, 3, 4, 9], [0, 0, 0, 0, 0, 1]) == [(9, 2.5)]


def test_uplift_of_a_promotion_run_keeps_the_baseline(make_weekly):
    assert uplift_of(make_weekly, [4, 6, 9, 8, 7], [0, 0, 1, 1, 1]) == [(9, 5.0), (8, 5.0), (7, 5.0)]


def test_tied_price_takes_the_lowest_change(spark):
    base = spark.createDataFrame([("P001", "p", -1.0, 100.0, 50.0)],
                                 "product_id string, product_name string, price_elasticity double, avg_price double, units_sold double")
    best = pricing.optimal_price(pricing.price_scenarios(base)).first()
    assert best.price_change_pct == "-15%" and best.predicted_revenue == 5000.0
    labels = {r.price_change_pct for r in pricing.price_scenarios(base).collect()}
    assert labels == {"-15%", "-10%", "-5%", "+0%", "+5%", "+10%", "+15%"}


def test_group_size_thresholds(spark, make_weekly):
    rows = [("S001", p, i, 5 + i % 3, {"price": 10.0 + i}) for p, n in [("P001", 19), ("P002", 20)] for i in range(n)]
    panel = make_weekly(rows)
    assert [r.product_id for r in pricing.simple_elasticity(panel).collect()] == ["P002"]
    assert [r.product_id for r in pricing.price_elasticity(panel).collect()] == ["P002"]
    ab = spark.createDataFrame(
        [("P1", "a", "c", s, 5, 1) for s, n in [("T", 4), ("C", 5)] for _ in range(n)]
        + [("P2", "a", "c", s, 5, 1) for s, n in [("T", 5), ("C", 5)] for _ in range(n)],
        "product_id string, product_name string, category string, store_id string, units_sold bigint, is_promo_week int")
    groups = spark.createDataFrame([("T", "Treatment"), ("C", "Control")], "store_id string, ab_group string")
    assert [(r.product_id, r.p_value) for r in promo.ab_effect(ab, groups).collect()] == [("P2", 1.0)]


def test_long_series_threshold(make_weekly):
    panel = make_weekly([("S001", p, i, 1) for p, n in [("P001", 103), ("P002", 104)] for i in range(n)])
    assert {r.product_id for r in decompose.long_series(panel).select("product_id").distinct().collect()} == {"P002"}


def test_empty_month_is_kept(make_weekly):
    panel = make_weekly([("S001", "P001", 0, 5), ("S001", "P001", 9, 5)])
    got = {r.month_end: r.revenue for r in reports.month_end_revenue(panel).collect()}
    assert got == {dt.date(2023, 1, 31): 50.0, dt.date(2023, 2, 28): 0.0, dt.date(2023, 3, 31): 50.0}


def test_histogram_edges(spark):
    df = spark.createDataFrame([(-99.0,), (0.0,), (50.0,), (999.0,), (None,)], "x double")
    got = {r.bin: r.n for r in describe.histogram(df, "x", -50, 100, 3).collect()}
    assert got == {0: 1, 1: 1, 2: 2}
    flat = describe.histogram(spark.createDataFrame([(3.0,)] * 4, "x double"), "x", -50, 100, 40).collect()
    assert [r.n for r in flat] == [4]


def test_correlations_with_nulls_use_complete_pairs(spark):
    import pandas as pd
    pdf = pd.DataFrame({"a": [1.0, 2.0, 3.0, None, 7.0], "b": [2.0, 1.0, 4.0, 9.0, 6.0], "c": [5.0, None, 1.0, 2.0, 0.0]})
    for data in (pdf, pdf.dropna()):
        df = spark.createDataFrame(data.astype(object).where(data.notna(), None), "a double, b double, c double")
        for r in describe.correlations(df, ["a", "b", "c"]).collect():
            assert r["corr"] == pytest.approx(data[r.row_name].corr(data[r.col_name]))


def test_correlation_of_a_large_offset(spark):
    df = spark.range(1000).selectExpr("1e9 + id % 7 as x", "1e9 + (id % 7) * 2 + id % 3 as y")
    want = df.agg(F.corr("x", "y")).first()[0]
    assert describe.correlations(df, ["x", "y"]).first()["corr"] == pytest.approx(want, abs=1e-9)


def test_forecast_join_fills_zero(spark, make_weekly):
    stats = inventory.policy(make_weekly([("S001", p, i, 5) for p in ("P001", "P002") for i in range(3)]))
    forecast = spark.createDataFrame([("S001", "P001", 3), ("S001", "P001", 4)], "store_id string, product_id string, predicted_units bigint")
    got = {r.product_id: r.forecast_12w_demand for r in inventory.join_forecast_demand(stats, forecast).collect()}
    assert got == {"P001": 7, "P002": 0}


def test_csv_and_stage_round_trip(spark, tmp_path):
    fields = [f.name for f in DAILY_SALES]
    row = (dt.date(2024, 1, 1), "S001", "n", "st", "P001", "p", "c", 3, 2.5, 7.5, 0, 0, 1, 2024, 0, 1, 0, 2, 0.2, 5.0)
    df = spark.createDataFrame([row], DAILY_SALES)
    stages.write_stage(df, f"{tmp_path}/daily", "csv")
    assert tables.read_daily_sales(spark, f"{tmp_path}/daily", "csv").select(fields).first() == df.first()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.read_daily_sales(spark, f"{tmp_path}/absent")
    with pytest.raises(ValueError):
        tables.read_table(spark, f"{tmp_path}/x.csv")
    weekly = df.select(F.lit("2024-01-01").alias("week_start"), "units_sold")
    stages.write_stage(weekly, f"{tmp_path}/weekly")
    assert stages.read_stage(spark, f"{tmp_path}/weekly").first().week_start == dt.date(2024, 1, 1)


def test_store_without_region_stays(make_weekly):
    from demandspark.operators import features

    rows = [(s, "P001", i, 10 + i % 5) for s in ("S001", "S006") for i in range(30)]
    stores = cluster.store_features(features.build_features(make_weekly(rows), ["CAT0"])).collect()
    assert {r.store_id: r.region for r in stores} == {"S001": "West", "S006": None}


def test_money_keeps_small_amounts_and_skips_nan(spark):
    from demandspark.functions.numeric import money, money_sum

    df = spark.createDataFrame([(0.00004, 1.0), (0.00004, float("nan")), (0.00004, 2.0)], "a double, b double")
    row = df.agg(money_sum(F.col("a")).alias("a"), money_sum(F.col("b")).alias("b"), F.count(money(F.col("b"))).alias("n")).first()
    assert (row.a, row.b, row.n) == (0.00012, 3.0, 2)


def test_failed_series_has_a_row(make_weekly):
    from demandspark.operators import decompose

    panel = make_weekly([("S001", "P001", i, 10 + i % 7) for i in range(120)] + [("S001", "P002", i, 5) for i in range(60)])
    summary = decompose.decomposition_summary(decompose.stl_decompose(decompose.gap_fill(panel)))
    rows = {r.product_id: r for r in summary.collect()}
    assert rows["P001"].error is None and rows["P001"].growth_direction is not None
    assert "two periods" in rows["P002"].error and rows["P002"].trend_strength is None and rows["P002"].growth_direction is None


def test_stage_tables_as_csv(spark, make_weekly, tmp_path):
    panel = features.build_features(make_weekly([("S001", "P001", i, 10 + i) for i in range(20)]), ["CAT0", "CAT1"])
    stages.write_stage(panel, f"{tmp_path}/csv", "csv")
    again = stages.read_stage(spark, f"{tmp_path}/csv", fmt="csv")
    assert dict(again.dtypes)["week_start"] == "date" and again.count() == panel.count()
    assert features.feature_columns(again) == [] and features.feature_columns(features.mark_inputs(again)) == features.feature_columns(panel)
    with pytest.raises(ValueError):
        stages.read_stage(spark, f"{tmp_path}/csv", fmt="orc")
