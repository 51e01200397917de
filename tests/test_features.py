"""Feature rules on literal series, and the plans behind them."""

from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfline.operators import dashboard, features, marts, sql_features
from shelfline.sources import tpch

from conftest import DATA


def series(spark, units, prices=None, start="2024-01-01"):
    days = pd.date_range(start, periods=len(units)).date
    prices = prices or [1.0] * len(units)
    rows = [(d, "S1", "P1", float(u), float(u), float(p), 1.0, 0.0, 0, 0) for d, u, p in zip(days, units, prices)]
    return spark.createDataFrame(
        rows,
        "sale_date date, store_id string, product_id string, units_sold double, revenue double, avg_price double, "
        "avg_competitor_price double, max_discount double, had_promotion int, is_holiday int",
    )


def column(df, name):
    return [r[name] for r in df.orderBy("sale_date").select(name, "sale_date").collect()]


def test_against_pandas(spark):
    units = np.random.default_rng(4).integers(0, 30, 60).tolist()
    df = features.demand_features(features.rolling_features(features.lag_features(series(spark, units))))
    got = df.orderBy("sale_date").toPandas()
    s = pd.Series(units, dtype="float64")
    for n in (1, 3, 7, 14, 30):
        assert np.allclose(got[f"lag_{n}d"], s.shift(n), equal_nan=True)
    for n in (7, 14, 30):
        past = s.shift(1).rolling(n, min_periods=1)
        assert np.allclose(got[f"rolling_{n}d_mean"], past.mean(), equal_nan=True)
        assert np.allclose(got[f"rolling_{n}d_std"], past.std(), equal_nan=True)
        assert np.allclose(got[f"rolling_{n}d_max"], past.max(), equal_nan=True)
    assert np.allclose(got["ytd_cumulative"], s.cumsum())
    assert np.allclose(got["demand_velocity"], s.diff().fillna(0))


def test_short_series(spark):
    df = features.demand_features(features.rolling_features(series(spark, [5, 5, 9])))
    assert column(df, "volatility_band") == ["Stable", "nan", "Stable"]
    assert column(df, "demand_volatility") == [0.0, None, 0.0]


def test_price_change(spark):
    df = features.price_features(series(spark, [1] * 5, [0, 5, 10, 9, 0]))
    assert column(df, "price_change_pct") == pytest.approx([0.0, 1.0, 1.0, -0.1, -1.0])


def test_year_turn(spark):
    df = features.demand_features(series(spark, [1, 2, 4], start="2023-12-30"))
    assert column(df, "ytd_cumulative") == [1.0, 3.0, 4.0]


def test_band_edges(spark):
    from shelfline.functions.columns import demand_band, volatility_band

    df = spark.createDataFrame([(0.3, 4), (0.7, 5), (1.5, 19), (5.0, 20), (None, 49), (0.0, 50), (0.0, None)], "v double, u int")
    rows = df.select(volatility_band(F.col("v")), demand_band(F.col("u"))).collect()
    assert [r[0] for r in rows] == ["Stable", "Moderate", "Volatile", "Erratic", "nan", "Stable", "Stable"]
    assert [r[1] for r in rows] == ["Low", "Medium", "Medium", "High", "High", "Surge", "Surge"]


def test_daily_aggregation_drops_missing_keys(spark, day):
    rows = [(day("2024-01-01"), "S1", "P1", 1, 2.0), (day("2024-01-01"), "S1", "P1", 2, None), (day("2024-01-01"), None, "P1", 9, 9.0)]
    df = spark.createDataFrame(rows, "sale_date date, store_id string, product_id string, units_sold int, revenue double")
    df = df.withColumns({c: F.lit(1.0) for c in ("unit_price", "competitor_price", "discount_pct", "is_promotion", "is_holiday")})
    row = features.aggregate_daily(df).collect()
    assert [(r["units_sold"], r["revenue"]) for r in row] == [(3, 2.0)]


def test_warmup_and_encoding(spark):
    df = features.demand_features(features.rolling_features(series(spark, list(range(40)))))
    kept = features.drop_warmup(df)
    assert kept.count() == 10
    encoded = features.encode_features(features.fill_remaining(kept))
    assert [c for c in encoded.columns if c.startswith("volatility_band")] == [
        f"volatility_band_{x}" for x in ("Moderate", "Stable", "Volatile", "nan")
    ]
    assert not {"store_id", "product_id", "sale_date", "volatility_band"} & set(encoded.columns)


def test_leak_free(spark):
    cleaned = series(spark, list(range(40))).withColumnsRenamed({
        "avg_price": "unit_price", "avg_competitor_price": "competitor_price", "max_discount": "discount_pct",
        "had_promotion": "is_promotion",
    })
    _, encoded = features.build_features(cleaned, leak_free=True)
    assert not set(features.LEAKING) & set(encoded.columns)


def test_calendar_lags(spark, day):
    rows = [(day(d), "S1", "P1", float(u)) for d, u in [("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-08", 8)]]
    df = spark.createDataFrame(rows, "sale_date date, store_id string, product_id string, units_sold double")
    got = features.calendar_lag_features(df, lags=(1, 7))
    assert column(got, "lag_1d") == [None, 1.0, None] and column(got, "lag_7d") == [None, None, 1.0]


def test_rank_of_missing_units(spark, day):
    rows = [(day("2024-01-01"), "S1", f"P{i}", u) for i, u in enumerate([5, None, 7, 5, 1])]
    df = spark.createDataFrame(rows, "sale_date date, store_id string, product_id string, units_sold int")
    assert {r["product_id"]: r["demand_rank"] for r in sql_features.demand_rank(df).collect()} == {
        "P0": 3, "P1": 1, "P2": 2, "P3": 3, "P4": 5
    }


def test_year_over_year_rows_and_days(spark):
    days = pd.date_range("2023-02-27", periods=368).date
    rows = [(d, "S1", "P1", i) for i, d in enumerate(days)]
    df = spark.createDataFrame(rows, "sale_date date, store_id string, product_id string, units_sold int")
    assert column(sql_features.lags(df), "yoy_change")[364:] == [None, 365, 365, 365]
    by_day = dict(zip(days, column(sql_features.calendar_yoy(df), "yoy_change")))
    assert by_day[days[-1]] is None and str(days[-1]) == "2024-02-29" and by_day[days[-2]] == 365


def test_risk_without_history(spark):
    df = spark.createDataFrame([(1, None, None, None, None, None)], "units_sold int, lag_1d int, lag_7d int, rolling_7d_mean double, rolling_7d_max int, rolling_7d_min int")
    row = sql_features.bands(df).first()
    assert (row["stockout_risk"], row["demand_volatility"]) == ("Low", 0.0)


def mart_rows(spark, n, promo):
    return spark.range(n).select(
        F.lit("P1").alias("product_id"), F.lit("Toys").alias("category"), F.lit(promo).alias("is_promotion"), F.lit(2).alias("units_sold"),
        F.lit(Decimal("1.00")).alias("revenue"), F.lit(0.5).alias("demand_volatility"), F.lit("High").alias("stockout_risk"),
    )


def test_mart_edges(spark):
    assert marts.stockout_summary(mart_rows(spark, 30, 1)).count() == 0
    assert marts.stockout_summary(mart_rows(spark, 31, 1)).first()["stockout_frequency_pct"] == 100.0
    assert marts.category_demand(mart_rows(spark, 3, 1)).first()["promo_demand_lift"] is None
    assert dashboard.category_summary(mart_rows(spark, 3, 1)).first()["risk_badge"] == "High"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_series_features_share_one_shuffle(spark):
    df = features.rolling_features(features.lag_features(series(spark, [1, 2, 3])))
    plan = plan_of(features.demand_features(features.price_features(df)))
    assert plan.count("Exchange hashpartitioning") == 1


def test_built_features_share_one_sort(spark):
    from shelfline.plans import catalog

    encoded = features.build_features(catalog._cleaned(spark, DATA))[0]
    plan = plan_of(encoded)
    windows = plan[plan.index("Window"):]
    assert windows.count(" Sort [") == 1
    assert features.YEAR not in encoded.columns


def test_features_of_cleaned_rows_need_no_shuffle(spark):
    from shelfline.plans import catalog

    with_ids, encoded = features.build_features(catalog._cleaned(spark, DATA))
    for df in (with_ids, encoded):
        assert "Window" in plan_of(df) and "Exchange hashpartitioning" not in plan_of(df)


def test_plans_have_no_cross_joins_or_python(spark):
    from shelfline.plans import catalog

    for name in ("features_dashboard", "sql_demand_features", "mart_category", "forecast_score", "demand_anomalies"):
        plan = plan_of(catalog.QUERIES[name](spark, DATA))
        for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
            assert node not in plan, (name, node)


def test_scan_reads_only_needed_columns(spark):
    rows = tpch.sales(spark, DATA).groupBy("store_id").agg(F.sum("units_sold"))
    plan = plan_of(rows)
    assert "l_tax" not in plan and "l_shipdate" not in plan and "p_name" not in plan
