"""Rules of both cleaning tracks on literal rows."""

import datetime
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfline.operators import cleaning, etl, quality
from shelfline.plans import pipelines


def values(df, column):
    return sorted((r[column] for r in df.collect()), key=lambda v: (v is None, v))


def test_whole_row_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a")], "x int, y string")
    once = cleaning.drop_duplicate_rows(df)
    assert once.count() == 2
    assert cleaning.drop_duplicate_rows(once).count() == 2


def test_latest_record_takes_missing_load_time_first(spark):
    t = datetime.datetime(2024, 1, 1)
    rows = [(1, t, "a"), (1, None, "b"), (1, t + datetime.timedelta(1), "c"), (2, t, "d"), (2, t, "e")]
    df = spark.createDataFrame(rows, "k int, loaded_at timestamp, v string")
    assert values(etl.latest_record(df, ["k"]), "v") == ["b", "e"]


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(0).alias("k"), F.col("id").alias("loaded_at"), F.lit(1).alias("v")
    )
    latest = etl.latest_record(df, ["k"])
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert latest.count() == 10_000
    assert latest.filter("k = 0").first()["loaded_at"] == 29_999


def test_invalid_rows_of_both_tracks(spark):
    rows = [(-1, 5.0, 5.0), (None, 5.0, 5.0), (0, 5.0, 5.0), (3, 5.0, 5.0), (4, 0.0, 5.0)]
    df = spark.createDataFrame(rows, "units_sold int, unit_price double, revenue double").withColumn(
        "sale_date", F.current_date()
    )
    assert values(etl.drop_invalid(df), "units_sold") == [0, 3, None]
    assert values(cleaning.drop_negative_sales(df), "units_sold") == [0, 3, 4]


def test_dates(spark):
    df = spark.createDataFrame([("2024-13-45",), ("2024-02-30",), ("2024-01-01",), ("2021-01-01 10:30:00",)], "sale_date string")
    rows = {r["sale_date"].isoformat(): r for r in cleaning.parse_dates(df).collect()}
    assert set(rows) == {"2024-01-01", "2021-01-01"}
    assert (rows["2024-01-01"]["day_of_week"], rows["2024-01-01"]["is_weekend"]) == (0, 0)
    assert rows["2021-01-01"]["week_of_year"] == 53


def test_caps_fill_missing_units(spark):
    rows = [(i, Decimal(i), Decimal(i)) for i in range(1, 101)] + [(None, Decimal(1), Decimal(1))]
    df = spark.createDataFrame(rows, "units_sold int, unit_price decimal(10,2), revenue decimal(12,2)")
    capped = etl.cap_p99(df)
    units = [r[0] for r in capped.select("units_sold").collect()]
    assert max(units) == 99 and units.count(99) == 3
    assert capped.agg(F.max("unit_price")).first()[0] == Decimal("99.00")


def test_fill_median(spark):
    df = spark.createDataFrame([(Decimal(1),), (Decimal(4),), (None,)], "competitor_price decimal(10,2)")
    assert values(etl.fill_median(df), "competitor_price") == [Decimal("1.00"), Decimal("2.50"), Decimal("4.00")]


def test_enrich_without_product(spark):
    sales = spark.createDataFrame(
        [("S1", "P1", 2, Decimal("8.00"), Decimal("16.00")), ("S9", "P9", 2, Decimal("8.00"), Decimal("16.00"))],
        "store_id string, product_id string, units_sold int, unit_price decimal(10,2), revenue decimal(12,2)",
    )
    stores = spark.createDataFrame([("S1", "West", "Express", 10)], "store_id string, region string, store_type string, store_size_sqft int")
    products = spark.createDataFrame(
        [("P1", "Soda", Decimal("10.00"), Decimal("5.00"), 0)],
        "product_id string, sub_category string, base_price decimal(10,2), cost_price decimal(10,2), is_perishable int",
    )
    rows = {r["store_id"]: r for r in etl.enrich(sales, stores, products).collect()}
    assert (rows["S1"]["gross_profit"], rows["S1"]["effective_discount"]) == (Decimal("6.00"), Decimal("20.00"))
    assert rows["S9"]["gross_profit"] is None and rows["S9"]["effective_discount"] == 0 and rows["S9"]["region"] is None


def test_impute(spark):
    df = spark.createDataFrame(
        [("b", 1.0), ("a", 2.0), ("b", None), ("a", 10.0), (None, 3.0)], "s string, x double"
    )
    filled = cleaning.impute(df)
    assert values(filled, "s") == ["a", "a", "a", "b", "b"]
    assert values(filled, "x") == [1.0, 2.0, 2.5, 3.0, 10.0]


def test_winsorize_like_pandas(spark):
    rng = np.random.default_rng(1)
    frame = pd.DataFrame({
        "x": rng.normal(size=500), "flat": 7.0, "is_promotion": rng.integers(0, 2, 500), "some_id": np.arange(500.0)
    })
    got = cleaning.winsorize(spark.createDataFrame(frame)).toPandas()
    expected = frame["x"].clip(frame["x"].quantile(0.01), frame["x"].quantile(0.99))
    assert np.allclose(np.sort(got["x"]), np.sort(expected))
    for c in ("flat", "is_promotion", "some_id"):
        assert sorted(got[c]) == sorted(frame[c])


@pytest.mark.parametrize("share", [0.0, 0.3, 0.99])
def test_fused_fill_and_cap(spark, share):
    rng = np.random.default_rng(2)
    x = [None if rng.random() < share else float(v) for v in rng.normal(size=301)]
    rows = [(v, float(i), "ab"[i % 2] if i % 7 else None) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "x double, y double, s string")
    one = cleaning.impute_and_winsorize(df).orderBy("y", "x").toPandas()
    two = cleaning.winsorize(cleaning.impute(df)).orderBy("y", "x").toPandas()
    pd.testing.assert_frame_equal(one, two)


def test_merge_metadata_skips_missing_dimensions(spark):
    sales = spark.createDataFrame([("S1", "P1", "Toys")], "store_id string, product_id string, category string")
    products = spark.createDataFrame([("P1", "Snacks", "Chips")], "product_id string, category string, sub_category string")
    row = cleaning.merge_metadata(sales, None, products).first()
    assert (row["category"], row["sub_category"]) == ("Toys", "Chips")


def test_early_dedup_equals_late_dedup(spark):
    schema = "sale_date string, store_id string, product_id string, units_sold double, revenue double, month int"
    rows = [("2024-01-01", "S1", "P1", 1.0, 2.0, 1), ("2024-01-01", "S1", "P1", 1.0, 2.0, 9), ("2024-01-02", "S2", "P2", 3.0, 4.0, 1)]
    sales = spark.createDataFrame(rows, schema)
    stores = spark.createDataFrame([("S1", "West"), ("S1", "West"), ("S2", "East")], "store_id string, region string")
    products = spark.createDataFrame([("P1", "Toys"), ("P2", "Dairy")], "product_id string, category string")
    late = cleaning.winsorize(cleaning.impute(cleaning.drop_negative_sales(cleaning.drop_duplicate_rows(
        cleaning.parse_dates(cleaning.merge_metadata(sales, stores, products))))))
    early = pipelines.clean(sales, stores, products)
    assert early.count() == 2
    assert late.select(sorted(late.columns)).exceptAll(early.select(sorted(late.columns))).count() == 0


def test_quality_report(spark, day):
    df = spark.createDataFrame([(day("2024-01-01"), "S1", 1), (day("2024-01-02"), "S2", None)], "sale_date date, store_id string, units_sold int")
    report = {r["check"]: (r["passed"], r["observed"]) for r in quality.quality_report(df, 1, 1, 1).collect()}
    assert report == {
        "no_nulls": (False, 1), "enough_rows": (True, 2), "no_negative_units": (False, 1), "has_date_range": (True, 2),
        "has_multiple_stores": (True, 2),
    }
