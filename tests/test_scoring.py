"""Request validation and rule-based forecasts."""

import hashlib

import pytest
from pyspark.sql import functions as F

from shelfline import schemas
from shelfline.functions.columns import python_number_text
from shelfline.operators import quality, scoring

# A request whose answer is known.
BASE = {
    "store_id": "S001", "product_id": "P0042", "category": "Groceries", "current_price": 12.99, "competitor_price": 13.5,
    "is_promotion": 0, "discount_pct": 0.0, "is_holiday": 0, "lag_7d": 45.0, "lag_30d": 0.0, "rolling_7d_mean": 42.5,
    "rolling_30d_mean": 0.0,
}


def requests(spark, *changes):
    return spark.createDataFrame([tuple({**BASE, **c}.values()) for c in changes], schemas.FORECAST_REQUEST)


@pytest.mark.parametrize("change, broken", [
    ({}, []),
    ({"current_price": -5.0}, ["current_price"]),
    ({"current_price": 6000.0}, ["current_price_reasonable"]),
    ({"current_price": None}, ["current_price", "current_price_reasonable"]),
    ({"category": "Gadgets"}, ["category"]),
    ({"discount_pct": 150.0}, ["discount_pct"]),
    ({"discount_pct": 100.0}, []),
    ({"store_id": ""}, ["store_id"]),
    ({"product_id": "P0123456789"}, ["product_id"]),
    ({"is_promotion": 2, "lag_7d": -1.0}, ["is_promotion", "lag_7d"]),
])
def test_rules(spark, change, broken):
    valid, quarantine = quality.validate_requests(requests(spark, change))
    assert [r["violations"] for r in quarantine.collect()] == ([broken] if broken else [])
    assert valid.count() == (0 if broken else 1)


def test_defaults(spark):
    df = spark.createDataFrame([("S1", "P1", "Toys", 5.0)], "store_id string, product_id string, category string, current_price double")
    row = quality.with_request_defaults(df).first()
    assert all(row[c] == 0 for c in quality.OPTIONAL_FIELDS)


def test_allocation_rules(spark):
    rows = [("ok", 1.0, 5, 10), ("zero", 1.0, 5, 0), ("bad", -1.0, -5, 10), ("mixed", 1.0, 5, 10), ("mixed", 1.0, 5, 11)]
    df = spark.createDataFrame(rows, "group_id string, demand double, capacity long, total_inventory long")
    got = {r["group_id"]: r["violations"] for r in quality.allocation_violations(df).collect()}
    assert got == {"ok": [], "zero": ["total_inventory"], "bad": ["demand", "capacity"], "mixed": ["total_inventory"]}
    valid, quarantine = quality.validate_allocation(df, max_stores=1)
    assert [r["group_id"] for r in valid.collect()] == ["ok"] and quarantine.count() == 4
    assert "stores" in quarantine.filter("group_id = 'mixed'").first()["violations"]


def test_all_boosts(spark):
    row = scoring.score(requests(spark, {
        "current_price": 8.0, "competitor_price": 10.0, "is_promotion": 1, "is_holiday": 1, "rolling_7d_mean": 0.0, "discount_pct": 25.0,
    })).first()
    assert (row["predicted_demand"], row["demand_band"], row["reorder_recommendation"]) == (81.0, "Surge", "SUFFICIENT")
    assert row["risk_factors"] == [
        "Heavy discount (25.0%) may spike demand", "Active promotion — expect 50%+ demand increase",
        "Holiday period — expect 80%+ demand surge",
    ]
    assert row["confidence"] == 0.75


def test_blend(spark):
    row = scoring.score(requests(spark, {}), model_loaded=True).first()
    assert (row["predicted_demand"], row["demand_band"], row["reorder_recommendation"]) == (35.5, "High", "SUFFICIENT")
    assert row["risk_factors"] == ["No significant risk factors"] and row["confidence"] == 0.92
    assert row["request_id"] == hashlib.md5(b"S001_P0042_12.99_45.0").hexdigest()[:12]


def test_recommendations_and_spike(spark):
    rows = scoring.score(requests(
        spark,
        {"rolling_7d_mean": 8.0, "lag_7d": 45.0},
        {"rolling_7d_mean": 18.0, "lag_7d": 0.0},
        {"competitor_price": 10.0, "rolling_7d_mean": 0.0},
        {"category": "Unlisted", "rolling_7d_mean": 0.0},
    )).collect()
    assert [r["reorder_recommendation"] for r in rows] == ["REORDER_NOW", "MONITOR", "SUFFICIENT", "SUFFICIENT"]
    assert rows[0]["risk_factors"] == ["Recent demand spike detected"]
    assert rows[2]["risk_factors"] == ["Price higher than competitor by >10%"] and rows[2]["predicted_demand"] == 20.0
    assert rows[3]["predicted_demand"] == 10.0


def test_first_answer_per_id(spark):
    scored = scoring.score(
        requests(spark, {"is_promotion": 1}, {}).withColumn("arrival", 1 - F.col("is_promotion")), keep=("arrival",)
    )
    rows = scoring.first_answers(scored, "arrival").collect()
    assert len(rows) == 1 and "Active promotion" in rows[0]["risk_factors"][0]


@pytest.mark.parametrize("value", [0.0, 12.99, 45.0, 1e7, 12345678.0, 12345678.25, 0.0005, 0.00012, 1e-5, 2.5e-7, 1e16, 1.5e20, 999999.5])
def test_numbers_as_python_prints_them(spark, value):
    df = spark.createDataFrame([(value,)], "x double")
    assert df.select(python_number_text(F.col("x"))).first()[0] == repr(value)


def test_response_rules(spark):
    marked = quality.with_violations(scoring.score(requests(spark, {})), quality.response_rules())
    assert marked.first()["violations"] == []
