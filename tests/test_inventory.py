"""Inventory analytics against brute force and the expected behaviour of small cases."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfline.operators import bundles, inventory

REQUEST = "group_id string, store_idx long, demand double, capacity long, total_inventory long"


def requests(spark, cases):
    rows = [
        (str(g), i, float(d), int(c), int(total))
        for g, (demands, capacities, total) in enumerate(cases)
        for i, (d, c) in enumerate(zip(demands, capacities))
    ]
    return spark.createDataFrame(rows, REQUEST)


def best_allocation(demands, capacities, total):
    """All allocations tried; the last store takes the most units that are still optimal, then the one before it."""
    best = max(
        itertools.product(*[range(c + 1) for c in capacities]),
        key=lambda k: (
            -1 if sum(k) > total else round(sum(min(x, d) for x, d in zip(k, demands)), 6),
            tuple(reversed(k)),
        ),
    )
    return list(best)


@pytest.mark.parametrize("limit", [3, 1_000_000])
def test_allocation_is_optimal(spark, limit):
    rng = random.Random(5)
    cases = []
    for _ in range(60):
        n = rng.randint(1, 4)
        demands = [rng.choice([rng.randint(0, 6), round(rng.random() * 6, 2)]) for _ in range(n)]
        cases.append((demands, [rng.randint(0, 6) for _ in range(n)], rng.randint(1, 20)))
    got = {}
    for r in inventory.allocate(requests(spark, cases), group_limit=limit).collect():
        got.setdefault(int(r["group_id"]), {})[r["store_idx"]] = r["allocation"]
    for g, (demands, capacities, total) in enumerate(cases):
        allocation = [got[g][i] for i in range(len(demands))]
        assert allocation == best_allocation(demands, capacities, total), cases[g]


@pytest.mark.parametrize("demands, capacities, total, expected", [
    ([3.5, 2], [7, 4], 100, [7, 4]),
    ([80, 80], [90, 90], 30, [0, 30]),
    ([40], [90], 60, [60]),
])
def test_allocation_cases(spark, demands, capacities, total, expected):
    rows = inventory.allocate(requests(spark, [(demands, capacities, total)])).orderBy("store_idx").collect()
    assert [r["allocation"] for r in rows] == expected


def test_allocation_summary(spark):
    cases = [([70, 40, 20], [120, 60, 40], 160), ([90] * 4, [90] * 4, 60), ([12, 18, 25], [40] * 3, 400), ([0], [0], 9_000)]
    rows = {r["group_id"]: r for r in inventory.allocation_summary(inventory.allocate(requests(spark, cases))).collect()}
    assert rows["0"]["inventory_used"] <= 160 and rows["0"]["fill_rate"] > 0
    assert rows["1"]["inventory_used"] == 60 and rows["1"]["fill_rate"] < 100
    assert rows["2"]["fill_rate"] == 100.0
    assert rows["3"]["fill_rate"] == 0.0 and rows["3"]["inventory_remaining"] == 9_000


def test_unit_cap(spark):
    case = [([30_000.0], [30_000], 30_000)]
    assert inventory.allocate(requests(spark, case), unit_cap=10_000).first()["allocation"] == 10_000
    assert inventory.allocate(requests(spark, case)).first()["allocation"] == 30_000


def daily(spark, demands):
    return spark.createDataFrame([(i, float(d)) for i, d in enumerate(demands)], "sale_date int, demand double")


@pytest.mark.parametrize("demands, window, expected", [
    (range(12, 84, 12), 3, [24.0, 36.0, 48.0, 60.0]),
    ([7] * 5, 3, [7.0] * 3),
    ([4, 9, 15], 1, [4.0, 9.0, 15.0]),
    ([9, 15, 21], 3, [15.0]),
    ([9, 15, 21], 7, [15.0]),
    ([], 3, []),
])
def test_demand_rate(spark, demands, window, expected):
    rows = inventory.demand_rate(daily(spark, demands), window).orderBy("sale_date").collect()
    assert [r["rate"] for r in rows] == expected


def test_anomalies(spark):
    flagged = inventory.demand_anomalies(inventory.demand_rate(daily(spark, [10] * 20 + [100]), 1))
    assert [r["rate"] for r in flagged.filter("is_anomaly").collect()] == [100.0]
    assert inventory.anomaly_summary(flagged, 1).first()["total_windows"] == 21


def units(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "units_sold double")


@pytest.mark.parametrize("values, level", [
    (range(5, 55, 5), 0.95), (np.random.default_rng(6).poisson(20, 1000), 0.95), ([10.0] * 100, 0.99), ([3], 0.5),
])
def test_reorder_point(spark, values, level):
    row = inventory.reorder_point(units(spark, values), level, 7).first()
    ordered = sorted(float(v) for v in values)
    at, mean = ordered[int(level * (len(ordered) - 1))], sum(ordered) / len(ordered)
    safety = max(0, round((at - mean) * 7))
    assert (row["safety_stock"], row["reorder_point"]) == (safety, round(mean * 7 + safety))
    assert row["daily_demand_at_sl"] == at


def test_reorder_point_of_nothing(spark):
    row = inventory.reorder_point(units(spark, [])).first()
    assert (row["reorder_point"], row["safety_stock"], row["daily_demand_at_sl"]) == (0, 0, 0.0)


def test_thresholds(spark):
    rows = {r["threshold"]: r for r in inventory.threshold_counts(units(spark, range(10, 60, 10)), [25, 30]).collect()}
    assert rows[25.0]["count_below"] == 2 and rows[30.0]["count_above"] == 2 and rows[30.0]["fraction_below"] == 0.6
    assert inventory.threshold_counts(units(spark, []), [1]).first()["fraction_below"] == 0.0
    many = spark.createDataFrame([(25.0,), (30.0,)], "threshold double")
    again = {r["threshold"]: r for r in inventory.threshold_counts(units(spark, range(10, 60, 10)), many).collect()}
    assert again == rows


def test_thresholds_for_rates_and_percentiles(spark):
    rates = {r["rate"]: r["value"] for r in inventory.threshold_for_rate(units(spark, range(100)), [-1, 0.5, 1]).collect()}
    assert rates == {-1.0: 0.0, 0.5: 50.0, 1.0: 99.0}
    got = {r["percentile"]: r["value"] for r in inventory.percentile_lookup(units(spark, range(101)), [0, 50, 100]).collect()}
    assert got == {0.0: 0.0, 50.0: 50.0, 100.0: 100.0}
    with pytest.raises(ValueError):
        inventory.percentile_lookup(units(spark, [1]), [101])


def test_top_k(spark):
    scores = spark.createDataFrame(
        [("g", p, s) for p, s in [("A", 0.1), ("B", 0.9), ("C", 0.5), ("D", 0.3), ("E", 0.9)]], "g string, product_id string, risk_score double"
    )
    assert [r["product_id"] for r in inventory.top_k(scores, 3).collect()] == ["E", "B", "C"]
    ranked = inventory.top_k_per_group(scores, ["g"], 2)
    assert {r["product_id"]: r["rank"] for r in ranked.collect()} == {"E": 1, "B": 2}
    # beyond the planner's limit the ranks come from a global sort
    assert inventory.top_k_per_group(scores, ["g"], 2000).exceptAll(
        inventory.top_k_per_group(scores, ["g"], 1000)).count() == 0


def test_stockout_risk(spark):
    df = spark.createDataFrame([("A", 1), ("A", 3), ("B", 5), ("C", 0), ("C", 0)], "product_id string, units_sold int")
    got = {r["product_id"]: r["risk_score"] for r in inventory.stockout_risk(df).collect()}
    assert got == pytest.approx({"A": 2**0.5 / 2, "B": 0.0, "C": 0.0})


def test_segments(spark):
    rows = [("Groceries", 100.0, 500.0), ("Dairy", 50.0, 200.0), ("Groceries", 80.0, 400.0)]
    df = spark.createDataFrame(rows, "category string, units_sold double, revenue double")
    got = {r["segment"]: r for r in inventory.segment_stats(df, "category").collect()}
    assert (got["Groceries"]["count"], got["Groceries"]["total_demand"], got["Groceries"]["avg_demand"]) == (2, 180.0, 90.0)
    assert sorted(got) == ["Dairy", "Groceries"]
    assert inventory.segment_stats(df, "category").filter("segment = 'Toys'").count() == 0


def test_ranges(spark):
    prefix = inventory.prefix_sums(daily(spark, range(10, 60, 10)))
    sums = [r["prefix"] for r in prefix.orderBy("position").collect()]
    assert sums == [0.0, 10.0, 30.0, 60.0, 100.0, 150.0]
    queries = spark.createDataFrame([(1, 3), (1, 1), (0, 2), (-4, 99), (9, 9)], "left int, right int")
    got = {(r["left"], r["right"]): r["total_demand"] for r in inventory.range_demand(prefix, queries).collect()}
    assert got == {(1, 3): 90.0, (1, 1): 20.0, (0, 2): 60.0, (-4, 99): 150.0, (9, 9): None}


def test_schedule(spark):
    df = spark.createDataFrame([("Low", 0.2, 0), ("High", 0.95, 1), ("Med", 0.5, 2), ("Also", 0.95, 3)], "product_id string, urgency double, seq int")
    ordered = inventory.reorder_schedule(df).orderBy("dispatch_order")
    assert [r["product_id"] for r in ordered.collect()] == ["High", "Also", "Med", "Low"]
    assert inventory.next_reorders(df).first()["product_id"] == "High" and df.count() == 4
    assert inventory.after_reorders(df, 2).count() == 2
    assert inventory.next_reorders(df.limit(0)).count() == 0


def two_ends(products, target):
    """The pairing scan itself, over exact numbers."""
    rows = sorted(products, key=lambda p: (p[1], p[0]))
    pairs, left, right = [], 0, len(rows) - 1
    while left < right:
        total = rows[left][1] + rows[right][1]
        if abs(total - target) * 20 <= target:
            pairs.append((rows[left][0], rows[right][0]))
            left, right = left + 1, right - 1
        elif total < target:
            left += 1
        else:
            right -= 1
    return pairs


@pytest.mark.parametrize("block_size, limit", [(256, 1_000_000), (7, 20), (3, 20)])
def test_bundles_like_the_scan(spark, block_size, limit):
    rng = random.Random(7)
    groups = {}
    for g in range(12):
        n = 200 if g == 0 else rng.randint(0, 25)
        spread = rng.choice([5, 60, 100])
        groups[f"g{g}"] = [(f"P{i:03d}", rng.choice([rng.randint(0, spread), rng.randint(0, 100 * spread) / 100])) for i in range(n)]
    rows = [(g, p, float(d)) for g, products in groups.items() for p, d in products]
    df = spark.createDataFrame(rows, "g string, product_id string, demand double")
    got = {}
    for r in bundles.bundle_pairs(df, 60, ["g"], block_size=block_size, group_limit=limit).collect():
        got.setdefault(r["g"], set()).add((r["left_product"], r["right_product"]))
    from fractions import Fraction

    expected = {
        g: set(two_ends([(p, Fraction(str(d))) for p, d in products], 60)) for g, products in groups.items()
    }
    assert got == {g: pairs for g, pairs in expected.items() if pairs}


def test_bundles_small(spark):
    df = spark.createDataFrame([("A", 10.0), ("B", 20.0), ("C", 30.0), ("D", 40.0)], "product_id string, demand double")
    rows = bundles.bundle_pairs(df, 50).collect()
    assert {(r["left_product"], r["right_product"], r["combined_demand"]) for r in rows} == {("A", "D", 50.0), ("B", "C", 50.0)}
    assert bundles.bundle_pairs(df.filter("demand < 25"), 100).count() == 0
    plan = bundles.bundle_pairs(df, 50)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_report(spark):
    rows = [(f"2024-01-{d:02d}", f"S{s}", f"P{p}", (d * s + p) % 9, 5.0, "Stable") for d in range(1, 15) for s in range(3) for p in range(4)]
    df = spark.createDataFrame(rows, "sale_date string, store_id string, product_id string, units_sold int, revenue double, volatility_band string")
    df = df.withColumn("sale_date", F.to_date("sale_date"))
    report = inventory.inventory_report(df, k=2)
    assert {name: r.count() for name, r in report.items()} == {
        "allocation": 3, "allocation_summary": 1, "sliding_window": 1, "reorder_point": 1, "top_k_stockout": 2, "category_analysis": 1
    }
