"""A NULL group is a group: in running totals at both limits, order statistics, counts, allocation and pairing."""

import pytest
from pyspark.sql import functions as F

from shelfline.functions import ordering
from shelfline.operators import bundles, inventory, sql_features
from shelfline.sources import readers


@pytest.fixture(scope="module")
def values(spark):
    rows = [(g, i, float(i % 7)) for g in (None, "a") for i in range(30)]
    return spark.createDataFrame(rows, "g string, id int, v double")


@pytest.mark.parametrize("limit", [10, 1_000_000])
def test_running_total(values, limit):
    got = ordering.running_total(values, "v", [F.col("id")], ["g"], group_limit=limit).toPandas()
    want = sum(i % 7 for i in range(30))
    for _, part in got.groupby("g", dropna=False):
        assert len(part) == 30 and part.running.max() == want


@pytest.mark.parametrize("limit", [10, 1_000_000])
def test_counts_and_statistics(values, limit):
    probes = values.select("g").distinct().withColumn("p", F.lit(3.0))
    got = ordering.counts_upto(values, "v", probes, "p", ["g"], group_limit=limit).collect()
    assert {(r.g, r.count_upto, r.total) for r in got} == {(g, sum(i % 7 <= 3 for i in range(30)), 30) for g in (None, "a")}
    assert {r.g for r in inventory.percentile_lookup(values, [50], "v", ["g"]).collect()} == {None, "a"}
    assert {r.g for r in inventory.reorder_point(values, column="v", by=["g"]).collect()} == {None, "a"}


@pytest.mark.parametrize("limit", [3, 1_000_000])
def test_allocation_and_pairs(spark, limit):
    rows = [(g, i, 5.0, 10, 100) for g in (None, "a") for i in range(4)]
    requests = spark.createDataFrame(rows, "group_id string, store_idx int, demand double, capacity int, total_inventory int")
    got = inventory.allocate(requests, group_limit=limit).collect()
    assert sorted(str(r.group_id) for r in got) == ["None"] * 4 + ["a"] * 4 and {r.allocation for r in got} == {10}
    products = spark.createDataFrame(
        [(g, f"p{v}", float(v)) for g in (None, "a") for v in (10, 20, 30, 40)], "g string, product_id string, demand double")
    pairs = bundles.bundle_pairs(products, 50, ["g"], group_limit=limit).collect()
    assert sorted((str(r.g), r.left_product, r.right_product) for r in pairs) == [
        (g, a, b) for g in ("None", "a") for a, b in (("p10", "p40"), ("p20", "p30"))]


def test_threshold_without_rows(values):
    got = inventory.threshold_for_rate(values.limit(0), [0.1, 0.9], "v").collect()
    assert {(r.rate, r.value) for r in got} == {(0.1, 0.0), (0.9, 0.0)}


def test_mixed_headers_are_an_error(spark, tmp_path):
    head = "Date,Store ID,Product ID,Units Sold,Revenue\n"
    (tmp_path / "a.csv").write_text(head + "2024-01-01,S1,P1,5,50\n")
    assert readers.read_sales(spark, str(tmp_path)).first().units_sold == 5
    (tmp_path / "b.csv").write_text("Date,Store ID,Product ID,Revenue,Units Sold\n2024-01-01,S1,P1,50,5\n")
    with pytest.raises(Exception):
        readers.read_sales(spark, str(tmp_path)).collect()


def test_plans_without_the_rank_have_no_join(spark):
    columns = {c: F.lit(None).cast("double") for c in sql_features.BASE_COLUMNS}
    base = spark.range(5).withColumns(columns).withColumn("sale_date", F.current_date()).drop("id")
    plan = sql_features.demand_features(base, ranked=False)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
