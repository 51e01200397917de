"""Ordered building blocks against plain Python, also where one group holds most rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfline.functions import ordering


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(3000):
        group = "hot" if i % 3 else f"g{i % 7}"
        value = float(rng.choice([-5.0, 0.0, 0.25, 1e6, rng.normal() * 100]))
        rows.append((i, group, value if i % 50 else None, int(rng.integers(0, 5))))
    rows.append((3000, "hot", float("nan"), 1))
    return spark.createDataFrame(rows, "id long, g string, v double, w long"), rows


def clean(rows, group=None):
    return sorted(v for _, g, v, _ in rows if v is not None and v == v and (group is None or g == group))


def test_quantiles(skewed):
    df, rows = skewed
    got = ordering.quantiles(df, {"v": [0.01, 0.5, 0.99], "w": [0.5]}).first()
    assert np.allclose([got["v_q1"], got["v_q50"], got["v_q99"]], np.quantile(clean(rows), [0.01, 0.5, 0.99]))
    assert got["w_q50"] == np.median([r[3] for r in rows])


def test_quantiles_by_group(skewed):
    df, rows = skewed
    for r in ordering.quantiles(df, {"v": [0.1, 0.9]}, ["g"]).collect():
        assert np.allclose([r["v_q10"], r["v_q90"]], np.quantile(clean(rows, r["g"]), [0.1, 0.9]))


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([], "v double")
    assert ordering.quantiles(df, {"v": [0.5]}).first()["v_q50"] is None


def test_every_position(skewed):
    df, rows = skewed
    expected = clean(rows)
    asked = {str(i): str(i) for i in range(0, len(expected), 97)}
    got = {int(r["label"]): r["value"] for r in ordering.order_statistics(df, {"v": asked}).collect()}
    assert got == {int(i): expected[int(i)] for i in asked}


@pytest.mark.parametrize("low, high", [(0, 5e-5), (100, 100.005), (-1e-300, 1e-300)])
@pytest.mark.parametrize("by", [[], ["g"]])
def test_values_that_share_a_bucket_are_searched_in_pieces(spark, monkeypatch, low, high, by):
    values = np.random.default_rng(5).uniform(low, high, 5000).tolist()
    df = spark.createDataFrame([(v, None if i % 2 else "a") for i, v in enumerate(values)], "v double, g string")
    pieces = []
    cut = ordering._sorted_total
    monkeypatch.setattr(ordering, "_sorted_total", lambda *args: pieces.append(1) or cut(*args))
    asked = {"v": {"low": "0", "middle": "CAST(n / 2 AS BIGINT)", "high": "n - 1"}}
    got = ordering.order_statistics(df, asked, by, group_limit=100).collect()
    assert pieces
    for group in ([None, "a"] if by else [0]):
        rows = sorted(v for i, v in enumerate(values) if not by or (group is None) == bool(i % 2))
        found = {r["label"]: r["value"] for r in got if not by or r["g"] == group}
        assert found == {"low": rows[0], "middle": rows[len(rows) // 2], "high": rows[-1]}


def test_positions(skewed):
    df, rows = skewed
    got = {r["id"]: r["position"] for r in ordering.with_position(df, [F.col("w").desc(), F.col("id")]).collect()}
    order = sorted(rows, key=lambda r: (-r[3], r[0]))
    assert got == {r[0]: i for i, r in enumerate(order)}


@pytest.mark.parametrize("limit", [10, 1_000_000])
def test_running_totals(skewed, limit):
    df, rows = skewed
    summed = ordering.running_total(df, "w", [F.col("w").desc(), F.col("id")], ["g"], group_limit=limit)
    got = {r["id"]: r["running"] for r in summed.collect()}
    expected, sums = {}, {}
    for i, g, _, w in sorted(rows, key=lambda r: (-r[3], r[0])):
        expected[i] = sums[g] = sums.get(g, 0) + w
    assert got == expected


def test_positions_by_group(skewed):
    df, rows = skewed
    got = {r["id"]: r["position"] for r in ordering.with_position(df, [F.col("id")], ["g"]).collect()}
    seen, expected = {}, {}
    for i, g, _, _ in rows:
        expected[i] = seen.get(g, 0)
        seen[g] = expected[i] + 1
    assert got == expected


@pytest.mark.parametrize("limit", [10, 1_000_000])
def test_counts(spark, skewed, limit):
    df, rows = skewed
    probes = spark.createDataFrame([(-6.0,), (-5.0,), (0.1,), (0.25,), (2e6,), (0.25,)], "p double")
    got = ordering.counts_upto(df.filter(~F.isnan("v")), "v", probes, "p", group_limit=limit).collect()
    values = clean(rows)
    assert {r["p"]: (r["count_upto"], r["total"]) for r in got} == {
        p: (sum(v <= p for v in values), len(values)) for p in (-6.0, -5.0, 0.1, 0.25, 2e6)
    }
