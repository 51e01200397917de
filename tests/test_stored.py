"""Partners, sketches, spikes, the lasting queue, samples and subtotals, each against a plain version."""

import heapq
import random

import pytest
from pyspark.sql import functions as F

from conftest import DATA
from shelfline.operators import marts, modeling, partners, sketches
from shelfline.plans import catalog, stored
from shelfline.sources import tpch
from shelfline.streaming import jobs, queue, spikes


def best_by_comparing_all(rows, target, k):
    out = []
    for g, a, x in rows:
        near = [(abs(x + y - target), b, x + y) for h, b, y in rows if h == g and b != a and abs(x + y - target) <= target * 0.05]
        out += [(g, a, b, round(s, 4), i + 1) for i, (_, b, s) in enumerate(sorted(near)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("limit", [1_000_000, 20])
def test_best_partners(spark, limit):
    rng = random.Random(5)
    rows = [(rng.choice(["a", None]), f"p{i:03}", rng.randrange(0, 200) / 4) for i in range(160)]
    rows += [("dense", f"q{i:03}", 25.0) for i in range(70)] + [("dense", "r", 24.5), ("dense", "s", 25.5), ("one", "t", 25.0)]
    df = spark.createDataFrame([*rows, ("a", "none", None)], "g string, product_id string, demand double")
    got = partners.best_partners(df, 50, 4, ["g"], group_limit=limit)
    assert sorted((tuple(r) for r in got.collect()), key=str) == best_by_comparing_all(rows, 50, 4)
    whole = partners.best_partners(df.filter("g = 'dense'").drop("g"), 50, 2)
    assert whole.filter("rank = 1").count() == 72 and whole.columns == ["left_product", "right_product", "combined_demand", "rank"]
    assert partners.best_partners(df.limit(0), 50, 4, ["g"]).count() == 0


def test_partners_meet_by_shuffle(spark):
    df = spark.createDataFrame([("a", f"p{i}", float(i)) for i in range(60)], "g string, product_id string, demand double")
    plan = partners.best_partners(df, 50, 4, ["g"])._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join [" in line and "_side" in line]
    assert len(joins) == 1 and "SortMergeJoin" in joins[0]


def test_sketches_merge_over_days_and_batches(spark, tmp_path):
    rng = random.Random(2)
    rows = [(f"2024-0{1 + i % 3}-{1 + i % 28:02}", i, rng.lognormvariate(2, 1), None if i % 3 else float(i % 5)) for i in range(9000)]
    df = spark.createDataFrame(rows, "d string, i int, x double, y double").withColumn("sale_date", F.to_date("d"))
    path, wanted = str(tmp_path / "s"), {"x": (0.01, 0.5, 0.99), "y": (0.2, 0.9)}
    for number in (0, 1, 1):
        sketches.merge_batch(df.filter(F.col("i") % 2 == number), number, path, ["x", "y"])
    errors = sketches.rank_errors(df, sketches.range_quantiles(spark, path, wanted), ["x", "y"]).collect()
    assert len(errors) == 5 and all(r.error <= sketches.RANK_ERROR and r.n == (9000 if r.column == "x" else 3000) for r in errors)
    part = df.filter("sale_date BETWEEN '2024-02-03' AND '2024-02-20'")
    found = sketches.range_quantiles(spark, path, wanted, "2024-02-03", "2024-02-20")
    assert all(r.error <= sketches.RANK_ERROR for r in sketches.rank_errors(part, found, ["x", "y"]).collect())
    none = sketches.range_quantiles(spark, path, wanted, "2030-01-01").collect()
    assert len(none) == 5 and all(r.value is None for r in none)
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "s").glob("slot=*/*.parquet")}
    sketches.merge_batch(df.filter("sale_date = '2024-03-05'").limit(2), 2, path, ["x", "y"])
    after = {f: f.stat().st_mtime_ns for f in (tmp_path / "s").glob("slot=*/*.parquet")}
    assert {f.parent.name for f, _ in set(before.items()) ^ set(after.items())} == {f"slot={2024 * 12 + 3}"}


def test_spikes_equal_one_pass(spark, tmp_path):
    rng = random.Random(7)
    rows = [(i, rng.choice(["a", "b", None]), None if i % 50 == 0 else 1e6 + rng.gauss(0, 1) + (9 if i % 40 == 7 else 0)) for i in range(900)]
    rows += [(1000, "single", 5.0), (1001, "nothing", None)]
    df = spark.createDataFrame(rows, "event_id int, kind string, value double")
    path = str(tmp_path / "s")
    for number in (0, 1, 2, 2):
        spikes.update(df.filter(F.col("event_id") % 3 == number).repartition(2), number, path, ["kind"])
    got = {(r.event_id, r.is_spike) for r in spikes.flagged(spark, path, ["kind"]).collect()}
    by = {}
    for i, k, v in rows:
        if v is not None:
            by.setdefault(k, []).append(v)
    want = set()
    for i, k, v in rows:
        if v is None:
            want.add((i, None))
        else:
            n, mean = len(by[k]), sum(by[k]) / len(by[k])
            want.add((i, abs(v - mean) > 2 * (sum((x - mean) ** 2 for x in by[k]) / n) ** 0.5))
    assert got == want and sum(bool(s) for _, s in want) > 5


@pytest.mark.parametrize("top", [10_000, 3])
def test_queue_equals_a_heap(spark, tmp_path, monkeypatch, top):
    monkeypatch.setattr(queue, "_TOP", top)
    rng = random.Random(9)
    held, heap, seq, want = queue.ReorderQueue(spark, str(tmp_path / "q")), [], 0, []
    assert held.dequeue(3, 0) is None and held.waiting() is None
    for step in range(4):
        rows = [(seq + k, rng.randrange(3), f"p{k}") for k in range(12)]
        seq += 12
        for s, u, p in rows:
            heapq.heappush(heap, (-u, s, p))
        df = spark.createDataFrame(rows, "seq long, urgency int, product_id string")
        held.enqueue(df, step)
        held.enqueue(df, step)  # again, as after a failure
        n = [5, 0, 17, 40][step]
        taken = [heapq.heappop(heap) for _ in range(min(n, len(heap)))]
        want += [(len(want) + k + 1, s) for k, (_, s, _) in enumerate(taken)]
        for _ in range(2):
            got = [r.seq for r in held.dequeue(n, 10 + step).orderBy("dispatch_order").collect()]
            assert got == [s for _, s, _ in taken]
    assert sorted((r.dispatch_order, r.seq) for r in held.dispatched().collect()) == want
    assert held.waiting().count() == len(heap)


def test_keyed_sample_does_not_depend_on_the_layout(spark):
    df = spark.range(3000).select((F.col("id") % 7).alias("store_id"), F.col("id").alias("product_id"), F.lit("2024-01-01").alias("sale_date"))
    want = sorted(modeling.keyed_sample(df, 15, by=["store_id"]).collect())
    assert len(want) == 7 * 15
    for other in (df.repartition(9), df.orderBy(F.rand(3)), df.coalesce(1)):
        assert sorted(modeling.keyed_sample(other, 15, by=["store_id"]).collect()) == want
    # the sample of a union is among the samples of its parts
    parts = [modeling.keyed_sample(df.filter(F.col("product_id") % 2 == k), 15, by=["store_id"]) for k in (0, 1)]
    assert sorted(modeling.keyed_sample(parts[0].union(parts[1]), 15, by=["store_id"]).collect()) == want
    assert modeling.keyed_sample(df, 1500, by=[]).count() == 1500  # beyond the planner's limit
    assert sorted(modeling.keyed_sample(df, 900).collect()) == sorted(modeling.keyed_sample(modeling.keyed_sample(df, 1500), 900).collect())
    assert want != sorted(modeling.keyed_sample(df, 15, by=["store_id"], seed=1).collect())


def test_subtotals_tell_null_keys_from_totals(spark):
    rows = [("north", "s1", 1), ("north", None, 2), (None, "s2", 4), (None, None, 8), ("north", "s1", 16)]
    df = spark.createDataFrame(rows, "region string, store_id string, units_sold int").withColumn("revenue", F.lit(1).cast("decimal(12,2)"))
    got = {(r.level, r.region, r.store_id): r.total_units for r in marts.region_subtotals(df).collect()}
    assert got == {
        (0, "north", "s1"): 17, (0, "north", None): 2, (0, None, "s2"): 4, (0, None, None): 8,
        (1, "north", None): 19, (1, None, None): 12, (3, None, None): 31}


def test_daily_mart_rewrites_touched_days_only(spark, tmp_path):
    def events(name, rows):
        df = spark.createDataFrame(rows, "t string, kind string, value double").withColumn("ts", F.to_timestamp("t")).drop("t")
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    out = str(tmp_path / "out")

    def run():
        schema = spark.read.parquet(str(tmp_path / "in")).schema
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        jobs.run_daily_mart(jobs.daily_mart(stream, ["kind"]), out, str(tmp_path / "state")).awaitTermination()
        return sorted((str(r[0]), *r[1:]) for r in jobs.read_daily_mart(spark, out, ["kind"]).collect())

    events("a", [("2024-01-01 05:00:00", "x", 1.0), ("2024-01-02 05:00:00", "x", 2.0), ("2024-01-02 06:00:00", "y", 3.0)])
    assert run() == [("2024-01-01", "x", 1, 1.0), ("2024-01-02", "x", 1, 2.0), ("2024-01-02", "y", 1, 3.0)]
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "out").glob("sale_date=*/*.parquet")}
    events("b", [("2024-01-02 09:00:00", "y", 4.0), ("2024-01-03 05:00:00", "x", 5.0)])
    assert run() == [("2024-01-01", "x", 1, 1.0), ("2024-01-02", "x", 1, 2.0), ("2024-01-02", "y", 2, 7.0), ("2024-01-03", "x", 1, 5.0)]
    after = {f: f.stat().st_mtime_ns for f in (tmp_path / "out").glob("sale_date=*/*.parquet")}
    assert {f.parent.name for f, _ in set(before.items()) ^ set(after.items())} == {"sale_date=2024-01-02", "sale_date=2024-01-03"}


def test_deliveries_of_the_latest_records_are_batches_of_many_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stored, "_scratch_path", lambda spark: str(tmp_path))
    sales = tpch.sales
    monkeypatch.setattr(tpch, "sales", lambda spark, folder: sales(spark, folder).repartition(5))
    got = catalog.QUERIES["stream_latest"](spark, DATA)
    # no delivery goes through a single task
    assert len(list((tmp_path / "in").glob("*.parquet"))) > 4
    assert sorted(p.name for p in (tmp_path / "out" / "changes").glob("batch=*")) == [f"batch={k}" for k in range(4)]
    want = catalog.QUERIES["etl_dedup_latest"](spark, DATA)
    assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()
