"""Latest record wins over arriving batches."""

import itertools

import pytest
from pyspark.sql import functions as F

from conftest import DATA
from shelfline.operators import etl
from shelfline.sources import tpch
from shelfline.streaming import latest


@pytest.fixture(scope="module")
def sales(spark):
    return tpch.sales(spark, DATA).filter("pmod(id, 40) IN (7, 8, 13)").cache()


def same(left, right):
    right = right.select(*left.columns)
    return left.exceptAll(right).count() == 0 == right.exceptAll(left).count()


def deliveries(sales):
    """The records, corrections that come later, and stale records that come too late."""
    newer = sales.filter("pmod(id, 3) = 0").withColumns({"units_sold": F.col("units_sold") + 5, "loaded_at": F.expr("loaded_at + INTERVAL 90 DAYS")})
    stale = sales.filter("pmod(id, 5) = 0").withColumns({"units_sold": F.lit(999), "loaded_at": F.expr("loaded_at - INTERVAL 90 DAYS")})
    return [sales, newer, stale]


@pytest.mark.parametrize("order", list(itertools.permutations(range(3)))[1::4])
def test_any_order_of_batches_equals_one_pass(spark, sales, tmp_path, order):
    path, parts = str(tmp_path / "table"), deliveries(sales)
    want = etl.latest_record(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    latest.create(sales, path)
    for number, k in enumerate(order):
        latest.upsert(parts[k], number, path, slots=8)
    assert same(latest.read_latest(spark, path), want)
    latest.upsert(parts[order[1]].repartition(3), 1, path, slots=8)  # repeated
    assert same(latest.read_latest(spark, path), want)


def test_changes_tell_what_is_replaced(spark, sales, tmp_path):
    path, (first, newer, stale) = str(tmp_path / "table"), deliveries(sales)
    latest.create(sales, path)
    for number, rows in enumerate([first, newer, stale, newer]):
        latest.upsert(rows, number, path, slots=8)
    told = {r.batch: (r.n, r.r) for r in latest.read_changes(spark, path).groupBy("batch").agg(
        F.count("*").alias("n"), F.count_if("replaces").alias("r")).collect()}
    keys = etl.latest_record(first).count()
    replaced = etl.latest_record(first.unionByName(newer)).exceptAll(etl.latest_record(first)).count()
    assert told[0] == (keys, 0) and told[1] == (replaced, replaced) and 2 not in told and 3 not in told
    # the change log alone gives the table
    rows = latest.read_changes(spark, path)
    again = etl.latest_record(rows.drop("batch", "replaces"), tie_breakers=[c for c in sales.columns if c not in etl.KEY and c != "loaded_at"])
    assert same(again.select(*sales.columns), latest.read_latest(spark, path))


def test_a_batch_touches_its_own_slots(spark, sales, tmp_path):
    path = tmp_path / "table"
    latest.create(sales, str(path))
    latest.upsert(sales, 0, str(path), slots=16)
    before = {f: f.stat().st_mtime_ns for f in path.glob("records/slot=*/*.parquet")}
    one = sales.limit(1).withColumn("loaded_at", F.expr("loaded_at + INTERVAL 9 DAYS")).filter("loaded_at IS NOT NULL")
    latest.upsert(one, 1, str(path), slots=16)
    after = {f: f.stat().st_mtime_ns for f in path.glob("records/slot=*/*.parquet")}
    assert len({f.parent for f, _ in set(before.items()) ^ set(after.items())}) <= 1


def test_a_batch_that_stopped_after_its_changes(spark, sales, tmp_path):
    path, (first, newer, _) = str(tmp_path / "table"), deliveries(sales)
    latest.create(sales, path)
    latest.upsert(first, 0, path, slots=8)
    whole = str(tmp_path / "whole")
    latest.create(sales, whole)
    latest.upsert(first, 0, whole, slots=8)
    latest.upsert(newer, 1, whole, slots=8)
    spark.read.parquet(f"{whole}/changes/batch=1").write.parquet(f"{path}/changes/batch=1")
    latest.upsert(newer, 1, path, slots=8)
    assert same(latest.read_latest(spark, path), latest.read_latest(spark, whole))


def test_stream_out_of_order(spark, sales, tmp_path):
    source = str(tmp_path / "in")
    parts = deliveries(sales)
    for rows in (parts[2], parts[1], parts[0]):
        rows.coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(sales.schema).option("maxFilesPerTrigger", 1).parquet(source)
    latest.run_latest(stream, str(tmp_path / "out"), str(tmp_path / "state"), slots=8).awaitTermination()
    want = etl.latest_record(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    assert same(latest.read_latest(spark, str(tmp_path / "out")), want)


def test_null_keys_and_no_rows(spark, tmp_path):
    rows = [(None, "a", 1, None), (None, "a", 2, None), (None, "b", 1, None), ("x", None, 4, None)]
    df = spark.createDataFrame(rows, "k string, p string, n int, loaded_at timestamp")
    path = str(tmp_path / "t")
    latest.create(df, path)
    latest.upsert(df.limit(0), 0, path, ["k", "p"])
    latest.upsert(df, 1, path, ["k", "p"])
    latest.upsert(df, 2, path, ["k", "p"])
    assert sorted(map(tuple, latest.read_latest(spark, path).collect()), key=str) == sorted([rows[1], rows[2], rows[3]], key=str)
