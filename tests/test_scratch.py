"""Scratch folders go when the work that wrote them is done."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import DATA
from shelfline.operators import mart_state
from shelfline.session import materialize, materialize_in_buckets, scratch_dir, scratch_scope
from shelfline.sources import tpch
from shelfline.streaming import latest, spikes


def folders(spark):
    place = scratch_dir(spark).removeprefix("file:") + "/shelfline"
    return set(os.listdir(place)) if os.path.isdir(place) else set()


def test_a_scope_deletes_what_it_wrote(spark):
    before = folders(spark)
    outside = materialize(spark.range(3))
    with scratch_scope():
        assert materialize(spark.range(5)).count() == 5
        with scratch_scope():
            materialize(spark.range(2))
            assert len(folders(spark) - before) == 3
        assert len(folders(spark) - before) == 2
    assert len(folders(spark) - before) == 1 and outside.count() == 3
    materialize(spark.range(1))
    assert len(folders(spark) - before) == 2


def test_buckets_are_read_without_a_shuffle_and_leave_no_table(spark):
    before, tables = folders(spark), spark.catalog.listTables()
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0), (None, 1, 3.0), (None, 1, 3.0), (None, None, None)], "k string, i int, x double")
    with scratch_scope():
        rows = materialize_in_buckets(df, 3, ["k"], ["k", "i"])
        assert rows.schema == df.schema and sorted(rows.collect(), key=str) == sorted(df.collect(), key=str)
        sums = rows.groupBy("i", "k").agg(F.sum("x").alias("x"))
        assert "Exchange" not in sums._jdf.queryExecution().executedPlan().toString()
        assert {tuple(r) for r in sums.collect()} == {(1, "a", 1.0), (2, "a", 2.0), (1, None, 6.0), (None, None, None)}
        assert spark.catalog.listTables() == tables and len(folders(spark) - before) == 1
    assert folders(spark) == before


def test_a_failure_leaves_nothing(spark):
    before = folders(spark)

    @scratch_scope()
    def work():
        materialize(spark.range(2))
        materialize(spark.range(2).select(F.raise_error(F.lit("lost")).alias("x")))

    for _ in range(2):
        with pytest.raises(Exception, match="lost"):
            work()
    assert folders(spark) == before


def test_batches_leave_nothing(spark, tmp_path):
    sales = tpch.sales(spark, DATA).filter("pmod(id, 50) = 3").cache()
    latest.create(sales, str(tmp_path / "latest"))
    before = folders(spark)
    for batch in range(2):
        latest.upsert(sales, batch, str(tmp_path / "latest"), slots=4)
        spikes.update(sales, batch, str(tmp_path / "spikes"), ["store_id"], "units_sold")
    assert folders(spark) == before
    assert latest.read_latest(spark, str(tmp_path / "latest")).count() > 0
    assert spikes.flagged(spark, str(tmp_path / "spikes"), ["store_id"], "units_sold").count() == 2 * sales.count()


def test_marts_leave_nothing(spark, tmp_path):
    path = str(tmp_path / "marts")
    new = spark.createDataFrame([(1, "a", 3), (2, "b", 4)], "slot long, k string, n long")
    before = folders(spark)
    for batch in range(2):
        mart_state.merge_slots(new, ["k"], {"n": F.sum("n")}, batch, path)
    assert folders(spark) == before
    assert {(r["k"], r["n"]) for r in spark.read.parquet(path).collect()} == {("a", 6), ("b", 8)}
