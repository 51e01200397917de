"""Streams over several micro-batches against their batch counterparts."""

import datetime

import pytest
from pyspark.sql import functions as F

from conftest import DATA
from shelfline.operators import marts, quality, scoring, sql_features
from shelfline.sources import tpch
from shelfline.streaming import jobs


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    """The events as ten files in order of time, read one per batch."""
    path = str(tmp_path_factory.mktemp("events"))
    events = spark.read.parquet(f"{DATA}/events.parquet").orderBy("ts").toPandas()
    size = len(events) // 10
    for i in range(10):
        piece = events.iloc[i * size:(i + 1) * size if i < 9 else None]
        spark.createDataFrame(piece).coalesce(1).write.mode("append").parquet(path)
    return path


def stream(spark, path):
    return jobs.event_source(spark, path, spark.read.parquet(path).schema, maxFilesPerTrigger=1)


def test_dedup(spark, parts, tmp_path):
    keys = ["user_id", "event_type", "day"]
    source = stream(spark, parts).withColumn("day", F.to_date("ts"))
    jobs.run_to_files(jobs.dedup(source, keys), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    batch = tpch.events(spark, DATA).withColumn("day", F.to_date("ts"))
    assert got.count() == batch.select(keys).distinct().count()


@pytest.mark.parametrize("length, slide", [("7 days", "1 day"), ("1 day", "1 day")])
def test_windows(spark, parts, tmp_path, length, slide):
    df = jobs.demand_windows(stream(spark, parts), ["event_type"], length=length, slide=slide)
    jobs.run_to_files(df, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    got = spark.read.schema(df.schema).parquet(str(tmp_path / "out"))
    events = tpch.events(spark, DATA)
    closed = events.agg(F.max("ts")).first()[0] - datetime.timedelta(days=1)
    batch = events.groupBy(F.window("ts", length, slide), "event_type").agg(F.count("*").alias("n")).filter(
        F.col("window.end") <= F.lit(closed))
    expected = {(r["window"]["start"], r["event_type"], r["n"]) for r in batch.collect()}
    assert {(r["window_start"], r["event_type"], r["n"]) for r in got.collect()} == expected


def test_daily_mart_keeps_the_latest_totals(spark, parts, tmp_path):
    out = str(tmp_path / "out")
    jobs.run_daily_mart(jobs.daily_mart(stream(spark, parts), ["event_type"]), out, str(tmp_path / "state")).awaitTermination()
    got = {(r["sale_date"], r["event_type"]): r["num_transactions"] for r in jobs.read_daily_mart(spark, out, ["event_type"]).collect()}
    batch = tpch.events(spark, DATA).groupBy(F.to_date("ts").alias("d"), "event_type").count().collect()
    assert got == {(r["d"], r["event_type"]): r["count"] for r in batch}


def test_store_mart_takes_late_rows_and_each_batch_once(spark, tmp_path):
    source, out, shared = str(tmp_path / "in"), str(tmp_path / "out"), ["sale_date", "store_id"]
    sales = tpch.sales(spark, DATA).filter("sale_date < '1996-04-01' AND store_id IN ('S1', 'S2', 'S3')")
    rows = sales.join(tpch.stores(spark, DATA), "store_id", "left")
    for part in range(3):  # every file holds rows of the same days
        rows.filter(F.pmod("id", F.lit(3)) == part).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
    jobs.run_store_mart(stream, out, str(tmp_path / "state")).awaitTermination()

    def stored():
        return sorted(jobs.read_store_mart(spark, out).select(
            *shared, "num_transactions", "total_units", "total_revenue", F.round("avg_units", 9), F.round("avg_price_ratio", 9)).collect())

    batch = marts.daily_store_demand(sql_features.price_ratio(rows)).select(
        *shared, "num_transactions", "total_units", "total_revenue", F.round("avg_units", 9), F.round("avg_price_ratio", 9))
    expected = sorted(batch.collect())
    assert stored() == expected and expected
    # the last batch again, as after a failure
    jobs.merge_store_days(rows.filter(F.pmod("id", F.lit(3)) == 2), 2, out)
    assert stored() == expected
    # a late row of one day leaves the files of the others alone
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "out").glob("sale_date=*/*.parquet")}
    late = rows.filter(F.col("sale_date") == F.lit(expected[0][0])).limit(1)
    jobs.merge_store_days(late, 3, out)
    after = {f: f.stat().st_mtime_ns for f in (tmp_path / "out").glob("sale_date=*/*.parquet")}
    changed = {file.parent.name for file, _ in set(before.items()) ^ set(after.items())}
    assert changed == {f"sale_date={expected[0][0]}"}
    assert sum(r[2] for r in stored()) == sum(r[2] for r in expected) + 1


def test_scoring(spark, tmp_path):
    responses, quarantine = jobs.score_requests(tpch.requests(spark, DATA, streaming=True))
    for name, df in (("good", responses), ("bad", quarantine)):
        jobs.run_to_files(df, str(tmp_path / name), str(tmp_path / f"{name}-state")).awaitTermination()
    valid, bad = quality.validate_requests(tpch.requests(spark, DATA))
    batch = scoring.score(valid)
    got = spark.read.schema(batch.schema).parquet(str(tmp_path / "good"))
    assert got.exceptAll(batch).count() == 0 == batch.exceptAll(got).count()
    assert spark.read.parquet(str(tmp_path / "bad")).count() == bad.count() > 0
