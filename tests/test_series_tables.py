"""Bucketed warehouse tables: loads, the latest record, and features without a shuffle."""

import re
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import DATA
from shelfline.operators import etl, sql_features
from shelfline.plans import pipelines
from shelfline.session import settings
from shelfline.sources import series_tables, tpch, writers


@pytest.fixture(scope="module")
def sales(spark):
    return tpch.sales(spark, DATA).cache()


@pytest.fixture
def table(spark):
    layer = f"t{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {layer}")
    yield f"{layer}.sales"
    spark.sql(f"DROP DATABASE {layer} CASCADE")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def same(left, right):
    right = right.select(*left.columns)
    return left.exceptAll(right).count() == 0 == right.exceptAll(left).count()


def load_all(spark, sales, table, parts=3, buckets=5):
    series_tables.create_series_table(spark, table, sales.schema, buckets)
    for k in range(parts):
        series_tables.add_load(sales.filter(F.pmod("id", F.lit(parts)) == k), table, f"part-{k}")


def test_loads_append_and_repeat(spark, sales, table):
    load_all(spark, sales, table)
    assert same(spark.table(table).drop(series_tables.LOAD), sales)
    before = set(spark.table(table).inputFiles())
    series_tables.add_load(sales.filter("pmod(id, 3) = 1").repartition(7), table, "part-1")  # again, as after a failure
    assert same(spark.table(table).drop(series_tables.LOAD), sales)
    kept = before & set(spark.table(table).inputFiles())
    assert sum("part-1" in f.split("/")[-2] for f in before - kept) == len(before - kept)
    series_tables.add_load(sales.filter("pmod(id, 3) = 0"), table, "more")
    assert spark.table(table).count() == sales.count() + sales.filter("pmod(id, 3) = 0").count()
    assert sorted(r[0] for r in series_tables.loads(spark, table).collect()) == ["more", "part-0", "part-1", "part-2"]
    series_tables.add_load(sales.limit(0), table, "more")
    assert same(spark.table(table).drop(series_tables.LOAD), sales)
    with pytest.raises(ValueError):
        series_tables.add_load(sales, table, "no' name")
    assert series_tables.layout(spark, table) == (5, ["store_id", "product_id"])


def test_latest_and_features_need_no_shuffle(spark, sales, table):
    load_all(spark, sales, table)
    # a second delivery of some records, loaded later
    newer = sales.filter("id % 7 = 0").withColumns({"units_sold": F.col("units_sold") + 1, "loaded_at": F.expr("loaded_at + INTERVAL 100 DAYS")})
    series_tables.add_load(newer, table, "corrections")
    everything = sales.unionByName(newer)
    latest = series_tables.latest_records(spark, table)
    assert "Exchange" not in plan_of(latest)
    assert same(latest, etl.latest_record(everything))
    features = series_tables.series_features(spark, table)
    assert "Exchange" not in plan_of(features) and "Window" in plan_of(features)
    want = sql_features.bands(sql_features.price_ratio(sql_features.rolling(sql_features.lags(etl.latest_record(everything)))))
    assert same(features, want)
    stored = table.replace(".sales", ".features")
    series_tables.append_features(spark, table, stored, "one")
    series_tables.append_features(spark, table, stored, "one")
    assert spark.table(stored).count() == features.count()
    again = sql_features.rolling(spark.table(stored).drop(*[c for c in features.columns if c.startswith("rolling")]))
    assert "Exchange" not in plan_of(again)


def test_hot_series_and_nulls(spark, table):
    rows = [(None if i % 11 == 0 else "S1", "P1" if i % 3 else None, i) for i in range(400)]
    df = spark.createDataFrame(rows, "store_id string, product_id string, n int").withColumn("sale_date", F.date_add(F.lit("2024-01-01"), F.col("n")))
    series_tables.create_series_table(spark, table, df.schema, 4)
    series_tables.add_load(df, table, "all")
    assert same(spark.table(table).drop(series_tables.LOAD), df)


def test_warehouse_track_stores_its_tables_in_buckets(spark, sales):
    prefix = f"w{uuid.uuid4().hex}_"
    layer = writers.create_layers(spark, prefix)[0]
    writers.create_tables(spark, layer)
    for name, df in (("sales", sales), ("stores", tpch.stores(spark, DATA)), ("products", tpch.brands(spark, DATA))):
        writers.typed(df, name).write.insertInto(f"{layer}.{name}")
    enriched, features, *_ = pipelines.run_warehouse_track(spark, prefix)
    for name in (enriched, features):
        assert series_tables.layout(spark, name)[1] == ["store_id", "product_id"]
        lags = sql_features.lags(spark.table(name).select("sale_date", "store_id", "product_id", "units_sold"))
        assert "Exchange" not in plan_of(lags)
    for name in ("raw_data", "cleaned_data", "analytics"):
        spark.sql(f"DROP DATABASE {prefix}{name} CASCADE")


def test_rank_in_buckets_equals_the_rank(spark, day):
    rows = [(day("2024-01-01"), s, p, u) for s, p, u in [
        ("S1", "P1", 5), ("S1", "P2", None), ("S1", "P3", 7), ("S1", "P4", 5), ("S1", "P4", 5), ("S1", "P4", 6), ("S1", "P4", None), (None, "P1", 3)]]
    rows.append((None, "S1", "P1", 9))
    schema = "sale_date date, store_id string, product_id string, units_sold int"
    for extra in ([], [(day("2024-01-01"), "S1", None, 6)]):
        df = spark.createDataFrame(rows + extra, schema)
        got = sql_features.demand_rank_by_series(df)
        assert got.count() == df.count() and same(sql_features.demand_rank(df), got)


def test_warehouse_track_deals_sales_into_buckets_once(spark, sales, monkeypatch):
    prefix, plans = f"w{uuid.uuid4().hex}_", {}
    layer = writers.create_layers(spark, prefix)[0]
    writers.create_tables(spark, layer)
    for name, df in (("sales", sales), ("stores", tpch.stores(spark, DATA)), ("products", tpch.brands(spark, DATA))):
        writers.typed(df, name).write.insertInto(f"{layer}.{name}")
    plain = writers.create_table_as

    def seen(df, table, *args, buckets=None):
        plans[table.split(".")[1]] = plan_of(df.repartition(buckets or 4, *sql_features.SERIES))
        return plain(df, table, *args, buckets=buckets)

    monkeypatch.setattr(writers, "create_table_as", seen)
    with settings(spark, {"spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        pipelines.run_warehouse_track(spark, prefix)
    moved = {name: len(re.findall(r"Exchange hashpartitioning", plan)) for name, plan in plans.items()}
    held = next(name for name in moved if name not in ("sales_enriched", "demand_features"))
    # for the features only day, series and units, there and back
    assert (moved[held], moved["sales_enriched"], moved["demand_features"]) == (1, 0, 2)
    assert [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {prefix}cleaned_data").collect()] == ["sales_enriched"]
    assert spark.conf.get("spark.sql.sources.bucketing.autoBucketedScan.enabled") == "true"
    for name in ("raw_data", "cleaned_data", "analytics"):
        spark.sql(f"DROP DATABASE {prefix}{name} CASCADE")
