"""Readers, writers, tables and both tracks end to end."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from conftest import DATA
from shelfline import schemas
from shelfline.operators import features, modeling, quality
from shelfline.plans import pipelines
from shelfline.sources import readers, tpch, writers


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    sales = tpch.raw_sales(spark, DATA)
    sales.toDF(*[c.replace("_", " ").title() for c in sales.columns]).write.option("header", True).csv(f"{folder}/sales.csv")
    tpch.stores(spark, DATA).write.option("header", True).csv(f"{folder}/stores.csv")
    tpch.brands(spark, DATA).write.option("header", True).csv(f"{folder}/products.csv")
    return str(folder)


def test_sales_reader(spark, raw, tmp_path):
    df = readers.read_sales(spark, candidates=[f"{raw}/retail_sales.csv", f"{raw}/sales.csv"])
    assert sorted(df.columns) == sorted(schemas.SALES_CSV.fieldNames())
    assert dict(df.dtypes)["units_sold"] == "double" and df.count() == tpch.raw_sales(spark, DATA).count()
    with pytest.raises(FileNotFoundError):
        readers.read_sales(spark, candidates=[str(tmp_path / "none.csv")])


def test_nan_is_missing(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text("Store ID,Units Sold,Note\nS1,NaN,x\nS2,3,y\n")
    rows = {r["store_id"]: r for r in readers.read_sales(spark, str(path)).collect()}
    assert rows["S1"]["units_sold"] is None and rows["S2"]["units_sold"] == 3.0 and rows["S2"]["note"] == "y"


def test_optional_dimensions(spark, raw, tmp_path):
    assert readers.read_stores(spark, f"{raw}/stores.csv").count() == 10
    assert readers.read_products(spark, f"{raw}/products.csv").schema["base_price"].dataType == schemas.PRODUCTS["base_price"].dataType
    assert readers.read_stores(spark, str(tmp_path / "none.csv")) is None


def test_missing_stage(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        readers.read_stage(spark, str(tmp_path / "none"))


def test_stage_is_pruned_by_partition(spark, tmp_path):
    df = spark.createDataFrame([(2023, 1, "a"), (2024, 2, "b")], "year int, month int, v string")
    writers.write_stage(df, str(tmp_path / "stage"))
    rows = readers.read_stage(spark, str(tmp_path / "stage")).filter("year = 2024")
    assert "PartitionFilters: [isnotnull(year" in rows._jdf.queryExecution().executedPlan().toString()
    assert [r["v"] for r in rows.collect()] == ["b"]
    writers.write_stage(df, str(tmp_path / "text"), fmt="csv", partition_by=())
    assert spark.read.option("header", True).csv(str(tmp_path / "text")).count() == 2


def test_months_are_written_where_the_rows_are(spark, tmp_path):
    df = spark.range(0, 60, 1, 3).selectExpr("id", "2024 AS year", "CAST(id % 2 + 1 AS INT) AS month", "1 AS day_of_month")
    files = {}
    for by in (("month",), ("year", "month")):
        path = tmp_path / "_".join(by)
        writers.write_stage(df, str(path), partition_by=by)
        files[by] = [p.name for p in path.rglob("month=1/*.parquet")]
        assert sorted(r["id"] for r in readers.read_stage(spark, str(path)).collect()) == list(range(60))
    assert len(files["month",]) == 3 and len(files["year", "month"]) == 1
    assert all(name.endswith(".zstd.parquet") for name in files["month",])


def test_parts_follow_the_size_of_the_files(spark, tmp_path, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    spark.range(100_000).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t")).filter("id > 3")
    assert readers.parts_for(df) == cores
    monkeypatch.setattr(readers, "PART_BYTES", 1000)
    assert readers.MAX_PARTS > readers.parts_for(df) > cores
    assert readers.parts_for(spark.createDataFrame(spark.sparkContext.parallelize([(1,)]), "a int")) == 4


def test_frame_track(spark, raw, tmp_path):
    models = {"boosted_trees": modeling.boosted_trees(trees=3, depth=3), "linear": modeling.linear_model()}
    paths = pipelines.run_frame_track(spark, raw, str(tmp_path), models=models)
    assert spark.read.parquet(paths["features"]).count() == 5799
    encoded = spark.read.parquet(paths["encoded"])
    assert encoded.count() == 5799 and "store_id" not in encoded.columns
    assert {r["check"] for r in spark.read.json(paths["quality"]).filter("passed").collect()} >= {"no_nulls", "no_negative_units"}
    assert spark.read.json(f"{paths['inventory']}/top_k_stockout").count() == 20
    metrics = {r["model"]: r for r in spark.read.json(f"{paths['metrics']}/json").collect()}
    assert set(metrics) == set(models)
    weights = spark.read.json(f"{paths['importance']}/boosted_trees").collect()
    used = {r["feature"] for r in weights}
    assert abs(sum(r["importance"] for r in weights) - 1) < 1e-9 and "lag_1d" in used and not used & {"units_sold", "revenue"}
    test = features.encode_features(modeling.date_split(spark.read.parquet(paths["features"]))[1])
    again = modeling.regression_metrics(PipelineModel.load(paths["model"]).transform(test)).first()
    best = max(metrics.values(), key=lambda r: r["r2"])
    assert abs(again["r2"] - best["r2"]) < 1e-3


def test_warehouse_track(spark):
    assert writers.create_layers(spark) == ["raw_data", "cleaned_data", "analytics"]
    created = writers.create_tables(spark)
    assert len(created) == 4 and writers.create_tables(spark) == []
    assert spark.table("raw_data.competitor_prices").columns == schemas.COMPETITOR_PRICES.fieldNames()
    writers.typed(tpch.sales(spark, DATA), "sales").write.insertInto("raw_data.sales")
    writers.typed(tpch.stores(spark, DATA), "stores").write.insertInto("raw_data.stores")
    writers.typed(tpch.brands(spark, DATA), "products").write.insertInto("raw_data.products")
    tables = pipelines.run_warehouse_track(spark)
    counts = {t: spark.table(t).count() for t in tables}
    assert counts["cleaned_data.sales_enriched"] == 5892 and counts["analytics.mv_category_demand"] == 6
    assert pipelines.run_warehouse_track(spark) == tables
    assert not writers.create_table_as(spark.range(1), "analytics.demand_features")


def test_missing_columns_take_the_declared_default(spark):
    rows = spark.createDataFrame([("P1", "Toys")], "product_id string, category string")
    got = writers.typed(rows, "products").first()
    assert (got["is_perishable"], got["base_price"]) == (0, None)
    given = writers.typed(rows.withColumn("is_perishable", F.lit(None).cast("short")), "products").first()
    assert given["is_perishable"] is None
    layer = writers.create_layers(spark, "defaults_")[0]
    writers.create_tables(spark, layer)
    spark.sql(f"INSERT INTO {layer}.products (product_id) VALUES ('P2')")
    assert spark.table(f"{layer}.products").first()["is_perishable"] == 0


def test_table_rules(spark, day):
    rows = [(day("2024-01-01"), "S1", "P1", "Toys"), (None, "S1234567890", "P1", "Toys")]
    df = spark.createDataFrame(rows, "sale_date date, store_id string, product_id string, category string")
    _, bad = quality.validate(df, quality.table_rules("sales"))
    assert [r["violations"] for r in bad.collect()] == [["sale_date_not_null", "store_id_length"]]
    keys = quality.duplicate_keys(df.withColumn("id", F.lit(1)), schemas.PRIMARY_KEY["sales"])
    assert [(r["id"], r["n"]) for r in keys.collect()] == [(1, 2)]


def _line_items(spark, path, n):
    """Line items of 200 orders over three parts, in one file."""
    spark.range(n).selectExpr(
        "id % 200 AS l_orderkey", "id % 3 AS l_partkey", "id % 5 AS l_suppkey", "CAST(id % 7 + 1 AS INT) AS l_linenumber",
        "CAST(id % 50 + 1 AS DOUBLE) AS l_quantity", "CAST(id * 10 AS DOUBLE) AS l_extendedprice", "0.05D AS l_discount",
        "0.01D AS l_tax", "'N' AS l_returnflag", "'O' AS l_linestatus",
        "timestamp_ntz'1996-03-01 00:00:00' + make_interval(0, 0, 0, CAST(id % 90 AS INT)) AS l_shipdate",
    ).coalesce(1).write.parquet(f"{path}/lineitem.parquet")
    spark.range(3).selectExpr(
        "id AS p_partkey", "'n' AS p_name", "concat('Brand#', id) AS p_brand", "'T' AS p_type", "1 AS p_size", "10.5D AS p_retailprice"
    ).write.parquet(f"{path}/part.parquet")


@pytest.mark.parametrize("build", [tpch.raw_sales, tpch.requests])
def test_parts_of_a_spread_table_have_a_bounded_size(spark, tmp_path, monkeypatch, build):
    path = str(tmp_path)
    _line_items(spark, path, 3000)
    whole = build(spark, path)
    size = tpch.stored_bytes(spark.read.schema(tpch.TABLES["lineitem"]).parquet(f"{path}/lineitem.parquet"))
    cores = spark.sparkContext.defaultParallelism
    monkeypatch.setattr(tpch, "SPREAD_PART_BYTES", size // 25, raising=False)
    for limit in (size, 0):  # a small table and one that used to be read as it is, in splits of any number of rows
        monkeypatch.setattr(tpch, "MAX_SPREAD_BYTES", limit)
        rows = build(spark, path)
        assert rows.rdd.getNumPartitions() >= 25 > cores
        assert rows.exceptAll(whole).count() == 0 == whole.exceptAll(rows).count()
