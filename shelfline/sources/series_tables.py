"""Warehouse tables laid out for series: bucketed by store and product, sorted by date, filled load by load.

A bucketed table is read in its buckets, so that whatever is worked out by
series (the latest record of a day, lags, rolling windows) takes no shuffle, however many loads the table has.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from shelfline.operators import etl, sql_features

SERIES = ("store_id", "product_id")
LOAD = "load_name"


def create_series_table(
    spark: SparkSession, table: str, schema: T.StructType, buckets: int, keys: Sequence[str] = SERIES, sort: str = "sale_date"
) -> None:
    """An empty table with the columns of ``schema`` and a partition for each load, unless it exists.

    ``buckets`` is the number of tasks that read it: about the table's final size over what one task should hold.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}, {LOAD} STRING) USING parquet PARTITIONED BY ({LOAD}) "
        f"CLUSTERED BY ({', '.join(keys)}) SORTED BY ({sort}) INTO {buckets} BUCKETS")


def _described(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE FORMATTED {table}").collect()}


def layout(spark: SparkSession, table: str) -> tuple[int, list[str]]:
    """Number of buckets of a table and the columns they are made of."""
    found = _described(spark, table)
    return int(found["Num Buckets"]), re.findall(r"`([^`]+)`", found["Bucket Columns"])


def add_load(df: DataFrame, table: str, load: str) -> None:
    """Writes ``df`` as the load of this name; a load that is repeated replaces itself, others stay as they are.

    Rows are dealt by the table's own hash, so each task writes one file of one bucket.  A series is
    bounded by the calendar, so no bucket can be filled by one of them.
    """
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", load):
        raise ValueError(f"not a load name: {load!r}")
    spark = df.sparkSession
    buckets, keys = layout(spark, table)
    columns = [c for c in spark.table(table).columns if c != LOAD]
    rows = df.select(*columns).repartition(buckets, *keys)
    names = ", ".join(f"`{c}`" for c in columns)
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({LOAD} = '{load}') SELECT {names} FROM {{rows}}", rows=rows)


def loads(spark: SparkSession, table: str) -> DataFrame:
    """Names of the loads that the table has."""
    return spark.sql(f"SHOW PARTITIONS {table}").select(F.regexp_extract("partition", "=(.*)", 1).alias(LOAD))


def latest_records(spark: SparkSession, table: str, keys: Sequence[str] = etl.KEY, loaded_at: str = "loaded_at") -> DataFrame:
    """The record of each key that was loaded last, over all loads, without a shuffle.

    The columns of the buckets are among ``keys``, so all records of a key are in one bucket.
    """
    rows = spark.table(table).drop(LOAD)
    return etl.latest_record(rows, keys, loaded_at)


def series_features(spark: SparkSession, table: str) -> DataFrame:
    """Lags, rolling windows, price ratio and risk classes of the latest records, read in the table's buckets."""
    rows = latest_records(spark, table)
    return sql_features.bands(sql_features.price_ratio(sql_features.rolling(sql_features.lags(rows))))


def append_features(spark: SparkSession, table: str, into: str, load: str) -> None:
    """Stores the features of ``table`` in a table of the same buckets, as one load."""
    rows = series_features(spark, table)
    buckets, keys = layout(spark, table)
    create_series_table(spark, into, rows.schema, buckets, keys)
    add_load(rows, into, load)
