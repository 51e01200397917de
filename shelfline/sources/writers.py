"""Writers: staged files, layered tables, marts, reports and metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfline import schemas
from shelfline.session import COMPRESSION

# Calendar columns of at most a dozen values.
_FEW_VALUES = ("month", "quarter", "day_of_week", "is_weekend")


def write_stage(df: DataFrame, path: str, fmt: str = "parquet", partition_by: tuple[str, ...] = ("year", "month")) -> None:
    """Overwrite a stage, partitioned by calendar columns where it has them.

    Partitions that are few whatever the rows, such as months, are written by the tasks that hold the rows, without a
    shuffle.  Otherwise rows of one partition value are hashed by it and by day, so a month of a year is
    written by a few dozen tasks and neither by one task nor by all of them.
    """
    present = [c for c in partition_by if c in df.columns]
    if any(c not in _FEW_VALUES for c in present):
        spread = [c for c in ("day_of_month", "sale_date") if c in df.columns][:1]
        df = df.repartition(*present, *spread)
    writer = df.write.mode("overwrite").format(fmt)
    writer = writer.option("header", True) if fmt == "csv" else writer.option("compression", COMPRESSION)
    if present:
        writer = writer.partitionBy(*present)
    writer.save(path)


def create_layers(spark: SparkSession, prefix: str = "") -> list[str]:
    """The three databases: raw, cleaned and analytics; ``prefix`` goes before their names."""
    names = [prefix + name for name in schemas.LAYERS]
    for name in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    return names


def create_tables(spark: SparkSession, layer: str = "raw_data") -> list[str]:
    """Empty typed tables for the declared entities, where they do not exist yet."""
    created = []
    for name, schema in schemas.TABLES.items():
        table = f"{layer}.{name}"
        if not spark.catalog.tableExists(table):
            required = set(schemas.NOT_NULL.get(name, ())) | set(schemas.PRIMARY_KEY.get(name, ()))
            defaults = schemas.DEFAULTS.get(name, {})
            columns = ", ".join(
                f"{f.name} {f.dataType.simpleString()}{' NOT NULL' if f.name in required else ''}"
                + (f" DEFAULT {defaults[f.name]}" if f.name in defaults else "")
                for f in schema
            )
            spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet OPTIONS (compression '{COMPRESSION}')")
            created.append(table)
    return created


def create_table_as(
    df: DataFrame, table: str, bucket_by: Sequence[str] = (), sort_by: Sequence[str] = (), buckets: int | None = None
) -> bool:
    """Save ``df`` as a table unless the table exists; tells whether it was written.

    With ``bucket_by`` the rows are dealt into ``buckets`` (the shuffle partitions unless given) by the hash that
    Spark's joins and windows use, so that readers by these columns need no shuffle.  The planner
    leaves out the exchange for rows that come in these buckets.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        return False
    if not bucket_by:
        df.write.format("parquet").option("compression", COMPRESSION).saveAsTable(table)
        return True
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # one task a bucket, one file a bucket
    writer = df.repartition(buckets, *bucket_by).write.format("parquet").option("compression", COMPRESSION).bucketBy(buckets, *bucket_by)
    (writer.sortBy(*sort_by) if sort_by else writer).saveAsTable(table)
    return True


def refresh_marts(marts: Mapping[str, DataFrame], layer: str = "analytics") -> None:
    """Rewrite every mart table in full."""
    for name, df in marts.items():
        df.write.mode("overwrite").format("parquet").option("compression", COMPRESSION).saveAsTable(f"{layer}.{name}")


def write_report(results: Mapping[str, DataFrame], path: str) -> None:
    """Each named result as a folder of JSON lines under ``path``."""
    for name, df in results.items():
        df.write.mode("overwrite").json(f"{path}/{name}")


def write_metrics(metrics: DataFrame, path: str) -> None:
    """One row per model, as JSON and as CSV."""
    metrics.write.mode("overwrite").json(f"{path}/json")
    metrics.write.mode("overwrite").option("header", True).csv(f"{path}/csv")


def typed(df: DataFrame, table: str) -> DataFrame:
    """``df`` cast to a declared table's columns; missing ones have the table's default, else NULL."""
    defaults = schemas.DEFAULTS.get(table, {})
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.expr(defaults.get(f.name, "NULL"))).cast(f.dataType).alias(f.name)
        for f in schemas.TABLES[table]
    ])
