"""Streaming forms of ingest deduplication, demand rates, scoring and the daily mart.

The analytics they share with the batch jobs are the same functions.  Sinks are
files in a shared folder; nothing is gathered on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from shelfline.functions.joins import null_safe_join
from shelfline.operators import quality, scoring, sql_features
from shelfline.session import materialize, scratch_scope


def event_source(spark: SparkSession, path: str, schema, **options) -> DataFrame:
    """A file stream whose ``ts`` is a timestamp that watermarks accept.

    ``path`` is a folder or a pattern; a stream does not read a single file by name.
    """
    return spark.readStream.schema(schema).options(**options).parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))


def dedup(stream: DataFrame, keys: Sequence[str], ts: str = "ts", delay: str = "2 days") -> DataFrame:
    """Drop repeats of a key that arrive within ``delay``; the first arrival wins."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def demand_windows(
    stream: DataFrame, by: Sequence[str] = (), value: str = "value", ts: str = "ts",
    length: str = "7 days", slide: str = "1 day", delay: str = "1 day",
) -> DataFrame:
    """Count, total and mean per event-time window; with a slide equal to the length the windows do not overlap."""
    return (
        stream.withWatermark(ts, delay)
        .groupBy(F.window(ts, length, slide), *by)
        .agg(F.count("*").alias("n"), F.sum(value).alias("total"), F.avg(value).alias("rate"))
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *by, "n", "total", "rate")
    )


def demand_sessions(
    stream: DataFrame, by: Sequence[str], value: str = "value", ts: str = "ts", gap: str = "1 hour", delay: str = "1 day"
) -> DataFrame:
    """Bursts of demand that are separated by at least ``gap`` without an event."""
    return (
        stream.withWatermark(ts, delay)
        .groupBy(F.session_window(ts, gap), *by)
        .agg(F.count("*").alias("n"), F.sum(value).alias("total"))
        .select(
            F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"),
            *by, "n", "total",
        )
    )


def score_requests(stream: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(responses, quarantined requests) of a request stream."""
    valid, quarantine = quality.validate_requests(stream)
    return scoring.score(valid), quarantine


def run_to_files(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the stream's rows to files, taking what is available now."""
    return (
        df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start(path)
    )


def daily_mart(stream: DataFrame, by: Sequence[str], value: str = "value", ts: str = "ts", delay: str = "2 days") -> DataFrame:
    """Totals per day as a running aggregate, to be written in update mode."""
    return (
        stream.withWatermark(ts, delay)
        .groupBy(F.window(ts, "1 day"), *by)
        .agg(F.count("*").alias("num_transactions"), F.sum(value).alias("total_units"))
        .select(F.to_date("window.start").alias("sale_date"), *by, "num_transactions", "total_units")
    )


def run_daily_mart(mart: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keeps the days that a batch changes up to date in a table with a partition for each day.

    A change brings the whole total of its day and key, so it replaces the row that is there;
    a batch that is repeated after a failure replaces its own.  Other days are neither read nor written.
    """
    keys = [c for c in mart.columns if c not in ("num_transactions", "total_units")]
    schema = T.StructType([*[f for f in mart.schema if f.name != "sale_date"], mart.schema["sale_date"]])
    spark = mart.sparkSession
    spark.createDataFrame([], schema).write.mode("append").partitionBy("sale_date").parquet(path)
    spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{path}-columns")

    @scratch_scope()
    def write(changes: DataFrame, batch: int) -> None:
        new = materialize(changes.select(*schema.names))
        days = F.broadcast(new.select("sale_date").distinct())
        stored = changes.sparkSession.read.schema(schema).parquet(path).join(days, "sale_date", "left_semi").select(*schema.names)
        kept = null_safe_join(stored, new.select(*keys), keys, "left_anti")
        (
            materialize(kept.unionByName(new)).repartition("sale_date")
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("sale_date").parquet(path)
        )

    return (
        mart.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).foreachBatch(write).start()
    )


def read_daily_mart(spark: SparkSession, path: str, by: Sequence[str]) -> DataFrame:
    """The totals of each day and key; the cost does not depend on the number of batches."""
    schema = spark.read.parquet(f"{path}-columns").schema
    return spark.read.schema(schema).parquet(path).select("sale_date", *by, "num_transactions", "total_units")


_STORE_DAY = ("sale_date", "store_id", "region", "store_type")
_STORE_SUMS = {
    "num_transactions": "long", "total_units": "long", "total_revenue": "decimal(38,2)", "units_known": "long",
    "ratio_sum": "double", "ratio_known": "long",
}
_STORE_SCHEMA = ", ".join(
    ["store_id string, region string, store_type string"]
    + [f"{name} {kind}" for name, kind in _STORE_SUMS.items()] + ["batch long, sale_date date"]
)


@scratch_scope()
def merge_store_days(sales: DataFrame, batch: int, path: str) -> None:
    """Adds a batch of enriched sales to the stored sums per day and store.

    Only the days that the batch touches are read, and rewritten whole.  A day
    knows the last batch it took, so a batch that is repeated after a failure,
    even one that had written some of its days, counts once.
    """
    spark = sales.sparkSession
    rows = sql_features.price_ratio(sales.filter("sale_date IS NOT NULL"))
    found = materialize(rows.groupBy(*_STORE_DAY).agg(
        F.count("*").alias("num_transactions"), F.sum("units_sold").alias("total_units"),
        F.sum("revenue").cast("decimal(38,2)").alias("total_revenue"), F.count("units_sold").alias("units_known"),
        F.sum("price_ratio").alias("ratio_sum"), F.count("price_ratio").alias("ratio_known"),
    ))
    # at most one row per calendar day, which also prunes the stored partitions
    days = F.broadcast(found.select("sale_date").distinct())
    stored = spark.read.schema(_STORE_SCHEMA).parquet(path).join(days, "sale_date", "left_semi")
    taken = F.broadcast(stored.filter(F.col("batch") >= batch).select("sale_date").distinct())
    both = found.unionByName(stored.drop("batch")).join(taken, "sale_date", "left_anti")
    merged = both.groupBy(*_STORE_DAY).agg(*[F.sum(c).cast(kind).alias(c) for c, kind in _STORE_SUMS.items()])
    (
        materialize(merged.withColumn("batch", F.lit(batch).cast("long"))).repartition("sale_date")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("sale_date").parquet(path)
    )


def run_store_mart(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keeps the daily store mart up to date from a stream of enriched sales, late days included."""
    empty = stream.sparkSession.createDataFrame([], _STORE_SCHEMA)
    empty.write.mode("append").partitionBy("sale_date").parquet(path)
    return (
        stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
        .foreachBatch(lambda rows, batch: merge_store_days(rows, batch, path)).start()
    )


def read_store_mart(spark: SparkSession, path: str) -> DataFrame:
    """The mart as ``marts.daily_store_demand`` has it; the cost does not depend on the number of batches."""
    return spark.read.schema(_STORE_SCHEMA).parquet(path).select(
        *_STORE_DAY, "num_transactions", "total_units", "total_revenue",
        F.try_divide("total_units", "units_known").alias("avg_units"),
        F.try_divide("ratio_sum", "ratio_known").alias("avg_price_ratio"),
    )
