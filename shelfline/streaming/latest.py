"""Latest record wins, for arriving data: an upsert table in which a newer record replaces an earlier answer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from shelfline.functions.joins import null_safe_join
from shelfline.operators import etl
from shelfline.session import materialize, scratch_scope
from shelfline.sources.readers import path_exists

SLOTS = 64


def _slot(keys: Sequence[str], slots: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(slots)).cast("int")


def create(df: DataFrame, path: str) -> None:
    """An empty table for records like ``df``, unless there is one."""
    empty = df.sparkSession.createDataFrame([], df.schema)
    empty.write.mode("ignore").parquet(f"{path}/columns")  # one file without rows, which keeps the schema
    empty.withColumn("slot", F.lit(0)).write.mode("append").partitionBy("slot").parquet(f"{path}/records")


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("slot", T.IntegerType())])).option("basePath", f"{path}/records").parquet(f"{path}/records")


@scratch_scope()
def upsert(
    records: DataFrame, batch: int, path: str, keys: Sequence[str] = etl.KEY, loaded_at: str = "loaded_at", slots: int = SLOTS
) -> None:
    """Takes a batch of records into the table at ``path``.

    Of the records of a key in the batch and in the table the one loaded last stays, by the
    same order as in ``etl.latest_record``; that order is total but for equal rows, so the
    answer does not depend on how records are dealt into batches, on the order of batches or
    on how often one is repeated.  Only the slots that hold a key of the batch are read, and
    only those with a change are written anew.  ``changes/batch=<n>`` gets each new answer
    and whether it replaces one; it is written before the table, so that a batch repeated after a
    failure finds its own changes and finishes with those.
    """
    spark = records.sparkSession
    names = list(records.columns)
    ties = [c for c in names if c not in keys and c != loaded_at]
    log = f"{path}/changes/batch={batch}"
    if not path_exists(spark, f"{log}/_SUCCESS"):
        fresh = materialize(etl.latest_record(records, keys, loaded_at).withColumn("slot", _slot(keys, slots)))
        before = _before(spark, fresh, path)
        # a key has at most one row on either side
        both = fresh.withColumn("_new", F.lit(True)).unionByName(before.withColumn("_new", F.lit(False)))
        won = etl.latest_record(both, keys, loaded_at, ties).filter("_new").drop("_new")
        # an answer that equals the stored one is no change
        changed = null_safe_join(won, before.select(*names), names, "left_anti")
        known = before.select(*keys).withColumn("_known", F.lit(True))
        told = null_safe_join(changed, known, keys, "left").select(*names, "slot", F.coalesce("_known", F.lit(False)).alias("replaces"))
        told.write.mode("overwrite").parquet(log)
    changes = spark.read.parquet(log).drop("replaces")
    stored = _before(spark, changes, path)
    rows = materialize(etl.latest_record(stored.unionByName(changes), keys, loaded_at, ties))
    (
        rows.repartition("slot").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("slot")
        .parquet(f"{path}/records")
    )


def _before(spark: SparkSession, rows: DataFrame, path: str) -> DataFrame:
    """The stored records in the slots of ``rows``; at most ``SLOTS`` numbers are sent to the scan."""
    touched = F.broadcast(rows.select("slot").distinct())
    schema = rows.drop("slot").schema
    return _stored(spark, path, schema).join(touched, "slot", "left_semi").select(*rows.columns)


def run_latest(
    stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str] = etl.KEY, loaded_at: str = "loaded_at", slots: int = SLOTS
) -> StreamingQuery:
    """Keeps the table at ``path`` up to date from a stream of records."""
    create(stream, path)
    return (
        stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
        .foreachBatch(lambda rows, batch: upsert(rows, batch, path, keys, loaded_at, slots)).start()
    )


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The latest record of each key; the cost does not depend on the number of batches."""
    return _stored(spark, path, spark.read.parquet(f"{path}/columns").schema).drop("slot")


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """Every answer that was given, by ``batch``, and whether it replaced an earlier one."""
    return spark.read.option("basePath", f"{path}/changes").parquet(f"{path}/changes").drop("slot")
