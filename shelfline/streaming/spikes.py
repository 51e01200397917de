"""Demand spikes in a stream: running moments per key, kept over batches and merged."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfline.functions.joins import null_safe_join, small_side
from shelfline.operators.mart_state import SLOTS, merge_slots
from shelfline.session import materialize, scratch_scope

_MOMENTS = "struct<n:bigint,mean:double,m2:double>"


def _merged(moments: str) -> Column:
    """One set of moments from a few: the pairwise rule, which loses no digits where a mean is large."""
    def add(a: Column, b: Column) -> Column:
        n = a["n"] + b["n"]
        gap = b["mean"] - a["mean"]
        return F.when(n == 0, a).otherwise(F.struct(
            n.alias("n"), (a["mean"] + gap * F.try_divide(b["n"], n)).alias("mean"),
            (a["m2"] + b["m2"] + gap * gap * F.try_divide(a["n"] * b["n"], n)).alias("m2")).cast(_MOMENTS))

    none = F.struct(F.lit(0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2")).cast(_MOMENTS)
    return F.aggregate(F.collect_list(moments), none, add)  # the stored set and the batch's


@scratch_scope()
def update(rows: DataFrame, batch: int, path: str, by: Sequence[str], value: str = "value") -> None:
    """Takes a batch of observations: their moments are merged into those of their keys, and the rows are kept.

    Only the slots of the batch's keys are written anew.  A batch that is repeated counts once: its
    rows replace themselves, and a slot knows the last batch it took.  NULL values are kept but count nowhere.
    """
    rows = materialize(rows)
    rows.write.mode("overwrite").parquet(f"{path}/rows/batch={batch}")
    x = F.col(value).cast("double")
    found = rows.groupBy(*by).agg(F.struct(
        F.count(x).alias("n"), F.coalesce(F.avg(x), F.lit(0.0)).alias("mean"),
        F.coalesce(F.var_pop(x) * F.count(x), F.lit(0.0)).alias("m2")).cast(_MOMENTS).alias("moments"))
    slot = F.pmod(F.xxhash64(*by), F.lit(SLOTS))
    merge_slots(found.withColumn("slot", slot), list(by), {"moments": _merged("moments")}, batch, f"{path}/moments")


def moments(spark: SparkSession, path: str) -> DataFrame:
    """n, mean and population deviation of each key so far."""
    kept = spark.read.option("basePath", f"{path}/moments").parquet(f"{path}/moments").drop("slot", "batch")
    return kept.select(
        "*", F.col("moments.n").alias("n"), F.col("moments.mean").alias("mean"),
        F.sqrt(F.try_divide("moments.m2", "moments.n")).alias("deviation")).drop("moments")


def flagged(spark: SparkSession, path: str, by: Sequence[str], value: str = "value", deviations: float = 2.0) -> DataFrame:
    """All rows so far with ``is_spike``: further from their key's mean than ``deviations`` population deviations.

    The same flags as over all rows at once.  Moments are sent to the rows if they measure small; else Spark shuffles.
    """
    rows = spark.read.option("basePath", f"{path}/rows").parquet(f"{path}/rows").drop("batch")
    known = small_side(moments(spark, path).select(*by, F.col("mean").alias("_mean"), F.col("deviation").alias("_deviation")))
    far = F.abs(F.col(value).cast("double") - F.col("_mean")) > deviations * F.col("_deviation")
    return null_safe_join(rows, known, list(by), "left").withColumn("is_spike", far).drop("_mean", "_deviation")


def run_spikes(stream: DataFrame, path: str, checkpoint: str, by: Sequence[str], value: str = "value") -> StreamingQuery:
    """Keeps rows and moments up to date from a stream."""
    return (
        stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
        .foreachBatch(lambda rows, batch: update(rows, batch, path, by, value)).start()
    )
