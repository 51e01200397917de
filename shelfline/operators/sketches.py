"""Quantiles from stored sketches: one mergeable sketch per day and column, merged over any range of days."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfline.operators.mart_state import merge_slots

SIZE = 2000  # of a sketch, in items on its lowest level
RANK_ERROR = 0.01  # stated bound; the sketches' own estimate for this size is about a quarter of it


def day_sketches(rows: DataFrame, columns: Sequence[str], date: str = "sale_date", size: int = SIZE) -> DataFrame:
    """A sketch of each column and day, combined in every task before the shuffle; a day without values has none."""
    return rows.groupBy(date).agg(*[
        F.when(F.count(c) > 0, F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(size))).alias(c) for c in columns])


def merge_batch(rows: DataFrame, batch: int, path: str, columns: Sequence[str], date: str = "sale_date", size: int = SIZE) -> None:
    """Adds a batch of rows, late ones included, to the sketches of their days.

    Only the months that the batch touches are written anew, and a batch that is repeated counts once in each.
    """
    found = day_sketches(rows, columns, date, size)
    slot = F.coalesce(F.year(date) * 12 + F.month(date), F.lit(-1)).cast("long")
    merged = {c: F.when(F.count(c) > 0, F.kll_merge_agg_double(c)) for c in columns}
    merge_slots(found.withColumn("slot", slot), [date], merged, batch, path)


def range_quantiles(
    spark: SparkSession, path: str, wanted: Mapping[str, Sequence[float]], first=None, last=None, date: str = "sale_date"
) -> DataFrame:
    """(column, q, value) over the days from ``first`` to ``last`` (all days unless given), from the sketches alone.

    A value's rank is within ``RANK_ERROR`` of q.  A column without values has NULL.
    """
    days = spark.read.option("basePath", path).parquet(path)
    if first is not None:
        days = days.filter(F.col(date) >= F.lit(first))
    if last is not None:
        days = days.filter(F.col(date) <= F.lit(last))
    merged = days.agg(*[F.when(F.count(c) > 0, F.kll_merge_agg_double(c)).alias(c) for c in wanted])
    return merged.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(float(q)).alias("q"), F.kll_sketch_get_quantile_double(c, F.lit(float(q))).alias("value"))
        for c, qs in wanted.items() for q in qs])))


def rank_errors(rows: DataFrame, found: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, q, value, n, error): by how much the value's true rank in ``rows`` differs from q, as a share of n.

    A value that occurs often has a range of ranks; the nearest one counts.  ``found`` has a few rows.
    """
    values = rows.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], list(columns), "column", "x")
    counted = values.filter("x IS NOT NULL").join(F.broadcast(found), "column").groupBy("column", "q", "value").agg(
        F.count("*").alias("n"), F.count_if(F.col("x") < F.col("value")).alias("_below"),
        F.count_if(F.col("x") <= F.col("value")).alias("_upto"))
    low, high = F.col("_below") / F.col("n"), F.col("_upto") / F.col("n")
    return counted.select(
        "column", "q", "value", "n", F.greatest(low - F.col("q"), F.col("q") - high, F.lit(0.0)).alias("error"))
