"""Joins that depend on a measured size, and joins in which NULL keys meet."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

# Largest side that is sent to every executor.
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def measured_bytes(df: DataFrame) -> int:
    """Size of the values of ``df`` from one aggregation: text by its length, the rest by its type."""
    fixed = 16 * len(df.schema)
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    length = F.lit(0).cast("long")
    for c in texts:
        length = length + F.coalesce(F.sum(F.octet_length(c)), F.lit(0))
    row = df.agg(F.count("*").alias("n"), length.alias("text")).first()
    return row["n"] * fixed + row["text"]


def small_side(df: DataFrame, limit: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if it measures at most ``limit`` bytes, else as it is.

    Estimates of derived tables are often far too high, which costs a shuffle of
    the other side; the measurement is one small job.
    """
    return F.broadcast(df) if measured_bytes(df) <= limit else df


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` with NULL equal to NULL, as grouping has it; the keys come from the left side."""
    names = {c: f"_right_{c}" for c in keys}
    other = right.select(*[F.col(c).alias(names.get(c, c)) for c in right.columns])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(names[c])) for c in keys])
    return left.join(other, same, how).drop(*names.values())
