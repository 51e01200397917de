"""Shared pieces: whole-row input, prefix sums over a global order, connected components."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from shelfline.session import materialize

# Words are runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

_OFFSET_BITS = 33


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def schema_with(df: DataFrame, **new: str) -> T.StructType:
    """The schema of ``df`` and further columns, leaving the frame's own schema alone."""
    schema = T.StructType(list(df.schema.fields))
    for name, kind in new.items():
        schema = schema.add(name, kind)
    return schema


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def join_groups(rows: DataFrame, groups: DataFrame, key: Sequence[str], size: str) -> DataFrame:
    """Inner join of rows with groups of one row per (non-null) key, whatever share of the rows one key holds.

    ``size`` counts the rows of a key.  Keys with more than a thousandth of all
    rows are fewer than 1,000, so those groups are sent to the rows; the others
    meet them by a shuffle in which no key is large.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    hot = F.broadcast(groups.filter(F.col(size) * 1000 > total))
    cold = groups.filter(F.col(size) * 1000 <= total)
    spread = rows.join(F.broadcast(hot.select(*key)), list(key), "left_anti").join(cold, list(key))
    return rows.join(hot, list(key)).unionByName(spread)


def prefix_sums(df: DataFrame, order: Sequence[Column], sums: Mapping[str, str]) -> DataFrame:
    """Adds, for each ``new name: column``, the sum of the column over all rows before this one in ``order``.

    Rows are range-sorted and written once; each sorted partition is summed on
    its own and shifted by the totals of the partitions before it (one row each).
    """
    marked = materialize(df.orderBy(*order).withColumn("_mark", F.monotonically_increasing_id()))
    rows = marked.withColumn("_part", F.shiftright("_mark", _OFFSET_BITS))
    inside = Window.partitionBy("_part").orderBy("_mark").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({f"_in_{new}": F.coalesce(F.sum(c).over(inside), F.lit(0)) for new, c in sums.items()})
    totals = marked.groupBy(F.shiftright("_mark", _OFFSET_BITS).alias("_part")).agg(
        *[F.sum(c).alias(f"_sum_{new}") for new, c in sums.items()]
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "_part", *[F.coalesce(F.sum(f"_sum_{new}").over(before), F.lit(0)).alias(f"_at_{new}") for new in sums]
    )
    joined = rows.join(starts, "_part")
    return joined.select(*df.columns, *[(F.col(f"_in_{new}") + F.col(f"_at_{new}")).alias(new) for new in sums])


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hands its larger neighbours to the smallest node around it."""
    both = _both_ways(edges)
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node hands itself and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge; a component is named by its smallest node.

    ``edges`` has two long columns ``a`` and ``b``.  Alternating large and small
    stars need about log(n) rounds; each is written to the shared folder, so a
    lost executor never replays earlier rounds.  The driver sees one row a round.
    """
    current = materialize(edges.select("a", "b").filter("a <> b").distinct())
    seen = None
    while True:
        current = materialize(_small_star(_large_star(current)))
        state = current.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")),
        ).first()
        if state == seen:
            break
        seen = state
    named = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return named.union(current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
