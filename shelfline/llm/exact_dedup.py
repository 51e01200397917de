"""Exact deduplication against a persistent digest index.  DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfline.llm.common import SPACE_CHARS, join_groups, shuffle_partitions, text_of
from shelfline.session import materialize

INDEX_SCHEMA = "digest BINARY, keep_id BIGINT, n_chars BIGINT, keep_hash BIGINT, batch STRING"


def create_index(spark: SparkSession, name: str, buckets: int | None = None) -> None:
    """An empty index table, bucketed and sorted by digest."""
    empty = spark.createDataFrame([], INDEX_SCHEMA)
    _write(empty, name, buckets or shuffle_partitions(spark))


def _write(rows: DataFrame, name: str, buckets: int) -> None:
    rows.write.mode("append").format("parquet").bucketBy(buckets, "digest").sortBy("digest").saveAsTable(name)


def drop_index(spark: SparkSession, name: str) -> None:
    """Removes an index; decisions made with it stay, since they are written down."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def digest_of() -> Column:
    """SHA-256 (lowercase hex) of the text without white space."""
    return F.sha2(F.translate(text_of(), SPACE_CHARS, ""), 256)


def deduplicate(docs: DataFrame, index: str, batch: str, buckets: int | None = None) -> DataFrame:
    """Adds the new texts of ``docs`` to ``index`` and returns a decision for each row.

    Texts are equal when they are identical without white space (SHA-256 of the
    rest).  Of equal new texts the one with the most code points, then the
    smallest doc_id, stays, and joins the index; texts that an earlier batch put
    there do not stay.  Digests are first reduced to one row each, combined before
    the shuffle, so a text that a third of all rows share costs one row per task; the
    sort-merge anti-join then reads the index in its buckets without moving it.
    ``batch`` names the run: repeating a batch that was added, whole or in part, finds its own rows
    again and changes nothing, whatever the order and partitions of its rows.  The index knows the row that stays by
    its length, id and a hash of its text; of rows that are equal in all three any one stays.

    Columns: doc_id, keep_id, group_size (rows of this batch), kept, text_sha256, n_chars.
    Null counts as the empty text; null ids come after all others; of rows that
    repeat with their id one stays.  No rows give no rows.
    """
    spark = docs.sparkSession
    buckets = buckets or shuffle_partitions(spark)
    rows = materialize(docs.select(
        "doc_id",
        F.length(text_of()).cast("long").alias("n_chars"),
        F.unhex(digest_of()).alias("digest"),
        F.xxhash64(text_of()).alias("hash"),
        F.monotonically_increasing_id().alias("row"),
    ))
    best = F.min(F.struct(
        (-F.col("n_chars")).alias("less"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "hash", "row",
    ))
    groups = materialize(
        rows.groupBy("digest").agg(best.alias("best"), F.count("*").alias("group_size"))
        .select("digest", F.col("best.doc_id").alias("keep_id"), (-F.col("best.less")).alias("n_chars"),
                F.col("best.hash").alias("keep_hash"), F.col("best.row").alias("keep_row"), "group_size")
    )
    if not spark.catalog.tableExists(index):
        create_index(spark, index, buckets)
    known = spark.table(index)
    fresh = materialize(
        groups.join(known.hint("merge"), "digest", "left_anti")
        .select("digest", "keep_id", "n_chars", "keep_hash", F.lit(batch).alias("batch"))
    )
    _write(fresh, index, buckets)
    spark.catalog.refreshTable(index)
    stay = spark.table(index).select("digest", *[F.col(c).alias(f"in_{c}") for c in ("keep_id", "n_chars", "keep_hash", "batch")])
    same = (F.col("in_batch") == batch) & (F.col("in_n_chars") == F.col("n_chars")) & (
        F.col("in_keep_hash") == F.col("keep_hash")) & F.col("in_keep_id").eqNullSafe(F.col("keep_id"))
    # the place of the row is this run's own
    sizes = materialize(groups.join(stay, "digest").select(
        "digest", "group_size", F.col("in_keep_id").alias("keep_id"), F.when(same, F.col("keep_row")).alias("keep_row")))
    return join_groups(rows, sizes, ["digest"], "group_size").select(
        "doc_id", "keep_id", "group_size", F.coalesce(F.col("row") == F.col("keep_row"), F.lit(False)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), "n_chars",
    )
