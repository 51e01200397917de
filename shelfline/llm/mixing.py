"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shelfline.functions.ordering import with_position
from shelfline.llm.common import WORD, prefix_sums
from shelfline.session import materialize


def source_targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), max_repeat: int = 3) -> DataFrame:
    """(source, source_size, target) from the rows (source, size).

    Sources in code point order, null last, take ``weights`` in turn and share
    all sizes by them.  No target exceeds ``max_repeat`` times its source's size:
    with sources sorted by that bound per weight, those held at it are a prefix,
    and what is left is shared by weight among the rest.  An empty table gives
    no row, and sources without words a target of 0.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    places = with_position(sources, [F.col("source").isNull(), F.col("source")], name="_place")
    choices = F.array(*[F.lit(int(w)) for w in weights])
    places = places.withColumn("_weight", choices[F.pmod("_place", F.lit(len(weights))).cast("int")].cast("long"))
    places = places.withColumn("_most", F.col("source_size") * max_repeat)
    by_bound = prefix_sums(
        places, [F.col("_most") / F.col("_weight"), F.col("_place")], {"_held": "_most", "_held_weight": "_weight"}
    )
    by_bound = materialize(by_bound)
    # two sums and one level are all that the driver sees
    whole = by_bound.agg(F.sum("source_size"), F.sum("_weight")).first()
    words, weight = whole[0] or 0, whole[1] or 0
    level = (F.lit(words) - F.col("_held")) / (F.lit(weight) - F.col("_held_weight"))
    rows = by_bound.withColumns({"_level": level, "_full": F.col("_most") <= level * F.col("_weight")})
    # the first source that is not held sees exactly the held ones before it
    share = rows.filter("NOT _full").agg(F.min_by("_level", "_held_weight")).first()[0]
    return rows.select(
        "source", "source_size",
        F.when(F.col("_full"), F.col("_most").cast("double")).otherwise(F.lit(share).cast("double") * F.col("_weight")).alias("target"),
    )


def mix(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), max_repeat: int = 3, seed: int = 17) -> DataFrame:
    """How often the mix takes each document: doc_id, size, source_size, target, taken, source, copies.

    A document's expected copies are target / source_size.  Within its source,
    ordered by size, these are summed up from one offset that ``seed`` and the
    source's name give, and a document is emitted once for each integer that its
    step crosses.  Sorted by size, the words taken differ from the target by
    about the longest document of the source at most.  Positions come from a range sort, so a
    source that holds most rows still spreads over many tasks; texts never move.

    A null text has size 0, a null source is a source of its own, rows that
    repeat count each, and rows with a null doc_id come last among equal sizes.
    """
    rows = _decided(docs.select("doc_id", "source", _size("text")), weights, max_repeat, seed)
    return rows.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies"
    )


def _size(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size")


def _decided(
    sizes: DataFrame, weights: Sequence[int], max_repeat: int, seed: int, ties: Sequence[str] = ()
) -> DataFrame:
    """The rows (doc_id, source, size) with what ``mix`` decides on each; ``ties`` order those of equal size and id."""
    sizes = materialize(sizes)
    targets = source_targets(sizes, weights, max_repeat)
    order = [F.col("size"), F.col("doc_id").isNull(), F.col("doc_id"), *[F.col(c) for c in ties]]
    placed = with_position(sizes, order, by=["source"], name="_place")
    rows = placed.join(targets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("="), "source"), F.lit("null")))
    offset = F.conv(F.substring(F.sha2(name, 256), 1, 12), 16, 10).cast("double") / float(1 << 48)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = rows.withColumns({"_offset": offset, "_rate": rate})
    crossed = F.floor(F.expr("_rate * (_place + 1) + _offset")) - F.floor(F.expr("_rate * _place + _offset"))
    return rows.withColumn("copies", F.least(crossed, F.lit(max_repeat)))


def mixed_documents(
    docs: DataFrame, weights: Sequence[int] = (1, 2, 3), max_repeat: int = 3, seed: int = 17
) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it.

    The decision is made per row, whatever ids are null or shared: rows are written once with a number, by which
    the copies meet them.  Among rows of one source, size and id it goes by a hash of the text.
    """
    rows = materialize(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("_row")))
    sizes = rows.select("row.doc_id", "row.source", _size("row.text"), F.xxhash64("row.text").alias("_text"), "_row")
    taken = _decided(sizes, weights, max_repeat, seed, ties=["_text", "_row"]).filter("copies > 0")
    kept = rows.join(taken.select("_row", F.col("copies").cast("int").alias("copies")), "_row")
    return kept.select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")
