"""Bundle pairs: products whose combined demand comes close to a target.

Products are sorted by demand and paired from both ends: the smallest remaining
one with the largest remaining one, dropping the smaller when the sum is too
low and the larger when it is too high.  Each product is in at most one pair.

Seen from the smaller side, the i-th product can take the partners number
``lo`` to ``hi - 1`` (largest first), and takes the first of them that is still
free.  With ``p`` the number of partners passed so far the step is
``p -> min(max(p, lo) + 1, hi)``.  In terms of ``p - i`` that is a clamp to two
bounds, and a chain of clamps is again one clamp.  So blocks of products are
condensed to two numbers each, blocks of blocks likewise, and then every block
is paired on its own, which gives the sequential result from bounded pieces.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from shelfline.functions.joins import null_safe_join
from shelfline.functions.ordering import running_total
from shelfline.session import materialize

TOLERANCE = Decimal("0.05")
_BELOW, _ITEM, _UPTO = 0, 1, 2  # order of rows at the same demand
_UNBOUNDED = 2**62


def _clamped(value: Column, step: Column) -> Column:
    return F.least(F.greatest(value, step["low"]), step["high"])


def _with_state(steps: DataFrame, group: Sequence[str], place: str, last: int, size: int) -> DataFrame:
    """``steps`` (clamps ``low``, ``high`` by place) with ``state``: what 0 has become before each of them.

    Runs of ``size`` steps are condensed to one clamp each; the state before a
    run comes from the same on the runs, so no array is longer than ``size``.
    """
    key = [*group, "_run"]
    others = [c for c in steps.columns if c not in group]
    runs = steps.withColumn("_run", F.floor(F.col(place) / F.lit(size))).groupBy(*key).agg(
        F.sort_array(F.collect_list(F.struct(place, *[c for c in others if c != place]))).alias("_steps")
    )
    if last < size:
        runs = runs.withColumn("state", F.lit(0).cast("long"))
    else:
        ends = [F.aggregate("_steps", F.lit(end), _clamped).alias(name)
                for name, end in (("low", -_UNBOUNDED), ("high", _UNBOUNDED))]
        # another name, since the level above has runs of its own
        whole = runs.select(*group, F.col("_run").alias("_place"), *ends)
        before = _with_state(whole, group, "_place", last // size, size)
        runs = null_safe_join(runs, before.select(*group, F.col("_place").alias("_run"), "state"), key)
    states = F.aggregate(
        "_steps",
        F.struct(F.col("state").alias("now"), F.array().cast("array<bigint>").alias("seen")),
        lambda acc, step: F.struct(
            _clamped(acc["now"], step).alias("now"), F.array_append(acc["seen"], acc["now"]).alias("seen")),
    )["seen"]
    told = runs.select(*group, F.inline(F.arrays_zip("_steps", states.alias("state"))))
    return told.select(*group, *[F.col("_steps")[c].alias(c) for c in others], "state")


def bundle_pairs(
    products: DataFrame,
    target: float,
    by: Sequence[str] = (),
    item: str = "product_id",
    demand: str = "demand",
    block_size: int = 256,
    group_limit: int = 1_000_000,
    scale: int = 6,
) -> DataFrame:
    """(``by``, left_product, right_product, combined_demand) of every pair.

    Demands are compared as decimals with ``scale`` places, so that a sum at the
    very edge of the tolerance counts whatever the order of its parts.
    """
    group = list(by)
    if not group:
        products, group = products.withColumn("_all", F.lit(0)), ["_all"]
    goal = Decimal(str(target))
    slack = goal * TOLERANCE
    value = F.col(demand).cast(f"decimal({12 + scale},{scale})")

    def row(point, kind: int):
        return F.struct(point.cast(f"decimal({14 + scale},{scale})").alias("point"), F.lit(kind).alias("kind"))

    # one row per product, read several times below
    products = materialize(
        products.filter(value.isNotNull()).select(*group, F.col(item).alias("item"), value.alias("value"))
    )
    value = F.col("value")
    # Three rows per product: itself, and the two demands between which its partners lie.
    points = products.select(
        *group, "item", "value",
        F.inline(F.array(row(value, _ITEM), row(goal - slack - value, _BELOW), row(goal + slack - value, _UPTO))),
    ).withColumn("weight", (F.col("kind") == _ITEM).cast("long"))
    counted = running_total(
        points, "weight", [F.col("point"), F.col("kind"), F.col("item")], group, "count", group_limit
    )

    def count_at(kind: int):
        return F.max(F.when(F.col("kind") == kind, F.col("count")))

    sizes = products.groupBy(*group).agg(F.count("*").alias("n"))
    places = counted.groupBy(*group, "item", "value").agg(
        (count_at(_ITEM) - 1).alias("pos"), count_at(_BELOW).alias("below"), count_at(_UPTO).alias("upto"),
    )
    placed = (
        null_safe_join(places, sizes, group)
        .select(
            *group, "item", "value", "pos", "n",
            (F.col("n") - F.col("upto") - F.col("pos")).alias("low"),
            (F.col("n") - F.col("below") - 1 - F.col("pos")).alias("high"),
        )
    )
    placed = materialize(placed)

    last = placed.agg(F.max("pos")).first()[0] or 0
    # the partner taken, counted from the largest product
    partner = F.greatest("state", "low") + F.col("pos")
    lefts = (
        _with_state(placed, group, "pos", last, block_size)
        .filter(partner <= F.col("high") + F.col("pos"))
        .select(*group, "item", "value", "pos", (F.col("n") - 1 - partner).alias("right_pos"))
        .filter("pos < right_pos")
    )
    rights = placed.select(
        *group, F.col("pos").alias("right_pos"), F.col("item").alias("right_product"), F.col("value").alias("right_value")
    )
    return null_safe_join(lefts, rights, [*group, "right_pos"]).select(
        *by,
        F.col("item").alias("left_product"),
        "right_product",
        F.bround(F.col("value") + F.col("right_value"), 2).cast("double").alias("combined_demand"),
    )
