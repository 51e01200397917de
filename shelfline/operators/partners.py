"""The best partners of each product: those whose demand together comes nearest to a target."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, Window, functions as F

from shelfline.functions.joins import null_safe_join
from shelfline.functions.ordering import running_total, with_position
from shelfline.session import materialize

TOLERANCE = Decimal("0.05")
_ITEM, _GOAL = 0, 1  # a goal counts the items at its own demand


def best_partners(
    products: DataFrame, target: float, k: int = 5, by: Sequence[str] = (), item: str = "product_id", demand: str = "demand",
    tolerance: Decimal = TOLERANCE, group_limit: int = 1_000_000, scale: int = 6,
) -> DataFrame:
    """(``by``, left_product, right_product, combined_demand, rank) of the ``k`` partners of every product, nearest first.

    Partners are within ``tolerance`` (a share of the target) of it; equal distances go by item.  A
    partner may be the partner of many.

    Products are sorted by demand.  What a product lacks to the target falls between two places of that order, and
    its best partners are the ``k + 1`` products below and above (one of them may be the product itself).  So a product
    meets 2k + 2 others by place, also where thousands have the same demand, and no pairs of a bucket are made.  Demands are
    decimals with ``scale`` places; products without a demand take no part.
    """
    group = list(by)
    if not group:
        products, group = products.withColumn("_all", F.lit(0)), ["_all"]
    goal = Decimal(str(target))
    kind = f"decimal({14 + scale},{scale})"
    rows = materialize(products.select(*group, F.col(item).alias("item"), F.col(demand).cast(kind).alias("value")).filter("value IS NOT NULL"))
    value = F.col("value")
    points = rows.select(*group, "item", F.inline(F.array(
        F.struct(value.alias("point"), F.lit(_ITEM).alias("kind")), F.struct((F.lit(goal) - value).cast(kind).alias("point"), F.lit(_GOAL).alias("kind")))))
    points = points.withColumn("weight", (F.col("kind") == _ITEM).cast("long"))
    counted = running_total(points, "weight", [F.col("point"), F.col("kind"), F.col("item")], group, "_upto", group_limit)
    asked = counted.filter(F.col("kind") == _GOAL).select(*group, F.col("item").alias("left_product"), (F.lit(goal) - F.col("point")).alias("_left"), "_upto")
    # of equal demands the first items come first on both sides of the goal
    up = with_position(rows, [value, F.col("item")], group, "_place").withColumn("_side", F.lit(1))
    down = with_position(rows, [value, F.col("item").desc()], group, "_place").withColumn("_side", F.lit(-1))
    places = F.concat(
        F.transform(F.sequence(F.lit(0), F.lit(k)), lambda i: F.struct((F.col("_upto") + i).alias("_place"), F.lit(1).alias("_side"))),
        F.transform(F.sequence(F.lit(1), F.lit(k + 1)), lambda i: F.struct((F.col("_upto") - i).alias("_place"), F.lit(-1).alias("_side"))))
    wanted = asked.select(*group, "left_product", "_left", F.inline(places))
    # both sides grow with the products; the planner counts files, not the rows that inline makes of them, and would broadcast one
    met = null_safe_join(wanted, up.unionByName(down).hint("merge"), [*group, "_place", "_side"])
    combined = F.col("_left") + value
    distance = F.abs(combined - F.lit(goal))
    near = met.filter((F.col("item") != F.col("left_product")) & (distance <= F.lit(goal * tolerance)))
    nearest = Window.partitionBy(*group, "left_product").orderBy(distance, "item")  # 2k + 2 rows at most
    return near.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= k).select(
        *by, "left_product", F.col("item").alias("right_product"), F.bround(combined, 4).cast("double").alias("combined_demand"), "rank")
