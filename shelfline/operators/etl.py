"""Warehouse-style ETL: latest record per key, three-valued filters, p99 caps, median fill, enrichment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, Window, functions as F

from shelfline.functions.joins import small_side
from shelfline.functions.ordering import quantile_name, quantiles

KEY = ("sale_date", "store_id", "product_id")
P99 = 0.99
MEDIAN = 0.5


def latest_record(
    df: DataFrame, keys: Sequence[str] = KEY, loaded_at: str = "loaded_at", tie_breakers: Sequence[str] | None = None
) -> DataFrame:
    """One row per key, the one loaded last; a missing load time counts as the latest.

    Ties are settled by all other columns in descending order.  The planner keeps
    only the best row per key in each task before the shuffle, so many copies of
    one key do not meet in one place.
    """
    if tie_breakers is None:
        tie_breakers = [c for c in df.columns if c not in keys and c != loaded_at]
    order = [F.col(loaded_at).desc_nulls_first(), *[F.col(c).desc_nulls_last() for c in tie_breakers]]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def drop_invalid(df: DataFrame) -> DataFrame:
    """Delete rows that are known to be invalid; an unknown (NULL) comparison keeps the row."""
    invalid = (
        (F.col("units_sold") < 0) | (F.col("unit_price") <= 0) | (F.col("revenue") < 0) | F.col("sale_date").isNull()
    )
    return df.filter(~F.coalesce(invalid, F.lit(False)))


def etl_statistics(df: DataFrame) -> Row:
    """The three p99 caps and the median competitor price, from two passes over ``df``."""
    return quantiles(
        df,
        {"units_sold": [P99], "unit_price": [P99], "revenue": [P99], "competitor_price": [MEDIAN]},
    ).first()


def cap_p99(df: DataFrame, stats: Row | None = None) -> DataFrame:
    """Cap units, price and revenue at their 99th percentile.

    The cap of units is rounded to an integer.  ``least`` skips NULL, so a
    missing measure takes the cap, as it does in SQL.
    """
    columns = ("units_sold", "unit_price", "revenue")
    if stats is None:
        stats = quantiles(df, {c: [P99] for c in columns}).first()
    types = dict(df.dtypes)
    caps = {c: F.lit(stats[quantile_name(c, P99)]).cast("double") for c in columns}
    caps["units_sold"] = F.bround(caps["units_sold"])
    return df.withColumns({c: F.least(F.col(c), caps[c].cast(types[c])) for c in columns})


def fill_median(df: DataFrame, column: str = "competitor_price", stats: Row | None = None) -> DataFrame:
    """Replace missing values of ``column`` by its median."""
    if stats is None:
        stats = quantiles(df, {column: [MEDIAN]}).first()
    median = F.lit(stats[quantile_name(column, MEDIAN)]).cast("double").cast(dict(df.dtypes)[column])
    return df.withColumn(column, F.coalesce(column, median))


def enrich(sales: DataFrame, stores: DataFrame, products: DataFrame) -> DataFrame:
    """Add store and product attributes, gross profit and effective discount.

    A dimension is broadcast if it measures small enough; otherwise Spark shuffles
    and splits hot keys.
    """
    store_side = stores.select("store_id", "region", "store_type", "store_size_sqft")
    product_side = products.select("product_id", "sub_category", "base_price", "cost_price", "is_perishable")
    price, base = F.col("unit_price"), F.col("base_price")
    discount = F.round(F.try_divide((base - price), base) * 100, 2)
    return (
        sales.join(small_side(store_side), "store_id", "left")
        .join(small_side(product_side), "product_id", "left")
        .withColumns({
            "gross_profit": F.col("revenue") - F.col("units_sold") * F.col("cost_price"),
            "effective_discount": F.when(base > 0, discount).otherwise(0).cast("decimal(18,2)"),
        })
    )
