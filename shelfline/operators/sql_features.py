"""Demand features of the warehouse track: the same series, other windows, bands and risk classes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from shelfline.functions.columns import demand_band, round_half_up

SERIES = ("store_id", "product_id")
LAGS = (1, 7, 14, 30)
# With these settings a join by series and more columns takes the rows of a bucketed table as they lie.
BY_SERIES = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}
YEAR_ROWS = 365
WARMUP_DAYS = 30
BASE_COLUMNS = [
    "sale_date", "store_id", "product_id", "category", "region", "store_type", "units_sold", "revenue", "unit_price",
    "competitor_price", "is_promotion", "is_holiday", "is_perishable",
]


def _series() -> Window:
    return Window.partitionBy(*SERIES).orderBy("sale_date")


def lags(df: DataFrame, year_rows: int = YEAR_ROWS) -> DataFrame:
    """Row lags and the change against ``year_rows`` rows earlier."""
    w = _series()
    columns = {f"lag_{n}d": F.lag("units_sold", n).over(w) for n in LAGS}
    columns["yoy_change"] = F.col("units_sold") - F.lag("units_sold", year_rows).over(w)
    return df.withColumns(columns)


def calendar_yoy(df: DataFrame) -> DataFrame:
    """Change against the same day one year earlier, by an equi-join on the shifted date."""
    shifted = F.add_months("sale_date", 12)
    # 29 February has no counterpart a year later
    before = df.filter(F.dayofmonth(shifted) == F.dayofmonth("sale_date")).select(
        shifted.alias("sale_date"), *SERIES, F.col("units_sold").alias("_before")
    )
    return df.join(before, ["sale_date", *SERIES], "left").withColumn(
        "yoy_change", F.col("units_sold") - F.col("_before")
    ).drop("_before")


def rolling(df: DataFrame) -> DataFrame:
    """Means of 7 and 30, maximum and minimum of 7 previous rows."""
    week, month = _series().rowsBetween(-7, -1), _series().rowsBetween(-30, -1)
    return df.withColumns({
        "rolling_7d_mean": F.avg("units_sold").over(week),
        "rolling_30d_mean": F.avg("units_sold").over(month),
        "rolling_7d_max": F.max("units_sold").over(week),
        "rolling_7d_min": F.min("units_sold").over(week),
    })


def demand_rank(df: DataFrame) -> DataFrame:
    """Rank of a product within its store and day by units, the largest (or a missing value) first.

    Ranked through counts per distinct value, so that the products of one big
    store and day are not sorted in one task: a rank is one plus the number of
    rows with a larger value.
    """
    groups = ["store_id", "sale_date"]
    counts = df.groupBy(*groups, "units_sold").agg(F.count("*").alias("_n"))
    larger = (
        Window.partitionBy(*groups)
        .orderBy(F.col("units_sold").desc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ranks = counts.select(
        *[F.col(c).alias(f"_{c}") for c in (*groups, "units_sold")],
        (F.coalesce(F.sum("_n").over(larger), F.lit(0)) + 1).cast("int").alias("demand_rank"),
    )
    same = [F.col(c) == F.col(f"_{c}") for c in groups] + [F.col("units_sold").eqNullSafe(F.col("_units_sold"))]
    return df.join(ranks, same, "left").drop(*[f"_{c}" for c in (*groups, "units_sold")])


def demand_rank_by_series(df: DataFrame) -> DataFrame:
    """``demand_rank`` for rows in buckets of a series, which stay where they are.

    Only day, store, product and units are ranked elsewhere and come back, once for equal rows.  In a plan that may
    join on the bucket columns alone (``BY_SERIES``), the other columns are not shuffled.
    """
    key = ["sale_date", *SERIES, "units_sold"]
    if not df.filter("product_id IS NULL").isEmpty():
        return demand_rank(df)  # a missing product has no partner in a join by product
    larger_first = Window.partitionBy("store_id", "sale_date").orderBy(F.col("units_sold").desc_nulls_first())
    ranks = df.select(*key).withColumn("demand_rank", F.rank().over(larger_first))
    ranks = ranks.groupBy(*[F.col(c).alias(f"_{c}") for c in key]).agg(F.first("demand_rank").alias("demand_rank"))
    same = [F.col(c) == F.col(f"_{c}") for c in key[:-1]] + [F.col("units_sold").eqNullSafe(F.col("_units_sold"))]
    return df.join(ranks, same, "left").drop(*[f"_{c}" for c in key])


def price_ratio(df: DataFrame) -> DataFrame:
    ratio = round_half_up(F.try_divide("unit_price", "competitor_price"), 4)
    return df.withColumn("price_ratio", F.when(F.col("competitor_price") > 0, ratio).otherwise(1.0))


def bands(df: DataFrame) -> DataFrame:
    """Demand band, range-based volatility and stockout risk; unknown comparisons fall to the last case."""
    mean = F.col("rolling_7d_mean")
    spread = F.try_divide((F.col("rolling_7d_max") - F.col("rolling_7d_min")).cast("double"), mean)
    return df.withColumns({
        "demand_band": demand_band(F.col("units_sold")),
        "demand_volatility": F.when(mean > 0, round_half_up(spread, 4)).otherwise(0.0),
        "stockout_risk": F.when((F.col("lag_1d") == 0) & (F.col("lag_7d") < mean * 0.5), "High")
        .when(F.col("lag_1d") < mean * 0.3, "Medium")
        .otherwise("Low"),
    })


def drop_warmup(df: DataFrame, days: int = WARMUP_DAYS, start: DataFrame | None = None) -> DataFrame:
    first = (df if start is None else start).agg(F.min("sale_date")).scalar()
    return df.filter(F.col("sale_date") >= F.date_add(first, days))


def demand_features(enriched: DataFrame, ranked: bool = True, by_series: bool = False) -> DataFrame:
    """All warehouse-track features; needs one row per day, store and product.

    The rank takes an aggregation and a join of the whole table, which stay in a
    plan that does not read it; ``ranked=False`` leaves it out.  ``by_series`` is for rows in buckets of a series.
    """
    df = enriched.select(*BASE_COLUMNS)
    # ranked first, while the rows to shuffle are narrow
    if ranked:
        df = demand_rank_by_series(df) if by_series else demand_rank(df)
    return drop_warmup(bands(price_ratio(rolling(lags(df)))), start=enriched)
