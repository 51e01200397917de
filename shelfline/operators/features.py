"""Demand features on the daily store and product series.

Lags and windows count rows of a series, not days.  All series functions share
one partitioning.  ``build_features`` orders the series by a year column of its
own and the date, which the windows within a year need as well, so the whole
chain costs one shuffle and one sort.  After ``aggregate_daily`` a series has at most one row per calendar day,
which bounds a window partition whatever the number of sales behind it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from shelfline import schemas
from shelfline.functions.columns import (
    calendar_columns, fourier_columns, numeric_columns, volatility_band,
)

SERIES = ("store_id", "product_id")
LAGS = (1, 3, 7, 14, 30)
WINDOWS = (7, 14, 30)
WARMUP_DAYS = 30


# Year of the sale, carried along a chain of series functions so that their windows share one sort.
YEAR = "_year"


def series_window(df: DataFrame) -> WindowSpec:
    """Rows of a series by date: one sort for all functions that use it."""
    return Window.partitionBy(*SERIES).orderBy(*[c for c in (YEAR,) if c in df.columns], "sale_date")


def aggregate_daily(df: DataFrame) -> DataFrame:
    """One row per day, store and product; rows with a missing key are left out."""
    keys = ["sale_date", *SERIES]
    df = df.filter(" AND ".join(f"{k} IS NOT NULL" for k in keys))
    return df.groupBy(*keys).agg(
        F.coalesce(F.sum("units_sold"), F.lit(0)).alias("units_sold"),
        F.coalesce(F.sum("revenue"), F.lit(0)).alias("revenue"),
        F.avg("unit_price").alias("avg_price"),
        F.avg("competitor_price").alias("avg_competitor_price"),
        F.max("discount_pct").alias("max_discount"),
        F.max("is_promotion").alias("had_promotion"),
        F.max("is_holiday").alias("is_holiday"),
    )


def lag_features(df: DataFrame, target: str = "units_sold", lags: Sequence[int] = LAGS) -> DataFrame:
    w = series_window(df)
    return df.withColumns({f"lag_{n}d": F.lag(target, n).over(w) for n in lags})


def calendar_lag_features(df: DataFrame, target: str = "units_sold", lags: Sequence[int] = LAGS) -> DataFrame:
    """Lags by days instead of rows: the value exactly ``n`` days earlier, else NULL."""
    day = F.datediff("sale_date", F.lit("1970-01-01").cast("date"))
    w = Window.partitionBy(*SERIES).orderBy(day)
    return df.withColumns({f"lag_{n}d": F.max(target).over(w.rangeBetween(-n, -n)) for n in lags})


def rolling_features(df: DataFrame, target: str = "units_sold", windows: Sequence[int] = WINDOWS) -> DataFrame:
    """Mean, sample deviation and maximum of the previous rows, the current one excluded."""
    columns: dict[str, Column] = {}
    for n in windows:
        w = series_window(df).rowsBetween(-n, -1)
        columns[f"rolling_{n}d_mean"] = F.avg(target).over(w)
        columns[f"rolling_{n}d_std"] = F.stddev_samp(target).over(w)
        columns[f"rolling_{n}d_max"] = F.max(target).over(w)
    return df.withColumns(columns)


def price_features(df: DataFrame) -> DataFrame:
    """Price relative to the competitor and to the previous row, and a discount flag."""
    price, rival = F.col("avg_price"), F.col("avg_competitor_price")
    before = F.lag("avg_price", 1).over(series_window(df))
    change = (
        F.when(before.isNull() | price.isNull(), 0.0)
        .when(before == 0, F.signum(price).cast("double"))
        .otherwise(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.try_divide(price, before) - 1)))
    )
    return df.withColumns({
        "price_ratio": F.when(rival > 0, F.try_divide(price, rival)).otherwise(1.0),
        "price_change_pct": change,
        "discount_flag": F.coalesce(F.col("max_discount") > 0, F.lit(False)).cast("int"),
    })


def seasonality_features(df: DataFrame) -> DataFrame:
    date = F.col("sale_date")
    columns = {k: v for k, v in calendar_columns(date).items() if k != "year"}
    columns["is_month_start"] = (F.dayofmonth(date) <= 5).cast("int")
    columns["is_month_end"] = (F.dayofmonth(date) >= 25).cast("int")
    return df.withColumns({**columns, **fourier_columns(date)})


def demand_features(df: DataFrame) -> DataFrame:
    """Velocity, volatility with its band, and the running total of the year."""
    units = F.col("units_sold")
    std = F.col("rolling_7d_std") if "rolling_7d_std" in df.columns else F.lit(0.0)
    mean = F.col("rolling_7d_mean") if "rolling_7d_mean" in df.columns else F.lit(1.0)
    ratio = F.try_divide(std, mean)
    volatility = F.when(mean > 0, F.when(ratio.isNotNull(), F.least(ratio, F.lit(5.0)))).otherwise(0.0)
    year = F.col(YEAR) if YEAR in df.columns else F.year("sale_date")
    of_year = Window.partitionBy(*SERIES, year).orderBy("sale_date").rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumns({
        "demand_velocity": F.coalesce(units - F.lag(units, 1).over(series_window(df)), F.lit(0)),
        "demand_volatility": volatility,
        "ytd_cumulative": F.sum(units).over(of_year),
    })
    return df.withColumn("volatility_band", volatility_band(F.col("demand_volatility")))


def drop_warmup(df: DataFrame, days: int = WARMUP_DAYS, start: DataFrame | None = None) -> DataFrame:
    """Drop the first ``days`` days of the whole data set; ``start`` may supply its first date as one row."""
    first = (df if start is None else start).agg(F.min("sale_date")).scalar()
    return df.filter(F.col("sale_date") >= F.date_add(first, days))


def fill_remaining(df: DataFrame) -> DataFrame:
    return df.fillna(0, numeric_columns(df))


BAND_LEVELS = sorted(
    [name for name, _ in schemas.VOLATILITY_EDGES] + [schemas.VOLATILITY_TOP, schemas.VOLATILITY_UNDEFINED]
)


def encode_features(df: DataFrame, levels: Sequence[str] = BAND_LEVELS, keep: Sequence[str] = ()) -> DataFrame:
    """Model input: one 0/1 column per band but the first level, no ids, dates or text.

    The level list is fixed, so the columns do not depend on which bands occur.
    ``keep`` names columns that stay before them as they are.
    """
    if "volatility_band" in df.columns:
        df = df.withColumns({
            f"volatility_band_{level}": (F.col("volatility_band") == level).cast("int") for level in list(levels)[1:]
        })
    return df.select(*keep, *numeric_columns(df.drop(*SERIES, *keep)))


# Columns that hold the target or are computed from its current value.
LEAKING = ["revenue", "avg_price", "demand_velocity", "ytd_cumulative"]


def build_features(cleaned: DataFrame, leak_free: bool = False) -> tuple[DataFrame, DataFrame]:
    """All features from cleaned sales: (with ids, encoded for a model)."""
    df = aggregate_daily(cleaned).withColumn(YEAR, F.year("sale_date"))
    df = demand_features(seasonality_features(price_features(rolling_features(lag_features(df))))).drop(YEAR)
    known = cleaned.filter(" AND ".join(f"{k} IS NOT NULL" for k in SERIES))
    df = fill_remaining(drop_warmup(df, start=known))
    encoded = encode_features(df)
    return df, encoded.drop(*LEAKING) if leak_free else encoded
