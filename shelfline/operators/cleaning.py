"""Frame-style cleaning: parse, deduplicate, impute and cap on both sides."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from shelfline import schemas
from shelfline.functions.columns import calendar_columns, numeric_columns, parsed_date, string_columns
from shelfline.functions.joins import small_side
from shelfline.functions.ordering import approximate_quantiles, order_statistics, quantile_name, quantile_position, quantiles

LOW, MEDIAN, HIGH = 0.01, 0.5, 0.99


def merge_metadata(sales: DataFrame, stores: DataFrame | None, products: DataFrame | None) -> DataFrame:
    """Left join the store and product attributes that the sales do not have yet."""
    if stores is not None:
        sales = sales.join(small_side(stores), "store_id", "left")
    if products is not None:
        new = [c for c in products.columns if c not in sales.columns]
        sales = sales.join(small_side(products.select("product_id", *new)), "product_id", "left")
    return sales


def parse_dates(df: DataFrame) -> DataFrame:
    """Parse ``sale_date``, drop rows without a valid one, and set the calendar columns."""
    df = df.withColumn("sale_date", parsed_date(F.col("sale_date"))).filter(F.col("sale_date").isNotNull())
    return df.withColumns(calendar_columns(F.col("sale_date")))


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Keep one of each set of identical rows; copies are merged before the shuffle."""
    return df.dropDuplicates()


def drop_negative_sales(df: DataFrame) -> DataFrame:
    """Keep rows whose units and revenue are known and not negative."""
    df = df.filter(F.col("units_sold") >= 0)
    return df.filter(F.col("revenue") >= 0) if "revenue" in df.columns else df


def modes(df: DataFrame, columns: list[str]) -> DataFrame:
    """Most frequent value of each text column, the smallest one on ties."""
    counts = (
        df.select(*columns)
        .unpivot([], columns, "column", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )
    return counts.groupBy("column").agg(F.min(F.struct(-F.col("n"), F.col("value")))["value"].alias("mode"))


def missing_counts(df: DataFrame) -> dict[str, int]:
    """Number of NULLs in each numeric and text column."""
    columns = numeric_columns(df) + string_columns(df)
    row = df.agg(F.count("*"), *[F.count(c) for c in columns]).first()
    return {c: row[0] - known for c, known in zip(columns, row[1:])}


def _mode_values(df: DataFrame, gaps: dict[str, int]) -> dict[str, object]:
    wanted = [c for c in string_columns(df) if gaps[c]]
    return {r["column"]: r["mode"] for r in modes(df, wanted).collect()} if wanted else {}


def fill_values(df: DataFrame) -> dict[str, object]:
    """Median or mode of each column that has a NULL; one value per column comes to the driver."""
    gaps = missing_counts(df)
    fills = _mode_values(df, gaps)
    wanted = [c for c in numeric_columns(df) if gaps[c]]
    if wanted:
        row = quantiles(df, {c: [MEDIAN] for c in wanted}).first()
        fills.update({c: row[quantile_name(c, MEDIAN)] for c in wanted if row[quantile_name(c, MEDIAN)] is not None})
    return fills


def _filled(df: DataFrame, fills: dict[str, object]) -> DataFrame:
    types = dict(df.dtypes)
    return df.withColumns({
        c: F.coalesce(F.col(c) if types[c] == "string" else F.col(c).cast("double"), F.lit(v)) for c, v in fills.items()
    })


def impute(df: DataFrame) -> DataFrame:
    """Fill missing numbers with the median and missing text with the mode; dates stay as they are.

    A filled numeric column becomes a double, since a median may fall between two values.
    """
    return _filled(df, fill_values(df))


def cap_columns(df: DataFrame) -> list[str]:
    return [c for c in numeric_columns(df) if c not in schemas.UNCAPPED and not c.endswith("_id")]


def winsorize(df: DataFrame, exact: bool = True) -> DataFrame:
    """Clip numeric columns to their 1st and 99th percentile, unless both are equal.

    Flags, calendar columns and ids are left alone.  ``exact=False`` takes the
    percentiles from sketches in one pass.
    """
    columns = cap_columns(df)
    if not columns:
        return df
    find = quantiles if exact else approximate_quantiles
    row = find(df, {c: [LOW, HIGH] for c in columns}).first()
    return _clipped(df, {c: (row[quantile_name(c, LOW)], row[quantile_name(c, HIGH)]) for c in columns})


def _clipped(df: DataFrame, limits: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    clipped = {}
    for c, (low, high) in limits.items():
        if low is not None and low != high:
            value = F.col(c).cast("double")
            clipped[c] = F.when(value.isNotNull(), F.greatest(F.least(value, F.lit(high)), F.lit(low)))
    return df.withColumns(clipped) if clipped else df


def impute_and_winsorize(df: DataFrame) -> DataFrame:
    """``winsorize(impute(df))`` with one search for medians and percentiles instead of two.

    Filling the m gaps of a column puts m copies of its median in the middle of
    its n sorted values, so the value at position k of the filled column is the
    value at k or k - m of the original one, or the median itself.
    """
    gaps = missing_counts(df)
    capped = cap_columns(df)
    needed = [c for c in numeric_columns(df) if gaps[c] or c in capped]
    fills: dict[str, object] = _mode_values(df, gaps)
    if not needed:
        return _filled(df, fills)

    def at(q: float, side: str, m: int) -> str:
        k, middle = f"{side}({quantile_position(q, f'(n + {m})')})", "ceil(n / 2)"
        return f"CASE WHEN {k} < {middle} THEN {k} WHEN {k} >= {middle} + {m} THEN {k} - {m} ELSE -1 END"

    picks = {}
    for c in needed:
        wanted = {f"{LOW}": (LOW, gaps[c]), f"{HIGH}": (HIGH, gaps[c])} if c in capped else {}
        if gaps[c]:
            wanted["median"] = (MEDIAN, 0)
        picks[c] = {f"{name} {side}": at(q, side, m) for name, (q, m) in wanted.items() for side in ("floor", "ceil")}
    found = {(r["column"], r["label"]): r for r in order_statistics(df, picks).collect()}
    totals = {c: r["total"] for (c, _), r in found.items()}

    def between(low: float, high: float, q: float, n: int) -> float:
        share = q * (n - 1)
        return low + (high - low) * (share - math.floor(share))

    limits = {}
    for c, n in totals.items():
        if gaps[c]:
            fills[c] = between(found[c, "median floor"]["value"], found[c, "median ceil"]["value"], MEDIAN, n)
        if c in capped:
            def value(label: str) -> float:
                return found[c, label]["value"] if (c, label) in found else fills[c]

            limits[c] = tuple(
                between(value(f"{q} floor"), value(f"{q} ceil"), q, n + gaps[c]) for q in (LOW, HIGH)
            )
    return _clipped(_filled(df, fills), limits)
