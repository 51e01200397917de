"""The queries behind the dashboard's tiles, charts and summary table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def kpi(features: DataFrame) -> DataFrame:
    """Records, revenue, mean demand and the number of products with a high stockout risk."""
    return features.agg(
        F.count("*").alias("records"),
        F.sum("revenue").alias("total_revenue"),
        F.avg("units_sold").alias("avg_demand"),
        F.count_distinct(F.when(F.col("stockout_risk") == "High", F.col("product_id"))).alias("at_risk_products"),
    )


def revenue_by_category(features: DataFrame) -> DataFrame:
    return features.groupBy("category").agg(F.sum("revenue").alias("total_revenue"))


def _share(df: DataFrame, value: str, name: str) -> DataFrame:
    """Percentage of the total; ``df`` is already grouped to a handful of rows."""
    total = F.sum(value).over(Window.partitionBy())
    return df.withColumn(name, F.try_divide(F.col(value) * F.lit(100.0), total))


def region_share(features: DataFrame) -> DataFrame:
    return _share(features.groupBy("region").agg(F.sum("units_sold").alias("total_units")), "total_units", "share_pct")


def monthly_revenue(features: DataFrame) -> DataFrame:
    """Revenue of every month and year that occurs."""
    return features.groupBy(F.month("sale_date").alias("month"), F.year("sale_date").alias("year")).agg(
        F.sum("revenue").alias("revenue")
    )


def monthly_revenue_by_year(features: DataFrame, years: Sequence[int] | None = None) -> DataFrame:
    """One row per month and one revenue column ``y<year>`` per year.

    Without a list the years present are looked up first, which is one small result.
    """
    by_month = features.groupBy(F.month("sale_date").alias("month"), F.year("sale_date").alias("year")).agg(
        F.sum("revenue").alias("revenue")
    )
    if years is None:
        years = [r["year"] for r in by_month.select("year").distinct().orderBy("year").collect()]
    return by_month.groupBy("month").agg(*[
        F.sum(F.when(F.col("year") == y, F.col("revenue"))).alias(f"y{y}") for y in years
    ])


def band_distribution(features: DataFrame) -> DataFrame:
    return _share(features.groupBy("demand_band").agg(F.count("*").alias("records")), "records", "share_pct")


def category_avg_demand(features: DataFrame) -> DataFrame:
    return features.groupBy("category").agg(F.avg("units_sold").alias("avg_demand"))


def promo_vs_base(features: DataFrame) -> DataFrame:
    """Mean demand with and without a promotion, and the lift of the means in percent."""
    def mean(promotion: int) -> Column:
        return F.avg(F.when(F.col("is_promotion") == promotion, F.col("units_sold")))

    return features.groupBy("category").agg(
        mean(1).alias("promo_avg"),
        mean(0).alias("base_avg"),
        ((F.try_divide(mean(1), mean(0)) - 1) * 100).alias("promo_lift_pct"),
    )


def category_volatility(features: DataFrame) -> DataFrame:
    return features.groupBy("category").agg(F.avg("demand_volatility").alias("avg_volatility"))


def weekday_demand(features: DataFrame) -> DataFrame:
    """Mean demand per weekday, Monday being 0."""
    return features.groupBy(F.weekday("sale_date").alias("day_of_week")).agg(F.avg("units_sold").alias("avg_demand"))


def _badge(value: Column, cuts: Sequence[float], names: Sequence[str]) -> Column:
    badge = F.when(value < cuts[0], names[0])
    for cut, name in zip(cuts[1:], names[1:]):
        badge = badge.when(value < cut, name)
    return badge.otherwise(names[-1])


def category_summary(
    features: DataFrame,
    volatility_cuts: Sequence[float] = (0.5, 1.0),
    risk_cuts: Sequence[float] = (1.0, 5.0),
    badges: Sequence[str] = ("Low", "Medium", "High"),
) -> DataFrame:
    """Demand, revenue, promotion lift and two badges per category, from one aggregation.

    The cut-offs are upper edges: of the mean volatility, and of the share of
    high-risk rows in percent.
    """
    summary = features.groupBy("category").agg(
        F.avg("units_sold").alias("avg_demand"),
        F.sum("revenue").alias("total_revenue"),
        ((F.try_divide(
            F.avg(F.when(F.col("is_promotion") == 1, F.col("units_sold"))),
            F.avg(F.when(F.col("is_promotion") == 0, F.col("units_sold"))),
        ) - 1) * 100).alias("promo_lift_pct"),
        F.avg("demand_volatility").alias("avg_volatility"),
        (F.count_if(F.col("stockout_risk") == "High") * 100.0 / F.count("*")).cast("double").alias("high_risk_pct"),
    )
    return summary.withColumns({
        "volatility_badge": _badge(F.col("avg_volatility"), volatility_cuts, badges),
        "risk_badge": _badge(F.col("high_risk_pct"), risk_cuts, badges),
    })
