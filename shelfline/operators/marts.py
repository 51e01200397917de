"""The five published marts over the warehouse-track features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfline.functions.columns import round_half_up


def _days_at(risk: str) -> Column:
    return F.sum(F.when(F.col("stockout_risk") == risk, 1).otherwise(0))


def daily_store_demand(features: DataFrame) -> DataFrame:
    return features.groupBy("sale_date", "store_id", "region", "store_type").agg(
        F.count("*").alias("num_transactions"),
        F.sum("units_sold").alias("total_units"),
        F.sum("revenue").alias("total_revenue"),
        F.avg("units_sold").alias("avg_units"),
        F.avg("price_ratio").alias("avg_price_ratio"),
    )


def category_demand(features: DataFrame) -> DataFrame:
    """Category totals; the promotion lift is a ratio of totals, NULL without regular sales."""
    def units(promotion: int) -> Column:
        return F.sum(F.when(F.col("is_promotion") == promotion, F.col("units_sold")).otherwise(0))

    return features.groupBy("category").agg(
        F.count("*").alias("total_records"),
        F.sum("units_sold").alias("total_units"),
        F.sum("revenue").alias("total_revenue"),
        F.avg("units_sold").alias("avg_daily_demand"),
        F.avg("demand_volatility").alias("avg_volatility"),
        _days_at("High").alias("high_stockout_count"),
        round_half_up(F.try_divide(units(1), F.nullif(units(0), F.lit(0))), 4).alias("promo_demand_lift"),
    )


def regional_demand(features: DataFrame, approximate: bool = False) -> DataFrame:
    """Region by month; ``approximate`` counts stores and products by sketches in one aggregation."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return features.groupBy(
        "region", F.month("sale_date").alias("month"), F.year("sale_date").alias("year")
    ).agg(
        F.sum("units_sold").alias("total_units"),
        F.sum("revenue").alias("total_revenue"),
        F.avg("units_sold").alias("avg_demand"),
        distinct("store_id").alias("active_stores"),
        distinct("product_id").alias("active_products"),
    )


def stockout_summary(features: DataFrame, min_days: int = 30) -> DataFrame:
    """Risk days per product; only products seen on more than ``min_days`` rows."""
    return (
        features.groupBy("product_id", "category")
        .agg(
            F.count("*").alias("total_days"),
            _days_at("High").alias("high_risk_days"),
            _days_at("Medium").alias("medium_risk_days"),
            round_half_up(_days_at("High") / F.count("*") * 100, 2).alias("stockout_frequency_pct"),
            F.avg("units_sold").alias("avg_demand"),
            F.avg("demand_volatility").alias("avg_volatility"),
        )
        .filter(F.col("total_days") > min_days)
    )


def promo_impact(features: DataFrame) -> DataFrame:
    return features.groupBy("category", "is_promotion").agg(
        F.count("*").alias("record_count"),
        F.avg("units_sold").alias("avg_demand"),
        F.avg("revenue").cast("double").alias("avg_revenue"),
        F.avg("price_ratio").alias("avg_price_ratio"),
    )


def region_subtotals(features: DataFrame) -> DataFrame:
    """Totals per store, per region and overall in one aggregation.

    ``level`` tells what a row is: 0 a store, 1 a region, 3 everything.  A NULL region or store
    at a level that has it is a group of its own, not a subtotal.
    """
    return features.rollup("region", "store_id").agg(
        F.grouping_id().cast("int").alias("level"), F.count("*").alias("num_transactions"), F.sum("units_sold").alias("total_units"),
        F.sum("revenue").alias("total_revenue"), F.avg("units_sold").alias("avg_units"))


def build_marts(features: DataFrame) -> dict[str, DataFrame]:
    return {
        "mv_daily_store_demand": daily_store_demand(features),
        "mv_category_demand": category_demand(features),
        "mv_regional_demand": regional_demand(features),
        "mv_stockout_summary": stockout_summary(features),
        "mv_promo_impact": promo_impact(features),
    }
