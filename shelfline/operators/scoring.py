"""Rule-based demand forecasts for validated requests, in batch or on a stream.

Every function is a projection without a shuffle, so the same code scores a
table of any size and each micro-batch of a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfline import schemas
from shelfline.functions.columns import demand_band, python_number_text, round_half_even

# Texts of the risk factors.
RISK_PRICE = "Price higher than competitor by >10%"
RISK_DISCOUNT = "Heavy discount (%s%%) may spike demand"
RISK_PROMOTION = "Active promotion — expect 50%+ demand increase"
RISK_HOLIDAY = "Holiday period — expect 80%+ demand surge"
RISK_SPIKE = "Recent demand spike detected"
RISK_NONE = "No significant risk factors"

# Confidence without and with a trained model at hand.
CONFIDENCE_RULES, CONFIDENCE_MODEL = 0.75, 0.92


def request_id() -> Column:
    """First 12 hex digits of an MD5 over store, product, price and weekly lag."""
    text = F.concat_ws(
        "_", "store_id", "product_id",
        python_number_text(F.col("current_price")), python_number_text(F.col("lag_7d")),
    )
    return F.substring(F.md5(text), 1, 12)


def rule_forecast() -> Column:
    """Category base, moved by price, promotion and holiday, blended with recent demand."""
    names = [F.lit(x) for pair in schemas.CATEGORY_DEMAND.items() for x in pair]
    base = F.coalesce(F.create_map(*names)[F.col("category")], F.lit(schemas.DEFAULT_CATEGORY_DEMAND)).cast("double")
    rival, mean = F.col("competitor_price"), F.col("rolling_7d_mean")
    ratio = F.when(rival > 0, F.try_divide("current_price", rival))
    base = base * F.when(ratio > 1.1, 0.8).when(ratio < 0.9, 1.2).otherwise(1.0)
    base = base * F.when(F.col("is_promotion") != 0, 1.5).otherwise(1.0)
    base = base * F.when(F.col("is_holiday") != 0, 1.8).otherwise(1.0)
    blended = F.when(mean > 0, 0.4 * base + 0.6 * mean).otherwise(base)
    return F.greatest(F.lit(0.0), round_half_even(blended, 2))


def recommendation(demand: Column, mean: Column) -> Column:
    return F.when(demand > mean * 1.5, "REORDER_NOW").when(demand > mean * 1.1, "MONITOR").otherwise("SUFFICIENT")


def risk_factors() -> Column:
    """Texts of the risks that apply, in a fixed order; one text says that there is none."""
    rival, mean, discount = F.col("competitor_price"), F.col("rolling_7d_mean"), F.col("discount_pct")
    found = F.array_compact(F.array(
        F.when((rival > 0) & (F.col("current_price") > rival * 1.1), RISK_PRICE),
        F.when(discount > 20, F.format_string(RISK_DISCOUNT, python_number_text(discount))),
        F.when(F.col("is_promotion") != 0, RISK_PROMOTION),
        F.when(F.col("is_holiday") != 0, RISK_HOLIDAY),
        F.when((mean > 0) & (F.col("lag_7d") > mean * 1.5), RISK_SPIKE),
    ))
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(RISK_NONE)))


def score(requests: DataFrame, model_loaded: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Forecast responses for valid requests; ``keep`` passes further columns through."""
    rows = requests.withColumn("predicted_demand", rule_forecast())
    predicted = F.col("predicted_demand")
    mean = F.when(F.col("rolling_7d_mean") > 0, F.col("rolling_7d_mean")).otherwise(predicted)
    return rows.select(
        request_id().alias("request_id"),
        "store_id",
        "product_id",
        "predicted_demand",
        demand_band(predicted).alias("demand_band"),
        recommendation(predicted, mean).alias("reorder_recommendation"),
        F.lit(CONFIDENCE_MODEL if model_loaded else CONFIDENCE_RULES).alias("confidence"),
        risk_factors().alias("risk_factors"),
        *keep,
    )


def first_answers(scored: DataFrame, arrival: str) -> DataFrame:
    """One response per request id, the one that arrived first; ties by the remaining values."""
    others = ["predicted_demand", "demand_band", "reorder_recommendation", "risk_factors"]
    w = Window.partitionBy("request_id").orderBy(arrival, *others)
    return scored.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")
