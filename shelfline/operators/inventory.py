"""Inventory analytics: allocation, demand rates, reorder points, risk, ranges and schedules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfline.functions.columns import round_half_even
from shelfline.functions.joins import null_safe_join
from shelfline.functions.ordering import counts_upto, order_statistics, running_total, with_position
from shelfline.session import materialize

# Worth of a unit below which it counts as nothing.
_EPSILON = 1e-9


# Allocation

def allocate(requests: DataFrame, unit_cap: int | None = None, group_limit: int = 1_000_000) -> DataFrame:
    """Units per store that fulfil the most demand of each group.

    A unit is worth 1 up to the whole part of a store's demand, then the
    fractional part once, then nothing up to the capacity.  Worth never rises
    along a store, so handing out units by falling worth is optimal; ties go to
    the store with the highest index.  That takes at most three rows per store
    and a running total, also for a group of any size.  ``unit_cap`` limits what one group hands out.
    """
    total = F.col("total_inventory")
    available = total if unit_cap is None else F.least(total, F.lit(unit_cap))
    whole, cap = F.floor("demand"), F.least(F.col("capacity"), F.col("_available"))
    full = F.least(whole, cap)
    part = F.col("demand") - whole
    partial = F.when((part > _EPSILON) & (cap > whole), 1).otherwise(0)

    def tier(worth: Column, units: Column) -> Column:
        return F.struct(worth.cast("double").alias("worth"), units.cast("long").alias("units"))

    tiers = requests.withColumn("_available", available.cast("long")).select(
        *requests.columns,
        "_available",
        F.inline(F.array(tier(F.lit(1), full), tier(part, partial), tier(F.lit(0), cap - full - partial))),
    )
    handed = running_total(
        # a store keeps its first tier even when empty, so that it stays in the result
        tiers.filter("units > 0 OR worth = 1"),
        "units", [F.col("worth").desc(), F.col("store_idx").desc()], ["group_id"], "_upto", group_limit,
    )
    left = F.greatest(F.col("_available") - (F.col("_upto") - F.col("units")), F.lit(0))
    return handed.groupBy("group_id", "store_idx").agg(
        F.first("demand").alias("demand"),
        F.first("capacity").alias("capacity"),
        F.first("total_inventory").alias("total_inventory"),
        F.sum(F.least(F.col("units"), left)).alias("allocation"),
    )


def allocation_summary(allocated: DataFrame) -> DataFrame:
    """Fulfilment of each group; the remainder counts against the requested total."""
    fulfilled, demand = F.sum(F.least(F.col("allocation"), F.col("demand"))), F.sum("demand")
    return allocated.groupBy("group_id").agg(
        round_half_even(fulfilled, 2).alias("total_fulfilled"),
        round_half_even(demand, 2).alias("total_demand"),
        F.when(demand > 0, round_half_even(F.try_divide(fulfilled, demand) * 100, 2)).otherwise(0.0).alias("fill_rate"),
        F.sum("allocation").alias("inventory_used"),
        (F.max("total_inventory") - F.sum("allocation")).alias("inventory_remaining"),
    )


def store_requests(features: DataFrame, n_stores: int | None = None, total_inventory: int = 5000) -> DataFrame:
    """One allocation group: mean demand of every store (or the first ``n_stores`` by id), capacity twice the mean."""
    means = features.filter("store_id IS NOT NULL").groupBy("store_id").agg(F.avg("units_sold").alias("demand"))
    if n_stores is None:
        means = with_position(means, [F.col("store_id")], name="store_idx")
    else:
        # a handful of rows that several later steps read
        means = materialize(means.orderBy("store_id").limit(n_stores))
        means = means.withColumn("store_idx", (F.row_number().over(Window.orderBy("store_id")) - 1).cast("long"))
    return means.select(
        F.lit("all").alias("group_id"), "store_idx", "store_id", "demand",
        F.floor(F.col("demand") * 2).alias("capacity"), F.lit(total_inventory).cast("long").alias("total_inventory"),
    )


def product_requests(features: DataFrame, total_inventory: int = 500) -> DataFrame:
    """One allocation group per product over all its stores, indexed by store id."""
    means = (
        features.filter("store_id IS NOT NULL AND product_id IS NOT NULL")
        .groupBy("product_id", "store_id").agg(F.avg("units_sold").alias("demand"))
    )
    rows = with_position(means, [F.col("store_id")], by=["product_id"], name="store_idx")
    return rows.select(
        F.col("product_id").alias("group_id"), "store_idx", "store_id", "demand",
        F.floor(F.col("demand") * 2).alias("capacity"), F.lit(total_inventory).cast("long").alias("total_inventory"),
    )


# Demand rates

def daily_totals(features: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return features.groupBy(*by, "sale_date").agg(F.sum("units_sold").alias("demand"))


def demand_rate(daily: DataFrame, window: int = 7, by: Sequence[str] = ()) -> DataFrame:
    """Mean of the last ``window`` rows wherever the window is full.

    A series shorter than the window has one rate, over all of it.  There is one
    row per day and series, so a window partition is bounded by the calendar.
    """
    series = Window.partitionBy(*by)
    ordered = series.orderBy("sale_date")
    return (
        daily.withColumns({
            "_row": F.row_number().over(ordered),
            "_rows": F.count("*").over(series),
            "rate": round_half_even(F.avg("demand").over(ordered.rowsBetween(-(window - 1), 0)), 4),
        })
        .filter(F.col("_row") >= F.least(F.lit(window), F.col("_rows")))
        .drop("_row", "_rows")
    )


def demand_anomalies(rates: DataFrame, by: Sequence[str] = (), deviations: float = 2.0) -> DataFrame:
    """Mark rates further from the mean than ``deviations`` population standard deviations."""
    series = Window.partitionBy(*by)
    distance = F.abs(F.col("rate") - F.avg("rate").over(series))
    return rates.withColumn("is_anomaly", distance > deviations * F.stddev_pop("rate").over(series))


def anomaly_summary(flagged: DataFrame, window: int = 7, by: Sequence[str] = ()) -> DataFrame:
    return flagged.groupBy(*by).agg(
        F.lit(window).alias("window_size"),
        round_half_even(F.avg("rate"), 2).alias("avg_rolling_demand"),
        F.count_if("is_anomaly").alias("anomalies_detected"),
        F.count("*").alias("total_windows"),
    )


# Order statistics

def reorder_point(
    df: DataFrame, service_level: float = 0.95, lead_time_days: int = 7, column: str = "units_sold", by: Sequence[str] = ()
) -> DataFrame:
    """Reorder point and safety stock from the demand at a service level.

    Input order does not matter.  An empty input has a reorder point of 0.
    """
    level = f"greatest(0, least(floor({float(service_level)}D * (n - 1)), n - 1))"
    picked = order_statistics(df, {column: {"level": level}}, by)
    means = df.filter(F.col(column).isNotNull()).groupBy(*by).agg(F.avg(column).alias("_mean"))
    if by:
        rows = null_safe_join(means, picked.select(*by, F.col("value").alias("_level")), list(by))
    else:
        rows = means.withColumn("_level", picked.select("value").scalar())
    mean, at_level = F.coalesce("_mean", F.lit(0.0)), F.coalesce("_level", F.lit(0.0))
    safety = F.greatest(F.lit(0), F.bround(((at_level - mean) * lead_time_days).cast("decimal(28,10)")).cast("long"))
    return rows.withColumn("safety_stock", safety).select(
        *by,
        F.bround((mean * lead_time_days + F.col("safety_stock")).cast("decimal(28,10)")).cast("long").alias("reorder_point"),
        "safety_stock",
        round_half_even(at_level, 2).alias("daily_demand_at_sl"),
        round_half_even(mean, 2).alias("avg_daily_demand"),
        F.lit(lead_time_days).alias("lead_time_days"),
        F.lit(float(service_level)).alias("service_level"),
    )


def threshold_counts(df: DataFrame, thresholds: Sequence[float] | DataFrame, column: str = "units_sold") -> DataFrame:
    """Values at most and above each threshold, and the fraction at most.

    A list is counted in one aggregation; a frame with a ``threshold`` column may
    have any number of rows.
    """
    if isinstance(thresholds, DataFrame):
        found = counts_upto(df, column, thresholds, "threshold").select(
            "threshold", F.col("count_upto").alias("count_below"), "total"
        )
    else:
        value = F.col(column)
        counts = [F.count_if(value <= t).alias(f"_{i}") for i, t in enumerate(thresholds)]
        found = df.agg(F.count(value).alias("total"), *counts).select(
            "total",
            F.inline(F.array(*[
                F.struct(F.lit(float(t)).alias("threshold"), F.col(f"_{i}").alias("count_below"))
                for i, t in enumerate(thresholds)
            ])),
        )
    return found.select(
        "threshold",
        "count_below",
        (F.col("total") - F.col("count_below")).alias("count_above"),
        F.coalesce(F.try_divide(F.col("count_below"), F.col("total")), F.lit(0.0)).alias("fraction_below"),
    )


def _picked(df: DataFrame, column: str, rules: dict[float, str], name: str, by: Sequence[str]) -> DataFrame:
    found = order_statistics(df, {column: {str(k): rule for k, rule in rules.items()}}, by)
    return found.select(*by, F.col("label").cast("double").alias(name), "value")


def threshold_for_rate(
    df: DataFrame, rates: Sequence[float], column: str = "units_sold", by: Sequence[str] = ()
) -> DataFrame:
    """The value below which about ``rate`` of the rows lie; the extremes outside (0, 1), and 0 without rows."""
    def rule(rate: float) -> str:
        if rate <= 0:
            return "0"
        return "n - 1" if rate >= 1 else f"least(floor({rate}D * n), n - 1)"

    found = _picked(df, column, {float(r): rule(float(r)) for r in rates}, "rate", by)
    if by:
        return found
    asked = df.sparkSession.createDataFrame([(float(r),) for r in rates], "rate double").distinct()
    return asked.join(found, "rate", "left").fillna(0.0, ["value"])


def percentile_lookup(
    df: DataFrame, percents: Sequence[float], column: str = "units_sold", by: Sequence[str] = ()
) -> DataFrame:
    """The value at each percentile, without interpolation."""
    if any(not 0 <= p <= 100 for p in percents):
        raise ValueError("percentiles lie between 0 and 100")
    return _picked(df, column, {float(p): f"floor({p / 100}D * (n - 1))" for p in percents}, "percentile", by)


# Risk and segments

def stockout_risk(features: DataFrame) -> DataFrame:
    """Variation of demand per product; a single observation has none."""
    mean, std = F.avg("units_sold"), F.stddev_samp("units_sold")
    return features.groupBy("product_id").agg(
        (F.coalesce(std, F.lit(0.0)) / F.greatest(F.coalesce(mean, F.lit(0.0)), F.lit(1.0))).alias("risk_score")
    )


def top_k(scores: DataFrame, k: int, score: str = "risk_score", item: str = "product_id") -> DataFrame:
    """The k highest scores; among equal ones the higher id comes first."""
    return scores.orderBy(F.col(score).desc(), F.col(item).desc()).limit(k)


def top_k_per_group(
    scores: DataFrame, by: Sequence[str], k: int, score: str = "risk_score", item: str = "product_id"
) -> DataFrame:
    """``top_k`` within each group, with ``rank`` from 1.

    For a usual k each task keeps k rows per group before the shuffle.  Beyond
    the planner's limit for that, ranks come from a global sort instead.
    """
    order = [F.col(score).desc(), F.col(item).desc()]
    limit = int(scores.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if k <= limit:
        ranked = scores.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    else:
        ranked = with_position(scores, order, by, "rank").withColumn("rank", (F.col("rank") + 1).cast("int"))
    return ranked.filter(F.col("rank") <= k)


def segment_stats(df: DataFrame, segment: str | None = None) -> DataFrame:
    """Count, demand and revenue per segment: the volatility band where there is one, else the store."""
    if segment is None:
        segment = "volatility_band" if "volatility_band" in df.columns else "store_id"
    revenue = F.sum("revenue") if "revenue" in df.columns else F.lit(0.0)
    return df.groupBy(F.col(segment).cast("string").alias("segment")).agg(
        F.count("*").alias("count"),
        round_half_even(F.sum("units_sold"), 2).alias("total_demand"),
        round_half_even(F.avg("units_sold"), 2).alias("avg_demand"),
        round_half_even(revenue, 2).alias("total_revenue"),
    )


# Ranges

def prefix_sums(daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Running totals of a daily series: ``position`` 0 holds 0, position i the first i days."""
    ordered = Window.partitionBy(*by).orderBy("sale_date")
    upto = F.sum("demand").over(ordered.rowsBetween(Window.unboundedPreceding, 0)).cast("double")
    rows = daily.select(*by, F.row_number().over(ordered).alias("_row"), upto.alias("_upto"))

    def entry(position: Column, prefix: Column) -> Column:
        return F.struct(position.cast("long").alias("position"), prefix.alias("prefix"))

    here = entry(F.col("_row"), F.col("_upto"))
    start = entry(F.lit(0), F.lit(0.0))
    return rows.select(*by, F.inline(F.when(F.col("_row") == 1, F.array(start, here)).otherwise(F.array(here))))


def range_demand(prefix: DataFrame, queries: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Total demand of each query's 0-based, inclusive ``[left, right]``.

    Bounds are clamped to the series.  A query outside of it has a NULL total.
    """
    by = list(by)
    lengths = prefix.groupBy(*by).agg(F.max("position").alias("_n"))
    if by:
        asked = queries.join(lengths, by, "left")
    else:
        asked = queries.withColumn("_n", lengths.scalar())
    asked = asked.withColumns({
        "_from": F.greatest(F.col("left"), F.lit(0)).cast("long"),
        "_to": (F.least(F.col("right"), F.col("_n") - 1) + 1).cast("long"),
    })
    for bound in ("_from", "_to"):
        side = prefix.select(*by, F.col("position").alias(bound), F.col("prefix").alias(f"{bound}_sum"))
        asked = asked.join(side, [*by, bound], "left")
    return asked.select(
        *queries.columns, round_half_even(F.col("_to_sum") - F.col("_from_sum"), 2).alias("total_demand")
    )


# Schedules

def reorder_schedule(requests: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Reorder requests with their ``dispatch_order`` from 1: most urgent first, then first come (``seq``)."""
    ordered = with_position(requests, [F.col("urgency").desc(), F.col("seq")], by, "dispatch_order")
    return ordered.withColumn("dispatch_order", F.col("dispatch_order") + 1)


def next_reorders(requests: DataFrame, n: int = 1) -> DataFrame:
    """The n requests to dispatch next, without numbering the others."""
    return requests.orderBy(F.col("urgency").desc(), F.col("seq")).limit(n)


def after_reorders(requests: DataFrame, n: int = 1) -> DataFrame:
    """What is left once the next n requests are dispatched."""
    return requests.join(next_reorders(requests, n).select("seq"), "seq", "left_anti")


# Report

def inventory_report(features: DataFrame, k: int = 20, window: int = 7) -> dict[str, DataFrame]:
    """All results of the inventory analysis by name."""
    allocated = allocate(store_requests(features))
    flagged = demand_anomalies(demand_rate(daily_totals(features), window))
    risky = top_k(stockout_risk(features), k).withColumn("risk_score", round_half_even(F.col("risk_score"), 4))
    return {
        "allocation": allocated,
        "allocation_summary": allocation_summary(allocated),
        "sliding_window": anomaly_summary(flagged, window),
        "reorder_point": reorder_point(features),
        "top_k_stockout": risky,
        "category_analysis": segment_stats(features),
    }
