"""Quality gates, table constraints and request validation with quarantine."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shelfline import schemas

Rules = Mapping[str, Column]


def quality_report(df: DataFrame, min_rows: int = 100_000, min_dates: int = 100, min_stores: int = 1) -> DataFrame:
    """Five checks from one pass: (check, passed, observed)."""
    nulls = sum((F.count_if(F.col(c).isNull()) for c in df.columns[1:]), F.count_if(F.col(df.columns[0]).isNull()))
    seen = df.agg(
        nulls.alias("nulls"),
        F.count("*").alias("rows"),
        F.count_if(~F.coalesce(F.col("units_sold") >= 0, F.lit(False))).alias("bad_units"),
        F.count_distinct("sale_date").alias("dates"),
        F.count_distinct("store_id").alias("stores"),
    )

    def check(name: str, passed: Column, observed: str) -> Column:
        return F.struct(F.lit(name).alias("check"), passed.alias("passed"), F.col(observed).alias("observed"))

    return seen.select(F.inline(F.array(
        check("no_nulls", F.col("nulls") == 0, "nulls"),
        check("enough_rows", F.col("rows") > min_rows, "rows"),
        check("no_negative_units", F.col("bad_units") == 0, "bad_units"),
        check("has_date_range", F.col("dates") > min_dates, "dates"),
        check("has_multiple_stores", F.col("stores") > min_stores, "stores"),
    )))


def violations(rules: Rules) -> Column:
    """Names of the rules a row breaks; a rule whose outcome is unknown counts as broken."""
    return F.array_compact(F.array(*[
        F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()
    ]))


def with_violations(df: DataFrame, rules: Rules) -> DataFrame:
    return df.withColumn("violations", violations(rules))


def keeps_all(rules: Rules) -> Column:
    """Whether a row keeps every rule; stops at the first broken one."""
    kept = F.lit(True)
    for rule in rules.values():
        kept = kept & F.coalesce(rule, F.lit(False))
    return kept


def validate(df: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """Split into rows that keep every rule and quarantined rows with their ``violations``."""
    kept = keeps_all(rules)
    return df.filter(kept), with_violations(df.filter(~kept), rules)


def table_rules(table: str) -> dict[str, Column]:
    """Row rules of a declared table: NOT NULL columns and text lengths."""
    rules = {f"{c}_not_null": F.col(c).isNotNull() for c in schemas.NOT_NULL.get(table, ())}
    for c, size in schemas.MAX_LENGTH.get(table, {}).items():
        rules[f"{c}_length"] = F.col(c).isNull() | (F.length(c) <= size)
    return rules


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


# Limits of a forecast request.
MAX_ID_LENGTH = 10
MAX_PRICE = 10_000
REASONABLE_PRICE = 5_000
OPTIONAL_FIELDS = [
    "competitor_price", "is_promotion", "discount_pct", "is_holiday", "lag_7d", "lag_30d", "rolling_7d_mean",
    "rolling_30d_mean",
]


def with_request_defaults(df: DataFrame) -> DataFrame:
    """Missing optional fields are 0, as are NULLs in them."""
    types = {f.name: f.dataType for f in schemas.FORECAST_REQUEST}
    return df.withColumns({
        c: F.coalesce(F.col(c) if c in df.columns else F.lit(None), F.lit(0)).cast(types[c]) for c in OPTIONAL_FIELDS
    })


def request_rules() -> dict[str, Column]:
    """Field rules of a forecast request."""
    def text(name: str) -> Column:
        return F.length(name).between(1, MAX_ID_LENGTH)

    price, rival = F.col("current_price"), F.col("competitor_price")
    rules = {
        "store_id": text("store_id"),
        "product_id": text("product_id"),
        "category": F.col("category").isin(schemas.CATEGORIES),
        "current_price": (price > 0) & (price <= MAX_PRICE),
        "current_price_reasonable": price <= REASONABLE_PRICE,
        "competitor_price": rival.between(0, MAX_PRICE),
        "is_promotion": F.col("is_promotion").isin(0, 1),
        "discount_pct": F.col("discount_pct").between(0, 100),
        "is_holiday": F.col("is_holiday").isin(0, 1),
    }
    for c in ("lag_7d", "lag_30d", "rolling_7d_mean", "rolling_30d_mean"):
        rules[c] = (F.col(c) >= 0) & ~F.isnan(c)
    return rules


def validate_requests(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return validate(with_request_defaults(df), request_rules())


def response_rules() -> dict[str, Column]:
    return {
        "predicted_demand": F.col("predicted_demand") >= 0,
        "confidence": F.col("confidence").between(0, 1),
    }


# Fixed value: limit of an allocation request.
MAX_TOTAL_INVENTORY = 1_000_000


def allocation_violations(
    df: DataFrame, max_stores: int | None = None, max_total: int = MAX_TOTAL_INVENTORY
) -> DataFrame:
    """Group rules of allocation requests: (group_id, stores, violations).

    One row per store makes demands and capacities equally long.  Groups have any
    size unless ``max_stores`` is given.
    """
    groups = df.groupBy("group_id").agg(
        F.count("*").alias("stores"),
        F.min("total_inventory").alias("low"),
        F.max("total_inventory").alias("high"),
        F.count_if(F.col("demand").isNull() | F.isnan("demand") | (F.col("demand") < 0)).alias("bad_demand"),
        F.count_if(F.col("capacity").isNull() | (F.col("capacity") < 0)).alias("bad_capacity"),
    )
    rules = {
        "total_inventory": (F.col("low") > 0) & (F.col("high") <= max_total) & (F.col("low") == F.col("high")),
        "demand": F.col("bad_demand") == 0,
        "capacity": F.col("bad_capacity") == 0,
    }
    if max_stores is not None:
        rules["stores"] = F.col("stores") <= max_stores
    return with_violations(groups, rules).select("group_id", "stores", "violations")


def validate_allocation(df: DataFrame, max_stores: int | None = None) -> tuple[DataFrame, DataFrame]:
    marked = df.join(allocation_violations(df, max_stores).drop("stores"), "group_id")
    return marked.filter(F.size("violations") == 0).drop("violations"), marked.filter(F.size("violations") > 0)
