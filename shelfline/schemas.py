"""Table schemas, allowed values and other fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


_S, _I, _SMALL, _L, _D = T.StringType(), T.IntegerType(), T.ShortType(), T.LongType(), T.DoubleType()

# Names and types of the columns of all tables.
SALES = _schema(
    ("id", _L), ("sale_date", T.DateType()), ("store_id", _S), ("product_id", _S), ("category", _S),
    ("units_sold", _I), ("unit_price", T.DecimalType(10, 2)), ("revenue", T.DecimalType(12, 2)),
    ("discount_pct", T.DecimalType(5, 2)), ("is_promotion", _SMALL), ("is_holiday", _SMALL),
    ("competitor_price", T.DecimalType(10, 2)), ("day_of_week", _SMALL), ("month", _SMALL), ("year", _SMALL),
    ("loaded_at", T.TimestampType()),
)

# The CSV form: the date is text until it is parsed, measures are doubles.
SALES_CSV = _schema(
    ("sale_date", _S), ("store_id", _S), ("product_id", _S), ("category", _S), ("units_sold", _D),
    ("unit_price", _D), ("revenue", _D), ("discount_pct", _D), ("is_promotion", _I), ("is_holiday", _I),
    ("competitor_price", _D), ("day_of_week", _I), ("month", _I), ("year", _I),
)

STORES = _schema(
    ("store_id", _S), ("region", _S), ("store_type", _S), ("store_size_sqft", _I), ("opening_year", _SMALL),
)

PRODUCTS = _schema(
    ("product_id", _S), ("category", _S), ("sub_category", _S), ("base_price", T.DecimalType(10, 2)),
    ("cost_price", T.DecimalType(10, 2)), ("is_perishable", _SMALL),
)

COMPETITOR_PRICES = _schema(
    ("id", _L), ("scrape_date", T.DateType()), ("product_id", _S), ("competitor_name", _S),
    ("competitor_price", T.DecimalType(10, 2)), ("source_url", _S), ("scraped_at", T.TimestampType()),
)

FORECAST_REQUEST = _schema(
    ("store_id", _S), ("product_id", _S), ("category", _S), ("current_price", _D), ("competitor_price", _D),
    ("is_promotion", _I), ("discount_pct", _D), ("is_holiday", _I), ("lag_7d", _D), ("lag_30d", _D),
    ("rolling_7d_mean", _D), ("rolling_30d_mean", _D),
)

ALLOCATION_REQUEST = _schema(
    ("group_id", _S), ("store_idx", _L), ("demand", _D), ("capacity", _L), ("total_inventory", _L),
)

# NOT NULL columns, primary keys, defaults and text lengths of the declared tables.
NOT_NULL = {"sales": ["sale_date", "store_id", "product_id"], "competitor_prices": ["scrape_date"]}
PRIMARY_KEY = {
    "sales": ["id"], "stores": ["store_id"], "products": ["product_id"], "competitor_prices": ["id"],
}
DEFAULTS = {
    "sales": {"discount_pct": "0", "is_promotion": "0", "is_holiday": "0", "loaded_at": "current_timestamp()"},
    "products": {"is_perishable": "0"},
    "competitor_prices": {"scraped_at": "current_timestamp()"},
}
MAX_LENGTH = {
    "sales": {"store_id": 10, "product_id": 10, "category": 50},
    "stores": {"store_id": 10, "region": 20, "store_type": 20},
    "products": {"product_id": 10, "category": 50, "sub_category": 50},
    "competitor_prices": {"product_id": 10, "competitor_name": 50},
}
TABLES = {"sales": SALES, "stores": STORES, "products": PRODUCTS, "competitor_prices": COMPETITOR_PRICES}

# Base demand per category.
CATEGORY_DEMAND = {
    "Groceries": 25, "Dairy": 22, "Beverages": 18, "Snacks": 15, "Frozen": 12, "Personal Care": 8,
    "Household": 7, "Electronics": 4, "Clothing": 3, "Toys": 3,
}
DEFAULT_CATEGORY_DEMAND = 10
CATEGORIES = list(CATEGORY_DEMAND)
STORE_TYPES = ["Supermarket", "Express", "Warehouse", "Online"]

# Names of the three table layers.
LAYERS = ["raw_data", "cleaned_data", "analytics"]

# Columns that the two-sided outlier cap leaves alone, besides "*_id".
UNCAPPED = [
    "is_promotion", "is_holiday", "is_weekend", "is_perishable", "day_of_week", "month", "year", "quarter",
    "day_of_month", "week_of_year",
]

# Volatility bands with their upper edges, and the band of an undefined volatility.
VOLATILITY_EDGES = [("Stable", 0.3), ("Moderate", 0.7), ("Volatile", 1.5)]
VOLATILITY_TOP = "Erratic"
VOLATILITY_UNDEFINED = "nan"

# Demand bands with their exclusive upper edges.
DEMAND_EDGES = [("Low", 5), ("Medium", 20), ("High", 50)]
DEMAND_TOP = "Surge"
