"""Retail tables derived from the TPC-H style tables of a data folder.

A line item is a sale, a supplier a store, a part (or its brand) a product.
The tables hold no gaps or errors, so some are put in by rule: negative and
missing units, negative revenue, free items and missing competitor prices.
Prices come from ``floor`` over IEEE operations, so that any engine gets the
same decimals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# One statement per table: the SQL is also valid in other engines.
SALES_SQL = """
SELECT l_orderkey * 8 + l_linenumber AS id,
       CAST(l_shipdate AS DATE) AS sale_date,
       concat('S', CAST(l_suppkey AS {text})) AS store_id,
       {product} AS product_id,
       p_type AS category,
       CASE WHEN l_linenumber = 7 AND l_orderkey % 40 = 0 THEN NULL
            WHEN l_returnflag = 'R' AND l_orderkey % 50 = 0 THEN CAST(-l_quantity AS INT)
            WHEN l_orderkey % 60 = 1 THEN 0
            ELSE CAST(l_quantity AS INT) END AS units_sold,
       CAST(CASE WHEN l_linenumber = 2 AND l_orderkey % 90 = 7 THEN 0
            ELSE FLOOR(l_extendedprice * 100 / l_quantity) / 100 END AS DECIMAL(10,2)) AS unit_price,
       CAST(CASE WHEN l_returnflag = 'R' AND l_orderkey % 70 = 0 THEN -1 ELSE 1 END
            * FLOOR(l_extendedprice * (1 - l_discount) * 100) / 100 AS DECIMAL(12,2)) AS revenue,
       CAST(FLOOR(l_discount * 100 + 0.5) AS DECIMAL(5,2)) AS discount_pct,
       CAST(CASE WHEN l_discount >= 0.08 THEN 1 ELSE 0 END AS SMALLINT) AS is_promotion,
       CAST(CASE WHEN (month(CAST(l_shipdate AS DATE)) = 12 AND day(CAST(l_shipdate AS DATE)) >= 20)
                   OR (month(CAST(l_shipdate AS DATE)) = 11 AND day(CAST(l_shipdate AS DATE)) >= 25)
            THEN 1 ELSE 0 END AS SMALLINT) AS is_holiday,
       CAST(CASE WHEN l_linenumber = 4 THEN NULL
            WHEN l_linenumber = 5 AND l_orderkey % 20 = 0 THEN 0
            ELSE FLOOR(p_retailprice * (85 + l_orderkey % 31)) / 100 END AS DECIMAL(10,2)) AS competitor_price,
       CASE WHEN l_linenumber = 6 AND l_orderkey % 9 = 0 THEN NULL
            ELSE CAST(l_shipdate AS DATE) + CAST(l_orderkey % 24 AS INT) END AS loaded_at
FROM lineitem JOIN part ON l_partkey = p_partkey
"""

STORES_SQL = """
SELECT concat('S', CAST(s_suppkey AS {text})) AS store_id,
       r_name AS region,
       CASE CAST(s_suppkey % 4 AS INT) WHEN 0 THEN 'Supermarket' WHEN 1 THEN 'Express'
            WHEN 2 THEN 'Warehouse' ELSE 'Online' END AS store_type,
       CAST(1000 + s_suppkey % 997 * 41 AS INT) AS store_size_sqft,
       CAST(1990 + s_suppkey % 31 AS SMALLINT) AS opening_year
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE s_suppkey % 50 <> 13
"""

# The nation of a store, a coarser seller whose series are long.
STORE_NATIONS_SQL = """
SELECT concat('S', CAST(s_suppkey AS {text})) AS seller_id, n_name AS nation
FROM supplier JOIN nation ON s_nationkey = n_nationkey
"""

# Brand 25 is left out so that some sales have no product row.
BRANDS_SQL = """
SELECT p_brand AS product_id,
       min(p_type) AS category,
       max(p_type) AS sub_category,
       CAST(CASE WHEN p_brand = 'Brand#3' THEN 0 ELSE FLOOR(max(p_retailprice)) END AS DECIMAL(10,2)) AS base_price,
       CAST(FLOOR(min(p_retailprice)) / 20 AS DECIMAL(10,2)) AS cost_price,
       CAST(CASE WHEN count(*) % 2 = 0 THEN 1 ELSE 0 END AS SMALLINT) AS is_perishable
FROM part WHERE p_brand <> 'Brand#25' GROUP BY p_brand
"""

# Whole-table forecast requests, some of which break a rule.
REQUESTS_SQL = """
SELECT CASE WHEN l_orderkey % 97 = 0 THEN '' ELSE concat('S', CAST(l_suppkey AS {text})) END AS store_id,
       concat('P', CAST(l_partkey AS {text})) AS product_id,
       CASE CAST(l_partkey % 11 AS INT)
            WHEN 0 THEN 'Groceries' WHEN 1 THEN 'Dairy' WHEN 2 THEN 'Beverages' WHEN 3 THEN 'Snacks'
            WHEN 4 THEN 'Frozen' WHEN 5 THEN 'Personal Care' WHEN 6 THEN 'Household' WHEN 7 THEN 'Electronics'
            WHEN 8 THEN 'Clothing' WHEN 9 THEN 'Toys' ELSE 'Gadgets' END AS category,
       CAST(CASE WHEN l_orderkey % 101 = 0 THEN -5
            ELSE FLOOR(p_retailprice * (70 + l_quantity)) / 100 * CASE WHEN l_orderkey % 89 = 0 THEN 8 ELSE 1 END
            END AS DOUBLE) AS current_price,
       CAST(CASE WHEN l_linenumber = 4 THEN NULL
            ELSE FLOOR(p_retailprice * (85 + l_orderkey % 31)) / 100 END AS DOUBLE) AS competitor_price,
       CASE WHEN l_orderkey % 103 = 0 THEN 2 WHEN l_discount >= 0.08 THEN 1
            WHEN l_linenumber = 3 THEN NULL ELSE 0 END AS is_promotion,
       CAST(CASE WHEN l_orderkey % 107 = 0 THEN 150 ELSE FLOOR(l_discount * 400 + 0.5) END AS DOUBLE) AS discount_pct,
       CASE WHEN month(CAST(l_shipdate AS DATE)) = 12 THEN 1 ELSE 0 END AS is_holiday,
       CAST(CASE WHEN l_orderkey % 109 = 0 THEN -1 ELSE l_quantity END AS DOUBLE) AS lag_7d,
       CAST(l_quantity AS DOUBLE) AS lag_30d,
       CAST(CASE WHEN l_linenumber = 1 THEN 0 ELSE l_linenumber * 7 END AS DOUBLE) AS rolling_7d_mean,
       CAST(l_linenumber * 5 AS DOUBLE) AS rolling_30d_mean
FROM lineitem JOIN part ON l_partkey = p_partkey
"""

PRODUCT_BRAND = "p_brand"
PRODUCT_PART = "concat('P', CAST(p_partkey AS {text}))"


def sales_sql(product: str = PRODUCT_BRAND, text: str = "STRING") -> str:
    return SALES_SQL.format(product=product.format(text=text), text=text)


# Columns of the source tables.
TABLES = {
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}
# Files of a few splits may hold all their rows in one row group, which one task reads; larger ones are read as they are.
MAX_SPREAD_BYTES = 256 * 1024 * 1024
# Line items take some 15 bytes a row in a file, so that a split of the reader's usual size holds ten million.
SPREAD_PART_BYTES = 8 * 1024 * 1024
_ROW_KEY = {"lineitem": "l_orderkey", "orders": "o_orderkey"}


def table(spark: SparkSession, folder: str, name: str, spread: bool = False) -> DataFrame:
    """A source table.  One of the large ones whose files are small in all is spread over the cores; any other is read as it is.

    ``spread`` spreads large files as well, for readers that hash or sort rows before their first shuffle.  The
    parts have a bounded size, so a task's rows and memory don't grow with the table.
    """
    df = spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")
    if name in _ROW_KEY:
        size = stored_bytes(df)
        if spread or size <= MAX_SPREAD_BYTES:
            parts = max(spark.sparkContext.defaultParallelism, -(-size // SPREAD_PART_BYTES))
            df = df.repartition(parts, _ROW_KEY[name])
    return df


def stored_bytes(df: DataFrame) -> int:
    """Size of the files that ``df`` scans, from their listing."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    # a stream reads a folder or a pattern, not a single file by name
    return spark.readStream.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet*")


def _run(
    spark: SparkSession, folder: str, sql: str, tables: tuple[str, ...], streams: tuple[str, ...] = (), spread: bool = False
) -> DataFrame:
    args = {t: stream(spark, folder, t) if t in streams else table(spark, folder, t, spread) for t in tables}
    for t in tables:
        sql = sql.replace(f"FROM {t}", f"FROM {{{t}}}").replace(f"JOIN {t} ", f"JOIN {{{t}}} ")
    return spark.sql(sql, **args)


def sales(
    spark: SparkSession, folder: str, product: str = PRODUCT_BRAND, streaming: bool = False, spread: bool = False
) -> DataFrame:
    """Sales; as a stream, line items arrive while parts are a static table."""
    return _run(spark, folder, sales_sql(product), ("lineitem", "part"), ("lineitem",) if streaming else (), spread)


def nation_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Sales with the store's nation in place of the store."""
    nations = _run(spark, folder, STORE_NATIONS_SQL.format(text="STRING"), ("supplier", "nation"))
    rows = sales(spark, folder).join(nations, F.col("store_id") == F.col("seller_id"))
    return rows.withColumn("store_id", F.col("nation")).drop("seller_id", "nation")


def stores(spark: SparkSession, folder: str) -> DataFrame:
    return _run(spark, folder, STORES_SQL.format(text="STRING"), ("supplier", "nation", "region"))


def brands(spark: SparkSession, folder: str) -> DataFrame:
    return _run(spark, folder, BRANDS_SQL, ("part",))


def requests(spark: SparkSession, folder: str, streaming: bool = False) -> DataFrame:
    """Forecast requests; as a stream, line items arrive while parts are a static table."""
    return _run(
        spark, folder, REQUESTS_SQL.format(text="STRING"), ("lineitem", "part"), ("lineitem",) if streaming else (), spread=True
    )


def raw_sales(spark: SparkSession, folder: str, spread: bool = True) -> DataFrame:
    """Sales in the CSV form: a text date (some invalid), double measures, repeated rows.

    Every 25th order was delivered twice, so whole rows repeat.
    """
    base = sales(spark, folder, spread=spread)
    doubles = ["units_sold", "unit_price", "revenue", "discount_pct", "competitor_price"]
    flags = ["is_promotion", "is_holiday"]
    text = F.when(F.col("id") % 211 == 0, "2024-02-30").otherwise(F.col("sale_date").cast("string"))
    copies = F.when(F.col("id") % 25 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    date = F.col("sale_date")
    return base.select(
        text.alias("sale_date"), "store_id", "product_id",
        F.when(F.col("id") % 50 != 3, F.col("category")).alias("category"),
        *[F.col(c).cast("double").alias(c) for c in doubles],
        *[F.col(c).cast("int").alias(c) for c in flags],
        F.weekday(date).alias("day_of_week"), F.month(date).alias("month"), F.year(date).alias("year"),
        F.explode(copies).alias("_copy"),
    ).drop("_copy")


def events(spark: SparkSession, folder: str) -> DataFrame:
    """The event stream with a UTC timestamp type that watermarks accept."""
    return table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
