"""Readers with explicit schemas; nothing is inferred from the data."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, types as T

from shelfline import schemas
from shelfline.functions.columns import nan_to_null, normalized_name

# Places where the raw sales file may lie, in order of preference.
SALES_PATHS = ("data/raw/retail_sales.csv", "data/raw/sales.csv")
STORES_PATH = "data/raw/stores.csv"
PRODUCTS_PATH = "data/raw/products.csv"

# What one task should hold of the files behind a frame; Parquet rows are many times larger in memory.
PART_BYTES = 8 * 1024 * 1024
# More parts than this cost more than they help.
MAX_PARTS = 10_000


def parts_for(df: DataFrame) -> int:
    """Number of parts to deal ``df`` into, by the size of the files that it reads; at least one for each core.

    Shuffle partitions where the size is not known.
    """
    spark = df.sparkSession
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    if size >= 1 << 62:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(spark.sparkContext.defaultParallelism, min(-(-size // PART_BYTES), MAX_PARTS))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on whatever file system it names."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop_path)


def _read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV by header name: known columns get their type, unknown ones stay text.

    Only one header line is looked at before the job runs.  A file whose header
    differs, in names or order, is an error when it is read.
    """
    header = spark.read.option("header", True).option("inferSchema", False).csv(path).columns
    known = {f.name: f.dataType for f in schema}
    names = [normalized_name(c) for c in header]
    typed = T.StructType([T.StructField(raw, known.get(c, T.StringType())) for raw, c in zip(header, names)])
    rows = spark.read.schema(typed).option("header", True).option("enforceSchema", False).option("nanValue", "NaN").csv(path)
    return nan_to_null(rows.toDF(*names))


def read_sales(spark: SparkSession, path: str | None = None, candidates: Iterable[str] = SALES_PATHS) -> DataFrame:
    """Raw sales from CSV; without a path the first existing candidate is read."""
    if path is None:
        path = next((p for p in candidates if path_exists(spark, p)), None)
    if path is None or not path_exists(spark, path):
        raise FileNotFoundError("no sales data found")
    return _read_csv(spark, path, schemas.SALES_CSV)


def _read_optional(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    return _read_csv(spark, path, schema) if path_exists(spark, path) else None


def read_stores(spark: SparkSession, path: str = STORES_PATH) -> DataFrame | None:
    """Store attributes, or None when the file is missing."""
    return _read_optional(spark, path, schemas.STORES)


def read_products(spark: SparkSession, path: str = PRODUCTS_PATH) -> DataFrame | None:
    """Product attributes, or None when the file is missing."""
    return _read_optional(spark, path, schemas.PRODUCTS)


def read_stage(spark: SparkSession, path: str, stage: str = "stage") -> DataFrame:
    """A stored stage (cleaned sales, features, encoded features) with its stored types."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        raise FileNotFoundError(f"no {stage} at {path}; run the stage before it") from error
