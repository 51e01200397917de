"""The operators chained into the two tracks, with stages written where several readers share them."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from shelfline.operators import cleaning, etl, features, inventory, marts, modeling, quality, sql_features
from shelfline.session import materialize, materialize_in_buckets, scratch_scope, settings
from shelfline.sources import readers, writers

_SERIES_LAYOUT = (sql_features.SERIES, ("sale_date",))
# Tables in buckets are read in them, whatever is done with the rows.
_IN_BUCKETS = {"spark.sql.sources.bucketing.autoBucketedScan.enabled": "false", **sql_features.BY_SERIES}


def clean(sales: DataFrame, stores: DataFrame | None, products: DataFrame | None, exact: bool = True) -> DataFrame:
    """Frame track: parse, deduplicate, drop negatives, enrich, impute, cap.

    Rows are made distinct before the enrichment instead of after it, which
    shuffles the sales columns only.  The result is the same, because the
    dimensions are made distinct too.  Sales are dealt by series before anything
    else, and stay so: copies of a row meet in one task, and the daily series and
    their windows are worked out from the result without another shuffle.
    """
    parts = readers.parts_for(sales)
    rows = cleaning.drop_negative_sales(cleaning.drop_duplicate_rows(cleaning.parse_dates(sales.repartition(parts, *features.SERIES))))
    if stores is not None:
        stores = stores.distinct()
    if products is not None:
        known = set(rows.columns) | set(stores.columns if stores is not None else ())
        products = products.select("product_id", *[c for c in products.columns if c not in known]).distinct()
    # Medians, modes and percentiles each read these rows, so they are written once.
    rows = materialize_in_buckets(cleaning.merge_metadata(rows, stores, products), parts, features.SERIES, [*features.SERIES, "sale_date"])
    return cleaning.impute_and_winsorize(rows) if exact else cleaning.winsorize(cleaning.impute(rows), exact=False)


def etl_stages(
    sales: DataFrame, stores: DataFrame, products: DataFrame, keep: Callable[[DataFrame], DataFrame] = materialize
) -> dict[str, DataFrame]:
    """Warehouse track: each stage by name; the valid rows are written once, by ``keep``, for the statistics."""
    deduped = etl.latest_record(sales)
    valid = keep(etl.drop_invalid(deduped))
    stats = etl.etl_statistics(valid)
    capped = etl.cap_p99(valid, stats)
    filled = etl.fill_median(capped, stats=stats)
    return {
        "deduped": deduped, "valid": valid, "capped": capped, "filled": filled,
        "enriched": etl.enrich(filled, stores, products),
    }


def _store_enriched(sales: DataFrame, stores: DataFrame, products: DataFrame, table: str) -> None:
    """The enriched sales as a table in buckets of a series.

    Sales are dealt into the buckets once, before anything else: the valid rows are kept in a table of the same
    buckets, and dimensions that are broadcast are joined where the rows are.
    """
    spark = sales.sparkSession
    held, buckets = f"{table}_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))

    def keep(valid: DataFrame) -> DataFrame:
        writers.create_table_as(valid, held, sql_features.SERIES, buckets=buckets)
        return spark.table(held)

    try:
        enriched = etl_stages(sales.repartition(buckets, *sql_features.SERIES), stores, products, keep)["enriched"]
        writers.create_table_as(enriched, table, *_SERIES_LAYOUT, buckets=buckets)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {held}")


def warehouse_features(sales: DataFrame, stores: DataFrame, products: DataFrame) -> DataFrame:
    return sql_features.demand_features(etl_stages(sales, stores, products)["enriched"])


@scratch_scope()
def run_training(spark: SparkSession, features_path: str, out: str, models: Mapping | None = None) -> dict[str, str]:
    """Stored features to the best model, the metrics of all models, and the importances of the trees.

    The models (``modeling.default_models`` unless given) see every row up to
    the cutoff date and are measured on the rows after it.  Columns that hold the
    target or are computed from its current value are not used.
    """
    paths = {name: f"{out}/{name}" for name in ("model", "metrics", "importance")}
    train, test = modeling.date_split(readers.read_stage(spark, features_path, "features"))
    target = "units_sold"
    train, test = features.encode_features(train), features.encode_features(test)
    inputs = [c for c in train.columns if c not in (target, *features.LEAKING)]
    fitted, metrics = modeling.train_models(train, test, inputs, target, models)
    writers.write_metrics(metrics, paths["metrics"])
    modeling.save_best(fitted, metrics, paths["model"])
    trees = {name: model for name, model in fitted.items() if hasattr(model.stages[-1], "featureImportances")}
    writers.write_report({name: modeling.feature_importance(model, inputs) for name, model in trees.items()}, paths["importance"])
    return paths


@scratch_scope()
def run_frame_track(
    spark: SparkSession, raw: str, out: str, exact: bool = True, models: Mapping | None = None
) -> dict[str, str]:
    """CSV folder to cleaned sales, features, encoded features, quality and inventory reports, and trained models."""
    paths = {name: f"{out}/{name}" for name in ("cleaned", "features", "encoded", "quality", "inventory")}
    sales = readers.read_sales(spark, candidates=[f"{raw}/retail_sales.csv", f"{raw}/sales.csv"])
    cleaned = clean(
        sales, readers.read_stores(spark, f"{raw}/stores.csv"), readers.read_products(spark, f"{raw}/products.csv"), exact
    )
    writers.write_stage(cleaned, paths["cleaned"])
    cleaned = readers.read_stage(spark, paths["cleaned"], "cleaned sales")
    quality.quality_report(cleaned).write.mode("overwrite").json(paths["quality"])
    with_ids, _ = features.build_features(cleaned)
    writers.write_stage(with_ids, paths["features"], partition_by=("month",))
    with_ids = readers.read_stage(spark, paths["features"], "features")
    writers.write_stage(features.encode_features(with_ids), paths["encoded"], partition_by=())
    writers.write_report(inventory.inventory_report(with_ids), paths["inventory"])
    return paths | run_training(spark, paths["features"], out, models)


@scratch_scope()
def run_warehouse_track(spark: SparkSession, prefix: str = "") -> list[str]:
    """Declared raw tables to cleaned, feature and mart tables; existing cleaned and feature tables are kept.

    Cleaned sales and features are stored in buckets of a series, sorted by date: features are
    worked out from the cleaned table, and read by series later, without a shuffle.
    ``prefix`` goes before the names of the layers.
    """
    raw_layer, cleaned_layer, analytics = writers.create_layers(spark, prefix)
    enriched_table, feature_table = f"{cleaned_layer}.sales_enriched", f"{analytics}.demand_features"
    sales, stores, products = (spark.table(f"{raw_layer}.{t}") for t in ("sales", "stores", "products"))
    with settings(spark, _IN_BUCKETS):
        if not spark.catalog.tableExists(enriched_table):
            _store_enriched(sales, stores, products, enriched_table)
        if not spark.catalog.tableExists(feature_table):
            found = sql_features.demand_features(spark.table(enriched_table), by_series=True)
            writers.create_table_as(found, feature_table, *_SERIES_LAYOUT)
    built = marts.build_marts(spark.table(feature_table))
    writers.refresh_marts(built, analytics)
    return [enriched_table, feature_table, *[f"{analytics}.{m}" for m in built]]
