"""Registered queries over stored and arriving data: bucketed tables, kept marts, upserts, queues, sketches and samples."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfline.operators import etl, inventory, mart_state, marts, modeling, partners, sketches
from shelfline.plans import catalog, oracle
from shelfline.plans.catalog import _scratch_path, _warehouse, register
from shelfline.session import materialize
from shelfline.sources import series_tables, tpch, writers
from shelfline.streaming import latest, queue, spikes

_KEY = catalog._KEY
_LAGGED = "lag_1d:i lag_7d:i lag_30d:i rolling_7d_mean:d rolling_7d_max:i rolling_7d_min:i price_ratio:d stockout_risk"


# Tables in buckets of a series

def _in_loads(spark: SparkSession, folder: str, read) -> DataFrame:
    """``read(table)`` of a series table filled by three loads, the second of them twice; the table is dropped again."""
    layer = f"run_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {layer}")
    table = f"{layer}.sales"
    sales = materialize(tpch.sales(spark, folder))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    series_tables.create_series_table(spark, table, sales.schema, buckets)
    for k in (0, 1, 1, 2):
        series_tables.add_load(sales.filter(F.pmod("id", F.lit(3)) == k), table, f"load-{k}")
    result = materialize(read(table))
    spark.sql(f"DROP DATABASE {layer} CASCADE")
    return result


@register("series_table_latest", catalog._SALES, _warehouse("deduped"))
def _(spark, folder):
    return _in_loads(spark, folder, lambda table: series_tables.latest_records(spark, table))


@register("series_table_features", _KEY + _LAGGED, _warehouse("deduped", """
    SELECT *, CASE WHEN lag_1d = 0 AND lag_7d < rolling_7d_mean * CAST(0.5 AS DOUBLE) THEN 'High'
        WHEN lag_1d < rolling_7d_mean * CAST(0.3 AS DOUBLE) THEN 'Medium' ELSE 'Low' END AS stockout_risk FROM lagged""",
    enriched="SELECT * FROM deduped", lagged=oracle.WAREHOUSE["lagged"]))
def _(spark, folder):
    return _in_loads(spark, folder, lambda table: series_tables.series_features(spark, table))


# Marts kept up to date batch by batch

def _kept_mart(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A mart after three batches, with days that come late and the last batch twice."""
    path = _scratch_path(spark)
    features = catalog._features(spark, folder)
    used = mart_state.used_columns(features, [mart_state.mart_states()[name]])
    # as for the full rebuild, the columns that the mart reads
    rows = materialize(features.select(*[c for c in features.columns if c in etl.KEY or c in used]))
    late = F.pmod(F.xxhash64("store_id", "product_id"), F.lit(5)) == 0
    early = F.year("sale_date") < 1996
    batches = [rows.filter(early & ~late), rows.filter(~early & ~late), rows.filter(late)]
    for number, batch in [*enumerate(batches), (2, batches[2])]:
        mart_state.merge_batch(batch, number, path, [name])
    return mart_state.read_marts(spark, path, [name])[name]


for _mart, _entry in (
    ("mv_daily_store_demand", "mart_daily_store"), ("mv_category_demand", "mart_category"), ("mv_regional_demand", "mart_regional"),
    ("mv_stockout_summary", "mart_stockout"), ("mv_promo_impact", "mart_promo"),
):
    # the same columns and SQL as the full rebuild
    catalog.register_like(f"{_entry}_incremental", _entry, lambda spark, folder, name=_mart: _kept_mart(spark, folder, name))


# Latest record wins

@register("stream_latest", catalog._SALES, _warehouse("deduped"))
def _(spark, folder):
    """Sales that arrive in four deliveries of any number of files, those loaded last first; each is a batch."""
    path = _scratch_path(spark)
    sales = materialize(tpch.sales(spark, folder))
    for k in (3, 1, 2, 0):
        part = F.coalesce(F.pmod(F.datediff("loaded_at", "sale_date"), F.lit(4)), F.lit(0)) == k
        sales.filter(part).write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(sales.schema).parquet(f"{path}/in")
        latest.run_latest(stream, f"{path}/out", f"{path}/state", etl.KEY).awaitTermination()
    return latest.read_latest(spark, f"{path}/out")


# The inventory report, each result as it was written

def _reported(spark: SparkSession, folder: str, name: str, schema: str) -> DataFrame:
    path = _scratch_path(spark)
    results = inventory.inventory_report(materialize(catalog._features(spark, folder)))
    writers.write_report({name: results[name]}, path)
    return spark.read.schema(schema).json(f"{path}/{name}")


_STORE_REQUESTS = catalog._ALL_REQUESTS.replace("12000 AS total_inventory", "5000 AS total_inventory")
_REPORT = {
    "allocation": (catalog._ALLOCATION, "group_id string, store_idx long, demand double, capacity long, allocation long", _warehouse(
        "features", catalog._ALLOCATED, requests=_STORE_REQUESTS, **catalog._STEPS)),
    "allocation_summary": (
        catalog._TOTALS, "group_id string, total_fulfilled double, total_demand double, fill_rate double, inventory_used long, inventory_remaining long",
        _warehouse("features", catalog._SUMMARY, requests=_STORE_REQUESTS, **catalog._STEPS, allocated=catalog._ALLOCATED)),
    "sliding_window": (
        catalog._COLUMNS["anomaly_summary"], "window_size int, avg_rolling_demand double, anomalies_detected long, total_windows long",
        catalog.ORACLES["anomaly_summary"]),
    "reorder_point": (
        catalog._REORDER, "reorder_point long, safety_stock long, daily_demand_at_sl double, avg_daily_demand double, "
        "lead_time_days int, service_level double", catalog.ORACLES["reorder_point"]),
    "top_k_stockout": ("product_id risk_score:d", "product_id string, risk_score double", catalog.ORACLES["sink_json_report"]),
    # the warehouse features have no volatility band, so segments are stores
    "category_analysis": (
        catalog._COLUMNS["segment_stats"], "segment string, count long, total_demand double, avg_demand double, total_revenue double",
        _warehouse("features", """SELECT store_id AS segment, COUNT(*) AS count, ROUND_EVEN(SUM(units_sold), 2) AS total_demand,
            ROUND_EVEN(AVG(units_sold), 2) AS avg_demand, ROUND_EVEN(SUM(revenue), 2) AS total_revenue FROM features GROUP BY 1""")),
}
for _name, (_columns, _schema, _sql) in _REPORT.items():
    register(f"report_{_name}", _columns, _sql)(
        lambda spark, folder, name=_name, schema=_schema: _reported(spark, folder, name, schema))


# Subtotals, samples, sketches, partners

@register(
    "mart_region_subtotals", "region store_id level:n num_transactions:i total_units:i total_revenue:d avg_units:d",
    _warehouse("features", """SELECT region, store_id, GROUPING_ID(region, store_id) AS level, COUNT(*) AS num_transactions,
        SUM(units_sold) AS total_units, SUM(revenue) AS total_revenue, AVG(units_sold) AS avg_units
        FROM features GROUP BY ROLLUP (region, store_id)"""))
def _(spark, folder):
    return marts.region_subtotals(catalog._features(spark, folder))


_SAMPLED = """sha256(concat_ws('|', '42', store_id, product_id, CAST(sale_date AS VARCHAR)))"""


@register("keyed_sample", _KEY + "units_sold:d", catalog._frame("daily", f"""
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY store_id ORDER BY {_SAMPLED}) AS place FROM daily) WHERE place <= 20"""))
def _(spark, folder):
    return modeling.keyed_sample(catalog._daily(spark, folder), 20, by=["store_id"])


_SKETCHED = {"units_sold": (0.01, 0.5, 0.99), "unit_price": (0.01, 0.99), "revenue": (0.01, 0.99), "competitor_price": (0.5,)}


@register("caps_from_sketches", "column q:d n:i within", _warehouse("raw", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {q} AS q, COUNT({c}) AS n, TRUE AS within FROM raw" for c, qs in _SKETCHED.items() for q in qs)))
def _(spark, folder):
    """Whether caps and medians from stored day sketches keep their rank error, after three batches and one of them again."""
    path = _scratch_path(spark)
    rows = materialize(tpch.sales(spark, folder).select("id", "sale_date", *_SKETCHED))
    for number in (0, 1, 2, 2):
        sketches.merge_batch(rows.filter(F.pmod("id", F.lit(3)) == number), number, path, list(_SKETCHED))
    found = materialize(sketches.range_quantiles(spark, path, _SKETCHED))
    return sketches.rank_errors(rows, found, list(_SKETCHED)).withColumn("within", F.col("error") <= sketches.RANK_ERROR)


@register("best_partners", "category left_product right_product combined_demand:d rank:n", catalog.oracle.with_steps(
    oracle.WAREHOUSE, None, """SELECT category, l AS left_product, r AS right_product, combined_demand, rank FROM (
        SELECT a.category, a.product_id AS l, b.product_id AS r, CAST(ROUND_EVEN(a.demand + b.demand, 4) AS DOUBLE) AS combined_demand,
            row_number() OVER (PARTITION BY a.category, a.product_id ORDER BY ABS(a.demand + b.demand - 50), b.product_id) AS rank
        FROM products a JOIN products b ON a.category = b.category AND a.product_id <> b.product_id
            AND ABS(a.demand + b.demand - 50) <= 2.5) WHERE rank <= 5""",
    sold=tpch.sales_sql(tpch.PRODUCT_PART, "VARCHAR"),
    products="""SELECT category, product_id, CAST(AVG(units_sold) AS DECIMAL(20,6)) AS demand FROM sold
        GROUP BY 1, 2 HAVING AVG(units_sold) IS NOT NULL"""))
def _(spark, folder):
    products = tpch.sales(spark, folder, tpch.PRODUCT_PART).groupBy("category", "product_id").agg(F.avg("units_sold").alias("demand"))
    return partners.best_partners(products, 50, 5, ["category"])


# Spikes and the queue

@register("stream_spikes", "event_id:i event_type is_spike", """
    SELECT event_id, event_type, ABS(value - AVG(value) OVER t) > 2 * STDDEV_POP(value) OVER t AS is_spike
    FROM events WINDOW t AS (PARTITION BY event_type)""")
def _(spark, folder):
    """Events that arrive in three files."""
    path = _scratch_path(spark)
    events = tpch.events(spark, folder)
    for k in range(3):
        events.filter(F.pmod("event_id", F.lit(3)) == k).coalesce(1).write.mode("append").parquet(f"{path}/in")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    spikes.run_spikes(stream, f"{path}/out", f"{path}/state", ["event_type"]).awaitTermination()
    return spikes.flagged(spark, f"{path}/out", ["event_type"])


@register("queue_dispatch", "warehouse seq urgency dispatch_order:i", f"""
    SELECT *, row_number() OVER (ORDER BY urgency DESC, seq) AS dispatch_order FROM ({catalog._REORDERS})""")
def _(spark, folder):
    """All requests, taken in four calls, one of which is asked for twice."""
    requests = materialize(catalog._reorders(spark, folder))
    held = queue.ReorderQueue(spark, _scratch_path(spark))
    for call in range(2):
        held.enqueue(requests.filter(F.pmod("seq", F.lit(2)) == call), call)
    for call, n in enumerate([25, 1000, 1000, requests.count()]):
        held.dequeue(n, call)
    held.dequeue(1000, 1)
    return held.dispatched()
