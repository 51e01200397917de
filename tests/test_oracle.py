"""Registered queries against DuckDB.  SHELFLINE_ALL=1 takes every query instead of the widest ones."""

import os

import harness
import pytest
from conftest import DATA

from shelfline.plans import catalog, stored  # noqa: F401  (stored adds its queries to the catalog)

WIDE = """
etl_dedup_latest etl_enriched clean_full clean_quality_report features_dashboard features_encoded
calendar_lag_features nation_lag_features nation_row_change sql_demand_features sql_yoy_calendar mart_daily_store mart_category mart_regional mart_stockout
mart_promo kpi monthly_revenue_by_year category_summary allocation_summary allocate_all_stores store_anomalies
reorder_point reorder_point_by_product topk_per_store threshold_counts_many threshold_for_rate percentile_lookup
range_demand bundle_pairs reorder_schedule forecast_score forecast_risk_factors request_validation
allocation_validation stride_sample positional_split scaled_features sequences best_model stream_dedup stream_rolling
stream_sessions stream_score stream_daily_mart sink_typed_tables sink_warehouse_tables stage_encoded source_csv_sales
series_table_features mart_promo_incremental report_category_analysis mart_region_subtotals keyed_sample best_partners
stream_spikes queue_dispatch
""".split()


@pytest.fixture(scope="module")
def con():
    return harness.connect(DATA)


@pytest.mark.parametrize("name", list(catalog.ORACLES) if os.environ.get("SHELFLINE_ALL") else WIDE)
def test_matches_sql(spark, con, name):
    left, right, difference = harness.compare(spark, con, DATA, catalog.QUERIES[name], catalog.ORACLES[name])
    assert not difference
    assert left == right > 0


def test_every_oracle_has_a_query():
    assert set(catalog.ORACLES) <= set(catalog.QUERIES)


def test_entry(spark):
    import __spark_entry__

    rows = __spark_entry__.entry(spark)
    assert rows.columns[:2] == ["product_id", "category"] and rows.count() > 0
