"""The registered queries.  Each runs over its whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfline import schemas
from shelfline.functions.columns import round_half_even
from shelfline.operators import (
    bundles, cleaning, dashboard, etl, features as frame, inventory, marts, modeling, quality, scoring,
    sql_features as warehouse,
)
from shelfline.plans import oracle, pipelines
from shelfline.plans.shape import select_list, shaped
from shelfline.session import materialize, scratch_dir
from shelfline.sources import readers, tpch, writers
from shelfline.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


_COLUMNS: dict[str, str] = {}


def register(name: str, columns: str, sql: str | None = None):
    """Add a query under ``name``; ``sql`` yields at least the same columns, in any order."""
    def add(run: Query) -> Query:
        _COLUMNS[name] = columns
        QUERIES[name] = lambda spark, folder: shaped(run(spark, folder), columns)
        if sql is not None:
            ORACLES[name] = f"SELECT {select_list(columns)} FROM ({sql}) AS result"
        return run
    return add


def register_like(name: str, other: str, run: Query) -> None:
    """Add another way to the result of ``other``, with its columns and its SQL."""
    columns = _COLUMNS[other]
    QUERIES[name] = lambda spark, folder: shaped(run(spark, folder), columns)
    ORACLES[name] = ORACLES[other]


def _warehouse(last: str, query: str | None = None, **extra: str) -> str:
    return oracle.with_steps(oracle.WAREHOUSE, last, query or f"SELECT * FROM {last}", **extra)


def _frame(last: str, query: str | None = None, **extra: str) -> str:
    return oracle.with_steps(oracle.FRAME, last, query or f"SELECT * FROM {last}", **extra)


def _requests(last: str, query: str | None = None) -> str:
    return oracle.with_steps(oracle.REQUESTS, last, query or f"SELECT * FROM {last}")


def _stages(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return pipelines.etl_stages(tpch.sales(spark, folder), tpch.stores(spark, folder), tpch.brands(spark, folder))


def _enriched(spark: SparkSession, folder: str) -> DataFrame:
    return _stages(spark, folder)["enriched"]


def _features(spark: SparkSession, folder: str) -> DataFrame:
    """The features without the rank, which only its own entries read."""
    return warehouse.demand_features(_enriched(spark, folder), ranked=False)


def _cleaned(spark: SparkSession, folder: str) -> DataFrame:
    # the cleaning deals the rows itself before it hashes any
    sales = tpch.raw_sales(spark, folder, spread=False)
    return pipelines.clean(sales, tpch.stores(spark, folder), tpch.brands(spark, folder))


def _frame_features(spark: SparkSession, folder: str) -> DataFrame:
    return frame.build_features(_cleaned(spark, folder))[0]


def _scratch_path(spark: SparkSession) -> str:
    return f"{scratch_dir(spark)}/shelfline/{uuid.uuid4().hex}"


# ETL of the warehouse track

_SALES = (
    "sale_date store_id product_id category units_sold unit_price:d revenue:d discount_pct:d is_promotion:n "
    "is_holiday:n competitor_price:d"
)


@register("etl_dedup_latest", _SALES, _warehouse("deduped"))
def _(spark, folder):
    return etl.latest_record(tpch.sales(spark, folder))


@register("etl_drop_invalid", _SALES, _warehouse("raw", """SELECT * FROM raw
    WHERE NOT COALESCE(units_sold < 0 OR unit_price <= 0 OR revenue < 0 OR sale_date IS NULL, FALSE)"""))
def _(spark, folder):
    return etl.drop_invalid(tpch.sales(spark, folder))


@register("etl_cap_p99", _SALES, _warehouse("capped"))
def _(spark, folder):
    return _stages(spark, folder)["capped"]


@register("etl_fill_median", _SALES, _warehouse("filled"))
def _(spark, folder):
    return _stages(spark, folder)["filled"]


@register(
    "etl_enriched",
    _SALES + " region store_type store_size_sqft sub_category base_price:d cost_price:d is_perishable:n "
    "gross_profit:d effective_discount:d",
    _warehouse("enriched"),
)
def _(spark, folder):
    return _enriched(spark, folder)


# Cleaning of the frame track

_CSV = "sale_date:t store_id product_id category units_sold:d unit_price:d revenue:d discount_pct:d is_promotion:n is_holiday:n competitor_price:d"
_CALENDAR = " day_of_week:n day_of_month:n week_of_year:n month:n quarter:n year:n is_weekend:n"
_DIMENSIONS = " region store_type store_size_sqft:d opening_year:d sub_category base_price:d cost_price:d is_perishable:d"


@register("clean_calendar", _CSV + _CALENDAR, _frame("dated"))
def _(spark, folder):
    return cleaning.parse_dates(tpch.raw_sales(spark, folder))


@register("clean_dedup_rows", _CSV + _CALENDAR, _frame("distinct_rows"))
def _(spark, folder):
    return cleaning.drop_duplicate_rows(cleaning.parse_dates(tpch.raw_sales(spark, folder)))


@register("clean_negative", _CSV.replace(":t", ""), _frame("csv", "SELECT * FROM csv WHERE units_sold >= 0 AND revenue >= 0"))
def _(spark, folder):
    return cleaning.drop_negative_sales(tpch.raw_sales(spark, folder))


def _merged(spark, folder):
    rows = cleaning.drop_negative_sales(
        cleaning.drop_duplicate_rows(cleaning.parse_dates(tpch.raw_sales(spark, folder)))
    )
    return cleaning.merge_metadata(rows, tpch.stores(spark, folder), tpch.brands(spark, folder))


@register("clean_merge_metadata", _CSV + _DIMENSIONS, _frame("merged"))
def _(spark, folder):
    return _merged(spark, folder)


@register("clean_impute", _CSV + _DIMENSIONS, _frame("imputed"))
def _(spark, folder):
    return cleaning.impute(materialize(_merged(spark, folder)))


@register("clean_winsorize", _CSV, _frame("nonnegative", """
    SELECT n.* REPLACE (GREATEST(LEAST(units_sold, u[2]), u[1]) AS units_sold,
        GREATEST(LEAST(unit_price, p[2]), p[1]) AS unit_price, GREATEST(LEAST(revenue, r[2]), r[1]) AS revenue,
        GREATEST(LEAST(discount_pct, d[2]), d[1]) AS discount_pct,
        CASE WHEN competitor_price IS NOT NULL THEN GREATEST(LEAST(competitor_price, c[2]), c[1]) END AS competitor_price)
    FROM nonnegative n, limits""", limits="""
    SELECT quantile_cont(units_sold, [0.01, 0.99]) AS u, quantile_cont(unit_price, [0.01, 0.99]) AS p,
        quantile_cont(revenue, [0.01, 0.99]) AS r, quantile_cont(discount_pct, [0.01, 0.99]) AS d,
        quantile_cont(competitor_price, [0.01, 0.99]) AS c FROM nonnegative"""))
def _(spark, folder):
    rows = cleaning.drop_duplicate_rows(cleaning.parse_dates(tpch.raw_sales(spark, folder)))
    return cleaning.winsorize(materialize(cleaning.drop_negative_sales(rows)))


_NULLS = " + ".join(
    f"COUNT(*) FILTER (WHERE {c} IS NULL)"
    for c in ("category", "units_sold", "unit_price", "revenue", "competitor_price")
)


@register("clean_quality_report", "check passed observed:i", _frame("dated", """
    SELECT unnest(['no_nulls', 'enough_rows', 'no_negative_units', 'has_date_range', 'has_multiple_stores']) AS "check",
           unnest([nulls = 0, n > 100000, bad = 0, dates > 100, stores > 1]) AS passed,
           unnest([nulls, n, bad, dates, stores]) AS observed FROM seen""", seen=f"""
    SELECT {_NULLS} AS nulls, COUNT(*) AS n,
           COUNT(*) FILTER (WHERE NOT COALESCE(units_sold >= 0, FALSE)) AS bad,
           COUNT(DISTINCT sale_date) AS dates, COUNT(DISTINCT store_id) AS stores FROM dated"""))
def _(spark, folder):
    return quality.quality_report(cleaning.parse_dates(tpch.raw_sales(spark, folder)))


@register("clean_full", _CSV + _CALENDAR + _DIMENSIONS, _frame("cleaned"))
def _(spark, folder):
    return _cleaned(spark, folder)


@register("clean_winsorize_approximate", _CSV)
def _(spark, folder):
    rows = cleaning.drop_negative_sales(cleaning.parse_dates(tpch.raw_sales(spark, folder)))
    return cleaning.winsorize(rows, exact=False)


# Features of the frame track

_KEY = "sale_date store_id product_id "
_DAILY = "units_sold:d revenue:d avg_price:d avg_competitor_price:d max_discount:d had_promotion:n is_holiday:n "


def _daily(spark, folder):
    return frame.aggregate_daily(_cleaned(spark, folder))


@register("daily_demand", _KEY + _DAILY, _frame("daily"))
def _(spark, folder):
    return _daily(spark, folder)


@register("lag_features", _KEY + " ".join(f"lag_{n}d:d" for n in frame.LAGS), _frame("windowed"))
def _(spark, folder):
    return frame.lag_features(_daily(spark, folder))


@register("calendar_lag_features", _KEY + "lag_1d:d lag_7d:d lag_30d:d", _frame("daily", """
    SELECT d.*, a.units_sold AS lag_1d, b.units_sold AS lag_7d, c.units_sold AS lag_30d FROM daily d
    LEFT JOIN daily a ON a.store_id = d.store_id AND a.product_id = d.product_id AND a.sale_date = d.sale_date - 1
    LEFT JOIN daily b ON b.store_id = d.store_id AND b.product_id = d.product_id AND b.sale_date = d.sale_date - 7
    LEFT JOIN daily c ON c.store_id = d.store_id AND c.product_id = d.product_id AND c.sale_date = d.sale_date - 30"""))
def _(spark, folder):
    return frame.calendar_lag_features(_daily(spark, folder), lags=(1, 7, 30))


_ROLLING = " ".join(f"rolling_{n}d_{f}:d" for n in frame.WINDOWS for f in ("mean", "std", "max"))


@register("rolling_features", _KEY + _ROLLING, _frame("windowed"))
def _(spark, folder):
    return frame.rolling_features(_daily(spark, folder))


@register("price_features", _KEY + "price_ratio:d price_change_pct:d discount_flag:n", _frame("windowed"))
def _(spark, folder):
    return frame.price_features(_daily(spark, folder))


_SEASON = (
    "day_of_week:n day_of_month:n week_of_year:n month:n quarter:n is_weekend:n is_month_start:n is_month_end:n "
    "sin_annual:d cos_annual:d sin_weekly:d cos_weekly:d sin_monthly:d cos_monthly:d"
)


@register("seasonality_features", _KEY + _SEASON, _frame("windowed"))
def _(spark, folder):
    return frame.seasonality_features(_daily(spark, folder))


_DEMAND = "demand_velocity:d demand_volatility:d ytd_cumulative:d volatility_band"


@register("demand_features", _KEY + _DEMAND, _frame("banded"))
def _(spark, folder):
    return frame.demand_features(frame.rolling_features(_daily(spark, folder)))


@register("ytd_cumulative", _KEY + "ytd_cumulative:d", _frame("windowed"))
def _(spark, folder):
    return frame.demand_features(_daily(spark, folder))


@register("volatility_band", "volatility_band n:i", _frame("banded", "SELECT volatility_band, COUNT(*) AS n FROM banded GROUP BY 1"))
def _(spark, folder):
    rows = frame.demand_features(frame.rolling_features(_daily(spark, folder)))
    return rows.groupBy("volatility_band").agg(F.count("*").alias("n"))


@register("warmup_filter", _KEY + _DAILY, _frame("daily", "SELECT * FROM daily WHERE sale_date >= (SELECT MIN(sale_date) + INTERVAL 30 DAY FROM daily)"))
def _(spark, folder):
    return frame.drop_warmup(_daily(spark, folder))


_ALL_FRAME = (
    _DAILY + " ".join(f"lag_{n}d:d" for n in frame.LAGS) + f" {_ROLLING} price_ratio:d price_change_pct:d discount_flag:n "
    + f"{_SEASON} demand_velocity:d demand_volatility:d ytd_cumulative:d"
)


@register("features_dashboard", _KEY + _ALL_FRAME + " volatility_band", _frame("frame_features"))
def _(spark, folder):
    return _frame_features(spark, folder)


_LEVELS = frame.BAND_LEVELS[1:]
ORACLE_ENCODED = _frame("frame_features", "SELECT *, " + ", ".join(
    f"CASE WHEN volatility_band = '{x}' THEN 1 ELSE 0 END AS volatility_band_{x}" for x in _LEVELS
) + " FROM frame_features")


@register(
    "features_encoded",
    _ALL_FRAME + " " + " ".join(f"volatility_band_{x}:n" for x in _LEVELS),
    ORACLE_ENCODED,
)
def _(spark, folder):
    return frame.build_features(_cleaned(spark, folder))[1]


# Series of a nation and a brand, long enough for every lag

_NATION = {
    "nations": tpch.STORE_NATIONS_SQL.format(text="VARCHAR"),
    "sold": "SELECT r.* REPLACE (n.nation AS store_id) FROM raw r JOIN nations n ON r.store_id = n.seller_id",
    "series": """
        SELECT sale_date, store_id, product_id, COALESCE(SUM(units_sold), 0) AS units_sold FROM sold GROUP BY ALL""",
}
NATION_YEAR_ROWS = 50


def _nation_daily(spark, folder):
    return frame.aggregate_daily(tpch.nation_sales(spark, folder))


def _nation_lag(n: int, alias: str) -> str:
    return f"LAG(units_sold, {n}) OVER ({oracle.SERIES}) AS {alias}"


@register("nation_lag_features", _KEY + " ".join(f"lag_{n}d:i" for n in frame.LAGS), _warehouse(
    "raw", f"SELECT *, {', '.join(_nation_lag(n, f'lag_{n}d') for n in frame.LAGS)} FROM series", **_NATION))
def _(spark, folder):
    return frame.lag_features(_nation_daily(spark, folder))


@register("nation_calendar_lags", _KEY + "lag_1d:i lag_7d:i lag_30d:i", _warehouse("raw", "SELECT d.*" + "".join(
    f", (SELECT MAX(b.units_sold) FROM series b WHERE b.store_id = d.store_id AND b.product_id = d.product_id "
    f"AND b.sale_date = d.sale_date - {n}) AS lag_{n}d" for n in (1, 7, 30)) + " FROM series d", **_NATION))
def _(spark, folder):
    return frame.calendar_lag_features(_nation_daily(spark, folder), lags=(1, 7, 30))


@register("nation_row_change", _KEY + "lag_1d:i lag_30d:i yoy_change:i", _warehouse("raw", f"""
    SELECT *, {_nation_lag(1, 'lag_1d')}, {_nation_lag(30, 'lag_30d')},
        units_sold - LAG(units_sold, {NATION_YEAR_ROWS}) OVER ({oracle.SERIES}) AS yoy_change FROM series""", **_NATION))
def _(spark, folder):
    return warehouse.lags(_nation_daily(spark, folder), NATION_YEAR_ROWS)


@register("nation_yoy_calendar", _KEY + "yoy_change:i", _warehouse("raw", """
    SELECT e.*, e.units_sold - b.units_sold AS yoy_change FROM series e
    LEFT JOIN series b ON b.store_id = e.store_id AND b.product_id = e.product_id
        AND month(b.sale_date) = month(e.sale_date) AND day(b.sale_date) = day(e.sale_date)
        AND year(b.sale_date) = year(e.sale_date) - 1""", **_NATION))
def _(spark, folder):
    return warehouse.calendar_yoy(_nation_daily(spark, folder))


# Features of the warehouse track

_W_LAGS = "lag_1d:n lag_7d:n lag_14d:n lag_30d:n yoy_change:n"
_W_ROLLING = "rolling_7d_mean:d rolling_30d_mean:d rolling_7d_max:n rolling_7d_min:n"


@register("sql_lags", _KEY + _W_LAGS, _warehouse("lagged"))
def _(spark, folder):
    return warehouse.lags(_enriched(spark, folder))


@register("sql_rolling", _KEY + _W_ROLLING, _warehouse("lagged"))
def _(spark, folder):
    return warehouse.rolling(_enriched(spark, folder))


@register("sql_yoy_calendar", _KEY + "yoy_change:n", _warehouse("enriched", """
    SELECT e.*, e.units_sold - b.units_sold AS yoy_change FROM enriched e
    LEFT JOIN enriched b ON b.store_id = e.store_id AND b.product_id = e.product_id
        AND month(b.sale_date) = month(e.sale_date) AND day(b.sale_date) = day(e.sale_date)
        AND year(b.sale_date) = year(e.sale_date) - 1"""))
def _(spark, folder):
    return warehouse.calendar_yoy(_enriched(spark, folder))


@register("sql_demand_rank", _KEY + "units_sold demand_rank:n", _warehouse("lagged"))
def _(spark, folder):
    return warehouse.demand_rank(_enriched(spark, folder))


@register("sql_price_ratio", _KEY + "price_ratio:d", _warehouse("lagged"))
def _(spark, folder):
    return warehouse.price_ratio(_enriched(spark, folder))


@register("sql_demand_band", _KEY + "units_sold demand_band demand_volatility:d", _warehouse("features"))
def _(spark, folder):
    return _features(spark, folder)


@register("sql_stockout_risk", _KEY + "lag_1d:n lag_7d:n rolling_7d_mean:d stockout_risk", _warehouse("features"))
def _(spark, folder):
    return _features(spark, folder)


@register(
    "sql_demand_features",
    _KEY + "category region store_type units_sold revenue:d unit_price:d competitor_price:d is_promotion:n is_holiday:n "
    f"is_perishable:n {_W_LAGS} {_W_ROLLING} demand_rank:n price_ratio:d demand_band demand_volatility:d stockout_risk",
    _warehouse("features"),
)
def _(spark, folder):
    return warehouse.demand_features(_enriched(spark, folder))


# Marts

_HIGH, _MEDIUM = "COUNT(*) FILTER (WHERE stockout_risk = 'High')", "COUNT(*) FILTER (WHERE stockout_risk = 'Medium')"


@register(
    "mart_daily_store",
    "sale_date store_id region store_type num_transactions:i total_units:i total_revenue:d avg_units:d avg_price_ratio:a",
    _warehouse("features", """SELECT sale_date, store_id, region, store_type, COUNT(*) AS num_transactions,
        SUM(units_sold) AS total_units, SUM(revenue) AS total_revenue, AVG(units_sold) AS avg_units,
        AVG(price_ratio) AS avg_price_ratio FROM features GROUP BY 1, 2, 3, 4"""),
)
def _(spark, folder):
    return marts.daily_store_demand(_features(spark, folder))


@register(
    "mart_category",
    "category total_records:i total_units:i total_revenue:d avg_daily_demand:d avg_volatility:a high_stockout_count:i promo_demand_lift:d",
    _warehouse("features", f"""SELECT category, COUNT(*) AS total_records, SUM(units_sold) AS total_units,
        SUM(revenue) AS total_revenue, AVG(units_sold) AS avg_daily_demand, AVG(demand_volatility) AS avg_volatility,
        {_HIGH} AS high_stockout_count,
        {oracle.near('''CAST(SUM(CASE WHEN is_promotion = 1 THEN units_sold ELSE 0 END) AS DOUBLE)
            / NULLIF(SUM(CASE WHEN is_promotion = 0 THEN units_sold ELSE 0 END), 0)''', 4)} AS promo_demand_lift
        FROM features GROUP BY 1"""),
)
def _(spark, folder):
    return marts.category_demand(_features(spark, folder))


@register(
    "mart_regional", "region month:n year:n total_units:i total_revenue:d avg_demand:d active_stores:i active_products:i",
    _warehouse("features", """SELECT region, month(sale_date) AS month, year(sale_date) AS year,
        SUM(units_sold) AS total_units, SUM(revenue) AS total_revenue, AVG(units_sold) AS avg_demand,
        COUNT(DISTINCT store_id) AS active_stores, COUNT(DISTINCT product_id) AS active_products
        FROM features GROUP BY 1, 2, 3"""),
)
def _(spark, folder):
    return marts.regional_demand(_features(spark, folder))


_STOCKOUT = "product_id category total_days:i high_risk_days:i medium_risk_days:i stockout_frequency_pct:d avg_demand:d avg_volatility:a"
_STOCKOUT_SQL = _warehouse("features", f"""SELECT product_id, category, COUNT(*) AS total_days,
    {_HIGH} AS high_risk_days, {_MEDIUM} AS medium_risk_days,
    {oracle.near(f"CAST({_HIGH} AS DOUBLE) / COUNT(*) * 100", 2)} AS stockout_frequency_pct,
    AVG(units_sold) AS avg_demand, AVG(demand_volatility) AS avg_volatility
    FROM features GROUP BY 1, 2 HAVING COUNT(*) > 30""")


@register("mart_stockout", _STOCKOUT, _STOCKOUT_SQL)
def _(spark, folder):
    return marts.stockout_summary(_features(spark, folder))


@register(
    "mart_promo", "category is_promotion:n record_count:i avg_demand:d avg_revenue:d avg_price_ratio:a",
    _warehouse("features", """SELECT category, is_promotion, COUNT(*) AS record_count, AVG(units_sold) AS avg_demand,
        AVG(revenue) AS avg_revenue, AVG(price_ratio) AS avg_price_ratio FROM features GROUP BY 1, 2"""),
)
def _(spark, folder):
    return marts.promo_impact(_features(spark, folder))


# Dashboard

@register("kpi", "records:i total_revenue:d avg_demand:d at_risk_products:i", _warehouse("features", """
    SELECT COUNT(*) AS records, SUM(revenue) AS total_revenue, AVG(units_sold) AS avg_demand,
        COUNT(DISTINCT CASE WHEN stockout_risk = 'High' THEN product_id END) AS at_risk_products FROM features"""))
def _(spark, folder):
    return dashboard.kpi(_features(spark, folder))


@register("revenue_by_category", "category total_revenue:d", _warehouse(
    "features", "SELECT category, SUM(revenue) AS total_revenue FROM features GROUP BY 1"))
def _(spark, folder):
    return dashboard.revenue_by_category(_features(spark, folder))


@register("region_share", "region total_units:i share_pct:d", _warehouse("features", """
    SELECT region, SUM(units_sold) AS total_units, SUM(units_sold) * 100.0 / SUM(SUM(units_sold)) OVER () AS share_pct
    FROM features GROUP BY 1"""))
def _(spark, folder):
    return dashboard.region_share(_features(spark, folder))


@register("monthly_revenue_by_year", "month:n year:n revenue:d", _warehouse(
    "features", "SELECT month(sale_date) AS month, year(sale_date) AS year, SUM(revenue) AS revenue FROM features GROUP BY 1, 2"))
def _(spark, folder):
    return dashboard.monthly_revenue(_features(spark, folder))


@register("band_distribution", "demand_band records:i share_pct:d", _warehouse("features", """
    SELECT demand_band, COUNT(*) AS records, COUNT(*) * 100.0 / SUM(COUNT(*)) OVER () AS share_pct
    FROM features GROUP BY 1"""))
def _(spark, folder):
    return dashboard.band_distribution(_features(spark, folder))


@register("category_avg_demand", "category avg_demand:d", _warehouse(
    "features", "SELECT category, AVG(units_sold) AS avg_demand FROM features GROUP BY 1"))
def _(spark, folder):
    return dashboard.category_avg_demand(_features(spark, folder))


_PROMO_AVG = "AVG(CASE WHEN is_promotion = 1 THEN units_sold END)"
_BASE_AVG = "AVG(CASE WHEN is_promotion = 0 THEN units_sold END)"


@register("promo_vs_base", "category promo_avg:d base_avg:d promo_lift_pct:d", _warehouse("features", f"""
    SELECT category, {_PROMO_AVG} AS promo_avg, {_BASE_AVG} AS base_avg,
        ({_PROMO_AVG} / {_BASE_AVG} - 1) * 100 AS promo_lift_pct FROM features GROUP BY 1"""))
def _(spark, folder):
    return dashboard.promo_vs_base(_features(spark, folder))


@register("category_volatility", "category avg_volatility:a", _warehouse(
    "features", "SELECT category, AVG(demand_volatility) AS avg_volatility FROM features GROUP BY 1"))
def _(spark, folder):
    return dashboard.category_volatility(_features(spark, folder))


@register("weekday_demand", "day_of_week:n avg_demand:d", _warehouse(
    "features", "SELECT isodow(sale_date) - 1 AS day_of_week, AVG(units_sold) AS avg_demand FROM features GROUP BY 1"))
def _(spark, folder):
    return dashboard.weekday_demand(_features(spark, folder))


@register(
    "category_summary",
    "category avg_demand:d total_revenue:d promo_lift_pct:d avg_volatility:a high_risk_pct:d volatility_badge risk_badge",
    _warehouse("features", """SELECT *,
        CASE WHEN avg_volatility < 0.5 THEN 'Low' WHEN avg_volatility < 1.0 THEN 'Medium' ELSE 'High' END AS volatility_badge,
        CASE WHEN high_risk_pct < 1 THEN 'Low' WHEN high_risk_pct < 5 THEN 'Medium' ELSE 'High' END AS risk_badge
        FROM summary""", summary=f"""
        SELECT category, AVG(units_sold) AS avg_demand, SUM(revenue) AS total_revenue,
            ({_PROMO_AVG} / {_BASE_AVG} - 1) * 100 AS promo_lift_pct, AVG(demand_volatility) AS avg_volatility,
            {_HIGH} * 100.0 / COUNT(*) AS high_risk_pct FROM features GROUP BY 1"""),
)
def _(spark, folder):
    return dashboard.category_summary(_features(spark, folder))


# Inventory

_TIERS = """
    SELECT *, total_inventory AS available, LEAST(capacity, total_inventory) AS cap,
           CAST(FLOOR(demand) AS BIGINT) AS whole, demand - FLOOR(demand) AS part FROM requests"""
_UNITS = """
    SELECT group_id, store_idx, available, CAST(1 AS DOUBLE) AS worth, LEAST(whole, cap) AS units FROM tiers
    UNION ALL SELECT group_id, store_idx, available, part, 1 FROM tiers WHERE part > 1e-9 AND cap > whole
    UNION ALL SELECT group_id, store_idx, available, 0,
        cap - LEAST(whole, cap) - CASE WHEN part > 1e-9 AND cap > whole THEN 1 ELSE 0 END FROM tiers"""
_TAKEN = """
    SELECT group_id, store_idx, SUM(LEAST(units, GREATEST(available - (upto - units), 0))) AS allocation FROM (
        SELECT *, SUM(units) OVER (PARTITION BY group_id ORDER BY worth DESC, store_idx DESC ROWS UNBOUNDED PRECEDING) AS upto
        FROM units) GROUP BY 1, 2"""
_PRODUCT_REQUESTS = """
    SELECT product_id AS group_id, row_number() OVER (PARTITION BY product_id ORDER BY store_id) - 1 AS store_idx,
           store_id, demand, CAST(FLOOR(demand * 2) AS BIGINT) AS capacity, 500 AS total_inventory
    FROM (SELECT product_id, store_id, AVG(units_sold) AS demand FROM features GROUP BY 1, 2)"""
_ALL_REQUESTS = """
    SELECT 'all' AS group_id, row_number() OVER (ORDER BY store_id) - 1 AS store_idx, demand,
           CAST(FLOOR(demand * 2) AS BIGINT) AS capacity, 12000 AS total_inventory
    FROM (SELECT store_id, AVG(units_sold) AS demand FROM features GROUP BY 1)"""
_STEPS = {"tiers": _TIERS, "units": _UNITS, "taken": _TAKEN}
_ALLOCATED = "SELECT r.*, t.allocation FROM requests r JOIN taken t USING (group_id, store_idx)"
_SUMMARY = """
    SELECT group_id, ROUND(SUM(LEAST(allocation, demand)), 2) AS total_fulfilled, ROUND(SUM(demand), 2) AS total_demand,
           ROUND(SUM(LEAST(allocation, demand)) / SUM(demand) * 100, 2) AS fill_rate, SUM(allocation) AS inventory_used,
           MAX(total_inventory) - SUM(allocation) AS inventory_remaining FROM allocated GROUP BY 1"""
_ALLOCATION = "group_id store_idx:i demand:d capacity:i allocation:i"
_TOTALS = "group_id total_fulfilled:d total_demand:d fill_rate:d inventory_used:i inventory_remaining:i"


@register("allocate_inventory", _ALLOCATION, _warehouse("features", _ALLOCATED, requests=_PRODUCT_REQUESTS, **_STEPS))
def _(spark, folder):
    return inventory.allocate(inventory.product_requests(_features(spark, folder)))


@register("allocation_summary", _TOTALS, _warehouse(
    "features", _SUMMARY, requests=_PRODUCT_REQUESTS, **_STEPS, allocated=_ALLOCATED))
def _(spark, folder):
    return inventory.allocation_summary(inventory.allocate(inventory.product_requests(_features(spark, folder))))


@register("allocate_all_stores", _ALLOCATION, _warehouse("features", _ALLOCATED, requests=_ALL_REQUESTS, **_STEPS))
def _(spark, folder):
    return inventory.allocate(inventory.store_requests(_features(spark, folder), total_inventory=12_000))


_RATES = {
    "daily": "SELECT sale_date, SUM(units_sold) AS demand FROM features GROUP BY 1",
    "rates": """SELECT sale_date, ROUND_EVEN(rate, 4) AS rate FROM (
        SELECT sale_date, AVG(demand) OVER (ORDER BY sale_date ROWS 6 PRECEDING) AS rate,
               row_number() OVER (ORDER BY sale_date) AS i, COUNT(*) OVER () AS n FROM daily) WHERE i >= LEAST(7, n)""",
}
_FLAGGED = """SELECT *, ABS(rate - AVG(rate) OVER ()) > 2 * STDDEV_POP(rate) OVER () AS is_anomaly FROM rates"""


@register("demand_rate", "sale_date rate:d", _warehouse("features", "SELECT * FROM rates", **_RATES))
def _(spark, folder):
    return inventory.demand_rate(inventory.daily_totals(_features(spark, folder)))


@register("demand_anomalies", "sale_date rate:d is_anomaly", _warehouse("features", _FLAGGED, **_RATES))
def _(spark, folder):
    return inventory.demand_anomalies(inventory.demand_rate(inventory.daily_totals(_features(spark, folder))))


@register("anomaly_summary", "window_size:n avg_rolling_demand:d anomalies_detected:i total_windows:i", _warehouse(
    "features", """SELECT 7 AS window_size, ROUND_EVEN(AVG(rate), 2) AS avg_rolling_demand,
        COUNT(*) FILTER (WHERE is_anomaly) AS anomalies_detected, COUNT(*) AS total_windows FROM flagged""",
    **_RATES, flagged=_FLAGGED))
def _(spark, folder):
    rates = inventory.demand_rate(inventory.daily_totals(_features(spark, folder)))
    return inventory.anomaly_summary(inventory.demand_anomalies(rates))


@register("store_anomalies", "store_id window_size:n avg_rolling_demand:d anomalies_detected:i total_windows:i", _warehouse(
    "features", """SELECT store_id, 7 AS window_size, ROUND_EVEN(AVG(rate), 2) AS avg_rolling_demand,
        COUNT(*) FILTER (WHERE is_anomaly) AS anomalies_detected, COUNT(*) AS total_windows FROM (
          SELECT *, ABS(rate - AVG(rate) OVER s) > 2 * STDDEV_POP(rate) OVER s AS is_anomaly FROM rates
          WINDOW s AS (PARTITION BY store_id)) GROUP BY 1""",
    daily="SELECT store_id, sale_date, SUM(units_sold) AS demand FROM features GROUP BY 1, 2",
    rates="""SELECT store_id, sale_date, ROUND_EVEN(rate, 4) AS rate FROM (
        SELECT store_id, sale_date, AVG(demand) OVER (PARTITION BY store_id ORDER BY sale_date ROWS 6 PRECEDING) AS rate,
               row_number() OVER (PARTITION BY store_id ORDER BY sale_date) AS i,
               COUNT(*) OVER (PARTITION BY store_id) AS n FROM daily) WHERE i >= LEAST(7, n)"""))
def _(spark, folder):
    by = ["store_id"]
    rates = inventory.demand_rate(inventory.daily_totals(_features(spark, folder), by), by=by)
    return inventory.anomaly_summary(inventory.demand_anomalies(rates, by), by=by)


_REORDER = "reorder_point:i safety_stock:i daily_demand_at_sl:d avg_daily_demand:d lead_time_days:n service_level:d"


def _reorder_sql(by: str) -> str:
    key, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    return f"""SELECT {key}CAST(ROUND_EVEN(mean * 7 + safety_stock, 0) AS BIGINT) AS reorder_point, safety_stock,
        level AS daily_demand_at_sl, ROUND_EVEN(mean, 2) AS avg_daily_demand, 7 AS lead_time_days, 0.95 AS service_level
        FROM (SELECT *, GREATEST(0, CAST(ROUND_EVEN((level - mean) * 7, 0) AS BIGINT)) AS safety_stock FROM (
            SELECT {key}AVG(units_sold) AS mean,
                   list_sort(list(units_sold))[CAST(FLOOR(CAST(0.95 AS DOUBLE) * (COUNT(*) - 1)) AS BIGINT) + 1] AS level
            FROM features {group}))"""


@register("reorder_point", _REORDER, _warehouse("features", _reorder_sql("")))
def _(spark, folder):
    return inventory.reorder_point(_features(spark, folder))


@register("reorder_point_by_product", "product_id " + _REORDER, _warehouse("features", _reorder_sql("product_id")))
def _(spark, folder):
    return inventory.reorder_point(_features(spark, folder), by=["product_id"])


_RISK = """SELECT {key}product_id, COALESCE(STDDEV_SAMP(units_sold), 0) / GREATEST(AVG(units_sold), 1) AS risk_score
    FROM features GROUP BY ALL"""


@register("stockout_topk", "product_id risk_score:d", _warehouse(
    "features", f"SELECT * FROM ({_RISK.format(key='')}) ORDER BY risk_score DESC, product_id DESC LIMIT 20"))
def _(spark, folder):
    return inventory.top_k(inventory.stockout_risk(_features(spark, folder)), 20)


@register("topk_per_store", "store_id product_id demand:i rank:n", _warehouse("features", """
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY store_id ORDER BY demand DESC, product_id DESC) AS rank
        FROM (SELECT store_id, product_id, SUM(units_sold) AS demand FROM features GROUP BY 1, 2)) WHERE rank <= 3"""))
def _(spark, folder):
    totals = _features(spark, folder).groupBy("store_id", "product_id").agg(F.sum("units_sold").alias("demand"))
    return inventory.top_k_per_group(totals, ["store_id"], 3, score="demand")


@register("segment_stats", "segment count:i total_demand:d avg_demand:d total_revenue:d", _frame("frame_features", """
    SELECT volatility_band AS segment, COUNT(*) AS count, ROUND(SUM(units_sold), 2) AS total_demand,
        ROUND(AVG(units_sold), 2) AS avg_demand, ROUND(SUM(revenue), 2) AS total_revenue FROM frame_features GROUP BY 1"""))
def _(spark, folder):
    return inventory.segment_stats(_frame_features(spark, folder))


_THRESHOLDS = [0, 5, 12.5, 20, 50, 1000]
_COUNTS = "threshold:d count_below:i count_above:i fraction_below:d"


def _counts_sql(column: str) -> str:
    return f"""SELECT threshold, COUNT(*) FILTER (WHERE {column} <= threshold) AS count_below,
        COUNT(*) FILTER (WHERE {column} > threshold) AS count_above,
        COUNT(*) FILTER (WHERE {column} <= threshold) / COUNT(*) AS fraction_below
        FROM features, thresholds GROUP BY 1"""


@register("threshold_counts", _COUNTS, _warehouse(
    "features", _counts_sql("units_sold"), thresholds=f"SELECT CAST(unnest({_THRESHOLDS}) AS DOUBLE) AS threshold"))
def _(spark, folder):
    return inventory.threshold_counts(_features(spark, folder), _THRESHOLDS)


@register("threshold_counts_many", _COUNTS, _warehouse(
    "features", _counts_sql("CAST(revenue AS DOUBLE)"),
    thresholds="SELECT DISTINCT CAST(max(unit_price) AS DOUBLE) AS threshold FROM features GROUP BY store_id"))
def _(spark, folder):
    rows = materialize(_features(spark, folder))
    asked = rows.groupBy("store_id").agg(F.max("unit_price").cast("double").alias("threshold"))
    return inventory.threshold_counts(rows, asked.select("threshold"), "revenue")


_RATES_ASKED = [0.0, 0.1, 0.5, 0.999, 1.0]


@register("threshold_for_rate", "rate:d value:d", _warehouse("features", f"""
    SELECT rate, list_sort(v)[1 + CASE WHEN rate <= 0 THEN 0 WHEN rate >= 1 THEN len(v) - 1
        ELSE LEAST(CAST(FLOOR(rate * len(v)) AS BIGINT), len(v) - 1) END] AS value
    FROM (SELECT list(units_sold) AS v FROM features), (SELECT CAST(unnest({_RATES_ASKED}) AS DOUBLE) AS rate)"""))
def _(spark, folder):
    return inventory.threshold_for_rate(_features(spark, folder), _RATES_ASKED)


_PERCENTS = [0, 1, 50, 95, 100]


@register("percentile_lookup", "category percentile:d value:d", _warehouse("features", f"""
    SELECT category, p AS percentile, list_sort(v)[1 + CAST(FLOOR(p / 100 * (len(v) - 1)) AS BIGINT)] AS value
    FROM (SELECT category, list(revenue) AS v FROM features GROUP BY 1), (SELECT CAST(unnest({_PERCENTS}) AS DOUBLE) AS p)"""))
def _(spark, folder):
    return inventory.percentile_lookup(_features(spark, folder), _PERCENTS, "revenue", ["category"])


_STORE_DAYS = "SELECT store_id, sale_date, SUM(units_sold) AS demand FROM features GROUP BY 1, 2"


@register("prefix_sums", "store_id position:i prefix:d", _warehouse("features", """
    SELECT store_id, row_number() OVER w AS position, SUM(demand) OVER w AS prefix FROM daily
    WINDOW w AS (PARTITION BY store_id ORDER BY sale_date ROWS UNBOUNDED PRECEDING)
    UNION ALL SELECT DISTINCT store_id, 0, 0 FROM daily""", daily=_STORE_DAYS))
def _(spark, folder):
    return inventory.prefix_sums(inventory.daily_totals(_features(spark, folder), ["store_id"]), ["store_id"])


@register("range_demand", "store_id left:i right:i total_demand:d", _warehouse("features", """
    SELECT q.store_id, q."left", q."right", SUM(d.demand) AS total_demand FROM queries q LEFT JOIN numbered d
        ON d.store_id = q.store_id AND d.i BETWEEN q."left" AND q."right" GROUP BY 1, 2, 3""",
    numbered=f"SELECT *, row_number() OVER (PARTITION BY store_id ORDER BY sale_date) - 1 AS i FROM ({_STORE_DAYS})",
    queries="""SELECT concat('S', CAST(s_suppkey AS VARCHAR)) AS store_id, s_suppkey % 30 - 3 AS "left",
        s_suppkey % 30 + s_suppkey % 1000 AS "right" FROM supplier"""))
def _(spark, folder):
    by = ["store_id"]
    prefix = inventory.prefix_sums(inventory.daily_totals(_features(spark, folder), by), by)
    key = F.col("s_suppkey")
    asked = tpch.table(spark, folder, "supplier").select(
        F.concat(F.lit("S"), key.cast("string")).alias("store_id"),
        (key % 30 - 3).alias("left"), (key % 30 + key % 1000).alias("right"),
    )
    return inventory.range_demand(prefix, asked, by)


_PARTS = f"""
    SELECT category, product_id, CAST(AVG(units_sold) AS DECIMAL(18,6)) AS demand
    FROM ({tpch.sales_sql(tpch.PRODUCT_PART, "VARCHAR")}) GROUP BY 1, 2 HAVING COUNT(units_sold) > 0"""
_BUNDLES = f"""
    WITH RECURSIVE parts AS ({_PARTS}),
    sorted AS (SELECT category, list(demand ORDER BY demand, product_id) AS d, list(product_id ORDER BY demand, product_id) AS p
               FROM parts GROUP BY 1),
    walk AS (
        SELECT category, CAST(1 AS BIGINT) AS l, len(d) AS r FROM sorted
        UNION ALL
        SELECT w.category, CASE WHEN d[l] + d[r] <= 52.5 THEN l + 1 ELSE l END,
               CASE WHEN d[l] + d[r] >= 47.5 THEN r - 1 ELSE r END
        FROM walk w JOIN sorted s ON s.category = w.category WHERE l < r)
    SELECT w.category, p[l] AS left_product, p[r] AS right_product, ROUND_EVEN(d[l] + d[r], 2) AS combined_demand
    FROM walk w JOIN sorted s ON s.category = w.category WHERE l < r AND ABS(d[l] + d[r] - 50) <= 2.5"""


@register("bundle_pairs", "category left_product right_product combined_demand:d", _BUNDLES)
def _(spark, folder):
    products = (
        tpch.sales(spark, folder, tpch.PRODUCT_PART).groupBy("category", "product_id")
        .agg(F.avg("units_sold").alias("demand"))
    )
    return bundles.bundle_pairs(products, 50, ["category"])


def _reorders(spark, folder):
    return tpch.table(spark, folder, "orders").select(
        F.col("o_orderstatus").alias("warehouse"), F.col("o_orderkey").alias("seq"), F.col("o_custkey").alias("product_id"),
        (6 - F.substring("o_orderpriority", 1, 1).cast("int")).alias("urgency"), F.col("o_totalprice").alias("quantity"),
    )


_REORDERS = """SELECT o_orderstatus AS warehouse, o_orderkey AS seq, o_custkey AS product_id,
    6 - CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS urgency, o_totalprice AS quantity FROM orders"""


@register("reorder_schedule", "warehouse seq urgency dispatch_order:i", f"""SELECT *,
    row_number() OVER (PARTITION BY warehouse ORDER BY urgency DESC, seq) AS dispatch_order FROM ({_REORDERS})""")
def _(spark, folder):
    return inventory.reorder_schedule(_reorders(spark, folder), ["warehouse"])


@register("next_reorders", "warehouse seq urgency", f"SELECT * FROM ({_REORDERS}) ORDER BY urgency DESC, seq LIMIT 25")
def _(spark, folder):
    return inventory.next_reorders(_reorders(spark, folder), 25)


# Scoring and validation

_RESPONSE = "request_id store_id product_id predicted_demand:d demand_band reorder_recommendation confidence:d"


def _valid(spark, folder):
    return quality.validate_requests(tpch.requests(spark, folder))[0]


@register("forecast_score", _RESPONSE, _requests("scored"))
def _(spark, folder):
    return scoring.score(_valid(spark, folder))


@register("forecast_risk_factors", "request_id risk_factors", _requests("scored"))
def _(spark, folder):
    return scoring.score(_valid(spark, folder)).withColumn("risk_factors", F.array_join("risk_factors", "; "))


_BROKEN = "SELECT *, array_to_string(broken, ',') AS violations FROM checked"


@register("request_validation", "store_id product_id category current_price:d violations", _requests("checked", _BROKEN))
def _(spark, folder):
    rows = quality.with_request_defaults(tpch.requests(spark, folder))
    marked = quality.with_violations(rows, quality.request_rules())
    return marked.withColumn("violations", F.array_join("violations", ","))


@register("violation_counts", "violation n:i", _requests(
    "checked", "SELECT violation, COUNT(*) AS n FROM (SELECT unnest(broken) AS violation FROM checked) GROUP BY 1"))
def _(spark, folder):
    quarantine = quality.validate_requests(tpch.requests(spark, folder))[1]
    return quarantine.select(F.explode("violations").alias("violation")).groupBy("violation").agg(F.count("*").alias("n"))


@register("request_ids", "request_id n:i", _requests("scored", "SELECT request_id, COUNT(*) AS n FROM scored GROUP BY 1"))
def _(spark, folder):
    return _valid(spark, folder).groupBy(scoring.request_id().alias("request_id")).agg(F.count("*").alias("n"))


@register("forecast_first_answers", "request_id predicted_demand:d demand_band risk_factors", _requests("scored", """
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY request_id
        ORDER BY lag_30d, predicted_demand, demand_band, reorder_recommendation, risk_factors) AS rn FROM scored) WHERE rn = 1"""))
def _(spark, folder):
    scored = scoring.score(_valid(spark, folder), keep=("lag_30d",))
    scored = scored.withColumn("risk_factors", F.array_join("risk_factors", "; "))
    return scoring.first_answers(scored, "lag_30d")


@register("response_checks", "violations n:i", _requests("scored", """
    SELECT concat_ws(',', CASE WHEN NOT predicted_demand >= 0 THEN 'predicted_demand' END,
        CASE WHEN NOT confidence BETWEEN 0 AND 1 THEN 'confidence' END) AS violations, COUNT(*) AS n FROM scored GROUP BY 1"""))
def _(spark, folder):
    marked = quality.with_violations(scoring.score(_valid(spark, folder)), quality.response_rules())
    return marked.groupBy(F.array_join("violations", ",").alias("violations")).agg(F.count("*").alias("n"))


@register("allocation_validation", "group_id stores:i violations", """
    SELECT CAST(o_custkey AS VARCHAR) AS group_id, COUNT(*) AS stores, concat_ws(',',
        CASE WHEN NOT (MIN(total) > 0 AND MAX(total) <= 1000000 AND MIN(total) = MAX(total)) THEN 'total_inventory' END,
        CASE WHEN SUM(CASE WHEN o_totalprice - 2000 < 0 THEN 1 ELSE 0 END) > 0 THEN 'demand' END,
        CASE WHEN COUNT(*) > 12 THEN 'stores' END) AS violations
    FROM (SELECT *, o_custkey % 40 * 30000 AS total FROM orders) GROUP BY 1""")
def _(spark, folder):
    requests = tpch.table(spark, folder, "orders").select(
        F.col("o_custkey").cast("string").alias("group_id"), F.col("o_orderkey").alias("store_idx"),
        (F.col("o_totalprice") - 2000).alias("demand"), F.lit(10).cast("long").alias("capacity"),
        (F.col("o_custkey") % 40 * 30000).alias("total_inventory"),
    )
    marked = quality.allocation_violations(requests, max_stores=12)
    return marked.withColumn("violations", F.array_join("violations", ","))


@register("table_constraints", "violations n:i", _warehouse("raw", """
    SELECT concat_ws(',', CASE WHEN sale_date IS NULL THEN 'sale_date_not_null' END,
        CASE WHEN store_id IS NULL THEN 'store_id_not_null' END, CASE WHEN product_id IS NULL THEN 'product_id_not_null' END,
        CASE WHEN length(store_id) > 10 THEN 'store_id_length' END,
        CASE WHEN length(product_id) > 10 THEN 'product_id_length' END,
        CASE WHEN length(category) > 50 THEN 'category_length' END) AS violations, COUNT(*) AS n FROM raw GROUP BY 1"""))
def _(spark, folder):
    marked = quality.with_violations(writers.typed(tpch.sales(spark, folder), "sales"), quality.table_rules("sales"))
    return marked.groupBy(F.array_join("violations", ",").alias("violations")).agg(F.count("*").alias("n"))


@register("duplicate_keys", "id:i n:i", _warehouse("raw", "SELECT id, COUNT(*) AS n FROM raw GROUP BY 1 HAVING COUNT(*) > 1"))
def _(spark, folder):
    return quality.duplicate_keys(tpch.sales(spark, folder), ["id"])


# Models

@register("stride_sample", _KEY + "units_sold:d", _frame("daily", """
    SELECT * FROM (SELECT *, row_number() OVER (ORDER BY store_id, product_id, sale_date) - 1 AS i,
        GREATEST(COUNT(*) OVER () // 1000, 1) AS step FROM daily) WHERE i % step = 0 AND i // step < 1000"""))
def _(spark, folder):
    return modeling.stride_sample(_daily(spark, folder), max_rows=1000)


_SPLIT = "part n:i first_day last_day units:i"


def _split_totals(train: DataFrame, test: DataFrame) -> DataFrame:
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.groupBy("part").agg(
        F.count("*").alias("n"), F.min("sale_date").alias("first_day"), F.max("sale_date").alias("last_day"),
        F.sum("units_sold").alias("units"),
    )


_SPLIT_SQL = """SELECT part, COUNT(*) AS n, MIN(sale_date) AS first_day, MAX(sale_date) AS last_day,
    SUM(units_sold) AS units FROM parts GROUP BY 1"""
_CUTOFF = """SELECT MIN(sale_date) AS cutoff FROM (SELECT sale_date, SUM(COUNT(*)) OVER (ORDER BY sale_date) AS upto,
    SUM(COUNT(*)) OVER () AS total FROM features GROUP BY 1) WHERE upto >= total * CAST(0.8 AS DOUBLE)"""


@register("date_split", _SPLIT, _warehouse("features", _SPLIT_SQL, cutoff=_CUTOFF, parts="""
    SELECT *, CASE WHEN sale_date <= cutoff THEN 'train' ELSE 'test' END AS part FROM features, cutoff"""))
def _(spark, folder):
    return _split_totals(*modeling.date_split(materialize(_features(spark, folder))))


@register("positional_split", _SPLIT, _warehouse("features", _SPLIT_SQL, parts="""
    SELECT *, CASE WHEN row_number() OVER (ORDER BY store_id, product_id, sale_date)
        <= FLOOR(COUNT(*) OVER () * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'test' END AS part FROM features"""))
def _(spark, folder):
    return _split_totals(*modeling.positional_split(_features(spark, folder)))


_SCALED = ["lag_1d", "rolling_7d_mean", "rolling_30d_mean", "price_ratio", "is_promotion"]


@register("scaled_features", _KEY + " ".join(f"{c}:d" for c in _SCALED), _warehouse(
    "features", "SELECT features.* REPLACE (" + ", ".join(f"({c} - m_{c}) / s_{c} AS {c}" for c in _SCALED)
    + ") FROM features, cutoff, fitted WHERE sale_date > cutoff", cutoff=_CUTOFF,
    fitted="SELECT " + ", ".join(f"AVG({c}) AS m_{c}, STDDEV_POP({c}) AS s_{c}" for c in _SCALED)
    + " FROM features, cutoff WHERE sale_date <= cutoff"))
def _(spark, folder):
    train, test = modeling.date_split(materialize(_features(spark, folder)))
    return modeling.standardize(train, [test], _SCALED)[1]


_SEQUENCE = ["units_sold", "is_promotion", "is_holiday"]


@register("sequences", _KEY + "flat target:i", _warehouse("features", f"""
    SELECT *, array_to_string(flatten(rows), ',') AS flat, units_sold AS target FROM (
        SELECT *, list([{', '.join(_SEQUENCE)}]) OVER ({oracle.SERIES} ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS rows
        FROM features) WHERE len(rows) = 5"""))
def _(spark, folder):
    rows = modeling.sequences(_features(spark, folder), _SEQUENCE, length=5)
    numbers = F.transform(F.flatten("sequence"), lambda x: x.cast("int").cast("string"))
    return rows.withColumn("flat", F.array_join(numbers, ","))


_NAIVE = ["lag_1d", "lag_7d", "rolling_7d_mean"]
_METRICS = "model mae:d rmse:d r2:d mape:d"
_LONG = " UNION ALL ".join(
    f"SELECT '{c}' AS model, CAST(units_sold AS DOUBLE) AS y, CAST({c} AS DOUBLE) AS p FROM features WHERE {c} IS NOT NULL"
    for c in _NAIVE
)
_METRICS_SQL = """SELECT model, ROUND(AVG(ABS(y - p)), 4) AS mae, ROUND(SQRT(AVG((y - p) * (y - p))), 4) AS rmse,
    ROUND(1 - AVG((y - p) * (y - p)) / VAR_POP(y), 4) AS r2, ROUND(AVG(ABS((y - p) / GREATEST(y, 1))) * 100, 2) AS mape
    FROM forecasts GROUP BY 1"""


def _naive_metrics(spark, folder):
    rows = _features(spark, folder).select(
        "units_sold",
        F.inline(F.array(*[F.struct(F.lit(c).alias("model"), F.col(c).cast("double").alias("prediction")) for c in _NAIVE])),
    )
    return modeling.regression_metrics(rows.filter("prediction IS NOT NULL"), by=["model"])


@register("regression_metrics", _METRICS, _warehouse("features", _METRICS_SQL, forecasts=_LONG))
def _(spark, folder):
    return _naive_metrics(spark, folder)


@register("best_model", _METRICS, _warehouse(
    "features", "SELECT * FROM metrics ORDER BY r2 DESC, model LIMIT 1", forecasts=_LONG, metrics=_METRICS_SQL))
def _(spark, folder):
    return modeling.best_model(_naive_metrics(spark, folder))


def _fit(spark, folder, *names):
    """The named default models (all unless given), fitted once for these inputs: (stored fit, folder of each)."""
    keys, target = ["sale_date", "store_id", "product_id"], "units_sold"
    rows = materialize(frame.encode_features(_frame_features(spark, folder), keep=keys))
    inputs = [c for c in rows.columns if c not in (*keys, target, *frame.LEAKING)]
    train, test = modeling.date_split(rows)
    models = {name: model for name, model in modeling.default_models(target).items() if not names or name in names}
    # sums of doubles follow the order of the shuffle, so only the tables name the same fit in every run
    tables = (tpch.raw_sales(spark, folder), tpch.stores(spark, folder), tpch.brands(spark, folder))
    fit = modeling.StoredFit(train, test, inputs, target, keys, source="|".join(map(modeling.fingerprint, tables)))
    return fit, fit.ensure(models)


@register("gbt_forecast", _KEY + "units_sold:d prediction:d")
def _(spark, folder):
    fit, paths = _fit(spark, folder, "boosted_trees")
    return fit.predictions(paths["boosted_trees"])


@register("model_comparison", _METRICS)
def _(spark, folder):
    fit, paths = _fit(spark, folder)
    return fit.metrics(paths)


@register("feature_importance", "feature importance:d")
def _(spark, folder):
    fit, paths = _fit(spark, folder, "boosted_trees")
    return modeling.feature_importance(fit.model(paths["boosted_trees"]), fit.features)


# Streams

def _event_stream(spark, folder):
    return jobs.event_source(spark, f"{folder}/events.parquet*", tpch.TABLES["events"])


def _run(spark: SparkSession, stream: DataFrame) -> DataFrame:
    path = _scratch_path(spark)
    jobs.run_to_files(stream, f"{path}/out", f"{path}/state").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/out")


@register("stream_dedup", "user_id event_type day", """
    SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS day FROM events""")
def _(spark, folder):
    stream = _event_stream(spark, folder).withColumn("day", F.to_date("ts"))
    return _run(spark, jobs.dedup(stream, ["user_id", "event_type", "day"]))


_CLOSED = "(SELECT MAX(ts) - INTERVAL 1 DAY FROM events)"


@register("stream_rolling", "day event_type n:i total:d rate:d", f"""
    SELECT CAST(window_start AS DATE) AS day, event_type, COUNT(*) AS n, SUM(value) AS total, AVG(value) AS rate
    FROM (SELECT *, date_trunc('day', ts) - to_days(CAST(unnest(range(7)) AS INTEGER)) AS window_start FROM events)
    WHERE window_start + INTERVAL 7 DAY <= {_CLOSED} GROUP BY 1, 2""")
def _(spark, folder):
    rows = _run(spark, jobs.demand_windows(_event_stream(spark, folder), ["event_type"]))
    return rows.withColumn("day", F.to_date("window_start"))


@register("stream_tumbling", "day event_type n:i total:d rate:d", f"""
    SELECT CAST(ts AS DATE) AS day, event_type, COUNT(*) AS n, SUM(value) AS total, AVG(value) AS rate
    FROM events WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= {_CLOSED} GROUP BY 1, 2""")
def _(spark, folder):
    rows = _run(spark, jobs.demand_windows(_event_stream(spark, folder), ["event_type"], length="1 day"))
    return rows.withColumn("day", F.to_date("window_start"))


@register("stream_sessions", "user_id session_start session_end n:i total:d", f"""
    SELECT user_id, MIN(ts) AS session_start, MAX(ts) + INTERVAL 6 HOUR AS session_end, COUNT(*) AS n, SUM(value) AS total
    FROM (SELECT *, SUM(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM (
        SELECT *, CASE WHEN ts - LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 6 HOUR
            THEN 0 ELSE 1 END AS fresh FROM events))
    GROUP BY user_id, s HAVING MAX(ts) + INTERVAL 6 HOUR <= {_CLOSED}""")
def _(spark, folder):
    rows = _run(spark, jobs.demand_sessions(_event_stream(spark, folder), ["user_id"], gap="6 hours"))
    # as in the source table, without a time zone
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")})


@register("stream_score", _RESPONSE, _requests("scored"))
def _(spark, folder):
    responses, _ = jobs.score_requests(tpch.requests(spark, folder, streaming=True))
    return _run(spark, responses)


@register("stream_quarantine", "store_id product_id violations", _requests("checked", f"SELECT * FROM ({_BROKEN}) WHERE len(broken) > 0"))
def _(spark, folder):
    _, quarantine = jobs.score_requests(tpch.requests(spark, folder, streaming=True))
    return _run(spark, quarantine).withColumn("violations", F.array_join("violations", ","))


@register("stream_daily_mart", "sale_date event_type num_transactions:i total_units:d", """
    SELECT CAST(ts AS DATE) AS sale_date, event_type, COUNT(*) AS num_transactions, SUM(value) AS total_units
    FROM events GROUP BY 1, 2""")
def _(spark, folder):
    path = _scratch_path(spark)
    mart = jobs.daily_mart(_event_stream(spark, folder), ["event_type"])
    jobs.run_daily_mart(mart, f"{path}/out", f"{path}/state").awaitTermination()
    return jobs.read_daily_mart(spark, f"{path}/out", ["event_type"])


@register(
    "stream_store_mart",
    "sale_date store_id region store_type num_transactions:i total_units:i total_revenue:d avg_units:d avg_price_ratio:a",
    _warehouse("stores", f"""
        SELECT sale_date, r.store_id, region, store_type, COUNT(*) AS num_transactions, SUM(units_sold) AS total_units,
            SUM(revenue) AS total_revenue, AVG(units_sold) AS avg_units, AVG(price_ratio) AS avg_price_ratio
        FROM (SELECT *, CASE WHEN competitor_price > 0
                THEN {oracle.near('CAST(unit_price AS DOUBLE) / competitor_price', 4)} ELSE 1.0 END AS price_ratio FROM raw) r
        LEFT JOIN stores s ON r.store_id = s.store_id GROUP BY 1, 2, 3, 4"""),
)
def _(spark, folder):
    path = _scratch_path(spark)
    arriving = tpch.sales(spark, folder, streaming=True).join(tpch.stores(spark, folder), "store_id", "left")
    jobs.run_store_mart(arriving, f"{path}/out", f"{path}/state").awaitTermination()
    return jobs.read_store_mart(spark, f"{path}/out")


# Sources and sinks

def _raw_layer(spark: SparkSession, folder: str, prefix: str, sales: DataFrame) -> str:
    """The declared tables, filled, in the raw layer of this prefix."""
    layer = writers.create_layers(spark, prefix)[0]
    writers.create_tables(spark, layer)
    for name, df in (("sales", sales), ("stores", tpch.stores(spark, folder)), ("products", tpch.brands(spark, folder))):
        writers.typed(df, name).write.insertInto(f"{layer}.{name}")
    return layer


def _then_dropped(spark: SparkSession, prefix: str, result: DataFrame) -> DataFrame:
    result = materialize(result)
    for name in schemas.LAYERS:
        spark.sql(f"DROP DATABASE {prefix}{name} CASCADE")
    return result


@register("sink_typed_tables", "id:i " + _SALES, _warehouse("raw", "SELECT * REPLACE (0 AS is_holiday, 0 AS discount_pct) FROM raw"))
def _(spark, folder):
    prefix = f"run_{uuid.uuid4().hex}_"
    layer = _raw_layer(spark, folder, prefix, tpch.sales(spark, folder).drop("is_holiday", "discount_pct"))
    return _then_dropped(spark, prefix, spark.table(f"{layer}.sales"))


@register(
    "sink_warehouse_tables",
    "sale_date store_id region store_type num_transactions:i total_units:i total_revenue:d avg_units:d avg_price_ratio:a",
    _warehouse("features", """SELECT sale_date, store_id, region, store_type, COUNT(*) AS num_transactions,
        SUM(units_sold) AS total_units, SUM(revenue) AS total_revenue, AVG(units_sold) AS avg_units,
        AVG(price_ratio) AS avg_price_ratio FROM features GROUP BY 1, 2, 3, 4"""),
)
def _(spark, folder):
    prefix = f"run_{uuid.uuid4().hex}_"
    _raw_layer(spark, folder, prefix, tpch.sales(spark, folder))
    written = pipelines.run_warehouse_track(spark, prefix)
    return _then_dropped(spark, prefix, spark.table(next(t for t in written if t.endswith("mv_daily_store_demand"))))


@register("stage_features", _KEY + _ALL_FRAME + " volatility_band", _frame("frame_features"))
def _(spark, folder):
    path = _scratch_path(spark)
    writers.write_stage(_frame_features(spark, folder), path, partition_by=("month",))
    return readers.read_stage(spark, path, "features")


@register("stage_encoded", _ALL_FRAME + " " + " ".join(f"volatility_band_{x}:n" for x in _LEVELS), ORACLE_ENCODED)
def _(spark, folder):
    path = _scratch_path(spark)
    writers.write_stage(frame.build_features(_cleaned(spark, folder))[1], path, partition_by=())
    return readers.read_stage(spark, path, "encoded features")


@register("source_csv_sales", _CSV.replace(":t", ""), _frame("csv"))
def _(spark, folder):
    path = _scratch_path(spark)
    sales = tpch.raw_sales(spark, folder)
    # header names as they may come: capitals and blanks
    sales.toDF(*[c.replace("_", " ").title() for c in sales.columns]).write.option("header", True).csv(path)
    return readers.read_sales(spark, path)


@register("source_csv_stores", "store_id region store_type store_size_sqft:i opening_year:i", _warehouse("stores"))
def _(spark, folder):
    path = _scratch_path(spark)
    tpch.stores(spark, folder).write.option("header", True).csv(path)
    return readers.read_stores(spark, path)


@register("source_csv_products", "product_id category sub_category base_price:d cost_price:d is_perishable:n", _warehouse("products"))
def _(spark, folder):
    path = _scratch_path(spark)
    tpch.brands(spark, folder).write.option("header", True).csv(path)
    return readers.read_products(spark, path)


@register("sink_partitioned_stage", "year:n month:n n:i units:i", _frame("dated", """
    SELECT year, month, COUNT(*) AS n, SUM(units_sold) AS units FROM dated WHERE year = 1998 GROUP BY 1, 2"""))
def _(spark, folder):
    path = _scratch_path(spark)
    writers.write_stage(cleaning.parse_dates(tpch.raw_sales(spark, folder)), path)
    rows = readers.read_stage(spark, path).filter("year = 1998")
    return rows.groupBy("year", "month").agg(F.count("*").alias("n"), F.sum("units_sold").alias("units"))


@register("sink_json_report", "product_id risk_score:d", _warehouse("features", f"""
    SELECT product_id, ROUND_EVEN(risk_score, 4) AS risk_score FROM ({_RISK.format(key='')})
    ORDER BY risk_score DESC, product_id DESC LIMIT 20"""))
def _(spark, folder):
    path = _scratch_path(spark)
    risky = inventory.top_k(inventory.stockout_risk(_features(spark, folder)), 20)
    writers.write_report({"top_k_stockout": risky.withColumn("risk_score", round_half_even(F.col("risk_score"), 4))}, path)
    return spark.read.schema("product_id string, risk_score double").json(f"{path}/top_k_stockout")


@register("sink_metrics", _METRICS, _warehouse("features", _METRICS_SQL, forecasts=_LONG))
def _(spark, folder):
    path = _scratch_path(spark)
    writers.write_metrics(_naive_metrics(spark, folder), path)
    schema = "mae double, model string, rmse double, r2 double, mape double"
    return spark.read.schema(schema).json(f"{path}/json")


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Which products are most often at a high stockout risk."""
    return QUERIES["mart_stockout"](spark, folder)
