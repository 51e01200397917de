"""SQL counterparts of the registered queries, for a second engine on the same tables.

Each track is a chain of named steps; a query takes the steps it needs.
"""

from __future__ import annotations

from shelfline import schemas
from shelfline.sources import tpch

_TEXT = "VARCHAR"
_NEAR = "CAST(ROUND(CAST({} AS DECIMAL(28,10)), {}) AS DOUBLE)"
_TIES = [
    "id", "category", "units_sold", "unit_price", "revenue", "discount_pct", "is_promotion", "is_holiday",
    "competitor_price",
]
SERIES = "PARTITION BY store_id, product_id ORDER BY sale_date"


def near(expr: str, digits: int) -> str:
    return _NEAR.format(expr, digits)


def half_even(expr: str, digits: int) -> str:
    return f"ROUND_EVEN({expr}, {digits})"


WAREHOUSE = {
    "raw": tpch.sales_sql(text=_TEXT),
    "stores": tpch.STORES_SQL.format(text=_TEXT),
    "products": tpch.BRANDS_SQL,
    "deduped": f"""
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY sale_date, store_id, product_id
            ORDER BY loaded_at DESC NULLS FIRST, {', '.join(f'{c} DESC NULLS LAST' for c in _TIES)}) AS rn
          FROM raw) WHERE rn = 1""",
    "valid": """
        SELECT * FROM deduped
        WHERE NOT COALESCE(units_sold < 0 OR unit_price <= 0 OR revenue < 0 OR sale_date IS NULL, FALSE)""",
    "caps": """
        SELECT quantile_cont(CAST(units_sold AS DOUBLE), 0.99) AS units_p99,
               quantile_cont(CAST(unit_price AS DOUBLE), 0.99) AS price_p99,
               quantile_cont(CAST(revenue AS DOUBLE), 0.99) AS revenue_p99,
               quantile_cont(CAST(competitor_price AS DOUBLE), 0.5) AS median_price FROM valid""",
    "capped": """
        SELECT valid.* REPLACE (
            LEAST(units_sold, CAST(ROUND_EVEN(units_p99, 0) AS INTEGER)) AS units_sold,
            LEAST(unit_price, CAST(price_p99 AS DECIMAL(10,2))) AS unit_price,
            LEAST(revenue, CAST(revenue_p99 AS DECIMAL(12,2))) AS revenue)
        FROM valid, caps""",
    "filled": """
        SELECT capped.* REPLACE (COALESCE(competitor_price, CAST(median_price AS DECIMAL(10,2))) AS competitor_price)
        FROM capped, caps""",
    "enriched": f"""
        SELECT f.*, st.region, st.store_type, st.store_size_sqft, p.sub_category, p.base_price, p.cost_price,
               p.is_perishable,
               f.revenue - f.units_sold * p.cost_price AS gross_profit,
               CASE WHEN p.base_price > 0
                    THEN {near('CAST((p.base_price - f.unit_price) AS DOUBLE) / p.base_price * 100', 2)}
                    ELSE 0 END AS effective_discount
        FROM filled f LEFT JOIN stores st ON f.store_id = st.store_id
        LEFT JOIN products p ON f.product_id = p.product_id""",
    "lagged": f"""
        SELECT *,
          LAG(units_sold, 1) OVER w AS lag_1d, LAG(units_sold, 7) OVER w AS lag_7d,
          LAG(units_sold, 14) OVER w AS lag_14d, LAG(units_sold, 30) OVER w AS lag_30d,
          units_sold - LAG(units_sold, 365) OVER w AS yoy_change,
          AVG(units_sold) OVER ({SERIES} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS rolling_7d_mean,
          AVG(units_sold) OVER ({SERIES} ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS rolling_30d_mean,
          MAX(units_sold) OVER ({SERIES} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS rolling_7d_max,
          MIN(units_sold) OVER ({SERIES} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS rolling_7d_min,
          RANK() OVER (PARTITION BY store_id, sale_date ORDER BY units_sold DESC NULLS FIRST) AS demand_rank,
          CASE WHEN competitor_price > 0
               THEN {near('CAST(unit_price AS DOUBLE) / competitor_price', 4)} ELSE 1.0 END AS price_ratio
        FROM enriched WINDOW w AS ({SERIES})""",
    "features": f"""
        SELECT *,
          CASE WHEN units_sold < 5 THEN 'Low' WHEN units_sold < 20 THEN 'Medium' WHEN units_sold < 50 THEN 'High'
               ELSE 'Surge' END AS demand_band,
          CASE WHEN rolling_7d_mean > 0
               THEN {near('(rolling_7d_max - rolling_7d_min) / rolling_7d_mean', 4)} ELSE 0 END AS demand_volatility,
          CASE WHEN lag_1d = 0 AND lag_7d < rolling_7d_mean * CAST(0.5 AS DOUBLE) THEN 'High'
               WHEN lag_1d < rolling_7d_mean * CAST(0.3 AS DOUBLE) THEN 'Medium' ELSE 'Low' END AS stockout_risk
        FROM lagged WHERE sale_date >= (SELECT MIN(sale_date) + INTERVAL 30 DAY FROM lagged)""",
}

_NUMBERS = [
    "units_sold", "unit_price", "revenue", "discount_pct", "competitor_price", "store_size_sqft", "opening_year",
    "base_price", "cost_price",
]
_FLAGS = ["is_promotion", "is_holiday", "is_perishable"]
_TEXTS = ["category", "region", "store_type", "sub_category"]


def _csv(suffix: str) -> str:
    return f"""
        SELECT CASE WHEN id % 211 = 0 THEN '2024-02-30' ELSE CAST(sale_date AS VARCHAR) END AS sale_date,
               store_id, product_id, CASE WHEN id % 50 <> 3 THEN category END AS category,
               CAST(units_sold AS DOUBLE) AS units_sold, CAST(unit_price AS DOUBLE) AS unit_price,
               CAST(revenue AS DOUBLE) AS revenue, CAST(discount_pct AS DOUBLE) AS discount_pct,
               CAST(is_promotion AS INTEGER) AS is_promotion, CAST(is_holiday AS INTEGER) AS is_holiday,
               CAST(competitor_price AS DOUBLE) AS competitor_price FROM raw {suffix}"""


_CALENDAR = {
    "day_of_week": "CAST(isodow(sale_date) - 1 AS INTEGER)",
    "day_of_month": "CAST(day(sale_date) AS INTEGER)",
    "week_of_year": "CAST(weekofyear(sale_date) AS INTEGER)",
    "month": "CAST(month(sale_date) AS INTEGER)",
    "quarter": "CAST(quarter(sale_date) AS INTEGER)",
    "year": "CAST(year(sale_date) AS INTEGER)",
    "is_weekend": "CASE WHEN isodow(sale_date) >= 6 THEN 1 ELSE 0 END",
}
_CALENDAR_SQL = ", ".join(f"{sql} AS {name}" for name, sql in _CALENDAR.items())


def _mode(c: str) -> str:
    return f"(SELECT {c} FROM merged WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY COUNT(*) DESC, {c} LIMIT 1)"


def _rolling(n: int) -> str:
    frame = f"({SERIES} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    return (
        f"AVG(units_sold) OVER {frame} AS rolling_{n}d_mean, STDDEV_SAMP(units_sold) OVER {frame} AS rolling_{n}d_std, "
        f"MAX(units_sold) OVER {frame} AS rolling_{n}d_max"
    )


def _fourier() -> str:
    cycles = {"annual": "dayofyear(sale_date) / 365.25", "weekly": "(isodow(sale_date) - 1) / 7.0", "monthly": "month(sale_date) / 12.0"}
    return ", ".join(
        f"{f}(2 * pi() * CAST({x} AS DOUBLE)) AS {f}_{name}" for name, x in cycles.items() for f in ("sin", "cos")
    )


_FILLED_FEATURES = [
    *[f"lag_{n}d" for n in (1, 3, 7, 14, 30)],
    *[f"rolling_{n}d_{f}" for n in (7, 14, 30) for f in ("mean", "std", "max")],
    "demand_volatility",
]

FRAME = {
    "raw": WAREHOUSE["raw"],
    "stores": WAREHOUSE["stores"],
    "products": WAREHOUSE["products"],
    "csv": f"{_csv('')} UNION ALL {_csv('WHERE id % 25 = 0')}",
    "dated": f"""
        SELECT *, {_CALENDAR_SQL}
        FROM (SELECT * REPLACE (TRY_CAST(sale_date AS DATE) AS sale_date) FROM csv) WHERE sale_date IS NOT NULL""",
    "distinct_rows": "SELECT DISTINCT * FROM dated",
    "nonnegative": "SELECT * FROM distinct_rows WHERE units_sold >= 0 AND revenue >= 0",
    "merged": """
        SELECT n.*, st.region, st.store_type, st.store_size_sqft, st.opening_year, p.sub_category, p.base_price,
               p.cost_price, p.is_perishable
        FROM nonnegative n LEFT JOIN stores st ON n.store_id = st.store_id
        LEFT JOIN products p ON n.product_id = p.product_id""",
    "medians": "SELECT "
    + ", ".join(f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS m_{c}" for c in _NUMBERS + _FLAGS)
    + ", " + ", ".join(f"{_mode(c)} AS m_{c}" for c in _TEXTS)
    + " FROM merged",
    "imputed": "SELECT merged.* REPLACE ("
    + ", ".join(f"COALESCE(CAST({c} AS DOUBLE), m_{c}) AS {c}" for c in _NUMBERS + _FLAGS)
    + ", " + ", ".join(f"COALESCE({c}, m_{c}) AS {c}" for c in _TEXTS)
    + ") FROM merged, medians",
    "limits": "SELECT "
    + ", ".join(f"quantile_cont({c}, 0.01) AS lo_{c}, quantile_cont({c}, 0.99) AS hi_{c}" for c in _NUMBERS)
    + " FROM imputed",
    "cleaned": "SELECT imputed.* REPLACE ("
    + ", ".join(f"CASE WHEN lo_{c} <> hi_{c} THEN GREATEST(LEAST({c}, hi_{c}), lo_{c}) ELSE {c} END AS {c}" for c in _NUMBERS)
    + ") FROM imputed, limits",
    "daily": """
        SELECT sale_date, store_id, product_id, SUM(units_sold) AS units_sold, SUM(revenue) AS revenue,
               AVG(unit_price) AS avg_price, AVG(competitor_price) AS avg_competitor_price,
               MAX(discount_pct) AS max_discount, MAX(is_promotion) AS had_promotion, MAX(is_holiday) AS is_holiday
        FROM cleaned WHERE store_id IS NOT NULL AND product_id IS NOT NULL GROUP BY ALL""",
    "windowed": f"""
        SELECT *,
          {', '.join(f'LAG(units_sold, {n}) OVER w AS lag_{n}d' for n in (1, 3, 7, 14, 30))},
          {', '.join(_rolling(n) for n in (7, 14, 30))},
          CASE WHEN avg_competitor_price > 0 THEN avg_price / avg_competitor_price ELSE 1.0 END AS price_ratio,
          CASE WHEN LAG(avg_price) OVER w IS NULL THEN 0
               WHEN LAG(avg_price) OVER w = 0 THEN SIGN(avg_price)
               ELSE GREATEST(-1, LEAST(1, avg_price / LAG(avg_price) OVER w - 1)) END AS price_change_pct,
          CASE WHEN max_discount > 0 THEN 1 ELSE 0 END AS discount_flag,
          {', '.join(f'{sql} AS {name}' for name, sql in _CALENDAR.items() if name != 'year')},
          CASE WHEN day(sale_date) <= 5 THEN 1 ELSE 0 END AS is_month_start,
          CASE WHEN day(sale_date) >= 25 THEN 1 ELSE 0 END AS is_month_end,
          {_fourier()},
          COALESCE(units_sold - LAG(units_sold) OVER w, 0) AS demand_velocity,
          SUM(units_sold) OVER (PARTITION BY store_id, product_id, year(sale_date) ORDER BY sale_date
                                ROWS UNBOUNDED PRECEDING) AS ytd_cumulative
        FROM daily WINDOW w AS ({SERIES})""",
    "volatile": """
        SELECT *, CASE WHEN rolling_7d_mean > 0 THEN
            CASE WHEN rolling_7d_std IS NOT NULL THEN LEAST(rolling_7d_std / rolling_7d_mean, 5) END
            ELSE 0 END AS demand_volatility FROM windowed""",
    "banded": """
        SELECT *, CASE WHEN demand_volatility IS NULL THEN 'nan' WHEN demand_volatility <= 0.3 THEN 'Stable'
            WHEN demand_volatility <= 0.7 THEN 'Moderate' WHEN demand_volatility <= 1.5 THEN 'Volatile'
            ELSE 'Erratic' END AS volatility_band FROM volatile""",
    "warm": "SELECT * FROM banded WHERE sale_date >= (SELECT MIN(sale_date) + INTERVAL 30 DAY FROM banded)",
    "frame_features": "SELECT * REPLACE ("
    + ", ".join(f"COALESCE({c}, 0) AS {c}" for c in _FILLED_FEATURES) + ") FROM warm",
}

REQUESTS = {
    "requests": tpch.REQUESTS_SQL.format(text=_TEXT),
    "defaulted": "SELECT * REPLACE ("
    + ", ".join(
        f"COALESCE({c}, 0) AS {c}"
        for c in ("competitor_price", "is_promotion", "discount_pct", "is_holiday", "lag_7d", "lag_30d",
                  "rolling_7d_mean", "rolling_30d_mean")
    ) + ") FROM requests",
    "checked": """
        SELECT *, list_filter([
            CASE WHEN NOT (length(store_id) BETWEEN 1 AND 10) THEN 'store_id' END,
            CASE WHEN NOT (length(product_id) BETWEEN 1 AND 10) THEN 'product_id' END,
            CASE WHEN category NOT IN (""" + ", ".join(f"'{c}'" for c in schemas.CATEGORIES) + """) THEN 'category' END,
            CASE WHEN NOT (current_price > 0 AND current_price <= 10000) THEN 'current_price' END,
            CASE WHEN NOT current_price <= 5000 THEN 'current_price_reasonable' END,
            CASE WHEN NOT (competitor_price BETWEEN 0 AND 10000) THEN 'competitor_price' END,
            CASE WHEN is_promotion NOT IN (0, 1) THEN 'is_promotion' END,
            CASE WHEN NOT (discount_pct BETWEEN 0 AND 100) THEN 'discount_pct' END,
            CASE WHEN is_holiday NOT IN (0, 1) THEN 'is_holiday' END,
            CASE WHEN NOT lag_7d >= 0 THEN 'lag_7d' END,
            CASE WHEN NOT lag_30d >= 0 THEN 'lag_30d' END,
            CASE WHEN NOT rolling_7d_mean >= 0 THEN 'rolling_7d_mean' END,
            CASE WHEN NOT rolling_30d_mean >= 0 THEN 'rolling_30d_mean' END], lambda x: x IS NOT NULL) AS broken
        FROM defaulted""",
    "valid_requests": "SELECT * FROM checked WHERE len(broken) = 0",
    "based": """
        SELECT *, (CASE category """ + " ".join(
            f"WHEN '{c}' THEN {d}" for c, d in schemas.CATEGORY_DEMAND.items()
        ) + """ ELSE 10 END)
            * CAST(CASE WHEN competitor_price > 0 AND current_price / competitor_price > 1.1 THEN 0.8
                        WHEN competitor_price > 0 AND current_price / competitor_price < 0.9 THEN 1.2 ELSE 1 END AS DOUBLE)
            * CAST(CASE WHEN is_promotion <> 0 THEN 1.5 ELSE 1 END AS DOUBLE)
            * CAST(CASE WHEN is_holiday <> 0 THEN 1.8 ELSE 1 END AS DOUBLE) AS base
        FROM valid_requests""",
    "predicted": """
        SELECT *, GREATEST(0, ROUND_EVEN(CASE WHEN rolling_7d_mean > 0
            THEN CAST(0.4 AS DOUBLE) * base + CAST(0.6 AS DOUBLE) * rolling_7d_mean ELSE base END, 2)) AS predicted_demand
        FROM based""",
    "scored": """
        SELECT *,
          substr(md5(concat_ws('_', store_id, product_id, CAST(current_price AS VARCHAR), CAST(lag_7d AS VARCHAR))), 1, 12)
            AS request_id,
          CASE WHEN predicted_demand < 5 THEN 'Low' WHEN predicted_demand < 20 THEN 'Medium'
               WHEN predicted_demand < 50 THEN 'High' ELSE 'Surge' END AS demand_band,
          CASE WHEN predicted_demand > level * CAST(1.5 AS DOUBLE) THEN 'REORDER_NOW'
               WHEN predicted_demand > level * CAST(1.1 AS DOUBLE) THEN 'MONITOR' ELSE 'SUFFICIENT' END
            AS reorder_recommendation,
          CAST(0.75 AS DOUBLE) AS confidence,
          CASE WHEN len(risks) = 0 THEN 'No significant risk factors' ELSE array_to_string(risks, '; ') END AS risk_factors
        FROM (SELECT *, CASE WHEN rolling_7d_mean > 0 THEN rolling_7d_mean ELSE predicted_demand END AS level,
          list_filter([
            CASE WHEN competitor_price > 0 AND current_price > competitor_price * CAST(1.1 AS DOUBLE)
                 THEN 'Price higher than competitor by >10%' END,
            CASE WHEN discount_pct > 20
                 THEN concat('Heavy discount (', CAST(discount_pct AS VARCHAR), '%) may spike demand') END,
            CASE WHEN is_promotion <> 0 THEN 'Active promotion — expect 50%+ demand increase' END,
            CASE WHEN is_holiday <> 0 THEN 'Holiday period — expect 80%+ demand surge' END,
            CASE WHEN rolling_7d_mean > 0 AND lag_7d > rolling_7d_mean * CAST(1.5 AS DOUBLE)
                 THEN 'Recent demand spike detected' END], lambda x: x IS NOT NULL) AS risks
          FROM predicted)""",
}


def with_steps(chain: dict[str, str], last: str | None, query: str, **extra: str) -> str:
    """``query`` after the steps of ``chain`` up to ``last`` and the ``extra`` steps."""
    steps = []
    for name, sql in chain.items():
        if last is None:
            break
        steps.append(f"{name} AS ({sql})")
        if name == last:
            break
    steps += [f"{name} AS ({sql})" for name, sql in extra.items()]
    return f"WITH {', '.join(steps)} {query}" if steps else query
