"""SQL counterparts of the registered queries, for checking results in DuckDB.

Each text derives the panel from the raw order-line tables on its own and
computes the result the plain way (day-by-day grids, self joins), sharing no
code with the Spark operators beyond the parameters of the registered queries.
"""

from __future__ import annotations

from .. import __version__ as VERSION
from .queries import LATEST_RUNS, MIN_HOLIDAY_ROWS, SCENARIOS, SURGE, SURGE_LABEL

ORACLES: dict[str, str] = {}

ENGINE_VERSION = "1.0.0"

REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
DISCOUNTS = [f"type_{i}_discount" for i in range(7)]


def up(value: str, places: int) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(38,10)), {places}) AS DOUBLE)"


def even(value: str, places: int) -> str:
    scale = f"{10**places}.0::DOUBLE"
    return f"(round_even(({value}) * {scale}, 0) / {scale})"


# --- the derived tables as common table expressions ---------------------------


def _panel(grain: str) -> list[str]:
    brand = "CAST(substr(p_brand, 7) AS BIGINT)"
    types = " ".join(f"WHEN '{t}' THEN {i}" for i, t in enumerate(TYPES))
    key = (
        f"CAST(r_regionkey AS BIGINT) * 100 + (CASE p_type {types} END)"
        if grain == "dense"
        else f"CAST(r_regionkey AS BIGINT) * 10000 + (CASE p_type {types} END) * 100 + {brand}"
    )
    factor = 100 if grain == "dense" else 10000
    name = "p_type" if grain == "dense" else "p_type || '_' || p_brand"
    second = "CAST(NULL AS VARCHAR)" if grain == "dense" else "p_brand"
    discounts = ",\n    ".join(
        f"coalesce(max(l_discount + 0.0) FILTER (WHERE l_linenumber % 7 = {i}), 0.0::DOUBLE) AS d{i}"
        for i in range(7)
    )
    named = ", ".join(f"d{i} AS type_{i}_discount" for i in range(1, 7))
    return [
        f"""line AS (
  SELECT CAST(l_shipdate AS DATE) AS date, r_name AS warehouse, p_type, p_brand, {key} AS unique_id, l.*
  FROM lineitem l JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)""",
        f"""cell AS (
  SELECT unique_id, date, warehouse, sum(l_quantity) AS quantity,
    max(l_extendedprice / l_quantity) AS top_price,
    avg(CASE WHEN l_returnflag = 'R' THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END) AS availability,
    {discounts}
  FROM line GROUP BY unique_id, date, warehouse)""",
        """volume AS (
  SELECT warehouse, date, count(DISTINCT l_orderkey) AS orders FROM line GROUP BY warehouse, date)""",
        f"""panel AS (
  SELECT unique_id, date, warehouse,
    CASE WHEN lost THEN NULL ELSE orders + 0.5::DOUBLE * (unique_id % 2) END AS total_orders,
    CASE WHEN lost THEN NULL ELSE quantity END AS sales,
    {up('top_price / 500.0::DOUBLE', 2)} AS sell_price_main, availability,
    CASE WHEN (unique_id * 17 + day) % 4999 = 0 THEN -0.5::DOUBLE ELSE d0 END AS type_0_discount, {named}
  FROM (SELECT *, (unique_id * 31 + day) % 997 = 0 AS lost
        FROM (SELECT *, date_diff('day', DATE '1970-01-01', date) AS day FROM cell)
        JOIN volume USING (warehouse, date)))""",
        f"""inventory AS (
  SELECT DISTINCT unique_id, unique_id % {factor} AS product_unique_id, {name} AS name,
    p_type AS l1_category_name_en, {second} AS l2_category_name_en, CAST(NULL AS VARCHAR) AS l3_category_name_en,
    CAST(NULL AS VARCHAR) AS l4_category_name_en, warehouse FROM line
  UNION ALL
  SELECT id, id % 100000, 'UNSOLD_' || id, NULL, NULL, NULL, NULL, (SELECT min(r_name) FROM region)
  FROM (VALUES (900001::BIGINT), (900002::BIGINT)) AS unsold(id))""",
        """every_day AS (
  SELECT CAST(unnest(generate_series(min(l_shipdate), max(l_shipdate), INTERVAL 1 DAY)) AS DATE) AS date FROM lineitem)""",
        """calendar AS (
  SELECT date, holiday_name, CAST(holiday_name IS NOT NULL AS INTEGER) AS holiday,
    CAST(coalesce(holiday_name, 'Labour Day') <> 'Labour Day' AS INTEGER) AS shops_closed,
    CAST(month(date) = 12 AND day(date) >= 24 AS INTEGER) AS winter_school_holidays,
    CAST(month(date) IN (7, 8) AS INTEGER) AS school_holidays, warehouse
  FROM (SELECT date, r_name AS warehouse, CASE strftime(date, '%m-%d') WHEN '01-01' THEN 'New Year'
          WHEN '05-01' THEN 'Labour Day' WHEN '12-25' THEN 'Christmas' END AS holiday_name
        FROM every_day, region))""",
        """weights AS (
  SELECT unique_id, 1.0::DOUBLE + unique_id % 5 AS weight FROM inventory WHERE unique_id < 900001)""",
        """edge AS (SELECT max(date) AS last_day, max(date) - 27 AS cutoff FROM panel)""",
        """ahead AS (
  SELECT unique_id, date + 28 AS date, warehouse, total_orders, sell_price_main,
    type_0_discount, type_1_discount, type_2_discount, type_3_discount, type_4_discount, type_5_discount,
    type_6_discount FROM panel, edge WHERE date > last_day - 28)""",
    ]


_FORECAST = [
    "history AS (SELECT p.* FROM panel p, edge WHERE date < cutoff)",
    "holdout AS (SELECT p.* FROM panel p, edge WHERE date >= cutoff)",
    """grid AS (
  SELECT unique_id, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date
  FROM history GROUP BY unique_id)""",
    """regular AS (
  SELECT unique_id, date, coalesce(last_value(sales IGNORE NULLS) OVER (
      PARTITION BY unique_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS sales
  FROM grid LEFT JOIN (SELECT unique_id, date, sales FROM history) USING (unique_id, date))""",
    "everyone AS (SELECT avg(sales) AS mean FROM regular)",
    "ids AS (SELECT unique_id FROM history UNION SELECT unique_id FROM holdout)",
    "horizon AS (SELECT DISTINCT date FROM holdout)",
    "future AS (SELECT unique_id, date, isodow(date) - 1 AS dow FROM ids, horizon)",
    """recent AS (
  SELECT unique_id, avg(sales) AS mean FROM regular
  WHERE date >= (SELECT max(date) - 27 FROM regular) GROUP BY unique_id)""",
    """average AS (
  SELECT unique_id, date, coalesce(r.mean, e.mean) AS prediction,
    CASE WHEN r.mean IS NULL THEN 'global_mean' ELSE 'recent_mean' END AS method
  FROM future LEFT JOIN recent r USING (unique_id), everyone e)""",
    """last_week AS (
  SELECT unique_id, isodow(date) - 1 AS dow, sales FROM (
    SELECT *, row_number() OVER (PARTITION BY unique_id ORDER BY date DESC) AS back FROM regular)
  WHERE back <= 7)""",
    """own AS (SELECT unique_id, avg(sales) AS mean, count(*) AS n FROM regular GROUP BY unique_id)""",
    """naive AS (
  SELECT unique_id, date, coalesce(w.sales, CASE WHEN o.n < 7 THEN o.mean END, e.mean) AS prediction,
    CASE WHEN w.sales IS NOT NULL THEN 'last_week' WHEN o.n < 7 THEN 'series_mean' ELSE 'global_mean' END AS method
  FROM future LEFT JOIN last_week w USING (unique_id, dow) LEFT JOIN own o USING (unique_id), everyone e)""",
]

_RISK = [
    """seen AS (
  SELECT unique_id, CAST(sum(CAST(availability AS DECIMAL(28,9))) AS DOUBLE) / count(availability) AS recent_availability,
    count(*) AS n_days_observed,
    count(*) FILTER (WHERE availability < 0.5) AS low_avail_days
  FROM panel WHERE date >= (SELECT min(date) - 28 FROM average) AND date < (SELECT min(date) FROM average)
  GROUP BY unique_id)""",
    """need AS (
  SELECT unique_id, CAST(sum(CAST(prediction AS DECIMAL(28,9))) AS DOUBLE) AS forecast_units FROM average GROUP BY unique_id)""",
    f"""unmet AS (
  SELECT unique_id, forecast_units, recent_availability, n_days_observed, low_avail_days,
    coalesce(recent_availability, 1.0::DOUBLE) AS assumed_future_availability,
    coalesce(n_days_observed, 0) = 0 AS availability_data_gap,
    {even('forecast_units * greatest(least(1.0::DOUBLE - coalesce(recent_availability, 1.0::DOUBLE), 1.0::DOUBLE), 0.0::DOUBLE)', 2)} AS estimated_unmet_units
  FROM need LEFT JOIN seen USING (unique_id))""",
    f"""share AS (
  SELECT *, CASE WHEN forecast_units > 0 THEN {even('estimated_unmet_units / greatest(forecast_units, 1e-9::DOUBLE)', 4)} ELSE 0.0::DOUBLE END AS risk_fraction
  FROM unmet)""",
    """risk AS (
  SELECT s.*, CASE WHEN estimated_unmet_units >= 10 AND risk_fraction >= 0.1::DOUBLE THEN 'HIGH'
      WHEN estimated_unmet_units >= 5 AND risk_fraction >= 0.05::DOUBLE THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier,
    name, l1_category_name_en, warehouse
  FROM share s LEFT JOIN inventory USING (unique_id))""",
]


def quantity(unmet: str) -> str:
    return f"(CAST(ceil(greatest({unmet}, 0.0::DOUBLE) * (1.0::DOUBLE + 0.1::DOUBLE) / 5.0::DOUBLE) AS BIGINT) * 5)"


_RECS = [
    f"""recs AS (
  SELECT unique_id, name, warehouse, risk_tier,
    CASE WHEN availability_data_gap THEN 'investigate_data' WHEN risk_tier = 'HIGH' THEN 'replenish_now'
      WHEN risk_tier = 'MEDIUM' THEN 'replenish_scheduled' ELSE 'monitor' END AS action,
    CASE WHEN availability_data_gap OR risk_tier = 'LOW' THEN 0::BIGINT
      ELSE {quantity('estimated_unmet_units')} END AS recommended_units,
    greatest(estimated_unmet_units, 0.0::DOUBLE) AS estimated_unmet_units,
    CASE risk_tier WHEN 'HIGH' THEN 1 WHEN 'MEDIUM' THEN 2 ELSE 4 END AS priority,
    CASE WHEN availability_data_gap THEN 'R4_availability_data_gap' WHEN risk_tier = 'HIGH' THEN 'R1_high_risk_replenish'
      WHEN risk_tier = 'MEDIUM' THEN 'R2_medium_risk_schedule' ELSE 'R3_monitor' END AS rule_id,
    '{ENGINE_VERSION}' AS engine_version,
    forecast_units, recent_availability, assumed_future_availability, availability_data_gap
  FROM risk)"""
]
REC_COLUMNS = (
    "unique_id, name, warehouse, risk_tier, action, recommended_units, estimated_unmet_units, priority, "
    "rule_id, engine_version"
)


def _simulated(scenarios) -> list[str]:
    levers = ", ".join(
        f"('{s.tag}', {float(s.demand_multiplier)!r}::DOUBLE, {float(s.promo_uplift)!r}::DOUBLE, "
        f"{float(s.availability_improvement)!r}::DOUBLE)"
        for s in scenarios
    )
    return [
        f"levers(scenario, dm, pu, ai) AS (VALUES {levers})",
        """moved AS (
  SELECT scenario, r.*, forecast_units * (dm * (1.0::DOUBLE + pu)) AS scenario_demand_units,
    CASE WHEN availability_data_gap THEN 1.0::DOUBLE
      ELSE greatest(least(assumed_future_availability + ai, 1.0::DOUBLE), 0.0::DOUBLE) END AS scenario_availability,
    estimated_unmet_units AS baseline_unmet_units
  FROM risk r, levers)""",
        f"""short AS (
  SELECT *, {even('scenario_demand_units * (1.0::DOUBLE - scenario_availability)', 2)} AS scenario_unmet_units FROM moved)""",
        f"""simulated AS (
  SELECT *, {even('scenario_unmet_units - baseline_unmet_units', 2)} AS unmet_units_delta,
    {quantity('scenario_unmet_units')} AS scenario_recommended_units FROM short)""",
    ]


def _with(ctes: list[str], select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select.strip()


def _dense(key: str, select: str, *more: str) -> None:
    ORACLES[key] = _with(_panel("dense") + list(more), select)


def _sparse(key: str, select: str, *more: str) -> None:
    ORACLES[key] = _with(_panel("sparse") + list(more), select)


# --- sources -------------------------------------------------------------------

_dense("s00_panel", "SELECT * FROM panel")
_dense("s01_typed_scan", "SELECT * FROM panel")
_TABLES = {"sales_train": "panel", "sales_test": "ahead", "inventory": "inventory", "calendar": "calendar"}
_dense(
    "s03_source_profile",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n_rows, count(DISTINCT warehouse) AS n_warehouses FROM {cte}"
        for name, cte in _TABLES.items()
    )
    + " UNION ALL SELECT 'test_weights', count(*), 0 FROM weights",
)
_dense(
    "s04_dim_seed",
    """SELECT CAST(run AS INTEGER) AS run,
  CASE run WHEN 1 THEN (SELECT count(*) FROM first) WHEN 2 THEN (SELECT count(*) FROM everyone) - (SELECT count(*) FROM first) ELSE 0 END AS inserted,
  (SELECT count(*) FROM everyone) AS members
FROM (VALUES (1), (2), (3)) AS runs(run)""",
    "first AS (SELECT DISTINCT warehouse FROM inventory WHERE unique_id % 100 = 1 AND warehouse <> '')",
    """everyone AS (SELECT warehouse FROM panel UNION SELECT warehouse FROM ahead UNION SELECT warehouse FROM inventory
      UNION SELECT warehouse FROM calendar)""",
)
_dense(
    "s06_orphan_rows",
    """SELECT 'lineitem->part' AS reference, count(*) AS orphan_rows FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
WHERE p_partkey IS NULL
UNION ALL SELECT 'sales_train->inventory', count(*) FROM panel p LEFT JOIN inventory i ON p.unique_id = i.unique_id
WHERE i.unique_id IS NULL
UNION ALL SELECT 'inventory->sales_train', count(*) FROM inventory i
LEFT JOIN (SELECT DISTINCT unique_id FROM panel) p ON p.unique_id = i.unique_id WHERE p.unique_id IS NULL""",
)
_sparse(
    "s09_artifact_io",
    """SELECT risk_tier, count(*) AS series, (SELECT count(*) FROM risk) AS rows_written FROM risk GROUP BY risk_tier""",
    *_FORECAST, *_RISK,
)
_sparse(
    "s10_curated_reload",
    "SELECT unique_id, risk_tier, availability_data_gap FROM risk",
    *_FORECAST, *_RISK,
)
_MADE = " UNION ALL ".join(f"SELECT '{run.tag}' AS tag, TIMESTAMP '{made:%Y-%m-%d}' AS made" for run, made in LATEST_RUNS)
_sparse(
    "s11_latest_artifact",
    """SELECT scenario, CAST(made AS DATE) AS generated_at, count(*) AS series,
  CAST(sum(scenario_recommended_units) AS BIGINT) AS total_scenario_recommended_units
FROM simulated JOIN made ON scenario = tag WHERE made = (SELECT max(made) FROM made) GROUP BY scenario, made""",
    *_FORECAST, *_RISK, *_simulated([run for run, _ in LATEST_RUNS]), f"made AS ({_MADE})",
)
_sparse(
    "s13_summaries",
    """SELECT 'tier' AS summary, risk_tier AS item, count(*) AS series, CAST(NULL AS DOUBLE) AS units FROM risk GROUP BY risk_tier
UNION ALL SELECT 'action', action, count(*), CAST(sum(recommended_units) AS DOUBLE) FROM recs GROUP BY action
UNION ALL SELECT 'scenario', scenario, count(*), CAST(sum(scenario_recommended_units) AS DOUBLE) FROM simulated GROUP BY scenario
UNION ALL SELECT 'unmet', 'all', count(*), """
    + up("sum(estimated_unmet_units)", 2)
    + """ FROM risk
UNION ALL SELECT 'top_unmet', CAST(unique_id AS VARCHAR), 1, """
    + up("estimated_unmet_units", 2)
    + """ FROM (SELECT * FROM risk WHERE risk_tier = 'HIGH'
  ORDER BY estimated_unmet_units DESC NULLS LAST, forecast_units DESC NULLS LAST, unique_id LIMIT 10)
UNION ALL SELECT 'top_ordered', CAST(unique_id AS VARCHAR), 1, CAST(recommended_units AS DOUBLE)
FROM (SELECT * FROM recs WHERE recommended_units > 0 ORDER BY recommended_units DESC, unique_id LIMIT 10)
UNION ALL SELECT 'top_increase', CAST(unique_id AS VARCHAR), 1, """
    + up("unmet_units_delta", 2)
    + f""" FROM (SELECT * FROM simulated WHERE scenario = '{SURGE.tag}' ORDER BY unmet_units_delta DESC, unique_id LIMIT 10)""",
    *_FORECAST, *_RISK, *_RECS, *_simulated(SCENARIOS),
)

# --- quality -------------------------------------------------------------------

_COLUMNS = {
    "sales_train": ["unique_id", "date", "warehouse", "total_orders", "sales", "sell_price_main", "availability", *DISCOUNTS],
    "sales_test": ["unique_id", "date", "warehouse", "total_orders", "sell_price_main", *DISCOUNTS],
    "inventory": ["unique_id", "product_unique_id", "name", *[f"l{i}_category_name_en" for i in (1, 2, 3, 4)], "warehouse"],
    "calendar": ["date", "holiday_name", "holiday", "shops_closed", "winter_school_holidays", "school_holidays", "warehouse"],
    "test_weights": ["unique_id", "weight"],
}
_CTE = {**_TABLES, "test_weights": "weights"}
_KEYS = {
    "sales_train": "unique_id, date", "sales_test": "unique_id, date", "inventory": "unique_id",
    "calendar": "warehouse, date", "test_weights": "unique_id",
}


def _nulls(table: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count,
  CAST(round(CAST(count(*) FILTER (WHERE {c} IS NULL) / count(*)::DOUBLE AS DECIMAL(38,12)), 6) AS DOUBLE) AS null_pct,
  {str(c == 'holiday_name').lower()} AS by_design FROM {_CTE[table]}"""
        for c in _COLUMNS[table]
    )


_NULL_STATUS = "CASE WHEN by_design THEN 'PASS' WHEN null_pct > 0.5 THEN 'FAIL' WHEN null_count > 0 THEN 'WARN' ELSE 'PASS' END"
_dense(
    "v02_missingness",
    f"SELECT *, {_NULL_STATUS} AS status FROM ("
    + " UNION ALL ".join(_nulls(t) for t in ("sales_train", "inventory", "calendar")) + ")",
)


def _copies(name: str, source: str, key: str) -> str:
    return f"""SELECT '{name}' AS table_name, CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_rows, count(*) AS duplicate_key_groups,
  CASE WHEN count(*) > 0 THEN 'FAIL' ELSE 'PASS' END AS status
FROM (SELECT count(*) AS n FROM {source} GROUP BY {key} HAVING count(*) > 1)"""


_dense(
    "v03_duplicates",
    " UNION ALL ".join(
        [
            _copies("lineitem", "lineitem", "l_orderkey, l_linenumber"),
            _copies("sales_train", "panel", "unique_id, date"),
            _copies("calendar", "calendar", "warehouse, date"),
            _copies("orders", "orders", "o_orderkey"),
        ]
    ),
)
_dense(
    "v04_date_continuity",
    """SELECT warehouse AS group_value, min(date) AS min_date, max(date) AS max_date, count(DISTINCT date) AS n_days,
  CAST(date_diff('day', min(date), max(date)) + 1 - count(DISTINCT date) AS BIGINT) AS missing_days
FROM panel GROUP BY warehouse""",
)
_sparse(
    "v04b_missing_dates",
    """SELECT unique_id, date FROM (
  SELECT unique_id, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date
  FROM panel GROUP BY unique_id)
EXCEPT SELECT unique_id, date FROM panel""",
)


def _violations(table: str) -> str:
    rules = []
    if "sales" in _COLUMNS[table]:
        rules.append(("impossible", "negative_sales", "sales < 0"))
    if "sell_price_main" in _COLUMNS[table]:
        rules.append(("impossible", "negative_price", "sell_price_main < 0"))
    if "availability" in _COLUMNS[table]:
        rules.append(("impossible", "availability_outside_0_1", "availability < 0 OR availability > 1"))
    rules += [("outlier", f"{c}_outside_0_1", f"{c} < 0 OR {c} > 1") for c in _COLUMNS[table] if c.endswith("_discount")]
    return " UNION ALL ".join(
        f"""SELECT '{table}' AS table_name, '{kind}' AS kind, '{rule}' AS rule,
  count(*) FILTER (WHERE {test}) AS violations, count(*) AS n_rows FROM {_CTE[table]}"""
        for kind, rule, test in rules
    )


_NUMERIC_STATUS = """CASE WHEN sum(violations) FILTER (WHERE kind = 'impossible') OVER w > 0 THEN 'FAIL'
    WHEN sum(violations) FILTER (WHERE kind = 'outlier') OVER w > 0.001 * n_rows THEN 'FAIL'
    WHEN sum(violations) FILTER (WHERE kind = 'outlier') OVER w > 0 THEN 'WARN' ELSE 'PASS' END"""
_dense(
    "v05_numeric_sanity",
    f"SELECT *, {_NUMERIC_STATUS} AS status FROM ({_violations('sales_train')}) WINDOW w AS (PARTITION BY table_name)",
)


def _unknown(name: str, source: str, key: str, known: str, known_key: str, bad: str) -> str:
    missing = f"(SELECT {key} AS k FROM {source} WHERE {key} NOT IN (SELECT {known_key} FROM {known}))"
    return f"""SELECT '{name}' AS reference, count(*) AS unknown_key_rows,
  coalesce((SELECT string_agg(k::VARCHAR, ',' ORDER BY k) FROM (SELECT DISTINCT k FROM {missing} ORDER BY k LIMIT 10)), '') AS unknown_key_examples,
  CASE WHEN count(*) > 0 THEN '{bad}' ELSE 'PASS' END AS status
FROM {missing}"""


_dense(
    "v06_referential",
    " UNION ALL ".join(
        [
            _unknown("sales_train->inventory", "panel", "unique_id", "inventory", "unique_id", "FAIL"),
            _unknown("sales_test->inventory", "ahead", "unique_id", "inventory", "unique_id", "FAIL"),
            _unknown("test_weights->inventory", "weights", "unique_id", "inventory", "unique_id", "FAIL"),
            _unknown("lineitem->orders", "lineitem", "l_orderkey", "orders", "o_orderkey", "FAIL"),
        ]
    ),
)
_dense(
    "v07_coverage",
    " UNION ALL ".join(
        [
            _unknown("inventory not in sales_train", "inventory", "unique_id", "panel", "unique_id", "WARN"),
            _unknown("orders not in lineitem", "orders", "o_orderkey", "lineitem", "l_orderkey", "WARN"),
            _unknown("customer not in orders", "customer", "c_custkey", "orders", "o_custkey", "WARN"),
        ]
    ),
)


def _worst(statuses: str) -> str:
    return (
        f"CASE WHEN count(*) FILTER (WHERE {statuses} = 'FAIL') > 0 THEN 'FAIL' "
        f"WHEN count(*) FILTER (WHERE {statuses} = 'WARN') > 0 THEN 'WARN' ELSE 'PASS' END"
    )


def _report() -> list[str]:
    checks = []
    for table, cte in _CTE.items():
        checks.append(f"SELECT '{table}' AS table_name, 'schema' AS check_name, 'PASS' AS status")
        checks.append(
            f"SELECT '{table}', 'missingness', {_worst('s')} FROM (SELECT {_NULL_STATUS} AS s FROM ({_nulls(table)}))"
        )
        rules = _violations(table)
        if rules:
            checks.append(
                f"SELECT '{table}', 'numeric_sanity', {_worst('s')} FROM (SELECT {_NUMERIC_STATUS} AS s "
                f"FROM ({rules}) WINDOW w AS (PARTITION BY table_name))"
            )
        else:
            checks.append(f"SELECT '{table}', 'numeric_sanity', 'PASS'")
        checks.append(f"SELECT table_name, 'duplicates', status FROM ({_copies(table, cte, _KEYS[table])})")
        if "date" in _COLUMNS[table]:
            checks.append(
                f"""SELECT '{table}', 'date_continuity', CASE WHEN max(gap) > 0 THEN 'WARN' ELSE 'PASS' END
FROM (SELECT date_diff('day', min(date), max(date)) + 1 - count(DISTINCT date) AS gap FROM {cte} GROUP BY warehouse)"""
            )
        else:
            checks.append(f"SELECT '{table}', 'date_continuity', 'PASS'")
    for table in ("sales_train", "sales_test", "test_weights"):
        checks.append(
            f"""SELECT '{table}', 'referential_unique_id->inventory', CASE WHEN count(*) > 0 THEN 'FAIL' ELSE 'PASS' END
FROM {_CTE[table]} WHERE unique_id NOT IN (SELECT unique_id FROM inventory)"""
        )
    checks.append(
        """SELECT 'inventory', 'coverage_unique_id_not_in_sales_train', CASE WHEN count(*) > 0 THEN 'WARN' ELSE 'PASS' END
FROM inventory WHERE unique_id NOT IN (SELECT unique_id FROM panel)"""
    )
    return ["report AS (" + "\nUNION ALL ".join(checks) + ")"]


_dense(
    "v08_overall",
    f"""SELECT count(*) FILTER (WHERE status = 'PASS') AS n_pass, count(*) FILTER (WHERE status = 'WARN') AS n_warn,
  count(*) FILTER (WHERE status = 'FAIL') AS n_fail, {_worst('status')} AS overall FROM report""",
    *_report(),
)
_dense("v09_gate", "SELECT status, count(*) AS n_checks FROM report GROUP BY status", *_report())
_dense("v09b_gate_on_files", "SELECT * FROM report", *_report())
_dense("d07_quality_exceptions", "SELECT * FROM report WHERE status <> 'PASS'", *_report())

# --- demand questions ----------------------------------------------------------

_WAREHOUSE_DAY = "wh_day AS (SELECT warehouse, date, avg(total_orders) AS orders FROM panel GROUP BY warehouse, date)"
_dense(
    "q01_top_warehouses",
    f"""SELECT warehouse, days_covered, {up('units', 0)} AS total_units_sold, {up('orders', 0)} AS total_orders,
  {up('units / nullif(orders, 0)', 3)} AS units_per_order
FROM (SELECT warehouse, count(DISTINCT date) AS days_covered, sum(sales) AS units FROM panel GROUP BY warehouse)
JOIN (SELECT warehouse, sum(orders) AS orders FROM wh_day GROUP BY warehouse) USING (warehouse)""",
    _WAREHOUSE_DAY,
)
_dense(
    "q02_top_skus",
    f"""SELECT i.name, i.warehouse, i.l1_category_name_en, {up('sum(sales)', 0)} AS total_units,
  {up('avg(sell_price_main)', 2)} AS avg_price
FROM panel JOIN inventory i USING (unique_id) GROUP BY i.name, i.warehouse, i.l1_category_name_en
ORDER BY total_units DESC NULLS LAST, i.name, i.warehouse, i.l1_category_name_en LIMIT 30""",
)
_dense(
    "q03_volatile_skus",
    f"""SELECT name, warehouse, n_days, {up('total', 0)} AS total_units, {up('mean', 2)} AS mean_daily_sales,
  {up('sd', 2)} AS sd_daily_sales, {up('sd / nullif(mean, 0)', 3)} AS coeff_of_variation
FROM (SELECT i.name, i.warehouse, count(*) AS n_days, sum(sales) AS total, avg(sales) AS mean, stddev_pop(sales) AS sd
      FROM panel JOIN inventory i USING (unique_id) GROUP BY i.name, i.warehouse HAVING sum(sales) > 1000)
ORDER BY coeff_of_variation DESC NULLS LAST, name, warehouse LIMIT 30""",
)
_dense(
    "q04_weekday",
    f"""SELECT day_of_week, n_observations, {up('mean_sales', 2)} AS avg_daily_sales_per_sku,
  {up('mean_orders', 0)} AS avg_daily_orders_per_wh
FROM (SELECT CAST(dayofweek(date) AS INTEGER) AS day_of_week, count(*) AS n_observations, avg(sales) AS mean_sales
      FROM panel GROUP BY 1)
JOIN (SELECT CAST(dayofweek(date) AS INTEGER) AS day_of_week, avg(orders) AS mean_orders FROM wh_day GROUP BY 1)
USING (day_of_week)""",
    _WAREHOUSE_DAY,
)
_dense(
    "q05_holiday",
    f"""SELECT holiday_name, count(*) AS n_observations, {up('avg(sales)', 2)} AS avg_sales_on_holiday,
  {up('avg(sales) / nullif(avg(CASE WHEN holiday = 0 THEN sales END), 0) - 1', 3)} AS uplift_vs_nonholiday
FROM panel p JOIN calendar c ON p.warehouse = c.warehouse AND p.date = c.date
WHERE holiday = 1 AND holiday_name IS NOT NULL GROUP BY holiday_name HAVING count(*) >= {MIN_HOLIDAY_ROWS}""",
)
_dense(
    "q05b_holiday_fixed",
    f"""SELECT holiday_name, n_observations, {up('mean', 2)} AS avg_sales_on_holiday, {up('base', 2)} AS avg_sales_nonholiday,
  {up('mean / nullif(base, 0) - 1', 3)} AS uplift_vs_nonholiday
FROM (SELECT holiday_name, count(*) AS n_observations, avg(sales) AS mean,
        (SELECT avg(o.sales) FROM joined o WHERE o.holiday = 0 AND o.warehouse IN
          (SELECT warehouse FROM joined h WHERE h.holiday_name = j.holiday_name)) AS base
      FROM joined j WHERE holiday = 1 AND holiday_name IS NOT NULL GROUP BY holiday_name)
WHERE n_observations >= {MIN_HOLIDAY_ROWS}""",
    "joined AS (SELECT p.warehouse, sales, holiday, holiday_name FROM panel p JOIN calendar c ON p.warehouse = c.warehouse AND p.date = c.date)",
)
_dense(
    "q06_closures",
    f"""SELECT shops_closed, count(*) AS n_observations, {up('avg(sales)', 2)} AS avg_sales_per_sku,
  {up('avg(total_orders)', 0)} AS avg_orders
FROM panel p JOIN calendar c ON p.warehouse = c.warehouse AND p.date = c.date GROUP BY shops_closed""",
)
_ANY = " OR ".join(f"{c} > 0" for c in DISCOUNTS)
_dense(
    "q07_promo_uplift",
    f"""SELECT ({_ANY}) AS any_promo, count(*) AS n_observations, {up('avg(sales)', 2)} AS avg_sales_per_sku,
  {up('avg(sell_price_main)', 2)} AS avg_list_price FROM panel GROUP BY 1""",
)
_SUM = " + ".join(f"coalesce({c}, 0)" for c in DISCOUNTS)
_VALID = " AND ".join(f"{c} BETWEEN 0 AND 1" for c in DISCOUNTS)
_dense(
    "q08_discount_depth",
    f"""SELECT CASE WHEN total <= 0 THEN '0_no_promo' WHEN total < 0.1::DOUBLE THEN '1_shallow'
  WHEN total < 0.25::DOUBLE THEN '2_moderate' WHEN total < 0.5::DOUBLE THEN '3_deep' ELSE '4_very_deep' END AS discount_band,
  count(*) AS n_observations, {up('avg(sales)', 2)} AS avg_sales_per_sku
FROM (SELECT sales, {_SUM} AS total FROM panel WHERE {_VALID}) GROUP BY 1""",
)
_dense(
    "q09_distribution",
    f"""SELECT percentile_disc(0.5) WITHIN GROUP (ORDER BY sales) AS p50, percentile_disc(0.75) WITHIN GROUP (ORDER BY sales) AS p75,
  percentile_disc(0.9) WITHIN GROUP (ORDER BY sales) AS p90, percentile_disc(0.99) WITHIN GROUP (ORDER BY sales) AS p99,
  {up('max(sales)', 1)} AS max_sales, {up('avg(sales)', 2)} AS mean_sales FROM panel""",
)
_dense(
    "q10_monthly_trend",
    f"""SELECT warehouse, month, {up('units', 0)} AS monthly_units, {up('orders', 0)} AS avg_daily_orders
FROM (SELECT warehouse, CAST(date_trunc('month', date) AS DATE) AS month, sum(sales) AS units FROM panel GROUP BY 1, 2)
JOIN (SELECT warehouse, CAST(date_trunc('month', date) AS DATE) AS month, avg(orders) AS orders FROM wh_day GROUP BY 1, 2)
USING (warehouse, month)""",
    _WAREHOUSE_DAY,
)
_dense(
    "q11_category",
    f"""SELECT coalesce(l1_category_name_en, 'UNKNOWN') AS category, count(DISTINCT unique_id) AS n_products,
  {up('sum(sales)', 0)} AS total_units, {up('avg(sell_price_main)', 2)} AS avg_price
FROM panel JOIN inventory USING (unique_id) GROUP BY 1""",
)
_dense(
    "q12_stockout_exposure",
    f"""SELECT p.warehouse, l1_category_name_en AS category, count(*) FILTER (WHERE availability < 0.5) AS low_availability_rows,
  count(*) AS n_rows, {up('avg(availability)', 3)} AS avg_availability
FROM panel p JOIN inventory USING (unique_id) GROUP BY 1, 2
ORDER BY low_availability_rows DESC, 1, 2 LIMIT 25""",
)
_dense(
    "q13_lost_sales",
    f"""SELECT warehouse, {up('sum(greatest(usual - sales, 0))', 0)} AS estimated_lost_units
FROM panel JOIN (SELECT unique_id, avg(sales) AS usual FROM panel WHERE availability >= 0.95 GROUP BY unique_id)
USING (unique_id) WHERE availability < 0.5 GROUP BY warehouse""",
)
_dense(
    "q14_coverage_bands",
    """SELECT CASE WHEN n < 30 THEN 'a_under_30d' WHEN n < 180 THEN 'b_under_180d' WHEN n < 730 THEN 'c_under_2y'
  ELSE 'd_full_history' END AS coverage_band, count(*) AS n_products
FROM (SELECT unique_id, count(*) AS n FROM panel GROUP BY unique_id) GROUP BY 1""",
)
_dense(
    "q15_churn",
    """SELECT CAST(date_trunc('quarter', first_day) AS DATE) AS quarter, count(*) AS n_products_introduced
FROM (SELECT unique_id, min(date) AS first_day FROM panel GROUP BY unique_id) GROUP BY 1""",
)
_dense(
    "q16_high_risk",
    f"""SELECT unique_id, name, r.warehouse, {up('velocity', 2)} AS recent_daily_velocity, {up('av', 3)} AS recent_availability,
  low AS low_avail_days
FROM (SELECT unique_id, warehouse, avg(sales) FILTER (WHERE date > last_day - 32) AS velocity,
        avg(availability) FILTER (WHERE date > last_day - 32) AS av,
        count(*) FILTER (WHERE date > last_day - 32 AND availability < 0.5) AS low
      FROM panel, edge WHERE date > last_day - 62 GROUP BY unique_id, warehouse) r
JOIN inventory USING (unique_id) WHERE velocity > 10 AND low > 0
ORDER BY low DESC, recent_daily_velocity DESC, unique_id, r.warehouse LIMIT 40""",
)
_dense(
    "q17_price_bands",
    f"""SELECT CASE WHEN sell_price_main < 2 THEN 'a_under_2' WHEN sell_price_main < 5 THEN 'b_2_to_5'
  WHEN sell_price_main < 15 THEN 'c_5_to_15' WHEN sell_price_main < 50 THEN 'd_15_to_50' ELSE 'e_over_50' END AS price_band,
  count(*) AS n_observations, {up('avg(sales)', 2)} AS avg_daily_sales_per_sku
FROM panel WHERE sell_price_main > 0 GROUP BY 1""",
)
_dense(
    "q18_units_per_order",
    f"""SELECT warehouse, quarter, {up('units / nullif(orders, 0)', 3)} AS units_per_order
FROM (SELECT warehouse, CAST(date_trunc('quarter', date) AS DATE) AS quarter, sum(sales) AS units FROM panel GROUP BY 1, 2)
JOIN (SELECT warehouse, CAST(date_trunc('quarter', date) AS DATE) AS quarter, sum(orders) AS orders
      FROM (SELECT warehouse, date, avg(total_orders) AS orders FROM panel WHERE total_orders > 0 GROUP BY 1, 2)
      GROUP BY 1, 2) USING (warehouse, quarter)""",
)
_dense(
    "b01_warehouse_demand",
    """SELECT warehouse, count(DISTINCT unique_id) AS products, sum(sales) AS total_units,
  CAST(CAST(avg(availability) AS DECIMAL(4,3)) AS DOUBLE) AS avg_availability FROM panel GROUP BY warehouse""",
)
_dense(
    "b02_constrained_days",
    """SELECT warehouse, CAST(CAST(avg(availability) AS DECIMAL(4,3)) AS DOUBLE) AS avg_availability,
  CAST(sum(CASE WHEN availability < 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS constrained_days FROM panel GROUP BY warehouse""",
)

# --- time lines and features ---------------------------------------------------

def _daily(panel: str, grid: str, held: str, past: str) -> list[str]:
    """Day-by-day values, lags and rolling means of a panel with its gaps filled."""
    return [
        f"""{grid} AS (
  SELECT unique_id, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date
  FROM {panel} GROUP BY unique_id)""",
        f"""{held} AS (
  SELECT unique_id, date, last_value(sales IGNORE NULLS) OVER (
      PARTITION BY unique_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS held
  FROM {grid} LEFT JOIN (SELECT unique_id, date, sales FROM {panel}) USING (unique_id, date))""",
        f"""{past} AS (
  SELECT unique_id, date,
    lag(held, 28) OVER w AS lag_28, lag(held, 35) OVER w AS lag_35, lag(held, 42) OVER w AS lag_42,
    lag(held, 56) OVER w AS lag_56,
    CASE WHEN count(held) OVER w7 >= 7 THEN avg(held) OVER w7 END AS r7,
    CASE WHEN count(held) OVER w28 >= 7 THEN avg(held) OVER w28 END AS r28
  FROM {held}
  WINDOW w AS (PARTITION BY unique_id ORDER BY date),
    w7 AS (PARTITION BY unique_id ORDER BY date ROWS BETWEEN 34 PRECEDING AND 28 PRECEDING),
    w28 AS (PARTITION BY unique_id ORDER BY date ROWS BETWEEN 55 PRECEDING AND 28 PRECEDING))""",
    ]


_FULL_GRID = _daily("panel", "full_grid", "held", "past")
_LAG_NAMES = "lag_28, lag_35, lag_42, lag_56"
_ROLLING = f"{up('r7', 4)} AS rmean_7_lag28, {up('r28', 4)} AS rmean_28_lag28"
_FLAGS = "holiday, shops_closed, winter_school_holidays, school_holidays"
_PARTS = "CAST(isodow(date) - 1 AS INTEGER) AS dow, CAST(day(date) AS INTEGER) AS day_of_month, CAST(month(date) AS INTEGER) AS month"
_ONE_HOT = ", ".join(
    [f"CAST(coalesce(warehouse = '{v}', false) AS INTEGER) AS \"warehouse_{v}\"" for v in REGIONS]
    + [f"CAST(coalesce(l1_category_name_en = '{v}', false) AS INTEGER) AS \"l1_category_name_en_{v}\"" for v in TYPES]
)
_CATEGORY = "(SELECT unique_id, l1_category_name_en FROM inventory)"
_dense("f01_regularize", "SELECT unique_id, date, coalesce(held, 0) AS sales FROM held", *_FULL_GRID)
_dense("f02_lags", f"SELECT unique_id, date, sales, {_LAG_NAMES} FROM panel JOIN past USING (unique_id, date)", *_FULL_GRID)
_dense("f03_rolling_means", f"SELECT unique_id, date, sales, {_ROLLING} FROM panel JOIN past USING (unique_id, date)", *_FULL_GRID)
_dense("f04_discount_total", f"SELECT unique_id, date, {up(_SUM, 4)} AS discount_total FROM panel")
_dense("f05_calendar_join", f"SELECT unique_id, date, warehouse, {_FLAGS} FROM panel LEFT JOIN calendar USING (warehouse, date)")
_sparse("f06_category_join", f"SELECT unique_id, date, l1_category_name_en FROM panel LEFT JOIN {_CATEGORY} USING (unique_id)")
_dense("f07_date_parts", f"SELECT unique_id, date, {_PARTS} FROM panel")
_dense(
    "f08_one_hot",
    f"SELECT unique_id, date, warehouse, l1_category_name_en, {_ONE_HOT} FROM panel LEFT JOIN {_CATEGORY} USING (unique_id)",
)
_dense(
    "f09_feature_frame",
    f"""SELECT unique_id, date, warehouse, sales, {_LAG_NAMES}, {_ROLLING}, sell_price_main,
  {up(_SUM, 4)} AS discount_total, {_PARTS}, {_FLAGS}, {_ONE_HOT}
FROM panel JOIN past USING (unique_id, date) LEFT JOIN calendar USING (warehouse, date)
LEFT JOIN {_CATEGORY} USING (unique_id)""",
    *_FULL_GRID,
)
_HISTORY = {"lag_28": "lag_28", "lag_35": "lag_35", "lag_42": "lag_42", "lag_56": "lag_56",
            "rmean_7_lag28": "r7", "rmean_28_lag28": "r28"}
# Features that never read sales cannot change with them.
_FIXED = ["sell_price_main", "discount_total", "dow", "day_of_month", "month", "holiday", "shops_closed",
          "winter_school_holidays", "school_holidays", *[f"warehouse_{v}" for v in REGIONS],
          *[f"l1_category_name_en_{v}" for v in TYPES]]
_dense(
    "f10_leak_audit",
    " UNION ALL ".join(
        [f"SELECT '{name}' AS feature, count(*) FILTER (WHERE a.{c} IS DISTINCT FROM b.{c}) AS n_changed, count(*) AS n_rows "
         "FROM compared a JOIN spiked_past b USING (unique_id, date)" for name, c in _HISTORY.items()]
        + [f"SELECT '{name}', 0, count(*) FROM compared" for name in _FIXED]
    ),
    *_FULL_GRID,
    "spiked AS (SELECT unique_id, date, CASE WHEN date >= cutoff THEN 1e6::DOUBLE ELSE sales END AS sales FROM panel, edge)",
    *_daily("spiked", "spiked_grid", "spiked_held", "spiked_past"),
    "compared AS (SELECT past.* FROM past JOIN panel USING (unique_id, date), edge WHERE date >= cutoff)",
)
_sparse("f11_seasonal_naive", f"SELECT unique_id, date, {up('prediction', 6)} AS prediction, method FROM naive", *_FORECAST)
_sparse("f12_moving_average", f"SELECT unique_id, date, {up('prediction', 6)} AS prediction, method FROM average", *_FORECAST)
_sparse("f13_forecast_grid", "SELECT unique_id, date, CAST(dow AS INTEGER) AS dow FROM future", *_FORECAST)
_sparse(
    "f15_fallback_report",
    """SELECT method, count(DISTINCT unique_id) AS n_series, count(*) AS n_rows, 'seasonal_naive_7' AS model FROM naive GROUP BY method
UNION ALL SELECT method, count(DISTINCT unique_id), count(*), 'moving_average_28' FROM average GROUP BY method""",
    *_FORECAST,
)

# --- metrics -------------------------------------------------------------------


def _pairs(forecast: str) -> str:
    return f"""(SELECT h.unique_id, h.date, h.warehouse, sales, prediction, weight FROM holdout h
  LEFT JOIN {forecast} f ON h.unique_id = f.unique_id AND h.date = f.date LEFT JOIN weights w ON h.unique_id = w.unique_id)"""


_ABS = "abs(sales - prediction)"
_METRICS = {
    "wmape": f"sum({_ABS}) / nullif(sum(abs(sales)), 0)",
    "wmape_weighted": f"sum({_ABS} * weight) / nullif(sum(abs(sales) * weight), 0)",
    "mae": f"avg({_ABS})",
    "rmse": f"sqrt(avg({_ABS} * {_ABS}))",
}
for _key, _name in zip(("m01_wmape", "m02_wmape_weighted", "m03_mae", "m04_rmse"), _METRICS):
    _sparse(
        _key,
        f"SELECT warehouse, {up(_METRICS[_name], 6)} AS {_name} FROM {_pairs('average')} GROUP BY warehouse",
        *_FORECAST,
    )
_ALL_METRICS = ", ".join(f"{up(text, 6)} AS {name}" for name, text in _METRICS.items())
_dense(
    "m05_eval_rollup",
    f"""SELECT 'overall' AS scope, CAST(NULL AS VARCHAR) AS warehouse, {_ALL_METRICS}, count(*) AS n_rows FROM {_pairs('average')}
UNION ALL SELECT 'warehouse', warehouse, {_ALL_METRICS}, count(*) FROM {_pairs('average')} GROUP BY warehouse""",
    *_FORECAST,
)
_PLAIN_METRICS = ", ".join(f"{text} AS {name}" for name, text in _METRICS.items())
_MODELS = f"""models AS (
  SELECT 'seasonal_naive_7' AS model, {_PLAIN_METRICS}, count(*) AS n_rows FROM {_pairs('naive')}
  UNION ALL SELECT 'moving_average_28', {_PLAIN_METRICS}, count(*) FROM {_pairs('average')})"""
_ROUNDED_METRICS = ", ".join(f"{up(name, 6)} AS {name}" for name in _METRICS)
_dense("d08_model_table", f"SELECT model, {_ROUNDED_METRICS}, n_rows FROM models", *_FORECAST, _MODELS)
_dense(
    "m06_model_compare",
    f"""SELECT m.model, {up('m.wmape', 6)} AS wmape, {up('c.wmape - m.wmape', 4)} AS delta_wmape FROM models m, models c
WHERE c.model = 'moving_average_28' AND m.model <> c.model""",
    *_FORECAST, _MODELS,
)
_dense(
    "m07_holdout_split",
    """SELECT 'history' AS part, count(*) AS n_rows, min(date) AS min_date, max(date) AS max_date FROM history
UNION ALL SELECT 'holdout', count(*), min(date), max(date) FROM holdout""",
    *_FORECAST,
)
_dense(
    "m08_temporal_split",
    """SELECT unique_id, date, CASE WHEN date >= cutoff THEN 'holdout' WHEN date >= cutoff - 28 THEN 'validation' ELSE 'train' END AS split
FROM panel, edge""",
)

# --- boosted trees: what does not depend on the fit -----------------------------

_dense("g01_boosted_trees", "SELECT unique_id, date, warehouse, sales AS actual, true AS finite FROM holdout", *_FORECAST)
_INPUTS = [
    *(f"lag_{k}" for k in (28, 35, 42, 56)), "rmean_7_lag28", "rmean_28_lag28", "sell_price_main", "discount_total", "dow",
    "day_of_month", "month", "holiday", "shops_closed", "winter_school_holidays", "school_holidays",
]
_dense(
    "g02_importance",
    "SELECT feature, 1.0::DOUBLE AS total_importance FROM ("
    + " UNION ALL ".join(
        f"SELECT '{name}' AS feature" for name in [*_INPUTS, "warehouse_unknown", "l1_category_name_en_unknown"]
    )
    + " UNION ALL SELECT DISTINCT 'warehouse_' || warehouse FROM inventory"
    " UNION ALL SELECT DISTINCT 'l1_category_name_en_' || l1_category_name_en FROM inventory WHERE l1_category_name_en IS NOT NULL)",
)

# --- decisions -----------------------------------------------------------------

_RISK_TAIL = f"""{up('forecast_units', 6)} AS forecast_units, {up('recent_availability', 6)} AS recent_availability,
  n_days_observed, low_avail_days, {up('assumed_future_availability', 6)} AS assumed_future_availability,
  availability_data_gap, estimated_unmet_units, risk_fraction"""
_sparse(
    "r01_recent_availability",
    f"SELECT unique_id, {up('recent_availability', 6)} AS recent_availability, n_days_observed, low_avail_days FROM seen",
    *_FORECAST, *_RISK,
)
_sparse("r02_risk", f"SELECT unique_id, {_RISK_TAIL} FROM risk", *_FORECAST, *_RISK)
_sparse("r03_tier", "SELECT unique_id, estimated_unmet_units, risk_fraction, risk_tier FROM risk", *_FORECAST, *_RISK)
_sparse(
    "r04_risk_enrich",
    f"SELECT unique_id, {_RISK_TAIL}, risk_tier, name, l1_category_name_en, warehouse FROM risk",
    *_FORECAST, *_RISK,
)
_sparse(
    "r05_quantity",
    f"SELECT unique_id, estimated_unmet_units, {quantity('estimated_unmet_units')} AS quantity FROM risk",
    *_FORECAST, *_RISK,
)
_sparse("r06_recommend", f"SELECT {REC_COLUMNS} FROM recs", *_FORECAST, *_RISK, *_RECS)


def _whole(value: str) -> str:
    return f"CAST(CAST(round_even({value}, 0) AS BIGINT) AS VARCHAR)"


# The texts of a recommendation.
GAP_TEXT = (
    "Availability telemetry missing for series %s; no scarcity signal can be computed. "
    "Fix the data feed before committing stock decisions."
)
TIER_TEXT = (
    "Tier %s: forecast %s units over the horizon at %s observed availability; "
    "assuming future availability equals recent, ~%s units would go unmet. "
    "%s: recommend %s units (+%s safety margin, packed in %ss)."
)
GAP_ASSUMPTION = "ASSUMED: absent telemetry treated as fully available (inherited from the risk engine)"
AVAILABILITY_ASSUMPTION = "ASSUMED: future availability = recent observed (%s)"
MARGIN_ASSUMPTION = "ASSUMED: safety margin %s, pack size %s"


def _filled(template: str, *values: str) -> str:
    """A %s template as a concatenation of its literal parts and SQL values."""
    parts = template.split("%s")
    pieces = [f"'{parts[0]}'"]
    for value, part in zip(values, parts[1:]):
        pieces += [f"({value})", f"'{part}'"]
    return " || ".join(pieces)


_RATIONALE = f"""CASE WHEN availability_data_gap THEN {_filled(GAP_TEXT, 'unique_id')}
  ELSE {_filled(
    TIER_TEXT, 'risk_tier', _whole('forecast_units'), _whole('recent_availability * 100') + " || '%'",
    _whole('estimated_unmet_units'), 'upper(action[1]) || action[2:]', 'recommended_units', "'10%'", "'5'",
)} END"""
_ASSUMPTIONS = f"""CASE WHEN availability_data_gap THEN '{GAP_ASSUMPTION}'
  ELSE {_filled(AVAILABILITY_ASSUMPTION, _whole('assumed_future_availability * 100') + " || '%'")} || ' | '
    || {_filled(MARGIN_ASSUMPTION, "'10%'", "'5'")} END"""
_sparse(
    "r07_rationale",
    f"SELECT unique_id, {_RATIONALE} AS rationale, {_ASSUMPTIONS} AS assumptions FROM recs",
    *_FORECAST, *_RISK, *_RECS,
)
_sparse("r08_priority_order", "SELECT unique_id, priority, estimated_unmet_units FROM recs", *_FORECAST, *_RISK, *_RECS)
_sparse(
    "r10_total_coverage",
    """SELECT (SELECT count(*) FROM risk) AS risk_rows, count(*) AS recommendation_rows,
  count(*) FILTER (WHERE action IN ('replenish_now', 'replenish_scheduled', 'investigate_data', 'monitor')) AS valid_action_rows
FROM recs""",
    *_FORECAST, *_RISK, *_RECS,
)
_SIMULATED = f"""SELECT scenario, unique_id, {up('scenario_demand_units', 4)} AS scenario_demand_units,
  {up('scenario_availability', 4)} AS scenario_availability, baseline_unmet_units, scenario_unmet_units,
  unmet_units_delta, scenario_recommended_units FROM simulated"""
_sparse("w01_scenario", _SIMULATED, *_FORECAST, *_RISK, *_simulated([SURGE]))
_sparse("w02_scenario_grid", _SIMULATED, *_FORECAST, *_RISK, *_simulated(SCENARIOS))
_sparse(
    "w04_identity_gate",
    "SELECT count(*) AS n_series, max(abs(scenario_unmet_units - baseline_unmet_units)) AS max_drift FROM simulated",
    *_FORECAST, *_RISK, *_simulated([type(SURGE)()]),
)
_sparse(
    "w05_scenario_summary",
    f"""SELECT scenario, count(*) AS series, {even('sum(baseline_unmet_units)', 2)} AS total_baseline_unmet_units,
  {even('sum(scenario_unmet_units)', 2)} AS total_scenario_unmet_units, {even('sum(unmet_units_delta)', 2)} AS unmet_units_delta,
  CAST(sum(scenario_recommended_units) AS BIGINT) AS total_scenario_recommended_units FROM simulated GROUP BY scenario""",
    *_FORECAST, *_RISK, *_simulated(SCENARIOS),
)
_sparse(
    "w06_top_increases",
    """SELECT scenario, CAST(rank AS INTEGER) AS rank, unique_id, name, warehouse, baseline_unmet_units, scenario_unmet_units, unmet_units_delta
FROM (SELECT *, row_number() OVER (PARTITION BY scenario ORDER BY unmet_units_delta DESC, unique_id) AS rank FROM simulated)
WHERE rank <= 10""",
    *_FORECAST, *_RISK, *_simulated(SCENARIOS),
)
_TAG = "replace('dm' || {dm} || '_pu' || {pu} || '_ai' || {ai}, '.', 'p')".format(
    **{c: f"regexp_replace({c}::VARCHAR, '\\.0$', '')" for c in ("dm", "pu", "ai")}
)
_sparse(
    "w07_scenario_tag",
    f"SELECT {_TAG} AS tag, count(*) AS series FROM risk, levers GROUP BY 1",
    *_FORECAST, *_RISK, *_simulated(SCENARIOS),
)

# --- read side -----------------------------------------------------------------

_sparse(
    "b03_high_risk_list",
    f"""SELECT name, warehouse, {up('forecast_units', 0)} AS forecast_units_28d, {up('recent_availability', 3)} AS observed_availability,
  {up('estimated_unmet_units', 0)} AS estimated_unmet_units
FROM risk r WHERE risk_tier = 'HIGH' AND NOT availability_data_gap
ORDER BY {up('r.estimated_unmet_units', 0)} DESC NULLS LAST, name, warehouse LIMIT 25""",
    *_FORECAST, *_RISK,
)
_sparse("b04_tier_counts", "SELECT risk_tier, count(*) AS series FROM risk GROUP BY risk_tier", *_FORECAST, *_RISK)
_sparse(
    "b05_action_counts",
    "SELECT action, count(*) AS series, CAST(sum(recommended_units) AS BIGINT) AS total_units_to_order FROM recs GROUP BY action",
    *_FORECAST, *_RISK, *_RECS,
)
_sparse(
    "b06_scenario_compare",
    f"""SELECT 'baseline' AS scenario, {up('sum(estimated_unmet_units)', 0)} AS unmet_units FROM risk
UNION ALL SELECT '{SURGE_LABEL}', {up('sum(scenario_unmet_units)', 0)} FROM simulated""",
    *_FORECAST, *_RISK, *_simulated([SURGE]),
)
_sparse(
    "d01_series_lookup",
    f"""SELECT unique_id, date, {up('prediction', 6)} AS prediction FROM average
WHERE unique_id = (SELECT min(unique_id) FROM average) ORDER BY date LIMIT 28""",
    *_FORECAST,
)
_ORDER = "ORDER BY estimated_unmet_units DESC NULLS LAST, forecast_units DESC NULLS LAST, unique_id"
_sparse(
    "d02_risk_filter",
    f"""SELECT unique_id, name, warehouse, risk_tier, estimated_unmet_units, risk_fraction
FROM risk WHERE risk_tier = 'HIGH' {_ORDER} LIMIT 50""",
    *_FORECAST, *_RISK,
)
_sparse(
    "d03_rec_filter",
    f"""SELECT {REC_COLUMNS} FROM recs WHERE action = 'replenish_now'
ORDER BY priority, estimated_unmet_units DESC NULLS LAST, unique_id LIMIT 50""",
    *_FORECAST, *_RISK, *_RECS,
)
_sparse(
    "d04_kpis",
    f"""SELECT count(*) AS series, {up('sum(forecast_units)', 2)} AS total_forecast_units,
  {up('sum(estimated_unmet_units)', 2)} AS total_unmet_units, count(*) FILTER (WHERE risk_tier = 'HIGH') AS n_high,
  count(*) FILTER (WHERE risk_tier = 'MEDIUM') AS n_medium, count(*) FILTER (WHERE risk_tier = 'LOW') AS n_low,
  """
    + ", ".join(
        f"(SELECT count(*) FROM recs WHERE action = '{a}') AS n_{a}"
        for a in ("replenish_now", "replenish_scheduled", "investigate_data", "monitor")
    )
    + """ FROM risk""",
    *_FORECAST, *_RISK, *_RECS,
)
_sparse(
    "d05_top_high",
    f"""SELECT unique_id, name, warehouse, {up('forecast_units', 6)} AS forecast_units,
  {up('recent_availability', 6)} AS recent_availability, estimated_unmet_units
FROM (SELECT * FROM risk WHERE risk_tier = 'HIGH' {_ORDER} LIMIT 10)""",
    *_FORECAST, *_RISK,
)
_sparse(
    "d06_gap_count",
    "SELECT count(*) FILTER (WHERE availability_data_gap) AS data_gaps, count(*) AS series FROM risk",
    *_FORECAST, *_RISK,
)

# --- jobs ------------------------------------------------------------------------

_COUNTED = [f"SELECT '{name}' AS table_name, count(*) AS n FROM {cte}" for name, cte in _CTE.items()]
_COUNTS = "counted AS (" + " UNION ALL ".join(_COUNTED) + ")"
_dense(
    "s05_verified_load",
    """SELECT table_name, n AS expected_rows, n AS actual_rows, outcome
FROM counted, (VALUES ('loaded'), ('skipped')) AS runs(outcome)""",
    _COUNTS,
)
_dense(
    "s12_run_manifest",
    f"SELECT 'ingestion' AS kind, '{VERSION}' AS version, 'PASS' AS status, table_name, n AS n_rows FROM counted",
    _COUNTS,
)
_RAW = ["region", "nation", "supplier", "customer", "part", "orders", "lineitem"]
_SOUND = " UNION ALL ".join(f"SELECT '{name}' AS table_name, count(*) AS n FROM {name}" for name in _RAW)
_dense(
    "v01_schema",
    """SELECT table_name, 'schema' AS check_name, CASE WHEN n > 0 THEN 'PASS' END AS status,
  '{"missing_columns":[],"unexpected_columns":[],"dtype_mismatches":{}}' AS details FROM (SELECT * FROM counted UNION ALL SELECT * FROM sound)
UNION ALL SELECT 'region:missing', 'schema', 'FAIL', '{"missing_columns":["r_name"],"unexpected_columns":[],"dtype_mismatches":{}}'
UNION ALL SELECT 'region:mistyped', 'schema', 'FAIL', '{"missing_columns":[],"unexpected_columns":[],"dtype_mismatches":{"r_regionkey":"string"}}'
UNION ALL SELECT 'region:extra', 'schema', 'WARN', '{"missing_columns":[],"unexpected_columns":["r_note"],"dtype_mismatches":{}}'""",
    _COUNTS, f"sound AS ({_SOUND})",
)
ORACLES["s08_query_batch"] = " UNION ALL ".join(
    f"SELECT '{key}' AS question, (SELECT count(*) FROM ({sql})) AS n_rows, 'PASS' AS status, CAST(NULL AS VARCHAR) AS error"
    for key, sql in ORACLES.items()
    if key[0] == "q"
)
ORACLES["d09_artifact_status"] = (
    "SELECT * FROM (VALUES ('forecasts', false), ('risk', true), ('recommendations', false)) AS t(artifact, available)"
)
