"""The registered queries: every operator over the tables of one data folder.

Questions, features and metrics use the dense panel, decisions the sparse one
(it has series without recent rows).  Floating results are rounded here, for
comparison; the operators themselves return what they compute.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import half_up
from ..operators import (
    baselines, boosting, demand, distribution, features, quality, readside, replenish, risk, scoring,
    timeline, whatif,
)
from ..session import settle, shared_folder
from ..sources import artifacts, load
from ..sources.panel import derive_panel
from ..sources.scan import scan_csv
from ..sources.tables import DISCOUNTS, ORDER_TABLES, TABLES
from . import batch
from .warehouse import Warehouse, open_warehouse

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# Parameters that fit the data at hand; the operators' defaults are larger.
MIN_HOLIDAY_ROWS = 50
SCENARIOS = [
    whatif.IDENTITY,
    whatif.Scenario(1.2, whatif.PROMO_UPLIFT, 0.1),
    whatif.Scenario(1.0, 0.0, 0.25),
    whatif.Scenario(0.8, 0.0, 0.0),
]
SURGE = SCENARIOS[1]
# Two runs and when they were made: the later one has the name that sorts first.
LATEST_RUNS = [
    (whatif.Scenario(1.2), datetime(2001, 11, 4, tzinfo=timezone.utc)),
    (whatif.Scenario(0.8), datetime(2001, 11, 5, tzinfo=timezone.utc)),
]
SURGE_LABEL = "demand +20%, promos +35.6%, availability +0.10"


def _register(key: str, grain: str = "dense"):
    def wrap(build: Callable[[Warehouse], DataFrame]):
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(open_warehouse(spark, sf_dir, grain))

        QUERIES[key] = query
        return build

    return wrap


def _rounded(df: DataFrame, places: int, *names: str) -> DataFrame:
    return df.withColumns({n: half_up(F.col(n), places) for n in names})


def _folder(w: Warehouse, label: str) -> str:
    """A fresh folder for one run of a job."""
    stamp = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    return f"{shared_folder(w.spark)}/{label}-{stamp}"


# --- sources -----------------------------------------------------------------


@_register("s00_panel")
def _(w):
    """The panel itself, straight from the order lines."""
    return derive_panel(w.spark, w.sf_dir, "dense")


@_register("s01_typed_scan")
def _(w):
    path = _folder(w, "csv")
    w.panel.write.option("header", True).csv(path)
    return scan_csv(w.spark, "sales_train", path)


@_register("s03_source_profile")
def _(w):
    profiles = None
    for name, table in w.tables().items():
        profile = load.source_profile(table, name)
        profiles = profile if profiles is None else profiles.unionByName(profile)
    return profiles


@_register("s04_dim_seed")
def _(w):
    """Three runs over a stored dimension: of some sources, of all, and of all once more."""
    path = _folder(w, "dimension")
    some = [w.inventory.filter(F.col("unique_id") % 100 == 1)]
    every = [w.panel, w.sales_ahead, w.inventory, w.calendar]
    counts = [(run, load.seed_dimension(sources, path)) for run, sources in ((1, some), (2, every), (3, every))]
    inserted = w.spark.createDataFrame(counts, "run int, inserted long")
    stored = w.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n")).scalar()
    return inserted.withColumn("members", stored)


@_register("s05_verified_load")
def _(w):
    folder = _folder(w, "load")
    first = load.load_all(w.tables(), folder)
    again = load.load_all(w.tables(), folder)
    return load.status_frame(w.spark, first + again)


@_register("s06_orphan_rows")
def _(w):
    checks = {
        "lineitem->part": (w.raw("lineitem").select(F.col("l_partkey").alias("p_partkey")), w.raw("part"), "p_partkey"),
        "sales_train->inventory": (w.panel, w.inventory, "unique_id"),
        "inventory->sales_train": (w.inventory, w.panel, "unique_id"),
    }
    result = None
    for name, (fact, dimension, key) in checks.items():
        row = load.orphan_rows(fact, dimension, key).select(F.lit(name).alias("reference"), "orphan_rows")
        result = row if result is None else result.unionByName(row)
    return result


@_register("s08_query_batch")
def _(w):
    questions = {key: (lambda q=query: q(w.spark, w.sf_dir)) for key, query in QUERIES.items() if key[0] == "q"}
    return batch.run_questions(w.spark, questions, _folder(w, "batch"))


@_register("s09_artifact_io", "sparse")
def _(w):
    path = _folder(w, "risk")
    rows = artifacts.write_artifact(w.risk, path)
    back = artifacts.read_artifact(w.spark, path, "risk")
    return back.groupBy("risk_tier").agg(
        F.count(F.lit(1)).alias("series"), F.lit(rows).cast("long").alias("rows_written")
    )


@_register("s10_curated_reload", "sparse")
def _(w):
    shouting = w.risk.withColumnsRenamed({"unique_id": "UNIQUE_ID", "risk_tier": "Risk_Tier"}).withColumn(
        "availability_data_gap", F.when(F.col("availability_data_gap"), True)
    )
    path = _folder(w, "curated")
    table = artifacts.reload_curated(shouting, "larder_curated_risk", path)
    return table.select("unique_id", "risk_tier", "availability_data_gap")


@_register("s11_latest_artifact", "sparse")
def _(w):
    """Of two stored simulation runs the one made later, not the one named later."""
    folder = _folder(w, "runs")
    for scenario, made in LATEST_RUNS:
        path = f"{folder}/{scenario.tag}"
        rows = artifacts.write_artifact(whatif.apply_scenarios(w.risk, [scenario]), path)
        row = artifacts.manifest_row(
            w.spark, "simulation", {"rows": rows}, {"simulation": path}, "PASS", generated_at=made
        )
        artifacts.append_manifest(row, f"{folder}/_manifest")
    newest = artifacts.latest_output(w.spark, f"{folder}/_manifest", "simulation")
    return newest.groupBy("scenario", F.col("generated_at").cast("date").alias("generated_at")).agg(
        F.count(F.lit(1)).alias("series"),
        F.sum("scenario_recommended_units").alias("total_scenario_recommended_units"),
    )


@_register("s12_run_manifest")
def _(w):
    folder = _folder(w, "manifest")
    inputs = {name: artifacts.write_artifact(table, f"{folder}/{name}") for name, table in w.tables().items()}
    outputs = {name: f"{folder}/{name}" for name in inputs}
    artifacts.append_manifest(
        artifacts.manifest_row(w.spark, "ingestion", inputs, outputs, "PASS"), f"{folder}/_manifest"
    )
    manifest = artifacts.read_artifact(w.spark, f"{folder}/_manifest", "ingestion")
    return manifest.select("kind", "version", "status", F.explode("inputs").alias("table_name", "n_rows"))


@_register("s13_summaries", "sparse")
def _(w):
    tiers = readside.tier_counts(w.risk).select(
        F.lit("tier").alias("summary"), F.col("risk_tier").alias("item"), "series", F.lit(None).cast("double").alias("units")
    )
    actions = readside.action_counts(w.recommendations).select(
        F.lit("action").alias("summary"), F.col("action").alias("item"), "series",
        F.col("total_units_to_order").cast("double").alias("units"),
    )
    runs = whatif.scenario_summary(whatif.apply_scenarios(w.risk, SCENARIOS)).select(
        F.lit("scenario").alias("summary"), F.col("scenario").alias("item"), "series",
        F.col("total_scenario_recommended_units").cast("double").alias("units"),
    )
    unmet = w.risk.agg(
        F.lit("unmet").alias("summary"), F.lit("all").alias("item"), F.count(F.lit(1)).alias("series"),
        half_up(F.sum("estimated_unmet_units"), 2).alias("units"),
    )
    ordered = w.recommendations.filter("recommended_units > 0").orderBy(
        F.desc("recommended_units"), "unique_id").limit(10)
    increased = whatif.top_increases(whatif.apply_scenarios(w.risk, [SURGE]))
    listed = None
    for label, rows, value in (
        ("top_unmet", readside.top_high(w.risk), "estimated_unmet_units"),
        ("top_ordered", ordered, "recommended_units"),
        ("top_increase", increased, "unmet_units_delta"),
    ):
        lines = rows.select(
            F.lit(label).alias("summary"), F.col("unique_id").cast("string").alias("item"),
            F.lit(1).cast("long").alias("series"), half_up(F.col(value).cast("double"), 2).alias("units"),
        )
        listed = lines if listed is None else listed.unionByName(lines)
    path = _folder(w, "summary")
    tiers.unionByName(actions).unionByName(runs).unionByName(unmet).unionByName(listed).write.json(path)
    return w.spark.read.schema("summary string, item string, series long, units double").json(path)


# --- quality -----------------------------------------------------------------


@_register("v01_schema")
def _(w):
    """Schemas as they are stored: the given files, the loaded tables, and three copies of region that drifted."""
    folder = _folder(w, "drift")
    region = w.raw("region")
    drifted = {
        "region:missing": region.drop("r_name"),
        "region:mistyped": region.withColumn("r_regionkey", F.col("r_regionkey").cast("string")),
        "region:extra": region.withColumn("r_note", F.lit("x")),
    }
    checks = []
    for name, copy in drifted.items():
        path = f"{folder}/{name.replace(':', '-')}"
        copy.write.parquet(path)
        checks.append(quality.schema_check(w.spark.read.parquet(path), ORDER_TABLES["region"], name))
    for name, spec in ORDER_TABLES.items():
        checks.append(quality.schema_check(w.spark.read.parquet(f"{w.sf_dir}/{name}.parquet"), spec))
    for name, spec in TABLES.items():
        path = f"{folder}/{name}"
        w.table(name).limit(1).write.parquet(path)
        checks.append(quality.schema_check(w.spark.read.parquet(path), spec))
    report = checks[0]
    for check in checks[1:]:
        report = report.unionByName(check)
    return report


@_register("v02_missingness")
def _(w):
    report = quality.missingness_evidence(w.panel, TABLES["sales_train"])
    for name in ("inventory", "calendar"):
        report = report.unionByName(quality.missingness_evidence(w.table(name), TABLES[name]))
    return report


@_register("v03_duplicates")
def _(w):
    keyed = {
        "lineitem": (w.raw("lineitem"), ["l_orderkey", "l_linenumber"]),
        "sales_train": (w.panel, ["unique_id", "date"]),
        "calendar": (w.calendar, ["warehouse", "date"]),
        "orders": (w.raw("orders"), ["o_orderkey"]),
    }
    report = None
    for name, (table, key) in keyed.items():
        row = quality.duplicate_evidence(table, key).select(
            F.lit(name).alias("table_name"), "duplicate_rows", "duplicate_key_groups",
            F.when(F.col("duplicate_rows") > 0, "FAIL").otherwise("PASS").alias("status"),
        )
        report = row if report is None else report.unionByName(row)
    return report


@_register("v04_date_continuity")
def _(w):
    return quality.date_continuity_evidence(w.panel, "warehouse")


@_register("v04b_missing_dates", "sparse")
def _(w):
    return quality.missing_dates(w.panel, "unique_id")


@_register("v05_numeric_sanity")
def _(w):
    return quality.numeric_evidence(w.panel, TABLES["sales_train"])


def _references(w: Warehouse, checks: dict[str, tuple[DataFrame, str, DataFrame, str]], bad: str) -> DataFrame:
    report = None
    for name, (df, key, known, known_key) in checks.items():
        row = quality.reference_evidence(df, key, known, known_key).select(
            F.lit(name).alias("reference"), "unknown_key_rows", "unknown_key_examples",
            F.when(F.col("unknown_key_rows") > 0, bad).otherwise("PASS").alias("status"),
        )
        report = row if report is None else report.unionByName(row)
    return report


@_register("v06_referential")
def _(w):
    checks = {
        "sales_train->inventory": (w.panel, "unique_id", w.inventory, "unique_id"),
        "sales_test->inventory": (w.sales_ahead, "unique_id", w.inventory, "unique_id"),
        "test_weights->inventory": (w.weights, "unique_id", w.inventory, "unique_id"),
        "lineitem->orders": (w.raw("lineitem"), "l_orderkey", w.raw("orders"), "o_orderkey"),
    }
    return _references(w, checks, "FAIL")


@_register("v07_coverage")
def _(w):
    checks = {
        "inventory not in sales_train": (w.inventory, "unique_id", w.panel, "unique_id"),
        "orders not in lineitem": (w.raw("orders"), "o_orderkey", w.raw("lineitem"), "l_orderkey"),
        "customer not in orders": (w.raw("customer"), "c_custkey", w.raw("orders"), "o_custkey"),
    }
    return _references(w, checks, "WARN")


@_register("v08_overall")
def _(w):
    return quality.overall(quality.full_report(w.tables(), TABLES))


@_register("v09_gate")
def _(w):
    report = batch.run_gate(w.spark, w.tables(), _folder(w, "gate"), strict=False)
    return report.groupBy("status").agg(F.count(F.lit(1)).alias("n_checks"))


@_register("v09b_gate_on_files")
def _(w):
    """The gate over files that arrive: all but the last year of sales, then that year, which alone is read then."""
    folder = _folder(w, "arriving")
    paths = {name: f"{folder}/{name}" for name in TABLES}
    for name in TABLES:
        if name != "sales_train":
            w.table(name).write.parquet(paths[name])
    last_year = F.year("date") == F.year(w.last_day)
    w.panel.where(~last_year | F.col("date").isNull()).write.parquet(paths["sales_train"])
    batch.run_gate_on_files(w.spark, paths, f"{folder}/gate", strict=False)
    w.panel.where(last_year).write.mode("append").parquet(paths["sales_train"])
    return batch.run_gate_on_files(w.spark, paths, f"{folder}/gate", strict=False).select("table_name", "check_name", "status")


# --- demand questions --------------------------------------------------------

for _key, _build in {
    "q01_top_warehouses": lambda w: demand.top_warehouses(w.panel),
    "q02_top_skus": lambda w: demand.top_skus(w.panel, w.inventory),
    "q03_volatile_skus": lambda w: demand.volatile_skus(w.panel, w.inventory),
    "q04_weekday": lambda w: demand.weekday_profile(w.panel),
    "q05_holiday": lambda w: demand.holiday_sales(w.panel, w.calendar, MIN_HOLIDAY_ROWS),
    "q05b_holiday_fixed": lambda w: demand.holiday_uplift(w.panel, w.calendar, MIN_HOLIDAY_ROWS),
    "q06_closures": lambda w: demand.closure_impact(w.panel, w.calendar),
    "q07_promo_uplift": lambda w: demand.promotion_effect(w.panel),
    "q08_discount_depth": lambda w: demand.discount_depth(w.panel),
    "q09_distribution": lambda w: distribution.demand_distribution(w.panel),
    "q10_monthly_trend": lambda w: demand.monthly_trend(w.panel),
    "q11_category": lambda w: demand.category_demand(w.panel, w.inventory),
    "q12_stockout_exposure": lambda w: demand.stockout_exposure(w.panel, w.inventory),
    "q13_lost_sales": lambda w: demand.lost_sales(w.panel),
    "q14_coverage_bands": lambda w: demand.coverage_bands(w.panel),
    "q15_churn": lambda w: demand.assortment_churn(w.panel),
    "q16_high_risk": lambda w: demand.high_risk_skus(w.dated_panel, w.inventory, w.last_day),
    "q17_price_bands": lambda w: demand.price_bands(w.panel),
    "q18_units_per_order": lambda w: demand.units_per_order_trend(w.panel),
    "b01_warehouse_demand": lambda w: demand.warehouse_overview(w.panel),
    "b02_constrained_days": lambda w: demand.constrained_days(w.panel),
}.items():
    _register(_key)(_build)


# --- time lines and features -------------------------------------------------


@_register("f01_regularize")
def _(w):
    return timeline.regularize(w.panel)


@_register("f02_lags")
def _(w):
    return timeline.with_lags(w.panel.select("unique_id", "date", "sales"))


@_register("f03_rolling_means")
def _(w):
    means = timeline.with_rolling_means(w.panel.select("unique_id", "date", "sales"))
    return _rounded(means, 4, "rmean_7_lag28", "rmean_28_lag28")


@_register("f04_discount_total")
def _(w):
    frame = features.with_discount_total(w.panel.select("unique_id", "date", *DISCOUNTS))
    return _rounded(frame.select("unique_id", "date", "discount_total"), 4, "discount_total")


@_register("f05_calendar_join")
def _(w):
    return features.with_calendar(w.panel.select("unique_id", "date", "warehouse"), w.calendar)


@_register("f06_category_join", "sparse")
def _(w):
    return features.with_category(w.panel.select("unique_id", "date"), w.inventory)


@_register("f07_date_parts")
def _(w):
    return features.with_date_parts(w.panel.select("unique_id", "date"))


@_register("f08_one_hot")
def _(w):
    frame = features.with_category(w.panel.select("unique_id", "date", "warehouse"), w.inventory)
    return features.with_one_hot(frame, w.one_hot_values)


@_register("f09_feature_frame")
def _(w):
    frame = features.feature_frame(w.panel, w.calendar, w.inventory, w.one_hot_values)
    return _rounded(frame, 4, "rmean_7_lag28", "rmean_28_lag28", "discount_total")


@_register("f10_leak_audit")
def _(w):
    return features.leak_audit(w.dated_panel, w.one_hot_values, state=w.carried, last=w.last_day)


@_register("f11_seasonal_naive", "sparse")
def _(w):
    return _rounded(w.seasonal_naive(), 6, "prediction")


@_register("f12_moving_average", "sparse")
def _(w):
    return _rounded(w.moving_average(), 6, "prediction")


@_register("f13_forecast_grid", "sparse")
def _(w):
    history, holdout = w.split
    return baselines.forecast_grid(history, baselines.horizon_dates(holdout), holdout)


@_register("f15_fallback_report", "sparse")
def _(w):
    naive = baselines.fallback_report(w.seasonal_naive()).withColumn("model", F.lit("seasonal_naive_7"))
    average = baselines.fallback_report(w.moving_average()).withColumn("model", F.lit("moving_average_28"))
    return naive.unionByName(average)


# --- metrics -----------------------------------------------------------------


_METRICS = ("wmape", "wmape_weighted", "mae", "rmse")


def _one_metric(w: Warehouse, name: str) -> DataFrame:
    """Per warehouse, behind the evaluation's gate: nothing unpredicted, nothing without a weight."""
    scores = scoring.evaluate(w.moving_average(), w.split[1], w.weights).filter("scope = 'warehouse'")
    return _rounded(scores.select("warehouse", name), 6, name)


for _key, _name in zip(("m01_wmape", "m02_wmape_weighted", "m03_mae", "m04_rmse"), _METRICS):
    _register(_key, "sparse")(lambda w, name=_name: _one_metric(w, name))


@_register("m05_eval_rollup")
def _(w):
    return _rounded(scoring.evaluate(w.moving_average(), w.split[1], w.weights), 6, *_METRICS)


def _models(w: Warehouse) -> DataFrame:
    holdout = w.split[1]
    return scoring.model_table(
        {
            "seasonal_naive_7": scoring.evaluate(w.seasonal_naive(), holdout, w.weights),
            "moving_average_28": scoring.evaluate(w.moving_average(), holdout, w.weights),
        }
    )


@_register("m06_model_compare")
def _(w):
    compared = scoring.compare(settle(_models(w), "models"), "moving_average_28")
    return _rounded(_rounded(compared, 6, "wmape"), 4, "delta_wmape")


@_register("m07_holdout_split")
def _(w):
    parts = None
    for name, part in zip(("history", "holdout"), w.split):
        row = part.agg(
            F.lit(name).alias("part"), F.count(F.lit(1)).alias("n_rows"),
            F.min("date").alias("min_date"), F.max("date").alias("max_date"),
        )
        parts = row if parts is None else parts.unionByName(row)
    return parts


@_register("m08_temporal_split")
def _(w):
    return features.temporal_split(w.panel.select("unique_id", "date"))


@_register("g01_boosted_trees")
def _(w):
    """What is determined about the boosted forecast: every holdout row has a finite prediction."""
    finite = F.col("prediction").isNotNull() & ~F.isnan("prediction") & (F.abs("prediction") < float("inf"))
    return w.boosted_predictions.select("unique_id", "date", "warehouse", "actual", finite.alias("finite"))


def boosted_scores(w: Warehouse) -> DataFrame:
    """Errors of the boosted model next to the baselines on the same holdout."""
    boosted = scoring.evaluate(w.boosted_predictions, w.split[1], w.weights)
    return _models(w).unionByName(scoring.model_table({"boosted_trees": boosted}))


@_register("g02_importance")
def _(w):
    """The model's inputs, and the sum of their importances."""
    table = boosting.importances(w.boosted, limit=None)
    total = table.agg(half_up(F.sum("importance"), 6)).scalar()
    return table.select("feature", total.alias("total_importance"))


# --- decisions ---------------------------------------------------------------

_RISK_ROUNDING = ("forecast_units", "recent_availability", "assumed_future_availability")


@_register("r01_recent_availability", "sparse")
def _(w):
    return _rounded(w.availability(), 6, "recent_availability")


@_register("r02_risk", "sparse")
def _(w):
    scored = risk.stockout_risk(w.forecasts, w.availability()).drop("risk_tier")
    return _rounded(scored, 6, *_RISK_ROUNDING)


@_register("r03_tier", "sparse")
def _(w):
    scored = risk.stockout_risk(w.forecasts, w.availability())
    return scored.select("unique_id", "estimated_unmet_units", "risk_fraction", "risk_tier")


@_register("r04_risk_enrich", "sparse")
def _(w):
    return _rounded(risk.worst_first(w.score_risk()), 6, *_RISK_ROUNDING)


@_register("r05_quantity", "sparse")
def _(w):
    return w.risk.select(
        "unique_id", "estimated_unmet_units",
        replenish.order_quantity(F.col("estimated_unmet_units")).alias("quantity"),
    )


@_register("r06_recommend", "sparse")
def _(w):
    return replenish.recommendations(w.risk).drop("rationale", "assumptions")


@_register("r07_rationale", "sparse")
def _(w):
    return replenish.recommendations(w.risk).select("unique_id", "rationale", "assumptions")


@_register("r08_priority_order", "sparse")
def _(w):
    return replenish.by_priority(w.recommendations).select("unique_id", "priority", "estimated_unmet_units")


@_register("r10_total_coverage", "sparse")
def _(w):
    return replenish.coverage(w.risk, w.recommendations)


_SCENARIO_COLUMNS = [
    "scenario", "unique_id", "scenario_demand_units", "scenario_availability", "baseline_unmet_units",
    "scenario_unmet_units", "unmet_units_delta", "scenario_recommended_units",
]


@_register("w01_scenario", "sparse")
def _(w):
    frame = whatif.apply_scenarios(w.risk, [SURGE]).select(*_SCENARIO_COLUMNS)
    return _rounded(frame, 4, "scenario_demand_units", "scenario_availability")


@_register("w02_scenario_grid", "sparse")
def _(w):
    frame = whatif.apply_scenarios(w.risk, SCENARIOS).select(*_SCENARIO_COLUMNS)
    return _rounded(frame, 4, "scenario_demand_units", "scenario_availability")


@_register("w04_identity_gate", "sparse")
def _(w):
    return whatif.identity_gate(w.risk)


@_register("w05_scenario_summary", "sparse")
def _(w):
    return whatif.scenario_summary(whatif.apply_scenarios(w.risk, SCENARIOS))


@_register("w06_top_increases", "sparse")
def _(w):
    return whatif.top_increases(whatif.apply_scenarios(w.risk, SCENARIOS))


@_register("w07_scenario_tag", "sparse")
def _(w):
    frame = whatif.apply_scenarios(w.risk, SCENARIOS)
    return frame.groupBy(F.col("scenario").alias("tag")).agg(F.count(F.lit(1)).alias("series"))


# --- read side ---------------------------------------------------------------


@_register("b03_high_risk_list", "sparse")
def _(w):
    return readside.high_risk_list(w.risk)


@_register("b04_tier_counts", "sparse")
def _(w):
    return readside.tier_counts(w.risk)


@_register("b05_action_counts", "sparse")
def _(w):
    return readside.action_counts(w.recommendations)


@_register("b06_scenario_compare", "sparse")
def _(w):
    return readside.scenario_comparison(w.risk, whatif.apply_scenarios(w.risk, [SURGE]), SURGE_LABEL)


@_register("d01_series_lookup", "sparse")
def _(w):
    smallest = w.forecasts.agg(F.min("unique_id")).scalar()
    return _rounded(readside.series_forecast(w.forecasts, smallest).drop("method"), 6, "prediction")


_RISK_LIST = ["unique_id", "name", "warehouse", "risk_tier", "estimated_unmet_units", "risk_fraction"]


@_register("d02_risk_filter", "sparse")
def _(w):
    return readside.risk_list(w.risk, "HIGH", 50).select(*_RISK_LIST)


@_register("d03_rec_filter", "sparse")
def _(w):
    listed = readside.recommendation_list(w.recommendations, "replenish_now", 50)
    return listed.drop("rationale", "assumptions")


@_register("d04_kpis", "sparse")
def _(w):
    return readside.kpis(w.risk, w.recommendations)


@_register("d05_top_high", "sparse")
def _(w):
    return _rounded(readside.top_high(w.risk), 6, "forecast_units", "recent_availability")


@_register("d06_gap_count", "sparse")
def _(w):
    return readside.gap_count(w.risk)


@_register("d07_quality_exceptions")
def _(w):
    return quality.exceptions(w.quality_report).select("table_name", "check_name", "status")


@_register("d08_model_table")
def _(w):
    return _rounded(_models(w), 6, *_METRICS)


@_register("d09_artifact_status", "sparse")
def _(w):
    folder = _folder(w, "stages")
    artifacts.write_artifact(w.risk, f"{folder}/risk")
    return artifacts.artifact_status(
        w.spark, {name: f"{folder}/{name}" for name in ("forecasts", "risk", "recommendations")}
    )
