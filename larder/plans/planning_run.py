"""A full planning run over a folder of source files.

    spark-submit -m larder.plans.planning_run SOURCE TARGET [--force]

SOURCE holds the five declared tables as CSV (``sales_train.csv`` and so on);
TARGET receives one folder per stage.  Each stage reads the stored output of
the stages before it and appends a row to the run manifest.  The run stops at
the first failed gate: source checks, orphan rows, incomplete evaluation, a
neutral scenario that does not reproduce the risk table.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import baselines, boosting, features, replenish, risk, scoring, whatif
from ..sources import artifacts, layout, load
from ..sources.layout import Layout
from ..sources.scan import scan_csv
from ..sources.tables import TABLES
from .batch import run_gate

DEFAULT_SCENARIOS = (whatif.IDENTITY, whatif.Scenario(1.2, whatif.PROMO_UPLIFT, 0.1))


@dataclass
class PlanningRun:
    """Stages of one run; every output is a table under ``target``."""

    spark: SparkSession
    target: str
    scenarios: Sequence[whatif.Scenario] = DEFAULT_SCENARIOS
    boosting_params: boosting.BoostingParams = field(default_factory=boosting.BoostingParams)

    def _path(self, stage: str) -> str:
        return f"{self.target}/{stage}"

    def _read(self, stage: str) -> DataFrame:
        return artifacts.read_artifact(self.spark, self._path(stage), stage)

    def _table(self, name: str) -> DataFrame:
        return load.loaded_table(self.spark, self._path(f"tables/{name}"))

    def _keep(self, stage: str, output: DataFrame, inputs: dict[str, int] | None = None, order: Layout | None = None) -> int:
        rows = artifacts.write_artifact(output, self._path(stage), mode="overwrite", layout=order)
        row = artifacts.manifest_row(
            self.spark, stage, {**(inputs or {}), "rows": rows}, {stage: self._path(stage)}, "PASS"
        )
        artifacts.append_manifest(row, self._path("_manifest"))
        return rows

    def check_and_load(self, tables: dict[str, DataFrame], force: bool = False) -> list[load.LoadStatus]:
        """Validate the sources, then store them and verify the row counts.

        The sources are parsed once, into a staging copy that all checks and
        the load read.
        """
        for name, table in tables.items():
            table.write.mode("overwrite").parquet(self._path(f"_staging/{name}"))
        staged = {name: self._read(f"_staging/{name}") for name in tables}
        run_gate(self.spark, staged, self._path("validation"))
        statuses = load.load_all(staged, self._path("tables"), force)
        load.require_no_orphans(self._table("sales_train"), self._table("inventory"), "unique_id")
        return statuses

    def build_features(self) -> None:
        frame = features.model_frame(
            self._table("sales_train"), self._table("calendar"), self._table("inventory")
        )
        self._keep("features", frame)

    def forecast_baselines(self) -> None:
        history, holdout = features.history_and_holdout(self._table("sales_train"))
        baselines.check_history(history)
        self._keep("profile", baselines.series_profile(history))
        profile, dates = self._read("profile"), baselines.horizon_dates(holdout)
        self._keep("forecasts/seasonal_naive_7", baselines.seasonal_naive(profile, dates, holdout), order=layout.FORECASTS)
        self._keep("forecasts/moving_average_28", baselines.moving_average(profile, dates, holdout), order=layout.FORECASTS)

    def forecast_boosted(self) -> boosting.BoostedForecast:
        fitted = boosting.boosted_forecast(self._read("features"), self._table("inventory"), self.boosting_params)
        self._keep("forecasts/boosted_trees", fitted.predictions, {"rounds": fitted.rounds}, layout.FORECASTS)
        return fitted

    def evaluate(self, models: Sequence[str]) -> None:
        _, holdout = features.history_and_holdout(self._table("sales_train"))
        weights = self._table("test_weights")
        scored = {m: scoring.evaluate(self._read(f"forecasts/{m}"), holdout, weights) for m in models}
        self._keep("evaluation", scoring.model_table(scored))

    def decide(self, model: str) -> None:
        """Risk, recommendations and scenarios on one model's forecasts."""
        forecasts, inventory = self._read(f"forecasts/{model}"), self._table("inventory")
        start = forecasts.agg(F.min("date")).scalar()
        seen = risk.recent_availability(self._table("sales_train"), start)
        self._keep("risk", risk.with_product(risk.stockout_risk(forecasts, seen), inventory), order=layout.RISK)
        self._keep("recommendations", replenish.recommendations(self._read("risk")), order=layout.RECOMMENDATIONS)
        whatif.identity_gate(self._read("risk")).collect()
        simulated = whatif.apply_scenarios(self._read("risk"), self.scenarios)
        self._keep("simulation", simulated)
        self._keep("simulation_summary", whatif.scenario_summary(self._read("simulation")))

    def run(self, tables: dict[str, DataFrame], force: bool = False, boosted: bool = True) -> DataFrame:
        """All stages in order; the manifest of the run."""
        refused = [s.table_name for s in self.check_and_load(tables, force) if s.outcome == load.NEEDS_FORCE]
        if refused:
            raise load.LoadRefused(f"stored tables of another row count: {', '.join(refused)}; use force to replace them")
        self.forecast_baselines()
        models = ["seasonal_naive_7", "moving_average_28"]
        if boosted:
            self.build_features()
            self.forecast_boosted()
            models.append("boosted_trees")
        self.evaluate(models)
        self.decide(models[-1])
        return self._read("_manifest")


def main() -> None:
    parser = argparse.ArgumentParser(description="Run all planning stages over a folder of CSV files.")
    parser.add_argument("source")
    parser.add_argument("target")
    parser.add_argument("--force", action="store_true", help="replace stored tables of another row count")
    options = parser.parse_args()
    spark = SparkSession.builder.appName("larder-planning").getOrCreate()
    tables = {name: scan_csv(spark, spec, f"{options.source}/{name}.csv") for name, spec in TABLES.items()}
    PlanningRun(spark, options.target).run(tables, options.force).show(truncate=False)


if __name__ == "__main__":
    main()
