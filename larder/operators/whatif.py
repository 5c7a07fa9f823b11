"""What-if scenarios over a frozen risk table.

Scenarios are parameters of the plan: a list of them is an array literal
exploded next to each risk row, so any number of scenarios is one pass over
the risk table without a join.  Baseline columns are carried through unchanged.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import clip, half_even
from .replenish import order_quantity

PROMO_UPLIFT = 0.356  # fixed value: the demand lift assumed for a promotion
IDENTITY_TOLERANCE = 0.01
TOP_INCREASES = 10


class InvalidScenario(ValueError):
    """A lever is outside its range."""


@dataclass(frozen=True)
class Scenario:
    demand_multiplier: float = 1.0
    promo_uplift: float = 0.0
    availability_improvement: float = 0.0

    def __post_init__(self) -> None:
        if self.demand_multiplier < 0:
            raise InvalidScenario("demand_multiplier must not be negative")
        if self.promo_uplift < 0:
            raise InvalidScenario("promo_uplift must not be negative")
        if not 0 <= self.availability_improvement <= 1:
            raise InvalidScenario("availability_improvement must lie within 0 and 1")

    @property
    def tag(self) -> str:
        """File-safe name, such as dm1p2_pu0p356_ai0p1."""
        levers = {
            "dm": self.demand_multiplier,
            "pu": self.promo_uplift,
            "ai": self.availability_improvement,
        }
        text = "_".join(f"{name}{value:g}" for name, value in levers.items())
        return text.translate(str.maketrans({".": "p", "-": "m"}))

    def literal(self) -> Column:
        return F.struct(
            F.lit(self.tag).alias("scenario"),
            F.lit(float(self.demand_multiplier)).alias("demand_multiplier"),
            F.lit(float(self.promo_uplift)).alias("promo_uplift"),
            F.lit(float(self.availability_improvement)).alias("availability_improvement"),
        )


IDENTITY = Scenario()


def apply_scenarios(risk: DataFrame, scenarios: Sequence[Scenario]) -> DataFrame:
    """Each risk row once per scenario, with the scenario's figures."""
    lever = F.col("lever")
    demand = F.col("forecast_units") * (lever["demand_multiplier"] * (F.lit(1.0) + lever["promo_uplift"]))
    gap = F.coalesce("availability_data_gap", F.lit(True))
    improved = clip(
        F.coalesce("assumed_future_availability", F.lit(1.0)) + lever["availability_improvement"], 0, 1
    )
    levers = F.explode(F.array(*[s.literal() for s in scenarios])).alias("lever")
    return (
        risk.select("*", levers)
        .withColumn("scenario", lever["scenario"])
        .withColumn("scenario_demand_units", demand)
        .withColumn("scenario_availability", F.when(gap, F.lit(1.0)).otherwise(improved))
        .withColumn("baseline_unmet_units", F.col("estimated_unmet_units"))
        .withColumn(
            "scenario_unmet_units",
            half_even(F.col("scenario_demand_units") * (F.lit(1.0) - F.col("scenario_availability")), 2),
        )
        .withColumn(
            "unmet_units_delta",
            half_even(F.col("scenario_unmet_units") - F.col("baseline_unmet_units"), 2),
        )
        .withColumn("scenario_recommended_units", order_quantity(F.col("scenario_unmet_units")))
        .drop("lever")
    )


def identity_gate(risk: DataFrame, tolerance: float = IDENTITY_TOLERANCE) -> DataFrame:
    """Largest deviation of the neutral scenario; fails beyond the tolerance."""
    drift = F.coalesce(
        F.max(F.abs(F.col("scenario_unmet_units") - F.col("baseline_unmet_units"))), F.lit(0.0)
    )
    measured = apply_scenarios(risk, [IDENTITY]).agg(
        F.count(F.lit(1)).alias("n_series"), drift.alias("max_drift")
    )
    message = F.concat(F.lit("neutral scenario drifted by "), F.col("max_drift").cast("string"))
    checked = F.when(F.col("max_drift") > tolerance, F.raise_error(message)).otherwise(F.col("max_drift"))
    return measured.select("n_series", checked.cast("double").alias("max_drift"))


def scenario_summary(simulated: DataFrame) -> DataFrame:
    """Series and totals of each scenario."""
    return simulated.groupBy("scenario").agg(
        F.count(F.lit(1)).alias("series"),
        half_even(F.sum("baseline_unmet_units"), 2).alias("total_baseline_unmet_units"),
        half_even(F.sum("scenario_unmet_units"), 2).alias("total_scenario_unmet_units"),
        half_even(F.sum("unmet_units_delta"), 2).alias("unmet_units_delta"),
        F.sum("scenario_recommended_units").alias("total_scenario_recommended_units"),
    )


def top_increases(simulated: DataFrame, limit: int = TOP_INCREASES) -> DataFrame:
    """The largest increases of unmet units of each scenario.

    The rank limit is applied per input partition before the shuffle, so a
    scenario's ranking receives a few rows per task, however long the table.
    """
    order = [F.desc_nulls_last("unmet_units_delta"), F.asc("unique_id")]
    rank = F.row_number().over(Window.partitionBy("scenario").orderBy(*order))
    return (
        simulated.withColumn("rank", rank)
        .filter(F.col("rank") <= limit)
        .select(
            "scenario", "rank", "unique_id", "name", "warehouse",
            "baseline_unmet_units", "scenario_unmet_units", "unmet_units_delta",
        )
    )
