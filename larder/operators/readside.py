"""Read-side lookups, report tables and indicators over frozen results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import half_up
from .replenish import ACTIONS, by_priority
from .risk import worst_first

LARGEST_PAGE = 500
TIERS = ("HIGH", "MEDIUM", "LOW")


class UnknownSeries(LookupError):
    """No forecast exists for the series asked for."""


class UnknownValue(ValueError):
    """A filter asks for a tier or an action that does not exist."""


def _one_of(value: str | None, known: Sequence[str], what: str) -> None:
    if value is not None and value not in known:
        raise UnknownValue(f"unknown {what} '{value}'; one of {', '.join(known)}")


def _page(limit: int) -> int:
    if not 1 <= limit <= LARGEST_PAGE:
        raise ValueError(f"limit must lie within 1 and {LARGEST_PAGE}")
    return limit


def series_forecast(forecasts: DataFrame, unique_id: int | Column, limit: int = 28) -> DataFrame:
    """Daily forecasts of one series in date order; a given number must have some."""
    rows = forecasts.filter(F.col("unique_id") == unique_id)
    if not isinstance(unique_id, Column) and rows.isEmpty():
        raise UnknownSeries(f"no forecast for series {unique_id}")
    return rows.orderBy("date").limit(_page(limit))


def risk_list(risk: DataFrame, tier: str | None = None, limit: int = 50) -> DataFrame:
    _one_of(tier, TIERS, "tier")
    rows = risk if tier is None else risk.filter(F.col("risk_tier") == tier)
    return worst_first(rows).limit(_page(limit))


def recommendation_list(recs: DataFrame, action: str | None = None, limit: int = 50) -> DataFrame:
    _one_of(action, ACTIONS, "action")
    rows = recs if action is None else recs.filter(F.col("action") == action)
    return by_priority(rows).limit(_page(limit))


def tier_counts(risk: DataFrame) -> DataFrame:
    return (
        risk.groupBy("risk_tier")
        .agg(F.count(F.lit(1)).alias("series"))
        .orderBy(F.desc("series"), "risk_tier")
    )


def action_counts(recs: DataFrame) -> DataFrame:
    return (
        recs.groupBy("action")
        .agg(
            F.count(F.lit(1)).alias("series"),
            F.sum("recommended_units").alias("total_units_to_order"),
        )
        .orderBy(F.desc("total_units_to_order"), "action")
    )


def high_risk_list(risk: DataFrame, limit: int = 25) -> DataFrame:
    """HIGH series with an availability signal, rounded for display."""
    signalled = ~F.coalesce("availability_data_gap", F.lit(False))
    return (
        risk.filter((F.col("risk_tier") == "HIGH") & signalled)
        .select(
            "name",
            "warehouse",
            half_up(F.col("forecast_units"), 0).alias("forecast_units_28d"),
            half_up(F.col("recent_availability"), 3).alias("observed_availability"),
            half_up(F.col("estimated_unmet_units"), 0).alias("estimated_unmet_units"),
        )
        .orderBy(F.desc_nulls_last("estimated_unmet_units"), "name", "warehouse")
        .limit(limit)
    )


def scenario_comparison(risk: DataFrame, simulated: DataFrame, label: str) -> DataFrame:
    """Unmet units of the baseline and of one scenario, one row each."""
    baseline = risk.agg(half_up(F.sum("estimated_unmet_units"), 0).alias("unmet_units"))
    scenario = simulated.agg(half_up(F.sum("scenario_unmet_units"), 0).alias("unmet_units"))
    return baseline.select(F.lit("baseline").alias("scenario"), "unmet_units").unionByName(
        scenario.select(F.lit(label).alias("scenario"), "unmet_units")
    )


def kpis(risk: DataFrame, recs: DataFrame) -> DataFrame:
    """Demand, units at risk, series by tier and by action."""
    actions = recs.agg(*[F.count_if(F.col("action") == a).alias(a) for a in ACTIONS])
    return risk.agg(
        F.count(F.lit(1)).alias("series"),
        half_up(F.sum("forecast_units"), 2).alias("total_forecast_units"),
        half_up(F.sum("estimated_unmet_units"), 2).alias("total_unmet_units"),
        *[F.count_if(F.col("risk_tier") == t).alias(f"n_{t.lower()}") for t in TIERS],
    ).withColumns({f"n_{a}": actions.select(a).scalar() for a in ACTIONS})


def top_high(risk: DataFrame, limit: int = 10) -> DataFrame:
    """First HIGH rows in risk order."""
    rows = worst_first(risk.filter(F.col("risk_tier") == "HIGH")).limit(limit)
    return rows.select(
        "unique_id", "name", "warehouse", "forecast_units", "recent_availability", "estimated_unmet_units"
    )


def gap_count(risk: DataFrame) -> DataFrame:
    gap = F.coalesce("availability_data_gap", F.lit(False))
    return risk.agg(F.count_if(gap).alias("data_gaps"), F.count(F.lit(1)).alias("series"))
