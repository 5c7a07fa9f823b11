"""Availability-aware stockout risk per series.

Future availability is assumed to equal the recent observed one.  A series
without any recent row has no signal: it counts as fully available and is
flagged as a data gap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import clip, half_even, mean_of, steady_sum
from .demand import LOW_AVAILABILITY
from .timeline import since

RECENT_DAYS = 28

# Tier thresholds on unmet units and on their share of demand.
HIGH_UNMET, HIGH_FRACTION = 10.0, 0.10
MEDIUM_UNMET, MEDIUM_FRACTION = 5.0, 0.05
SMALLEST_DEMAND = 1e-9


def recent_availability(panel: DataFrame, window_end: Column, days: int = RECENT_DAYS) -> DataFrame:
    """Observed availability per series in the ``days`` before ``window_end``."""
    low = F.col("availability") < LOW_AVAILABILITY
    return (
        since(panel, F.date_sub(window_end, days)).filter(F.col("date") < window_end)
        .groupBy("unique_id")
        .agg(
            mean_of(steady_sum(F.col("availability")), F.count("availability")).alias("recent_availability"),
            F.count(F.lit(1)).alias("n_days_observed"),
            F.count_if(low).alias("low_avail_days"),
        )
    )


def tier(unmet: Column, fraction: Column) -> Column:
    """Tier from the rounded figures, both thresholds inclusive."""
    return (
        F.when((unmet >= HIGH_UNMET) & (fraction >= HIGH_FRACTION), "HIGH")
        .when((unmet >= MEDIUM_UNMET) & (fraction >= MEDIUM_FRACTION), "MEDIUM")
        .otherwise("LOW")
    )


def stockout_risk(forecasts: DataFrame, availability: DataFrame) -> DataFrame:
    """Expected demand, unmet units, their share and the tier of each series."""
    demand = forecasts.groupBy("unique_id").agg(steady_sum(F.col("prediction")).alias("forecast_units"))
    units = F.col("forecast_units")
    shortfall = clip(F.lit(1.0) - F.col("assumed_future_availability"), 0, 1)
    fraction = half_even(F.col("estimated_unmet_units") / F.greatest(units, F.lit(SMALLEST_DEMAND)), 4)
    return (
        demand.join(availability, "unique_id", "left")
        .withColumn("assumed_future_availability", F.coalesce("recent_availability", F.lit(1.0)))
        .withColumn("availability_data_gap", F.coalesce("n_days_observed", F.lit(0)) == 0)
        .withColumn("estimated_unmet_units", half_even(units * shortfall, 2))
        .withColumn("risk_fraction", F.when(units > 0, fraction).otherwise(F.lit(0.0)))
        .withColumn("risk_tier", tier(F.col("estimated_unmet_units"), F.col("risk_fraction")))
    )


def with_product(risk: DataFrame, inventory: DataFrame) -> DataFrame:
    """Add name, category and warehouse."""
    product = inventory.select("unique_id", "name", "l1_category_name_en", "warehouse")
    return risk.join(product, "unique_id", "left")


def worst_first(risk: DataFrame) -> DataFrame:
    return risk.orderBy(
        F.desc_nulls_last("estimated_unmet_units"), F.desc_nulls_last("forecast_units"), "unique_id"
    )
