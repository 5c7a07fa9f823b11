"""Exact discrete percentiles without gathering the values in one task."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import half_up, mean_of

SLICES = 512


def _ranked(df: DataFrame, value: str, slices: int) -> DataFrame:
    """Each distinct value, its copies, rows up to and including it, and n.

    Equal values are counted first, so a frequent value is one row.  The
    distinct values are cut into slices at approximate quantiles; only slice
    totals (at most ``slices`` rows) are accumulated globally, and each slice
    accumulates its own values in its own task.  The cut points steer the work
    only; the ranks are exact.
    """
    counted = df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("copies"))
    # The cut points come from the same counted shuffle, which runs once.
    cuts = counted.agg(F.percentile_approx(value, [i / slices for i in range(1, slices)], 10 * slices)).scalar()
    # By bisection; never NULL, so no null check of it is pushed below the counting.
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(slices.bit_length()))])
    below = lambda at, step: (at + step <= F.size("cuts")) & (F.get("cuts", at + step - 1) < F.col(value))
    position = F.aggregate(steps, F.lit(0), lambda at, step: F.when(below(at, step), at + step).otherwise(at))
    sliced = counted.withColumn("cuts", cuts).select(value, "copies", position.alias("slice"))
    totals = sliced.groupBy("slice").agg(F.sum("copies").alias("slice_copies"))
    running = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select(
        "slice",
        (F.sum("slice_copies").over(running) - F.col("slice_copies")).alias("before"),
        F.sum("slice_copies").over(everything).alias("n"),
    )
    within = Window.partitionBy("slice").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return sliced.join(offsets, "slice").withColumn("reached", F.col("before") + F.sum("copies").over(within))


def _percentile(value: str, fraction: float):
    return F.min(F.when(F.col("reached") >= F.ceil(F.lit(fraction) * F.col("n")), F.col(value)))


def discrete_percentiles(df: DataFrame, value: str, wanted: Mapping[str, float], slices: int = SLICES) -> DataFrame:
    """Smallest value whose cumulative share reaches each wanted fraction."""
    ranked = _ranked(df, value, slices)
    return ranked.agg(*[_percentile(value, fraction).alias(name) for name, fraction in wanted.items()])


# The reported percentiles.
REPORTED = {"p50": 0.5, "p75": 0.75, "p90": 0.9, "p99": 0.99}


def demand_distribution(panel: DataFrame) -> DataFrame:
    """Percentiles, maximum and mean of daily sales, from one pass."""
    total = F.sum(F.col("sales") * F.col("copies"))
    return _ranked(panel, "sales", SLICES).agg(
        *[_percentile("sales", fraction).alias(name) for name, fraction in REPORTED.items()],
        half_up(F.max("sales"), 1).alias("max_sales"),
        half_up(mean_of(total, F.sum("copies")), 2).alias("mean_sales"),
    )
