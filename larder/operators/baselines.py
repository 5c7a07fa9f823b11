"""Seasonal-naive and moving-average forecasts.

Both need only a profile of each series: totals over its gapless line, totals
over the recent window and its last seven days.  The profile is one pass over
the history; forecasts are then one row per series times the horizon.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import ratio
from .features import HORIZON_DAYS
from .timeline import held_runs

MOVING_WINDOW = 28
WEEK = 7
REQUIRED = ("unique_id", "date", "sales")


def check_history(history: DataFrame) -> None:
    missing = [c for c in REQUIRED if c not in history.columns]
    if missing:
        raise ValueError(f"history lacks columns {missing}; it needs {sorted(REQUIRED)}")
    if history.isEmpty():
        raise ValueError("history is empty: nothing to forecast from")


def series_profile(history: DataFrame, window: int = MOVING_WINDOW) -> DataFrame:
    """One row per series.

    units, days              totals over the gapless line
    recent_units/_days       the same over the last ``window`` days before the
                             last day of the whole history
    week                     weekday (0 = Monday) -> value of its last 7 days
    """
    if window <= 0:
        raise ValueError("window must be positive")
    newest = F.unix_date(history.agg(F.max("date")).scalar())
    own_last = F.max("day_no").over(Window.partitionBy("unique_id"))
    runs = (
        held_runs(history.select("unique_id", "date", "sales"))
        .withColumn("value", F.coalesce("held", F.lit(0.0)))
        .withColumn("end_no", F.col("day_no") + F.col("days") - 1)
        .withColumn("week_start", own_last - (WEEK - 1))
    )
    first_recent = newest - (window - 1)
    overlap = F.greatest(F.col("end_no") - F.greatest(F.col("day_no"), first_recent) + 1, F.lit(0))
    week_days = F.sequence(F.greatest("day_no", "week_start"), F.col("end_no"))
    pattern = F.transform(
        week_days, lambda n: F.struct(F.weekday(F.date_from_unix_date(n)).alias("dow"), F.col("value"))
    )
    # At most seven runs of a series reach its last week.
    in_week = F.when(F.col("end_no") >= F.col("week_start"), pattern)
    return runs.groupBy("unique_id").agg(
        F.sum(F.col("value") * F.col("days")).alias("units"),
        F.sum("days").alias("days"),
        F.sum(F.col("value") * overlap).alias("recent_units"),
        F.sum(overlap).alias("recent_days"),
        F.map_from_entries(F.flatten(F.collect_list(in_week))).alias("week"),
    )


def horizon_dates(holdout: DataFrame) -> Column:
    """The distinct holdout dates (at most the horizon's 28) as one array."""
    return holdout.agg(F.sort_array(F.collect_set("date"))).scalar()


def forecast_grid(known: DataFrame, dates: Column, declared: DataFrame | None = None) -> DataFrame:
    """Every known or declared series on every horizon date, with the weekday."""
    ids = known.select("unique_id")
    if declared is not None:
        ids = ids.unionByName(declared.select("unique_id"))
    grid = ids.distinct().withColumn("date", F.explode(dates))
    return grid.withColumn("dow", F.weekday("date"))


def _forecast(
    profile: DataFrame, dates: Column, declared: DataFrame | None, methods: list[tuple[str, Column]]
) -> DataFrame:
    """First applicable method per row; the global mean is the last resort."""
    everyone = profile.agg(ratio(F.sum("units"), F.sum("days"))).scalar()
    if declared is None:
        series = profile
    else:
        series = profile.join(declared.select("unique_id").distinct(), "unique_id", "full")
    rows = series.withColumn("date", F.explode(dates)).withColumn("dow", F.weekday("date"))
    value, method = F.lit(None).cast("double"), F.lit("global_mean")
    for name, candidate in reversed(methods):
        value = F.coalesce(candidate, value)
        method = F.when(candidate.isNotNull(), name).otherwise(method)
    prediction = F.coalesce(value, everyone)
    checked = F.when(prediction.isNotNull(), prediction).otherwise(
        F.raise_error(F.lit("forecast left a row without a prediction"))
    )
    return rows.select("unique_id", "date", checked.cast("double").alias("prediction"), method.alias("method"))


def seasonal_naive(profile: DataFrame, dates: Column, declared: DataFrame | None = None) -> DataFrame:
    """Repeat each series' last week over the horizon.

    Series with less than a week of history use their own mean for weekdays
    they never saw; series without history use the global mean.
    """
    same_weekday = F.element_at("week", F.col("dow"))
    own_mean = F.when(F.size("week") < WEEK, ratio(F.col("units"), F.col("days")))
    return _forecast(profile, dates, declared, [("last_week", same_weekday), ("series_mean", own_mean)])


def moving_average(profile: DataFrame, dates: Column, declared: DataFrame | None = None) -> DataFrame:
    """Hold the mean of the last ``window`` days flat over the horizon.

    The window ends at the last day of the whole history, so a series that
    stopped earlier than that has no recent mean and uses the global one.
    """
    recent = ratio(F.col("recent_units"), F.col("recent_days"))
    return _forecast(profile, dates, declared, [("recent_mean", recent)])


def fallback_report(forecast: DataFrame) -> DataFrame:
    """Series and rows served by each method."""
    per_series = forecast.groupBy("method", "unique_id").agg(F.count(F.lit(1)).alias("n"))
    return per_series.groupBy("method").agg(
        F.count("unique_id").alias("n_series"), F.sum("n").alias("n_rows")
    )
