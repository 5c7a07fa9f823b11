"""Per-series time lines without building a day-by-day grid.

A series with gaps is kept as runs: the value of an observed row holds until
the day before the next one.  Sums, means and look-backs over the gapless
daily line follow from run lengths and running totals, so nothing is exploded
and no wide matrix exists.  A series holds at most one row per day, which
bounds every window partition here by the number of days in the calendar.

All windows share one partitioning and one order, hence one exchange (none on
a panel bucketed by series) and one sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

LAGS = (28, 35, 42, 56)
ROLLING_WINDOWS = (7, 28)
LAG_SHIFT = 28
MIN_ROLLING_DAYS = 7


#: Columns that hold the first day of each row's period, where a stored panel is divided by them, and the unit of each.
PERIODS = {"month_start": "MM", "year_start": "YEAR"}


def since(panel: DataFrame, low: Column) -> DataFrame:
    """Rows from day ``low`` on; of a panel divided by periods, other periods are not read."""
    for column, unit in PERIODS.items():
        if column in panel.columns:
            panel = panel.filter(F.col(column) >= F.trunc(low, unit))
    return panel.filter(F.col("date") >= low)


def last_known(panel: DataFrame) -> DataFrame:
    """The state that history carries over: unique_id, period and, of each series and period, the last day with known sales."""
    column = next(c for c in PERIODS if c in panel.columns)
    known = panel.filter(F.col("sales").isNotNull())
    return known.groupBy("unique_id", F.col(column).alias("period")).agg(F.max("date").alias("date"), F.max_by("sales", "date").alias("sales"))


def recent_history(panel: DataFrame, state: DataFrame, low: Column, **options) -> DataFrame:
    """:func:`with_history` of the rows from day ``low`` on, without reading the periods that lie further back than any window.

    Of those, ``state`` (from :func:`last_known`) gives the last known sales of
    each series, which hold until the first row that is read.
    """
    lags, windows, shift = options.get("lags", LAGS), options.get("windows", ROLLING_WINDOWS), options.get("shift", LAG_SHIFT)
    column, unit = next((c, u) for c, u in PERIODS.items() if c in panel.columns)
    start = F.trunc(F.date_sub(low, max([*lags, *(shift + w for w in windows)])), unit)
    before = state.filter(F.col("period") < start).groupBy("unique_id").agg(F.max("date").alias("date"), F.max_by("sales", "date").alias("sales"))
    rows = panel.filter(F.col(column) >= start).select("unique_id", "date", "sales").unionByName(before)
    return with_history(rows, **options).filter(F.col("date") >= low)


def _by_day():
    return Window.partitionBy("unique_id").orderBy("day_no")


def _dated(df: DataFrame) -> DataFrame:
    return df if "day_no" in df.columns else df.withColumn("day_no", F.unix_date("date"))


def held_runs(history: DataFrame) -> DataFrame:
    """Add the run each row starts: ``days`` it lasts and the value ``held``.

    ``held`` is the last known value at or before the row and NULL before the
    first known one.  Two rows for one day have no defined order and fail.
    """
    past = _by_day().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    following = F.lead("day_no").over(_by_day())
    days = F.coalesce(following - F.col("day_no"), F.lit(1))
    twice = F.concat(F.lit("two rows for one day in series "), F.col("unique_id").cast("string"))
    return _dated(history).withColumns(
        {
            "days": F.when(days > 0, days).otherwise(F.raise_error(twice).cast("int")),
            "held": F.last("sales", ignorenulls=True).over(past),
        }
    )


def regularize(history: DataFrame) -> DataFrame:
    """One row per series and calendar day of its own range, gaps filled.

    Values are carried forward; days before the first known value are zero.
    """
    last_day = F.date_add("date", F.col("days") - 1)
    return held_runs(history.select("unique_id", "date", "sales")).select(
        "unique_id",
        F.explode(F.sequence("date", last_day)).alias("date"),
        F.coalesce("held", F.lit(0.0)).alias("sales"),
    )


def _upto(days_back: int) -> WindowSpec:
    """All rows of the series that are ``days_back`` or more calendar days old."""
    return _by_day().rangeBetween(Window.unboundedPreceding, -days_back)


def _as_of(value: Column, days_back: int) -> Column:
    """The last non-null value at least ``days_back`` calendar days ago."""
    return F.last(value, ignorenulls=True).over(_upto(days_back))


def _read_of(days_back: int) -> Column:
    """The latest day that :func:`_as_of` reads."""
    return F.max("day_no").over(_upto(days_back))


def _lag_columns(lags: Sequence[int]) -> dict[str, Column]:
    return {f"lag_{k}": _as_of(F.col("sales"), k) for k in lags}


def history_names(lags: Sequence[int], windows: Sequence[int], shift: int) -> list[str]:
    return [f"lag_{k}" for k in lags] + [f"rmean_{w}_lag{shift}" for w in windows]


def with_lags(panel: DataFrame, lags: Sequence[int] = LAGS) -> DataFrame:
    """Add ``lag_k``: the last known sales k or more days before the row."""
    return _dated(panel).withColumns(_lag_columns(lags)).drop("day_no")


def with_history(
    panel: DataFrame,
    lags: Sequence[int] = LAGS,
    windows: Sequence[int] = ROLLING_WINDOWS,
    shift: int = LAG_SHIFT,
    min_days: int = MIN_ROLLING_DAYS,
    read_days: bool = False,
) -> DataFrame:
    """Add lags and ``rmean_w_lag{shift}``: mean of w days ending ``shift`` days ago.

    A mean is the difference of running totals at two earlier days.  Each total
    is looked up as of its day: the total before the run that covers the day,
    plus that run's value for the days it has lasted.  With ``read_days``, each
    feature's ``<name>_read`` is the number of the latest day among the rows in
    its windows.
    """
    earlier = _by_day().rowsBetween(Window.unboundedPreceding, -1)
    known = F.col("held").isNotNull()
    units = F.when(known, F.col("held") * F.col("days")).otherwise(F.lit(0.0))
    length = F.when(known, F.col("days")).otherwise(F.lit(0))
    run = F.struct(
        F.coalesce("units_before", F.lit(0.0)).alias("units_before"),
        F.coalesce("days_before", F.lit(0).cast("long")).alias("days_before"),
        "day_no",
        "held",
    )
    totals = held_runs(panel).withColumns(
        {"units_before": F.sum(units).over(earlier), "days_before": F.sum(length).over(earlier)}
    )
    offsets = sorted({shift} | {shift + w for w in windows})
    looked_up = totals.withColumns(
        {**_lag_columns(lags), **{f"run_{k}": _as_of(run, k) for k in offsets}}
    )
    read = []
    if read_days:
        reaches = {f"lag_{k}": [k] for k in lags} | {f"rmean_{w}_lag{shift}": [shift, shift + w] for w in windows}
        for name, reach in reaches.items():
            days_read = [_read_of(k) for k in reach]
            read.append((days_read[0] if len(reach) == 1 else F.greatest(*days_read)).alias(f"{name}_read"))

    def upto(k: int) -> tuple[Column, Column]:
        at = F.col(f"run_{k}")
        lasted = F.col("day_no") - F.lit(k) - at["day_no"] + 1
        units_upto = at["units_before"] + F.coalesce(at["held"] * lasted, F.lit(0.0))
        days_upto = at["days_before"] + F.when(at["held"].isNotNull(), lasted).otherwise(F.lit(0))
        return F.coalesce(units_upto, F.lit(0.0)), F.coalesce(days_upto, F.lit(0).cast("long"))

    means = []
    for w in windows:
        (units_end, days_end), (units_start, days_start) = upto(shift), upto(shift + w)
        n = days_end - days_start
        mean = F.when(n >= min_days, (units_end - units_start) / n)
        means.append(mean.alias(f"rmean_{w}_lag{shift}"))
    return looked_up.select(*panel.columns, *[f"lag_{k}" for k in lags], *means, *read)


def with_rolling_means(panel: DataFrame, windows: Sequence[int] = ROLLING_WINDOWS, shift: int = LAG_SHIFT) -> DataFrame:
    return with_history(panel, lags=(), windows=windows, shift=shift)
