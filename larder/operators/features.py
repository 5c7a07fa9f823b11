"""Leak-safe feature table.

Everything known on the decision day may be used: history at least 28 days
old, planned prices and discounts, the calendar and product attributes.  The
day's own order volume and availability are outcomes and stay out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import sum_skipping_nulls
from ..sources.tables import DISCOUNTS
from .timeline import LAG_SHIFT, LAGS, ROLLING_WINDOWS, history_names, recent_history, since, with_history

HORIZON_DAYS = 28
CALENDAR_FLAGS = ["holiday", "shops_closed", "winter_school_holidays", "school_holidays"]
CATEGORY = "l1_category_name_en"

HISTORY_FEATURES = history_names(LAGS, ROLLING_WINDOWS, LAG_SHIFT)
KNOWN_AHEAD = ["sell_price_main", "discount_total", "dow", "day_of_month", "month", *CALENDAR_FLAGS]


def with_discount_total(panel: DataFrame) -> DataFrame:
    return panel.withColumn("discount_total", sum_skipping_nulls(DISCOUNTS))


def with_calendar(panel: DataFrame, calendar: DataFrame) -> DataFrame:
    flags = calendar.select("warehouse", "date", *CALENDAR_FLAGS)
    return panel.join(flags, ["warehouse", "date"], "left")


def with_category(panel: DataFrame, inventory: DataFrame) -> DataFrame:
    return panel.join(inventory.select("unique_id", CATEGORY), "unique_id", "left")


def with_date_parts(panel: DataFrame) -> DataFrame:
    """Weekday (0 = Monday), day of month and month."""
    return panel.withColumns(
        {
            "dow": F.weekday("date"),
            "day_of_month": F.dayofmonth("date"),
            "month": F.month("date"),
        }
    )


def categories(df: DataFrame, column: str) -> list[str]:
    """Sorted distinct values of a dimension column, for presenting them as columns of their own.

    Each value becomes a column of the plan.  The model does not go this way:
    it reads :func:`category_index`, which stays a table.
    """
    found = df.select(column).filter(F.col(column).isNotNull()).distinct().collect()
    return sorted(row[0] for row in found)


def category_index(df: DataFrame, column: str) -> DataFrame:
    """``column`` and its ``slot`` in sorted order, from 1 on; slot 0 is for missing or unknown values.

    Numbering runs over the distinct values of a dimension, not over its rows.
    """
    values = df.select(column).filter(F.col(column).isNotNull()).distinct()
    return values.select(column, F.row_number().over(Window.orderBy(column)).alias("slot"))


def with_one_hot(df: DataFrame, values: dict[str, Sequence[str]]) -> DataFrame:
    """0/1 column per value; NULL gives zeros everywhere."""
    return df.withColumns({name: flag for name, flag in _one_hot(values)})


def _one_hot(values: dict[str, Sequence[str]]) -> list[tuple[str, Column]]:
    return [
        (f"{column}_{value}", F.coalesce((F.col(column) == value).cast("int"), F.lit(0)))
        for column, known in values.items()
        for value in known
    ]


def feature_columns(values: dict[str, Sequence[str]]) -> list[str]:
    return HISTORY_FEATURES + KNOWN_AHEAD + [name for name, _ in _one_hot(values)]


def model_frame(panel: DataFrame, calendar: DataFrame, inventory: DataFrame) -> DataFrame:
    """Keys, target, numeric features and the category of each panel row.

    History comes first, on a panel pruned to the columns in use.  The category
    follows while rows are still placed by series; the calendar, bounded by
    warehouses times days, comes last.
    """
    used = panel.select("unique_id", "date", "warehouse", "sales", "sell_price_main", *DISCOUNTS)
    frame = with_discount_total(with_history(used)).drop(*DISCOUNTS)
    frame = with_date_parts(with_calendar(with_category(frame, inventory), calendar))
    return frame.select("unique_id", "date", "warehouse", "sales", CATEGORY, *HISTORY_FEATURES, *KNOWN_AHEAD)


def feature_frame(
    panel: DataFrame, calendar: DataFrame, inventory: DataFrame, values: dict[str, Sequence[str]]
) -> DataFrame:
    """The model's frame with 0/1 columns for the known warehouses and categories (see ``categories``)."""
    frame = with_one_hot(model_frame(panel, calendar, inventory), values)
    return frame.select("unique_id", "date", "warehouse", "sales", *feature_columns(values))


def split_label(date: Column, last_day: Column) -> Column:
    """Train, validation (28 days) or holdout (the last 28 days)."""
    cutoff = F.date_sub(last_day, HORIZON_DAYS - 1)
    return (
        F.when(date >= cutoff, "holdout")
        .when(date >= F.date_sub(cutoff, HORIZON_DAYS), "validation")
        .when(date.isNotNull(), "train")
    )


def last_day(panel: DataFrame) -> Column:
    """The panel's last date as a scalar subquery; the plan stays lazy."""
    return panel.agg(F.max("date")).scalar()


def temporal_split(panel: DataFrame) -> DataFrame:
    return panel.withColumn("split", split_label(F.col("date"), last_day(panel)))


def history_and_holdout(panel: DataFrame, last: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """The days before the last ``HORIZON_DAYS``, and these; ``last`` is the panel's last day unless given."""
    cutoff = F.date_sub(last_day(panel) if last is None else last, HORIZON_DAYS - 1)
    return panel.filter(F.col("date") < cutoff), since(panel, cutoff)


def leak_audit(
    panel: DataFrame, values: dict[str, Sequence[str]],
    lags: Sequence[int] = LAGS, windows: Sequence[int] = ROLLING_WINDOWS, shift: int = LAG_SHIFT,
    state: DataFrame | None = None, last: Column | None = None,
) -> DataFrame:
    """Count the holdout rows whose features read sales of the holdout; one row per feature.

    History features are built together with the latest day that each of them
    reads, through the same windows; all others read no sales.  One pass over
    the panel's keys and sales; over its recent periods, with the ``state``
    carried over from earlier ones.
    """
    cutoff = F.date_sub(last_day(panel) if last is None else last, HORIZON_DAYS - 1)
    history = history_names(lags, windows, shift)
    options = {"lags": lags, "windows": windows, "shift": shift, "read_days": True}
    if state is None:
        read = with_history(panel.select("unique_id", "date", "sales"), **options).filter(F.col("date") >= cutoff)
    else:
        read = recent_history(panel, state, cutoff, **options)
    names = [*history, *(n for n in feature_columns(values) if n not in HISTORY_FEATURES)]
    leaks = {n: F.count_if(F.col(f"{n}_read") >= F.unix_date(cutoff)) for n in history}
    audited = [
        F.struct(F.lit(n).alias("feature"), leaks.get(n, F.lit(0).cast("bigint")).alias("n_changed"), F.count(F.lit(1)).alias("n_rows")) for n in names
    ]
    return read.agg(F.array(*audited).alias("audit")).select(F.inline("audit"))


def leak_trial(
    panel: DataFrame, calendar: DataFrame, inventory: DataFrame, values: dict[str, Sequence[str]], spike: float = 1e6
) -> DataFrame:
    """The audit by experiment: spike the holdout's sales and count the holdout features that change.

    It builds the feature frame twice and joins the two; for checking :func:`leak_audit`.
    """
    cutoff = F.date_sub(last_day(panel), HORIZON_DAYS - 1)
    spiked = panel.withColumn("sales", F.when(F.col("date") >= cutoff, F.lit(spike)).otherwise(F.col("sales")))
    names = feature_columns(values)

    def holdout(source: DataFrame, alias: str) -> DataFrame:
        frame = feature_frame(source, calendar, inventory, values).filter(F.col("date") >= cutoff)
        return frame.select("unique_id", "date", F.struct(*names).alias(alias))

    both = holdout(panel, "plain").join(holdout(spiked, "spiked"), ["unique_id", "date"], "full")
    changed = [
        F.struct(
            F.lit(name).alias("feature"),
            F.count_if(~F.col(f"plain.{name}").eqNullSafe(F.col(f"spiked.{name}"))).alias("n_changed"),
            F.count(F.lit(1)).alias("n_rows"),
        )
        for name in names
    ]
    return both.agg(F.array(*changed).alias("audit")).select(F.inline("audit"))
