"""A loaded set of tables for one data folder.

The panel is derived once per application and kept as a table in the shared
folder, divided by periods of days and, within each, bucketed by series: the
per-series windows, duplicate checks and series aggregates that read it need no
shuffle of the panel, and questions about recent days read recent periods only.
Everything smaller is a plain Parquet copy.
"""

from __future__ import annotations

import hashlib
import math
from functools import cached_property

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..operators import baselines, boosting, features, quality, replenish, risk
from ..operators.features import history_and_holdout
from ..operators.timeline import PERIODS, last_known
from ..session import settle, shared_folder
from ..sources import layout
from ..sources import panel as derive
from ..sources.scan import scan_parquet
from ..sources.tables import ORDER_TABLES, TABLES

# The published settings.
BOOSTING = boosting.BoostingParams()

# Panel rows per bucket file, and the fewest buckets.
ROWS_PER_BUCKET = 20_000_000
FEWEST_BUCKETS = 8
# Rows of a bucket in a month from which months, not years, divide the panel: smaller files cost more than they save.
ROWS_PER_MONTH = 200_000

_open: dict[tuple[str, str, str], "Warehouse"] = {}
_summed: dict[tuple[str, str], tuple[DataFrame, DataFrame]] = {}


def open_warehouse(spark: SparkSession, sf_dir: str, grain: str = "dense") -> "Warehouse":
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), grain)
    if key not in _open:
        _open[key] = Warehouse(spark, sf_dir.rstrip("/"), grain)
    return _open[key]


class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str, grain: str):
        self.spark, self.sf_dir, self.grain = spark, sf_dir, grain

    def raw(self, name: str) -> DataFrame:
        return scan_parquet(self.spark, ORDER_TABLES[name], f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def _lines(self) -> tuple[DataFrame, DataFrame]:
        """Order cells and volumes, read from the lines once for both grains."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir)
        if key not in _summed:
            cells = settle(derive.order_cells(self.spark, self.sf_dir), "order-cells")
            _summed[key] = cells, settle(derive.order_volume(self.spark, self.sf_dir), "order-volume")
        return _summed[key]

    def _buckets(self, rows: int, series: int) -> int:
        """From the panel's own size; more buckets than series would stay empty."""
        return max(FEWEST_BUCKETS, min(series, math.ceil(rows / ROWS_PER_BUCKET)))

    @cached_property
    def _derived(self) -> DataFrame:
        return settle(derive.panel_of(*self._lines, self.grain), "derived-panel")

    @cached_property
    def _facts(self) -> Row:
        """Rows, series, months and last day of the panel, known since it was loaded."""
        by_series = self._derived.groupBy("unique_id").agg(F.count("*").alias("n"), F.min("date").alias("low"), F.max("date").alias("high"))
        months = F.months_between(F.trunc(F.max("high"), "MM"), F.trunc(F.min("low"), "MM")) + 1
        return by_series.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("*").alias("series"), F.coalesce(months, F.lit(1.0)).cast("int").alias("months"),
            F.max("high").alias("last_day")).first()

    @cached_property
    def last_day(self) -> Column:
        return F.lit(self._facts.last_day).cast("date")

    @cached_property
    def dated_panel(self) -> DataFrame:
        """The panel with the column of its periods (see ``timeline.PERIODS``)."""
        # One name for each data folder and grain: a later application replaces the table, none pile up.
        name = f"larder_panel_{self.grain}_{hashlib.sha256(self.sf_dir.encode()).hexdigest()[:32]}"
        facts = self._facts
        buckets = self._buckets(facts.rows, facts.series)
        period = "month_start" if facts.rows / buckets / facts.months >= ROWS_PER_MONTH else "year_start"
        (
            self._derived.withColumn(period, F.trunc("date", PERIODS[period]))
            .repartition(buckets, "unique_id")
            .write.partitionBy(period)
            .bucketBy(buckets, "unique_id")
            .sortBy("unique_id", "date")
            .mode("overwrite")
            .option("path", f"{shared_folder(self.spark)}/{name}")
            .saveAsTable(name)
        )
        return self.spark.table(name)

    @cached_property
    def panel(self) -> DataFrame:
        return self.dated_panel.select(*TABLES["sales_train"].columns)

    @cached_property
    def carried(self) -> DataFrame:
        """Last known sales of each series and period; with it, recent history needs recent periods only."""
        return settle(last_known(self.dated_panel), "carried-state")

    @cached_property
    def inventory(self) -> DataFrame:
        return settle(derive.derive_inventory(self.panel, self.grain), "inventory")

    @cached_property
    def calendar(self) -> DataFrame:
        return settle(derive.derive_calendar(self.panel), "calendar")

    @cached_property
    def weights(self) -> DataFrame:
        return settle(derive.derive_weights(self.inventory), "weights")

    @cached_property
    def sales_ahead(self) -> DataFrame:
        return settle(derive.derive_sales_ahead(self.panel), "sales_ahead")

    # Stage results, each written once and read by the stages after it.

    @cached_property
    def split(self) -> tuple[DataFrame, DataFrame]:
        columns = TABLES["sales_train"].columns
        return tuple(part.select(*columns) for part in history_and_holdout(self.dated_panel, self.last_day))

    @cached_property
    def profile(self) -> DataFrame:
        return settle(baselines.series_profile(self.split[0]), "profile")

    def moving_average(self) -> DataFrame:
        holdout = self.split[1]
        return baselines.moving_average(self.profile, baselines.horizon_dates(holdout), holdout)

    def seasonal_naive(self) -> DataFrame:
        holdout = self.split[1]
        return baselines.seasonal_naive(self.profile, baselines.horizon_dates(holdout), holdout)

    @cached_property
    def forecasts(self) -> DataFrame:
        return settle(self.moving_average(), "forecasts", layout.FORECASTS)

    def availability(self) -> DataFrame:
        return risk.recent_availability(self.dated_panel, self.forecasts.agg(F.min("date")).scalar())

    def score_risk(self) -> DataFrame:
        scored = risk.stockout_risk(self.forecasts, self.availability())
        return risk.with_product(scored, self.inventory)

    @cached_property
    def risk(self) -> DataFrame:
        return settle(self.score_risk(), "risk", layout.RISK)

    @cached_property
    def recommendations(self) -> DataFrame:
        return settle(replenish.recommendations(self.risk), "recommendations", layout.RECOMMENDATIONS)

    @cached_property
    def one_hot_values(self) -> dict[str, list[str]]:
        sold = self.inventory
        return {
            "warehouse": features.categories(sold, "warehouse"),
            features.CATEGORY: features.categories(sold, features.CATEGORY),
        }

    @cached_property
    def features(self) -> DataFrame:
        return settle(
            features.model_frame(self.panel, self.calendar, self.inventory), "features"
        )

    @cached_property
    def boosted(self) -> boosting.BoostedForecast:
        fitted = boosting.boosted_forecast(self.features, self.inventory, BOOSTING)
        if not fitted.stopped:
            raise boosting.RoundsExhausted(f"no rest within {BOOSTING.max_rounds} rounds")
        return fitted

    @cached_property
    def boosted_predictions(self) -> DataFrame:
        return settle(self.boosted.predictions, "boosted")

    @cached_property
    def quality_report(self) -> DataFrame:
        return settle(quality.full_report(self.tables(), TABLES), "quality")

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in TABLES}

    def table(self, name: str) -> DataFrame:
        attribute = {
            "sales_train": "panel",
            "sales_test": "sales_ahead",
            "inventory": "inventory",
            "calendar": "calendar",
            "test_weights": "weights",
        }[name]
        return getattr(self, attribute)
