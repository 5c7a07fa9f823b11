"""Demand questions over the panel.

Order volume (``total_orders``) belongs to the warehouse-day but is repeated on
product rows, so it is averaged per warehouse-day before it is summed or
averaged further.  Sales of the same cells are summed in the same pass, which
leaves one aggregation by (warehouse, date) and one over its small result; no
question joins two aggregates of the panel.

Product attributes are joined after aggregating per series: what is shuffled
is one row per series, never the panel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import band, half_up, mean_of, ratio, sum_skipping_nulls
from ..sources.tables import DISCOUNTS
from .timeline import since

LOW_AVAILABILITY = 0.5
FULL_AVAILABILITY = 0.95


def warehouse_days(panel: DataFrame) -> DataFrame:
    """Panel rolled up to one row per warehouse and day."""
    ordered = F.col("total_orders") > 0
    return panel.groupBy("warehouse", "date").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("sales").alias("units"),
        F.count("sales").alias("n_sales"),
        F.sum("total_orders").alias("order_rows_total"),
        F.count("total_orders").alias("n_order_rows"),
        F.avg("total_orders").alias("orders"),
        F.avg(F.when(ordered, F.col("total_orders"))).alias("positive_orders"),
    )


def _count(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def top_warehouses(panel: DataFrame) -> DataFrame:
    """Units, orders and units per order of each warehouse, largest first."""
    per_warehouse = (
        warehouse_days(panel)
        .groupBy("warehouse")
        .agg(
            F.count("date").alias("days_covered"),
            F.sum("units").alias("units"),
            F.sum("orders").alias("orders"),
        )
    )
    return per_warehouse.select(
        "warehouse",
        "days_covered",
        half_up(F.col("units"), 0).alias("total_units_sold"),
        half_up(F.col("orders"), 0).alias("total_orders"),
        half_up(ratio(F.col("units"), F.col("orders")), 3).alias("units_per_order"),
    ).orderBy(F.desc_nulls_last("total_units_sold"), "warehouse")


def _per_series(panel: DataFrame) -> DataFrame:
    return panel.groupBy("unique_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("sales").alias("units"),
        F.count("sales").alias("n_sales"),
        F.avg("sales").alias("mean_sales"),
        F.var_pop("sales").alias("variance"),
        F.sum("sell_price_main").alias("price_total"),
        F.count("sell_price_main").alias("n_prices"),
    )


def top_skus(panel: DataFrame, inventory: DataFrame, limit: int = 30) -> DataFrame:
    """Best-selling product names by warehouse with their mean price."""
    named = _per_series(panel).join(inventory, "unique_id")
    return (
        named.groupBy("name", "warehouse", "l1_category_name_en")
        .agg(
            half_up(F.sum("units"), 0).alias("total_units"),
            half_up(mean_of(F.sum("price_total"), F.sum("n_prices")), 2).alias("avg_price"),
        )
        .orderBy(F.desc_nulls_last("total_units"), "name", "warehouse", "l1_category_name_en")
        .limit(limit)
    )


def volatile_skus(
    panel: DataFrame, inventory: DataFrame, min_units: float = 1000, limit: int = 30
) -> DataFrame:
    """Highest coefficient of variation among products of enough volume.

    Series sharing a name are pooled from their counts, means and variances.
    """
    n, mean = F.col("n_sales"), F.col("mean_sales")
    pooled = (
        _per_series(panel)
        .join(inventory, "unique_id")
        .groupBy("name", "warehouse")
        .agg(
            F.sum("n_rows").alias("n_days"),
            F.sum("units").alias("units"),
            F.sum("n_sales").alias("n"),
            F.sum(n * F.col("variance")).alias("within"),
            F.sum(n * mean * mean).alias("squares"),
        )
        .filter(F.col("units") > min_units)
        .withColumn("mean", mean_of(F.col("units"), F.col("n")))
    )
    between = F.greatest(F.col("squares") - F.col("n") * F.col("mean") * F.col("mean"), F.lit(0.0))
    deviation = F.sqrt(ratio(F.col("within") + between, F.col("n")))
    return (
        pooled.withColumn("deviation", deviation)
        .select(
            "name",
            "warehouse",
            "n_days",
            half_up(F.col("units"), 0).alias("total_units"),
            half_up(F.col("mean"), 2).alias("mean_daily_sales"),
            half_up(F.col("deviation"), 2).alias("sd_daily_sales"),
            half_up(ratio(F.col("deviation"), F.col("mean")), 3).alias("coeff_of_variation"),
        )
        .orderBy(F.desc_nulls_last("coeff_of_variation"), "name", "warehouse")
        .limit(limit)
    )


def weekday_profile(panel: DataFrame) -> DataFrame:
    """Mean sales per product row and mean orders per warehouse-day, 0 = Sunday."""
    return (
        warehouse_days(panel)
        .groupBy((F.dayofweek("date") - 1).alias("day_of_week"))
        .agg(
            F.sum("n_rows").alias("n_observations"),
            half_up(mean_of(F.sum("units"), F.sum("n_sales")), 2).alias("avg_daily_sales_per_sku"),
            half_up(F.avg("orders"), 0).alias("avg_daily_orders_per_wh"),
        )
        .orderBy("day_of_week")
    )


def holiday_sales(panel: DataFrame, calendar: DataFrame, min_rows: int = 500) -> DataFrame:
    """Mean sales on each named holiday.

    The uplift column compares against non-holiday rows of the same, holiday
    only, selection and is therefore always NULL; ``holiday_uplift`` has the
    comparison that was meant.
    """
    named = calendar.filter((F.col("holiday") == 1) & F.col("holiday_name").isNotNull())
    ordinary = F.when(F.col("holiday") == 0, F.col("units"))
    ordinary_rows = F.when(F.col("holiday") == 0, F.col("n_sales"))
    mean = mean_of(F.sum("units"), F.sum("n_sales"))
    return (
        warehouse_days(panel)
        .join(named.select("warehouse", "date", "holiday_name", "holiday"), ["warehouse", "date"])
        .groupBy("holiday_name")
        .agg(
            F.sum("n_rows").alias("n_observations"),
            half_up(mean, 2).alias("avg_sales_on_holiday"),
            half_up(ratio(mean, mean_of(F.sum(ordinary), F.sum(ordinary_rows))) - 1, 3).alias(
                "uplift_vs_nonholiday"
            ),
        )
        .filter(F.col("n_observations") >= min_rows)
        .orderBy(F.desc("n_observations"), "holiday_name")
    )


def holiday_uplift(panel: DataFrame, calendar: DataFrame, min_rows: int = 500) -> DataFrame:
    """Holiday sales against non-holiday sales of the warehouses that had it."""
    days = warehouse_days(panel).join(
        calendar.select("warehouse", "date", "holiday_name", "holiday"), ["warehouse", "date"]
    )
    ordinary = (
        days.filter(F.col("holiday") == 0)
        .groupBy("warehouse")
        .agg(F.sum("units").alias("base_units"), F.sum("n_sales").alias("base_n"))
    )
    observed = (
        days.filter((F.col("holiday") == 1) & F.col("holiday_name").isNotNull())
        .groupBy("holiday_name", "warehouse")
        .agg(
            F.sum("n_rows").alias("n_rows"),
            F.sum("units").alias("units"),
            F.sum("n_sales").alias("n_sales"),
        )
    )
    mean = mean_of(F.sum("units"), F.sum("n_sales"))
    base = mean_of(F.sum("base_units"), F.sum("base_n"))
    return (
        observed.join(ordinary, "warehouse", "left")
        .groupBy("holiday_name")
        .agg(
            F.sum("n_rows").alias("n_observations"),
            half_up(mean, 2).alias("avg_sales_on_holiday"),
            half_up(base, 2).alias("avg_sales_nonholiday"),
            half_up(ratio(mean, base) - 1, 3).alias("uplift_vs_nonholiday"),
        )
        .filter(F.col("n_observations") >= min_rows)
        .orderBy(F.desc("n_observations"), "holiday_name")
    )


def closure_impact(panel: DataFrame, calendar: DataFrame) -> DataFrame:
    """Sales and orders, both weighted by product rows, by shop closure."""
    return (
        warehouse_days(panel)
        .join(calendar.select("warehouse", "date", "shops_closed"), ["warehouse", "date"])
        .groupBy("shops_closed")
        .agg(
            F.sum("n_rows").alias("n_observations"),
            half_up(mean_of(F.sum("units"), F.sum("n_sales")), 2).alias("avg_sales_per_sku"),
            half_up(mean_of(F.sum("order_rows_total"), F.sum("n_order_rows")), 0).alias("avg_orders"),
        )
        .orderBy("shops_closed")
    )


def promotion_effect(panel: DataFrame) -> DataFrame:
    """Sales and price with and without any discount; unknown flags stay NULL."""
    flag = F.col(DISCOUNTS[0]) > 0
    for name in DISCOUNTS[1:]:
        flag = flag | (F.col(name) > 0)
    return (
        panel.groupBy(flag.alias("any_promo"))
        .agg(
            F.count(F.lit(1)).alias("n_observations"),
            half_up(F.avg("sales"), 2).alias("avg_sales_per_sku"),
            half_up(F.avg("sell_price_main"), 2).alias("avg_list_price"),
        )
        .orderBy("any_promo")
    )


# Band edges and labels of the discount, price and coverage reports.
DISCOUNT_BANDS = [(0.10, "1_shallow"), (0.25, "2_moderate"), (0.50, "3_deep")]
NO_DISCOUNT, DEEPEST_DISCOUNT = "0_no_promo", "4_very_deep"
PRICE_BANDS = [(2, "a_under_2"), (5, "b_2_to_5"), (15, "c_5_to_15"), (50, "d_15_to_50")]
HIGHEST_PRICE = "e_over_50"
COVERAGE_BANDS = [(30, "a_under_30d"), (180, "b_under_180d"), (730, "c_under_2y")]
FULL_COVERAGE = "d_full_history"


def discount_depth(panel: DataFrame) -> DataFrame:
    """Mean sales by band of summed discount; rows with a corrupt one are out."""
    valid = F.col(DISCOUNTS[0]).between(0, 1)
    for name in DISCOUNTS[1:]:
        valid = valid & F.col(name).between(0, 1)
    total = sum_skipping_nulls(DISCOUNTS)
    label = F.when(total <= 0, F.lit(NO_DISCOUNT)).otherwise(band(total, DISCOUNT_BANDS, DEEPEST_DISCOUNT))
    return (
        panel.filter(valid)
        .groupBy(label.alias("discount_band"))
        .agg(
            F.count(F.lit(1)).alias("n_observations"),
            half_up(F.avg("sales"), 2).alias("avg_sales_per_sku"),
        )
        .orderBy("discount_band")
    )


def monthly_trend(panel: DataFrame) -> DataFrame:
    return (
        warehouse_days(panel)
        .groupBy("warehouse", F.trunc("date", "MM").alias("month"))
        .agg(
            half_up(F.sum("units"), 0).alias("monthly_units"),
            half_up(F.avg("orders"), 0).alias("avg_daily_orders"),
        )
        .orderBy("warehouse", "month")
    )


def category_demand(panel: DataFrame, inventory: DataFrame) -> DataFrame:
    series = _per_series(panel).join(inventory.select("unique_id", "l1_category_name_en"), "unique_id")
    return (
        series.groupBy(F.coalesce("l1_category_name_en", F.lit("UNKNOWN")).alias("category"))
        .agg(
            F.count("unique_id").alias("n_products"),
            half_up(F.sum("units"), 0).alias("total_units"),
            half_up(mean_of(F.sum("price_total"), F.sum("n_prices")), 2).alias("avg_price"),
        )
        .orderBy(F.desc_nulls_last("total_units"), "category")
    )


def _availability_by_series(panel: DataFrame) -> DataFrame:
    return panel.groupBy("warehouse", "unique_id").agg(
        _count(F.col("availability") < LOW_AVAILABILITY).alias("low_rows"),
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("availability").alias("availability_total"),
        F.count("availability").alias("n_availability"),
        F.sum("sales").alias("units"),
    )


def stockout_exposure(panel: DataFrame, inventory: DataFrame, limit: int = 25) -> DataFrame:
    """Warehouse and category cells with the most low-availability rows."""
    category = inventory.select("unique_id", F.col("l1_category_name_en").alias("category"))
    return (
        _availability_by_series(panel)
        .join(category, "unique_id")
        .groupBy("warehouse", "category")
        .agg(
            F.sum("low_rows").alias("low_availability_rows"),
            F.sum("n_rows").alias("n_rows"),
            half_up(mean_of(F.sum("availability_total"), F.sum("n_availability")), 3).alias(
                "avg_availability"
            ),
        )
        .orderBy(F.desc("low_availability_rows"), "warehouse", "category")
        .limit(limit)
    )


def lost_sales(panel: DataFrame) -> DataFrame:
    """Units short of each series' own unconstrained mean on constrained days.

    Series that were never fully available have no such mean and drop out.
    """
    usual = (
        panel.filter(F.col("availability") >= FULL_AVAILABILITY)
        .groupBy("unique_id")
        .agg(F.avg("sales").alias("usual_sales"))
    )
    short = F.greatest(F.col("usual_sales") - F.col("sales"), F.lit(0.0))
    return (
        panel.filter(F.col("availability") < LOW_AVAILABILITY)
        .join(usual, "unique_id")
        .groupBy("warehouse")
        .agg(half_up(F.sum(short), 0).alias("estimated_lost_units"))
        .orderBy(F.desc_nulls_last("estimated_lost_units"), "warehouse")
    )


def coverage_bands(panel: DataFrame) -> DataFrame:
    """Number of series by length of history."""
    return (
        panel.groupBy("unique_id")
        .agg(F.count(F.lit(1)).alias("n_days"))
        .groupBy(band(F.col("n_days"), COVERAGE_BANDS, FULL_COVERAGE).alias("coverage_band"))
        .agg(F.count(F.lit(1)).alias("n_products"))
        .orderBy("coverage_band")
    )


def assortment_churn(panel: DataFrame) -> DataFrame:
    """Number of series by the quarter of their first row."""
    return (
        panel.groupBy("unique_id")
        .agg(F.min("date").alias("first_day"))
        .groupBy(F.trunc("first_day", "quarter").alias("quarter"))
        .agg(F.count(F.lit(1)).alias("n_products_introduced"))
        .orderBy("quarter")
    )


def high_risk_skus(
    panel: DataFrame,
    inventory: DataFrame,
    as_of: Column | None = None,
    days: int = 32,
    min_velocity: float = 10,
    limit: int = 40,
) -> DataFrame:
    """Fast movers with low-availability days in the last days before ``as_of``.

    ``as_of`` is the panel's last date unless given.  Only the recent window is
    read: a series without recent rows has no velocity and cannot qualify.
    """
    if as_of is None:
        as_of = panel.agg(F.max("date")).scalar()
    recent = (
        since(panel, F.date_sub(as_of, days - 1))
        .groupBy("unique_id", "warehouse")
        .agg(
            F.avg("sales").alias("velocity"),
            F.avg("availability").alias("availability"),
            _count(F.col("availability") < LOW_AVAILABILITY).alias("low_avail_days"),
        )
        .filter((F.col("velocity") > min_velocity) & (F.col("low_avail_days") > 0))
    )
    return (
        recent.join(inventory.select("unique_id", "name"), "unique_id")
        .select(
            "unique_id",
            "name",
            "warehouse",
            half_up(F.col("velocity"), 2).alias("recent_daily_velocity"),
            half_up(F.col("availability"), 3).alias("recent_availability"),
            "low_avail_days",
        )
        .orderBy(F.desc("low_avail_days"), F.desc("recent_daily_velocity"), "unique_id", "warehouse")
        .limit(limit)
    )


def price_bands(panel: DataFrame) -> DataFrame:
    price = F.col("sell_price_main")
    return (
        panel.filter(price > 0)
        .groupBy(band(price, PRICE_BANDS, HIGHEST_PRICE).alias("price_band"))
        .agg(
            F.count(F.lit(1)).alias("n_observations"),
            half_up(F.avg("sales"), 2).alias("avg_daily_sales_per_sku"),
        )
        .orderBy("price_band")
    )


def units_per_order_trend(panel: DataFrame) -> DataFrame:
    """Units per order by warehouse and quarter that had any orders."""
    return (
        warehouse_days(panel)
        .groupBy("warehouse", F.trunc("date", "quarter").alias("quarter"))
        .agg(F.sum("units").alias("units"), F.sum("positive_orders").alias("orders"))
        .filter(F.col("orders").isNotNull())
        .select(
            "warehouse",
            "quarter",
            half_up(ratio(F.col("units"), F.col("orders")), 3).alias("units_per_order"),
        )
        .orderBy("quarter", "warehouse")
    )


def warehouse_overview(panel: DataFrame) -> DataFrame:
    """Products, units and mean availability of each warehouse."""
    mean = mean_of(F.sum("availability_total"), F.sum("n_availability"))
    return (
        _availability_by_series(panel)
        .groupBy("warehouse")
        .agg(
            F.count("unique_id").alias("products"),
            F.sum("units").alias("total_units"),
            mean.cast("decimal(4,3)").cast("double").alias("avg_availability"),
        )
        .orderBy(F.desc_nulls_last("total_units"), "warehouse")
    )


def constrained_days(panel: DataFrame) -> DataFrame:
    """Mean availability and low-availability product days of each warehouse."""
    return (
        panel.groupBy("warehouse")
        .agg(
            F.avg("availability").cast("decimal(4,3)").cast("double").alias("avg_availability"),
            _count(F.col("availability") < LOW_AVAILABILITY).alias("constrained_days"),
        )
        .orderBy("avg_availability", "warehouse")
    )
