"""The sales panel and its dimensions, derived from order-line tables.

A series is a product group in a region ("warehouse").  Two grains exist:
``dense`` groups parts by type, ``sparse`` by type and brand.

The panel is an aggregate by (unique_id, date) of the order lines, so each
series has at most one row per calendar day; every per-series window in the
package relies on that bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import half_up
from .scan import scan_parquet, select_declared
from .tables import CALENDAR, DISCOUNTS, INVENTORY, ORDER_TABLES, SALES, SALES_AHEAD, WEIGHTS

PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
CATALOGUE_ONLY_IDS = (900001, 900002)
HORIZON_DAYS = 28


def _series_id(grain: str) -> Column:
    type_index = F.array_position(F.lit(PART_TYPES), F.col("p_type")) - 1
    region = F.col("r_regionkey").cast("long")
    if grain == "dense":
        return region * 100 + type_index
    brand = F.regexp_extract("p_brand", r"(\d+)$", 1).cast("long")
    return region * 10000 + type_index * 100 + brand


def _scan(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return scan_parquet(spark, ORDER_TABLES[name], f"{sf_dir}/{name}.parquet")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _scan(spark, sf_dir, "lineitem")
    return lines.withColumn("date", F.col("l_shipdate").cast("date"))


def _in_regions(lines: DataFrame, sf_dir: str) -> DataFrame:
    """Lines with the supplier's region.

    One table at a time, the lines always on the left: the planner compares
    each dimension by its own size and broadcasts it only while it is small.
    """
    spark = lines.sparkSession
    supplier = _scan(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = _scan(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = _scan(spark, sf_dir, "region")
    return (
        lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .withColumn("warehouse", F.col("r_name"))
    )


def order_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines summed up per region, part type, brand and day, the finest grain in use.

    Sums, counts and maxima only, so coarser grains are sums of these rows and
    the lines need not be read again.
    """
    part = _scan(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    lines = _in_regions(_lines(spark, sf_dir), sf_dir).join(part, F.col("l_partkey") == F.col("p_partkey"))
    return lines.groupBy("warehouse", "r_regionkey", "p_type", "p_brand", "date").agg(
        F.expr("sum(l_quantity) AS quantity"),
        F.expr("max(l_extendedprice / l_quantity) AS top_price"),
        F.expr("sum(IF(l_returnflag = 'R', 0D, 1D)) AS kept_lines"),
        F.expr("count(1) AS n_lines"),
        *[F.expr(f"max(l_discount + 0D) FILTER (WHERE l_linenumber % 7 = {i}) AS {n}") for i, n in enumerate(DISCOUNTS)],
    )


def order_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct orders per warehouse and day, over all products."""
    lines = _in_regions(_lines(spark, sf_dir), sf_dir)
    return lines.groupBy("warehouse", "date").agg(F.count_distinct("l_orderkey").alias("orders"))


def derive_panel(spark: SparkSession, sf_dir: str, grain: str) -> DataFrame:
    """The panel straight from the order lines."""
    return panel_of(order_cells(spark, sf_dir), order_volume(spark, sf_dir), grain)


def panel_of(order_cells: DataFrame, volume: DataFrame, grain: str) -> DataFrame:
    """One row per series and day with sales, price, availability, discounts.

    Fixed shares of rows carry a null target or a corrupt discount, so the
    quality checks and the null rules downstream have something to find.
    """
    cells = order_cells.withColumn("unique_id", _series_id(grain)).groupBy("unique_id", "date", "warehouse").agg(
        F.expr("sum(quantity) AS quantity"),
        F.expr("max(top_price) AS top_price"),
        F.expr("sum(kept_lines) / sum(n_lines) AS availability"),
        *[F.expr(f"coalesce(max({name}), 0D) AS {name}") for name in DISCOUNTS],
    )
    lost = "(unique_id * 31 + unix_date(date)) % 997 = 0"
    corrupt = "(unique_id * 17 + unix_date(date)) % 4999 = 0"
    panel = cells.join(volume, ["warehouse", "date"]).withColumns(
        {
            "sales": F.expr(f"IF({lost}, NULL, quantity)"),
            "total_orders": F.expr(f"IF({lost}, NULL, orders + unique_id % 2 * 0.5D)"),
            "sell_price_main": half_up(F.expr("top_price / 500D"), 2),
            "type_0_discount": F.expr(f"IF({corrupt}, -0.5D, type_0_discount)"),
        }
    )
    return select_declared(panel, SALES)


def derive_inventory(panel: DataFrame, grain: str) -> DataFrame:
    """One row per series, plus two catalogue entries that never sold.

    The series id spells out region, type and brand, so the distinct ids of
    the loaded panel are enough and the order lines are not read again.
    """
    factor = 100 if grain == "dense" else 10000
    type_index = "unique_id % 100" if grain == "dense" else "unique_id % 10000 div 100"
    brand = "CAST(NULL AS STRING)" if grain == "dense" else "concat('Brand#', unique_id % 100)"
    types = ", ".join(f"'{t}'" for t in PART_TYPES)
    series = (
        panel.select("unique_id", "warehouse")
        .distinct()
        .selectExpr(
            "unique_id",
            f"unique_id % {factor} AS product_unique_id",
            f"element_at(array({types}), CAST({type_index} + 1 AS INT)) AS l1_category_name_en",
            f"{brand} AS l2_category_name_en",
            "CAST(NULL AS STRING) AS l3_category_name_en",
            "CAST(NULL AS STRING) AS l4_category_name_en",
            "warehouse",
        )
        .withColumn("name", F.concat_ws("_", "l1_category_name_en", "l2_category_name_en"))
    )
    ids = ", ".join(f"{i}L" for i in CATALOGUE_ONLY_IDS)
    unsold = (
        panel.agg(F.min("warehouse").alias("warehouse"))
        .selectExpr("warehouse", f"explode(array({ids})) AS unique_id")
        .selectExpr(
            "unique_id",
            "unique_id % 100000 AS product_unique_id",
            "concat('UNSOLD_', unique_id) AS name",
            *[f"CAST(NULL AS STRING) AS l{i}_category_name_en" for i in (1, 2, 3, 4)],
            "warehouse",
        )
    )
    return select_declared(series.unionByName(unsold), INVENTORY)


# The holidays of the derived calendar by month and day.
HOLIDAYS = {"01-01": "New Year", "05-01": "Labour Day", "12-25": "Christmas"}
OPEN_HOLIDAY = "Labour Day"


def derive_calendar(panel: DataFrame) -> DataFrame:
    """Every warehouse and day of the panel's range with holiday flags."""
    every_day = panel.agg(F.sequence(F.min("date"), F.max("date"))).scalar()
    names = " ".join(f"WHEN '{day}' THEN '{name}'" for day, name in HOLIDAYS.items())
    calendar = (
        panel.select("warehouse")
        .distinct()
        .withColumn("date", F.explode(every_day))
        .withColumn("holiday_name", F.expr(f"CASE date_format(date, 'MM-dd') {names} END"))
        .selectExpr(
            "date",
            "holiday_name",
            "int(holiday_name IS NOT NULL) AS holiday",
            f"int(coalesce(holiday_name, '{OPEN_HOLIDAY}') <> '{OPEN_HOLIDAY}') AS shops_closed",
            "int(month(date) = 12 AND dayofmonth(date) >= 24) AS winter_school_holidays",
            "int(month(date) IN (7, 8)) AS school_holidays",
            "warehouse",
        )
    )
    return select_declared(calendar, CALENDAR)


def derive_weights(inventory: DataFrame) -> DataFrame:
    sold = inventory.filter(~F.col("unique_id").isin(*CATALOGUE_ONLY_IDS))
    return select_declared(sold.withColumn("weight", F.lit(1.0) + F.col("unique_id") % 5), WEIGHTS)


def derive_sales_ahead(panel: DataFrame) -> DataFrame:
    """The last 28 days moved 28 days ahead, without the observed outcomes."""
    last = panel.agg(F.max("date")).scalar()
    recent = panel.filter(F.col("date") > F.date_sub(last, HORIZON_DAYS))
    return select_declared(recent.withColumn("date", F.date_add("date", HORIZON_DAYS)), SALES_AHEAD)
