"""Loading tables: source profiles, dimension seeding, verified copies."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import snapshots
from .artifacts import MissingArtifact

LOADED, SKIPPED, NEEDS_FORCE = "loaded", "skipped", "needs_force"
STATUS_SCHEMA = "table_name string, expected_rows long, actual_rows long, outcome string"


class LoadMismatch(RuntimeError):
    """The written table has another row count than its source."""


class LoadRefused(RuntimeError):
    """Stored tables differ from their sources and may not be replaced."""


class OrphanRows(RuntimeError):
    """Fact rows refer to keys the dimension does not hold."""


def source_profile(df: DataFrame, table: str) -> DataFrame:
    """Row count and number of distinct non-empty warehouses of one source.

    Counted per warehouse first: one pass, and a few rows to combine.
    """
    named = F.col("warehouse") if "warehouse" in df.columns else F.lit(None).cast("string")
    per_warehouse = df.groupBy(named.alias("warehouse")).agg(F.count(F.lit(1)).alias("n"))
    return per_warehouse.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count_if(F.col("warehouse") != "").alias("n_warehouses"),
    ).select(F.lit(table).alias("table_name"), "n_rows", "n_warehouses")


def new_members(sources: list[DataFrame], dimension: DataFrame, column: str = "warehouse") -> DataFrame:
    """Distinct non-empty values of all sources that the dimension lacks."""
    found = None
    for source in sources:
        values = source.select(column).distinct()
        found = values if found is None else found.unionByName(values)
    found = found.filter(F.col(column).isNotNull() & (F.col(column) != "")).distinct()
    return found.join(dimension.select(column), column, "left_anti")


def seed_dimension(sources: list[DataFrame], path: str, column: str = "warehouse") -> int:
    """Append the members that the stored dimension lacks; how many these were.

    Nothing stored yet counts as an empty dimension.  A second run with the
    same sources inserts none.
    """
    spark = sources[0].sparkSession
    kind = sources[0].schema[column].dataType
    schema = T.StructType([T.StructField(column, kind, True)])
    stored = spark.read.schema(schema).parquet(path) if _stored_rows(spark, path) else spark.createDataFrame([], schema)
    seen = Observation()
    added = new_members(sources, stored, column).observe(seen, F.count(F.lit(1)).alias("n"))
    added.write.mode("append").parquet(path)
    return int(seen.get["n"])


def orphan_rows(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Number of fact rows whose key the dimension lacks, NULL keys included."""
    per_key = fact.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    orphans = per_key.join(dimension.select(key).distinct(), key, "left_anti")
    return orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"))


def require_no_orphans(fact: DataFrame, dimension: DataFrame, key: str) -> None:
    orphans = orphan_rows(fact, dimension, key).first()[0]
    if orphans:
        raise OrphanRows(f"{orphans} rows have no {key} in the dimension")


@dataclass(frozen=True)
class LoadStatus:
    table_name: str
    expected_rows: int
    actual_rows: int
    outcome: str


def _stored_rows(spark: SparkSession, path: str) -> int:
    try:
        return spark.read.parquet(path).count()
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return 0
        raise


def verified_load(df: DataFrame, table: str, path: str, force: bool = False) -> LoadStatus:
    """Publish a table at ``path`` unless it is there already, and verify it.

    Equal row counts mean there is nothing to do; another non-zero count is
    replaced only with ``force``.  A load that fails leaves the stored table as
    it was (see :mod:`snapshots`).  Counting Parquet reads footers only.
    """
    spark = df.sparkSession
    expected, stored = df.count(), snapshots.current_rows(spark, path)
    if stored == expected:
        return LoadStatus(table, expected, stored, SKIPPED)
    if stored and not force:
        return LoadStatus(table, expected, stored, NEEDS_FORCE)
    try:
        actual = snapshots.publish(df, path, expected)
    except snapshots.RowsMismatch as error:
        raise LoadMismatch(f"{table}: {error}") from error
    return LoadStatus(table, expected, actual, LOADED)


def loaded_table(spark: SparkSession, path: str) -> DataFrame:
    """The current rows of a loaded table."""
    table = snapshots.current(spark, path)
    if table is None:
        raise MissingArtifact(f"nothing is loaded at {path}")
    return table


def load_all(tables: Mapping[str, DataFrame], folder: str, force: bool = False) -> list[LoadStatus]:
    """Load every table in order; one status per table."""
    return [verified_load(df, name, f"{folder}/{name}", force) for name, df in tables.items()]


def status_frame(spark: SparkSession, statuses: list[LoadStatus]) -> DataFrame:
    rows = [(s.table_name, s.expected_rows, s.actual_rows, s.outcome) for s in statuses]
    return spark.createDataFrame(rows, STATUS_SCHEMA)
