"""Tables published as whole versions: written aside, verified, then made current in one step.

A table's folder holds one folder for each version, and a list of which one was
made current when.  A version becomes current by one row appended to that list,
after its rows have been counted; until then, and whenever writing or counting
fails, readers go on seeing the version before.  Versions that are no longer
kept are emptied.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

#: Versions that keep their rows: the current one, and those that running readers may still see.
KEPT = 2

_LIST = "sequence long, version string, n_rows long"


class RowsMismatch(RuntimeError):
    """A written version has another row count than its source."""


def _listed(spark: SparkSession, path: str) -> list:
    """The versions of a table, latest first; a few rows, one for each load."""
    try:
        rows = spark.read.schema(_LIST).parquet(f"{path}/_versions").collect()
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return []
        raise
    return sorted(rows, key=lambda r: r.sequence, reverse=True)


def current(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of the current version; None if nothing was published."""
    versions = _listed(spark, path)
    return spark.read.parquet(f"{path}/{versions[0].version}") if versions else None


def current_rows(spark: SparkSession, path: str) -> int:
    """Rows of the current version as they are stored now; zero if nothing was published."""
    table = current(spark, path)
    return 0 if table is None else table.count()


def _count(spark: SparkSession, path: str) -> int:
    return spark.read.parquet(path).count()


def publish(df: DataFrame, path: str, expected: int) -> int:
    """Write ``df`` as a new version, verify its row count and make it current."""
    spark = df.sparkSession
    before = _listed(spark, path)
    version = f"version-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{version}")
    actual = _count(spark, f"{path}/{version}")
    if actual != expected:
        spark.createDataFrame([], df.schema).write.mode("overwrite").parquet(f"{path}/{version}")
        raise RowsMismatch(f"{actual} rows stored, {expected} expected; the version before stays current")
    sequence = before[0].sequence + 1 if before else 1
    row = spark.createDataFrame([(sequence, version, actual)], _LIST)
    row.coalesce(1).write.mode("append").parquet(f"{path}/_versions")
    for old in before[KEPT - 1 : KEPT]:  # the one that has just fallen out; earlier ones are empty already
        spark.createDataFrame([], df.schema).write.mode("overwrite").parquet(f"{path}/{old.version}")
    return actual
