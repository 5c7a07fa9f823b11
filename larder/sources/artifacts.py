"""Stage outputs, the run manifest and curated tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import __version__
from .layout import Layout
from .scan import lower_case_columns

MANIFEST_SCHEMA = (
    "run_id string, generated_at timestamp, version string, kind string, "
    "inputs map<string,bigint>, outputs map<string,string>, status string, note string"
)


class MissingArtifact(FileNotFoundError):
    """An upstream stage has not produced its output yet."""


def write_artifact(df: DataFrame, path: str, mode: str = "errorifexists", layout: Layout | None = None) -> int:
    """Write a stage output, in a layout if it is looked up; its row count is observed while writing."""
    seen = Observation()
    # Observed after rows are arranged: drawing the bounds of the ranges would count them once more.
    rows = df if layout is None else layout.arranged(df)
    writer = rows.observe(seen, F.count(F.lit(1)).alias("n_rows")).write.mode(mode)
    (writer if layout is None else layout.options(writer)).parquet(path)
    return int(seen.get["n_rows"])


def read_artifact(spark: SparkSession, path: str, stage: str) -> DataFrame:
    """Read an upstream output; a consumer never recomputes it."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            raise MissingArtifact(f"nothing at {path}; run the {stage} stage first") from error
        raise


def artifact_status(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Which named artifacts exist."""

    def exists(path: str) -> bool:
        try:
            read_artifact(spark, path, "upstream")
        except MissingArtifact:
            return False
        return True

    return spark.createDataFrame(
        [(name, exists(path)) for name, path in paths.items()], "artifact string, available boolean"
    )


def manifest_row(
    spark: SparkSession,
    kind: str,
    inputs: Mapping[str, int],
    outputs: Mapping[str, str],
    status: str,
    note: str = "",
    generated_at: datetime | None = None,
) -> DataFrame:
    when = generated_at or datetime.now(timezone.utc)
    row = (str(uuid.uuid4()), when, __version__, kind, dict(inputs), dict(outputs), status, note)
    return spark.createDataFrame([row], MANIFEST_SCHEMA)


def append_manifest(row: DataFrame, path: str) -> None:
    row.write.mode("append").parquet(path)


def latest(df: DataFrame, by: str, *group: str) -> DataFrame:
    """The newest row of each group by time, as a partial aggregate.

    Names are no measure of age, so artifacts are picked by their time stamp.
    """
    newest = F.max_by(F.struct(*df.columns), F.col(by)).alias("newest")
    return df.groupBy(*group).agg(newest).select("newest.*")


def latest_output(spark: SparkSession, manifest: str, kind: str) -> DataFrame:
    """The stored output of the newest run of a kind, found through the manifest."""
    runs = read_artifact(spark, manifest, kind).filter(F.col("kind") == kind)
    newest = latest(runs, "generated_at").select(F.col("outputs")[kind].alias("path"), "generated_at").first()
    if newest is None or newest.path is None:
        raise MissingArtifact(f"no {kind} run in {manifest}")
    return read_artifact(spark, newest.path, kind).withColumn("generated_at", F.lit(newest.generated_at))


def curated(df: DataFrame) -> DataFrame:
    """Lower-case columns; an unknown data-gap flag counts as no gap."""
    df = lower_case_columns(df)

    def column(name: str) -> Column:
        if "data_gap" in name:
            return F.coalesce(F.col(name).cast("boolean"), F.lit(False)).alias(name)
        return F.col(name)

    return df.select([column(c) for c in df.columns])


def reload_curated(df: DataFrame, table: str, path: str) -> DataFrame:
    """Replace a curated table with the current artifact."""
    curated(df).write.mode("overwrite").option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)
