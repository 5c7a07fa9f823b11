"""Validation that remembers what it has read: one state for each source file.

A file's state is what the checks need of it and merges with the states of
other files: row, null and violation counts, a bit for each day, copies of each
key, rows of each referenced key.  A run lists the files, reads those that it
has no state of, and reports from the states of the files that are there now.
A file that was replaced or removed takes its state with it.

States are appended under the name of their batch and count once the batch's
files are listed, which is the last write: a run that was cut off leaves
nothing that is read later.  Runs on one folder follow one another.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import quality
from ..session import settle
from ..sources.scan import without_nan
from ..sources.tables import TableSpec

_IDENTITY = ["file", "bytes", "modified"]
_FILES = "batch string, file string, bytes long, modified timestamp, columns string"
_OWNER = ["batch", "file"]


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """place, file, bytes, modified of each file below ``path``; contents are not read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return listed.select(
        F.col("path").alias("place"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("bytes"), F.col("_metadata.file_modification_time").alias("modified"),
    )


def read_parquet(spark: SparkSession, places: list[str]) -> DataFrame:
    return without_nan(spark.read.parquet(*places))


@dataclass
class FileStates:
    """The states of one table's files, kept in ``folder``.

    ``read`` turns paths of files into rows.  Files are told apart by path,
    size and time of change.
    """

    spark: SparkSession
    spec: TableSpec
    folder: str
    read: Callable[[SparkSession, list[str]], DataFrame] = read_parquet

    def _stored(self, kind: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.folder}/{kind}")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" in str(error):
                return None
            raise

    def _append(self, kind: str, state: DataFrame, batch: str) -> None:
        state.withColumn("batch", F.lit(batch)).write.mode("append").parquet(f"{self.folder}/{kind}")

    def _known(self) -> DataFrame:
        stored = self._stored("files")
        return self.spark.createDataFrame([], _FILES) if stored is None else stored

    def refresh(self, path: str) -> list[str]:
        """Read the files below ``path`` that have no state yet; their paths.

        The paths of new files pass through the driver, as those of any scan do.
        """
        new = list_files(self.spark, path).join(self._known(), _IDENTITY, "left_anti").orderBy("file").collect()
        if new:
            self._add(new)
        return [r.place for r in new]

    def _add(self, new: list[Row]) -> None:
        batch = uuid.uuid4().hex
        source = self.read(self.spark, [r.place for r in new])
        columns = source.columns
        rows = source.withColumn("file", F.col("_metadata.file_path"))
        span = [F.min("date").alias("low"), F.max("date").alias("high")] if "date" in columns else []
        self._append("profiles", quality.profiles_by(rows, "file", *span), batch)
        if "date" in columns:
            self._append("days", quality.day_bitmaps(rows, quality.date_group(columns), "file"), batch)
        if self.spec.key:
            keys = rows.groupBy("file", *self.spec.key).agg(F.count(F.lit(1)).alias("copies"))
            self._append("keys", keys, batch)
        if quality.REFERENCE in columns:
            counted = rows.groupBy("file", quality.REFERENCE).agg(F.count(F.lit(1)).alias("n"))
            self._append("references", counted, batch)
        listed = [(batch, r.file, r.bytes, r.modified, source.schema.json()) for r in new]
        self.spark.createDataFrame(listed, _FILES).coalesce(1).write.mode("append").parquet(f"{self.folder}/files")

    def at(self, path: str) -> "MergedStates":
        """The states of the files below ``path``, which must be refreshed; files without a state are an error."""
        listing = list_files(self.spark, path)
        latest = self._known().groupBy(*_IDENTITY).agg(F.max_by(F.struct("batch", "columns"), "batch").alias("state"))
        live = settle(
            listing.join(latest, _IDENTITY, "left").select("file", "state.batch", "state.columns"), "live-files")
        schemas = [r.columns for r in live.select("columns").distinct().collect()]  # few: files of a table agree
        if None in schemas or not schemas:
            raise StaleStates(f"{self.spec.name}: files without a state, or no files, below {path}; refresh first")
        return MergedStates(self, live.select(*_OWNER), [T.StructType.fromJson(json.loads(s)) for s in sorted(schemas)])


class StaleStates(RuntimeError):
    """A source has files that no state covers."""


@dataclass
class MergedStates:
    """What the states of a table's present files say together; no source file is read."""

    states: FileStates
    live: DataFrame
    schemas: list[T.StructType]

    @property
    def _spark(self) -> SparkSession:
        return self.states.spark

    @property
    def columns(self) -> list[str]:
        return list(dict.fromkeys(name for schema in self.schemas for name in schema.names))

    def _of(self, kind: str) -> DataFrame:
        stored = self.states._stored(kind)
        if stored is None:
            raise StaleStates(f"{self.states.spec.name}: no {kind} are stored")
        return stored.join(self.live, _OWNER, "left_semi")

    def schema_result(self) -> DataFrame:
        """The worst outcome over the schemas that the files have."""
        empty = [self._spark.createDataFrame([], schema) for schema in self.schemas]
        results = quality.union_of([quality.schema_check(df, self.states.spec) for df in empty])
        if len(empty) == 1:
            return results
        worst = F.max_by(F.struct(*results.columns), F.struct(quality.severity(F.col("status")), "details"))
        return results.agg(worst.alias("r")).select("r.*")

    def profile(self) -> DataFrame:
        return quality.merged_profile(self._of("profiles"), self.columns)

    def _meeting(self) -> DataFrame:
        """Files whose days overlap those of another file: elsewhere no key can be in two files.

        One row a file is ordered here, not one a key.
        """
        spans = self._of("profiles").select(*_OWNER, "low", "high").where("low IS NOT NULL")
        order = Window.orderBy("low", "file")
        reached = F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1))
        meets = (reached >= F.col("low")) | (F.lead("low").over(order) <= F.col("high"))
        return spans.withColumn("meets", F.coalesce(meets, F.lit(False))).where("meets").select(*_OWNER)

    def duplicates(self) -> DataFrame:
        """Duplicate rows and key groups.

        Where the key has a date, the keys of files that share no day with
        others are settled within the file, and only those with copies are read.
        """
        key, keys = list(self.states.spec.key), self._of("keys")
        if "date" not in key:
            return quality.duplicates_among(keys.groupBy(*key).agg(F.sum("copies").alias("copies")))
        meeting = self._meeting()
        dated = keys.where("date IS NOT NULL")
        alone = dated.where("copies > 1").join(meeting, _OWNER, "left_anti").select("copies")
        shared = dated.join(meeting, _OWNER, "left_semi").unionByName(keys.where("date IS NULL"))
        return quality.duplicates_among(alone.unionByName(shared.groupBy(*key).agg(F.sum("copies").alias("copies")).select("copies")))

    def days(self) -> DataFrame:
        return quality.merged_bitmaps(self._of("days").drop(*_OWNER))

    def references(self) -> DataFrame:
        """Rows (``n``) of each referenced key, null included."""
        return self._of("references").groupBy(quality.REFERENCE).agg(F.sum("n").alias("n"))

    def checks(self) -> list[DataFrame]:
        """The five checks of the table, as :func:`quality.table_checks` has them."""
        spec, spark = self.states.spec, self._spark
        return [
            self.schema_result(),
            quality.profile_results(self.profile(), spec),
            quality.duplicate_result(self.duplicates(), spec)
            if spec.key else quality.skipped(spark, "duplicates", spec, quality.NO_KEY),
            quality.date_continuity_result(self.days(), spec)
            if "date" in self.columns else quality.skipped(spark, "date_continuity", spec, quality.NO_DATE),
        ]


#: Tables whose new files are read at the same time.
CONCURRENT = 6


def refresh_all(states: Mapping[str, FileStates], paths: Mapping[str, str]) -> dict[str, list[str]]:
    """Refresh the states of every table; the files read for each."""
    names = list(states)
    if not names:
        return {}
    spark = states[names[0]].spark
    with ThreadPoolExecutor(CONCURRENT) as pool:
        read = pool.map(inheritable_thread_target(spark)(lambda name: states[name].refresh(paths[name])), names)
        return dict(zip(names, read))


def full_report(states: Mapping[str, FileStates], paths: Mapping[str, str]) -> DataFrame:
    """The report of :func:`quality.full_report`, from states alone."""
    with ThreadPoolExecutor(CONCURRENT) as pool:
        spark = next(iter(states.values())).spark
        merged = dict(zip(states, pool.map(inheritable_thread_target(spark)(lambda n: states[n].at(paths[n])), states)))
    specs = {name: state.spec for name, state in states.items()}
    checks = [check for table in merged.values() for check in table.checks()]
    tied = {name: merged[name].references() for name in {*quality.REFERRING, quality.REFERRED, quality.COVERED_BY}}
    return quality.union_of(checks + quality.reference_checks(tied, specs, F.col("n")))
