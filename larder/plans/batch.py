"""Running a batch of named questions and the validation gate as jobs."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from threading import Event, Timer

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality
from ..sources.artifacts import append_manifest, manifest_row, write_artifact
from ..sources.tables import TABLES
from . import file_states
from .file_states import FileStates, refresh_all

BATCH_SCHEMA = "question string, n_rows long, status string, error string"
#: Questions that run at the same time, and seconds after which one is cancelled.
CONCURRENT = 6
TIME_LIMIT = 3600.0


class BatchFailed(RuntimeError):
    """At least one question of the batch failed."""


class TimeLimitExceeded(RuntimeError):
    """A question ran longer than it may."""


def _run_question(spark: SparkSession, name: str, question: Callable[[], DataFrame], path: str, time_limit: float) -> int:
    """Rows written; the question's jobs share a tag of their own and are cancelled with it once its time is over."""
    tag = f"question-{name}-{uuid.uuid4().hex}"
    over = Event()

    def cancel() -> None:
        over.set()
        spark.sparkContext.cancelJobsWithTag(tag)

    spark.sparkContext.addJobTag(tag)
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)  # a fair pool each, where the scheduler is fair
    watch = Timer(time_limit, cancel)
    watch.start()
    try:
        rows = write_artifact(question(), path, mode="overwrite")
    except Exception as error:
        if over.is_set():
            raise TimeLimitExceeded(f"cancelled after {time_limit:g} s") from error
        raise
    finally:
        watch.cancel()
        spark.sparkContext.removeJobTag(tag)
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)
    if over.is_set():
        raise TimeLimitExceeded(f"cancelled after {time_limit:g} s")
    return rows


def run_questions(
    spark: SparkSession, questions: Mapping[str, Callable[[], DataFrame]], folder: str, concurrent: int = CONCURRENT, time_limit: float = TIME_LIMIT
) -> DataFrame:
    """Run every question, several at a time, and keep going past failures.

    One row per question, in name order: rows written and status.  A question
    beyond its time limit is cancelled and fails.  Results land in
    ``folder/<question>``, the seconds each took in ``folder/_times``, and one
    manifest row covers the batch.
    """
    outcome, outputs, times = {}, {}, {}

    def answer(name: str) -> None:
        path, began = f"{folder}/{name}", time.monotonic()
        try:
            rows = _run_question(spark, name, questions[name], path, time_limit)
        except Exception as error:  # a failed question must not stop the others
            outcome[name] = (name, None, "FAIL", f"{type(error).__name__}: {(str(error).splitlines() or [''])[0]}")
        else:
            outcome[name] = (name, rows, "PASS", None)
            outputs[name] = path
        times[name] = time.monotonic() - began

    with ThreadPoolExecutor(concurrent) as pool:
        list(pool.map(inheritable_thread_target(spark)(answer), sorted(questions)))
    ordered = [outcome[name] for name in sorted(questions)]
    if ordered:
        seconds = spark.createDataFrame([(n, times[n], outcome[n][2]) for n in sorted(questions)], "question string, seconds double, status string")
        seconds.coalesce(1).write.mode("overwrite").parquet(f"{folder}/_times")
    failed = [name for name, _, status, _ in ordered if status == "FAIL"]
    append_manifest(
        manifest_row(
            spark,
            "question_batch",
            {name: rows for name, rows, status, _ in ordered if status == "PASS"},
            outputs,
            "FAIL" if failed else "PASS",
            ", ".join(failed),
        ),
        f"{folder}/_manifest",
    )
    return spark.createDataFrame(ordered, BATCH_SCHEMA)


def require_success(batch: DataFrame) -> None:
    failed = [row.question for row in batch.filter(F.col("status") == "FAIL").collect()]
    if failed:
        raise BatchFailed(f"failed questions: {', '.join(failed)}")


def run_gate(spark: SparkSession, tables: Mapping[str, DataFrame], folder: str, strict: bool = True) -> DataFrame:
    """Check all tables, keep the report and a manifest row, stop on failure."""
    return _judge(spark, quality.full_report(tables, TABLES), folder, strict)


def run_gate_on_files(spark: SparkSession, paths: Mapping[str, str], folder: str, strict: bool = True) -> DataFrame:
    """The same gate over Parquet folders that grow: only files it has not seen are read.

    ``paths`` has the folder of each declared table.  What earlier runs found
    stands in ``folder/states``; files without change are not read again.
    """
    states = {name: FileStates(spark, TABLES[name], f"{folder}/states/{name}") for name in TABLES}
    read = refresh_all(states, paths)
    return _judge(spark, file_states.full_report(states, paths), folder, strict, sum(map(len, read.values())))


def _judge(spark: SparkSession, checks: DataFrame, folder: str, strict: bool, files_read: int | None = None) -> DataFrame:
    write_artifact(checks, f"{folder}/report", mode="overwrite")
    report = spark.read.parquet(f"{folder}/report")
    verdict = quality.overall(report)
    summary = verdict.first()
    counts = {"checks": summary.n_pass + summary.n_warn + summary.n_fail}
    if files_read is not None:
        counts["files_read"] = files_read
    append_manifest(
        manifest_row(
            spark,
            "validation",
            counts,
            {"report": f"{folder}/report"},
            summary.overall,
            f"{summary.n_pass} pass, {summary.n_warn} warn, {summary.n_fail} fail",
        ),
        f"{folder}/_manifest",
    )
    if strict:
        quality.require_valid(report)
    return report
