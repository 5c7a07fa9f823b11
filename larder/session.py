"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import itertools
import tempfile

from pyspark.sql import DataFrame, SparkSession

from .sources.layout import Layout

_attempt = itertools.count()
_local_scratch: dict[str, str] = {}


def build_session(app: str = "larder", cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks.

    On a cluster the session comes from spark-submit; only the adaptive
    settings below matter there: they coalesce small shuffles, split skewed
    join partitions and broadcast a side only once its measured size is small.
    """
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    Unset in local mode (tests, benchmarks), a fresh temporary folder serves;
    unset on a cluster is an error, since a machine-local folder would be
    lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        app = context.applicationId
        if app not in _local_scratch:
            _local_scratch[app] = tempfile.mkdtemp(prefix="larder-")
        configured = _local_scratch[app]
    return f"{configured.rstrip('/')}/{context.applicationId}"


def settle(df: DataFrame, label: str, layout: Layout | None = None) -> DataFrame:
    """Write a frame once to the shared folder and continue from the copy.

    For results that several plans read, or that one plan reads twice: the
    work is done once, later readers still prune columns and push filters
    down, and a lost executor costs nothing but the running tasks.  A result
    that is looked up by single values has a layout.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{next(_attempt)}"
    if layout is None:
        df.write.parquet(path)
    else:
        layout.options(layout.arranged(df).write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
