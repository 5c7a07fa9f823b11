"""Load source files as they arrive, each exactly once.

The same idempotent load as ``sources.load``, for a folder that keeps growing:
the stream's checkpoint remembers which files are in, and ``availableNow``
ends the run once every waiting file is loaded.  Checkpoint and target belong
together (the sink skips batch numbers it has seen), so the checkpoint stands
next to the target and a later application continues where the last one stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scan import without_nan
from ..sources.tables import TABLES


def arriving_rows(spark: SparkSession, table: str, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """A stream of the declared table's CSV files in ``folder``."""
    reader = (
        spark.readStream.schema(TABLES[table].schema)
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .option("maxFilesPerTrigger", files_per_batch)
    )
    return without_nan(reader.csv(folder))


def load_arrivals(spark: SparkSession, table: str, folder: str, target: str, checkpoint: str | None = None) -> int:
    """Append all files that are new since the last call; rows now stored."""
    place = checkpoint or f"{target.rstrip('/')}_checkpoint"
    query = (
        arriving_rows(spark, table, folder)
        .writeStream.format("parquet")
        .option("checkpointLocation", place)
        .trigger(availableNow=True)
        .start(target)
    )
    query.awaitTermination()
    return spark.read.schema(TABLES[table].schema).parquet(target).agg(F.count(F.lit(1))).first()[0]
