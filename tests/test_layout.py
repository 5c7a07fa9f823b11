"""Stored results in their layout: a lookup reads one row group, and all rows are there."""

from pathlib import Path

import pyarrow.parquet as pq
import pytest
from compare import days

from larder.operators import readside
from larder.sources import artifacts
from larder.sources.layout import Layout

SERIES, DAYS = 2_000, days("2024-01-01", 28)


def rows_read(df):
    """Rows that the scan of a plan without a shuffle gave, once the plan has run."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def row_groups(path):
    footers = [pq.ParquetFile(f).metadata for f in sorted(Path(path).glob("*.parquet"))]
    return [m.row_group(i).num_rows for m in footers for i in range(m.num_row_groups)]


@pytest.fixture(scope="module")
def forecasts(spark):
    """Rows of a series lie far apart."""
    dates = spark.createDataFrame([(d,) for d in DAYS], "date date")
    series = spark.range(SERIES).selectExpr("id * 7919 AS unique_id", "CAST(id % 3 AS STRING) AS risk_tier")
    return dates.join(series).selectExpr("unique_id", "date", "risk_tier", "CAST(xxhash64(unique_id, date) AS DOUBLE) AS prediction").orderBy("prediction")


def test_a_series_lookup_reads_one_row_group(spark, forecasts, tmp_path):
    path = str(tmp_path / "forecasts")
    assert artifacts.write_artifact(forecasts, path, layout=Layout(("unique_id", "date"), ("unique_id",), 64 << 10)) == SERIES * len(DAYS)
    stored, groups = spark.read.parquet(path), row_groups(path)
    assert len(groups) > 8 and sum(groups) == SERIES * len(DAYS)
    for series in (0, 7919 * 700, 7919 * (SERIES - 1)):
        found = readside.series_forecast(stored, series)
        assert rows_read(found) <= 2 * max(groups) < sum(groups) / 4  # two where the series crosses the end of a group
        assert [r.date for r in found.collect()] == DAYS
    assert rows_read(stored.where("unique_id = 7919 * 100")) <= max(groups)
    with pytest.raises(readside.UnknownSeries):
        readside.series_forecast(stored, 5)


def test_bloom_filters_find_a_series_in_another_order(spark, forecasts, tmp_path):
    path = str(tmp_path / "risk")
    risk = forecasts.where(f"date = DATE'{DAYS[0]}'").drop("date")
    few = risk.crossJoin(spark.range(20).withColumnRenamed("id", "copy"))  # enough rows for several groups
    few = few.selectExpr("unique_id * 100 + copy AS unique_id", "risk_tier", "prediction + copy AS prediction")
    artifacts.write_artifact(few, path, layout=Layout(("risk_tier", "prediction"), ("unique_id",), 64 << 10))
    stored, groups = spark.read.parquet(path), row_groups(path)
    assert len(groups) > 8
    assert rows_read(stored.where("unique_id = 791900 * 3 + 4")) <= 3 * max(groups) < sum(groups) / 2
    assert rows_read(stored.where("unique_id = 791900 * 3 + 50")) <= 2 * max(groups)
    highest = stored.where("risk_tier = '0'")
    assert rows_read(highest) <= highest.count() + 2 * max(groups) < sum(groups) / 2
