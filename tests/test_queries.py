"""Every registered query against its SQL counterpart on whole tables."""

import pytest
from compare import connect, differences

from __spark_entry__ import entry, oracle_sql, queries
from larder.plans.queries import boosted_scores
from larder.plans.warehouse import open_warehouse

SQL = oracle_sql()


@pytest.fixture(scope="module")
def connection(small_data):
    return connect(small_data)


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_equals_sql(spark, small_data, connection, key):
    assert differences(queries()[key](spark, small_data), connection, SQL[key]) == []


def test_boosted_model_is_scored_next_to_the_baselines(spark, small_data):
    """The fit has no SQL counterpart; its scores must be complete."""
    scores = {r.model: r for r in boosted_scores(open_warehouse(spark, small_data, "dense")).collect()}
    assert set(scores) == {"seasonal_naive_7", "moving_average_28", "boosted_trees"}
    assert len({r.n_rows for r in scores.values()}) == 1
    assert all(r.wmape > 0 for r in scores.values())


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(queries())


def test_entry_is_the_scenario_summary(spark):
    result = entry(spark)
    assert "total_scenario_unmet_units" in result.columns
    assert result.count() == 4


def test_results_do_not_depend_on_partitioning(spark, small_data):
    warehouse = open_warehouse(spark, small_data, "sparse")
    before = sorted(map(tuple, warehouse.score_risk().collect()), key=str)
    saved = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        after = sorted(map(tuple, warehouse.score_risk().collect()), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", saved)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert before == after
