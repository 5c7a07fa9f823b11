"""Validation states of single files, merged, against the report over whole tables."""

import json
import random
from datetime import date, timedelta

import pytest

from larder.operators import quality
from larder.plans import batch, file_states
from larder.plans.file_states import FileStates
from larder.sources.tables import DISCOUNTS, TABLES
from larder.streaming.arrivals import load_arrivals


def sales_rows(rng, count, days, series=12):
    rows = []
    for _ in range(count):
        i = rng.choice([None, *range(series)])
        day = rng.choice([None, *days, *days])
        rows.append((
            i, day, rng.choice([None, "W_1", "W_2", "W_3"]), 5.0, rng.choice([None, -1.0, 2.0, 3.0]), rng.choice([1.0, -2.0]),
            rng.choice([0.5, 1.5, None]), *(rng.choice([0.0, 0.2, 1.3]) for _ in DISCOUNTS)))
    return rows


def days_of(first, count):
    return [first + timedelta(days=i) for i in range(count)]


@pytest.fixture
def tables(spark, tmp_path):
    """Folders of several files each: overlapping days, a file apart, one without dates, one without rows."""
    rng = random.Random(5)
    paths = {name: str(tmp_path / name) for name in TABLES}
    spans = [days_of(date(2024, 1, 1), 10), days_of(date(2024, 1, 8), 10), days_of(date(2024, 3, 1), 5), [None], days_of(date(2024, 3, 5), 3)]
    for span in spans:
        add(spark, paths, "sales_train", sales_rows(rng, 60, span))
    add(spark, paths, "sales_train", [])
    ahead = [c for c in TABLES["sales_test"].columns]
    for span in spans[:3]:
        rows = [dict(zip(TABLES["sales_train"].columns, r)) for r in sales_rows(rng, 20, span)]
        add(spark, paths, "sales_test", [tuple(r[c] for c in ahead) for r in rows])
    add(spark, paths, "inventory", [(i, i, "n", "a", "b", "c", "d", "W_1") for i in (0, 1, 2, 3, 40, 41, 7)])
    add(spark, paths, "inventory", [(i, i, "n", "a", None, "c", "d", "W_1") for i in (3, 50)])
    add(spark, paths, "calendar", [(d, None, 0, 0, 0, 0, "W_1") for d in spans[0]])
    add(spark, paths, "calendar", [(d, None, 0, 0, 0, 0, "W_1") for d in spans[1]])
    add(spark, paths, "test_weights", [(i, 1.0) for i in (0, 1, 99)])
    return paths


def add(spark, paths, name, rows):
    spark.createDataFrame(rows, TABLES[name].schema).coalesce(1).write.mode("append").parquet(paths[name])


def states_of(spark, folder):
    return {name: FileStates(spark, spec, f"{folder}/{name}") for name, spec in TABLES.items()}


def content(report):
    return {(r.table_name, r.check_name): (r.status, json.loads(r.details)) for r in report.collect()}


def whole(spark, paths):
    return content(quality.full_report({n: spark.read.parquet(p) for n, p in paths.items()}, TABLES))


def test_merged_states_give_the_report_over_whole_tables(spark, tables, tmp_path):
    states = states_of(spark, tmp_path / "states")
    file_states.refresh_all(states, tables)
    got, wanted = content(file_states.full_report(states, tables)), whole(spark, tables)
    assert got == wanted
    assert wanted["sales_train", "duplicates"][1]["duplicate_rows"] > 0
    assert len(wanted) == 5 * len(TABLES) + 4


def test_a_second_run_reads_new_and_changed_files_only(spark, tables, tmp_path):
    states = states_of(spark, tmp_path / "states")
    first = file_states.refresh_all(states, tables)
    assert [len(first[n]) for n in TABLES] == [len(spark.read.parquet(tables[n]).inputFiles()) for n in TABLES]
    assert not any(file_states.refresh_all(states, tables).values())
    add(spark, tables, "sales_train", sales_rows(random.Random(6), 40, days_of(date(2024, 1, 15), 60)))
    with pytest.raises(file_states.StaleStates):
        file_states.full_report(states, tables)
    read = file_states.refresh_all(states, tables)
    assert [len(read[n]) for n in TABLES] == [1, 0, 0, 0, 0]
    assert content(file_states.full_report(states, tables)) == whole(spark, tables)


def test_files_that_are_gone_or_rewritten_take_their_state_along(spark, tables, tmp_path):
    states = states_of(spark, tmp_path / "states")
    file_states.refresh_all(states, tables)
    rows = [(i, 1.0) for i in (5, 6, 6)]
    spark.createDataFrame(rows, TABLES["test_weights"].schema).coalesce(1).write.mode("overwrite").parquet(tables["test_weights"])
    assert len(states["test_weights"].refresh(tables["test_weights"])) == 1
    got = content(file_states.full_report(states, tables))
    assert got == whole(spark, tables)
    assert got["test_weights", "duplicates"][1] == {"key": ["unique_id"], "duplicate_rows": 2, "duplicate_key_groups": 1}


def test_states_of_a_run_that_was_cut_off_do_not_count(spark, tables, tmp_path):
    states = states_of(spark, tmp_path / "states")
    weights = states["test_weights"]
    rows = spark.read.parquet(tables["test_weights"]).selectExpr("*", "_metadata.file_path AS file")
    weights._append("profiles", quality.profiles_by(rows, "file"), "lost")
    file_states.refresh_all(states, tables)
    assert content(file_states.full_report(states, tables)) == whole(spark, tables)


def test_files_with_other_columns_are_reported(spark, tables, tmp_path):
    states = states_of(spark, tmp_path / "states")
    file_states.refresh_all(states, tables)
    odd = spark.createDataFrame([(1, "x")], "unique_id long, weight string")
    odd.coalesce(1).write.mode("append").parquet(tables["test_weights"])
    file_states.refresh_all(states, tables)
    status, details = content(file_states.full_report(states, tables))["test_weights", "schema"]
    assert status == "FAIL" and details["dtype_mismatches"] == {"weight": "string"}


def test_keys_of_files_apart_are_not_merged(spark, tables, tmp_path):
    """Files that share no day with others stay out of the grouping of keys."""
    state = FileStates(spark, TABLES["sales_train"], str(tmp_path / "states"))
    folder = str(tmp_path / "apart")
    for k in range(4):
        rows = [(i, date(2024, 1 + k, 1 + d), "W", 1.0, 1.0, 1.0, 1.0, *[0.0] * 7) for i in range(3) for d in range(5)]
        add(spark, {"sales_train": folder}, "sales_train", rows + rows[:k])
    state.refresh(folder)
    merged = state.at(folder)
    assert merged._meeting().count() == 0
    assert tuple(merged.duplicates().first()) == (2 * (1 + 2 + 3), 1 + 2 + 3)


def test_gate_over_arriving_files(spark, tables, tmp_path):
    """Files loaded by the stream are validated once each."""
    waiting, target = tmp_path / "waiting", str(tmp_path / "target")
    waiting.mkdir()
    paths = {**tables, "test_weights": target}
    for n, rows in enumerate((["0,1.0", "1,2.0"], ["2,0.5", "1,9.0"])):
        (waiting / f"part{n}.csv").write_text("\n".join(["unique_id,weight", *rows]) + "\n")
        load_arrivals(spark, "test_weights", str(waiting), target)
        report = batch.run_gate_on_files(spark, paths, str(tmp_path / "gate"), strict=False)
        assert content(report) == whole(spark, paths)
    manifest = spark.read.parquet(str(tmp_path / "gate/_manifest")).collect()
    assert len(manifest) == 2
    with pytest.raises(quality.ValidationFailed, match="test_weights:duplicates"):
        batch.run_gate_on_files(spark, paths, str(tmp_path / "gate"))
