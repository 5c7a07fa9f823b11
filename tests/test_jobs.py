from datetime import date, datetime

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from larder.operators import boosting, demand, features, risk, timeline, trees
from larder.plans import batch
from larder.plans.warehouse import open_warehouse
from larder.session import settle, shared_folder
from larder.sources import artifacts, load, scan, snapshots
from larder.sources.scan import MissingSource, scan_csv, scan_parquet
from larder.sources.tables import TABLES


def test_csv_scan_applies_the_declared_schema(spark, tmp_path):
    path = tmp_path / "weights.csv"
    path.write_text("unique_id,weight\n1,2.5\n2,NaN\n3,\n")
    rows = scan_csv(spark, "test_weights", str(path)).orderBy("unique_id").collect()
    assert [tuple(r) for r in rows] == [(1, 2.5), (2, None), (3, None)]


def test_csv_header_case_does_not_matter(spark, tmp_path):
    path = tmp_path / "inventory.csv"
    path.write_text(
        "unique_id,product_unique_id,name,L1_category_name_en,L2_category_name_en,L3_category_name_en,"
        "L4_category_name_en,warehouse\n1,2,Milk,Dairy,,,,W_1\n"
    )
    row = scan_csv(spark, "inventory", str(path)).first()
    assert (row.l1_category_name_en, row.l2_category_name_en) == ("Dairy", None)


def test_drifted_or_missing_files_fail(spark, tmp_path):
    drifted = tmp_path / "drifted.csv"
    drifted.write_text("unique_id,heaviness\n1,2.5\n")
    with pytest.raises(Exception):
        scan_csv(spark, "test_weights", str(drifted)).collect()
    mistyped = tmp_path / "mistyped.csv"
    mistyped.write_text("unique_id,weight\nabc,2.5\n")
    with pytest.raises(Exception):
        scan_csv(spark, "test_weights", str(mistyped)).collect()
    with pytest.raises(MissingSource):
        scan_csv(spark, "test_weights", str(tmp_path / "nowhere.csv"))
    with pytest.raises(MissingSource):
        scan_parquet(spark, TABLES["test_weights"], str(tmp_path / "nowhere.parquet"))


def test_verified_load_states(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    small = frame([(1,), (2,)], "a int")
    assert load.verified_load(small, "t", path).outcome == load.LOADED
    assert load.verified_load(small, "t", path).outcome == load.SKIPPED
    larger = frame([(1,), (2,), (3,)], "a int")
    refused = load.verified_load(larger, "t", path)
    assert (refused.outcome, refused.actual_rows) == (load.NEEDS_FORCE, 2)
    forced = load.verified_load(larger, "t", path, force=True)
    assert (forced.outcome, forced.actual_rows) == (load.LOADED, 3)


def test_new_members_and_orphans(frame):
    known = frame([("A",)], "warehouse string")
    sources = [frame([("A",), ("B",), (None,), ("",)], "warehouse string"), frame([("C",)], "warehouse string")]
    assert sorted(r.warehouse for r in load.new_members(sources, known).collect()) == ["B", "C"]
    fact = frame([(1,), (1,), (2,), (None,)], "k int")
    dimension = frame([(1,)], "k int")
    assert load.orphan_rows(fact, dimension, "k").first()[0] == 2
    with pytest.raises(load.OrphanRows, match="2 rows"):
        load.require_no_orphans(fact, dimension, "k")
    profile = load.source_profile(sources[0], "s").first()
    assert (profile.n_rows, profile.n_warehouses) == (4, 2)


def test_artifacts_and_manifest(spark, frame, tmp_path):
    path, manifest = str(tmp_path / "risk"), str(tmp_path / "manifest")
    with pytest.raises(artifacts.MissingArtifact, match="risk stage"):
        artifacts.read_artifact(spark, path, "risk")
    assert artifacts.write_artifact(frame([(1,), (2,)], "a int"), path) == 2
    status = artifacts.artifact_status(spark, {"risk": path, "other": str(tmp_path / "none")})
    assert {r.artifact: r.available for r in status.collect()} == {"risk": True, "other": False}
    for hour, state in ((9, "WARN"), (8, "PASS")):
        row = artifacts.manifest_row(
            spark, "risk", {"rows": 2}, {"risk": path}, state, generated_at=datetime(2024, 6, 2, hour)
        )
        artifacts.append_manifest(row, manifest)
    newest = artifacts.latest(spark.read.parquet(manifest), "generated_at", "kind").collect()
    assert [r.status for r in newest] == ["WARN"]


def test_curated_table_has_no_unknown_gaps(spark, frame, tmp_path):
    df = frame([(1, True), (2, None)], "Unique_ID int, availability_data_gap boolean")
    table = artifacts.reload_curated(df, "curated_gap_test", str(tmp_path / "curated"))
    assert sorted(map(tuple, table.collect())) == [(1, True), (2, False)]
    artifacts.reload_curated(df.limit(1), "curated_gap_test", str(tmp_path / "curated"))
    assert spark.table("curated_gap_test").count() == 1


def test_a_failed_load_leaves_the_table_as_it_was(spark, frame, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    load.verified_load(frame([(1,), (2,)], "a int"), "t", path)
    counted = snapshots._count
    monkeypatch.setattr(snapshots, "_count", lambda *a: counted(*a) - 1)
    with pytest.raises(load.LoadMismatch, match="stays current"):
        load.verified_load(frame([(7,), (8,), (9,)], "a int"), "t", path, force=True)
    assert sorted(r.a for r in load.loaded_table(spark, path).collect()) == [1, 2]
    unreadable = frame([(7,), (8,), (9,)], "a int").withColumn("a", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        load.verified_load(unreadable, "t", path, force=True)
    assert sorted(r.a for r in load.loaded_table(spark, path).collect()) == [1, 2]


def test_readers_keep_their_version_and_old_ones_expire(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    assert snapshots.current(spark, path) is None
    with pytest.raises(artifacts.MissingArtifact):
        load.loaded_table(spark, path)
    seen = []
    for n in (1, 2, 3, 4):
        snapshots.publish(spark.range(n), path, n)
        seen.append(snapshots.current(spark, path))
        assert snapshots.current_rows(spark, path) == n
        if n > 1:
            assert seen[-2].count() == n - 1  # a reader that began before the change
    versions = snapshots._listed(spark, path)
    assert [spark.read.schema("id long").parquet(f"{path}/{v.version}").count() for v in versions] == [4, 3, 0, 0]


def test_a_hanging_question_is_cancelled_and_the_others_pass(spark, frame, tmp_path):
    def hang():
        return spark.range(0, 1 << 44, 1, 4).agg(F.sum(F.hash("id")).alias("s"))

    questions = {"hangs": hang, **{f"q{i}": (lambda i=i: frame([(i,)], "a int")) for i in range(5)}}
    result = {r.question: r for r in batch.run_questions(spark, questions, str(tmp_path), concurrent=3, time_limit=8).collect()}
    assert list(result) == sorted(questions)
    assert result["hangs"].status == "FAIL" and "TimeLimitExceeded" in result["hangs"].error
    assert all(result[f"q{i}"].status == "PASS" and result[f"q{i}"].n_rows == 1 for i in range(5))
    times = {r.question: r.seconds for r in spark.read.parquet(str(tmp_path / "_times")).collect()}
    assert times.keys() == questions.keys() and 8 <= times["hangs"] < 60
    assert batch.run_questions(spark, {}, str(tmp_path / "none")).count() == 0


def test_batch_survives_a_failing_question(spark, frame, tmp_path):
    questions = {
        "good": lambda: frame([(1,)], "a int"),
        "bad": lambda: frame([(1,)], "a int").select("b"),
    }
    result = batch.run_questions(spark, questions, str(tmp_path))
    rows = {r.question: r for r in result.collect()}
    assert rows["good"].status == "PASS" and rows["good"].n_rows == 1
    assert rows["bad"].status == "FAIL" and rows["bad"].error
    assert spark.read.parquet(str(tmp_path / "_manifest")).first().status == "FAIL"
    with pytest.raises(batch.BatchFailed, match="bad"):
        batch.require_success(result)


def test_settled_frames_are_read_from_the_shared_folder(spark, frame):
    copy = settle(frame([(1, None)], "a int, b string"), "probe")
    assert copy.inputFiles()[0].removeprefix("file:").lstrip("/").startswith(shared_folder(spark).lstrip("/"))
    assert [tuple(r) for r in copy.collect()] == [(1, None)]


def test_panel_is_unique_by_series_and_day(spark, small_data):
    for grain in ("dense", "sparse"):
        panel = open_warehouse(spark, small_data, grain).panel
        assert panel.groupBy("unique_id", "date").count().filter(F.col("count") > 1).isEmpty()
        assert panel.schema.names == TABLES["sales_train"].columns


def test_series_windows_read_the_panel_without_a_shuffle(spark, small_data):
    panel = open_warehouse(spark, small_data, "dense").panel
    plan = features.with_history(panel)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_recent_questions_read_recent_periods(spark, small_data):
    """Partition filters in the plan, no shuffle where none is due, and the values of the whole panel."""
    w = open_warehouse(spark, small_data, "dense")
    start = F.date_sub(w.last_day, 27)
    pairs = {
        "q16": (demand.high_risk_skus(w.dated_panel, w.inventory, w.last_day, min_velocity=0), demand.high_risk_skus(w.panel, w.inventory, min_velocity=0)),
        "r01": (risk.recent_availability(w.dated_panel, start), risk.recent_availability(w.panel, start)),
        "m07": (w.split[1], w.panel.filter(F.col("date") >= start)),
        "history": (timeline.recent_history(w.dated_panel, w.carried, start), features.with_history(w.panel.select("unique_id", "date", "sales")).filter(F.col("date") >= start)),
    }
    for name, (pruned, whole) in pairs.items():
        plan = pruned._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(" in plan, name
        assert sorted(map(tuple, pruned.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str) != [], name
        if name in ("r01", "m07"):
            assert "Exchange" not in plan, name
    scanned = pairs["m07"][0]
    scanned.collect()
    assert len(scanned.inputFiles()) <= len(w.panel.inputFiles())


def test_carried_state_stands_for_the_history_before(frame):
    import random

    rng = random.Random(4)
    for trial in range(6):
        first = date(2021, 1, 1).toordinal()
        rows = [
            (s, date.fromordinal(first + i), None if rng.random() < 0.3 else float(rng.randint(0, 9)))
            for s in range(4) for i in sorted(rng.sample(range(900), 900 if s == 0 else 12 * s))
        ]
        panel = frame(rows, "unique_id long, date date, sales double")
        low = F.lit(date.fromordinal(first + 600 + 40 * trial))
        whole = timeline.with_history(panel).filter(F.col("date") >= low)
        for column, unit in timeline.PERIODS.items():
            dated = panel.withColumn(column, F.trunc("date", unit))
            recent = timeline.recent_history(dated, timeline.last_known(dated), low)
            assert sorted(map(tuple, recent.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)


def test_boosting_trains_before_the_holdout_only(spark, frame):
    start = date(2024, 1, 1).toordinal()
    rows = [
        (s, date.fromordinal(start + i), "W", None if i == 3 else float(10 * s + i % 7), float(i % 7), None if i < 28 else 5.0)
        for s in (1, 2, 3) for i in range(140)
    ]
    schema = "unique_id long, date date, warehouse string, sales double, dow double, lag_28 double"
    table = frame(rows, schema).withColumns({"sell_price_main": F.lit(1.0), features.CATEGORY: F.lit("c")})
    known = frame([("W", "c"), ("V", "d"), ("V", None)], f"warehouse string, {features.CATEGORY} string")
    params = boosting.BoostingParams(max_rounds=8, patience=2, learning_rate=0.3, max_depth=3, min_rows_per_leaf=1)
    names = ["dow", "lag_28", "sell_price_main"]
    fitted = boosting.boosted_forecast(table, known, params, names)
    assert 1 <= fitted.rounds <= 8
    predictions = {(r.unique_id, r.date): r.prediction for r in fitted.predictions.collect()}
    assert len(predictions) == 3 * 28 and all(p == p for p in predictions.values())
    inputs = [r.feature for r in fitted.inputs.orderBy("place").collect()]
    assert inputs[:3] == names
    assert inputs[3:6] == ["warehouse_unknown", "warehouse_V", "warehouse_W"] and len(inputs) == 9
    cutoff = date.fromordinal(start + 112)
    spiked = table.withColumn("sales", F.when(F.col("date") >= cutoff, 1e6).otherwise(F.col("sales")))
    again = boosting.boosted_forecast(spiked, known, params, names)
    assert {(r.unique_id, r.date): r.prediction for r in again.predictions.collect()} == predictions
    top = boosting.importances(fitted).collect()
    assert top[0].importance >= top[-1].importance
    assert sum(r.importance for r in boosting.importances(fitted, limit=None).collect()) == pytest.approx(1)


def model_rows(frame, count=400):
    rows = [
        (i // 20, date.fromordinal(738_000 + i % 20), float(10 * (i % 5) + (i * 7) % 11 % 3 + (40 if i % 6 == 0 else 0)), "validation" if i % 20 > 15 else "train",
         float(i % 5), None if i % 6 == 0 else float((i * 7) % 11), i % 3, i % 2)
        for i in range(count)
    ]
    return frame(rows, "unique_id long, date date, sales double, split string, a double, b double, warehouse_slot int, l1_category_name_en_slot int")


def test_a_search_fits_its_rounds_and_the_patience_and_nothing_twice(frame):
    """Trees grow one by one: the error of each round is that of the trees so far, and the final model has the best rounds."""
    table, names, sizes = model_rows(frame), ["a", "b"], (3, 2)
    params = boosting.BoostingParams(max_rounds=120, patience=3, learning_rate=0.6, max_depth=3, min_rows_per_leaf=2)
    model, rounds, stopped, errors = boosting._search(table, names, sizes, params)
    assert stopped and len(errors) == rounds + params.patience and len(model.trees) == rounds == errors.index(min(errors)) + 1
    assert rounds > 3 and errors[rounds - 1] < errors[0] / 2
    again, rounds_again, _, errors_again = boosting._search(table.repartition(5), names, sizes, params)
    assert (rounds_again, errors_again) == (rounds, errors)
    assert [t.value.tolist() for t in again.trees] == [t.value.tolist() for t in model.trees]
    assert sum(model.importances()) == pytest.approx(1) and len(model.importances()) == 7
    few, shortest, ended, _ = boosting._search(table, names, sizes, boosting.BoostingParams(max_rounds=2, patience=3, max_depth=2))
    assert not ended and shortest == len(few.trees) == 2
    with pytest.raises(ValueError, match="labelled"):
        boosting._search(table.filter("split = 'train'"), names, sizes, params)


@pytest.mark.parametrize("few_rows", [trees.FEW_ROWS, 60, 0])
def test_trees_equal_exhaustive_search_however_large_their_nodes(frame, few_rows):
    """Every split of a grown tree is the best of all cuts, sides for missing values and categories; no matter which jobs found it."""
    table, sizes = model_rows(frame).repartition(3), (3, 2)
    how = boosting.binned(table, ["a", "b"], sizes)
    blocks = boosting.settle(boosting._blocks(table, how, 0.0), "test-blocks")
    rules = trees.Rules(3, 5, 1.0, 1.0, 1)
    tree, error, n = trees.Grower(blocks, 400, how.inputs, rules, (0, 1), 1, 0.1, 1024.0, few_rows).grow([], 0)
    rows = table.collect()
    assert n == sum(r.split == "validation" for r in rows)
    assert error == pytest.approx(sum(abs(r.sales) for r in rows if r.split == "validation"))
    candidates = [(name, cut, left) for name in "ab" for cut in range(-1, 11) for left in (True, False)]
    candidates += [(c, v, None) for c, k in (("warehouse_slot", 3), ("l1_category_name_en_slot", 2)) for v in range(k)]

    def squared(group):
        return sum(r.sales for r in group) ** 2 / len(group)

    def check(node, group):
        best = 0.0
        for name, at, left in candidates:
            right = [r for r in group if (r[name] == at if left is None else not left if r[name] is None else r[name] > at)]
            rest = [r for r in group if r not in right]
            if len(right) >= 5 and len(rest) >= 5:
                best = max(best, squared(right) + squared(rest) - squared(group))
        if node.bit_length() > 3 or best < 1e-6:
            assert tree.place[node] < 0 and tree.value[node] == pytest.approx(sum(r.sales for r in group) / len(group))
            return
        assert tree.gain[node] == pytest.approx(best)
        place = tree.place[node]
        if place < 2:
            name, bound = "ab"[place], how.bounds[place][min(tree.cut[node], len(how.bounds[place]) - 1)]
            goes = lambda r: not tree.missing_left[node] if r[name] is None else r[name] > bound if tree.cut[node] < len(how.bounds[place]) else False
        else:
            goes = lambda r: r.warehouse_slot == place - 2 if place < 5 else r.l1_category_name_en_slot == place - 5
        check(2 * node, [r for r in group if not goes(r)])
        check(2 * node + 1, [r for r in group if goes(r)])

    check(1, rows)
    scored = boosting.BoostedTrees(how, 1.0, 0.5, [tree, tree]).transform(table).collect()
    ends = tree.walk(how.bins(pa.RecordBatch.from_pandas(table.toPandas())), how.inputs)
    by_key = {(r.unique_id, r.date): tree.value[e] for r, e in zip(rows, ends)}
    assert all(r.prediction == pytest.approx(1.0 + by_key[r.unique_id, r.date]) for r in scored)


def test_fitting_stops_once_the_error_rests():
    assert boosting.first_stop([5, 4, 3, 3.5, 3.2, 2.9], 2) == 3
    assert boosting.first_stop([5, 4, 3, 3.5, 2.9, 3], 2) is None
    assert boosting.first_stop([1, 1, 1], 2) == 1
    assert boosting.first_stop([], 2) is None


def test_thousands_of_categories_are_inputs(spark):
    known = spark.range(5000).select(F.lit("W").alias("warehouse"), F.format_string("c%05d", "id").alias(features.CATEGORY))
    table = known.select("warehouse", features.CATEGORY, F.lit(1.0).alias("dow")).limit(50)
    rows, names, sizes = boosting.coded(table, known, ["dow"])
    assert names.count() == 1 + 2 + 5001 and sizes == (2, 5001)
    assert sorted(r[0] for r in rows.select(f"{features.CATEGORY}_slot").collect()) == list(range(1, 51))


def test_a_drifted_parquet_source_fails(spark, tmp_path):
    spec = TABLES["test_weights"]
    for name, columns in {"missing": ["unique_id"], "mistyped": ["unique_id", "cast(weight AS string) AS weight"]}.items():
        spark.range(1).selectExpr("id AS unique_id", "1.5D AS weight").selectExpr(*columns).write.parquet(f"{tmp_path}/{name}")
        with pytest.raises(scan.SchemaDrift, match="weight"):
            scan.scan_parquet(spark, spec, f"{tmp_path}/{name}")
    spark.range(1).selectExpr("id AS unique_id", "1.5D AS weight", "'x' AS note").write.parquet(f"{tmp_path}/extra")
    assert scan.scan_parquet(spark, spec, f"{tmp_path}/extra").columns == ["unique_id", "weight"]


def test_a_dimension_grows_by_new_members_only(spark, frame, tmp_path):
    path = f"{tmp_path}/dimension"
    assert load.seed_dimension([frame([("A",), ("",), (None,)], "warehouse string")], path) == 1
    assert load.seed_dimension([frame([("A",), ("B",)], "warehouse string"), frame([("C",)], "warehouse string")], path) == 2
    assert load.seed_dimension([frame([("B",)], "warehouse string")], path) == 0
    assert sorted(r.warehouse for r in spark.read.parquet(path).collect()) == ["A", "B", "C"]


def test_the_latest_output_is_found_through_the_manifest(spark, tmp_path):
    for name, day in (("z", 1), ("a", 2)):
        artifacts.write_artifact(spark.range(day), f"{tmp_path}/{name}")
        row = artifacts.manifest_row(spark, "run", {}, {"run": f"{tmp_path}/{name}"}, "PASS", generated_at=datetime(2024, 1, day))
        artifacts.append_manifest(row, f"{tmp_path}/_manifest")
    assert artifacts.latest_output(spark, f"{tmp_path}/_manifest", "run").count() == 2
    with pytest.raises(artifacts.MissingArtifact):
        artifacts.latest_output(spark, f"{tmp_path}/_manifest", "other")
