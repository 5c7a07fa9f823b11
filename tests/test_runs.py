import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from larder.operators import boosting, quality, whatif
from larder.plans.planning_run import PlanningRun
from larder.plans.warehouse import open_warehouse
from larder.sources import load
from larder.sources.scan import scan_csv
from larder.sources.tables import TABLES
from larder.streaming.arrivals import load_arrivals


ROOT = Path(__file__).resolve().parents[1]


@pytest.fixture(scope="module")
def sources(spark, small_data, tmp_path_factory):
    """The derived tables as CSV, with the category levels filled in."""
    warehouse = open_warehouse(spark, small_data, "dense")
    folder = tmp_path_factory.mktemp("sources")
    for name, table in warehouse.tables().items():
        if name == "inventory":
            filled = {f"l{i}_category_name_en": F.coalesce(f"l{i}_category_name_en", "name") for i in (1, 2, 3, 4)}
            table = table.withColumns(filled)
        table.write.option("header", True).csv(f"{folder}/{name}.csv")
    return {name: scan_csv(spark, name, f"{folder}/{name}.csv") for name in TABLES}


def test_all_stages_run_and_agree(spark, sources, tmp_path):
    params = boosting.BoostingParams(max_rounds=6, patience=2, learning_rate=0.3, max_depth=3)
    run = PlanningRun(spark, str(tmp_path), boosting_params=params)
    manifest = run.run(sources)
    kinds = {r.kind for r in manifest.collect()}
    assert {"features", "risk", "recommendations", "simulation", "evaluation"} <= kinds
    risk_rows = spark.read.parquet(f"{tmp_path}/risk")
    recs = spark.read.parquet(f"{tmp_path}/recommendations")
    assert risk_rows.count() == recs.count() > 0
    assert spark.read.parquet(f"{tmp_path}/evaluation").filter("wmape IS NOT NULL").count() == 3
    summary = {r.scenario: r for r in spark.read.parquet(f"{tmp_path}/simulation_summary").collect()}
    assert summary[whatif.IDENTITY.tag].unmet_units_delta == 0.0
    again = run.check_and_load(sources)
    assert {s.outcome for s in again} == {"skipped"}
    fewer = dict(sources, test_weights=sources["test_weights"].orderBy("unique_id").limit(3))
    with pytest.raises(load.LoadRefused, match="test_weights"):
        run.run(fewer, boosted=False)


def test_a_failed_check_stops_the_run(spark, sources, tmp_path):
    broken = dict(sources, sales_train=sources["sales_train"].withColumn("sales", F.lit(-1.0)))
    with pytest.raises(quality.ValidationFailed, match="sales_train:numeric_sanity"):
        PlanningRun(spark, str(tmp_path)).run(broken)


def test_arriving_files_are_loaded_once(spark, tmp_path):
    inbox, target, checkpoint = (str(tmp_path / n) for n in ("inbox", "target", "checkpoint"))
    (tmp_path / "inbox").mkdir()
    (tmp_path / "inbox" / "one.csv").write_text("unique_id,weight\n1,2.5\n2,NaN\n")
    assert load_arrivals(spark, "test_weights", inbox, target, checkpoint) == 2
    assert load_arrivals(spark, "test_weights", inbox, target, checkpoint) == 2
    (tmp_path / "inbox" / "two.csv").write_text("unique_id,weight\n3,1\n")
    assert load_arrivals(spark, "test_weights", inbox, target, checkpoint) == 3
    stored = spark.read.parquet(target)
    assert stored.filter("weight IS NULL").count() == 1


def test_a_later_application_loads_only_what_is_new(spark, tmp_path):
    """Two applications and one target: each file is stored once, none is lost."""
    inbox, target = str(tmp_path / "inbox"), str(tmp_path / "target")
    (tmp_path / "inbox").mkdir()
    (tmp_path / "inbox" / "one.csv").write_text("unique_id,weight\n1,2.5\n")
    assert load_arrivals(spark, "test_weights", inbox, target) == 1
    (tmp_path / "inbox" / "two.csv").write_text("unique_id,weight\n2,1\n")
    code = (
        "import sys; from larder.session import build_session; from larder.streaming.arrivals import load_arrivals;"
        "s = build_session('later', cpus=1); print('rows', load_arrivals(s, 'test_weights', *sys.argv[1:])); s.stop()"
    )
    for _ in range(2):
        done = subprocess.run([sys.executable, "-c", code, inbox, target], cwd=ROOT, capture_output=True, text=True, timeout=300)
        assert "rows 2" in done.stdout, done.stderr[-2000:]


def test_queries_fit_the_declared_trees():
    from larder.plans.warehouse import BOOSTING

    assert BOOSTING == boosting.BoostingParams()
