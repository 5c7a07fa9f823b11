from datetime import date

import pytest
from compare import days
from pyspark.sql import functions as F

from larder.operators import readside, replenish, risk, whatif

FORECAST = "unique_id long, date date, prediction double"
AVAILABILITY = "unique_id long, recent_availability double, n_days_observed long, low_avail_days long"


def scored(frame, units, availability, n_days=28):
    forecasts = frame([(1, d, units / 28) for d in days("2024-05-06", 28)], FORECAST)
    seen = [] if n_days is None else [(1, availability, n_days, 0)]
    return risk.stockout_risk(forecasts, frame(seen, AVAILABILITY)).first()


@pytest.mark.parametrize(
    "units, availability, tier",
    [
        (280.0, 0.0, "HIGH"),
        (280.0, 1.0, "LOW"),
        (200.0, 0.95, "MEDIUM"),
        (280.0, 0.9, "HIGH"),
        (280.0, 1 - 10 / 280, "LOW"),
        (0.0, 0.0, "LOW"),
    ],
)
def test_tier_edges(frame, units, availability, tier):
    assert scored(frame, units, availability).risk_tier == tier


def test_missing_availability_is_a_gap(frame):
    row = scored(frame, 280.0, None, n_days=None)
    assert row.availability_data_gap and row.assumed_future_availability == 1.0
    assert row.risk_tier == "LOW" and row.estimated_unmet_units == 0.0


def test_rows_without_a_value_are_no_gap(frame):
    row = scored(frame, 280.0, None)
    assert not row.availability_data_gap and row.assumed_future_availability == 1.0


def test_negative_forecast_is_low(frame):
    row = scored(frame, -28.0, 0.5)
    assert (row.estimated_unmet_units, row.risk_fraction, row.risk_tier) == (-14.0, 0.0, "LOW")


def test_recent_window_excludes_its_end(frame):
    rows = [(1, d, a) for d, a in zip(days("2024-04-07", 31), [0.0] + [0.4] * 14 + [1.0] * 14 + [0.0] * 2)]
    panel = frame(rows, "unique_id long, date date, availability double")
    row = risk.recent_availability(panel, F.lit(date(2024, 5, 6))).first()
    assert (row.n_days_observed, row.low_avail_days) == (28, 14)
    assert row.recent_availability == pytest.approx(0.7)


RISK = (
    "unique_id long, name string, warehouse string, risk_tier string, forecast_units double, "
    "recent_availability double, assumed_future_availability double, estimated_unmet_units double, "
    "risk_fraction double, availability_data_gap boolean"
)


def risk_row(**changes):
    row = dict(
        unique_id=1, name="Milk", warehouse="W_1", risk_tier="HIGH", forecast_units=500.0,
        recent_availability=0.6, assumed_future_availability=0.6, estimated_unmet_units=200.0,
        risk_fraction=0.4, availability_data_gap=False,
    )
    row.update(changes)
    return tuple(row.values())


def recommend(frame, **changes):
    return replenish.recommendations(frame([risk_row(**changes)], RISK)).first()


def test_high_risk_is_replenished_now(frame):
    row = recommend(frame)
    assert (row.action, row.rule_id, row.priority) == ("replenish_now", "R1_high_risk_replenish", 1)
    assert row.recommended_units == 225
    assert row.rationale == (
        "Tier HIGH: forecast 500 units over the horizon at 60% observed availability; assuming future "
        "availability equals recent, ~200 units would go unmet. Replenish_now: recommend 225 units "
        "(+10% safety margin, packed in 5s)."
    )
    assert row.assumptions == (
        "ASSUMED: future availability = recent observed (60%) | ASSUMED: safety margin 10%, pack size 5"
    )


@pytest.mark.parametrize("unmet", [0.0, 0.01, 1.0, 4.54, 4.55, 5.0, 12.34, 99.99, 1000.0, 123456.78])
def test_quantity_covers_the_need_within_margin_and_one_pack(frame, unmet):
    units = recommend(frame, estimated_unmet_units=unmet).recommended_units
    assert units % 5 == 0
    assert unmet <= units <= unmet * 1.1 + 5
    assert (units == 0) == (unmet == 0)


@pytest.mark.parametrize(
    "changes, action, rule, units, priority",
    [
        ({"availability_data_gap": True}, "investigate_data", "R4_availability_data_gap", 0, 1),
        ({"assumed_future_availability": None}, "investigate_data", "R4_availability_data_gap", 0, 1),
        ({"risk_tier": "MEDIUM"}, "replenish_scheduled", "R2_medium_risk_schedule", 225, 2),
        ({"risk_tier": "LOW"}, "monitor", "R3_monitor", 0, 4),
        ({"risk_tier": "EXTREME"}, "monitor", "R0_unknown_tier", 0, 4),
        ({"risk_tier": "EXTREME", "availability_data_gap": True}, "investigate_data",
         "R4_availability_data_gap", 0, 3),
        ({"risk_tier": "LOW", "availability_data_gap": True}, "investigate_data",
         "R4_availability_data_gap", 0, 4),
    ],
)
def test_every_condition_has_an_action(frame, changes, action, rule, units, priority):
    row = recommend(frame, **changes)
    assert (row.action, row.rule_id, row.recommended_units, row.priority) == (action, rule, units, priority)
    assert row.action in replenish.ACTIONS
    if changes.get("risk_tier") == "EXTREME" and action == "monitor":
        assert "EXTREME" in row.rationale and row.assumptions == ""


def test_priority_order_and_total_coverage(frame):
    rows = [
        risk_row(unique_id=1, risk_tier="LOW"),
        risk_row(unique_id=2, risk_tier="MEDIUM", estimated_unmet_units=6.0),
        risk_row(unique_id=3, estimated_unmet_units=50.0),
        risk_row(unique_id=4, estimated_unmet_units=300.0),
    ]
    table = frame(rows, RISK)
    recs = replenish.recommendations(table)
    assert [r.unique_id for r in replenish.by_priority(recs).collect()] == [4, 3, 2, 1]
    assert tuple(replenish.coverage(table, recs).first()) == (4, 4, 4)


def test_missing_columns_are_all_named(frame):
    with pytest.raises(replenish.ContractViolation, match="risk_tier.*risk_fraction"):
        replenish.recommendations(frame([risk_row()], RISK).drop("risk_tier", "risk_fraction"))


def scenario_rows(frame):
    return frame(
        [
            risk_row(unique_id=1),
            risk_row(unique_id=2, recent_availability=1.0, assumed_future_availability=1.0,
                     estimated_unmet_units=0.0),
            risk_row(unique_id=3, recent_availability=None, assumed_future_availability=None,
                     estimated_unmet_units=0.0, availability_data_gap=True),
        ],
        RISK,
    )


@pytest.mark.parametrize(
    "scenario, unmet",
    [
        (whatif.Scenario(1.0, 0.0, 0.0), 200.0),
        (whatif.Scenario(1.2), 240.0),
        (whatif.Scenario(availability_improvement=0.2), 100.0),
        (whatif.Scenario(2.0, 0.5, 0.1), 450.0),
        (whatif.Scenario(availability_improvement=1.0), 0.0),
    ],
)
def test_levers(frame, scenario, unmet):
    rows = {r.unique_id: r for r in whatif.apply_scenarios(scenario_rows(frame), [scenario]).collect()}
    assert rows[1].scenario_unmet_units == pytest.approx(unmet, abs=0.01)
    assert rows[1].baseline_unmet_units == rows[1].estimated_unmet_units == 200.0
    assert rows[2].scenario_unmet_units == rows[3].scenario_unmet_units == 0.0
    assert rows[3].scenario_availability == 1.0


def test_grid_equals_single_scenarios(frame):
    table, levers = scenario_rows(frame), [whatif.IDENTITY, whatif.Scenario(1.5), whatif.Scenario(0.5, 0.1, 0.3)]
    grid = sorted(map(str, whatif.apply_scenarios(table, levers).collect()))
    single = sorted(str(r) for s in levers for r in whatif.apply_scenarios(table, [s]).collect())
    assert grid == single


def test_identity_gate(frame):
    assert whatif.identity_gate(scenario_rows(frame)).first().max_drift < 0.01
    broken = scenario_rows(frame).withColumn("estimated_unmet_units", F.col("estimated_unmet_units") + 1)
    with pytest.raises(Exception, match="drifted"):
        whatif.identity_gate(broken).collect()


@pytest.mark.parametrize("levers", [(-0.1, 0, 0), (1, -0.1, 0), (1, 0, -0.1), (1, 0, 1.1)])
def test_levers_out_of_range(levers):
    with pytest.raises(whatif.InvalidScenario):
        whatif.Scenario(*levers)


@pytest.mark.parametrize(
    "levers, tag", [((1.2, 0.356, 0.1), "dm1p2_pu0p356_ai0p1"), ((1.0, 0.0, 0.0), "dm1_pu0_ai0")]
)
def test_tags(levers, tag):
    assert whatif.Scenario(*levers).tag == tag


def test_top_increases_keeps_the_largest_per_scenario(frame):
    rows = [risk_row(unique_id=i, forecast_units=float(i), estimated_unmet_units=0.0) for i in range(1, 400)]
    simulated = whatif.apply_scenarios(frame(rows, RISK), [whatif.IDENTITY, whatif.Scenario(2.0)])
    top = whatif.top_increases(simulated, 10).collect()
    for tag in ("dm1_pu0_ai0", "dm2_pu0_ai0"):
        mine = sorted((r["rank"], r.unique_id) for r in top if r.scenario == tag)
        assert mine == [(k, 400 - k) for k in range(1, 11)]


def test_lookups(frame):
    forecasts = frame([(1, d, 2.0) for d in days("2024-05-06", 28)], FORECAST)
    assert readside.series_forecast(forecasts, 1, 5).count() == 5
    with pytest.raises(readside.UnknownSeries):
        readside.series_forecast(forecasts, 2)
    with pytest.raises(ValueError):
        readside.series_forecast(forecasts, 1, 501)
    table = scenario_rows(frame)
    assert readside.risk_list(table, "HIGH", 2).count() == 2
    assert readside.gap_count(table).first().data_gaps == 1
    indicators = readside.kpis(table, replenish.recommendations(table)).first()
    assert indicators.n_high == 3 and indicators.n_replenish_now == 2
    with pytest.raises(readside.UnknownValue, match="HGIH"):
        readside.risk_list(table, "HGIH")
    with pytest.raises(readside.UnknownValue, match="one of replenish_now"):
        readside.recommendation_list(replenish.recommendations(table), "order")
