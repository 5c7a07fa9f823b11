import random
from datetime import date, timedelta

import pytest
from compare import days

from larder.operators import baselines, features, timeline
from larder.operators.distribution import discrete_percentiles

HISTORY = "unique_id long, date date, sales double"


def brute_line(rows):
    """Day-by-day values of one series, None before the first known one."""
    known = dict(rows)
    day, end, held, line = min(known), max(known), None, {}
    while day <= end:
        if known.get(day) is not None:
            held = known[day]
        line[day] = held
        day += timedelta(days=1)
    return line


@pytest.fixture(scope="module")
def gappy():
    draw = random.Random(7)
    start = date(2024, 1, 1)
    rows = []
    for series in range(6):
        for offset in range(150):
            if draw.random() < 0.4:
                value = None if draw.random() < 0.15 else float(draw.randint(0, 50))
                rows.append((series, start + timedelta(days=offset), value))
    return rows


def by_series(rows):
    grouped = {}
    for series, day, value in rows:
        grouped.setdefault(series, []).append((day, value))
    return grouped


def test_regularize_fills_gaps(frame, gappy):
    ours = {(r.unique_id, r.date): r.sales for r in timeline.regularize(frame(gappy, HISTORY)).collect()}
    expected = {
        (s, d): (v or 0.0) for s, rows in by_series(gappy).items() for d, v in brute_line(rows).items()
    }
    assert ours == expected


def test_lags_and_rolling_means_equal_the_daily_line(frame, gappy):
    result = timeline.with_history(frame(gappy, HISTORY)).collect()
    lines = {s: brute_line(rows) for s, rows in by_series(gappy).items()}
    assert len(result) == len(gappy)
    for row in result:
        line = lines[row.unique_id]
        for k in timeline.LAGS:
            assert row[f"lag_{k}"] == line.get(row.date - timedelta(days=k))
        for w in timeline.ROLLING_WINDOWS:
            window = [line.get(row.date - timedelta(days=28 + i)) for i in range(w)]
            window = [v for v in window if v is not None]
            mean = row[f"rmean_{w}_lag28"]
            if len(window) < 7:
                assert mean is None
            else:
                assert mean == pytest.approx(sum(window) / len(window))


@pytest.mark.parametrize("operator", [timeline.regularize, timeline.with_history, baselines.series_profile])
def test_two_rows_for_a_day_fail(frame, operator):
    rows = [(1, date(2024, 1, 1), 5.0), (1, date(2024, 1, 1), 6.0), (1, date(2024, 1, 2), 7.0)]
    with pytest.raises(Exception, match="two rows for one day in series 1"):
        operator(frame(rows, HISTORY)).collect()


def forecast(frame, rows, dates, model, declared=None, window=28):
    profile = baselines.series_profile(frame(rows, HISTORY), window)
    horizon = baselines.horizon_dates(frame([(d,) for d in dates], "date date"))
    ids = frame([(i,) for i in declared], "unique_id long") if declared else None
    return {(r.unique_id, r.date): r for r in model(profile, horizon, ids).collect()}


def weekly():
    return [(1, d, 20.0 if d.weekday() >= 5 else 10.0) for d in days("2024-01-01", 56)]


def test_naive_repeats_the_last_week(frame):
    result = forecast(frame, weekly(), days("2024-02-26", 28), baselines.seasonal_naive)
    assert len(result) == 28
    for (_, day), row in result.items():
        assert row.prediction == (20.0 if day.weekday() >= 5 else 10.0)
        assert row.method == "last_week"


def test_moving_average_is_flat(frame):
    result = forecast(frame, weekly(), days("2024-02-26", 28), baselines.moving_average)
    (value,) = {row.prediction for row in result.values()}
    assert value == pytest.approx((5 * 10 + 2 * 20) / 7)


def test_gap_is_filled_before_the_week_is_taken(frame):
    rows = [(1, date(2024, 1, 1), 5.0), (1, date(2024, 1, 5), 15.0)]
    result = forecast(frame, rows, days("2024-01-06", 7), baselines.seasonal_naive)
    assert result[1, date(2024, 1, 12)].prediction == 15.0
    saturday = result[1, date(2024, 1, 6)]
    assert saturday.prediction == 7.0 and saturday.method == "series_mean"


def test_cold_start_and_unknown_series(frame):
    rows = [(1, date(2024, 1, 5), 5.0), (1, date(2024, 1, 6), 10.0), (1, date(2024, 1, 7), 15.0)]
    result = forecast(frame, rows, days("2024-01-08", 7), baselines.seasonal_naive, declared=[1, 2])
    assert result[1, date(2024, 1, 8)].prediction == 10.0
    assert {r.method for (s, _), r in result.items() if s == 2} == {"global_mean"}
    assert {r.prediction for (s, _), r in result.items() if s == 2} == {10.0}


def test_moving_average_window_ends_at_the_newest_day(frame):
    rows = [(1, d, 4.0) for d in days("2024-01-01", 10)] + [(2, d, 8.0) for d in days("2024-03-01", 10)]
    result = forecast(frame, rows, days("2024-03-11", 1), baselines.moving_average)
    assert result[2, date(2024, 3, 11)].prediction == 8.0
    lapsed = result[1, date(2024, 3, 11)]
    assert lapsed.method == "global_mean" and lapsed.prediction == 6.0


def test_leading_null_counts_as_zero_in_baselines(frame):
    rows = [(1, date(2024, 1, 1), None), (1, date(2024, 1, 2), 6.0)]
    result = forecast(frame, rows, days("2024-01-03", 1), baselines.moving_average)
    assert result[1, date(2024, 1, 3)].prediction == 3.0


def test_bad_inputs_are_refused(frame):
    with pytest.raises(ValueError, match="sales"):
        baselines.check_history(frame([], "unique_id long, date date"))
    with pytest.raises(ValueError, match="empty"):
        baselines.check_history(frame([], HISTORY))
    with pytest.raises(ValueError, match="positive"):
        baselines.series_profile(frame(weekly(), HISTORY), 0)


def test_fallback_report_counts_series_and_rows(frame):
    rows = weekly() + [(2, date(2024, 2, 25), 3.0)]
    profile = baselines.series_profile(frame(rows, HISTORY))
    horizon = baselines.horizon_dates(frame([(d,) for d in days("2024-02-26", 28)], "date date"))
    report = baselines.fallback_report(baselines.seasonal_naive(profile, horizon))
    assert {r.method: (r.n_series, r.n_rows) for r in report.collect()} == {
        "last_week": (2, 32), "series_mean": (1, 24)
    }


PANEL = "unique_id long, date date, warehouse string, sales double, sell_price_main double, " + ", ".join(
    f"type_{i}_discount double" for i in range(7)
)


def feature_inputs(frame, spike=None):
    panel = [
        (1, d, "W_1", spike if spike is not None and i >= 92 else 10.0, 3.0, *[0.1] * 7)
        for i, d in enumerate(days("2024-01-01", 120))
    ]
    calendar = [("W_1", d, 0, 0, 0, 0) for d in days("2024-01-01", 120)]
    return (
        frame(panel, PANEL),
        frame(calendar, "warehouse string, date date, holiday int, shops_closed int, "
                        "winter_school_holidays int, school_holidays int"),
        frame([(1, "Bakery")], "unique_id long, l1_category_name_en string"),
    )


VALUES = {"warehouse": ["W_1", "W_2"], features.CATEGORY: ["Bakery"]}


def test_feature_values(frame):
    rows = features.feature_frame(*feature_inputs(frame), VALUES).orderBy("date").collect()
    assert len(rows) == 120
    assert rows[27].lag_28 is None and rows[28].lag_28 == 10.0
    assert rows[33].rmean_7_lag28 is None and rows[34].rmean_7_lag28 == 10.0
    assert rows[0].discount_total == pytest.approx(0.7)
    assert (rows[0].dow, rows[0].day_of_month, rows[0].month) == (0, 1, 1)
    assert (rows[0].warehouse_W_1, rows[0].warehouse_W_2, rows[0].l1_category_name_en_Bakery) == (1, 0, 1)


def test_holdout_features_do_not_see_the_holdout(frame):
    audit = features.leak_audit(feature_inputs(frame)[0], VALUES).collect()
    assert sorted(map(tuple, audit)) == sorted(map(tuple, features.leak_trial(*feature_inputs(frame), VALUES).collect()))
    assert {r.n_changed for r in audit} == {0}
    assert {r.n_rows for r in audit} == {28}
    spiked = features.feature_frame(*feature_inputs(frame, spike=1000.0), VALUES)
    top = spiked.orderBy("date").collect()[-28:]
    assert max(r[name] for r in top for name in features.HISTORY_FEATURES) == 10.0


def test_planted_leaks_are_found(frame):
    panel, _, _ = feature_inputs(frame)
    audit = {r.feature: r.n_changed for r in features.leak_audit(panel, VALUES, lags=(27, 28, 1), windows=(7,), shift=27).collect()}
    assert (audit["lag_27"], audit["lag_28"], audit["lag_1"], audit["rmean_7_lag27"], audit["dow"]) == (1, 0, 27, 1, 0)


def test_the_audit_is_one_pass_without_a_join(frame):
    plan = features.leak_audit(feature_inputs(frame)[0], VALUES)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_temporal_split_has_28_day_parts(frame):
    panel, _, _ = feature_inputs(frame)
    counts = {r.split: r["count"] for r in features.temporal_split(panel).groupBy("split").count().collect()}
    assert counts == {"train": 64, "validation": 28, "holdout": 28}
    history, holdout = features.history_and_holdout(panel)
    assert (history.count(), holdout.count()) == (92, 28)


def test_categories_are_numbered_in_order(frame):
    df = frame([("b",), ("a",), (None,), ("b",)], "c string")
    assert features.categories(df, "c") == ["a", "b"]
    assert {r.c: r.slot for r in features.category_index(df, "c").collect()} == {"a": 1, "b": 2}


@pytest.mark.parametrize("slices", [2, 7, 64])
def test_percentiles_equal_sorting(frame, slices):
    draw = random.Random(slices)
    values = [float(draw.choice([1, 1, 1, 2, draw.randint(0, 400)])) for _ in range(501)] + [None] * 5
    wanted = {"p10": 0.1, "p50": 0.5, "p99": 0.99, "top": 1.0}
    result = discrete_percentiles(frame([(v,) for v in values], "v double"), "v", wanted, slices).first()
    ordered = sorted(v for v in values if v is not None)
    for name, fraction in wanted.items():
        rank = -(-fraction * len(ordered) // 1)
        assert result[name] == ordered[max(int(rank), 1) - 1]
