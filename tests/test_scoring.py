from datetime import date

import pytest

from larder.operators import scoring

PAIRS = "sales double, prediction double, weight double"


def score(frame, rows, metric):
    return frame(rows, PAIRS).agg(metric.alias("m")).first().m


def test_metrics_by_hand(frame):
    rows = [(100.0, 110.0, 10.0), (1.0, 2.0, 1.0)]
    assert score(frame, rows, scoring.wmape()) == pytest.approx(11 / 101)
    assert score(frame, rows, scoring.wmape(weight="weight")) == pytest.approx(101 / 1001)
    assert score(frame, rows, scoring.mae()) == pytest.approx(5.5)
    assert score(frame, rows, scoring.rmse()) == pytest.approx((101 / 2) ** 0.5)


def test_incomplete_pairs_are_left_out_with_their_weight(frame):
    rows = [(10.0, 12.0, 1.0), (None, 5.0, 100.0), (5.0, None, 100.0)]
    for metric in (scoring.wmape(), scoring.wmape(weight="weight")):
        assert score(frame, rows, metric) == pytest.approx(0.2)
    assert score(frame, rows, scoring.mae()) == 2.0


def test_undefined_metrics_are_null(frame):
    assert score(frame, [(0.0, 5.0, 1.0)], scoring.wmape()) is None
    assert score(frame, [(None, 5.0, 1.0)], scoring.mae()) is None
    assert score(frame, [], scoring.rmse()) is None


HOLDOUT = "unique_id long, date date, warehouse string, sales double"
DAY = date(2024, 5, 6)


def inputs(frame, predicted=(1, 2), weighted=(1, 2)):
    holdout = frame([(1, DAY, "A", 10.0), (2, DAY, "B", 20.0)], HOLDOUT)
    predictions = frame([(i, DAY, 12.0) for i in predicted], "unique_id long, date date, prediction double")
    weights = frame([(i, float(i)) for i in weighted], "unique_id long, weight double")
    return predictions, holdout, weights


def test_evaluate_scores_overall_and_per_warehouse(frame):
    rows = {(r.scope, r.warehouse): r for r in scoring.evaluate(*inputs(frame)).collect()}
    assert set(rows) == {("overall", None), ("warehouse", "A"), ("warehouse", "B")}
    assert rows["overall", None].wmape == pytest.approx(10 / 30, abs=1e-6)
    assert rows["overall", None].wmape_weighted == pytest.approx(18 / 50, abs=1e-6)
    assert rows["warehouse", "A"].mae == 2.0 and rows["warehouse", "B"].n_rows == 1


@pytest.mark.parametrize(
    "gap, message", [({"predicted": (1,)}, "1 holdout rows lack a prediction"),
                     ({"weighted": (2,)}, "1 holdout rows lack a weight")]
)
def test_incomplete_evaluation_fails(frame, gap, message):
    with pytest.raises(Exception, match=message):
        scoring.evaluate(*inputs(frame, **gap)).collect()


def test_model_comparison(frame):
    models = frame([("a", 0.5), ("b", 0.25)], "model string, wmape double")
    assert [tuple(r) for r in scoring.compare(models, "b").collect()] == [("a", 0.5, -0.25)]
