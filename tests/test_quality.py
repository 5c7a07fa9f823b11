import json
from datetime import date

import pytest
from compare import days
from pyspark.sql import types as T

from larder.operators import quality
from larder.sources.tables import TableSpec

SCHEMA = "unique_id long, date date, warehouse string, sales double"
KINDS = {"long": T.LongType(), "date": T.DateType(), "string": T.StringType(), "double": T.DoubleType()}


def declared(text):
    schema = T.StructType()
    for part in text.split(", "):
        name, kind = part.split()
        schema.add(name, KINDS[kind])
    return schema


SPEC = TableSpec("panel", declared(SCHEMA), key=("unique_id", "date"))


def clean_rows():
    return [(i, d, f"W_{i + 1}", 10.0) for i in (0, 1) for d in days("2024-01-01", 5)]


def only(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].status, json.loads(rows[0].details)


def test_clean_panel_passes_all_checks(frame):
    report = quality.table_checks(frame(clean_rows(), SCHEMA), SPEC).collect()
    assert {r.check_name for r in report} == {
        "schema", "missingness", "numeric_sanity", "duplicates", "date_continuity"
    }
    assert {r.status for r in report} == {"PASS"}


@pytest.mark.parametrize(
    "schema, status",
    [
        ("unique_id long, date date, warehouse string", "FAIL"),
        ("unique_id string, date date, warehouse string, sales double", "FAIL"),
        ("unique_id int, date timestamp, warehouse string, sales long", "PASS"),
        ("unique_id long, date date, warehouse string, sales boolean", "FAIL"),
        ("unique_id long, date date, warehouse string, sales double, extra int", "WARN"),
    ],
)
def test_schema_families(frame, schema, status):
    assert only(quality.schema_check(frame([], schema), SPEC))[0] == status


def test_duplicates_count_all_copies(frame):
    rows = clean_rows()
    rows += [r for r in rows if r[1] == date(2024, 1, 1)]
    status, details = only(quality.duplicate_check(frame(rows, SCHEMA), SPEC))
    assert status == "FAIL"
    assert details["duplicate_rows"] == 4 and details["duplicate_key_groups"] == 2


def test_null_keys_group_together(frame):
    rows = [(None, date(2024, 1, 1), "W", 1.0)] * 2
    assert quality.duplicate_evidence(frame(rows, SCHEMA), ["unique_id", "date"]).first()[0] == 2


def test_missing_day_is_counted_per_group(frame):
    rows = [r for r in clean_rows() if r[:2] != (0, date(2024, 1, 3))]
    status, details = only(quality.date_continuity_check(frame(rows, SCHEMA), SPEC))
    assert status == "WARN"
    assert details["missing_days_by_group"] == {"W_1": 1}
    missing = quality.missing_dates(frame(rows, SCHEMA), "warehouse").collect()
    assert [tuple(r) for r in missing] == [("W_1", date(2024, 1, 3))]


@pytest.mark.parametrize("nulls, status", [(0, "PASS"), (3, "WARN"), (5, "WARN"), (6, "FAIL"), (10, "FAIL")])
def test_null_share(frame, nulls, status):
    rows = [(*r[:3], None if i < nulls else r[3]) for i, r in enumerate(clean_rows())]
    assert only(quality.missingness_check(frame(rows, SCHEMA), SPEC))[0] == status


def test_null_by_design_never_escalates(frame):
    spec = TableSpec("panel", SPEC.schema, SPEC.key, frozenset({"sales"}))
    rows = [(*r[:3], None) for r in clean_rows()]
    status, details = only(quality.missingness_check(frame(rows, SCHEMA), spec))
    assert status == "PASS"
    assert details["columns_affected"]["sales"] == {"count": 10, "pct": 1.0}


NUMERIC = "sales double, sell_price_main double, availability double, type_0_discount double"
NUMERIC_SPEC = TableSpec("panel", declared(NUMERIC))


def numeric(frame, rows, **options):
    return only(quality.numeric_check(frame(rows, NUMERIC), NUMERIC_SPEC, **options))


def test_impossible_values_fail(frame):
    good = (1.0, 1.0, 1.0, 0.0)
    for bad in [(-1.0, 1.0, 1.0, 0.0), (1.0, -1.0, 1.0, 0.0), (1.0, 1.0, 1.1, 0.0), (1.0, 1.0, -0.1, 0.0)]:
        status, details = numeric(frame, [good] * 9 + [bad])
        assert status == "FAIL" and sum(details["impossible_values"].values()) == 1


def test_sparse_outliers_warn_and_material_ones_fail(frame):
    rows = [(1.0, 1.0, 1.0, 1.5 if i < 2 else 0.1) for i in range(10)]
    status, details = numeric(frame, rows, max_outlier_share=0.5)
    assert status == "WARN" and details["outliers"]["type_0_discount_outside_0_1"] == 2
    assert numeric(frame, [(1.0, 1.0, 1.0, -0.2)] * 10)[0] == "FAIL"


def test_nulls_are_not_outliers(frame):
    assert numeric(frame, [(None, None, None, None)] * 3)[0] == "PASS"


def test_unknown_references_fail_and_unused_ones_warn(frame):
    rows = [(99 - r[0], *r[1:]) for r in clean_rows()]
    known = frame([(0,), (1,)], "unique_id long")
    status, details = only(
        quality.referential_check(frame(rows, SCHEMA), SPEC, "unique_id", known, "inventory")
    )
    assert status == "FAIL"
    assert details == {"unknown_key_rows": 10, "unknown_key_examples": "98,99"}
    extra = frame([(0,), (1,), (7,)], "unique_id long")
    used = frame(clean_rows(), SCHEMA)
    status, details = only(quality.coverage_check(extra, SPEC, "unique_id", used, "panel"))
    assert status == "WARN" and details["extra_key_examples"] == "7"


def test_null_reference_is_unknown_unless_known_set_has_null(frame):
    df = frame([(None,), (1,)], "unique_id long")
    assert quality.reference_evidence(df, "unique_id", frame([(1,)], "unique_id long")).first()[0] == 1
    with_null = frame([(1,), (None,)], "unique_id long")
    assert quality.reference_evidence(df, "unique_id", with_null).first()[0] == 0


def test_overall_takes_the_worst_and_the_gate_raises(frame):
    schema = "table_name string, check_name string, status string, details string"
    passing = frame([("t", "a", "PASS", ""), ("t", "b", "WARN", "")], schema)
    assert quality.overall(passing).first().overall == "WARN"
    quality.require_valid(passing)
    failing = passing.unionByName(frame([("t", "c", "FAIL", "")], schema))
    assert tuple(quality.overall(failing).first()) == (1, 1, 1, "FAIL")
    assert quality.exceptions(failing).count() == 2
    with pytest.raises(quality.ValidationFailed, match="t:c"):
        quality.require_valid(failing)


def test_day_bitmaps_merge_and_give_the_missing_days(frame):
    """Days of any century, groups that lie in several stretches of bits, and states of parts that add up to that of the whole."""
    import random

    rng = random.Random(2)
    ordinals = {"A": [1, 700, 719_163, 719_163 + 32_767, 719_163 + 32_768], "B": [rng.randrange(738_000, 738_400) for _ in range(200)], "C": [738_000], None: [738_000]}
    rows = [(g, date.fromordinal(o)) for g, found in ordinals.items() for o in found for _ in range(2)] + [("B", None)]
    rng.shuffle(rows)
    table = frame(rows, "warehouse string, date date")
    got = {r.group_value: r for r in quality.date_continuity_evidence(table, "warehouse").collect()}
    for g in "ABC":
        distinct = sorted(set(ordinals[g]))
        assert (got[g].n_days, got[g].missing_days) == (len(distinct), distinct[-1] - distinct[0] + 1 - len(distinct))
    assert set(got) == {"A", "B", "C"}
    parts = [quality.day_bitmaps(frame(rows[i::3], "warehouse string, date date"), "warehouse") for i in range(3)]
    merged = quality.date_continuity_of(quality.merged_bitmaps(*parts))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, got.values()))
    missing = quality.missing_dates(table.filter("warehouse IN ('B', 'C')"), "warehouse").collect()
    distinct = set(ordinals["B"])
    assert sorted(r.date.toordinal() for r in missing) == [o for o in range(min(distinct), max(distinct)) if o not in distinct]
    across = frame([("D", date.fromordinal(719_163 + 32_760)), ("D", date.fromordinal(719_163 + 32_775))], "warehouse string, date date")
    assert quality.missing_dates(across, "warehouse").count() == 14
    for plan in (quality.date_continuity_evidence(table, "warehouse"), quality.missing_dates(table, "warehouse")):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in text and "distinct" not in text.lower().replace("isdistinct", "")
