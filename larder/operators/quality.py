"""Data-quality gate: quantified checks that report and never repair.

Each check is one aggregate whose result is a row

    table_name, check_name, status, details (JSON text)

so a whole report is a union of a few dozen rows.  The evidence behind a check
is available on its own (``*_evidence``) with typed columns.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.scan import schema_drift
from ..sources.tables import TableSpec

PASS, WARN, FAIL = "PASS", "WARN", "FAIL"
SEVERITY = {PASS: 0, WARN: 1, FAIL: 2}
MAX_NULL_SHARE = 0.5
MAX_OUTLIER_SHARE = 0.001
EXAMPLES = 10


class ValidationFailed(RuntimeError):
    """At least one check failed; downstream stages must not run."""


def _status(fail: Column, warn: Column) -> Column:
    return F.when(fail, FAIL).when(warn, WARN).otherwise(PASS)


def _result(name: str, table: str, status: Column, details: Column) -> list[Column]:
    return [
        F.lit(table).alias("table_name"),
        F.lit(name).alias("check_name"),
        status.alias("status"),
        details.alias("details"),
    ]


def schema_check(df: DataFrame, spec: TableSpec, name: str | None = None) -> DataFrame:
    """Missing columns or another type family fail, extra columns warn.

    Reads metadata only; the result has one row and costs no scan.  Give it a
    source as it is stored: a frame with the declared schema can only pass.
    """
    missing, unexpected, mismatched = schema_drift(df.schema, spec)
    status = FAIL if missing or mismatched else WARN if unexpected else PASS
    details = F.to_json(
        F.struct(
            _texts(missing).alias("missing_columns"),
            _texts(unexpected).alias("unexpected_columns"),
            _text_map(mismatched).alias("dtype_mismatches"),
        )
    )
    row = df.sparkSession.range(1)
    return row.select(*_result("schema", name or spec.name, F.lit(status), details))


def _texts(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def _text_map(values: Mapping[str, str]) -> Column:
    pairs = [F.lit(part) for item in values.items() for part in item]
    return F.create_map(*pairs).cast("map<string,string>") if pairs else F.create_map().cast("map<string,string>")


# --- one pass over a table: null counts and impossible values ---------------
#
# These expressions are SQL text: a wide table has hundreds of them, and text
# is parsed in one call where columns would be built one call per operator.

_IMPOSSIBLE = {
    "negative_sales": ("sales", "{0} < 0"),
    "negative_price": ("sell_price_main", "{0} < 0"),
    "availability_outside_0_1": ("availability", "{0} < 0 OR {0} > 1"),
}


def _counts(rules: Mapping[str, str]) -> str:
    """A map from rule name to the number of rows that meet its condition."""
    pairs = ", ".join(f"'{name}', count_if({condition})" for name, condition in rules.items())
    return f"CAST(map({pairs}) AS MAP<STRING, BIGINT>)"


def _rules(columns: list[str]) -> tuple[dict[str, str], dict[str, str]]:
    """Conditions of impossible values and of outliers that apply to these columns."""
    impossible = {rule: test.format(f"`{column}`") for rule, (column, test) in _IMPOSSIBLE.items() if column in columns}
    outliers = {f"{c}_outside_0_1": f"`{c}` < 0 OR `{c}` > 1" for c in columns if c.endswith("_discount")}
    return impossible, outliers


def _profile_columns(columns: list[str]) -> list[Column]:
    impossible, outliers = _rules(columns)
    return [
        F.expr("count(1) AS n_rows"),
        F.expr(_counts({c: f"`{c}` IS NULL" for c in columns}) + " AS nulls"),
        F.expr(_counts(impossible) + " AS impossible"),
        F.expr(_counts(outliers) + " AS outliers"),
    ]


def table_profile(df: DataFrame) -> DataFrame:
    """Row count, nulls per column and rule violations, in one aggregate."""
    return df.agg(*_profile_columns(df.columns))


def profiles_by(df: DataFrame, part: str, *more: Column) -> DataFrame:
    """The profile of each part of a table, with further aggregates; profiles merge by :func:`merged_profile`."""
    columns = [c for c in df.columns if c != part]
    return df.groupBy(part).agg(*_profile_columns(columns), *more)


def merged_profile(profiles: DataFrame, columns: list[str]) -> DataFrame:
    """The profile of a table from those of its parts; ``columns`` are the table's."""
    impossible, outliers = _rules(columns)
    wanted = {"nulls": columns, "impossible": impossible, "outliers": outliers}
    sums = []
    for kind, names in wanted.items():
        pairs = ", ".join(f"'{name}', coalesce(sum({kind}['{name}']), 0L)" for name in names)
        sums.append(F.expr(f"CAST(map({pairs}) AS MAP<STRING, BIGINT>) AS {kind}"))
    return profiles.agg(F.expr("coalesce(sum(n_rows), 0L) AS n_rows"), *sums)


_SHARE = "CAST(round(CAST({0} / nullif(n_rows, 0) AS DECIMAL(38, 12)), 6) AS DOUBLE)"


def missingness_evidence(df: DataFrame, spec: TableSpec, max_fail_share: float = MAX_NULL_SHARE) -> DataFrame:
    """One row per column: nulls, share, whether they are by design, status."""
    by_design = F.col("column_name").isin(*spec.nullable_by_design) if spec.nullable_by_design else F.lit(False)
    long = table_profile(df).select("n_rows", F.explode("nulls").alias("column_name", "null_count"))
    share = F.expr(_SHARE.format("null_count"))
    return long.select(
        F.lit(spec.name).alias("table_name"),
        "column_name",
        "null_count",
        share.alias("null_pct"),
        by_design.alias("by_design"),
        F.when(by_design, PASS)
        .otherwise(_status(share > max_fail_share, F.col("null_count") > 0))
        .alias("status"),
    )


def _profile_results(
    profile: DataFrame, spec: TableSpec, max_fail_share: float, max_outlier_share: float
) -> DataFrame:
    """The missingness and numeric-sanity rows of one profile row."""
    design = ", ".join(f"'{c}'" for c in sorted(spec.nullable_by_design))
    facts = profile.selectExpr(
        "n_rows",
        "impossible",
        "outliers",
        f"""transform_values(map_filter(nulls, (c, n) -> n > 0),
            (c, n) -> named_struct('count', n, 'pct', {_SHARE.format("n")})) AS shares""",
        "aggregate(map_values(impossible), 0L, (total, n) -> total + n) AS n_impossible",
        "aggregate(map_values(outliers), 0L, (total, n) -> total + n) AS n_outliers",
    ).selectExpr(
        "*",
        f"""array_max(transform(map_values(map_filter(shares,
            (c, s) -> NOT array_contains(CAST(array({design}) AS ARRAY<STRING>), c))), s -> s.pct)) AS worst""",
    )
    return facts.selectExpr(
        f"""inline(array(
            struct('{spec.name}' AS table_name, 'missingness' AS check_name,
                CASE WHEN worst > {max_fail_share!r}D THEN '{FAIL}' WHEN worst IS NOT NULL THEN '{WARN}'
                    ELSE '{PASS}' END AS status,
                to_json(struct(shares AS columns_affected, worst AS worst_pct)) AS details),
            struct('{spec.name}' AS table_name, 'numeric_sanity' AS check_name,
                CASE WHEN n_impossible > 0 OR n_outliers > {max_outlier_share!r}D * n_rows THEN '{FAIL}'
                    WHEN n_outliers > 0 THEN '{WARN}' ELSE '{PASS}' END AS status,
                to_json(struct(impossible AS impossible_values, outliers)) AS details)))"""
    )


def missingness_check(df: DataFrame, spec: TableSpec, max_fail_share: float = MAX_NULL_SHARE) -> DataFrame:
    results = _profile_results(table_profile(df), spec, max_fail_share, MAX_OUTLIER_SHARE)
    return results.filter(F.col("check_name") == "missingness")


def numeric_check(df: DataFrame, spec: TableSpec, max_outlier_share: float = MAX_OUTLIER_SHARE) -> DataFrame:
    results = _profile_results(table_profile(df), spec, MAX_NULL_SHARE, max_outlier_share)
    return results.filter(F.col("check_name") == "numeric_sanity")


def numeric_evidence(df: DataFrame, spec: TableSpec, max_outlier_share: float = MAX_OUTLIER_SHARE) -> DataFrame:
    """One row per rule with its violations, the table's row count and status."""
    return (
        table_profile(df)
        .selectExpr(
            "n_rows",
            "impossible",
            "outliers",
            "aggregate(map_values(impossible), 0L, (total, n) -> total + n) AS n_impossible",
            "aggregate(map_values(outliers), 0L, (total, n) -> total + n) AS n_outliers",
        )
        .selectExpr(
            "*",
            """explode(map_concat(
                transform_values(impossible, (rule, n) -> struct('impossible' AS kind, n AS n)),
                transform_values(outliers, (rule, n) -> struct('outlier' AS kind, n AS n)))) AS (rule, found)""",
        )
        .select(
            F.lit(spec.name).alias("table_name"),
            F.col("found.kind").alias("kind"),
            "rule",
            F.col("found.n").alias("violations"),
            "n_rows",
            _status(
                (F.col("n_impossible") > 0) | (F.col("n_outliers") > F.lit(max_outlier_share) * F.col("n_rows")),
                F.col("n_outliers") > 0,
            ).alias("status"),
        )
    )


# --- keys --------------------------------------------------------------------


def duplicates_among(copies: DataFrame) -> DataFrame:
    """Rows in key groups of more than one row, and the number of such groups, from the copies of each key."""
    return copies.filter(F.col("copies") > 1).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("duplicate_rows"),
        F.count(F.lit(1)).alias("duplicate_key_groups"),
    )


def duplicate_evidence(df: DataFrame, key: list[str]) -> DataFrame:
    """Rows in key groups of more than one row, and the number of such groups."""
    return duplicates_among(df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")))


def duplicate_result(evidence: DataFrame, spec: TableSpec) -> DataFrame:
    details = F.struct(_texts(list(spec.key)).alias("key"), "duplicate_rows", "duplicate_key_groups")
    return evidence.select(
        *_result(
            "duplicates",
            spec.name,
            _status(F.col("duplicate_rows") > 0, F.lit(False)),
            F.to_json(details),
        )
    )


def skipped(spark: SparkSession, check: str, spec: TableSpec, reason: str) -> DataFrame:
    """The passing row of a check that does not apply to a table."""
    note = F.to_json(F.struct(F.lit(reason).alias("skipped")))
    return spark.range(1).select(*_result(check, spec.name, F.lit(PASS), note))


NO_KEY, NO_DATE = "no business key declared", "no date column"


def duplicate_check(df: DataFrame, spec: TableSpec) -> DataFrame:
    if not spec.key:
        return skipped(df.sparkSession, "duplicates", spec, NO_KEY)
    return duplicate_result(duplicate_evidence(df, list(spec.key)), spec)


# --- dates -------------------------------------------------------------------


#: Days in one bitmap; a group has one for each such stretch of days that it touches.
BITMAP_DAYS = 32_768


def day_bitmaps(df: DataFrame, group: str | None = None, *parts: str) -> DataFrame:
    """group_value, stretch, first and last date and one bit a day: a state of fixed size that merges by OR.

    Rows without a date or a group have no state.  With ``parts``, columns of
    ``df``, each part of the table has states of its own.
    """
    label = F.col(group) if group else F.lit("all")
    days = df.filter(F.col("date").isNotNull())
    days = days.filter(F.col(group).isNotNull()) if group else days
    number = F.unix_date("date")
    return days.groupBy(*parts, label.alias("group_value"), F.floor(number / BITMAP_DAYS).alias("stretch")).agg(
        F.min("date").alias("min_date"), F.max("date").alias("max_date"),
        F.bitmap_construct_agg(F.pmod(number, F.lit(BITMAP_DAYS)).cast("bigint")).alias("days"),
    )


def merged_bitmaps(*states: DataFrame) -> DataFrame:
    """The state of several tables' rows together, from the states of each."""
    union = states[0]
    for state in states[1:]:
        union = union.unionByName(state)
    return union.groupBy("group_value", "stretch").agg(
        F.min("min_date").alias("min_date"), F.max("max_date").alias("max_date"), F.bitmap_or_agg("days").alias("days"))


def date_continuity_of(state: DataFrame) -> DataFrame:
    """Days missing between each group's first and last date: days of the range less bits set."""
    return state.groupBy("group_value").agg(
        F.min("min_date").alias("min_date"), F.max("max_date").alias("max_date"), F.sum(F.bitmap_count("days")).alias("n_days"),
    ).select(
        F.col("group_value").cast("string").alias("group_value"),
        "min_date",
        "max_date",
        "n_days",
        (F.datediff("max_date", "min_date") + 1 - F.col("n_days")).cast("long").alias("missing_days"),
    )


def date_continuity_evidence(df: DataFrame, group: str | None = None) -> DataFrame:
    """Days missing between each group's first and last date; no date is built."""
    return date_continuity_of(day_bitmaps(df, group))


def missing_dates(df: DataFrame, group: str) -> DataFrame:
    """The missing days themselves, per group: the zero bits between its first and last date."""
    stretches = day_bitmaps(df, group).groupBy("group_value").agg(
        F.min("min_date").alias("low"), F.max("max_date").alias("high"),
        F.map_from_entries(F.collect_list(F.struct("stretch", "days"))).alias("days"),  # one entry for each 89 years
    )
    octet = f"ascii(decode(substring(days[floor(unix_date(day) / {BITMAP_DAYS})], cast(pmod(unix_date(day), {BITMAP_DAYS}) div 8 as int) + 1, 1), 'ISO-8859-1'))"
    absent = f"coalesce({octet}, 0) & shiftleft(1, cast(pmod(unix_date(day), 8) as int)) = 0"
    between = F.expr(f"filter(sequence(low, high, interval 1 day), day -> {absent})")
    return stretches.select(F.col("group_value").alias(group), F.explode(between).alias("date"))


def date_group(columns: list[str]) -> str | None:
    """The column whose groups must each have a day after another."""
    return "warehouse" if "warehouse" in columns else None


def date_continuity_check(df: DataFrame, spec: TableSpec) -> DataFrame:
    if "date" not in df.columns:
        return skipped(df.sparkSession, "date_continuity", spec, NO_DATE)
    return date_continuity_result(day_bitmaps(df, date_group(df.columns)), spec)


def date_continuity_result(state: DataFrame, spec: TableSpec) -> DataFrame:
    gaps = date_continuity_of(state)
    # Groups are warehouses: a collected map of them is small.
    entry = F.when(F.col("missing_days") > 0, F.struct("group_value", "missing_days"))
    report = gaps.agg(
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("missing_days_by_group"),
        F.min("min_date").alias("min_date"),
        F.max("max_date").alias("max_date"),
    )
    return report.select(
        *_result(
            "date_continuity",
            spec.name,
            _status(F.lit(False), F.size("missing_days_by_group") > 0),
            F.to_json(F.struct("missing_days_by_group", "min_date", "max_date")),
        )
    )


# --- cross-table -------------------------------------------------------------


def unknown_keys(
    df: DataFrame, key: str, known: DataFrame, known_key: str | None = None, rows: Column | None = None
) -> DataFrame:
    """Keys of ``df`` absent from ``known``, with their row counts.

    Rows are counted per key before the anti join, so a frequent key is one
    row.  A NULL key is unknown unless the known set holds a NULL as well.
    ``rows`` is the number of rows that a row of ``df`` stands for.
    """
    count = F.count(F.lit(1)) if rows is None else F.sum(rows)
    counted = df.groupBy(F.col(key).alias("key_value")).agg(count.alias("n_rows"))
    reference = known.select(F.col(known_key or key).alias("known_value")).distinct()
    return counted.join(reference, F.col("key_value").eqNullSafe(F.col("known_value")), "left_anti")


#: Groups in which unknown keys are ranked for the examples.
EXAMPLE_GROUPS = 256


def reference_evidence(
    df: DataFrame, key: str, known: DataFrame, known_key: str | None = None, rows: Column | None = None
) -> DataFrame:
    """Number of rows with an unknown key and the ten smallest such keys.

    The ten smallest keys of each of 256 hash groups reach the one aggregate,
    so its state is bounded and the keys are held against the known ones once.
    """
    unknown = unknown_keys(df, key, known, known_key, rows)
    group = F.pmod(F.xxhash64("key_value"), F.lit(EXAMPLE_GROUPS))
    place = F.row_number().over(Window.partitionBy(group).orderBy(F.col("key_value").asc_nulls_last()))
    ranked = unknown.withColumn("place", place)
    kept = F.collect_list(F.when(F.col("place") <= EXAMPLES, F.col("key_value")))  # nulls are not collected
    smallest = F.slice(F.array_sort(kept), 1, EXAMPLES)
    return ranked.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("unknown_key_rows"),
        F.array_join(F.transform(smallest, lambda k: k.cast("string")), ",").alias("unknown_key_examples"),
    )


def referential_check(
    df: DataFrame, spec: TableSpec, key: str, known: DataFrame, known_name: str, rows: Column | None = None
) -> DataFrame:
    """Every key must exist in the referenced table."""
    return reference_evidence(df, key, known, rows=rows).select(
        *_result(
            f"referential_{key}->{known_name}",
            spec.name,
            _status(F.col("unknown_key_rows") > 0, F.lit(False)),
            F.to_json(F.struct("unknown_key_rows", "unknown_key_examples")),
        )
    )


def coverage_check(
    df: DataFrame, spec: TableSpec, key: str, known: DataFrame, known_name: str, rows: Column | None = None
) -> DataFrame:
    """Keys nobody refers to are worth a warning, not a failure."""
    return reference_evidence(df, key, known, rows=rows).select(
        *_result(
            f"coverage_{key}_not_in_{known_name}",
            spec.name,
            _status(F.lit(False), F.col("unknown_key_rows") > 0),
            F.to_json(
                F.struct(
                    F.col("unknown_key_rows").alias("extra_key_rows"),
                    F.col("unknown_key_examples").alias("extra_key_examples"),
                )
            ),
        )
    )


# --- reports -----------------------------------------------------------------


def profile_results(profile: DataFrame, spec: TableSpec) -> DataFrame:
    """The missingness and numeric-sanity rows of a profile at the standard limits."""
    return _profile_results(profile, spec, MAX_NULL_SHARE, MAX_OUTLIER_SHARE)


def union_of(parts: list[DataFrame]) -> DataFrame:
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def table_checks(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The five checks of one table; nulls and numeric rules share a pass."""
    return union_of([
        schema_check(df, spec),
        profile_results(table_profile(df), spec),
        duplicate_check(df, spec),
        date_continuity_check(df, spec),
    ])


# The column that ties the tables together, and who refers to whom.
REFERENCE = "unique_id"
REFERRING, REFERRED, COVERED_BY = ("sales_train", "sales_test", "test_weights"), "inventory", "sales_train"


def reference_checks(
    tables: Mapping[str, DataFrame], specs: Mapping[str, TableSpec], rows: Column | None = None
) -> list[DataFrame]:
    """Three referential checks and one coverage check; ``rows`` as in :func:`unknown_keys`."""
    known = tables[REFERRED]
    checks = [referential_check(tables[name], specs[name], REFERENCE, known, REFERRED, rows) for name in REFERRING]
    return [*checks, coverage_check(known, specs[REFERRED], REFERENCE, tables[COVERED_BY], COVERED_BY, rows)]


def full_report(tables: Mapping[str, DataFrame], specs: Mapping[str, TableSpec]) -> DataFrame:
    """Five checks per table, three referential checks and one coverage check."""
    checks = [table_checks(tables[name], spec) for name, spec in specs.items()]
    return union_of(checks + reference_checks(tables, specs))


def severity(status: Column) -> Column:
    return F.when(status == FAIL, SEVERITY[FAIL]).when(status == WARN, SEVERITY[WARN]).otherwise(SEVERITY[PASS])


def overall(report: DataFrame) -> DataFrame:
    """Counts by status and the worst status of a report."""
    return report.agg(
        F.count_if(F.col("status") == PASS).alias("n_pass"),
        F.count_if(F.col("status") == WARN).alias("n_warn"),
        F.count_if(F.col("status") == FAIL).alias("n_fail"),
        F.max_by("status", severity(F.col("status"))).alias("overall"),
    )


def exceptions(report: DataFrame) -> DataFrame:
    """Checks that did not pass."""
    return report.filter(F.col("status") != PASS)


def require_valid(report: DataFrame) -> None:
    """Raise when a check failed.  The report has a few dozen rows."""
    failed = report.filter(F.col("status") == FAIL).select("table_name", "check_name").collect()
    if failed:
        names = ", ".join(f"{row.table_name}:{row.check_name}" for row in failed)
        raise ValidationFailed(f"failed checks: {names}")
