"""Number-to-text expressions for rationales."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole(value: Column) -> Column:
    """Whole number, ties to even (the JVM formatter alone would round up).

    A missing value reads ``nan``.
    """
    return F.when(value.isNotNull(), F.format_string("%.0f", F.rint(value))).otherwise(F.lit("nan"))


def percent(value: Column) -> Column:
    return F.concat(whole(value * F.lit(100.0)), F.lit("%"))


def capitalise(value: Column) -> Column:
    """Upper-case the first letter only."""
    return F.concat(F.upper(F.substring(value, 1, 1)), F.substr(value, F.lit(2)))
