"""Rounding, guarded division and banding.

Two rounding families are needed.  Report columns round half away from zero on
decimals; decision columns (risk, scenario) round half to even on the scaled
double.  Mixing them up moves units across tier edges, so both are named.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_up(value: Column, places: int) -> Column:
    """Decimal rounding, ties away from zero; the result is a double again.

    Ten places hold what a double says about values of this size, and drop the
    last bits, in which sums taken in another order differ.
    """
    return F.round(value.cast("decimal(38,10)"), places).cast("double")


def half_even(value: Column, places: int) -> Column:
    """Round the scaled double, ties to even."""
    scale = float(10**places)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator, NULL where the denominator is zero or NULL."""
    return numerator / F.nullif(denominator.cast("double"), F.lit(0.0))


def mean_of(total: Column, count: Column) -> Column:
    """Mean from a pre-aggregated sum and non-null count, NULL when empty."""
    return ratio(total.cast("double"), count)


def steady_sum(value: Column) -> Column:
    """Sum on a fixed grid of 1e-9, the same whatever order the tasks add in.

    For totals that are rounded or banded afterwards, where the last bit of a
    double could move a row across an edge from one run to the next.
    """
    return F.sum(value.cast("decimal(28,9)")).cast("double")


def clip(value: Column, low: float, high: float) -> Column:
    """Bound a value; NULL stays NULL (greatest/least alone would skip it)."""
    bounded = F.greatest(F.least(value, F.lit(float(high))), F.lit(float(low)))
    return F.when(value.isNotNull(), bounded)


def band(value: Column, edges: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Label by the first edge the value is strictly below."""
    (first_edge, first_label), *rest = edges
    label = F.when(value < F.lit(first_edge), F.lit(first_label))
    for edge, name in rest:
        label = label.when(value < F.lit(edge), F.lit(name))
    return label.otherwise(F.lit(otherwise))


def sum_skipping_nulls(columns: Sequence[str]) -> Column:
    """Row-wise sum in the given order, NULL counting as zero."""
    total = F.coalesce(F.col(columns[0]), F.lit(0.0))
    for name in columns[1:]:
        total = total + F.coalesce(F.col(name), F.lit(0.0))
    return total

