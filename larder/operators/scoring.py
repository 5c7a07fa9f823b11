"""Forecast error metrics and model comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import ratio


def _pair(actual: str, predicted: str) -> tuple[Column, Column]:
    """Absolute actual and absolute error, both NULL unless the pair is complete."""
    complete = F.col(actual).isNotNull() & F.col(predicted).isNotNull()
    size = F.when(complete, F.abs(F.col(actual)))
    error = F.when(complete, F.abs(F.col(actual) - F.col(predicted)))
    return size, error


def wmape(actual: str = "sales", predicted: str = "prediction", weight: str | None = None) -> Column:
    """Sum of (weighted) absolute errors over that of actuals; NULL if undefined."""
    size, error = _pair(actual, predicted)
    if weight is not None:
        size, error = size * F.col(weight), error * F.col(weight)
    return ratio(F.sum(error), F.sum(size))


def mae(actual: str = "sales", predicted: str = "prediction") -> Column:
    return F.avg(_pair(actual, predicted)[1])


def rmse(actual: str = "sales", predicted: str = "prediction") -> Column:
    error = _pair(actual, predicted)[1]
    return F.sqrt(F.avg(error * error))


def pair_with_holdout(predictions: DataFrame, holdout: DataFrame, weights: DataFrame) -> DataFrame:
    """Holdout rows with their prediction and their series' weight, if any."""
    return (
        holdout.select("unique_id", "date", "warehouse", "sales")
        .join(predictions.select("unique_id", "date", "prediction"), ["unique_id", "date"], "left")
        .join(weights.select("unique_id", "weight"), "unique_id", "left")
    )


def _complete(value: Column) -> Column:
    """Let the value through only if nothing was missing, else fail the job."""
    problems = [("n_unpredicted", "lack a prediction"), ("n_unweighted", "lack a weight")]
    for column, text in reversed(problems):
        message = F.concat(F.col(column).cast("string"), F.lit(f" holdout rows {text}"))
        value = F.when(F.col(column) > 0, F.raise_error(message)).otherwise(value)
    return value


def evaluate(predictions: DataFrame, holdout: DataFrame, weights: DataFrame) -> DataFrame:
    """Errors overall (``scope`` overall) and per warehouse, in one pass.

    A holdout row without a prediction, or a series without a weight, fails the
    job instead of leaving the scores silently incomplete.
    """
    pairs = pair_with_holdout(predictions, holdout, weights)
    scores = pairs.rollup("warehouse").agg(
        F.grouping("warehouse").alias("is_overall"),
        F.count_if(F.col("prediction").isNull()).alias("n_unpredicted"),
        F.count_if(F.col("weight").isNull()).alias("n_unweighted"),
        wmape().alias("wmape"),
        wmape(weight="weight").alias("wmape_weighted"),
        mae().alias("mae"),
        rmse().alias("rmse"),
        F.count(F.lit(1)).alias("n_rows"),
    )
    overall = F.col("is_overall") == 1
    return scores.filter(overall | F.col("warehouse").isNotNull()).select(
        F.when(overall, "overall").otherwise("warehouse").alias("scope"),
        "warehouse",
        *[_complete(F.col(m)).alias(m) for m in ("wmape", "wmape_weighted", "mae", "rmse")],
        "n_rows",
    )


def model_table(scored: dict[str, DataFrame]) -> DataFrame:
    """Overall errors of several evaluated models, one row each."""
    table = None
    for model, scores in scored.items():
        row = scores.filter(F.col("scope") == "overall").select(
            F.lit(model).alias("model"), "wmape", "wmape_weighted", "mae", "rmse", "n_rows"
        )
        table = row if table is None else table.unionByName(row)
    return table


def compare(models: DataFrame, candidate: str) -> DataFrame:
    """WMAPE difference of one model against each other model."""
    own = models.filter(F.col("model") == candidate).select("wmape").scalar()
    return models.filter(F.col("model") != candidate).select(
        "model",
        "wmape",
        (own - F.col("wmape")).alias("delta_wmape"),
    )
