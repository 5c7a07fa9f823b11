"""Boosted regression trees on the model's frame.

An additive model grows by one tree a round.  Every row carries its running
prediction, so a round fits a single tree to what is left to explain, adds its
share to the rows, and takes the error from the result: nothing is fitted twice
and no round looks at earlier trees.  Fitting stops early: the number of rounds
is the one with the smallest mean absolute error on an inner validation window,
the 28 days before the holdout, once ``patience`` rounds have not improved on
it.  The final model is grown on everything before the holdout, which is only
predicted; it follows the search, never ahead of the best round so far.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from threading import Condition

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settle
from .features import CATEGORY, HISTORY_FEATURES, KNOWN_AHEAD, category_index, last_day, split_label
from .trees import BINS, BLOCK_ROWS, BLOCKS, MISSING, Grower, Inputs, Rules, Tree, packed

CATEGORICAL = ("warehouse", CATEGORY)
PARTS = ("train", "validation")
#: Trees after which the rows are written with their running prediction.
STRIDE = 16
#: Steps of one unit of sales in which a tree sees what is left to explain.
GRID = 1024.0
#: Accuracy of the quantiles that bound the bins: exact for inputs of so many rows.
QUANTILE_ACCURACY = 100_000


@dataclass(frozen=True)
class BoostingParams:
    """The learner's published settings."""

    max_rounds: int = 3000
    patience: int = 50
    learning_rate: float = 0.03
    max_depth: int = 8
    min_rows_per_leaf: int = 10
    row_share: float = 0.9
    column_share: float = 0.8
    seed: int = 42


@dataclass(frozen=True)
class Binned:
    """How features become bin numbers: the upper bounds of each numeric feature's bins, and the categories' number of values."""

    features: tuple[str, ...]
    bounds: tuple[np.ndarray, ...]
    inputs: Inputs

    def bins(self, batch: pa.RecordBatch) -> np.ndarray:
        """Rows of bin numbers; a missing value has one of its own."""
        found = np.empty((batch.num_rows, self.inputs.columns), "<i4")
        for i, (name, bounds) in enumerate(zip(self.features, self.bounds)):
            values = batch.column(name).to_numpy(zero_copy_only=False)
            found[:, i] = np.where(np.isnan(values), MISSING, np.searchsorted(bounds, values))
        for i, name in enumerate(CATEGORICAL, len(self.features)):
            found[:, i] = batch.column(f"{name}_slot").to_numpy()
        return found


@dataclass(frozen=True)
class BoostedTrees:
    """A constant and the trees that are added to it, each ``rate`` times."""

    binned: Binned
    base: float
    rate: float
    trees: Sequence[Tree]

    def transform(self, rows: DataFrame) -> DataFrame:
        """``rows`` (features and slots among their columns) with their ``prediction``."""
        shared = rows.sparkSession.sparkContext.broadcast(self)

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = shared.value
            for batch in batches:
                bins = model.binned.bins(batch)
                sums = sum((model.rate * t.predict(bins, model.binned.inputs) for t in model.trees), np.full(len(bins), model.base))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sums)], [*batch.schema.names, "prediction"])

        return rows.mapInArrow(task, rows.select("*", F.lit(0.0).alias("prediction")).schema)

    def importances(self) -> list[float]:
        """Share of each input in the squared error that splits take away."""
        summed = np.zeros(self.binned.inputs.places)
        for tree in self.trees:
            inner = tree.place >= 0
            np.add.at(summed, tree.place[inner], tree.gain[inner])
        return (summed / summed.sum() if summed.sum() else summed).tolist()


@dataclass(frozen=True)
class BoostedForecast:
    """The final model; ``errors`` are those of each round of the search, ``stopped`` is false if the ceiling of rounds ended it."""

    model: BoostedTrees
    rounds: int
    stopped: bool
    errors: Sequence[float]
    inputs: DataFrame
    predictions: DataFrame


class RoundsExhausted(RuntimeError):
    """The ceiling of rounds was reached while the error was still falling."""


def coded(frame: DataFrame, known: DataFrame, features: Sequence[str]) -> tuple[DataFrame, DataFrame, tuple[int, ...]]:
    """The frame with a slot number for each category, the name of each input, and the categories' numbers of slots.

    Every value of a category is an input of its own, whatever their number;
    the values of ``known`` are numbered in a table that is joined in.  Missing
    features stay missing: each split learns where they go.
    """
    spark = frame.sparkSession
    numbered = frame.withColumns({f: F.col(f).cast("double") for f in features})
    names = spark.createDataFrame(list(enumerate(features)), "place int, feature string")
    offset, sizes = len(features), []
    for column in CATEGORICAL:
        slots = category_index(known, column)
        numbered = numbered.join(slots.withColumnRenamed("slot", f"{column}_slot"), column, "left").fillna(0, [f"{column}_slot"])
        values = slots.select((F.lit(offset) + F.col("slot")).alias("place"), F.concat(F.lit(f"{column}_"), F.col(column)).alias("feature"))
        unknown = spark.range(1).select(F.lit(offset).alias("place"), F.lit(f"{column}_unknown").alias("feature"))
        names = names.unionByName(unknown).unionByName(values)
        sizes.append(slots.count() + 1)
        offset += sizes[-1]
    return numbered, names, tuple(sizes)


def binned(rows: DataFrame, features: Sequence[str], sizes: tuple[int, ...]) -> Binned:
    """Bins of about equally many rows for each feature; one pass, a few numbers per feature."""
    parts = [i / BINS for i in range(1, BINS)]
    quantiles = rows.agg(*(F.percentile_approx(f, parts, QUANTILE_ACCURACY).alias(f"q{i}") for i, f in enumerate(features))).first()
    bounds = tuple(np.unique(np.array(quantiles[f"q{i}"] or [], float)) for i in range(len(features)))
    return Binned(tuple(features), bounds, Inputs(len(features), sizes))


def _blocks(rows: DataFrame, how: Binned, base: float) -> DataFrame:
    """Rows packed into blocks, with the part each belongs to and a hash of its key."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, BLOCK_ROWS):
                some = batch.slice(low, BLOCK_ROWS)
                target = some.column("sales").to_numpy().astype("<f8")
                part = np.array([PARTS.index(p) for p in some.column("split").to_pylist()], "u1")
                yield packed(how.bins(some), target, np.full(len(target), base), part, some.column("chance").to_numpy().view("<u8"))

    slots = [f"{c}_slot" for c in CATEGORICAL]
    chosen = rows.select(F.col("sales").cast("double").alias("sales"), "split", *how.features, *slots, F.xxhash64("unique_id", "date").alias("chance"))
    return chosen.mapInArrow(task, BLOCKS)


class _Growing:
    """A model that grows by a tree a round, on the parts of the rows in ``fitted``."""

    def __init__(self, blocks: DataFrame, how: Binned, base: float, rows: int, fitted: Sequence[str], params: BoostingParams):
        rules = Rules(params.max_depth, params.min_rows_per_leaf, params.row_share, params.column_share, params.seed)
        parts = tuple(PARTS.index(p) for p in fitted)
        self.grower = Grower(blocks, rows, how.inputs, rules, parts, PARTS.index("validation"), params.learning_rate, GRID)
        self.how, self.base, self.rate = how, base, params.learning_rate
        self.trees: list[Tree] = []
        self.written = 0

    def grow(self) -> float | None:
        """Add one tree; the mean absolute error on the validation rows before it."""
        if len(self.trees) - self.written == STRIDE:
            self.grower = replace(self.grower, blocks=settle(self.grower.moved(self.trees[self.written :]), "boosting-blocks"))
            self.written = len(self.trees)
        tree, error, n = self.grower.grow(self.trees[self.written :], len(self.trees))
        self.trees.append(tree)
        return error / n if n else None

    def model(self) -> BoostedTrees:
        return BoostedTrees(self.how, self.base, self.rate, self.trees)


def first_stop(errors: Sequence[float], patience: int) -> int | None:
    """Rounds up to the best error at the first time that none improves on it for ``patience`` rounds."""
    best = 0
    for i, error in enumerate(errors):
        if error < errors[best]:
            best = i
        elif i - best >= patience:
            return best + 1
    return None


class _Follower:
    """Grows the final model beside the search, up to the best round known so far."""

    def __init__(self, growing: _Growing):
        self.growing, self.rounds, self.over = growing, 0, False
        self.news = Condition()

    def allow(self, rounds: int, over: bool = False) -> None:
        with self.news:
            self.rounds, self.over = rounds, over
            self.news.notify()

    def run(self) -> None:
        while True:
            with self.news:
                self.news.wait_for(lambda: self.over or self.rounds > len(self.growing.trees))
                if self.rounds <= len(self.growing.trees):
                    return
            self.growing.grow()


def _search(rows: DataFrame, features: Sequence[str], sizes: tuple[int, ...], params: BoostingParams) -> tuple[BoostedTrees, int, bool, list[float]]:
    """The final model, its rounds, whether patience (not the ceiling) ended the search, and the error after each round.

    A tree is measured by the job that grows the next one.
    """
    how = binned(rows, features, sizes)
    means = {r.split: (r.mean, r.n) for r in rows.groupBy("split").agg(F.avg("sales").alias("mean"), F.count("*").alias("n")).collect()}
    if set(means) != set(PARTS):
        raise ValueError("no labelled rows in the training days, or none in the validation window")
    n_all = sum(n for _, n in means.values())
    mean_all = sum(mean * n for mean, n in means.values()) / n_all
    base, n_train = means["train"]
    trial = _Growing(settle(_blocks(rows, how, base), "boosting-blocks"), how, base, n_train, ["train"], params)
    follower = _Follower(_Growing(settle(_blocks(rows, how, mean_all), "boosting-blocks"), how, mean_all, n_all, PARTS, params))
    errors: list[float] = []
    best, stopped = 0, False
    with ThreadPoolExecutor(1) as pool:
        following = pool.submit(inheritable_thread_target(rows.sparkSession)(follower.run))
        try:
            trial.grow()  # measures the constant
            while len(errors) < params.max_rounds and not stopped and not following.done():
                errors.append(trial.grow())
                found = first_stop(errors, params.patience)
                stopped = found is not None
                best = found or min(range(len(errors)), key=errors.__getitem__) + 1
                follower.allow(best)
        finally:
            follower.allow(best, over=True)
        following.result()
    return follower.growing.model(), best, stopped, errors


def boosted_forecast(
    frame: DataFrame,
    inventory: DataFrame,
    params: BoostingParams = BoostingParams(),
    features: Sequence[str] = (*HISTORY_FEATURES, *KNOWN_AHEAD),
) -> BoostedForecast:
    """Fit on the model's frame (read several times: pass a written one).

    ``inventory`` lists the warehouses and categories that have inputs of their own.
    """
    labelled = frame.withColumn("split", split_label(F.col("date"), last_day(frame)))
    rows, inputs, sizes = coded(labelled, inventory, features)
    rows = rows.select("unique_id", "date", "warehouse", "sales", "split", *features, *(f"{c}_slot" for c in CATEGORICAL))
    known = settle(rows.filter((F.col("split") != "holdout") & F.col("sales").isNotNull()), "boosting-rows")
    model, rounds, stopped, errors = _search(known, features, sizes, params)

    predictions = model.transform(rows.filter(F.col("split") == "holdout")).select(
        "unique_id", "date", "warehouse", "prediction", F.col("sales").alias("actual")
    )
    return BoostedForecast(model, rounds, stopped, errors, inputs, predictions)


def importances(forecast: BoostedForecast, limit: int | None = 10) -> DataFrame:
    """The model's inputs, most important first."""
    spark = forecast.inputs.sparkSession
    values = list(enumerate(forecast.model.importances()))
    weighted = forecast.inputs.join(spark.createDataFrame(values, "place int, importance double"), "place")
    table = weighted.select("feature", "importance").orderBy(F.desc("importance"), "feature")
    return table if limit is None else table.limit(limit)
