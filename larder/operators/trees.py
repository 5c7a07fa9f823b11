"""Regression trees grown on binned rows that stay where they are.

Rows are kept in blocks: a matrix of bin numbers and, beside it, the target and
the running prediction of each row.  A node with many rows is split by a
histogram job: tasks add up counts and sums per bin, Spark merges them, and only
the best split of each node reaches the driver.  Once a node has few rows they
are sent together, and one task grows everything below it; so a tree takes one
job for each level with large nodes, and one more.

Missing values have a bin of their own and go, at each split, to the side where
they reduce the error most.  Targets lie on a grid, so sums, and with them the
trees, do not depend on the order of tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bins of a numeric input, and the number that stands for a missing value.
BINS = 128
MISSING = -1
#: Rows that a task may hold to finish a node: about 20 MB.
FEW_ROWS = 1 << 17
#: Rows of a block.
BLOCK_ROWS = 1 << 16
LEAST_GAIN = 1e-9

BLOCKS = "bins binary, target binary, running binary, part binary, chance binary"


@dataclass(frozen=True)
class Inputs:
    """Numeric inputs come first; each value of a categorical one is an input of its own (the value against the rest)."""

    numeric: int
    sizes: tuple[int, ...]

    @property
    def columns(self) -> int:
        return self.numeric + len(self.sizes)

    @property
    def places(self) -> int:
        return self.numeric + sum(self.sizes)

    def first_place(self, column: int) -> int:
        return column if column < self.numeric else self.numeric + sum(self.sizes[: column - self.numeric])

    def width(self, column: int) -> int:
        """Histogram cells of a column: missing and bins, or values."""
        return BINS + 1 if column < self.numeric else self.sizes[column - self.numeric]

    def of_places(self) -> tuple[np.ndarray, np.ndarray]:
        """Column of each place, and the value it stands for (``MISSING`` for numeric inputs)."""
        column = np.concatenate([np.arange(self.numeric), np.repeat(np.arange(self.numeric, self.columns), self.sizes)]).astype(np.int64)
        values = np.concatenate([np.full(self.numeric, MISSING), *(np.arange(s) for s in self.sizes)]).astype(np.int64)
        return column, values


@dataclass
class Tree:
    """Nodes numbered from 1, children of n are 2 n and 2 n + 1; a leaf has no place to split at."""

    depth: int
    place: np.ndarray = field(init=False)
    cut: np.ndarray = field(init=False)
    missing_left: np.ndarray = field(init=False)
    value: np.ndarray = field(init=False)
    gain: np.ndarray = field(init=False)

    def __post_init__(self):
        size = 2 << self.depth
        self.place, self.cut = np.full(size, -1, np.int32), np.zeros(size, np.int32)
        self.missing_left, self.value, self.gain = np.zeros(size, bool), np.zeros(size), np.zeros(size)

    def split(self, node: int, split: tuple) -> None:
        self.gain[node], self.place[node], self.cut[node], self.missing_left[node] = split

    def step(self, bins: np.ndarray, nodes: np.ndarray, column: np.ndarray, values: np.ndarray) -> np.ndarray:
        """One level down, for rows at nodes that are split."""
        place = self.place[nodes]
        found = bins[np.arange(len(bins)), column[place]]
        above = np.where(found == MISSING, ~self.missing_left[nodes], found > self.cut[nodes])
        return 2 * nodes + np.where(values[place] == MISSING, above, found == values[place])

    def walk(self, bins: np.ndarray, inputs: Inputs) -> np.ndarray:
        """The node in which each row ends."""
        column, values = inputs.of_places()
        nodes = np.ones(len(bins), np.int64)
        moving = np.arange(len(bins))
        for _ in range(self.depth):
            moving = moving[self.place[nodes[moving]] >= 0]
            if not len(moving):
                break
            nodes[moving] = self.step(bins[moving], nodes[moving], column, values)
        return nodes

    def predict(self, bins: np.ndarray, inputs: Inputs) -> np.ndarray:
        return self.value[self.walk(bins, inputs)]


def histogram(bins: np.ndarray, left_over: np.ndarray, slots: np.ndarray, count: int, column: int, inputs: Inputs) -> tuple[np.ndarray, np.ndarray]:
    """Rows and sums of each node (its slot) and cell of a column."""
    width = inputs.width(column)
    cells = slots * width + bins[:, column] + (column < inputs.numeric)
    size = count * width
    return np.bincount(cells, minlength=size).reshape(count, width), np.bincount(cells, left_over, size).reshape(count, width)


def best_splits(histograms: Iterator[tuple[int, np.ndarray, np.ndarray]], count: int, allowed: np.ndarray, least_rows: int, inputs: Inputs) -> list[tuple | None]:
    """(gain, place, cut, missing go left) of each node's best split; of equally good ones, the first place and cut."""
    best: list[tuple | None] = [None] * count
    for column, n, s in histograms:
        rows, total = n.sum(axis=1, keepdims=True), s.sum(axis=1, keepdims=True)
        first = inputs.first_place(column)
        if column < inputs.numeric:
            below, under = np.cumsum(n[:, 1:], axis=1), np.cumsum(s[:, 1:], axis=1)
            options = [(below, under, False), (below + n[:, :1], under + s[:, :1], True)]
            open_ = np.full(below.shape[1], allowed[first])
        else:
            options = [(rows - n, total - s, False)]
            open_ = allowed[first : first + n.shape[1]]
        for left, left_sum, missing_left in options:
            right, right_sum = rows - left, total - left_sum
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = left_sum**2 / left + right_sum**2 / right - total**2 / rows
            gain = np.where((left >= least_rows) & (right >= least_rows) & open_, gain, -1.0)
            at = gain.argmax(axis=1)
            for slot in np.flatnonzero(gain[np.arange(count), at] > LEAST_GAIN).tolist():
                found = float(gain[slot, at[slot]])
                if best[slot] is None or found > best[slot][0]:
                    where = int(at[slot])
                    best[slot] = (found, first, where, missing_left) if column < inputs.numeric else (found, first + where, 0, False)
    return best


def finish(tree: Tree, node: int, bins: np.ndarray, left_over: np.ndarray, allowed: np.ndarray, least_rows: int, inputs: Inputs) -> np.ndarray:
    """Grow everything below ``node`` from all of its rows; the nodes that came about."""
    nodes = np.full(len(bins), node, np.int64)
    growing = np.arange(len(bins))
    column, values = inputs.of_places()
    columns = np.unique(column[allowed]).tolist()
    made = [node]
    for _ in range(node.bit_length() - 1, tree.depth):
        named, slots = np.unique(nodes[growing], return_inverse=True)
        own_bins, own_left = bins[growing], left_over[growing]
        parts = ((c, *histogram(own_bins, own_left, slots, len(named), c, inputs)) for c in columns)
        splits = best_splits(parts, len(named), allowed, least_rows, inputs)
        for name, split in zip(named.tolist(), splits):
            if split is not None:
                tree.split(name, split)
                made += [2 * name, 2 * name + 1]
        growing = growing[np.array([s is not None for s in splits])[slots]]
        if not len(growing):
            break
        nodes[growing] = tree.step(bins[growing], nodes[growing], column, values)
    made = np.array(sorted(made))
    n, s = np.bincount(nodes, minlength=2 << tree.depth), np.bincount(nodes, left_over, 2 << tree.depth)
    ends = np.flatnonzero(n)
    tree.value[ends] = s[ends] / n[ends]
    return made


@dataclass(frozen=True)
class Rules:
    """How trees are grown."""

    depth: int
    least_rows: int
    row_share: float
    column_share: float
    seed: int

    def allowed(self, number: int, places: int) -> np.ndarray:
        """The share of inputs that tree ``number`` may split at."""
        chosen = np.random.default_rng([self.seed, number]).permutation(places)[: max(1, round(self.column_share * places))]
        return np.isin(np.arange(places), chosen)

    def drawn(self, number: int, chance: np.ndarray) -> np.ndarray:
        """The share of rows that tree ``number`` is grown on, by the rows' own hashes."""
        h = (chance ^ np.uint64((self.seed * 1_000_003 + number) * 0x9E3779B97F4A7C15 % (1 << 64))) * np.uint64(0xFF51AFD7ED558CCD)
        return (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53) >> np.uint64(11) < self.row_share * (1 << 53)


def _array(row: pa.RecordBatch, name: str, kind: str) -> np.ndarray:
    return np.frombuffer(row.column(name)[0].as_buffer(), kind)


def unpacked(batches: Iterator[pa.RecordBatch], inputs: Inputs) -> Iterator[tuple[np.ndarray, ...]]:
    """bins, target, running, part and chance of each block."""
    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1)
            yield (
                _array(row, "bins", "<i4").reshape(-1, inputs.columns), _array(row, "target", "<f8"), _array(row, "running", "<f8"),
                _array(row, "part", "u1"), _array(row, "chance", "<u8"),
            )


def packed(*columns: np.ndarray) -> pa.RecordBatch:
    names = [part.split()[0] for part in BLOCKS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(c).tobytes()], pa.binary()) for c in columns], names)


def _counted(tree: Tree, node: int, histograms: dict[int, tuple[np.ndarray, np.ndarray]], inputs: Inputs) -> tuple[int, int]:
    """Rows to the left and right of a node's split, from the histograms of the node."""
    column, values = inputs.of_places()
    place = int(tree.place[node])
    n = histograms[int(column[place])][0][0]
    if values[place] == MISSING:
        left = int(n[1 : tree.cut[node] + 2].sum()) + (int(n[0]) if tree.missing_left[node] else 0)
    else:
        left = int(n.sum() - n[values[place]])
    return left, int(n.sum()) - left


@dataclass(frozen=True)
class Grower:
    """Grows trees on ``blocks``: rows of the parts in ``fitted``, ``rows`` of them at most; errors are those of part ``measured``."""

    blocks: DataFrame
    rows: int
    inputs: Inputs
    rules: Rules
    fitted: tuple[int, ...]
    measured: int
    rate: float
    grid: float
    few_rows: int = FEW_ROWS

    def grow(self, pending: Sequence[Tree], number: int) -> tuple[Tree, float, int]:
        """Tree ``number``, for what the pending trees leave of the targets; and the absolute error before it, with its rows."""
        tree, allowed = Tree(self.rules.depth), self.rules.allowed(number, self.inputs.places)
        large, small = ([1], []) if self.rows > self.few_rows else ([], [1])
        while large:
            splits, large = self._split_large(tree, large, allowed, pending, number), []
            for node, n_left, n_right in splits:
                for child, n in ((2 * node, n_left), (2 * node + 1, n_right)):
                    if child.bit_length() <= self.rules.depth:
                        (large if n > self.few_rows else small).append(child)
        return tree, *self._finish_small(tree, small, allowed, pending, number)

    def _left_over(self, batches: Iterator[pa.RecordBatch], pending: Sequence[Tree], number: int) -> Iterator[tuple]:
        """Bins and what is left over of the rows drawn for the tree; absolute error and number of the measured rows."""
        for bins, target, running, part, chance in unpacked(batches, self.inputs):
            now = running + sum((self.rate * t.predict(bins, self.inputs) for t in pending), np.zeros(len(target)))
            left = np.rint((target - now) * self.grid) / self.grid
            own = np.flatnonzero(np.isin(part, self.fitted) & self.rules.drawn(number, chance))
            aside = left[part == self.measured]
            yield bins[own], left[own], float(np.abs(aside).sum()), len(aside)

    def _split_large(self, tree: Tree, large: list[int], allowed: np.ndarray, pending: Sequence[Tree], number: int) -> list[tuple[int, int, int]]:
        """Split nodes by merged histograms; each split node and the rows on its two sides."""
        inputs, rules, left_over = self.inputs, self.rules, self._without_blocks()._left_over
        columns = np.unique(inputs.of_places()[0][allowed]).tolist()

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for bins, left, _, _ in left_over(batches, pending, number):
                nodes = tree.walk(bins, inputs)
                own = np.isin(nodes, large)
                bins, left, slots = bins[own], left[own], np.searchsorted(large, nodes[own])
                for column in columns:
                    n, s = histogram(bins, left, slots, len(large), column, inputs)
                    at, cell = np.nonzero(n)
                    parts = np.array(large, np.int64)[at], np.full(len(at), column), cell, n[at, cell], s[at, cell]
                    yield pa.RecordBatch.from_arrays([pa.array(p) for p in parts], ["node", "column", "cell", "n", "s"])

        def choose(table: pa.Table) -> pa.Table:
            node = table.column("node")[0].as_py()
            column, cell, n, s = (table.column(c).to_numpy() for c in ("column", "cell", "n", "s"))
            histograms = {}
            for c in columns:
                own = column == c
                whole = np.zeros((1, inputs.width(c)), np.int64), np.zeros((1, inputs.width(c)))
                whole[0][0, cell[own]], whole[1][0, cell[own]] = n[own], s[own]
                histograms[c] = whole
            (split,) = best_splits(((c, *h) for c, h in histograms.items()), 1, allowed, rules.least_rows, inputs)
            rows = []
            if split is not None:
                tried = Tree(rules.depth)
                tried.split(node, split)
                rows = [(node, *split, *_counted(tried, node, histograms, inputs))]
            return pa.Table.from_pylist([dict(zip(chosen.names, r)) for r in rows], chosen)

        chosen = pa.schema([("node", pa.int64()), ("gain", pa.float64()), ("place", pa.int32()), ("cut", pa.int32()),
                            ("missing_left", pa.bool_()), ("n_left", pa.int64()), ("n_right", pa.int64())])
        cells = self.blocks.mapInArrow(count, "node bigint, column bigint, cell bigint, n bigint, s double")
        merged = cells.groupBy("node", "column", "cell").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
        # A group has one row for each cell of one node.
        found = merged.groupBy("node").applyInArrow(choose, "node bigint, gain double, place int, cut int, missing_left boolean, n_left bigint, n_right bigint")
        rows = sorted(map(tuple, found.collect()))
        for node, gain, place, cut, missing_left, _, _ in rows:
            tree.split(node, (gain, place, cut, missing_left))
        return [(r[0], r[5], r[6]) for r in rows]

    def _finish_small(self, tree: Tree, small: list[int], allowed: np.ndarray, pending: Sequence[Tree], number: int) -> tuple[float, int]:
        """Grow below the small nodes, one task a node; give all ends their values."""
        inputs, rules, left_over = self.inputs, self.rules, self._without_blocks()._left_over
        sent = "node bigint, bins binary, left_over binary, total double, n bigint"

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for bins, left, error, measured in left_over(batches, pending, number):
                nodes = tree.walk(bins, inputs)
                rows = [(0, b"", b"", error, measured)]  # errors go as node 0
                for node in np.unique(nodes).tolist():
                    own = nodes == node
                    here = node in small
                    rows.append((node, bins[own].tobytes() if here else b"", left[own].tobytes() if here else b"", float(left[own].sum()), int(own.sum())))
                kinds = pa.int64(), pa.binary(), pa.binary(), pa.float64(), pa.int64()
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["node", "bins", "left_over", "total", "n"])

        names = ["gain", "place", "cut", "missing_left", "value"]
        made = pa.schema([("node", pa.int64()), ("gain", pa.float64()), ("place", pa.int32()), ("cut", pa.int32()),
                          ("missing_left", pa.bool_()), ("value", pa.float64()), ("n", pa.int64())])

        def below(table: pa.Table) -> pa.Table:
            node = table.column("node")[0].as_py()
            total, n = sum(sorted(table.column("total").to_pylist())), sum(table.column("n").to_pylist())
            if node not in small:  # the errors, or an end without anything to grow
                return pa.Table.from_pylist([{"node": node, "gain": 0.0, "place": -1, "cut": 0, "missing_left": False, "value": total if node == 0 else total / n, "n": n}], made)
            bins = np.frombuffer(b"".join(table.column("bins").to_pylist()), "<i4").reshape(-1, inputs.columns)
            left = np.frombuffer(b"".join(table.column("left_over").to_pylist()), "<f8")
            grown = Tree(rules.depth)
            nodes = finish(grown, node, bins, left, allowed, rules.least_rows, inputs)
            return pa.Table.from_arrays([pa.array(nodes), *(pa.array(getattr(grown, c)[nodes]) for c in names), pa.array(np.full(len(nodes), n))], made.names)

        rows = self.blocks.mapInArrow(send, sent)
        found = rows.groupBy("node").applyInArrow(below, "node bigint, gain double, place int, cut int, missing_left boolean, value double, n bigint").toArrow()
        nodes = found.column("node").to_numpy()
        new = (nodes > 0) & (tree.place[nodes] < 0)  # splits of large nodes are known already
        for name in names:
            getattr(tree, name)[nodes[new]] = found.column(name).to_numpy()[new]
        errors = nodes == 0
        return float(found.column("value").to_numpy()[errors].sum()), int(found.column("n").to_numpy()[errors].sum())

    def _without_blocks(self) -> Grower:
        """What tasks need of this object."""
        return replace(self, blocks=None)

    def moved(self, pending: Sequence[Tree]) -> DataFrame:
        """The blocks with the pending trees added to their running predictions."""
        inputs, rate = self.inputs, self.rate

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for bins, target, running, part, chance in unpacked(batches, inputs):
                yield packed(bins, target, running + sum((rate * t.predict(bins, inputs) for t in pending), np.zeros(len(target))), part, chance)

        return self.blocks.mapInArrow(task, BLOCKS)
