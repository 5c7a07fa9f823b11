"""Ranked lexical search: the best documents for each of a set of items, by a dual-tree search.

A score is a sum over an item's terms of the term's weight times how much the
term counts in the document.  Items and documents each form a hierarchy whose
nodes hold, for every term, the largest weight (count) below them.  The product
of two nodes bounds every score between what lies below; a pair of nodes is
left as soon as its bound is under the weakest k-th best score of its items.
What remains at the leaves is scored exactly.  All numbers are integers that
doubles hold exactly, so bounds and scores can be matrix products.

Items are searched in blocks of bounded size, each against all documents.  The
documents' terms are counted once per block and kept as vectors over the
block's terms; their statistics are Spark aggregates.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import settle
from .batches import slices

BEST = 10
#: Items, and bytes of their texts, that a block holds on average at most.
BLOCK_ITEMS = 512
BLOCK_BYTES = 64 << 10
#: Numbers in the dense vectors of the documents that a task searches at a time, and documents at most.
CELLS = 1 << 22
DOCUMENTS = 2_048
#: Rows below a leaf, and children of an inner node.
LEAF, FAN = 8, 4
#: The k-th best scores to start from are those of one in so many documents; they only save work.
SEEDED = 32

# What separates terms, the scale of scores, and how length counts.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
GAIN, SATURATION, LENGTH = 1_000_000_000, 1_000, 8
FLAT, SLOPE = 10, 90


def terms(text: str | None) -> list[bytes]:
    """Runs of digits, letters and characters beyond ASCII; only A to Z are lowered."""
    return (text or "").encode().translate(_TABLE).split()


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


@dataclass(frozen=True)
class Block:
    """Items with their ids and the places of their terms; the term of a place has a weight."""

    ids: list
    places: list[np.ndarray]
    weights: np.ndarray
    order: np.ndarray

    def kind(self) -> type:
        """Doubles, unless scores could exceed what they hold exactly."""
        most = max(int(self.weights[own].sum()) for own in self.places) * (GAIN // SATURATION)
        return np.float64 if most < 1 << 53 else np.int64

    def dense(self) -> np.ndarray:
        """Items in the order of their hierarchy, terms as columns."""
        rows = np.zeros((len(self.ids), len(self.weights)), self.kind())
        for row, item in enumerate(self.order.tolist()):
            own = self.places[item]
            rows[row, own] = self.weights[own]
        return rows


def _similar_order(rows: np.ndarray) -> np.ndarray:
    """An order in which rows alike are neighbours: halves by which of two far rows a row is nearer to, again and again."""
    order, pending = np.arange(len(rows)), [(0, len(rows))]
    while pending:
        low, high = pending.pop()
        if high - low <= LEAF:
            continue
        own = rows[order[low:high]]
        far = own[np.argmin(own @ own.sum(axis=0))]
        other = own[np.argmin(own @ far)]
        order[low:high] = order[low:high][np.argsort(own @ other - own @ far, kind="stable")]
        middle = low + max(LEAF, (high - low) // 2 // LEAF * LEAF)
        pending += [(low, middle), (middle, high)]
    return order


def _levels(rows: np.ndarray) -> list[np.ndarray]:
    """Coordinate maxima of the nodes, from the root down to the leaves."""
    levels = [np.maximum.reduceat(rows, np.arange(0, len(rows), LEAF), axis=0)]
    while len(levels[-1]) > 1:
        levels.append(np.maximum.reduceat(levels[-1], np.arange(0, len(levels[-1]), FAN), axis=0))
    return levels[::-1]


class Search:
    """The best documents so far of each item of a block."""

    def __init__(self, block: Block, least: np.ndarray, best: int):
        self.block, self.best = block, best
        self.rows = block.dense()
        self.item_levels = _levels(self.rows)
        self.least = np.maximum(1, least[block.order])  # scores below these cannot be among the best
        none = np.zeros(0, np.int64)
        self.found = [(none, none, none.astype(bool))] * len(self.rows)

    def add(self, ids: np.ndarray, nulls: np.ndarray, lengths: np.ndarray, places: np.ndarray, gains: np.ndarray) -> None:
        """More documents: their ids (and which are null), numbers of terms, and the terms' places and gains, one after the other."""
        wide = len(self.block.weights)
        step = max(LEAF, min(DOCUMENTS, CELLS // max(1, wide)))
        starts = np.concatenate([[0], np.cumsum(lengths)])
        value = self.block.weights[places] * gains
        top = np.zeros(len(ids), np.int64)  # a document's strongest term, to bring documents alike together
        if len(places):
            owner = np.repeat(np.arange(len(ids)), lengths)
            last = np.lexsort((value, owner))
            ends = starts[1:][lengths > 0] - 1
            top[lengths > 0] = places[last[ends]]
        order = np.argsort(top, kind="stable")
        for low in range(0, len(order), step):
            own = order[low : low + step]
            rows = np.zeros((len(own), wide), self.rows.dtype)
            counts = lengths[own]
            at = np.repeat(starts[own] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
            rows[np.repeat(np.arange(len(own)), counts), places[at]] = gains[at]
            self._join(rows, ids[own], nulls[own])

    def _join(self, rows: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        document_levels = _levels(rows)
        depths = len(self.item_levels), len(document_levels)
        alive = np.ones((1, 1), bool)
        for depth in range(max(depths)):
            items, documents = (levels[min(depth, d - 1)] for levels, d in zip((self.item_levels, document_levels), depths))
            if depth:
                for axis, d, size in ((0, depths[0], len(items)), (1, depths[1], len(documents))):
                    if depth < d:
                        alive = np.repeat(alive, FAN, axis=axis)[(slice(None),) * axis + (slice(size),)]
            a, b = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
            if not len(a):
                return
            bounds = items[a] @ documents[b].T
            weakest = self._weakest(min(depth, depths[0] - 1))
            alive[np.ix_(a, b)] &= bounds >= weakest[a][:, None]
        for leaf in np.flatnonzero(alive.any(axis=1)).tolist():
            some = (np.flatnonzero(alive[leaf])[:, None] * LEAF + np.arange(LEAF)).ravel()
            some = some[some < len(rows)]
            scores = (self.rows[leaf * LEAF : (leaf + 1) * LEAF] @ rows[some].T).astype(np.int64)
            for row, own in enumerate(scores, leaf * LEAF):
                good = np.flatnonzero(own >= self.least[row])
                if len(good):
                    self._keep(row, own[good], ids[some[good]], nulls[some[good]])

    def _weakest(self, depth: int) -> np.ndarray:
        """For each node of a level, the weakest score that one of its items still takes."""
        weakest = np.minimum.reduceat(self.least, np.arange(0, len(self.least), LEAF))
        for _ in range(len(self.item_levels) - 1 - depth):
            weakest = np.minimum.reduceat(weakest, np.arange(0, len(weakest), FAN))
        return weakest

    def _keep(self, row: int, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        columns = [np.concatenate(pair) for pair in zip(self.found[row], (scores, ids, nulls))]
        first = np.lexsort((columns[1], columns[2], -columns[0]))[: self.best]
        self.found[row] = tuple(c[first] for c in columns)
        if len(first) == self.best:
            self.least[row] = max(self.least[row], self.found[row][0][-1])

    def results(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Item numbers, document ids, which of these are null, and scores."""
        numbers = np.repeat(self.block.order, [len(f[0]) for f in self.found])
        scores, ids, nulls = (np.concatenate(c) for c in zip(*self.found))
        return numbers, ids, nulls, scores


def _vectors(docs: DataFrame, vocabulary: dict[bytes, int], key: str, text: str) -> DataFrame:
    """doc_id, n (terms with repeats), and places and counts of the terms of the vocabulary, for each document."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # bounded by the block's bytes

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in slices(batches):
            sizes, places, counts = [], [], []
            for value in batch.column("text").to_pylist():
                own = Counter(terms(value))
                sizes.append(own.total())
                held = [(p, n) for t, n in own.items() if (p := known.get(t)) is not None]
                places.append([p for p, _ in held])
                counts.append([n for _, n in held])
            lists = [pa.array(x, pa.list_(kind)) for x, kind in ((places, pa.int32()), (counts, pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), *lists], ["doc_id", "n", "places", "counts"])

    chosen = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return chosen.mapInArrow(task, "doc_id bigint, n bigint, places array<int>, counts array<bigint>")


def _searched(vectors: DataFrame, block: Block, least: np.ndarray, documents: int, total: int, best: int) -> DataFrame:
    """item (its number), doc_id and score: the best of each task."""
    shared = vectors.sparkSession.sparkContext.broadcast((block, least))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = None
        for batch in batches:
            search = search or Search(*shared.value, best)
            column = batch.column("doc_id")
            nulls = column.is_null().to_numpy(zero_copy_only=False)
            ids = column.fill_null(0).to_numpy()
            lists = batch.column("places")
            places = lists.flatten().to_numpy().astype(np.int64)
            counts = batch.column("counts").flatten().to_numpy()
            lengths = np.diff(lists.offsets.to_numpy()).astype(np.int64)
            size = FLAT + SLOPE * batch.column("n").to_numpy() * documents // total
            gains = GAIN * counts // (SATURATION * counts + LENGTH * np.repeat(size, lengths))
            search.add(ids, nulls, lengths, places, gains)
        if search is not None:
            numbers, ids, nulls, scores = search.results()
            yield pa.RecordBatch.from_arrays([pa.array(numbers.astype(np.int32)), pa.array(ids, mask=nulls), pa.array(scores)], ["item", "doc_id", "score"])

    return vectors.mapInArrow(task, "item int, doc_id bigint, score bigint")


def _ranked(found: DataFrame, best: int) -> DataFrame:
    place = F.row_number().over(W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return found.withColumn("rank", place).where(F.col("rank") <= best)


def _search_block(items: list[tuple], docs: DataFrame, kind: str, best: int, key: str, text: str) -> DataFrame | None:
    spark = docs.sparkSession
    held = [sorted(set(terms(t))) for _, t in items]
    vocabulary = {t: i for i, t in enumerate(sorted({t for own in held for t in own}))}
    if not vocabulary:
        return None
    vectors = settle(_vectors(docs, vocabulary, key, text).where("n > 0"), "ranking-vectors")
    whole = vectors.agg(F.count("*").alias("documents"), F.sum("n").alias("total")).first()
    holding = np.zeros(len(vocabulary), np.int64)
    for row in vectors.select(F.explode("places").alias("place")).groupBy("place").count().collect():  # a row for each term of the block
        holding[row["place"]] = row["count"]
    weights = np.array([weight(whole.documents, h) if h else 0 for h in holding.tolist()], np.int64)
    places = [np.array([vocabulary[t] for t in own], np.int64) for own in held]
    block = Block([i for i, _ in items], places, weights, np.arange(len(items)))
    block = replace(block, order=_similar_order(block.dense()))
    none = np.zeros(len(items), np.int64)
    seeds = vectors.where(f"pmod(xxhash64(doc_id, n), {SEEDED}) = 0")
    least = none.copy()
    for row in _ranked(_searched(seeds, block, none, whole.documents, whole.total, best), best).where(F.col("rank") == best).collect():  # one row an item
        least[row["item"]] = row["score"]
    found = _ranked(_searched(vectors, block, least, whole.documents, whole.total, best), best)
    names = spark.createDataFrame([(number, i) for number, i in enumerate(block.ids)], f"item int, item_id {kind}")
    return settle(found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"), "ranking-best")  # BLOCK_ITEMS rows or so


def search(items: DataFrame, docs: DataFrame, best: int = BEST, item_key: str = "item_id", item_text: str = "text", key: str = "doc_id", text: str = "text",
           block_items: int = BLOCK_ITEMS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id and score of the ``best`` documents of each item with a score above zero.

    Each row of ``items`` is an item, each row of ``docs`` a document, so
    repeated rows are ranked (and counted) each for itself.  Equal scores are
    ranked by ascending id, null ids last.  Null texts have no terms: such
    items find nothing, such documents are neither found nor counted.  Texts
    of any length are taken whole; a document id is an integer.  Only key and
    text of either table are read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    kind = items.schema[item_key].dataType.simpleString()
    asked = settle(items.select(F.col(item_key).alias("item_id"), F.col(item_text).alias("text"), F.monotonically_increasing_id().alias("row")), "ranking-items")
    whole = asked.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    blocks = max(math.ceil(whole.n / block_items), math.ceil(whole.bytes / block_bytes))
    results = None
    for number in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == number).select("item_id", "text")
        rows = [tuple(r) for r in own.collect()]  # about BLOCK_BYTES
        if rows and (found := _search_block(rows, docs, kind, best, key, text)) is not None:
            results = found if results is None else results.unionByName(found)
    return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint") if results is None else results
