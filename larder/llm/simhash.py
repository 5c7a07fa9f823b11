"""Near-duplicate groups by SimHash fingerprints and a binary trie self-join.

A sorted array of fingerprints is a binary trie: a node is the range of values
that share a prefix.  The self-join walks pairs of nodes together, from the
root pair down, adding up the bits in which their prefixes differ, and leaves a
pair as soon as the sum exceeds the budget.  The upper levels are walked as a
table of prefix pairs; each surviving pair then meets in one row with the
fingerprints below it (in blocks of bounded size), where the walk goes on over
arrays of node pairs.  A row returns a spanning forest of the links it finds,
never all of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settle
from .batches import slices
from .components import components

SHINGLE = 4
SEED = 42
BITS = 64
MOST_DIFFERING = 4

#: Distinct fingerprints below one node where the walk leaves Spark's table of prefix pairs.
NODE = 1 << 15
#: Levels that are walked as a table at least, so that small inputs use several tasks too.
LEAST_DEPTH = 6
#: Node pairs that a task expands at a time.
FRONTIER = 1 << 18
#: Fingerprint pairs below a node pair that are compared directly.
DIRECT = 16

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(text: str | None) -> int:
    """Bit i is 1 if it is set in over half of the shingles' hashes; without a word, zero."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    if len(words) > SHINGLE:
        starts, ends = starts[: 1 - SHINGLE], ends[SHINGLE - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    hash_of = xxhash.xxh64_intdigest
    hashes = np.fromiter((hash_of(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist())), np.uint64, len(starts))
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        octets = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``bits``, the fingerprint of the whole text as a signed long."""
    kind = docs.schema[key].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values = np.fromiter(map(fingerprint, batch.column("text").to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], ["key", "bits"])

    chosen = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return chosen.mapInArrow(task, f"key {kind}, bits bigint").withColumnRenamed("key", key)


class _Trie:
    """A sorted array of distinct fingerprints; a node is a range in it."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self._ones: dict[int, np.ndarray] = {}

    def split(self, low: np.ndarray, high: np.ndarray, level: int) -> np.ndarray:
        """Where the range's values with bit ``level`` (from the top) set begin."""
        ones = self._ones.get(level)
        if ones is None:
            bit = (self.values >> np.uint64(BITS - 1 - level)) & np.uint64(1)
            ones = self._ones[level] = np.concatenate([[0], np.cumsum(bit, dtype=np.int32)]).astype(np.int32)
        return high - (ones[high] - ones[low])


class _Forest:
    """Spanning forest of the links seen so far; ``root`` is always flat."""

    def __init__(self, size: int):
        self.root = np.arange(size, dtype=np.int32)

    def link(self, x: np.ndarray, y: np.ndarray) -> None:
        while True:
            a, b = self.root[x], self.root[y]
            apart = a != b
            if not apart.any():
                return
            x, y, a, b = x[apart], y[apart], a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while True:
                flat = self.root[self.root]
                if np.array_equal(flat, self.root):
                    break
                self.root = flat


def close_links(left: np.ndarray, right: np.ndarray | None, level: int, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what lies within ``budget`` bits of each other.

    ``left`` and ``right`` are sorted distinct fingerprints, each with one
    prefix of ``level`` bits; without ``right``, ``left`` is joined to itself.
    """
    alone = right is None
    a, b = _Trie(left), _Trie(left) if alone else _Trie(right)
    shift = 0 if alone else len(left)
    forest = _Forest(len(left) + (0 if alone else len(right)))
    values = left if alone else np.concatenate([left, right])
    error = int(np.bitwise_count((a.values[0] ^ b.values[0]) >> np.uint64(BITS - level))) if level else 0
    if error <= budget:
        one = lambda v: np.array([v], np.int32)
        stack = [(level, one(0), one(len(left)), one(0), one(len(b.values)), np.array([error], np.int8))]
        while stack:
            depth, a0, a1, b0, b1, errors = stack.pop()
            few = ((a1 - a0).astype(np.int64) * (b1 - b0) <= DIRECT) | (depth == BITS)
            if few.any():
                _compare(a, b, a0[few], a1[few], b0[few], b1[few], alone, shift, budget, forest)
                a0, a1, b0, b1, errors = (v[~few] for v in (a0, a1, b0, b1, errors))
            if not len(a0):
                continue
            am, bm = a.split(a0, a1, depth), b.split(b0, b1, depth)
            below = [(a0, am, b0, bm, errors), (am, a1, bm, b1, errors), (a0, am, bm, b1, errors + 1)]
            mixed = np.flatnonzero(a0 != b0) if alone else slice(None)  # a node with itself: one of the two mixed pairs
            below.append((am[mixed], a1[mixed], b0[mixed], bm[mixed], errors[mixed] + 1))
            children = [np.concatenate(column) for column in zip(*below)]
            good = (children[0] < children[1]) & (children[2] < children[3]) & (children[4] <= budget)
            children = [c[good] for c in children]
            for at in range(0, len(children[0]), FRONTIER):
                stack.append((depth + 1, *(c[at : at + FRONTIER] for c in children)))
    hung = np.flatnonzero(forest.root != np.arange(len(forest.root)))
    return values[hung], values[forest.root[hung]]


def _compare(a, b, a0, a1, b0, b1, alone, shift, budget, forest) -> None:
    """All values of each node pair (few by now) against each other."""
    wide = (b1 - b0).astype(np.int64)
    sizes = (a1 - a0) * wide
    which = np.repeat(np.arange(len(sizes)), sizes)
    number = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    x = a0[which] + number // wide[which]
    y = b0[which] + number % wide[which]
    if alone:
        x, y = x[x < y], y[x < y]
    near = np.bitwise_count(a.values[x] ^ b.values[y]) <= budget
    forest.link(x[near], y[near] + shift)


def _walk_task(level: int, budget: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part = batch.slice(row, 1)
                lists = [part.column(n).flatten().to_numpy().view(np.uint64) for n in ("left", "right")]
                left, right = (np.sort(v) for v in lists)
                own = part.column("own")[0].as_py()
                x, y = close_links(left, None if own else right, level, budget)
                yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(y.view(np.int64))], ["x", "y"])

    return task


def _prefix_pairs(spark, level: int, budget: int) -> DataFrame:
    """The walk over the upper levels: pairs of prefixes (a <= b) that differ in ``budget`` bits at most."""
    pairs = spark.range(1).select(F.lit(0).alias("a"), F.lit(0).alias("b"), F.lit(0).alias("errors"))
    steps = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)))
    for depth in range(level):
        if depth == 10:
            pairs = pairs.repartition("a", "b")
        step = pairs.select("a", "b", "errors", F.explode(steps).alias("s"))
        pairs = step.select(
            F.expr("a * 2 + s.i").alias("a"), F.expr("b * 2 + s.j").alias("b"), F.expr("errors + (s.i ^ s.j)").alias("errors")
        ).where(f"errors <= {budget} AND a <= b")
    return pairs.select("a", "b")


def near_links(values: DataFrame, budget: int = MOST_DIFFERING, node: int = NODE) -> DataFrame:
    """Links ``x``, ``y`` whose components are those of all pairs within ``budget`` bits.

    ``values`` has one column ``bits`` of distinct fingerprints.  The depth at
    which the table of prefix pairs ends follows their number, so that a node
    holds about ``node`` of them; a node that holds many more is dealt into
    several blocks.  Each level deeper sends every fingerprint to more pairs,
    each level less makes larger rows: ``node`` balances the two.
    """
    spark = values.sparkSession
    level = max(LEAST_DEPTH, math.ceil(math.log2(max(1, values.count()) / node)))
    prefixed = values.select("bits", F.shiftrightunsigned("bits", BITS - level).cast("int").alias("prefix"))
    counts = prefixed.groupBy("prefix").agg(F.expr(f"cast(ceil(count(*) / {2 * node}) as int)").alias("blocks"))
    dealt = prefixed.join(counts, "prefix").select("prefix", "bits", F.expr("pmod(hash(bits), blocks)").alias("block"))
    blocks = settle(dealt.groupBy("prefix", "block").agg(F.collect_list("bits").alias("bits")), "trie-blocks")
    side = lambda p, q, v: blocks.select(*(F.col(c).alias(n) for c, n in zip(("prefix", "block", "bits"), (p, q, v))))
    met = _prefix_pairs(spark, level, budget).join(side("a", "block_a", "left"), "a").join(side("b", "block_b", "right"), "b")
    met = met.where("a < b OR block_a <= block_b").select("left", "right", F.expr("a = b AND block_a = block_b").alias("own"))
    return met.mapInArrow(_walk_task(level, budget), "x bigint, y bigint")


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", budget: int = MOST_DIFFERING) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    Texts whose fingerprints differ in ``budget`` bits or fewer are linked;
    ``component_id`` is the smallest id reachable over links.  Null text counts
    as empty; texts without a word have fingerprint zero and are linked like any
    other.  Equal fingerprints are one node, whatever number of rows has them.
    Null ids never become a component's id unless it has no other; repeated
    rows come back repeated.  An empty table gives an empty one.
    """
    marked = settle(fingerprints(docs, key, text).select(F.col(key).alias("doc_id"), "bits"), "simhash")
    distinct = settle(marked.groupBy("bits").agg(F.min("doc_id").alias("least_id")), "simhash-distinct")
    links = settle(near_links(distinct.select("bits"), budget), "simhash-links")
    roots = components(links)
    hung = distinct.join(roots, F.col("bits") == F.col("node"), "left").select(
        "bits", "least_id", F.coalesce("root", "bits").alias("root"))
    least = hung.groupBy("root").agg(F.min("least_id").alias("component_id"))
    ids = settle(hung.join(least, "root").select("bits", "component_id"), "simhash-components")
    return marked.join(ids, "bits").select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id"
    )
