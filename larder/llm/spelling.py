"""Spelling variants: near words found through Bloom filters over the neighbourhoods of words.

Words are counted over all texts.  The vocabulary fills blocked Bloom filters,
one for each word length (a block is one 64-bit word, so a probe reads one
place).  Each word generates its edits, deletions and replacements by a later
letter; an insertion is the other word's deletion, a replacement by an earlier
letter is the other word's by a later one.  The edits' hashes follow from the
word's own by a few additions, and probe the filter of the edit's length.  Only
positives leave the task; a join with the vocabulary on the hash and a
comparison of the spelled edit with the word found remove the false ones.

Filters are broadcast in rounds: one round's filters have ``ROUND_BITS`` bits
at most, whatever the vocabulary, and a length with more words than that is
filled and probed in several parts of its hash range.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settle
from .batches import slices

LEAST_LENGTH = 7
LEAST_COUNT = 2
#: A form is at least so many times as frequent as the word it stands for.
RATIO = 10
#: One in so many (document, run) pairs loses a character before counting; zero for none.
MISSPELT = 31

#: Bits of filter for each word, and of all filters of a round (32 MB).
BITS_PER_WORD = 16
ROUND_BITS = 1 << 28
#: Bits set for each word in its block.
PROBES = 5
#: Lengths from here on share a filter, in which each word has several blocks: long words have many edits.
LONG = 64
LONG_BLOCKS = 3
#: Characters of words, and hashes, that a task handles at a time.
STRIPE = 1 << 16

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
RUN = re.compile("[a-zÀ-ÿ]+")

_DELETE, _REPLACE = 0, 1
_GOLDEN, _ALL = 0x9E3779B97F4A7C15, (1 << 64) - 1


def count_words(docs: DataFrame, key: str = "doc_id", text: str = "text", misspelt: int = MISSPELT) -> DataFrame:
    """word and n of all runs of letters, A to Z lowered, that are long enough after their (rare) deletion."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts: Counter = Counter()
            for doc, value in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                if not value:
                    continue
                own = Counter(RUN.findall(value.encode().translate(_LOWER).decode()))
                seed = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for run, n in own.items():
                    # A length below the least cannot grow; all the runs of one document share their fate.
                    if len(run) >= LEAST_LENGTH:
                        if misspelt and (h := zlib.crc32(run.encode(), seed)) % misspelt == 0:
                            at = h % len(run)
                            run = run[:at] + run[at + 1 :]
                            if len(run) < LEAST_LENGTH:
                                continue
                        counts[run] += n
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    chosen = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return chosen.mapInArrow(task, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _mixed(h: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of h."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _factors(length: int) -> np.ndarray:
    """An odd factor for each place in a word."""
    return _mixed(np.arange(1, length + 1, dtype=np.uint64) * np.uint64(_GOLDEN)) | np.uint64(1)


def _finished(sums: np.ndarray, length: int) -> np.ndarray:
    return _mixed(sums + np.uint64((length * 0xD6E8FEB86659FD93) & _ALL))


def word_hashes(points: np.ndarray) -> np.ndarray:
    """Hashes of words of one length, a row of code points each: a sum of code points times factors, mixed."""
    return _finished((points.astype(np.uint64) * _factors(points.shape[1])).sum(axis=1, dtype=np.uint64), points.shape[1])


def edits(points: np.ndarray, letters: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(kind, letter, rows, places, hashes) of the words' edits, in arrays of bounded size.

    A deletion within a run of one letter is generated at the first place only.
    """
    count, length = points.shape
    wide = points.astype(np.uint64)
    factors = _factors(length)
    products = wide * factors
    whole = products.sum(axis=1, dtype=np.uint64)
    if length > 1:
        moved = np.zeros_like(products)
        moved[:, 1:] = wide[:, 1:] * factors[:-1]  # what a letter counts one place further to the front
        before = np.cumsum(products, axis=1, dtype=np.uint64) - products
        after = moved.sum(axis=1, dtype=np.uint64)[:, None] - np.cumsum(moved, axis=1, dtype=np.uint64)
        first = np.ones((count, length), bool)
        first[:, 1:] = points[:, 1:] != points[:, :-1]
        rows, places = np.nonzero(first)
        yield _DELETE, 0, rows, places, _finished((before + after)[rows, places], length - 1)
    rest = whole[:, None] - products
    step = max(1, STRIPE * 16 // max(1, count))
    for low in range(0, length, step):  # a very long word is replaced stripe by stripe
        part, left, factor = points[:, low : low + step], rest[:, low : low + step], factors[low : low + step]
        for letter in letters.tolist():
            rows, places = np.nonzero(part < letter)
            if len(rows):
                yield _REPLACE, letter, rows, places + low, _finished(left[rows, places] + np.uint64(letter) * factor[places], length)


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions and code points of the words of each length, at most about STRIPE characters at a time."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths).tolist():
        own = np.flatnonzero(lengths == length)
        step = max(1, STRIPE // length)
        for low in range(0, len(own), step):
            some = own[low : low + step]
            yield some, np.frombuffer("".join(words[i] for i in some.tolist()).encode("utf-32-le"), "<u4").reshape(len(some), length)


@dataclass(frozen=True)
class Filter:
    """Words of one length (``LONG`` for all longer ones) whose hash falls into ``part`` of ``parts``, in blocks from ``first`` on."""

    length: int
    part: int
    parts: int
    first: int
    blocks: int

    def turns(self) -> int:
        return LONG_BLOCKS if self.length == LONG else 1

    def marks(self, hashes: np.ndarray, turn: int) -> tuple[np.ndarray, np.ndarray]:
        """Block and bits of each hash."""
        h = _mixed(hashes + np.uint64((turn + 1) * _GOLDEN & _ALL))
        block = ((h >> np.uint64(32)) * np.uint64(self.blocks)) >> np.uint64(32)
        bits = np.zeros(len(h), np.uint64)
        for probe in range(PROBES):
            bits |= np.uint64(1) << ((h >> np.uint64(6 * probe)) & np.uint64(63))
        return block.astype(np.int64) + self.first, bits

    def own(self, hashes: np.ndarray) -> np.ndarray:
        """Positions of the hashes in this part of the range."""
        return np.flatnonzero(hashes % np.uint64(self.parts) == self.part) if self.parts > 1 else np.arange(len(hashes))

    def positives(self, hashes: np.ndarray, filled: np.ndarray) -> np.ndarray:
        """Positions of the hashes that may be words."""
        left = self.own(hashes)
        for turn in range(self.turns()):
            block, bits = self.marks(hashes[left], turn)
            left = left[filled[block] & bits == bits]
        return left


def plan_rounds(lengths: dict[int, int], round_bits: int) -> list[list[Filter]]:
    """Filters for so many words of each length, in rounds of at most ``round_bits`` bits."""
    pooled: Counter = Counter()
    for length, n in lengths.items():
        pooled[min(length, LONG)] += n * (LONG_BLOCKS if length >= LONG else 1)
    rounds: list[list[Filter]] = []
    most = max(1, round_bits // 64)
    used = most
    for length, n in sorted(pooled.items()):
        parts = max(1, math.ceil(n * BITS_PER_WORD / 64 / most))
        blocks = max(1, min(most, math.ceil(n * BITS_PER_WORD / 64 / parts)))
        for part in range(parts):
            if used + blocks > most:
                rounds.append([])
                used = 0
            rounds[-1].append(Filter(length, part, parts, used, blocks))
            used += blocks
    return rounds


def _of_length(filters: list[Filter]) -> dict[int, list[Filter]]:
    found: dict[int, list[Filter]] = {}
    for f in filters:
        found.setdefault(f.length, []).append(f)
    return found


def _lengths(filters: list[Filter], further: int = 0) -> Column:
    """Words of the filters' lengths, and of up to ``further`` more characters."""
    chosen = F.length("word").isin(sorted({f.length + extra for f in filters for extra in range(further + 1)}))
    return chosen | (F.length("word") >= LONG) if any(f.length == LONG for f in filters) else chosen


def _filled(vocabulary: DataFrame, filters: list[Filter]) -> tuple[np.ndarray, np.ndarray]:
    """The blocks of a round's filters, and the letters of their words; both of bounded size."""
    wanted = _of_length(filters)

    def rows(block: np.ndarray, bits: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(block.astype(np.int32)), pa.array(bits.view(np.int64))], ["block", "bits"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters: set[int] = set()
        for batch in batches:
            for _, points in _by_length(batch.column("word").to_pylist()):
                letters.update(np.unique(points).tolist())
                hashes = word_hashes(points)
                for f in wanted.get(min(points.shape[1], LONG), ()):
                    own = hashes[f.own(hashes)]
                    for turn in range(f.turns()):
                        yield rows(*f.marks(own, turn))
        yield rows(np.array([-1 - c for c in sorted(letters)], np.int64), np.zeros(len(letters), np.uint64))  # letters go as negative blocks

    marks = vocabulary.where(_lengths(filters)).select("word").mapInArrow(task, "block int, bits bigint")
    table = marks.groupBy("block").agg(F.bit_or("bits").alias("bits")).toArrow()  # ROUND_BITS / 64 rows at most, and the letters
    block, bits = table.column("block").to_numpy(), table.column("bits").to_numpy().view(np.uint64)
    filled = np.zeros(max(f.first + f.blocks for f in filters), np.uint64)
    filled[block[block >= 0]] = bits[block >= 0]
    return filled, np.sort(-1 - block[block < 0]).astype(np.uint32)


def _probed(vocabulary: DataFrame, filters: list[Filter]) -> DataFrame:
    """word, n, kind, place, letter and hash of the edits that the round's filters take for words."""
    shared = vocabulary.sparkSession.sparkContext.broadcast(_filled(vocabulary, filters))
    wanted = _of_length(filters)
    names = ["word", "n", "kind", "place", "letter", "hash"]

    def rows(batch: pa.RecordBatch, parts: list[tuple]) -> pa.RecordBatch:
        members, kinds, places, letters, hashes = (np.concatenate(c) for c in zip(*parts))
        taken = batch.take(pa.array(members))
        spelled = pa.array([chr(c) for c in letters.tolist()], pa.string())
        columns = [taken.column("word"), taken.column("n"), pa.array(kinds.astype(np.int32)), pa.array(places.astype(np.int32)), spelled, pa.array(hashes.view(np.int64))]
        return pa.RecordBatch.from_arrays(columns, names)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled, alphabet = shared.value
        for batch in batches:
            held, parts = 0, []
            for members, points in _by_length(batch.column("word").to_pylist()):
                for kind, letter, own, places, hashes in edits(points, alphabet):
                    for f in wanted.get(min(points.shape[1] - (kind == _DELETE), LONG), ()):
                        good = f.positives(hashes, filled)
                        if len(good):
                            parts.append((members[own[good]], np.full(len(good), kind), places[good], np.full(len(good), letter), hashes[good]))
                            held += len(good) * (1 + points.shape[1] // LONG)
                if held > STRIPE:
                    yield rows(batch, parts)
                    held, parts = 0, []
            if parts:
                yield rows(batch, parts)

    return vocabulary.where(_lengths(filters, 1)).select("word", "n").mapInArrow(
        task, "word string, n bigint, kind int, place int, letter string, hash bigint")


def _hashed(words: DataFrame) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = np.zeros(batch.num_rows, np.uint64)
            for members, points in _by_length(batch.column("word").to_pylist()):
                hashes[members] = word_hashes(points)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hashes.view(np.int64))], ["word", "n", "hash"])

    return words.mapInArrow(task, "word string, n bigint, hash bigint")


def near_pairs(vocabulary: DataFrame, round_bits: int = ROUND_BITS) -> DataFrame:
    """word, n, near, near_n for each ordered pair of words that differ by one edit; ``vocabulary`` has word, n and hash."""
    counted = vocabulary.groupBy(F.least(F.length("word"), F.lit(LONG)).alias("length")).count().collect()  # LONG rows at most
    spelled = F.concat(F.expr("substring(word, 1, place)"), F.when(F.col("kind") == _REPLACE, F.col("letter")).otherwise(""), F.expr("substring(word, place + 2)"))
    known = vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n"), F.col("hash").alias("near_hash"))
    pairs = None
    for filters in plan_rounds({r["length"]: r["count"] for r in counted}, round_bits):
        probed = settle(_probed(vocabulary, filters), "spelling-positives")
        found = probed.join(known, F.col("hash") == F.col("near_hash")).where(spelled == F.col("near")).select("word", "n", "near", "near_n")
        pairs = found if pairs is None else pairs.unionByName(found)
    if pairs is None:
        pairs = vocabulary.selectExpr("word", "n", "word AS near", "n AS near_n").where("false")
    pairs = settle(pairs, "spelling-pairs")
    return pairs.unionByName(pairs.selectExpr("near AS word", "near_n AS n", "word AS near", "n AS near_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """word and root of each word that has a form, by doubling pointers; a chain is as long as counts can grow by ``RATIO``."""
    current = settle(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = current.select(F.col("word").alias("at"), F.col("root").alias("next"))
        moved = settle(current.join(further, F.col("root") == F.col("at"), "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        current = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return current


def variants(
    docs: DataFrame, key: str = "doc_id", text: str = "text", misspelt: int = MISSPELT, least_count: int = LEAST_COUNT,
    ratio: int = RATIO, round_bits: int = ROUND_BITS,
) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    Words have ``LEAST_LENGTH`` code points and ``least_count`` occurrences in
    all texts.  Two words are near if one inserted, deleted or replaced code
    point makes one of the other.  A word's form is its most frequent near word
    (of equally frequent ones the first in code-point order), if that is at
    least ``ratio`` times (two or more) as frequent; its root is where forms lead, itself if it
    has none.  Null texts have no words; a null id is spelled as nothing; each
    repeated row counts.  Words and texts of any length are taken whole.  Other columns are not read; an empty
    table gives an empty one.
    """
    if ratio < 2:
        raise ValueError("ratio must be at least 2: forms must lead to more frequent words")
    vocabulary = settle(_hashed(count_words(docs, key, text, misspelt).where(F.col("n") >= least_count)), "spelling-words")
    near = near_pairs(vocabulary, round_bits).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    enough = -F.col("best.less") >= ratio * F.col("n")
    named = settle(vocabulary.join(near, "word", "left").select(
        "word", F.when(enough, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(enough, -F.col("best.less")).alias("form_n")), "spelling-forms")
    roots = _roots(named.where("form IS NOT NULL"))
    return named.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
