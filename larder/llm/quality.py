"""Quality rules: base counts, and perplexity bands of each language.

The language model (see :mod:`ngrams`) is counted over the distinct texts of each
language.  The perplexity of a document is compared with the bands of its
language: quartiles of all distinct texts that pass the base rules, widened by
``FENCES`` times their distance.  A copied text weighs one in both.  Beyond the
upper band the text is unlike its language, below the lower one it says too
little.

Only copied texts are moved to be counted once: digests with several rows fill a
Bloom filter of bounded size, and texts outside it are counted where they are
read.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settle
from .batches import slices
from .ngrams import PART_ENTRIES, SLICE, Batches, Model, ModelTable, by_language, count_grams, grams_in, per_language
from .spelling import Filter

LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
WINDOW = 3
#: Below the lower quartile and above the upper one; low values are common among short or nearly copied texts.
FENCES = (4.0, 3.0)
#: Steps of cross-entropy (nats per character) in which the quartiles are counted.
STEP = 0.001
#: Bits of filter for each copied text, and of the filter (32 MB); a fuller filter only moves more texts.
BITS_PER_TEXT = 16
FILTER_BITS = 1 << 28

# The characters that separate words, and those that count as symbols.
SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"

_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """Words, their characters, symbols, repeated lines, and words in repeated windows of three."""
    words = text.encode().split()
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    repeated = 0
    if len(words) >= WINDOW:
        windows = list(zip(*(words[i:] for i in range(WINDOW))))
        if len(set(windows)) < len(windows):
            counts = Counter(windows)
            starts = np.fromiter((counts[w] > 1 for w in windows), bool, len(windows))
            covered = np.zeros(len(words), bool)
            for i in range(WINDOW):
                covered[i : i + len(starts)] |= starts
            repeated = int(covered.sum())
    return (
        len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)), repeated,
    )


def fails_base(n_words: int, n_repeat_words: int) -> bool:
    return n_words < LEAST_WORDS or 100 * n_repeat_words > MOST_REPEATED_PERCENT * n_words


def _digest(texts: list[str]) -> tuple[list[bytes], np.ndarray]:
    """SHA-256 of each text, and its first eight bytes as numbers."""
    found = [hashlib.sha256(t.encode()).digest() for t in texts]
    return found, np.frombuffer(b"".join(d[:8] for d in found), "<u8").astype(np.uint64)


def _copied(named: DataFrame) -> tuple[Filter, np.ndarray]:
    """A filter that holds the digests of all texts with several rows in one language."""
    rows = named.groupBy("lang", F.unhex(F.sha2("text", 256)).alias("digest")).count().where("count > 1")
    copies = settle(rows.select("digest").distinct(), "copied-digests")
    size = max(1, min(FILTER_BITS, copies.count() * BITS_PER_TEXT) // 64)
    holds = Filter(0, 0, 1, 0, size)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block, bits = holds.marks(np.frombuffer(b"".join(d[:8] for d in batch.column("digest").to_pylist()), "<u8").astype(np.uint64), 0)
            yield pa.RecordBatch.from_arrays([pa.array(block.astype(np.int32)), pa.array(bits.view(np.int64))], ["block", "bits"])

    marks = copies.mapInArrow(task, "block int, bits bigint").groupBy("block").agg(F.bit_or("bits").alias("bits")).toArrow()  # FILTER_BITS / 64 rows at most
    filled = np.zeros(size, np.uint64)
    filled[marks.column("block").to_numpy()] = marks.column("bits").to_numpy().view(np.uint64)
    return holds, filled


def count_distinct_texts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """n-grams of every distinct text of a language, nulls as empty: texts with one row are counted where they are read."""
    named = docs.select(F.coalesce(lang, F.lit("")).alias("lang"), F.coalesce(text, F.lit("")).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(_copied(named))  # FILTER_BITS at most

    def chosen(maybe_copied: bool) -> Callable[[Batches], Batches]:
        def only(batches: Batches) -> Batches:
            holds, filled = shared.value
            for batch in slices(batches, most=SLICE):
                _, hashes = _digest(batch.column("text").to_pylist())
                maybe = np.zeros(len(hashes), bool)
                maybe[holds.positives(hashes, filled)] = True
                yield batch.filter(pa.array(maybe if maybe_copied else ~maybe))

        return only

    copies = named.mapInArrow(chosen(True), "lang string, text string")
    once = copies.groupBy("lang", F.sha2("text", 256).alias("digest")).agg(F.first("text").alias("text"))
    return count_grams(grams_in(named, chosen(False)), grams_in(once))


def _sums(texts: list[str], batch: pa.RecordBatch, model: Model) -> np.ndarray:
    """Sum of log-probabilities of each text; zero without a character."""
    sums = np.zeros(len(texts))
    for lang, rows in by_language(batch):
        sums[rows] = model.score(lang, [texts[r] for r in rows])
    return sums


class Rules:
    """The model and the bands fitted to a table of documents, and each document's counts and verdict.

    With ``whole`` the rows themselves are written beside their scores, so that
    they need neither be scored again nor joined.
    """

    def __init__(self, docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", whole: bool = False, part_entries: int = PART_ENTRIES):
        self.key, self.whole = key, whole
        counts = settle(count_distinct_texts(docs, text, lang), "grams")
        self.model = ModelTable(counts, part_entries)
        said = [F.coalesce(lang, F.lit("")).alias("lang"), F.coalesce(text, F.lit("")).alias("text")]
        self.held = F.struct(*(F.col(f"`{c}`") for c in docs.columns)) if whole else F.col(key)
        # Whole rows hold language and text already: these are not sent to the tasks a second time.
        self.names = (lang, text) if whole else None
        self.scored = settle(self._scored(docs.select(self.held.alias("held"), *([] if whole else said))), "quality-scores")
        for number in range(1, self.model.parts):
            more = self._partial(docs.select(*said), number).groupBy("lang", "digest").agg(F.min("part_sum").alias("part_sum"))
            joined = self.scored.join(more, ["lang", "digest"])
            self.scored = settle(joined.withColumn("log_sum", F.col("log_sum") + F.col("part_sum")).drop("part_sum"), "quality-scores")
        self.bands = settle(self._bands(), "perplexity-bands")

    def _scored(self, docs: DataFrame) -> DataFrame:
        """What is held of each row, its counts, and the sum of log-probabilities from the model's first part."""
        model = docs.sparkSession.sparkContext.broadcast(self.model.part(0))
        names = self.names

        def said(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if names is None:
                    yield batch
                else:
                    held = batch.column("held")
                    parts = [pc.fill_null(pc.struct_field(held, [name]), "") for name in names]
                    yield pa.RecordBatch.from_arrays([held, *parts], ["held", "lang", "text"])

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = Model(*model.value)
            for batch in slices(said(batches), most=SLICE):
                texts = batch.column("text").to_pylist()
                counts = np.array([base_counts(t) for t in texts], np.int64).reshape(-1, len(_COUNTS))
                failed = [fails_base(n, r) for n, r in counts[:, [0, 4]].tolist()]
                columns = [batch.column("held"), batch.column("lang"), *(pa.array(counts[:, i]) for i in range(len(_COUNTS))), pa.array(failed, pa.bool_()),
                           pa.array([len(t) for t in texts], pa.int64()), pa.array(_sums(texts, batch, own)), pa.array(_digest(texts)[0], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["held", "lang", *_COUNTS, "base_failed", "n_chars", "log_sum", "digest"])

        added = ", ".join(f"CAST(0 AS BIGINT) AS {c}" for c in _COUNTS)
        schema = docs.selectExpr("held", "'' AS lang", *added.split(", "), "false AS base_failed", "0L AS n_chars", "0D AS log_sum", "CAST('' AS BINARY) AS digest").schema
        return docs.mapInArrow(task, schema)

    def _partial(self, docs: DataFrame, number: int) -> DataFrame:
        """lang, digest and sum of log-probabilities from another part of the model."""
        model = docs.sparkSession.sparkContext.broadcast(self.model.part(number))

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = Model(*model.value)
            for batch in slices(batches, most=SLICE):
                texts = batch.column("text").to_pylist()
                columns = [batch.column("lang"), pa.array(_digest(texts)[0], pa.binary()), pa.array(_sums(texts, batch, own))]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "digest", "part_sum"])

        return docs.mapInArrow(task, "lang string, digest binary, part_sum double")

    @property
    def entropy(self) -> Column:
        return -F.col("log_sum") / F.greatest("n_chars", F.lit(1))

    def _bands(self) -> DataFrame:
        """lang, lower and upper cross-entropy; quartiles come from counts of distinct texts per step, one row a step."""
        texts = self.scored.where("NOT base_failed").groupBy("lang", "digest").agg(F.min(self.entropy).alias("entropy"))
        steps = texts.groupBy("lang", F.round(F.col("entropy") / STEP).cast("bigint").alias("step")).count()
        quartiles = steps.groupBy("lang").agg(F.expr("percentile(step, array(0.25, 0.75), count)").alias("q"))
        low, high = F.col("q")[0] * STEP, F.col("q")[1] * STEP
        width = F.greatest(high - low, F.lit(STEP))
        return quartiles.select("lang", (low - FENCES[0] * width).alias("lower"), (high + FENCES[1] * width).alias("upper"))

    def _judged(self) -> DataFrame:
        joined = self.scored.withColumn("entropy", self.entropy).join(per_language(self.bands), "lang", "left")
        inside = F.coalesce(F.col("entropy").between(F.col("lower"), F.col("upper")), F.lit(False))
        return joined.withColumn("kept", ~F.col("base_failed") & inside)

    def verdicts(self) -> DataFrame:
        """One row per document: doc_id, the base counts, base_failed, kept, perplexity and its bands."""
        key = F.col("held").getField(self.key) if self.whole else F.col("held")
        return self._judged().select(
            key.alias(self.key), *_COUNTS, "base_failed", "kept",
            F.exp("entropy").alias("perplexity"), F.exp("lower").alias("lower_band"), F.exp("upper").alias("upper_band"),
        )

    def kept(self) -> DataFrame:
        """The rows that the rules keep, whole and unshuffled."""
        return self._judged().where("kept").select("held.*")


def keep(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns; see :func:`judge` for nulls, ties and empty tables."""
    return Rules(docs, key, text, lang, whole=True).kept()


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Counts and verdict of every row of ``docs``.

    Null text counts as empty and fails the base rules; a null language counts
    as the empty one, and every value is a language of its own.  Rows are judged
    one by one: repeated rows and null ids come back as they are.  Texts of any
    length are counted and scored whole, a very long one in a slice of its own.
    A language in which no document passes the base rules has no bands and
    keeps none.  Other columns are not read; an empty table gives an empty one.
    """
    return Rules(docs, key, text, lang).verdicts()
