"""Character n-gram language models: modified Kneser-Ney, counted by Spark, kept in sorted hash arrays.

One model per language over the characters of all texts.  Tasks count the
n-grams of a slice by sorting their codes and send each distinct one once;
Spark adds up the counts, and derives continuation counts, discounts, back-off
weights and probabilities of all orders by grouping and joining.

The finished model is a table of 64-bit hashes of (language, n-gram) and the
logarithms that belong to them; a hash is an n-gram's identity, so one that was
never counted is not found but backs off.  The table grows with the corpus.  It
goes to tasks in parts of bounded size as pairs of sorted arrays.  A part holds
all n-grams with certain characters before the last one, and the back-off
weights of the contexts that end in these characters: what one look-up may need
lies in one part.  N-grams of one or two characters are in every part.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settle
from .batches import slices

ORDER = 5
#: Entries of a part on average at most (12 bytes each); parts double in number beyond that.
PART_ENTRIES = 8 << 20
#: Languages up to which tables with one row a language are sent to every task.
LANGUAGES = 1_000
#: Bytes of text that a task counts or scores at a time.
SLICE = 2 << 20
SEED = 42
#: Distinct characters that a code of ORDER characters in 64 bits has room for.
ALPHABET = 7_000

_GAP = "\0"
#: What is hashed in front of a language: probabilities, back-off weights, and the characters that choose a part.
_PROBABILITY, _BACK_OFF, _PART = "p", "b", "s"


def codes(points: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Start, codes and alphabet: one code for each n-gram that begins at start, start + 1, ... of ``points``."""
    pending = [(0, len(points))]
    while pending:
        low, high = pending.pop()
        part = points[low:high]
        alphabet = np.flatnonzero(np.bincount(part)) if len(part) else np.zeros(0, np.int64)
        if len(alphabet) > ALPHABET:
            middle = (low + high) // 2
            pending += [(low, middle + ORDER - 1), (middle, high)]
            continue
        if len(part) < ORDER:
            continue
        number = np.zeros(int(alphabet[-1]) + 1, np.uint64)
        number[alphabet] = np.arange(len(alphabet), dtype=np.uint64)
        digits = number[part]
        count = len(part) - ORDER + 1
        code = digits[:count].copy()
        for i in range(1, ORDER):
            code *= np.uint64(len(alphabet))
            code += digits[i : count + i]
        yield low, code, alphabet


def grams_of(code: np.ndarray, alphabet: np.ndarray) -> str:
    """The n-grams of the codes, ORDER characters each, one after the other."""
    points = np.empty((len(code), ORDER), "<u4")
    rest = code.copy()
    for i in reversed(range(ORDER)):
        rest, digit = np.divmod(rest, np.uint64(len(alphabet)))
        points[:, i] = alphabet[digit.astype(np.int64)]
    return points.tobytes().decode("utf-32-le")


def _points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each after ORDER - 1 gaps, and where each text begins."""
    gap = _GAP * (ORDER - 1)
    points = np.frombuffer((gap + gap.join(texts)).encode("utf-32-le"), "<u4")
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    return points, np.cumsum(lengths + ORDER - 1) - lengths - (ORDER - 1)


def by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray]]:
    """Each language of a batch and the rows that have it."""
    languages = np.array([lang or "" for lang in batch.column("lang").to_pylist()], object)
    for lang in sorted(set(languages.tolist())):
        yield lang, np.flatnonzero(languages == lang)


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, most=SLICE):
        texts = batch.column("text").to_pylist()
        for lang, rows in by_language(batch):
            points, starts = _points([texts[r] or "" for r in rows])
            inside = np.ones(len(points), bool)  # an n-gram belongs to the text in which it ends
            inside[(starts[:, None] + np.arange(ORDER - 1)).ravel()] = False
            for low, code, alphabet in codes(points):
                code = np.sort(code[inside[low + ORDER - 1 : low + ORDER - 1 + len(code)]])
                if not len(code):
                    continue
                first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
                counts = np.diff(np.r_[first, len(code)])
                text = grams_of(code[first], alphabet)
                grams = [text[i : i + ORDER] for i in range(0, len(text), ORDER)]
                columns = [pa.array([lang] * len(grams)), pa.array(grams), pa.array(counts, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "gram", "n"])


Batches = Iterator[pa.RecordBatch]


def grams_in(docs: DataFrame, only: Callable[[Batches], Batches] | None = None) -> DataFrame:
    """lang, gram and n of each slice of ``docs`` (lang, text), in the same task as ``only``, which chooses rows."""

    def task(batches: Batches) -> Batches:
        return _count_task(only(batches) if only else batches)

    return docs.select("lang", "text").mapInArrow(task, "lang string, gram string, n bigint")


def count_grams(*parts: DataFrame) -> DataFrame:
    """lang, gram and n for every n-gram of ORDER characters, added up over parts from :func:`grams_in`; a text begins after gaps."""
    return reduce(DataFrame.unionByName, parts).groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _discounts(counts: DataFrame) -> DataFrame:
    """The three discounts of each language from the counts of counts; 0.5, 1 and 1.5 where these are too few."""
    of = lambda c: F.sum((F.col("n") == c).cast("double"))
    tallied = counts.groupBy("lang").agg(*(of(c).alias(f"n{c}") for c in range(1, 5)))
    usual = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
    enough = (F.col("n1") > 0) & (F.col("n2") > 0) & (F.col("n3") > 0) & (F.col("n4") > 0)
    value = lambda k: F.when(enough, F.least(F.lit(float(k)), F.greatest(F.lit(0.0), k - (k + 1) * usual * F.col(f"n{k + 1}") / F.col(f"n{k}")))).otherwise(k / 2)
    return tallied.select("lang", *(value(k).alias(f"d{k}") for k in (1, 2, 3)))


def per_language(table: DataFrame) -> DataFrame:
    """A table with one row a language, for a join; sent to every task if it is checked to be small."""
    stored = settle(table, "languages")
    return F.broadcast(stored) if stored.count() <= LANGUAGES else stored


def probabilities(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Natural logarithms: (lang, gram, value) of all orders, and the back-off weights of all contexts."""
    tables = {ORDER: counts}
    for order in range(ORDER - 1, 0, -1):  # lower orders count the distinct characters in front
        tables[order] = settle(
            tables[order + 1].groupBy("lang", F.substring("gram", 2, order).alias("gram")).agg(F.count("*").alias("n")), f"grams-{order}")
    found, back_offs, lower = [], [], None
    for order in range(1, ORDER + 1):
        table = tables[order]
        cut = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        rows = table.join(per_language(_discounts(table)), "lang").select(
            "lang", "gram", "n", cut.alias("cut"), F.substring("gram", 1, order - 1).alias("context"))
        contexts = settle(
            rows.groupBy("lang", "context").agg(F.sum("n").alias("total"), (F.sum("cut") / F.sum("n")).alias("left"), F.count("*").alias("kinds")),
            f"contexts-{order}")
        joined = rows.join(contexts, ["lang", "context"])
        share = (F.col("n") - F.col("cut")) / F.col("total")
        if lower is None:  # what is left is shared evenly, with one part for characters never seen
            value = joined.select("lang", "gram", "n", (share + F.col("left") / (F.col("kinds") + 1)).alias("p"))
            unseen = contexts.select("lang", F.lit("").alias("gram"), F.log(F.col("left") / (F.col("kinds") + 1)).alias("value"))
            found.append(unseen)
        else:
            shorter = lower.select("lang", F.col("gram").alias("ending"), F.col("p").alias("lower_p"))
            value = joined.withColumn("ending", F.substring("gram", 2, order - 1)).join(shorter, ["lang", "ending"]).select(
                "lang", "gram", "n", (share + F.col("left") * F.col("lower_p")).alias("p"))
            back_offs.append(contexts.select("lang", F.col("context").alias("gram"), F.log(F.greatest("left", F.lit(1e-12))).alias("value")))
        lower = settle(value, f"probabilities-{order}")
        found.append(lower.select("lang", "gram", F.log("p").alias("value")))
    union = lambda frames: frames[0] if len(frames) == 1 else frames[0].unionByName(union(frames[1:]))
    return union(found), union(back_offs)


class ModelTable:
    """The model of these counts as a written table: hash, value, and the hash that chooses the part (null: in every part)."""

    def __init__(self, counts: DataFrame, part_entries: int = PART_ENTRIES):
        found, back_offs = probabilities(counts)
        length = F.length("gram")
        before_last = F.when(length >= 3, F.substring("gram", length - 2, F.lit(2)))
        at_end = F.when(length >= 2, F.substring("gram", length - 1, F.lit(2)))

        def hashed(rows: DataFrame, kind: str, chooses: Column) -> DataFrame:
            return rows.select(
                F.xxhash64(F.concat(F.lit(kind), "lang"), "gram").alias("hash"), F.col("value").cast("float").alias("value"),
                F.when(chooses.isNotNull(), F.xxhash64(F.concat(F.lit(_PART), "lang"), chooses)).alias("chooses"))

        both = hashed(found, _PROBABILITY, before_last).unionByName(hashed(back_offs, _BACK_OFF, at_end))
        self.table = settle(both, "language-model")
        entries = self.table.count()
        self.parts = 1 << max(0, math.ceil(math.log2(max(1, entries / part_entries))))

    def part(self, number: int) -> tuple[np.ndarray, np.ndarray, int, int]:
        """Sorted hashes and their values, the part's number and the number of parts; what :class:`Model` takes."""
        own = F.col("chooses").isNull() | (F.pmod("chooses", F.lit(self.parts)) == number)
        table = self.table.where(own).select("hash", "value").toArrow()  # about PART_ENTRIES rows
        hashes = table.column("hash").to_numpy().view(np.uint64)
        order = np.argsort(hashes)
        return hashes[order], table.column("value").to_numpy().astype(np.float32)[order], number, self.parts


class Model:
    """Look-ups in one part of the model."""

    def __init__(self, hashes: np.ndarray, values: np.ndarray, number: int = 0, parts: int = 1):
        self.hashes, self.values, self.number, self.parts = hashes, values, number, parts

    def find(self, kind: str, lang: str, grams: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Value of each n-gram, and whether it was counted."""
        if not len(self.hashes):
            return np.zeros(len(grams), np.float32), np.zeros(len(grams), bool)
        seed, digest = xxhash.xxh64_intdigest((kind + lang).encode(), SEED), xxhash.xxh64_intdigest
        wanted = np.fromiter((digest(g.encode(), seed) for g in grams), np.uint64, len(grams))
        at = np.minimum(np.searchsorted(self.hashes, wanted), len(self.hashes) - 1)
        return self.values[at], self.hashes[at] == wanted

    def own(self, lang: str, grams: list[str]) -> np.ndarray:
        """Which n-grams of ORDER characters belong to this part."""
        seed, digest = xxhash.xxh64_intdigest((_PART + lang).encode(), SEED), xxhash.xxh64_intdigest
        chosen: dict[str, bool] = {}
        for pair in {g[ORDER - 3 : ORDER - 1] for g in grams}:
            chosen[pair] = digest(pair.encode(), seed) % self.parts == self.number
        return np.fromiter((chosen[g[ORDER - 3 : ORDER - 1]] for g in grams), bool, len(grams))

    def log_probabilities(self, lang: str, grams: list[str]) -> np.ndarray:
        """Of the last character of each n-gram after the others; unseen ones back off to shorter contexts."""
        value, known = self.find(_PROBABILITY, lang, grams)
        if not known.all():
            open_ = np.flatnonzero(~known)
            value = value.astype(np.float32).copy()
            longer = [grams[i] for i in open_]
            if not longer[0]:
                value[open_] = -20.0  # a language that was never counted
            else:
                weight, seen = self.find(_BACK_OFF, lang, [g[:-1] for g in longer])
                value[open_] = np.where(seen & (len(longer[0]) > 1), weight, 0) + self.log_probabilities(lang, [g[1:] for g in longer])
        return value

    def score(self, lang: str, texts: list[str]) -> np.ndarray:
        """Sum of the log-probabilities of the characters of each text that this part knows about."""
        points, starts = _points(texts)
        each = np.zeros(len(points) + 1)
        for low, code, alphabet in codes(points):
            distinct = np.sort(code)
            distinct = distinct[np.r_[True, distinct[1:] != distinct[:-1]]]
            joined = grams_of(distinct, alphabet)
            grams = [joined[i : i + ORDER] for i in range(0, len(joined), ORDER)]
            if self.parts == 1:
                value = self.log_probabilities(lang, grams)
            else:
                value, own = np.zeros(len(grams)), np.flatnonzero(self.own(lang, grams))
                if len(own):
                    value[own] = self.log_probabilities(lang, [grams[i] for i in own.tolist()])
            each[low + ORDER - 1 : low + ORDER - 1 + len(code)] = value[np.searchsorted(distinct, code)]
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        each[(starts[:, None] + np.arange(ORDER - 1)).ravel()] = 0.0
        return np.where(lengths > 0, np.add.reduceat(each, starts) if len(starts) else 0.0, 0.0)
