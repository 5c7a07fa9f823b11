"""Repeated passages by content-defined chunking.

A gear hash rolls over the bytes of a text; wherever it falls below a
threshold, a chunk ends.  The hash covers the last 16 bytes only, so an
insertion moves the cuts near it and no others, and a passage that stands in
two documents is cut alike inside.  Chunks are deduplicated by digest: the
document with the smallest id holds the first copy.  Neighbouring chunks of a
document that have their first copy elsewhere form a span.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import settle
from .batches import slices

#: Bytes of a chunk on average, and at most.
AVERAGE = 32
MOST = 256
#: A span counts with so many words, and so many bytes beyond the first COMMON ones of each chunk:
#: short chunks repeat by chance.
LEAST_WORDS = 12
LEAST_EVIDENCE = 32
COMMON = 16

_WINDOW = (1, 2, 4, 8)
_GEAR = np.random.Generator(np.random.PCG64(2024)).integers(0, 1 << 16, 256, dtype=np.uint16)
_MIX = np.uint16(40_503)
_SPACES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])

_FIELDS = ["key", "chunk", "start", "size", "words", "d1", "d2"]
_TYPES = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]


def rolling(data: np.ndarray) -> np.ndarray:
    """Sum over the last 16 bytes of their gear value, doubled once for each byte passed since, then mixed."""
    value = _GEAR[data]
    for width in _WINDOW:
        if len(value) > width:
            wider = value.copy()
            wider[width:] += value[:-width] << np.uint16(width)
            value = wider
    return value * _MIX


def cuts(data: np.ndarray) -> np.ndarray:
    """Ends of the chunks of one text, the last one its length."""
    ends = np.flatnonzero(rolling(data) < (1 << 16) // AVERAGE) + 1
    if not len(ends) or ends[-1] != len(data):
        ends = np.r_[ends, len(data)]
    gaps = np.diff(ends, prepend=0)
    if len(gaps) and gaps.max() > MOST:  # long stretches without a cut: every MOST bytes
        more = [np.arange(end - gap + MOST, end, MOST) for end, gap in zip(ends[gaps > MOST], gaps[gaps > MOST])]
        ends = np.unique(np.concatenate([ends, *more]))
    return ends


def cut_text(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, sizes, words that begin in it, and 128-bit digests (two columns) of the chunks of a text."""
    data = np.frombuffer(text, np.uint8)
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros((0, 2), np.int64)
    ends = cuts(data)
    starts = np.r_[0, ends[:-1]]
    space = _SPACES[data]
    begins = ~space
    begins[1:] &= space[:-1]
    words = np.add.reduceat(begins.astype(np.int32), starts)
    digest = xxhash.xxh3_128_digest
    digests = np.frombuffer(b"".join([digest(text[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]), ">i8").reshape(-1, 2)
    return starts, (ends - starts).astype(np.int32), words, digests


def chunk_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per chunk: key, chunk (its number), start and size in bytes, words, and the digest in d1 and d2."""
    kind = docs.schema[key].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [cut_text((t or "").encode()) for t in batch.column("text").to_pylist()]
            counts = np.array([len(f[0]) for f in found])
            if not counts.sum():
                continue
            rows = np.repeat(np.arange(len(found)), counts)
            number = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
            starts, sizes, words = (np.concatenate([f[i] for f in found]) for i in range(3))
            digests = np.concatenate([f[3] for f in found]).astype(np.int64)
            values = [number, starts, sizes, words, digests[:, 0], digests[:, 1]]
            columns = [batch.column(0).take(pa.array(rows)), *(pa.array(v, t) for v, t in zip(values, _TYPES))]
            yield pa.RecordBatch.from_arrays(columns, _FIELDS)

    chosen = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return chosen.mapInArrow(task, f"key {kind}, chunk int, start bigint, size int, words int, d1 bigint, d2 bigint")


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per span of a document that other documents, with smaller ids, hold already.

    Returns doc_id, start and n_bytes (in the UTF-8 bytes of the text), n_words,
    n_chunks, and source_doc_ids: the documents that hold the first copies of
    its chunks.  A document without such a span has no row; cutting the spans
    out leaves one copy of each passage.

    Null and empty texts have no chunk.  Rows with a null id are left out, as no
    copy could be assigned to them.  Rows repeated with the same id are one
    document, whose own repeats don't count.  Other columns are not read; an
    empty table gives an empty one.
    """
    chunks = chunk_rows(docs.where(F.col(key).isNotNull()), key, text)
    owners = chunks.groupBy("d1", "d2").agg(F.min("key").alias("owner"), F.max("key").alias("last"))
    # Written, so that both sides of the join are plain shuffles and a very common chunk can be split.
    shared = settle(owners.where("owner < last").select("d1", "d2", "owner"), "shared-chunks")
    later = chunks.join(shared, ["d1", "d2"]).where("key > owner").select("key", "chunk", "start", "size", "words", "owner")
    run = F.col("chunk") - F.dense_rank().over(W.partitionBy("key").orderBy("chunk"))
    spans = later.withColumn("run", run).groupBy("key", "run").agg(
        F.min("start").alias("start"), F.sum("size").alias("bytes"), F.sum("words").alias("words"), F.count("*").alias("n"),
        F.sum(F.greatest(F.col("size") - COMMON, F.lit(0))).alias("evidence"), F.sort_array(F.collect_set("owner")).alias("owners"),
        F.size(F.collect_set("chunk")).cast("bigint").alias("distinct_chunks"),
    )
    copies = F.col("n") / F.col("distinct_chunks")  # a row that is repeated brings each chunk again
    return spans.where((F.col("words") >= LEAST_WORDS * copies) & (F.col("evidence") >= LEAST_EVIDENCE * copies)).select(
        F.col("key").alias("doc_id"), "start", (F.col("bytes") / copies).cast("bigint").alias("n_bytes"),
        (F.col("words") / copies).cast("bigint").alias("n_words"), F.col("distinct_chunks").alias("n_chunks"),
        F.col("owners").alias("source_doc_ids"),
    )
