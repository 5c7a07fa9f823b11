"""Exact deduplication by composable polynomial fingerprints and a chunkwise comparison.

A text is read as pieces of ``PIECE`` bytes.  The hash of a piece is the sum of
``(byte + 1) * B**position`` modulo a prime, so the hash of the whole text is
the sum of the piece hashes, each shifted by ``B**(bytes before it)``: pieces of
a huge document are hashed by different tasks and combined by one sum.  Two
primes' worth of bases and the length make the fingerprint.  Equal fingerprints
are only candidates: the pieces of each candidate are then compared, piece by
piece, with those of the row that would stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settle
from .batches import slices

#: Bytes of a text that are hashed or compared at a time.
PIECE = 1 << 16

PRIME = (1 << 31) - 1
BASES = (1_103_515_245, 1_566_083_941)


@lru_cache(maxsize=4)
def _powers(base: int) -> np.ndarray:
    powers = np.empty(PIECE, np.uint64)
    powers[0] = 1
    known = 1
    while known < PIECE:  # the next run of powers is the known one, shifted
        shift = np.uint64(pow(base, known, PRIME))
        powers[known : 2 * known] = powers[: min(known, PIECE - known)] * shift % np.uint64(PRIME)
        known *= 2
    return powers


def piece_hashes(pieces: list[bytes], base: int) -> np.ndarray:
    """Hash of each piece (of ``PIECE`` bytes at most), not shifted."""
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    out = np.zeros(len(pieces), np.uint64)
    filled = np.flatnonzero(sizes)
    if len(filled):
        starts = (np.cumsum(sizes) - sizes)[filled]
        data = np.frombuffer(b"".join(pieces), np.uint8).astype(np.uint64) + np.uint64(1)
        data *= _powers(base)[np.arange(len(data)) - np.repeat(starts, sizes[filled])]
        out[filled] = np.add.reduceat(data, starts) % np.uint64(PRIME)
    return out


def shifted(hashes: np.ndarray, before: np.ndarray, base: int) -> np.ndarray:
    """What pieces with so many bytes before them add to the hash of the whole."""
    shift = np.fromiter((pow(base, int(n), PRIME) for n in before), np.uint64, len(before))
    return hashes * shift % np.uint64(PRIME)


def fingerprint(text: bytes) -> tuple[int, int, int]:
    """Length and both hashes of one text, by the same arithmetic as the distributed way."""
    pieces = [text[i : i + PIECE] for i in range(0, len(text), PIECE)] or [b""]
    before = np.arange(len(pieces)) * PIECE
    return (len(text), *(int(shifted(piece_hashes(pieces, b), before, b).sum() % PRIME) for b in BASES))


def _hash_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "bytes"):
        pieces = batch.column("bytes").to_pylist()
        before = batch.column("piece").to_numpy() * np.int64(PIECE)
        hashes = [shifted(piece_hashes(pieces, b), before, b).astype(np.int64) for b in BASES]
        names = ["doc_id", "text_sha256", "n_bytes", "piece", "h1", "h2"]
        columns = [batch.column(n) for n in names[:4]] + [pa.array(h) for h in hashes]
        yield pa.RecordBatch.from_arrays(columns, names)


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Id, digest, length and text of each row; the digest tells rows with the same id apart."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(key).alias("doc_id"),
        F.sha2(whole, 256).alias("text_sha256"),
        F.octet_length(whole).cast("bigint").alias("n_bytes"),
        whole.cast("binary").alias("bytes"),
    )


def _cut(rows: DataFrame) -> DataFrame:
    """One row per piece; an empty text has one empty piece."""
    numbers = F.expr(f"sequence(0, cast((greatest(n_bytes, 1) - 1) div {PIECE} as int))")
    others = [c for c in rows.columns if c != "bytes"]
    return rows.select(*others, "bytes", F.explode(numbers).alias("piece")).select(
        *others, "piece", F.expr(f"substring(bytes, piece * {PIECE} + 1, {PIECE})").alias("bytes")
    )


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text_sha256, n_bytes, h1, h2 of every row.

    Texts of one piece are hashed where they are read; only the pieces of
    longer ones are dealt out to other tasks and summed up per document.
    """
    rows = _rows(docs, key, text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, text_sha256 string, n_bytes bigint, piece int, h1 bigint, h2 bigint"
    names = ["doc_id", "text_sha256", "n_bytes"]
    short = rows.where(f"n_bytes <= {PIECE}").withColumn("piece", F.lit(0)).mapInArrow(_hash_task, schema)
    pieces = _cut(rows.where(f"n_bytes > {PIECE}")).repartition(*names, "piece").mapInArrow(_hash_task, schema)
    # A row that is repeated gives equal pieces, counted as copies.
    single = pieces.groupBy(*names, "piece").agg(F.max("h1").alias("h1"), F.max("h2").alias("h2"), F.count("*").alias("copies"))
    total = lambda name: (F.sum(name) % PRIME).alias(name)
    long = single.groupBy(*names).agg(total("h1"), total("h2"), F.max("copies").cast("int").alias("copies"))
    repeated = long.select(*names, "h1", "h2", F.explode(F.expr("sequence(1, copies)"))).select(*names, "h1", "h2")
    return short.select(*names, "h1", "h2").unionByName(repeated)


def _same_row(a: str, b: str) -> Column:
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.text_sha256") == F.col(f"{b}.text_sha256"))


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Of rows whose texts are identical, the one with the largest id stays.  Null
    text counts as the empty text, and all empty texts form one group.  Null ids
    count as smaller than all others.  A row that is repeated with the same id
    and text counts in ``group_size`` and shares the fate of its twin.  Other
    columns of ``docs`` are not read; an empty table gives an empty one.
    """
    rows = _rows(docs, key, text)
    meta = settle(fingerprints(docs, key, text), "fingerprints")
    shape = ["n_bytes", "h1", "h2"]
    open_rows = meta
    assigned = None
    while True:
        # Each round compares every open row with the largest id of its fingerprint.
        # Written, so that both sides of the join are plain shuffles and a large group can be split.
        groups = settle(open_rows.groupBy(*shape).agg(
            F.max(F.struct("doc_id", "text_sha256")).alias("stays"), F.count("*").alias("n")
        ).where("n > 1"), "groups")
        candidates = settle(open_rows.join(groups, shape).select(
            "doc_id", "text_sha256", F.col("stays.doc_id").alias("keep_id"), F.col("stays.text_sha256").alias("keep_sha256")
        ), "candidates")
        found = settle(_compare(rows, candidates.distinct()), "equal-rows")
        assigned = found if assigned is None else assigned.unionByName(found)
        left = open_rows.join(groups.select(*shape), shape, "left_semi").alias("a").join(
            found.alias("b"), _same_row("a", "b"), "left_anti")
        left = settle(left, "open-rows")
        if left.isEmpty():
            break
        open_rows = left
    sizes = settle(assigned.groupBy("keep_id", "keep_sha256").agg(F.sum("copies").alias("group_size")), "group-sizes")
    found = assigned.alias("a").join(
        sizes.alias("s"), F.col("a.keep_id").eqNullSafe(F.col("s.keep_id")) & (F.col("a.keep_sha256") == F.col("s.keep_sha256"))
    ).select("a.doc_id", "a.text_sha256", "a.keep_id", "a.keep_sha256", "s.group_size")
    result = meta.select("doc_id", "text_sha256").alias("a").join(found.alias("b"), _same_row("a", "b"), "left")
    alone = F.col("b.text_sha256").isNull()
    return result.select(
        F.col("a.doc_id").alias("doc_id"),
        F.when(alone, F.col("a.doc_id")).otherwise(F.col("b.keep_id")).alias("keep_id"),
        F.coalesce("b.group_size", F.lit(1)).cast("bigint").alias("group_size"),
        (alone | (F.col("a.doc_id").eqNullSafe(F.col("b.keep_id")) & (F.col("b.text_sha256") == F.col("b.keep_sha256")))).alias("kept"),
        F.col("a.text_sha256").alias("text_sha256"),
    )


def _compare(rows: DataFrame, candidates: DataFrame) -> DataFrame:
    """The candidates whose pieces all equal those of the row that would stay, with their number of copies."""
    members = settle(rows.alias("r").join(candidates.alias("c"), _same_row("r", "c")).select(
        "r.doc_id", "r.text_sha256", "r.n_bytes", "r.bytes", "c.keep_id", "c.keep_sha256"
    ), "candidate-texts")  # a small part of all texts, read twice below
    pieces = _cut(members)
    standing = pieces.where(F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("text_sha256") == F.col("keep_sha256")))
    equal = pieces.alias("p").join(
        standing.select("keep_id", "keep_sha256", "piece", "bytes").alias("s"),
        F.col("p.keep_id").eqNullSafe(F.col("s.keep_id")) & (F.col("p.keep_sha256") == F.col("s.keep_sha256"))
        & (F.col("p.piece") == F.col("s.piece")) & (F.col("p.bytes") == F.col("s.bytes")),
        "left_semi",
    )
    whole = F.expr(f"(greatest(max(n_bytes), 1) - 1) div {PIECE} + 1")
    return (
        equal.groupBy("doc_id", "text_sha256", "keep_id", "keep_sha256")
        .agg(F.count("*").alias("pieces"), whole.alias("expected"))
        .where("pieces >= expected")
        .select("doc_id", "text_sha256", "keep_id", "keep_sha256", F.expr("pieces div expected").alias("copies"))
    )
