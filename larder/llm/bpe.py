"""Byte-level BPE encoding and decoding through a pair occurrence index.

A task splits the texts of an Arrow batch into pre-tokens, keeps each distinct
pre-token once, and lays their bytes out in one long linked list of symbols.
An index maps every mergeable pair to all its positions in that list.  The
active merge ranks are applied in ascending order: all occurrences of a pair
are merged at once, and the lists of the pairs that appear around them are
extended.  A merge result takes part in later ranks only, so one pass over the
ascending ranks gives the same ids as merging each text on its own.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import slices

# The pre-token pattern that byte-level vocabularies of this family share.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_GAP = -1


def _byte_of_character() -> dict[str, int]:
    """Vocabulary files spell each byte as a printable character: itself, or the next free code from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def _latin_pattern() -> re.Pattern:
    """PATTERN for texts whose characters are all below 256, where plain character sets are faster."""

    def members(kind: str) -> str:
        return "".join(re.escape(chr(c)) for c in range(256) if regex.match(kind, chr(c)))

    letters, numbers, spaces = members(r"\p{L}"), members(r"\p{N}"), members(r"\p{White_Space}")
    return re.compile(
        rf" ?[{letters}]+|'(?:s|t|re|ve|m|ll|d)| ?[{numbers}]+| ?[^{spaces}{letters}{numbers}]+"
        rf"|[{spaces}]+(?![^{spaces}])|[{spaces}]+"
    )


_LATIN = _latin_pattern()
_ANY = regex.compile(PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


def pre_tokens(text: str) -> list[str]:
    """Pieces of a text that merges never cross."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return _ANY.findall(text)
    return _LATIN.findall(text)


class Vocabulary:
    """Merge ranks, byte ids and token bytes of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        ids, byte_of = spec["model"]["vocab"], _byte_of_character()
        added = {token["content"]: token["id"] for token in spec["added_tokens"]}
        self.added = added
        self.added_pattern = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.size = max([*ids.values(), *added.values()]) + 1
        spelled = [b""] * self.size
        for token, number in ids.items():
            spelled[number] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        for token, number in added.items():
            spelled[number] = token.encode()
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        self.spelled_at = np.concatenate([[0], np.cumsum([len(s) for s in spelled])])
        self.of_byte = np.zeros(256, np.int32)
        for character, byte in byte_of.items():
            self.of_byte[byte] = ids[character]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.left = np.array([ids[a] for a, _ in pairs], np.int64)
        self.right = np.array([ids[b] for _, b in pairs], np.int64)
        self.made = np.array([ids[a + b] for a, b in pairs], np.int64)
        keys = self.left * self.size + self.right
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where it can't be merged."""
        wanted = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where((left != _GAP) & (right != _GAP) & (self.keys[at] == wanted), self.order[at], -1)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class _Occurrences:
    """For each active rank the positions at which its pair begins."""

    def __init__(self):
        self.lists: dict[int, list[np.ndarray]] = {}
        self.active: list[int] = []

    def add(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        mergeable = ranks >= 0
        ranks, positions = ranks[mergeable], positions[mergeable]
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        starts = np.flatnonzero(np.r_[True, ranks[1:] != ranks[:-1]])
        for rank, group in zip(ranks[starts].tolist(), np.split(positions, starts[1:])):
            known = self.lists.get(rank)
            if known is None:
                self.lists[rank] = [group]
                heapq.heappush(self.active, rank)
            else:
                known.append(group)

    def pop(self) -> tuple[int, np.ndarray]:
        rank = heapq.heappop(self.active)
        groups = self.lists.pop(rank)
        return rank, groups[0] if len(groups) == 1 else np.concatenate(groups)


def merge_all(words: list[bytes], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words one after the other, and the offsets of each word in them."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths + 1) - lengths - 1
    total = int(lengths.sum()) + len(words)
    symbol = np.full(total + 2, _GAP, np.int32)
    inside = np.ones(total, bool)
    inside[starts + lengths] = False
    symbol[:total][inside] = vocab.of_byte[np.frombuffer(b"".join(words), np.uint8)]
    after = np.arange(1, total + 3, dtype=np.int32)
    before = np.arange(-1, total + 1, dtype=np.int32)
    before[0] = total + 1
    after[-2:] = total + 1
    index = _Occurrences()
    every = np.flatnonzero(symbol[:total] != _GAP).astype(np.int32)
    index.add(vocab.ranks(symbol[every], symbol[after[every]]), every)
    del every
    while index.active:
        rank, at = index.pop()
        left, right, made = vocab.left[rank], vocab.right[rank], vocab.made[rank]
        at = at[(symbol[at] == left) & (symbol[after[at]] == right)]
        if left == right and len(at) > 1:
            at = _without_overlaps(np.unique(at), after)
        if not len(at):
            continue
        gone = after[at]
        symbol[at] = made
        symbol[gone] = _GAP - 1
        following = after[gone]
        after[at] = following
        before[following] = at
        previous = before[at]
        index.add(vocab.ranks(symbol[previous], symbol[at]), previous)
        index.add(vocab.ranks(symbol[at], symbol[following]), at)
    alive = np.flatnonzero(symbol[:total] >= 0)
    ids = symbol[alive]
    ends = np.searchsorted(alive, starts + lengths)
    return ids, np.concatenate([[0], ends])


def _without_overlaps(at: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of pairs that share a symbol (as in a a a), every other one, from the left."""
    chained = np.r_[False, after[at[:-1]] == at[1:]]
    run_start = np.maximum.accumulate(np.where(chained, 0, np.arange(len(at))))
    return at[(np.arange(len(at)) - run_start) % 2 == 0]


def _gather(flat: np.ndarray, offsets: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The pieces ``flat[offsets[c]:offsets[c + 1]]`` of all chosen, one after the other."""
    sizes = offsets[chosen + 1] - offsets[chosen]
    ends = np.cumsum(sizes)
    shift = np.repeat(offsets[chosen] - ends + sizes, sizes)
    return flat[shift + np.arange(len(shift))]


class _Numbers(dict):
    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


def encode_texts(texts: list[str | None], vocab: Vocabulary) -> list[np.ndarray]:
    """Ids of each text (uint32); None counts as empty."""
    numbers = _Numbers()
    pieces: list[list[int | np.ndarray]] = []
    for text in texts:
        parts = vocab.added_pattern.split(text) if text and vocab.added_pattern else [text or ""]
        pieces.append([
            vocab.added[part] if i % 2 else np.fromiter(map(numbers.__getitem__, words := pre_tokens(part)), np.int32, len(words))
            for i, part in enumerate(parts)
        ])
    flat, offsets = merge_all([word.encode() for word in numbers], vocab)
    flat = flat.astype(np.uint32)
    return [
        np.concatenate([np.array([p], np.uint32) if isinstance(p, int) else _gather(flat, offsets, p) for p in parts])
        for parts in pieces
    ]


def decode_ids(ids: np.ndarray, vocab: Vocabulary) -> str:
    """Text of the ids, special tokens included; bytes that are no UTF-8 become U+FFFD."""
    return _gather(vocab.spelled, vocab.spelled_at, ids.astype(np.int64)).tobytes().decode("utf-8", "replace")


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", decoded: bool = False) -> DataFrame:
    """Ids of every whole text.

    Returns ``key`` and ``ids`` (binary, little-endian unsigned 32-bit numbers)
    and, if asked for, ``decoded``: the text that the ids give back.  ``path``
    names a tokenizer file that exists on every executor.

    Null text counts as empty and gives no ids.  Rows are independent of each
    other: repeated rows and null keys come back as they are, an empty table
    gives an empty one, and other columns of ``docs`` are not read.
    """
    kind = docs.schema[key].dataType
    schema = pa.schema([("ids", pa.binary()), ("decoded", pa.string())][: 1 + decoded])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in slices(batches, "text", 32 << 20):
            found = encode_texts(batch.column("text").to_pylist(), vocab)
            start = 0
            for part in slices(iter([batch]), "text"):
                rows = found[start : start + part.num_rows]
                start += part.num_rows
                columns = [part.column(0), pa.array([r.tobytes() for r in rows], pa.binary())]
                if decoded:
                    columns.append(pa.array([decode_ids(r, vocab) for r in rows], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, ["key", *schema.names])

    chosen = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    outcome = chosen.mapInArrow(task, f"key {kind.simpleString()}, ids binary" + ", decoded string" * decoded)
    return outcome.withColumnRenamed("key", key)


def decode(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key`` and ``text`` for the ids of :func:`encode`; null ids give the empty text."""
    kind = encoded.schema[key].dataType

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in slices(batches, "ids"):
            texts = [decode_ids(np.frombuffer(b or b"", "<u4"), vocab) for b in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["key", "text"])

    chosen = encoded.select(F.col(key).alias("key"), F.col(ids).alias("ids"))
    return chosen.mapInArrow(task, f"key {kind.simpleString()}, text string").withColumnRenamed("key", key)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256 and decoded_sha256."""
    return encode(docs, path, decoded=True).select(
        "doc_id",
        F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
