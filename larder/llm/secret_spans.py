"""Secrets in texts: named patterns, and candidate strings whose windows are too random for their characters.

Candidate strings are runs of the characters that keys are written in.  Within
a candidate, each character class (hexadecimal digits; letters and digits)
has runs of its own, over which a window slides.  The Shannon entropy of the
window follows from its character counts, which change by one character in and
one out at each step.  Windows above the entropy of their class that mix the
kinds of characters a key mixes are hot; overlapping hot windows make one span.
Allow-listed strings (identifiers, digests of content, links, alphabets,
samples) are not reported.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import slices

# The named patterns, and how long what they find must be at least.
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_LEAST, ACCESS_LEAST = 8, 16
KINDS = ("assign", "access", "hex", "random_hex", "random_key")

#: Runs in which random strings are looked for.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")


@dataclass(frozen=True)
class CharacterClass:
    """Runs of ``run``; a window is hot from ``entropy`` bits a character if it has each of the ``mixed`` kinds."""

    kind: str
    run: re.Pattern
    window: int
    entropy: float
    mixed: tuple[str, ...]


DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
CLASSES = (
    CharacterClass("random_hex", re.compile(r"[0-9A-Fa-f]{20,}"), 20, 3.0, (DIGITS, "abcdefABCDEF")),
    CharacterClass("random_key", re.compile(r"[A-Za-z0-9+/_=-]{20,}"), 20, 3.75, (DIGITS, LOWER, UPPER)),
)

#: What is random and no secret: the parts of a text that these patterns match are not reported.
ALLOWED = (
    r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}",  # universally unique identifiers
    r"(?i:sha(?:1|224|256|384|512)|md5|blake2[bs]|etag|digest|checksum|fingerprint|commit)[\"']?[-:=\x20]{1,3}[\"']?[A-Za-z0-9+/=_-]+",
    r"(?<![a-z0-9+.-])[a-z][a-z0-9+.-]*://[^\s\"'<>]+",  # links
    r"(?<![a-z])data:[a-z]+/[a-z0-9.+-]+;base64,[A-Za-z0-9+/=]+",  # embedded media
)
#: Candidates that hold one of these words, in either case, are samples.
SAMPLES = re.compile(r"(?ai)example|sample|placeholder|changeme|dummy")
#: Windows that step through one of these are alphabets, not keys.
ALPHABETS = (UPPER + LOWER + DIGITS + "+/", DIGITS + LOWER + UPPER, DIGITS + UPPER + LOWER, LOWER + UPPER + DIGITS, DIGITS + "abcdef" + DIGITS + "ABCDEF")

Span = tuple[int, int, int]


def base_spans(text: str) -> list[Span]:
    """(start, kind number, end) of the named patterns; leftmost, not overlapping within a kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_LEAST]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


_TERMS = [0.0] + [c * math.log2(c) for c in range(1, 257)]


def hot_windows(run: str, window: int, entropy: float, mixed: Sequence[str]) -> list[tuple[int, int]]:
    """Unions of the windows of ``run`` that are hot, by counts that change as the window slides.

    Entropy is log2(window) - sum(c * log2(c)) / window over the counts c.
    """
    if len(run) < window:
        return []
    most = (math.log2(window) - entropy) * window + 1e-9
    kind_of = {c: i for i, kind in enumerate(mixed) for c in kind}
    counts: dict[str, int] = {}
    kinds = [0] * (len(mixed) + 1)
    total, found = 0.0, []
    for at, char in enumerate(run):
        n = counts.get(char, 0)
        counts[char] = n + 1
        total += _TERMS[n + 1] - _TERMS[n]
        kinds[kind_of.get(char, -1)] += 1
        if at >= window:
            gone = run[at - window]
            n = counts[gone]
            counts[gone] = n - 1
            total += _TERMS[n - 1] - _TERMS[n]
            kinds[kind_of.get(gone, -1)] -= 1
        start = at - window + 1
        if start >= 0 and total <= most and all(kinds[:-1]) and not any(run[start : at + 1] in a for a in ALPHABETS):
            if found and start <= found[-1][1]:
                found[-1][1] = at + 1
            else:
                found.append([start, at + 1])
    return [(a, b) for a, b in found]


class _Cover:
    """Parts of a text, to be asked whether one of them overlaps a span."""

    def __init__(self, parts: Iterable[tuple[int, int]]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for a, b in sorted(parts):
            if self.ends and a < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def overlaps(self, start: int, end: int) -> bool:
        at = bisect_left(self.starts, end) - 1
        return at >= 0 and self.ends[at] > start


def random_spans(text: str, base: Sequence[Span] = (), classes: Sequence[CharacterClass] = CLASSES, allowed: Sequence[str] = ALLOWED) -> list[Span]:
    """(start, kind number, end) of the hot parts of candidates that touch no base span, no allow-listed part and no earlier class."""
    hot: list[Span] = []
    for candidate in CANDIDATE.finditer(text):
        own: list[Span] = []
        for number, kind in enumerate(classes, len(KINDS) - len(classes)):
            for run in kind.run.finditer(text, candidate.start(), candidate.end()):
                first = run.start()
                own += [(first + a, number, first + b) for a, b in hot_windows(run.group(), kind.window, kind.entropy, kind.mixed)]
        if own and not SAMPLES.search(candidate.group()):
            hot += own
    if not hot:
        return []
    known = _Cover([*((a, b) for a, _, b in base), *(m.span() for p in allowed for m in re.finditer(p, text))])
    found: list[Span] = []
    for number in sorted({k for _, k, _ in hot}):
        earlier = _Cover((a, b) for a, _, b in found)
        found += [(a, k, b) for a, k, b in hot if k == number and not known.overlaps(a, b) and not earlier.overlaps(a, b)]
    return found


def joined(spans: Sequence[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", classes: Sequence[CharacterClass] = CLASSES, allowed: Sequence[str] = ALLOWED) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    Positions are code points, ends exclusive; spans are ordered by start, then
    by kind in the order of ``KINDS``.  Random strings that touch a named
    pattern are part of it and not reported again.  Null text counts as empty;
    rows are scanned one by one, so repeated rows and null ids come back as
    they are.  A text of any length is scanned whole, in time about linear in
    its length.  Other columns are not read; an empty table gives an empty one.
    """
    kind = docs.schema[key].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for value in batch.column("text").to_pylist():
                base = base_spans(value or "")
                more = random_spans(value or "", base, classes, allowed)
                numbers = [k for _, k, _ in base]
                rows.append((numbers.count(0), numbers.count(1), numbers.count(2), hashlib.sha256(joined(base).encode()).hexdigest(), joined([*base, *more])))
            columns = [pa.array(c) for c in zip(*rows)]
            types = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([batch.column(0), *(c.cast(t) for c, t in zip(columns, types))], ["key", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    chosen = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = f"key {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    return chosen.mapInArrow(task, schema).withColumnRenamed("key", key)
