"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page is cut into its leaf blocks: runs of text that no block element
interrupts, each with its chain of open elements.  Every block is described by
its ancestors' tags, their class and id words, and the shape of its text.  The
field scores the labels (main or other) of all blocks and of neighbouring
pairs; it is fitted to labelled pages by maximum likelihood and decoded by
Viterbi.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import slices
from .labelled_pages import MAIN, labelled_pages

#: Labelled pages the field is fitted to, and the seed they are made from.
TRAINING_PAGES = 500
TRAINING_SEED = 20
STEPS = 120
#: Weights are kept in so many hashed places for each label.
PLACES = 1 << 12

# Element groups of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike"
    " strong sub sup time tt u var".split())
UNSEEN = frozenset("head script style noscript template iframe object svg math select option textarea".split())
RAW = frozenset("script style textarea title iframe noscript".split())
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
CLOSES_PARAGRAPH = frozenset(
    "address article aside blockquote details dialog dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hr li main menu nav ol p pre section table ul".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")


@dataclass(frozen=True, slots=True)
class Element:
    """An open element: the places of its own and all ancestors' features as bits of a number, and the last two block tags."""

    tag: str
    bits: int
    last: tuple[str, ...]

    def within(self, tag: str, names: tuple[str, ...]) -> Element:
        if tag in INLINE:
            return Element(tag, self.bits, self.last)
        bits = self.bits
        for feature in (tag, *names):
            bits |= 1 << _place("in " + feature)
        return Element(tag, bits, (*self.last, tag)[-2:])


class _Open:
    """The open elements, and where those of a tag, and those that are no inline elements, stand among them."""

    def __init__(self):
        self.stack = [Element("", 0, ())]
        self.at: dict[str, list[int]] = {}
        self.block_at: list[int] = []
        self.hidden = 0

    def last(self, tag: str) -> int | None:
        places = self.at.get(tag)
        return places[-1] if places else None

    def push(self, tag: str, names: tuple[str, ...]) -> None:
        self.at.setdefault(tag, []).append(len(self.stack))
        if tag not in INLINE:
            self.block_at.append(len(self.stack))
        self.hidden += tag in UNSEEN
        self.stack.append(self.stack[-1].within(tag, names))

    def close(self, index: int) -> None:
        """Close the element at ``index`` and all within it."""
        while len(self.stack) > index:
            tag = self.stack.pop().tag
            self.at[tag].pop()
            if tag not in INLINE:
                self.block_at.pop()
            self.hidden -= tag in UNSEEN


def leaf_blocks(html: str) -> list[tuple[str, Element, bool]]:
    """Text, innermost open element and "all of it is link text" of each leaf block with text; in time linear in the page."""
    blocks: list[tuple[str, Element, bool]] = []
    opened = _Open()
    pieces: list[str] = []
    linked = [0, 0]

    def end_block() -> None:
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                blocks.append((text, opened.stack[-1], linked[1] == 0 and linked[0] > 0))
            pieces.clear()
            linked[0] = linked[1] = 0

    def leave_head() -> None:
        """A page may leave out </head>: what cannot stand in a head ends it."""
        if opened.stack[-1].tag == "head":
            opened.close(len(opened.stack) - 1)

    def add(raw: str) -> None:
        if raw.strip():
            leave_head()
        if raw and not opened.hidden:
            pieces.append(unescape(raw))
            if raw.strip():
                linked[0 if opened.at.get("a") else 1] += 1

    at, end = 0, len(html)
    while at < end:
        match = _TOKEN.search(html, at)
        if match is None:
            add(html[at:])
            break
        if match.start() > at:
            add(html[at : match.start()])
        at = match.end()
        tag = (match[2] or "").lower()
        if not tag:
            if match[0] == "</":  # at the very end of a page
                add(match[0])
            continue
        if not match[4] and not match[0].endswith(">"):
            break  # a tag that the page's end cuts off
        if match[1]:
            index = opened.last(tag)
            if tag not in INLINE:
                end_block()
                if index is not None:
                    opened.close(index)
            elif index is not None and not (opened.block_at and opened.block_at[-1] > index):
                opened.close(index)
            continue
        if tag not in IN_HEAD:
            leave_head()
        if tag == "br":
            pieces.append(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                end_block()
            continue
        if tag not in INLINE:
            end_block()
            if tag in CLOSES_PARAGRAPH and opened.block_at:
                index = opened.block_at[-1]
                if opened.stack[index].tag == "p" or tag == "li" and opened.stack[index].tag == "li":
                    opened.close(index)
        names = tuple(
            "." + word for found in _NAMES.findall(match[3]) for word in _WORD.findall("".join(found).lower())) if match[3] else ()
        if match[3].endswith("/"):
            continue
        opened.push(tag, names)
        if tag in RAW:
            stop = re.compile(rf"</{tag}\b", re.I).search(html, at)
            if tag not in UNSEEN:
                add(html[at : stop.start() if stop else end])
            at = stop.start() if stop else end
    end_block()
    return blocks


def _place(feature: str) -> int:
    value = 0
    for byte in feature.encode():
        value = (value * 1_000_003 + byte) % 2_147_483_647
    return value % PLACES


_place = lru_cache(maxsize=1 << 16)(_place)


@lru_cache(maxsize=1 << 10)
def _element_places(bits: int, last: tuple[str, ...]) -> tuple[int, ...]:
    for i, tag in enumerate(reversed(last)):
        bits |= 1 << _place(f"last{i} {tag}")
    octets = np.frombuffer(bits.to_bytes(PLACES // 8, "little"), np.uint8)
    return tuple(np.flatnonzero(np.unpackbits(octets, bitorder="little")).tolist())


def _shape_places(text: str, linked: bool) -> tuple[int, ...]:
    words = text.count(" ") + 1
    return (
        _place("always"), _place(f"words {min(words.bit_length(), 8)}"), _place(f"ends {text[-1] in '.!?'}"),
        _place(f"linked {linked}"), _place(f"copyright {'©' in text}"), _place(f"capital {text[0].isupper()}"),
    )


def block_places(blocks: list[tuple[str, Element, bool]]) -> Iterator[tuple[int, ...]]:
    for text, element, linked in blocks:
        yield _element_places(element.bits, element.last) + _shape_places(text, linked)


class Field:
    """Weights of a two-label linear chain: ``state[place, label]`` and ``move[before, label]``."""

    def __init__(self, state: np.ndarray, move: np.ndarray):
        self.state, self.move = state, move
        self.margin = (state[:, 1] - state[:, 0]).tolist()

    def decode(self, places: Iterable[tuple[int, ...]]) -> list[int]:
        """The best labels by Viterbi; label 0 scores zero on its own, label 1 the margin."""
        margin, (m00, m01), (m10, m11) = self.margin, *self.move.tolist()
        zero = one = 0.0
        back, some = [], False
        for i, chosen in enumerate(places):
            gain = sum(margin[p] for p in chosen)
            if i == 0:
                zero, one, some = 0.0, gain, True
                continue
            from_zero, from_one = one + m10 <= zero + m00, one + m11 > zero + m01
            back.append((0 if from_zero else 1, 1 if from_one else 0))
            zero, one = max(zero + m00, one + m10), max(zero + m01, one + m11) + gain
        label = int(one > zero)
        labels = [label]
        for before in reversed(back):
            label = before[label]
            labels.append(label)
        return labels[::-1] if some else []


def _log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(a - top).sum(axis=axis))


def fit(pages: list[tuple[str, list[int]]], steps: int = STEPS, rate: float = 0.3, penalty: float = 1e-3) -> Field:
    """Maximum likelihood by gradient steps with per-weight rates; forward-backward over all pages at once."""
    sequences = [(list(block_places(leaf_blocks(html))), labels) for html, labels in pages]
    sequences = [(places, labels) for places, labels in sequences if places and len(places) == len(labels)]
    n, longest = len(sequences), max(len(labels) for _, labels in sequences)
    length = np.array([len(labels) for _, labels in sequences])
    inside = np.arange(longest) < length[:, None]
    truth = np.zeros((n, longest), np.int64)
    rows, columns = [], []
    for i, (places, labels) in enumerate(sequences):
        truth[i, : len(labels)] = labels
        for j, chosen in enumerate(places):
            rows += [i * longest + j] * len(chosen)
            columns += chosen
    rows, columns = np.array(rows), np.array(columns)
    state, move = np.zeros((PLACES, 2)), np.zeros((2, 2))
    seen_state, seen_move = np.full_like(state, 1e-6), np.full_like(move, 1e-6)
    gold = np.eye(2)[truth] * inside[..., None]
    pair_inside = inside[:, 1:]
    gold_move = np.zeros((2, 2))
    np.add.at(gold_move, (truth[:, :-1][pair_inside], truth[:, 1:][pair_inside]), 1)
    for _ in range(steps):
        scores = np.stack([np.bincount(rows, state[columns, k], n * longest).reshape(n, longest) for k in (0, 1)], -1)
        forward = np.empty_like(scores)
        backward = np.zeros_like(scores)
        forward[:, 0] = scores[:, 0]
        for t in range(1, longest):
            following = scores[:, t] + _log_sum(forward[:, t - 1, :, None] + move, 1)
            forward[:, t] = np.where(inside[:, t, None], following, forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            leading = _log_sum(move + (scores[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(inside[:, t + 1, None], leading, 0.0)
        norm = _log_sum(forward[np.arange(n), length - 1], 1)
        marginal = np.exp(forward + backward - norm[:, None, None]) * inside[..., None]
        joint = np.exp(
            forward[:, :-1, :, None] + move + (scores[:, 1:] + backward[:, 1:])[:, :, None, :] - norm[:, None, None, None])
        change = (gold - marginal).reshape(n * longest, 2)
        for weights, seen, slope in (
            (state, seen_state, np.stack([np.bincount(columns, change[rows, k], PLACES) for k in (0, 1)], -1) / n - penalty * state),
            (move, seen_move, (gold_move - (joint * pair_inside[..., None, None]).sum((0, 1))) / n - penalty * move),
        ):
            seen += slope**2
            weights += rate * slope / np.sqrt(seen)
    return Field(state, move)


@lru_cache(maxsize=1)
def trained_field() -> Field:
    return fit(labelled_pages(TRAINING_PAGES, TRAINING_SEED))


def main_text(html: str | None, field: Field) -> str:
    blocks = leaf_blocks(html or "")
    labels = field.decode(block_places(blocks))
    return "\n".join(text for (text, _, _), label in zip(blocks, labels) if label == MAIN)


def extract(pages: DataFrame, key: str = "page_id", html: str = "html", url: str = "url") -> DataFrame:
    """``key``, ``url``, ``text`` and n_chars (its code points) for every row.

    The field is fitted once, on the driver, to a fixed number of labelled
    pages; its weights, of fixed size, go to the tasks.  Null or empty html, or
    a page without main text, gives the empty text.  Rows are independent:
    repeated rows, null keys and null urls come back as they are.  Pages of any
    size and depth are taken whole, in time about linear in their length.  Other
    columns are not read; an empty table gives an empty one.
    """
    kind = pages.schema[key].dataType.simpleString()
    field = trained_field()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [main_text(h, field) for h in batch.column("text").to_pylist()]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "url", "text", "n_chars"])

    chosen = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(html).alias("text"))
    named = chosen.mapInArrow(task, f"key {kind}, url string, text string, n_chars bigint")
    return named.toDF(key, url, "text", "n_chars")
