"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from larder.llm import spelling


def brute_words(rows, misspelt=31):
    counts = Counter()
    for d, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if misspelt and h % misspelt == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(counts, ratio=10):
    near = {w: [v for v in counts if is_near(w, v)] for w in counts}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None
    rows = set()
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return rows


def test_variants_equal_all_pairs(spark, docs, doc_rows, no_docs):
    assert {tuple(r) for r in spelling.variants(docs).collect()} == brute_variants(brute_words(doc_rows))
    assert spelling.variants(no_docs).count() == 0


@pytest.mark.parametrize("round_bits", [spelling.ROUND_BITS, 64 * 40])
def test_rounds_and_parts_change_nothing(spark, round_bits):
    rng = random.Random(9)
    stems = ["".join(rng.choices("abcé", k=rng.randint(7, 10))) for _ in range(60)]
    stems += ["y" * 64, "y" * 63, "y" * 65, "z" * 300, "z" * 150 + "a" + "z" * 149, "z" * 301, "aaaabbbb", "aaabbbb"]
    rows = []
    for i in range(400):
        words = []
        for _ in range(12):
            w = rng.choice(stems[: 1 + rng.randrange(len(stems))])
            at = rng.randrange(len(w))
            w = rng.choice([w] * 6 + [w[:at] + w[at + 1 :], w[:at] + "a" + w[at:], w[:at] + "É" + w[at + 1 :]])
            words.append(w)
        rows.append((i if i % 9 else None, " ".join(words), "k", 3))
    rows += [(900 + i, "y" * 64 + " " + "z" * 300 + " " + "z" * 150 + "a" + "z" * 149) for i in range(3)]
    rows += [(950 + i, " ".join(["chainyy"] * 3 + ["chainxy"] * (i < 12) + ["chainxx"] * (i < 4))) for i in range(20)]
    rows = [(*r, "k", 3)[:4] for r in rows]
    frame = spark.createDataFrame(rows, "doc_id long, text string, word string, n int").repartition(3)
    counts = brute_words(rows)
    assert {tuple(r) for r in spelling.variants(frame, round_bits=round_bits).collect()} == brute_variants(counts)
    chains = [r for r in brute_variants(counts, 2) if r[1] and r[1] != r[2]]
    assert chains and {tuple(r) for r in spelling.variants(frame, ratio=2, round_bits=round_bits).collect()} == brute_variants(counts, 2)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abÿ", min_size=7, max_size=9), min_size=1, max_size=6))
def test_hashes_of_edits_are_those_of_the_words(words):
    letters = np.array(sorted(map(ord, "abÿ")), np.uint32)
    for members, points in spelling._by_length(words):
        for kind, letter, rows, places, hashes in spelling.edits(points, letters):
            for r, at, h in zip(rows.tolist(), places.tolist(), hashes):
                w = words[members[r]]
                edit = w[:at] + (chr(letter) if kind else "") + w[at + 1 :]
                assert spelling.word_hashes(np.array([list(map(ord, edit))], np.uint32))[0] == h


def test_a_ratio_that_leads_nowhere_is_refused(docs):
    with pytest.raises(ValueError):
        spelling.variants(docs, ratio=1)
