"""Ranked search against scoring every document for every item."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from larder.llm import ranking

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(items, rows, best=10):
    documents = [(d, Counter(plain_terms(t))) for d, t in rows]
    documents = [(d, c) for d, c in documents if c]
    total = sum(c.total() for _, c in documents)
    holding = Counter(t for _, c in documents for t in c)
    found = defaultdict(list)
    for number, (item, text) in enumerate(items):
        scores = []
        for d, c in documents:
            m = 10 + 90 * c.total() * len(documents) // total
            score = 0
            for t in set(plain_terms(text)):
                if t in c:
                    score += math.floor(1000 * math.log((2 * len(documents) + 2) / (2 * holding[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        for rank, (score, _, _, d) in enumerate(sorted(scores, key=lambda s: s[:3])[:best], 1):
            found[number].append((item, rank, d, -score))
    return sorted((r for rows in found.values() for r in rows), key=str)


def texts(rng, count, words):
    return [" ".join(rng.choice(words) for _ in range(rng.randint(1, 60))) for _ in range(count)]


@pytest.fixture(scope="module")
def many(spark):
    rng = random.Random(3)
    words = ["".join(rng.choices("etaoin", k=rng.randint(1, 4))) for _ in range(400)] + ["Über", "x1", "日本"]
    rows = [(i, t) for i, t in enumerate(texts(rng, 900, words))]
    rows += [(2_000 + i, rows[5][1]) for i in range(60)] + [(7, rows[7][1])] * 3 + [(None, rows[8][1])] * 2 + [(990, None), (991, ""), (992, "...")]
    items = [(i, t) for i, t in enumerate(texts(rng, 40, words))] + [(100, rows[5][1]), (100, rows[5][1]), (101, None), (102, "never-seen"), (None, rows[8][1].upper())]
    return items, rows


@pytest.mark.parametrize("sizes", [{}, {"block_items": 16}])
def test_search_equals_scoring_all(spark, many, sizes):
    items, rows = many
    docs = spark.createDataFrame([(*r, "k", 5) for r in rows], "doc_id long, text string, item string, n int").repartition(6)
    asked = spark.createDataFrame([(*i, 1) for i in items], "item_id int, text string, doc_id int")
    got = [tuple(r) for r in ranking.search(asked, docs, **sizes).collect()]
    assert sorted(got, key=str) == brute(items, rows)


def test_awkward_documents(spark, docs, doc_rows, no_docs):
    items = [(1, doc_rows[3][1]), (2, "endoftext é中 one two"), (3, None)]
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert sorted(map(tuple, ranking.search(asked, docs).collect()), key=str) == brute(items, [(d, t) for d, t, _ in doc_rows])
    assert ranking.search(asked, no_docs).count() == 0
    assert ranking.search(asked.limit(0), docs).count() == 0


@pytest.mark.parametrize("kind", [np.float64, np.int64])
def test_pruning_keeps_every_best_document(monkeypatch, kind):
    """One task's search against all products, with starting scores and in several additions."""
    monkeypatch.setattr(ranking.Block, "kind", lambda self: kind)
    monkeypatch.setattr(ranking, "DOCUMENTS", 128)
    rng = np.random.default_rng(4)
    wide, n_items, n_docs = 50, 45, 700
    weights = rng.integers(1, 9_000, wide)
    places = [np.sort(rng.choice(wide, rng.integers(0, 9), replace=False)) for _ in range(n_items)]
    gains = rng.integers(1, 9, (n_docs, wide)) * (rng.random((n_docs, wide)) < 0.1)
    block = ranking.Block(list(range(n_items)), places, weights, np.arange(n_items))
    block = ranking.replace(block, order=ranking._similar_order(block.dense()))
    assert sorted(block.order.tolist()) == list(range(n_items))
    scores = np.array([[(weights[p] * g[p]).sum() for g in gains] for p in places])
    least = np.sort(scores, axis=1)[:, -10]
    for start in (np.zeros(n_items, np.int64), least):
        search = ranking.Search(block, start, 10)
        visited = []
        keep = search._keep
        monkeypatch.setattr(search, "_keep", lambda *a: (visited.append(len(a[1])), keep(*a)))
        for low in range(0, n_docs, 300):
            part = gains[low : low + 300]
            rows, cols = np.nonzero(part)
            ids = np.arange(low, low + len(part))
            search.add(ids, np.zeros(len(part), bool), np.count_nonzero(part, axis=1), cols, part[rows, cols])
        numbers, ids, _, found = search.results()
        for item in range(n_items):
            expected = sorted(((-s, d) for d, s in enumerate(scores[item]) if s > 0))[:10]
            assert sorted((-s, d) for s, d in zip(found[numbers == item], ids[numbers == item])) == expected
    assert sum(visited) < n_items * 30


def test_terms_equal_the_pattern():
    text = "".join(map(chr, range(256))) + " Größe_42x İ ſ 日本\x7f~a"
    assert [t.decode() for t in ranking.terms(text)] == plain_terms(text)
