"""Secret scans against brute force: every window counted anew, every pattern matched plainly."""

import hashlib
import math
import random
import re
import string
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from larder.llm import secret_spans as secrets

KEY = "q7Rk2Zp9LmX4vB8nT1sWc6Yd"


def brute_base(text):
    found = []
    for m in re.finditer(r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m.group(1)) >= 8:
            found.append((m.start(), 0, m.end()))
    for kind, pattern, least in ((1, "AKIA[A-Z0-9]+", 16), (2, "[0-9a-f]+", 32)):
        found += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if len(m.group()) >= least]
    return sorted(found)


def brute_hot(run, window, entropy, mixed):
    marked = [False] * len(run)
    for start in range(len(run) - window + 1):
        part = run[start : start + window]
        bits = -sum(n / window * math.log2(n / window) for n in Counter(part).values())
        if bits >= entropy - 1e-9 and all(set(part) & set(m) for m in mixed) and not any(part in a for a in secrets.ALPHABETS):
            marked[start : start + window] = [True] * window
    return marked


@settings(max_examples=150, deadline=None)
@given(st.text("abcdef0123456789", max_size=60) | st.text(string.ascii_letters + string.digits + "+/=", max_size=80) | st.text("aAbB1", max_size=50))
def test_sliding_counts_equal_counting_each_window_anew(run):
    for kind in secrets.CLASSES:
        spans = secrets.hot_windows(run, kind.window, kind.entropy, kind.mixed)
        marked = [False] * len(run)
        for a, b in spans:
            marked[a:b] = [True] * (b - a)
        assert marked == brute_hot(run, kind.window, kind.entropy, kind.mixed)
        assert all(b < c for (_, b), (c, _) in zip(spans, spans[1:]))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["password", "Secret", "api_key", "APIKEY", "token", "ſecret", "=", ": ", "'", '"', " ", "AKIA", "ABCD1234EFGH", "deadbeef", "0" * 30, "ab", "é", "\n"]), max_size=14).map("".join))
def test_named_patterns_equal_plain_matching(text):
    assert secrets.base_spans(text) == brute_base(text)


@pytest.mark.parametrize(
    "text, spans",
    [
        ("key " + KEY + " end", f"random_key:4:{4 + len(KEY)}"),
        ("id 9F8E7D6C5B4A39281706AB13 end", "random_hex:3:27"),
        ("id 123e4567-e89b-12d3-a456-426614174000", ""),
        (f"see https://host.example.org/{KEY}?q=1", ""),
        (f"integrity='sha384-{KEY}{KEY}'", ""),
        (f"<img src='data:image/png;base64,{KEY}{KEY}'>", ""),
        (f"{KEY}EXAMPLE", ""),
        (string.ascii_uppercase + string.ascii_lowercase + string.digits, ""),
        ("Donaudampfschifffahrtsgesellschaftskapitaen 12345678901234567890123", ""),
        ("secret: token: abcdefghij", ""),
        ('passwd = "hunter2hunter2"', "assign:0:24"),
        (f"é{KEY} token={KEY}", f"random_key:1:{1 + len(KEY)},assign:{2 + len(KEY)}:{8 + 2 * len(KEY)}"),
    ],
)
def test_spans(text, spans):
    assert secrets.joined([*secrets.base_spans(text), *secrets.random_spans(text, secrets.base_spans(text))]) == spans


def test_random_keys_are_found_and_prose_is_not():
    rng = random.Random(5)
    keys = ["".join(rng.choices(string.ascii_letters + string.digits, k=rng.randint(32, 64))) for _ in range(500)]
    found = sum(bool(secrets.random_spans(f"x {k} y")) for k in keys)
    assert found >= 490
    prose = " ".join("".join(rng.choices("etaoinshrdlu", k=rng.randint(1, 40))) for _ in range(5_000))
    assert secrets.random_spans(prose) == []


def test_rows_of_all_kinds(spark, docs, doc_rows, no_docs):
    got = Counter(map(tuple, secrets.scan(docs).collect()))
    expected = Counter()
    for d, text, _ in doc_rows:
        base = brute_base(text or "")
        said = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in base)
        spans = secrets.joined([*base, *secrets.random_spans(text or "", base)])
        expected[d, *(sum(k == i for _, k, _ in base) for i in range(3)), hashlib.sha256(said.encode()).hexdigest(), spans] += 1
    assert got == expected
    assert secrets.scan(no_docs).count() == 0
    clash = spark.createDataFrame([(1, f"token={KEY}", "a", "b", "c"), (None, None, "a", "b", "c")], "doc_id long, text string, key string, spans string, n_hex string")
    assert {r.doc_id: r.spans for r in secrets.scan(clash).collect()} == {1: f"assign:0:{6 + len(KEY)}", None: ""}


def test_long_candidates_take_linear_time():
    text = "x" * 400_000 + " " + KEY * 4_000 + " " + f"token={KEY} " * 5_000
    base = secrets.base_spans(text)
    more = secrets.random_spans(text, base)
    assert len(base) == 5_000
    assert more == [(400_001, 4, 400_001 + len(KEY) * 4_000)]
