"""Operators on documents against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from larder.llm import bpe, chunks, exact, mixing, quality, sharding, simhash
from larder.llm.components import components
from larder.llm.registry import tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_exact_classes(docs, doc_rows, no_docs):
    got = sorted(map(tuple, exact.classes(docs).collect()), key=str)
    groups = {}
    for d, t, _ in doc_rows:
        groups.setdefault(t or "", []).append(d)
    expected = []
    for t, ids in groups.items():
        keep = max((d for d in ids if d is not None), default=None)
        sha = hashlib.sha256(t.encode()).hexdigest()
        expected += [(d, keep, len(ids), d == keep, sha) for d in ids]
    assert got == sorted(expected, key=str)
    assert exact.classes(no_docs).count() == 0


def test_equal_fingerprints_of_different_texts_are_told_apart(docs, doc_rows, monkeypatch):
    """With a fingerprint that says nothing, the comparison alone must separate texts of one length."""
    def blind(frame, key="doc_id", text="text"):
        rows = exact._rows(frame, key, text)
        return rows.selectExpr("doc_id", "text_sha256", "n_bytes", "0L AS h1", "0L AS h2")

    few = docs.where("doc_id < 12 OR doc_id BETWEEN 110 AND 112").selectExpr("doc_id", "substring(text, 1, 20) AS text")
    expected = sorted(map(tuple, exact.classes(few).collect()), key=str)
    monkeypatch.setattr(exact, "fingerprints", blind)
    assert sorted(map(tuple, exact.classes(few).collect()), key=str) == expected


@settings(max_examples=30, deadline=None)
@given(st.binary(max_size=300), st.integers(0, 300))
def test_hashes_of_parts_combine_to_the_hash_of_the_whole(data, cut):
    a, b = data[:cut], data[cut:]
    for base in exact.BASES:
        whole = sum((byte + 1) * pow(base, i, exact.PRIME) for i, byte in enumerate(data)) % exact.PRIME
        parts = exact.shifted(exact.piece_hashes([a, b], base), np.array([0, len(a)]), base)
        assert int(parts.sum() % exact.PRIME) == whole


def test_pieces_of_long_texts(spark):
    rows = [(1, "ab" * exact.PIECE), (2, "ab" * exact.PIECE), (3, "ab" * exact.PIECE + "c"), (4, "é" * exact.PIECE)]
    found = {r.doc_id: (r.n_bytes, r.h1, r.h2) for r in exact.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {d: exact.fingerprint(t.encode()) for d, t in rows}


def brute_fingerprint(text):
    found = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not found:
        return 0
    shingles = [" ".join(found[i : i + 4]) for i in range(max(1, len(found) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values, budget):
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if bin(values[i] ^ values[j]).count("1") <= budget:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(values))]


def test_simhash_groups(docs, doc_rows, no_docs):
    prints = [brute_fingerprint(t) for _, t, _ in doc_rows]
    roots = brute_components(prints, 4)
    least = {}
    for (d, _, _), r in zip(doc_rows, roots):
        least[r] = min((x for x in (least.get(r), d) if x is not None), default=None)
    expected = sorted(((d, f"{p:016x}", least[r]) for (d, _, _), p, r in zip(doc_rows, prints, roots)), key=str)
    assert sorted(map(tuple, simhash.groups(docs).collect()), key=str) == expected
    assert simhash.groups(no_docs).count() == 0


@pytest.mark.parametrize("crowded", [False, True])
def test_trie_join_finds_all_links(crowded):
    rng = np.random.default_rng(7)
    values = rng.integers(0, 1 << 64, 300, dtype=np.uint64)
    if crowded:  # a ball of near copies around one value
        values[:200] = values[0] ^ (np.uint64(1) << rng.integers(0, 64, 200).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 200).astype(np.uint64))
    values[200:240] = values[240:280] ^ np.uint64(0b1011)
    values = np.unique(values)
    x, y = simhash.close_links(values, None, 0, 4)
    assert all(bin(int(a ^ b)).count("1") <= 64 for a, b in zip(x, y)) and len(x) < len(values)
    links = {(int(a), int(b)) for a, b in zip(x, y)}
    position = {int(v): i for i, v in enumerate(values)}
    root = list(range(len(values)))
    for a, b in links:
        i, j = position[a], position[b]
        root = [min(root[i], root[j]) if r in (root[i], root[j]) else r for r in root]
    expected = brute_components([int(v) for v in values], 4)
    assert [root.index(r) for r in root] == [expected.index(r) for r in expected]
    half = values < values[len(values) // 2]
    a, b = simhash.close_links(values[half], values[~half], 0, 4)
    joined = brute_components([int(v) for v in values], 4)
    assert all(joined[position[int(i)]] == joined[position[int(j)]] for i, j in zip(a, b))


def test_near_links_in_several_blocks(spark):
    rng = np.random.default_rng(3)
    values = np.unique(np.concatenate([rng.integers(0, 1 << 64, 400, dtype=np.uint64), np.arange(100, dtype=np.uint64) << np.uint64(3)]))
    frame = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "bits long")
    roots = {r.node: r.root for r in components(simhash.near_links(frame, node=16)).collect()}
    expected = brute_components([int(v) for v in values], 4)
    signed = values.view(np.int64).tolist()
    for i, v in enumerate(signed):
        assert (roots.get(v, v) == roots.get(signed[expected[i]], signed[expected[i]]))
    assert len({roots.get(v, v) for v in signed}) == len(set(expected))


def test_components_of_a_long_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101 + i) for i in range(50)] + [(7, 7), (3, 2)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "x long, y long")).collect()}
    assert found == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(51)}


def brute_base(text):
    found, lines, seen = WORD.findall(text or ""), (text or "").split("\n"), set()
    repeated = 0
    for line in lines:
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    windows = Counter(zip(found, found[1:], found[2:]))
    covered = {j for i, w in enumerate(zip(found, found[1:], found[2:])) if windows[w] > 1 for j in (i, i + 1, i + 2)}
    failed = len(found) < 50 or 100 * len(covered) > 50 * len(found)
    return len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text or ""), repeated, len(covered), failed


def test_quality_rules(docs, doc_rows, no_docs):
    rules = quality.Rules(docs)
    got = rules.verdicts().collect()
    expected = Counter((d, *brute_base(t)) for d, t, _ in doc_rows)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == expected
    assert all(not (r.kept and r.base_failed) for r in got)
    assert sum(r.kept for r in got) > 30
    kept = quality.keep(docs)
    assert kept.schema == docs.schema
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in got if r.kept)
    assert quality.judge(no_docs).count() == 0


@pytest.mark.parametrize("share", [0.5, 0.8])
def test_copies_of_one_text_do_not_move_the_bands(spark, share):
    """One text is half, or 80 percent, of a language's rows; it weighs as much as in one row."""
    rng = random.Random(11)
    texts = [" ".join("".join(rng.choices("etaoinshrdlu", k=rng.randint(1, 8))) for _ in range(rng.randint(60, 120))) for _ in range(40)]
    copies = round(len(texts) * share / (1 - share))
    schema = "doc_id long, text string, lang string"
    once = [(i, t, "en") for i, t in enumerate(texts)]
    plain = quality.judge(spark.createDataFrame(once, schema)).collect()
    hot = quality.judge(spark.createDataFrame(once + [(1000 + i, texts[0], "en") for i in range(copies)], schema).repartition(4)).collect()
    bands = {(round(r.lower_band, 9), round(r.upper_band, 9)) for r in plain}
    assert len(bands) == 1 and {(round(r.lower_band, 9), round(r.upper_band, 9)) for r in hot} == bands
    kept = {r.doc_id: r.kept for r in plain}
    assert {r.doc_id: r.kept for r in hot} == kept | {1000 + i: kept[0] for i in range(copies)}


def test_kneser_ney_probabilities_equal_a_plain_computation(spark):
    """Modified Kneser-Ney of order 5 on short texts, all orders by hand."""
    from larder.llm import ngrams

    texts = ["abracadabra abracadabra", "banana bandana abba", "cadabra banana", "abba abra abab"]
    frame = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string")
    counts = Counter()
    for t in texts:
        padded = "\0" * 4 + t
        counts.update(padded[i : i + 5] for i in range(len(t)))
    assert {r.gram: r.n for r in ngrams.count_grams(ngrams.grams_in(frame)).collect()} == counts
    tables = {5: counts}
    for k in (4, 3, 2, 1):
        tables[k] = Counter(g[1:] for g in tables[k + 1])
    known = {}
    for k in range(1, 6):
        of = Counter(tables[k].values())
        if all(of[c] for c in (1, 2, 3, 4)):
            y = of[1] / (of[1] + 2 * of[2])
            cut = {c: min(c, max(0.0, c - (c + 1) * y * of[c + 1] / of[c])) for c in (1, 2, 3)}
        else:
            cut = {1: 0.5, 2: 1.0, 3: 1.5}
        for g, n in tables[k].items():
            peers = [m for h, m in tables[k].items() if h[:-1] == g[:-1]]
            left = sum(cut[min(m, 3)] for m in peers) / sum(peers)
            lower = known[g[1:]] if k > 1 else 1 / (len(peers) + 1)
            known[g] = (n - cut[min(n, 3)]) / sum(peers) + left * lower
    found, _ = ngrams.probabilities(ngrams.count_grams(ngrams.grams_in(frame)))
    got = {r.gram: r.value for r in found.collect() if r.gram}
    assert got.keys() == known.keys()
    assert all(abs(np.exp(v) - known[g]) < 1e-9 for g, v in got.items())
    table = ngrams.ModelTable(ngrams.count_grams(ngrams.grams_in(frame)))
    assert table.parts == 1
    model = ngrams.Model(*table.part(0))
    assert (np.diff(model.hashes.astype(object)) > 0).all()
    scores = model.score("en", [texts[0], "", "banana", "zzqz"])
    plain = lambda t: sum(np.log(known[("\0" * 4 + t)[i : i + 5]]) for i in range(len(t)))
    assert abs(scores[0] - plain(texts[0])) < 1e-3 and scores[1] == 0
    assert scores[2] / 6 > scores[3] / 4  # unseen text backs off to less
    divided = ngrams.ModelTable(ngrams.count_grams(ngrams.grams_in(frame)), part_entries=20)
    assert divided.parts >= 8
    parts = [ngrams.Model(*divided.part(i)) for i in range(divided.parts)]
    assert max(len(p.hashes) for p in parts) < len(model.hashes) / 2
    assert np.allclose(sum(p.score("en", [texts[0], "", "banana", "zzqz"]) for p in parts), scores)


def test_ngrams_never_counted_are_not_found(spark, docs):
    from larder.llm import ngrams

    named = docs.selectExpr("coalesce(lang, '') AS lang", "coalesce(text, '') AS text")
    model = ngrams.Model(*ngrams.ModelTable(ngrams.count_grams(ngrams.grams_in(named))).part(0))
    rng = random.Random(8)
    unseen = ["".join(rng.choices("QWXYZ0123456789", k=5)) for _ in range(100_000)]
    for kind, lang in (("p", "en"), ("b", "en"), ("p", "b/en")):
        assert not model.find(kind, lang, unseen)[1].any()


def test_parts_of_the_model_change_no_verdict(spark, docs):
    whole = {tuple(r[:-3]): r[-3:] for r in quality.Rules(docs).verdicts().collect()}
    rules = quality.Rules(docs, part_entries=20_000)
    assert rules.model.parts > 1
    for r in rules.verdicts().collect():
        assert np.allclose([v or 0 for v in r[-3:]], [v or 0 for v in whole[tuple(r[:-3])]], rtol=1e-6)


def test_many_characters_are_coded_in_parts():
    from larder.llm import ngrams

    points = np.arange(1, 9_001, dtype="<u4")
    found = Counter()
    for _, code, alphabet in ngrams.codes(points):
        text = ngrams.grams_of(code, alphabet)
        found.update(text[i : i + 5] for i in range(0, len(text), 5))
    assert found == Counter("".join(map(chr, points[i : i + 5])) for i in range(len(points) - 4))


def test_shards(docs, doc_rows, no_docs):
    got = sharding.assign(docs, 6).collect()
    assert Counter(r.doc_id for r in got) == Counter(d for d, _, _ in doc_rows)
    by_shard = {}
    for r in got:
        by_shard.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert sum(r["size"] for r in got) == sum(len((t or "").encode()) + 8 for _, t, _ in doc_rows)
    assert sharding.assign(no_docs, 6).count() == 0


def test_shards_are_even_and_keep_copies_together(spark):
    import zlib

    rows = [(i, f"text {i % 700} " * (1 + i % 13)) for i in range(6000)] + [(10_000 + i, "hot") for i in range(3000)]
    got = sharding.assign(spark.createDataFrame(rows, "doc_id long, text string"), 24).collect()
    text = dict(rows)
    assert all(r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) and r["size"] == len(text[r.doc_id]) + 8 for r in got)
    totals, places = Counter(), {}
    for r in got:
        totals[r.shard] += r["size"]
        places.setdefault(text[r.doc_id], set()).add(r.shard)
    mean = sum(totals.values()) / 24
    assert set(totals) == set(range(24)) and max(abs(t - mean) for t in totals.values()) < 0.05 * mean
    assert all(len(p) == 1 for t, p in places.items() if t != "hot")


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer())


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_no_group_below_the_bound_is_divided(spark, folder):
    docs = spark.read.parquet(f"/root/testdata/{folder}/documents.parquet")
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    got = sharding.assign(docs, 24).collect()
    sizes, places = Counter(), {}
    for r in got:
        sizes[text[r.doc_id]] += r["size"]
        places.setdefault(text[r.doc_id], set()).add(r.shard)
    bound = sharding.group_bound(sum(sizes.values()), 24)
    assert all(len(places[t]) == 1 for t, s in sizes.items() if s <= bound)
    totals = Counter()
    for r in got:
        totals[r.shard] += r["size"]
    assert max(totals.values()) <= sum(sizes.values()) / 24 + max(bound, max(len(t.encode()) + 8 for t in text.values()))


def test_bpe_digests(docs, doc_rows, no_docs):
    expected, lib = Counter(), library()
    for d, t, _ in doc_rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        back = lib.decode(ids, skip_special_tokens=False)
        expected[d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()] += 1
    assert Counter(map(tuple, bpe.digests(docs, tokenizer()).collect())) == expected
    assert bpe.digests(no_docs, tokenizer()).count() == 0
    back = bpe.decode(bpe.encode(docs.where("doc_id >= 0"), tokenizer()), tokenizer())
    assert Counter(map(tuple, back.collect())) == Counter((d, t or "") for d, t, _ in doc_rows if d is not None)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60) | st.text("aab \n\t'sdtl12²\x1c\x85\xa0中é<|>endoftext", max_size=60))
def test_bpe_equals_the_library(text):
    vocab = bpe.vocabulary(tokenizer())
    ids = bpe.encode_texts([text], vocab)[0]
    lib = library_once()
    assert ids.tolist() == lib.encode(text, add_special_tokens=False).ids
    assert bpe.decode_ids(ids, vocab) == text


_library = []


def library_once():
    if not _library:
        _library.append(library())
    return _library[0]


def test_repeated_spans(docs, doc_rows, no_docs):
    got = chunks.repeated_spans(docs).collect()
    texts = {d: t for d, t, _ in doc_rows}
    by_doc = {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        piece = texts[r.doc_id].encode()[r.start : r.start + r.n_bytes]
        assert all(s < r.doc_id for s in r.source_doc_ids)
        assert r.n_words >= chunks.LEAST_WORDS
        if len(r.source_doc_ids) == 1:
            assert piece in texts[r.source_doc_ids[0]].encode()
    for copy in range(110, 116):
        assert sum(r.n_bytes for r in by_doc[copy]) == len(texts[copy])
    assert 130 in by_doc[131][-1].source_doc_ids
    assert not by_doc.keys() & set(range(40)) and 153 not in by_doc
    assert chunks.repeated_spans(no_docs).count() == 0


@settings(max_examples=50, deadline=None)
@given(st.binary(min_size=200, max_size=600), st.binary(max_size=40))
def test_cuts_resist_shifts(data, inserted):
    """After an insertion in front, all cuts further in than the window move with the text."""
    plain = set(chunks.cuts(np.frombuffer(data, np.uint8)).tolist())
    moved = {c - len(inserted) for c in chunks.cuts(np.frombuffer(inserted + data, np.uint8)).tolist()}
    natural = set((np.flatnonzero(chunks.rolling(np.frombuffer(data, np.uint8)) < (1 << 16) // chunks.AVERAGE) + 1).tolist())
    assert {c for c in natural if c > 16} <= moved & plain
    starts, sizes, found, digests = chunks.cut_text(data)
    assert starts[0] == 0 and (starts[1:] == np.cumsum(sizes)[:-1]).all() and sizes.sum() == len(data) and sizes.max() <= chunks.MOST
    assert found.sum() == len(data.split())
    assert len(digests) == len(starts)


def test_mixing(spark, docs, doc_rows, labels, no_docs):
    mixed = mixing.mix(docs, labels)
    got = mixed.collect()
    assert Counter(r.doc_id for r in got) == Counter({d for d, _, _ in doc_rows})
    names = [f"p_{d.name}" for d in mixing.DOMAINS]
    assert all(abs(sum(r[n] for n in names) - 1) < 1e-9 and r.rate >= 0 and abs(r.copies - r.rate) <= 1 for r in got)
    applied = mixing.apply(docs, mixed)
    assert applied.columns == docs.columns
    rows = Counter(d for d, _, _ in doc_rows)
    assert Counter(r.doc_id for r in applied.collect()) == Counter({r.doc_id: r.copies * rows[r.doc_id] for r in got if r.copies})
    assert mixing.mix(no_docs, labels).count() == 0
    assert mixing.mix(docs.limit(5), labels.limit(0)).count() == 5


def test_rates_meet_the_targets_as_least_squares_do(spark):
    rng = np.random.default_rng(1)
    p = rng.dirichlet([0.3, 0.2, 0.2, 0.1], 300)
    tokens = rng.integers(0, 400, 300)
    rows = [(i, int(t), *map(float, row)) for i, (t, row) in enumerate(zip(tokens, p))]
    members = spark.createDataFrame(rows, "doc_id long, tokens long, p0 double, p1 double, p2 double, p3 double")
    total = (tokens[:, None] * p).sum(0)
    for shares in ((0.9, 0.04, 0.05, 0.01), (0.0, 0.0, 0.5, 0.5), (0.25, 0.25, 0.25, 0.25)):
        by_weight = [mixing.Domain(str(i), 0, 0, float(s / t)) for i, (s, t) in enumerate(zip(shares, total))]
        domains = [mixing.Domain(str(i), 0, 0, share=s) for i, s in enumerate(shares)]
        found = mixing.solution(members, domains)
        rate = np.array([r.rate for r in found.rates.orderBy("doc_id").collect()])
        assert np.allclose(rate, [r.rate for r in mixing.solution(members, by_weight).rates.orderBy("doc_id").collect()], atol=1e-6)
        assert found.met == (min(shares) > 0) and (found.converged or not found.met)
        assert np.allclose([r.reached_tokens for r in found.report().collect()], (tokens[:, None] * p).T @ rate)
        a = (tokens[:, None] * p).T
        target = np.array(shares) * mixing.BUDGET * tokens.sum()
        assert (rate >= 0).all()
        if min(shares) > 0:
            assert np.abs(a @ rate - target).max() <= 2e-4 * target.sum()
        else:  # not attainable: the plain loop gets no nearer
            x = last = np.ones(300)
            inverse = np.linalg.inv(a @ a.T)
            for step in range(found.steps):
                ahead = x + step / (step + 3) * (x - last)
                x, last = np.maximum(0, ahead - a.T @ inverse @ (a @ ahead - target)), x
            assert np.allclose(x, rate, atol=1e-6)


def test_a_toxic_third_is_brought_down_to_one_percent(spark):
    rows = [(i, 100, *((0.95, 0.02, 0.02, 0.01) if i % 3 else (0.03, 0.92, 0.03, 0.02))) for i in range(300)]
    members = spark.createDataFrame(rows, "doc_id long, tokens long, p0 double, p1 double, p2 double, p3 double")
    domains = [mixing.Domain("good", 1, 0, weight=1.0), mixing.Domain("good_toxic", 1, 1, share=0.03), mixing.Domain("low", 0, 0, weight=1.0), mixing.Domain("low_toxic", 0, 1, share=0.011)]
    found = mixing.solution(members, domains, budget=1.0)
    report = {r.domain: r for r in found.report().collect()}
    assert report["good_toxic"].target_tokens == pytest.approx(900) and found.converged
    assert report["good_toxic"].reached_tokens < 0.05 * sum(r.reached_tokens for r in report.values())
    bounded = mixing.solution(members, domains, budget=1.0, most_copies=1.2)
    assert max(r.rate for r in bounded.rates.collect()) <= 1.2 and not bounded.met


def test_rates_that_still_move_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(mixing, "STEPS", 1)
    rng = np.random.default_rng(1)
    rows = [(i, 100, *map(float, rng.dirichlet([0.3, 0.2, 0.2, 0.1]))) for i in range(100)]
    members = spark.createDataFrame(rows, "doc_id long, tokens long, p0 double, p1 double, p2 double, p3 double")
    domains = [mixing.Domain(str(i), 0, 0, share=s) for i, s in enumerate((0.0, 0.0, 0.5, 0.5))]
    assert not mixing.solution(members, domains).converged
    with pytest.raises(mixing.NotConverged):
        mixing.rates(members, domains)
    with pytest.raises(ValueError, match="one"):
        mixing.rates(members, [mixing.Domain("a", 0, 0, share=0.4)] * 4)


def test_posteriors_equal_a_plain_computation(spark):
    rng = random.Random(6)
    words = ["Alpha", "beta", "gamma", "delta", "epsilon", "zeta"]
    rows = [(i, " ".join(rng.choices(words[i % 2 * 2 :], k=rng.randint(0, 12))), "x") for i in range(60)]
    known = {i: (i % 2, i % 3 == 0) for i in range(40)}
    docs = spark.createDataFrame(rows, "doc_id long, text string, domain string")
    labels = spark.createDataFrame([(i, q, int(t)) for i, (q, t) in known.items()], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in mixing.memberships(docs, labels).collect()}
    place = lambda w: xxhash.xxh64_intdigest(w.lower().encode(), 42) % mixing.BUCKETS
    counts = [Counter() for _ in mixing.DOMAINS]
    sizes = Counter()
    which = lambda i: next(k for k, d in enumerate(mixing.DOMAINS) if (d.quality, d.toxic) == (known[i][0], int(known[i][1])))
    for i, text, _ in rows:
        if i in known:
            sizes[which(i)] += 1
            counts[which(i)].update(place(w) for w in text.split())
    for i, text, _ in rows:
        found = [place(w) for w in text.split()]
        logs = []
        for k, c in enumerate(counts):
            prior = np.log((sizes[k] + 1) / (len(known) + 4))
            each = [np.log((c[b] + mixing.SMOOTHING) / (c.total() + mixing.SMOOTHING * mixing.BUCKETS)) for b in found]
            logs.append(prior + (mixing.EVIDENCE_WORDS * np.mean(each) if each else 0.0))
        expected = np.exp(np.array(logs) - max(logs)) / np.exp(np.array(logs) - max(logs)).sum()
        assert np.allclose([got[i][f"p{k}"] for k in range(4)], expected)
        assert got[i].tokens == len(found)


def test_the_classifier_learns_its_labels(spark):
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(rng.choice(["bad", "worse"] if i % 3 == 0 else ["fine", "good"], 30)), 0) for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n int")
    known = spark.createDataFrame([(i, int(i % 3 != 0), 0) for i in range(150)], "doc_id long, quality int, toxic int")
    mixed = mixing.mix(frame, known).where("doc_id >= 150").collect()
    assert all((r.p_good > 0.5) == (r.doc_id % 3 != 0) for r in mixed)
