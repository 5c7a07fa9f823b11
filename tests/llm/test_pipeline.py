"""The registered queries against SQL, and the pipeline against a plain version of its stages."""

import hashlib
from collections import Counter

import pytest
from compare import connect, differences
from pyspark.sql import functions as F

import corpus_pipeline
from larder.llm import bpe, exact, simhash
from larder.llm.quality import Rules
from larder.llm.registry import ORACLES, QUERIES, tokenizer


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_equals_sql(spark, small_data, key):
    assert differences(QUERIES[key](spark, small_data), connect(small_data), ORACLES[key]) == []


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_pipeline_equals_its_stages_done_plainly(spark, small_data):
    docs = spark.read.parquet(f"{small_data}/documents.parquet")
    kept = {r.doc_id for r in Rules(docs).verdicts().where("kept").collect()}
    rows = {r.doc_id: r.text for r in docs.collect() if r.doc_id in kept}
    last = {}
    for d in sorted(rows):
        last[rows[d]] = d
    rows = {d: t for t, d in last.items()}
    prints = {d: simhash.fingerprint(t) for d, t in rows.items()}
    first, ids = {}, sorted(rows)
    root = {d: d for d in ids}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for i, a in enumerate(ids):
        for b in ids[:i]:
            if bin(prints[a] ^ prints[b]).count("1") <= 4:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    rows = {d: rows[d] for d in ids if find(d) == d}
    frame = spark.createDataFrame([(d, t) for d, t in rows.items()], "doc_id long, text string")
    mixed = corpus_pipeline.mixing.mix(frame, spark.read.parquet(f"{small_data}/labels.parquet"))
    copies = {r.doc_id: r.copies for r in mixed.collect()}
    vocab, expected = bpe.vocabulary(tokenizer()), Counter()
    for d, t in rows.items():
        (tokens,) = bpe.encode_texts([t], vocab)
        digest = lambda b: hashlib.sha256(b).hexdigest()
        if copies[d]:
            expected[d, len(tokens), digest(tokens.astype("<u4").tobytes()), digest(t.encode()), tokens.astype("<u4").tobytes()] += copies[d]
    got = Counter((*r[:4], bytes(r[4])) for r in corpus_pipeline.run(spark, small_data).collect())
    assert got == expected


@pytest.mark.parametrize("number", range(4))
def test_stages_keep_the_columns_and_take_awkward_rows(spark, docs, no_docs, small_data, number):
    plain = ["doc_id", "text", "lang", "source", "n_chars"]
    stage = corpus_pipeline.STAGES[number][1]
    for frame in (docs.select(*plain), docs, no_docs):
        result = stage(spark, frame, small_data)
        assert result.columns == frame.columns
        assert result.count() <= 2 * frame.count()
    clashing = ["digest", "kept_id", "kept_sha256", "first_id", "domain", "mixed_id", "mixed_copies", "row", "held", "lower", "entropy", "id", "text_sha256"]
    wide = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).select("*", *(F.concat(F.lit(f"{c}-"), "doc_id").alias(c) for c in clashing))
    kept = stage(spark, wide, small_data)
    assert kept.columns == wide.columns
    rows = kept.collect()
    assert rows and all(r[c] == f"{c}-{r.doc_id}" for r in rows for c in clashing)
    if number == 1:
        texts = [r.text or "" for r in stage(spark, docs, small_data).collect()]
        assert len(texts) == len(set(texts))
        assert len(texts) == exact.classes(docs).select("text_sha256").distinct().count()


def test_last_stage_takes_awkward_rows(spark, docs, no_docs, small_data):
    assert corpus_pipeline.bpe_encoding(spark, docs, small_data).count() == docs.count()
    assert corpus_pipeline.bpe_encoding(spark, no_docs, small_data).count() == 0
