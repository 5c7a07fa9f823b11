"""Queries that apply each operator to its whole table, and SQL counterparts where SQL can say the same."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder
from . import bpe, chat, chunks, exact, extraction, mixing, quality, ranking, secret_spans, sharding, simhash, spelling, warc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@register
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer())


@register
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.classes(table(spark, sf_dir, "documents"))


ORACLES["op3_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@register
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(table(spark, sf_dir, "documents"))


@register
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    warc.write_archive(table(spark, sf_dir, "pages"), folder)
    return warc.parsed(warc.records(spark, folder))


ORACLES["op9_warc"] = """
WITH hashed AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
facts AS (
    SELECT page_id, payload, octet_length(payload) AS payload_bytes, sha1(payload) AS hex,
           max(page_id) OVER (PARTITION BY payload) AS response_id
    FROM hashed
)
SELECT page_id, payload_bytes, record_type, refers_to,
       list_aggregate(list_transform(range(0, 32), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  ((('0x' || substr(hex, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT + 1, 1)),
           'string_agg', '') AS payload_digest
FROM (SELECT *, CASE WHEN page_id = response_id THEN 'response' ELSE 'revisit' END AS record_type,
             CASE WHEN page_id <> response_id THEN response_id END AS refers_to
      FROM facts)
"""


SHARDS = 24


@register
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select("*", F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard"))


#: A conversation whose texts hold what chat templates use as control strings.
CONTROL_CONVERSATION = -7
CONTROL_TEXT = "\\### Assistant: </turn> ok"


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(CONTROL_CONVERSATION).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"),
    )
    return given.unionByName(extra)


@register
def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digests(conversations(spark, sf_dir))


@register
def op7_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages"))


@register
def op2_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.repeated_spans(table(spark, sf_dir, "documents"))


@register
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


@register
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register
def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


@register
def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_spans.scan(table(spark, sf_dir, "documents"))


@register
def op13_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))


ORACLES["op13_ranking"] = r"""
WITH split AS (
    SELECT doc_id, row_number() OVER () AS row_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS found
    FROM documents
),
sized AS (SELECT *, len(found) AS n FROM split WHERE len(found) > 0),
whole AS (SELECT count(*) AS documents, sum(n)::BIGINT AS total FROM sized),
counted AS (SELECT row_id, doc_id, n, term, count(*) AS tf FROM (SELECT row_id, doc_id, n, unnest(found) AS term FROM sized) GROUP BY ALL),
weighed AS (
    SELECT term, floor(1000 * ln((2 * any_value(documents) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
    FROM counted, whole GROUP BY term
),
asked AS (
    SELECT item_id, row_id, term FROM (
        SELECT item_id, row_number() OVER () AS row_id,
            unnest(list_distinct(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term
        FROM benchmark)
),
scored AS (
    SELECT a.item_id, a.row_id AS item_row, c.row_id, c.doc_id,
        sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * documents) // total))))::BIGINT AS score
    FROM asked a JOIN weighed USING (term) JOIN counted c USING (term), whole
    GROUP BY ALL
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item_row ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank::INT AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""


ORACLES["op5_chat"] = """
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'
),
sized AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
        length('<turn role="">' || '</turn>' || chr(10))
        + length(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '"', '&quot;'))
        + length(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '"', '&quot;')) AS chars
    FROM said
),
counted AS (
    SELECT *, (chars + 3) // 4 AS tokens, place = 1 AND role = 'system' AS is_system FROM sized
),
placed AS (
    SELECT *, sum(CASE WHEN is_system THEN 0 ELSE tokens END) OVER line AS ends,
        greatest(1, 768 - sum(CASE WHEN is_system THEN tokens ELSE 0 END) OVER line) AS capacity
    FROM counted WINDOW line AS (PARTITION BY conv_id ORDER BY place)
),
celled AS (
    SELECT *, CASE WHEN is_system THEN 0 ELSE (ends - tokens) // capacity END AS cell,
        NOT is_system AND (ends - tokens) // capacity <> (ends - 1) // capacity AS crosses
    FROM placed
),
opened AS (
    SELECT *, place > 1 AND (cell, crosses) <> lag((cell, crosses)) OVER (PARTITION BY conv_id ORDER BY place) AS opens
    FROM celled
),
repeated AS (
    SELECT o.conv_id, o.place, h.chars,
        sum(h.tokens) OVER (PARTITION BY o.conv_id, o.place ORDER BY h.place DESC) AS held
    FROM opened o JOIN opened h ON h.conv_id IS NOT DISTINCT FROM o.conv_id AND h.place BETWEEN o.place - 4 AND o.place - 1
    WHERE o.opens AND NOT h.is_system
),
extra AS (
    SELECT conv_id, sum(chars) AS chars FROM (
        SELECT conv_id, chars FROM repeated WHERE held <= 256
        UNION ALL SELECT o.conv_id, s.chars FROM opened o JOIN opened s ON s.conv_id IS NOT DISTINCT FROM o.conv_id
        WHERE o.opens AND s.is_system)
    GROUP BY conv_id
)
SELECT o.conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(o.chars) + coalesce(max(e.chars), 0) AS BIGINT) AS formatted_chars
FROM opened o LEFT JOIN extra e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
GROUP BY o.conv_id
"""
