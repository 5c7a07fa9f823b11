"""A corpus pipeline: from raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are
written to the shared folder and read again as the next one's ``docs``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import bpe, exact, mixing, quality, simhash
from larder.llm.registry import table, tokenizer
from larder.session import shared_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie within the perplexity bands of their language.

    A null text is empty and goes, a null language is the empty one; repeated
    rows share their fate, texts of any length are judged whole, an empty table
    stays empty.
    """
    return quality.keep(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of identical texts, the row with the largest id.

    Null texts equal the empty one, null ids are the smallest; of rows that are
    repeated with id and text one stays.  Texts of any length are compared
    whole, an empty table stays empty.
    """
    kept = exact.classes(docs).where("kept").select("doc_id", "text_sha256").alias("k")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), "doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest")).alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("d.digest") == F.col("k.text_sha256"))
    return rows.join(kept, same, "left_semi").dropDuplicates(["doc_id", "digest"]).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate group, the row with the smallest id.

    Texts without a word (null ones too) are one group; rows with the smallest
    id of a group all stay if that id is repeated, null ids stay only in groups
    that have no other.  Texts of any length count whole, an empty table stays
    empty.
    """
    first = simhash.groups(docs).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id").alias("f")
    return docs.alias("d").join(first, F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")), "left_semi")


def mixing_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its rate says; the expected tokens of each domain meet the targets.

    Rows of one id (null among them) are one document; null and empty texts have
    no tokens and stay once.  Texts of any length are read whole, an empty table
    stays empty.
    """
    return mixing.apply(docs, mixing.mix(docs, table(spark, sf_dir, "labels")))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and digests of the ids and of the text they give back.

    A null text is empty and has no ids; every row gives one, repeated rows and
    null ids too.  Texts of any length are encoded whole, an empty table stays
    empty.
    """
    return bpe.encode(docs, tokenizer(), decoded=True).select(
        "doc_id",
        F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "ids",
    )


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("SimHash near-dedup", near_dedup),
    ("mixing to target weights", mixing_to_targets),
    ("BPE encoding", bpe_encoding),
]

#: No SQL: the language model, the fingerprints and the tokenizer are not expressible in it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the documents table."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return docs
