"""Content-addressed WARC archive: payloads once, headers apart, records by join.

An archive is a folder with two Parquet tables.  ``payloads`` holds the bytes
of each distinct payload once, under its SHA-256.  ``headers`` holds one row
per record: the exact header bytes, the record type and the payload's address.
Records are read back by joining the two; a payload whose bytes do not give its
own address, or a record whose header disagrees with its payload, fails the read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import settle

# Names and line ends of the WARC format, and the alphabet of base 32.
VERSION = "WARC/1.1"
LINE_END = "\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ID_PREFIX = "urn:page:"


def base32_sha1(data: Column) -> Column:
    """Upper-case base 32 of the SHA-1 (160 bits are 32 digits, no padding)."""
    digest = F.sha1(data)
    letters = []
    for group in range(8):  # five hex digits, 20 bits, give four letters
        number = F.conv(F.substring(digest, 5 * group + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            at = F.shiftright(number, shift).bitwiseAND(31)
            letters.append(F.lit(BASE32).substr(at + 1, F.lit(1)))
    return F.concat(*letters)


def _field(name: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), F.regexp_replace(value, r"[\r\n]+", " "), F.lit(LINE_END))).otherwise("")


def describe(pages: DataFrame, smallest: int = 0) -> DataFrame:
    """page_id, url, digests, sizes and record type of each page; of equal payloads the largest page_id is the response.

    Payloads below ``smallest`` bytes are all responses.  Which payloads are
    equal is decided by SHA-256 and length; the group of a frequent payload is
    one aggregate per task before it is shuffled.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    facts = settle(
        pages.select(
            "page_id", "url", F.sha2(payload, 256).alias("address"), base32_sha1(payload).alias("payload_digest"),
            F.octet_length(payload).cast("bigint").alias("payload_bytes"),
        ),
        "warc-facts",
    )
    winners = facts.where(F.col("payload_bytes") >= smallest).groupBy("address", "payload_bytes").agg(
        F.max("page_id").alias("response_id"))
    joined = facts.alias("f").join(winners.alias("w"), ["address", "payload_bytes"], "left")
    revisit = (F.col("payload_bytes") >= smallest) & F.col("response_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response_id"))
    return joined.select(
        "page_id", "url", "address", "payload_digest", "payload_bytes",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("response_id")).alias("refers_to"),
    )


def header() -> Column:
    """Exact header bytes of the record, blank line included."""
    revisit = F.col("record_type") == "revisit"
    name = lambda c: F.concat(F.lit(f"<{ID_PREFIX}"), F.coalesce(c.cast("string"), F.lit("unknown")), F.lit(">"))
    return F.concat(
        F.lit(VERSION + LINE_END),
        _field("WARC-Type", F.col("record_type")),
        _field("WARC-Record-ID", name(F.col("page_id"))),
        _field("WARC-Target-URI", F.col("url")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _field("WARC-Profile", F.when(revisit, SAME_PAYLOAD)),
        _field("WARC-Refers-To", F.when(revisit, name(F.col("refers_to")))),
        _field("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("payload_bytes").cast("string"))),
        F.lit(LINE_END),
    ).cast("binary")


def write_archive(pages: DataFrame, folder: str, smallest: int = 0) -> None:
    """Write the archive of ``pages`` (page_id, url, html) into a new folder.

    Null html is an empty payload, a null url leaves its header line out, a
    null page_id is named "unknown"; repeated rows are records of their own.
    Payloads of any size are stored whole.  Other columns of ``pages`` are not
    read; an empty table writes an empty archive.
    """
    described = describe(pages, smallest).withColumn("record_id", F.col("page_id"))
    described.select("record_id", "record_type", "refers_to", "address", header().alias("header")).write.parquet(f"{folder}/headers")
    # Every payload has a response; tasks send each payload they read once, whatever its number of records.
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    source = pages.select(F.sha2(payload, 256).alias("address"), payload.alias("payload"))
    source.groupBy("address").agg(F.first("payload").alias("payload")).write.parquet(f"{folder}/payloads")


def records(spark: SparkSession, folder: str) -> DataFrame:
    """record_id, ``record`` (its exact bytes; a revisit has no block) and ``payload``, a revisit's through its response.

    Every record is rebuilt by the join of its header with its payload.  A
    payload whose bytes do not give its own address fails the read, as does a
    record whose payload is missing.
    """
    payloads = spark.read.parquet(f"{folder}/payloads")
    headers = spark.read.parquet(f"{folder}/headers")
    wrong = F.raise_error(F.concat(F.lit("payload does not have the digest it is stored under: "), F.col("address")))
    verified = payloads.select("address", F.when(F.sha2("payload", 256) == F.col("address"), F.col("payload")).otherwise(wrong.cast("binary")).alias("payload"))
    missing = F.raise_error(F.concat(F.lit("no payload is stored under "), F.col("address")))
    joined = headers.join(verified, "address", "left").withColumn("payload", F.coalesce("payload", missing.cast("binary")))
    block = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit("").cast("binary"))
    return joined.select("record_id", F.concat("header", block, F.lit(2 * LINE_END).cast("binary")).alias("record"), "payload")


def parsed(rebuilt: DataFrame) -> DataFrame:
    """One row per record of :func:`records`, read from the record's bytes; a revisit's payload is the one it refers to.

    A record whose block is not as long as its header says, or whose payload
    has another digest, is an error.
    """
    head = F.substring_index(F.col("record").cast("string"), 2 * LINE_END, 1)
    read = rebuilt.select("record_id", "record", "payload", F.concat(head, F.lit(LINE_END)).alias("head"))
    value = lambda name: F.regexp_extract("head", rf"\n{name}: ([^\r]*)\r\n", 1)
    starts = F.octet_length("head") + len(LINE_END)
    read = read.select(
        "record_id", value("WARC-Type").alias("record_type"), value("WARC-Refers-To").alias("refers_to"), value("WARC-Record-ID").alias("name"),
        F.regexp_replace(value("WARC-Payload-Digest"), "^sha1:", "").alias("declared"), value("Content-Length").cast("bigint").alias("length"),
        F.col("record").substr(starts + 1, F.octet_length("record") - starts - 2 * len(LINE_END)).alias("block"), "payload",
    ).withColumn("payload", F.when(F.col("record_type") == "response", F.col("block")).otherwise(F.col("payload")))
    differs = F.raise_error(F.concat(F.lit("header and payload differ: "), F.col("name")))
    agrees = (F.octet_length("block") == F.col("length")) & (base32_sha1(F.col("payload")) == F.col("declared"))
    number = F.regexp_extract("refers_to", rf"^<{ID_PREFIX}(-?\d+)>$", 1)
    return read.select(
        F.col("record_id").alias("page_id"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.when(agrees, F.col("declared")).otherwise(differs.cast("string")).alias("payload_digest"),
        "record_type",
        F.when(number != "", number.cast("bigint")).alias("refers_to"),
    )
