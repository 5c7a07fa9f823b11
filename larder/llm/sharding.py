"""Shards of nearly equal bytes by sampled splitters.

The key of a row is the hash of its text, so equal texts are neighbours and
share a shard.  Keys are drawn with a chance in proportion to the row's size;
quantiles of the draw split the key space into many small ranges.  The exact
bytes of each range give every key its place on one line of bytes, which is cut
into equal shards.  A text that fills its range alone (many copies, or one very
long row) is subdivided by row, and only then may copies lie in two shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import settle

#: Bytes that each row counts beside its text.
ROW_BYTES = 8
#: Rows that a range holds on average at most, and the numbers of ranges to choose from.
RANGE_ROWS = 100_000
RANGES = (240, 1 << 16)
#: Keys drawn for each range.
DRAWN = 32
#: A group of copies is subdivided, into parts of this share of a shard, if it is larger than that and than so many bytes
#: (or a quarter of a shard, where shards are as small as that), and in any case beyond so many bytes.
PART_OF_SHARD = 1 / 50
LEAST_PART_BYTES, PART_BYTES = 64 << 10, 64 << 20


def _range_of(key: str, splitters: list[int]) -> Column:
    """Number of splitters that are not above the key, by bisection over a constant array."""
    if not splitters:
        return F.lit(0)
    bounds = F.array(*map(F.lit, splitters)) if len(splitters) < 4 else F.lit(splitters)
    steps = [1 << i for i in reversed(range(len(splitters).bit_length()))]
    ahead = lambda at, step: (at + step <= len(splitters)) & (F.element_at(bounds, F.least(at + step, F.lit(len(splitters)))) <= F.col(key))
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, step: F.when(ahead(at, step), at + step).otherwise(at))


def splitters(rows: DataFrame, ranges: int, total: int) -> list[int]:
    """Quantiles of a draw of keys weighted by size; a few numbers per range, whatever the input."""
    rate = ranges * DRAWN / max(total, 1)
    chance = F.expr("cast(pmod(xxhash64(key, doc_id, 11), 1000000007) as double) / 1000000007")
    parts = [i / ranges for i in range(1, ranges)]
    drawn = rows.where(chance < F.col("size") * rate).agg(F.percentile_approx("key", parts, max(10_000, 4 * ranges)).alias("q")).first()
    return sorted(set(drawn.q or []))


def group_bound(total: int, shards: int) -> int:
    """Bytes up to which all copies of a text share a shard."""
    shard = total / shards
    return max(1, int(min(max(shard * PART_OF_SHARD, min(LEAST_PART_BYTES, shard / 4)), PART_BYTES)))


def assign(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, shard, slot.

    Shards hold nearly equal bytes; ``slot`` numbers the rows of a shard
    without gaps from 0.  Rows of one text share a shard unless they hold more
    than :func:`group_bound` together; a single text is never cut, however long.  Null text has no bytes and is the same key as the
    empty text.  Null ids are rows like others, repeated rows get a slot each.
    Other columns of ``docs`` are not read; an empty table gives an empty one.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = settle(
        docs.select(
            F.col(key).alias("doc_id"), F.xxhash64(whole).alias("key"), F.crc32(whole.cast("binary")).alias("text_crc32"),
            (F.octet_length(whole) + F.lit(ROW_BYTES).cast("bigint")).alias("size"),
        ),
        "shard-rows",
    )
    whole_table = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first()
    ranges = min(max(RANGES[0], -(-whole_table.n // RANGE_ROWS)), RANGES[1])
    most = group_bound(whole_table.bytes, shards)
    cut = splitters(rows, ranges, whole_table.bytes)

    # Groups of copies, the large ones in parts; a row's part follows from its id.
    fine = max(1, min(int(whole_table.bytes / shards * PART_OF_SHARD), PART_BYTES))
    groups = rows.groupBy("key").agg(F.expr(f"cast(IF(sum(size) <= {most}, 1, ceil(sum(size) / {fine})) as int)").alias("parts"))
    parted = settle(
        rows.join(groups, "key").select("doc_id", "key", "size", "text_crc32", F.expr("pmod(xxhash64(doc_id), parts)").alias("part")),
        "shard-parts",
    )
    units = parted.groupBy("key", "part").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).withColumn("range", _range_of("key", cut))
    units = settle(units, "shard-units")

    # Bytes before a unit: those of earlier ranges, and those of earlier units in its range.
    in_order = W.partitionBy("range").orderBy("key", "part").rowsBetween(W.unboundedPreceding, -1)
    earlier = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    totals = units.groupBy("range").agg(F.sum("bytes").alias("range_bytes"))
    starts = totals.select("range", F.coalesce(F.sum("range_bytes").over(earlier), F.lit(0)).alias("range_start"))
    placed = units.withColumn("inside", F.coalesce(F.sum("bytes").over(in_order), F.lit(0))).join(starts, "range")
    middle = f"(2 * (range_start + inside) + bytes) * {shards}"
    shard = F.expr(f"cast(least({shards - 1}, cast({middle} as decimal(38)) div (2 * {max(1, int(whole_table.bytes))})) as int)")
    placed = settle(placed.withColumn("shard", shard).select("key", "part", "range", "n", "shard"), "shard-places")

    # Rows before a unit in its shard, in the same two steps.
    in_shard = W.partitionBy("range", "shard").orderBy("key", "part").rowsBetween(W.unboundedPreceding, -1)
    earlier = W.partitionBy("shard").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    counts = placed.groupBy("range", "shard").agg(F.sum("n").alias("range_n"))
    starts = counts.select("range", "shard", F.coalesce(F.sum("range_n").over(earlier), F.lit(0)).alias("first"))
    slots = placed.withColumn("inside", F.coalesce(F.sum("n").over(in_shard), F.lit(0))).join(starts, ["range", "shard"])
    slots = slots.select("key", "part", "shard", (F.col("first") + F.col("inside")).alias("first"))
    ranked = parted.withColumn("rank", F.row_number().over(W.partitionBy("key", "part").orderBy("doc_id")))
    return ranked.join(slots, ["key", "part"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("rank") - 1).cast("bigint").alias("slot")
    )
