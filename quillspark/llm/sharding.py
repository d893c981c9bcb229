"""Sharding: contiguous shards of nearly equal bytes, cut from a global prefix sum.

Rows are dealt to as many sorted ranges of doc_id as spark.sql.shuffle.partitions says, every range gives its total (bytes, rows), the prefix sums of
these few totals give each range its base, and a running sum inside the range gives each row its global
offset. A row belongs to the shard in which the middle of its bytes lies, so a shard's size is off the
target by less than one row on either side.

Null doc_ids come first; ties and repeated rows are ordered by size and checksum, so equal rows are
interchangeable. A null text has no bytes and keeps its fixed cost of 16. An empty table gives no rows.
Only the id, the text and nothing else of the input is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.session import cut

SHARDS = 40
#: Bytes that a row costs besides its text.
ROW_COST = 16


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32) of each row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + ROW_COST).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )


def ranged(sized: DataFrame) -> DataFrame:
    """The rows in sorted ranges: (..., part, before_bytes, before_rows) with exclusive running sums of the whole table.

    The ranges are written to the shared folder, so the range of a row never changes between the two reads.
    """
    spark = sized.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    order = [F.col("doc_id").asc_nulls_first(), F.col("size"), F.col("text_crc32")]
    rows = cut(sized.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()))
    totals = rows.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    # one row for each range: bounded by the number of partitions
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(ahead), F.lit(0)).alias("base_bytes"),
        F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base_rows"),
        F.sum("bytes").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("all_bytes"),
    )
    inside = Window.partitionBy("part").orderBy(*order)
    return (
        rows.withColumn("upto", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .withColumn("nth", F.row_number().over(inside))
        .join(F.broadcast(bases), "part")
        .select(
            "doc_id",
            "size",
            "text_crc32",
            (F.col("base_bytes") + F.col("upto") - F.col("size")).alias("before_bytes"),
            (F.col("base_rows") + F.col("nth") - 1).alias("before_rows"),
            "all_bytes",
        )
    )


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): slot counts the rows of a shard from 0, in order."""
    middle = F.expr(f"((2 * before_bytes + size) * {shards}L) div (2 * all_bytes)")
    placed = ranged(sizes(docs)).withColumn("shard", F.least(middle, F.lit(shards - 1)).cast("int"))
    # one row for each shard
    first = placed.groupBy("shard").agg(F.min("before_rows").alias("first_row"))
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("before_rows") - F.col("first_row")).alias("slot")
    )


#: The checksum by its definition: a table made from the polynomial, and a fold over the bytes.
ORACLE_SQL = """
WITH RECURSIVE steps(i, k, v) AS (
  SELECT i, 0, i FROM range(256) r(i) UNION ALL SELECT i, k + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM steps WHERE k < 8
), lookup AS (SELECT i, v FROM steps WHERE k = 8
), b AS (
  SELECT doc_id, encode(coalesce(text, '')) AS raw FROM documents
), tab AS (SELECT list(v ORDER BY i) AS t FROM lookup
), s AS (
  SELECT doc_id, CAST(octet_length(raw) AS BIGINT) + 16 AS size,
    xor(list_reduce(list_transform(regexp_extract_all(hex(raw), '..'), lambda h: CAST('0x' || h AS BIGINT)), lambda acc, x: xor(acc // 256, t[xor(acc % 256, x) + 1]), 4294967295), 4294967295) AS crc
  FROM b CROSS JOIN tab
), o AS (
  SELECT doc_id, size, crc, coalesce(sum(size) OVER (ORDER BY doc_id NULLS FIRST, size, crc ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    row_number() OVER (ORDER BY doc_id NULLS FIRST, size, crc) AS rn, sum(size) OVER () AS total FROM s
), p AS (
  SELECT *, CAST(least(39, (2 * before + size) * 40 // (2 * total)) AS INTEGER) AS shard FROM o
)
SELECT doc_id, size, crc AS text_crc32, 'bytes' AS law, shard, CAST(rn - min(rn) OVER (PARTITION BY shard) AS BIGINT) AS slot, NULL::INTEGER AS grown_shard FROM p
"""
