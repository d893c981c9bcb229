"""Document fingerprints: a homomorphic multiset hash over paragraphs.

Each paragraph (line) is hashed to a wide vector of 60-bit words and a document's fingerprint is the sum of
its paragraphs' vectors, each word modulo 2^60. The sum does not depend on the order of paragraphs; adding
or taking away a paragraph adds or subtracts its vector (`plus`, `minus`).

The words are slices of a paragraph's SHA-512, so none is a function of another. The first WIDE words, 240
bits, decide equality. The others are a sketch made from a further slice: each carries three lanes of 20
bits, into which a paragraph adds one bit of its hash, so that the difference of two documents' sketches
estimates the size of the difference of their paragraph multisets (a tug-of-war sketch of 3 * SHIFTS
signs), which `likeness` turns into a number from 0 to 1.

All in Spark SQL functions. Null texts count as empty: one empty paragraph. Equal texts have equal
fingerprints. Rows with equal doc_ids are ordered by their text, a null doc_id sorts first; other columns
are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.session import cut

WIDE = 4
SHIFTS = 20
LANE_BITS = 20
WORD = (1 << 60) - 1
LANES = (1 << 40) | (1 << 20) | 1
NO_ID = -(1 << 63)
HEX_DIGITS = 15
#: Rows of a range of doc_ids, and the number of ranges that is never passed: their bounds, 8 bytes each, are broadcast.
ROWS_PER_RANGE, MOST_RANGES = 400, 1 << 20


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _vector(paragraph: Column) -> Column:
    """What one paragraph adds: WIDE words of its SHA-512, then SHIFTS words of three lanes with a bit each."""

    def words(digest: Column) -> Column:
        def slice_(k: int) -> Column:
            return F.conv(F.substring(digest, 1 + HEX_DIGITS * k, HEX_DIGITS), 16, 10).cast("long")

        def lanes(h: Column) -> Column:
            return F.array(*[F.shiftrightunsigned(h, k).bitwiseAND(F.lit(LANES)) for k in range(SHIFTS)])

        return F.concat(F.array(*[slice_(k) for k in range(WIDE)]), _bound(slice_(WIDE), lanes))

    return _bound(F.sha2(paragraph.cast("binary"), 512), words)


def fingerprint(text: Column) -> Column:
    """array<bigint>: WIDE + SHIFTS words, then the number of paragraphs. Every paragraph is hashed once."""
    paragraphs = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    none = F.array_repeat(F.lit(0).cast("long"), WIDE + SHIFTS + 1)
    one = F.array(F.lit(1).cast("long"))
    return F.aggregate(paragraphs, none, lambda total, p: plus(total, F.concat(_vector(p), one)))


def plus(a: Column, b: Column) -> Column:
    """The fingerprint of both documents' paragraphs together."""
    return F.zip_with(a, b, lambda x, y: (x + y).bitwiseAND(F.lit(WORD)))


def minus(a: Column, b: Column) -> Column:
    """The fingerprint of a's paragraphs without b's."""
    return F.zip_with(a, b, lambda x, y: (x - y).bitwiseAND(F.lit(WORD)))


def written(words: Column) -> Column:
    """15 hex digits a word."""
    return F.lower(F.array_join(F.transform(words, lambda w: F.lpad(F.hex(w), 15, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """1 for equal fingerprints; else 1 - d / (n_a + n_b), with d the estimated number of paragraphs in one only."""

    def signs(words: Column) -> Column:
        n = F.element_at(words, -1)
        lanes = F.flatten(
            F.transform(
                F.slice(words, WIDE + 1, SHIFTS),
                lambda w: F.array(*[F.shiftright(w, LANE_BITS * j).bitwiseAND(F.lit((1 << LANE_BITS) - 1)) for j in range(3)]),
            )
        )
        return F.transform(lanes, lambda x: 2 * x - n)

    square = F.aggregate(F.zip_with(signs(a), signs(b), lambda x, y: (x - y).cast("double") * (x - y)), F.lit(0.0), lambda acc, x: acc + x)
    apart = square / (3 * SHIFTS)
    return F.when(a == b, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), 1 - apart / (F.element_at(a, -1) + F.element_at(b, -1))))


def _heads(base: DataFrame) -> DataFrame:
    """(range, head, before): the first doc_id of each range, in order, and the number of the range before it (round the end).

    The ids alone are sorted; a window inside each sorted part takes every so many-th of them. Nothing of it
    comes to the driver but the number of rows.
    """
    ids = base.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("head"))
    parts = max(int(base.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    step = max(ROWS_PER_RANGE, -(-ids.count() // MOST_RANGES))
    sorted_ids = cut(ids.repartitionByRange(parts, "head").withColumn("part", F.spark_partition_id()))
    nth = F.row_number().over(Window.partitionBy("part").orderBy("head"))
    chosen = sorted_ids.withColumn("nth", nth).where((F.col("nth") - 1) % step == 0).select("head").distinct()
    whole = Window.orderBy("head")  # a row for each range
    numbered = chosen.withColumn("range", F.row_number().over(whole) - 1)
    last = F.max("range").over(Window.orderBy("head").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return cut(numbered.withColumn("before", F.coalesce(F.lag("range").over(whole), last)))


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, words, next_text, next_words): each document beside the next in ascending doc_id, the last beside the first.

    The ids alone decide the ranges; one shuffle brings each range's texts together, with the first
    document of the range that follows as a guest at its end.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    known = F.coalesce("doc_id", F.lit(NO_ID))
    heads = _heads(base)
    # one row: at most MOST_RANGES longs
    bounds = heads.agg(F.array_sort(F.collect_list("head")).alias("bounds"))
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(MOST_RANGES.bit_length()))])
    found = F.aggregate(steps, F.lit(0), lambda at, s: F.when(F.coalesce(F.get("bounds", at + s) <= known, F.lit(False)), at + s).otherwise(at))
    placed = base.crossJoin(F.broadcast(bounds)).withColumn("range", found).drop("bounds")
    guest = (
        base.withColumn("head", known)
        .join(F.broadcast(heads.select("head", "before")), "head")
        .groupBy("before")
        .agg(F.min(F.struct("doc_id", "text")).alias("d"))
        .select(F.col("d.doc_id").alias("doc_id"), F.col("d.text").alias("text"), F.col("before").alias("range"), F.lit(True).alias("guest"))
    )
    every = placed.withColumn("guest", F.lit(False)).unionByName(guest).withColumn("words", fingerprint(F.col("text")))
    order = Window.partitionBy("range").orderBy("guest", F.col("doc_id").asc_nulls_first(), "text")
    return (
        every.withColumn("next_text", F.lead("text").over(order))
        .withColumn("next_words", F.lead("words").over(order))
        .where(~F.col("guest"))
        .select("doc_id", "text", "words", "next_text", "next_words")
    )


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many of the next text.
    """
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    paired = with_next(docs).withColumn("edited", F.concat(F.left("text", n - half), F.left("next_text", half)))
    return paired.withColumn("edited_words", fingerprint(F.col("edited"))).select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        written(F.col("words")).alias("fingerprint"),
        written(F.col("edited_words")).alias("edited_fingerprint"),
        likeness(F.col("words"), F.col("edited_words")).alias("near_edited"),
        likeness(F.col("words"), F.col("next_words")).alias("near_next"),
    )
