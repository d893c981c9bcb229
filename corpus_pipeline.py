"""A corpus pipeline: quality, near-duplicates, benchmark leaks, personal data, tokens.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame that is written as Parquet and read again as
the next stage's docs. All but the last return the columns of documents.

Every stage takes null ids and texts, empty and very long texts, ties, repeated rows, an empty table and
further columns: null and empty texts count as empty (they are judged, never dropped for that alone; a null
text stays null under the mask). A stage that keeps rows keeps them with all their columns as they are. Of
rows that repeat a doc_id and a text, near_dedup keeps one; rows without a doc_id only go where a row with
an id or another one repeats them. Each stage's docstring says what it decides.
"""

from __future__ import annotations

import posixpath
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import decontaminate, near_dedup, pieces, pii, quality
from quillspark.session import shared_dir, table

#: Texts whose sets of five words have a Jaccard similarity of this or more are near-duplicates.
NEAR_PERCENT = 80


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier keeps; it is fitted on labelled documents of the table as it came.

    Labels that are null are ignored, several of one document count as its worst, and a repeated doc_id is one row of the fit.
    """
    model = quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality.select(docs, model)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the least doc_id, of each group of near-duplicates."""
    return near_dedup.keep_one(docs, NEAR_PERCENT)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item within a tenth of its characters in edits; null and empty items match nothing."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; n_chars is that of the new text."""
    return pii.mask(docs).withColumn("n_chars", F.length("text").cast("long"))


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document left."""
    return pieces.digests(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("tokens", tokens_stage),
]

#: SQL cannot express a fitted model, MinHash or a tokenizer; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared folder and read again."""
    folder = posixpath.join(shared_dir(spark), f"corpus-{uuid.uuid4().hex}")
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        path = posixpath.join(folder, f"{k}-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
