"""The queries of this subpackage, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import decontaminate, fingerprint, html_text, near_dedup, packing, pieces, pii, prefix_trie, quality, repair, sharding, token_files, url_filter
from quillspark.session import table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.report(table(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), url_filter.rules_frame(spark, url_filter.RULES))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_files.new_folder(spark)
    return token_files.read(token_files.write(table(spark, sf_dir, "documents"), folder), folder)


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.components(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.grade(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.report(table(spark, sf_dir, "documents"))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.report(table(spark, sf_dir, "conversations"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.report(table(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (op1_pii, op2_sharding, op3_decontamination, op4_sentencepiece, op5_fingerprints, op6_url_filter, op7_token_files, op8_near_dedup, op9_quality, op10_html_text, op11_packing, op12_repair, op13_prefix_trie, pipeline)
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_sharding": sharding.ORACLE_SQL, "op6_url_filter": url_filter.ORACLE_SQL, "op12_repair": repair.ORACLE_SQL, "op13_prefix_trie": prefix_trie.ORACLE_SQL}
