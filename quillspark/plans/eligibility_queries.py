"""Eligibility of documents as evidence: cells come from the documents, their labels and digits of their hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.operators import eligibility
from quillspark.plans.registry import query
from quillspark.session import table

DIMENSIONS = ("0", "1", "2", "3", "4", "5", "6")


def _mostly(usual: str, *others: str) -> tuple[str, ...]:
    """Sixteen values of a cell, one for each digit: the others once, else the usual one."""
    return (*others, *[usual] * (16 - len(others)))


#: Cells by the digits of md5(text): each one's values, mostly one that passes.
EVIDENCE = {
    "collision_status": _mostly("", "verified_independent_occurrence"), "collision_review_valid": _mostly("true", "", "false"), "used_for_scoring": _mostly("true", "no"), "is_direct_place_evidence": _mostly("1", ""), "score_scope": _mostly("direct", "area"), "entity_level": _mostly("place", "area_aggregate"),
    "unit_type": _mostly("user_review", "comment", "heading", "source_native_numeric", "source_native_numeric", "source_native_numeric"), "content_layer": _mostly("user_review", "comment"), "primary_dimension": _mostly("3", "7", "1", "2", "", "0"), "dedup_key": _mostly("k", ""),
    "semantic_method": _mostly("rule_codebook", "coding_parse_fallback", "manual_code", "source_native_numeric", "source_native_numeric", "source_native_numeric"), "evidence_reliability": _mostly("0.8", "0.5", "x", "0.9"), "sentiment_score": _mostly("2", "6", "", "-3", "0", "0.25"), "semantic_score_final": _mostly("2", "-3", "0", "nan"),
    "native_rating_value": _mostly("4", "", "9"), "native_rating_scale_min": _mostly("1", "5"), "native_rating_scale_max": _mostly("5", ""), "native_rating_normalized": _mostly("2.5", "", "7"), "aggregation_weight": _mostly("0.64", "0.5", "", "0", "0.72"), "semantic_review_status": _mostly("auto_eligible", "human_confirmed", "pending", "human_confirmed"),
    "adjudication_status": _mostly("human_confirmed", ""), "review_origin": _mostly("trusted_human_input", "x"), "reviewer_id": _mostly("r", ""), "review_provenance_valid": _mostly("true", ""), "semantic_confidence": _mostly("0.8", "0.7", ""), "aspect_confidence": _mostly("0.9", "0.5"), "figurative_risk": _mostly("false", "true"),
    "semantic_rule_trace": _mostly("t", ""), "original_summary_text": _mostly("o", ""), "excerpt_or_summary": _mostly("e", ""),
}
SOURCE = {
    "used_for_scoring": _mostly("true", "false"), "is_relevant": _mostly("yes", ""), "is_user_source": _mostly("true", "false"), "access_status": _mostly("full", "blocked", "metadata_only", "partial"), "content_layer": _mostly("user_review", "rating_only", "official_fact"), "score_scope": _mostly("direct", ""),
    "entity_level": _mostly("", "area_aggregate"), "platform_id": _mostly("p", ""), "declared_platform_id": _mostly("", "q"), "url_good": _mostly("1", "0"), "known": _mostly("1", "0"),
}


def _digits(salt: str, cells: dict[str, tuple[str, ...]]) -> list[Column]:
    hashes = [F.md5(F.concat(F.coalesce("text", F.lit("")), F.lit(f"{salt}{k}"))) for k in range(2)]
    out = []
    for k, (name, values) in enumerate(cells.items()):
        digit = F.conv(F.substring(hashes[k // 32], k % 32 + 1, 1), 16, 10).cast("int")
        out.append(F.get(F.array(*[F.lit(v) for v in values]), digit).alias(name))
    return out


def _sql(salt: str, cells: dict[str, tuple[str, ...]]) -> str:
    digit = lambda k: f"strpos('0123456789abcdef', md5(coalesce(text, '') || '{salt}{k // 32}')[{k % 32 + 1}])"
    return ", ".join(f"{list(values)}[{digit(k)}] AS {salt}_{name}" for k, (name, values) in enumerate(cells.items()))


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    own = F.col("doc_id").cast("string")
    evidence = docs.join(labels.select("doc_id", "quality"), "doc_id", "left").select(
        own.alias("source_id"), F.when(F.col("doc_id") % 50 > 0, own).otherwise("").alias("evidence_id"), F.when(F.col("quality") == 1, "true").when(F.col("quality") == 0, "false").alias("is_valid"), F.col("text").alias("semantic_unit_text"),
        F.lit("x").alias("review_record_id"), F.lit("2024-05-02T10:00:00Z").alias("review_decision_time"), F.lit("h").alias("review_provenance_sha256"), *_digits("e", EVIDENCE),
    )
    sources = docs.join(labels.select("doc_id", "toxic"), "doc_id", "left").select(own.alias("source_id"), F.when(F.col("toxic") == 0, "no").when(F.col("toxic") == 1, "yes").alias("suspected_promotion"), own.alias("canonical_url"), *_digits("s", SOURCE))
    sources = sources.where("known = '1'").withColumn("normalized_url_sha256", F.when(F.col("url_good") == "1", F.sha2("canonical_url", 256)).otherwise("0")).drop("known", "url_good")
    return eligibility.judged(evidence, sources, DIMENSIONS)


RULES = f"""WITH c AS (SELECT d.doc_id, coalesce(text, '') AS text, l.quality, l.toxic, {_sql("e", EVIDENCE)}, {_sql("s", SOURCE)} FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id) l USING (doc_id)),
n AS (SELECT *, s_known = '1' AS linked, e_semantic_method = 'source_native_numeric' AS native, e_semantic_method IN ('rule_codebook', 'manual_code') AS coded, TRY_CAST(nullif(e_evidence_reliability, 'x') AS DOUBLE) AS rel, TRY_CAST(e_semantic_confidence AS DOUBLE) AS conf, TRY_CAST(e_aggregation_weight AS DOUBLE) AS w,
TRY_CAST(CASE WHEN e_semantic_method = 'source_native_numeric' THEN e_native_rating_normalized ELSE e_sentiment_score END AS DOUBLE) AS score, TRY_CAST(nullif(e_semantic_score_final, 'nan') AS DOUBLE) AS final, TRY_CAST(e_native_rating_scale_min AS DOUBLE) AS lo, TRY_CAST(e_native_rating_value AS DOUBLE) AS val, TRY_CAST(e_native_rating_scale_max AS DOUBLE) AS hi, TRY_CAST(e_native_rating_normalized AS DOUBLE) AS norm,
CASE WHEN s_known = '1' AND s_content_layer IN ('user_review', 'official_fact') THEN s_content_layer ELSE '' END AS block, e_semantic_review_status AS review FROM c),
r AS (SELECT doc_id, score, [
CASE WHEN e_collision_status <> '' AND e_collision_review_valid <> 'true' THEN 'collision_review_provenance_invalid' END, CASE WHEN e_used_for_scoring <> 'true' THEN 'not_marked_for_scoring' END, CASE WHEN quality IS DISTINCT FROM 1 THEN 'invalid_evidence' END, CASE WHEN e_is_direct_place_evidence <> '1' THEN 'not_direct_place_evidence' END,
CASE WHEN e_score_scope <> 'direct' THEN 'score_scope_not_direct' END, CASE WHEN e_entity_level = 'area_aggregate' THEN 'aggregate_area_evidence' END,
CASE WHEN e_unit_type = 'source_native_numeric' OR block <> '' AND e_unit_type IN ('user_review', 'comment') AND (e_content_layer <> e_unit_type OR block <> e_unit_type OR s_is_user_source <> 'true') THEN 'content_qualification_conflict' END,
CASE WHEN NOT (e_unit_type IN ('user_review', 'comment') OR native AND e_unit_type = 'source_native_numeric') THEN 'unit_type_not_scorable' END, CASE WHEN e_primary_dimension IN ('7', '') THEN 'invalid_primary_dimension' END, CASE WHEN doc_id % 50 = 0 THEN 'missing_evidence_id' END, CASE WHEN e_dedup_key = '' THEN 'missing_dedup_key' END,
CASE WHEN e_semantic_method = 'coding_parse_fallback' THEN 'semantic_method_not_formally_scorable' END, CASE WHEN coalesce(rel < 0.55, true) THEN 'evidence_reliability_below_threshold' END, CASE WHEN NOT coalesce(abs(score) <= 5, false) THEN 'missing_or_invalid_scoring_value' END,
CASE WHEN native AND NOT coalesce(lo < hi AND lo <= val AND val <= hi, false) THEN 'invalid_native_numeric_scale' END, CASE WHEN native AND (lo IS NULL OR val IS NULL OR hi IS NULL OR norm IS NULL) THEN 'incomplete_native_numeric_scale' END, CASE WHEN (native OR coded) AND NOT coalesce(w > 0, false) THEN 'missing_aggregation_weight' END,
CASE WHEN coded AND review = 'pending' THEN 'semantic_review_not_confirmed' END, CASE WHEN coded AND review = 'human_confirmed' AND (e_adjudication_status = '' OR e_review_origin = 'x' OR e_reviewer_id = '' OR e_review_provenance_valid = '') THEN 'review_provenance_invalid' END,
CASE WHEN coded AND coalesce(conf < 0.72, true) THEN 'semantic_confidence_below_threshold' END, CASE WHEN coded AND e_aspect_confidence = '0.5' THEN 'dimension_confidence_below_threshold' END, CASE WHEN coded AND w > 0 AND abs(w - conf * rel) > 0.02 THEN 'aggregation_weight_mismatch' END,
CASE WHEN coded AND NOT coalesce(abs(final - score) <= 1e-9, false) THEN 'semantic_final_score_mismatch' END, CASE WHEN coded AND e_figurative_risk = 'true' AND review <> 'human_confirmed' THEN 'figurative_risk_not_human_confirmed' END, CASE WHEN coded AND trim(text) = '' THEN 'missing_semantic_unit_text' END, CASE WHEN coded AND e_semantic_rule_trace = '' THEN 'missing_semantic_rule_trace' END,
CASE WHEN NOT native AND e_original_summary_text = '' THEN 'missing_original_summary_text' END, CASE WHEN NOT native AND e_excerpt_or_summary = '' THEN 'missing_excerpt_or_summary' END, CASE WHEN NOT linked THEN 'missing_linked_source' END, CASE WHEN linked AND s_url_good = '0' THEN 'source_normalized_url_hash_invalid' END,
CASE WHEN linked AND s_used_for_scoring <> 'true' THEN 'source_not_marked_for_scoring' END, CASE WHEN linked AND s_is_relevant = '' THEN 'source_not_relevant' END, CASE WHEN linked AND s_is_user_source <> 'true' THEN 'source_not_user_evidence' END, CASE WHEN linked AND toxic IS DISTINCT FROM 0 THEN 'source_promotional_or_unknown' END,
CASE WHEN linked AND (s_access_status = 'blocked' OR s_access_status = 'metadata_only' AND NOT (native AND s_content_layer = 'rating_only')) THEN 'source_not_readable' END, CASE WHEN linked AND s_score_scope = '' THEN 'source_scope_not_direct' END, CASE WHEN linked AND s_entity_level <> '' THEN 'source_is_area_aggregate' END, CASE WHEN linked AND s_platform_id = '' THEN 'source_platform_missing' END] AS codes FROM n),
j AS (SELECT doc_id, list_filter(codes, lambda x: x IS NOT NULL) AS codes, CASE WHEN score IS NULL THEN 'not_scored' WHEN score >= 0.5 THEN 'positive' WHEN score <= -0.5 THEN 'negative' ELSE 'neutral' END AS direction FROM r)
"""


@query(RULES + "SELECT CAST(doc_id AS VARCHAR) AS source_id, array_to_string(codes, ',') AS reasons, len(codes) = 0 AS eligible, direction FROM j")
def record_eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reason why a document is no evidence that can be scored, of 39 rules over it and its source (F1)."""
    return _judged(spark, sf_dir).select("source_id", F.array_join("reasons", ",").alias("reasons"), "eligible", "direction")


@query(RULES + "SELECT code, count(*) AS n FROM (SELECT unnest(codes) AS code FROM j) GROUP BY code")
def eligibility_code_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each rule is broken."""
    return _judged(spark, sf_dir).select(F.explode("reasons").alias("code")).groupBy("code").agg(F.count("*").alias("n"))
