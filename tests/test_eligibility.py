"""Eligibility: a row that passes, and each rule broken alone."""

import hashlib

import pytest

from quillspark.operators import eligibility

GOOD = dict(
    source_id="s1", evidence_id="e1", collision_status="", used_for_scoring="true", is_valid="1", is_direct_place_evidence="yes", score_scope="direct", entity_level="", unit_type="user_review", content_layer="user_review", primary_dimension="a", dedup_key="k", semantic_method="rule_codebook",
    evidence_reliability="0.8", sentiment_score="2", semantic_score_final="2.0", aggregation_weight="0.64", semantic_review_status="auto_eligible", semantic_confidence="0.8", aspect_confidence="0.9", figurative_risk="false", semantic_unit_text="t", semantic_rule_trace="r", original_summary_text="o", excerpt_or_summary="x", platform_id="p",
    native_rating_value="", native_rating_scale_min="", native_rating_scale_max="", native_rating_normalized="", review_decision_time="", retrieved_at="2024-01-02T00:00:00Z", reviewer_id="", review_record_id="", review_provenance_sha256="", review_provenance_valid="", adjudication_status="", review_origin="", source_block_type="", source_block_is_user_generated="",
)
SOURCE = dict(source_id="s1", used_for_scoring="true", is_relevant="true", is_user_source="true", suspected_promotion="false", access_status="full", content_layer="user_review", score_scope="direct", entity_level="", platform_id="p", declared_platform_id="", canonical_url="u", normalized_url_sha256=hashlib.sha256(b"u").hexdigest())
HUMAN = dict(semantic_review_status="human_confirmed", adjudication_status="human_confirmed", review_origin="trusted_human_input", review_provenance_valid="true", reviewer_id="r", review_record_id="i", review_decision_time="2024-01-03T00:00:00Z", review_provenance_sha256="h")
NATIVE = dict(semantic_method="source_native_numeric", unit_type="source_native_numeric", content_layer="rating_only", native_rating_value="4", native_rating_scale_min="1", native_rating_scale_max="5", native_rating_normalized="2.5")
CASES = [
    ({}, {}, []), (HUMAN, {}, []), ({**NATIVE}, dict(content_layer="rating_only", access_status="metadata_only"), []), (dict(collision_status="verified_independent_occurrence"), {}, ["collision_review_provenance_invalid"]), (dict(used_for_scoring="?"), {}, ["not_marked_for_scoring"]), (dict(is_valid=None), {}, ["invalid_evidence"]),
    (dict(is_direct_place_evidence="no"), {}, ["not_direct_place_evidence"]), (dict(score_scope=""), {}, ["score_scope_not_direct"]), (dict(entity_level="area_aggregate"), {}, ["aggregate_area_evidence"]), (dict(source_block_type="user_review", source_block_is_user_generated="false"), {}, ["content_qualification_conflict"]),
    (dict(primary_dimension="z"), {}, ["invalid_primary_dimension"]), (dict(evidence_id=" "), {}, ["missing_evidence_id"]), (dict(dedup_key=None), {}, ["missing_dedup_key"]), (dict(semantic_method=""), {}, ["semantic_method_not_formally_scorable"]), (dict(evidence_reliability="0.5", aggregation_weight="0.4"), {}, ["evidence_reliability_below_threshold"]),
    (dict(sentiment_score="6", semantic_score_final="6"), {}, ["missing_or_invalid_scoring_value"]), ({**NATIVE, "native_rating_value": "9"}, dict(content_layer="rating_only"), ["invalid_native_numeric_scale"]), ({**NATIVE, "native_rating_scale_max": ""}, dict(content_layer="rating_only"), ["invalid_native_numeric_scale", "incomplete_native_numeric_scale"]),
    (dict(aggregation_weight="0"), {}, ["missing_aggregation_weight"]), (dict(semantic_review_status="pending"), {}, ["semantic_review_not_confirmed"]), ({**HUMAN, "reviewer_id": ""}, {}, ["review_provenance_invalid"]), ({**HUMAN, "review_decision_time": "2024-01-01T00:00:00Z"}, {}, ["review_provenance_invalid"]),
    (dict(semantic_confidence="0.7", aggregation_weight="0.56"), {}, ["semantic_confidence_below_threshold"]), (dict(aspect_confidence="nan"), {}, ["dimension_confidence_below_threshold"]), (dict(aggregation_weight="0.7"), {}, ["aggregation_weight_mismatch"]), (dict(semantic_score_final="1"), {}, ["semantic_final_score_mismatch"]),
    (dict(figurative_risk="true"), {}, ["figurative_risk_not_human_confirmed"]), ({**HUMAN, "figurative_risk": "true"}, {}, []), (dict(semantic_unit_text=" "), {}, ["missing_semantic_unit_text"]), (dict(semantic_rule_trace=""), {}, ["missing_semantic_rule_trace"]), (dict(original_summary_text=""), {}, ["missing_original_summary_text"]), (dict(excerpt_or_summary=""), {}, ["missing_excerpt_or_summary"]),
    (dict(source_id="s2"), {}, ["missing_linked_source"]), (dict(source_id=None), {}, ["missing_linked_source"]), ({}, dict(normalized_url_sha256="x"), ["source_normalized_url_hash_invalid"]), ({}, dict(used_for_scoring=""), ["source_not_marked_for_scoring"]), ({}, dict(is_relevant="false"), ["source_not_relevant"]),
    ({}, dict(suspected_promotion=""), ["source_promotional_or_unknown"]), ({}, dict(access_status="blocked"), ["source_not_readable"]), ({}, dict(score_scope="x"), ["source_scope_not_direct"]), ({}, dict(entity_level="area_aggregate"), ["source_is_area_aggregate"]), (dict(platform_id=""), dict(platform_id=""), ["source_platform_missing"]), ({}, dict(declared_platform_id="q"), ["platform_conflict"]),
    (dict(source_block_type="heading"), dict(is_user_source="0"), ["content_qualification_conflict", "source_not_user_evidence"]), (dict(unit_type="heading"), {}, ["unit_type_not_scorable"]),
]
TEXT = ", ".join


@pytest.fixture(scope="module")
def found(spark):
    evidence = [{**GOOD, **e, "case": str(k), "source_id": f"{k}-{(e.get('source_id', 's1'))}" if e.get("source_id", "s1") else None} for k, (e, _, _) in enumerate(CASES)]
    sources = [{**SOURCE, **s, "source_id": f"{k}-s1"} for k, (_, s, _) in enumerate(CASES)]
    frame = lambda rows: spark.createDataFrame([tuple(r.values()) for r in rows], TEXT(f"{c} string" for c in rows[0]))
    rows = eligibility.judged(frame(evidence), frame([*sources, sources[0]]), ("a", "b")).collect()
    assert len(rows) == len(CASES)
    return {int(r.case): r for r in rows}


@pytest.mark.parametrize("k", range(len(CASES)))
def test_each_rule(found, k):
    assert sorted(found[k].reasons) == sorted(CASES[k][2])
    assert found[k].eligible == (not CASES[k][2])


def test_every_code_is_broken_somewhere(spark):
    evidence = spark.createDataFrame([("s",)], "source_id string")
    told = set(eligibility.rules([*evidence.columns, "linked"], ("a",)))
    assert told == {code for *_, codes in CASES for code in codes}


def test_missing_columns_and_empty_tables(spark):
    evidence = spark.createDataFrame([("s",), (None,)], "source_id string")
    got = eligibility.judged(evidence, spark.createDataFrame([], "source_id string"), ("a",)).collect()
    assert len(got) == 2 and all("missing_linked_source" in r.reasons and r.direction == "not_scored" for r in got)
    assert eligibility.judged(evidence.limit(0), evidence, ("a",)).count() == 0
