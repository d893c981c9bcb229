"""Eligibility of evidence for scoring: every rule over an evidence row and its source that a row breaks.

Cells are text, as ledgers have them; a missing column counts as empty. A cell that can't be read breaks the
rules that need it, so nothing becomes eligible by being unknown.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.times import strict_timestamp
from quillspark.operators.contracts import OTHER_BLOCKS, USER_BLOCKS, finite_double, reasons, tri_state, unit_reasons

#: Units, methods, reviews and access that can be scored, and the thresholds.
UNITS = ("page_body", "user_post", "user_review", "comment", "reply")
NATIVE = "source_native_numeric"
PROHIBITED = ("coding_parse_fallback", "not_applicable", "")
REVIEWED = ("auto_eligible", "human_confirmed")
ACCESS = ("full", "partial")
LEAST_RELIABILITY, LEAST_CONFIDENCE, LEAST_ASPECT, NEUTRAL, MOST_SCORE = 0.55, 0.72, 0.60, 0.5, 5.0
REVIEW_CELLS = ("reviewer_id", "review_record_id", "review_decision_time", "review_provenance_sha256")
BINDING = ("source_block_id", "source_block_type", "source_block_is_user_generated", "locator_sha256")


def _cells(columns: list[str], prefix: str = "") -> Callable[[str], Column]:
    return lambda name: F.trim(F.coalesce(F.col(prefix + name).cast("string"), F.lit(""))) if prefix + name in columns else F.lit("")


def _true(flag: Column) -> Column:
    return F.coalesce(flag, F.lit(False))


def _below(value: Column, least: float) -> Column:
    return F.coalesce(value < least, F.lit(True))


def trusted_review(e: Callable[[str], Column], s: Callable[[str], Column]) -> Column:
    """Whether a person's review is told in full, has a valid proof, and was decided after what it reviews was captured."""
    decided = strict_timestamp(e("review_decision_time"))
    told = (e("semantic_review_status") == "human_confirmed") & (e("adjudication_status") == "human_confirmed") & (e("review_origin") == "trusted_human_input") & _true(tri_state(e("review_provenance_valid")))
    for name in REVIEW_CELLS:
        told &= e(name) != ""
    for given in (e("retrieved_at"), e("captured_at"), e("recorded_at"), s("retrieved_at"), s("captured_at")):
        told &= (given == "") | _true(decided >= strict_timestamp(given))
    return told & decided.isNotNull()


def rules(columns: list[str], dimensions: tuple[str, ...], prefix: str = "source_row_") -> dict[str, Column]:
    """Code -> whether a row breaks it, over evidence cells and source cells with a prefix; `linked` tells whether there is a source."""
    e, s, linked = _cells(columns), _cells(columns, prefix), F.col("linked")
    number, flag = (lambda name: finite_double(e(name))), (lambda name: tri_state(e(name)))
    method, unit = e("semantic_method"), e("unit_type")
    native, coded = method == NATIVE, ~method.isin(NATIVE, *PROHIBITED)
    score = F.when(native, number("native_rating_normalized")).otherwise(number("sentiment_score"))
    reliability, confidence, weight = number("evidence_reliability"), number("semantic_confidence"), number("aggregation_weight")
    low, value, high = number("native_rating_scale_min"), number("native_rating_value"), number("native_rating_scale_max")
    bound = F.lit(False)
    for name in BINDING:
        bound = bound | (e(name) != "")
    layer = F.when(~bound & (e("content_layer") == ""), s("content_layer")).otherwise(e("content_layer"))
    typed = s("content_layer").isin("page_body", *USER_BLOCKS, *OTHER_BLOCKS)
    block = F.when(bound, e("source_block_type")).when(typed, s("content_layer")).otherwise("")
    by_user = F.when(bound, flag("source_block_is_user_generated")).when(typed, tri_state(s("is_user_source")))
    metadata = native & (s("access_status") == "metadata_only") & (s("content_layer") == "rating_only")
    told = lambda name: linked & ~_true(tri_state(s(name)))
    return {
        "collision_review_provenance_invalid": (e("collision_status") == "verified_independent_occurrence") & ~_true(flag("collision_review_valid")),
        "not_marked_for_scoring": ~_true(flag("used_for_scoring")),
        "invalid_evidence": ~_true(flag("is_valid")),
        "not_direct_place_evidence": ~_true(flag("is_direct_place_evidence")),
        "score_scope_not_direct": e("score_scope") != "direct",
        "aggregate_area_evidence": e("entity_level") == "area_aggregate",
        "content_qualification_conflict": F.size(unit_reasons(unit, layer, block, by_user, scoring=True)) > 0,
        "unit_type_not_scorable": ~(unit.isin(*UNITS) | native & (unit == NATIVE)),
        "invalid_primary_dimension": ~e("primary_dimension").isin(*dimensions),
        "missing_evidence_id": e("evidence_id") == "",
        "missing_dedup_key": e("dedup_key") == "",
        "semantic_method_not_formally_scorable": method.isin(*PROHIBITED),
        "evidence_reliability_below_threshold": _below(reliability, LEAST_RELIABILITY),
        "missing_or_invalid_scoring_value": ~_true(F.abs(score) <= MOST_SCORE),
        "invalid_native_numeric_scale": native & ~_true((low < high) & (low <= value) & (value <= high)),
        "incomplete_native_numeric_scale": native & (low.isNull() | value.isNull() | high.isNull() | number("native_rating_normalized").isNull()),
        "missing_aggregation_weight": (native | coded) & ~_true(weight > 0),
        "semantic_review_not_confirmed": coded & ~e("semantic_review_status").isin(*REVIEWED),
        "review_provenance_invalid": coded & (e("semantic_review_status") == "human_confirmed") & ~trusted_review(e, s),
        "semantic_confidence_below_threshold": coded & _below(confidence, LEAST_CONFIDENCE),
        "dimension_confidence_below_threshold": coded & _below(number("aspect_confidence"), LEAST_ASPECT),
        "aggregation_weight_mismatch": coded & _true(weight > 0) & _true(F.abs(weight - confidence * reliability) > F.greatest(F.lit(0.02), 1e-9 * F.greatest(F.abs(weight), F.abs(confidence * reliability)))),
        "semantic_final_score_mismatch": coded & ~_true(F.abs(number("semantic_score_final") - score) <= 1e-9),
        "figurative_risk_not_human_confirmed": coded & _true(flag("figurative_risk")) & (e("semantic_review_status") != "human_confirmed"),
        "missing_semantic_unit_text": coded & (e("semantic_unit_text") == ""),
        "missing_semantic_rule_trace": coded & (e("semantic_rule_trace") == ""),
        "missing_original_summary_text": ~native & (e("original_summary_text") == ""),
        "missing_excerpt_or_summary": ~native & (e("excerpt_or_summary") == ""),
        "missing_linked_source": ~linked,
        "source_normalized_url_hash_invalid": linked & ((s("canonical_url") == "") | (s("normalized_url_sha256") != F.sha2(s("canonical_url"), 256))),
        "source_not_marked_for_scoring": told("used_for_scoring"),
        "source_not_relevant": told("is_relevant"),
        "source_not_user_evidence": told("is_user_source"),
        "source_promotional_or_unknown": linked & ~_true(~tri_state(s("suspected_promotion"))),
        "source_not_readable": linked & ~s("access_status").isin(*ACCESS) & ~metadata,
        "source_scope_not_direct": linked & (s("score_scope") != "direct"),
        "source_is_area_aggregate": linked & (s("entity_level") == "area_aggregate"),
        "source_platform_missing": linked & (s("platform_id") == ""),
        "platform_conflict": linked & (e("platform_id") != "") & (e("platform_id") != F.when(s("declared_platform_id") != "", s("declared_platform_id")).otherwise(s("platform_id"))),
    }


def judged(evidence: DataFrame, sources: DataFrame, dimensions: tuple[str, ...]) -> DataFrame:
    """Evidence with reasons (every code, in the order of the rules), eligible and direction.

    Rows are joined to sources on source_id; of sources that repeat an id one counts, and a null or unknown id
    has none. Source cells are those of sources; canonical_url and platform_id are what the URL operators give.
    """
    prefix = "source_row_"
    once = sources.where("source_id is not null").dropDuplicates(["source_id"])
    named = once.select(F.col("source_id").alias("_source_id"), F.lit(True).alias("_there"), *[F.col(c).alias(prefix + c) for c in sources.columns])
    joined = evidence.join(named, evidence["source_id"] == named["_source_id"], "left").withColumn("linked", _true(F.col("_there")))
    read = _cells(joined.columns)
    score = F.when(read("semantic_method") == NATIVE, finite_double(read("native_rating_normalized"))).otherwise(finite_double(read("sentiment_score")))
    direction = F.when(score.isNull(), "not_scored").when(score >= NEUTRAL, "positive").when(score <= -NEUTRAL, "negative").otherwise("neutral")
    told = joined.withColumns({"reasons": reasons(rules(joined.columns, dimensions, prefix)), "direction": direction})
    return told.withColumn("eligible", F.size("reasons") == 0).select(*evidence.columns, "reasons", "eligible", "direction")
