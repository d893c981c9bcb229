"""Lexicon sentiment and aspects.

The codebook is a table; codebook.Reader finds its terms in one pass over a text. That scan is the one
thing that Spark's expressions cannot say; it runs as an Arrow-batched UDF, and all that follows are columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.operators.codebook import RESULT, Codebook, Reader, as_arrow


#: Texts whose traces are held at once.
ROWS = 64


def lexicon(book: Codebook) -> Column:
    """A UDF from text to its sums, the cues of each dimension and the trace of its hits."""
    @F.arrow_udf(RESULT)
    def read(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        reader = Reader(book)
        for batch in texts:
            # traces are many times as large as texts: few rows at once
            for at in range(0, len(batch), ROWS):
                yield as_arrow([reader.read(t) for t in batch.slice(at, ROWS).to_pylist()])

    return read


def sentiment(units: DataFrame, book: Codebook | None = None, text: str = "text") -> DataFrame:
    """Add score (-5..5, rounded half away), sentiment class and the lexicon's sums."""
    from quillspark.operators import scoring

    found = units.withColumn("lexicon", lexicon(book or Codebook())(F.col(text)))
    found = found.withColumn("score_raw", scoring.bounded(F.col("lexicon.raw")))
    named = scoring.sentiment_class(F.col("lexicon.positive"), F.col("lexicon.negative"), F.col("score_raw"), F.col("lexicon.hits"), F.col("lexicon.neutral"))
    return found.withColumn("score", scoring.half_away(F.col("score_raw"))).withColumn("sentiment", named)


def aspects(units: DataFrame, book: Codebook | None = None, text: str = "text", declared: str | None = None) -> DataFrame:
    """Add aspect, aspect_basis, dominance, margin and aspect_confidence.

    The dimension with most cues is told by its name; of equal counts the last name wins. dominance is its
    share of all cues, margin how far the second is behind, as a share of its own count. declared names a
    column of declared dimensions: null and empty declare none, and a name that the codebook lacks has confidence 0.
    """
    book = book or Codebook()
    names = F.array(*[F.lit(n) for n in book.names()])
    found = units if "lexicon" in units.columns else units.withColumn("lexicon", lexicon(book)(F.col(text)))
    counted = F.reverse(F.array_sort(F.zip_with(F.col("lexicon.aspects"), names, lambda n, name: F.struct(n.alias("n"), name.alias("name")))))
    df = found.withColumn("_ranked", counted)
    first, second = F.get("_ranked", F.lit(0)), F.coalesce(F.get("_ranked", F.lit(1))["n"], F.lit(0))
    total = F.aggregate("lexicon.aspects", F.lit(0), lambda a, x: a + x)
    top = F.when(first["n"] > 0, first["name"])
    own = F.nullif(F.trim(F.col(declared).cast("string")), F.lit("")) if declared else F.lit(None).cast("string")
    basis = (
        F.when(own.isNotNull() & ~F.array_contains(names, own), "invalid_declared_dimension")
        .when(own == top, "declared+lexical_agreement")
        .when(own.isNotNull() & top.isNotNull(), "declared_lexical_conflict")
        .when(own.isNotNull(), "declared_only")
        .when(top.isNotNull(), "lexical_candidate")
        .otherwise("unresolved")
    )
    df = df.withColumns({"aspect_basis": basis, "dominance": F.when(total > 0, first["n"] / total).otherwise(0.0), "margin": F.when(total > 0, (first["n"] - second) / first["n"]).otherwise(0.0)})
    told = F.col("aspect_basis")
    aspect = F.when(told.isin("declared+lexical_agreement", "declared_lexical_conflict", "declared_only"), own).otherwise(top)
    confidence = (
        F.when(told == "declared+lexical_agreement", 0.65 + 0.2 * F.col("dominance") + 0.15 * F.col("margin"))
        .when(told == "lexical_candidate", 0.45 + 0.35 * F.col("dominance") + 0.2 * F.col("margin"))
        .when(told == "declared_lexical_conflict", 0.4)
        .when(told == "declared_only", 0.65)
        .otherwise(0.0)
    )
    df = df.withColumn("aspect", aspect).withColumn("aspect_confidence", confidence).drop("_ranked")
    return df if "lexicon" in units.columns else df.drop("lexicon")


def match_status(aspect_hits: Column, polarity_hits: Column) -> Column:
    """full_match, dimension_only, polarity_only or zero_hit."""
    return F.when((aspect_hits > 0) & (polarity_hits > 0), "full_match").when(aspect_hits > 0, "dimension_only").when(polarity_hits > 0, "polarity_only").otherwise("zero_hit")


def review(units: DataFrame) -> DataFrame:
    """Add method, review_reasons and review_status.

    units has text, native (rating or null), original (its text is the unit's own), valid, direct, user_unit,
    readable, user_source, promotion, sentiment, aspect, aspect_conflict, figurative, contrasts, confidence,
    reliability, aspect_confidence, match and candidates (of the profile match). Unknown flags fail.
    """
    from quillspark.operators.contracts import reasons

    present = F.trim(F.coalesce("text", F.lit(""))) != ""
    text = F.col("native").isNull() & present
    method = F.when(F.col("native").isNotNull(), "source_native_numeric").when(~present, "not_applicable").when(F.col("match") == "full_match", "rule_codebook").otherwise("coding_parse_fallback")
    partial = F.col("match") != "full_match"
    found = reasons(
        {
            "missing_visible_text": F.col("native").isNull() & ~present,
            "missing_original_summary_text": text & ~F.coalesce("original", F.lit(False)),
            "evidence_not_valid": text & ~F.coalesce("valid", F.lit(False)),
            "not_direct_place_evidence": text & ~F.coalesce("direct", F.lit(False)),
            "non_user_semantic_unit": text & ~F.coalesce("user_unit", F.lit(False)),
            "source_not_readable": text & ~F.coalesce("readable", F.lit(False)),
            "source_not_user_content": text & ~F.coalesce("user_source", F.lit(False)),
            "source_promotional": text & F.coalesce("promotion", F.lit(False)),
            "promotion_status_unknown": text & F.col("promotion").isNull(),
            "no_directional_cue": text & (F.col("sentiment") == "na"),
            "dimension_unresolved": text & F.col("aspect").isNull(),
            "dimension_conflict": text & F.col("aspect_conflict"),
            "figurative_or_sarcasm_risk": text & F.col("figurative"),
            "multiple_contrast_requires_review": text & (F.col("contrasts") > 1),
            "semantic_confidence_below_threshold": text & (F.col("confidence") < 0.72),
            "evidence_reliability_below_threshold": text & (F.col("reliability") < 0.55),
            "aspect_confidence_below_threshold": text & (F.col("aspect_confidence") < 0.60),
            "lexicon_zero_hit_coding_parse_started": text & (F.col("match") == "zero_hit"),
            "lexicon_partial_hit_coding_parse_started": text & partial & (F.col("match") != "zero_hit"),
            "coding_parse_unresolved": text & partial & (F.col("candidates") == 0),
            "coding_parse_candidate_requires_confirmation": text & partial & (F.col("candidates") > 0),
        }
    )
    status = F.when(~text, "not_applicable").when(F.size("review_reasons") == 0, "auto_eligible").otherwise("review_required")
    return units.withColumn("method", method).withColumn("review_reasons", found).withColumn("review_status", status)


def derived(units: DataFrame) -> DataFrame:
    """Add what each method makes of a unit: basis, final score, told confidence and weight.

    units has method, sentiment_basis, score_raw, score, stance (of a hand coding), declared (its sentiment),
    confidence, reliability and polarity_candidate. A fallback is never scored and its confidence is capped at 0.71.
    """
    method = F.col("method")
    rule, native, hand, fallback = method == "rule_codebook", method == "source_native_numeric", method.isin("manual_code", "assisted_semantic"), method == "coding_parse_fallback"
    signed = F.when(F.col("declared") == "neutral", 0).when(F.col("declared") == "positive", F.col("stance")).otherwise(-F.col("stance"))
    return (
        units.withColumn("basis", F.when(hand, "human_confirmed_review").when(fallback & F.col("polarity_candidate"), "coding_parse_candidate").when(rule | fallback, F.col("sentiment_basis")).otherwise(method))
        .withColumn("score_final", F.when(hand, signed).when(rule, F.col("score")).cast("long"))
        .withColumn("told_confidence", F.when(fallback, F.least(F.col("confidence"), F.lit(0.71))).when(rule | hand, F.col("confidence")))
        .withColumn("weight", F.when(native, F.col("reliability")).when(rule | hand, F.col("confidence") * F.col("reliability")))
    )


def profile_matches(units: DataFrame, profiles: DataFrame, k: int = 3, least: float = 0.12, strong: float = 0.28) -> DataFrame:
    """(id, kind, concept, similarity, strength, place): the best k profiles of each kind for each unit.

    units has id and tokens, profiles has kind, concept and tokens: a codebook of tens of rows. Pairs are made
    by an equi-join on tokens, so units and profiles without a common one never meet.
    """
    from pyspark.sql import Window

    own = units.select("id", F.size("tokens").alias("n"), F.explode("tokens").alias("token"))
    listed = profiles.select("kind", "concept", F.size("tokens").alias("m"), F.explode("tokens").alias("token"))
    shared = own.join(listed, "token").groupBy("id", "kind", "concept").agg(F.count("*").alias("both"), F.first("n").alias("n"), F.first("m").alias("m"))
    both = F.col("both")
    score = F.round(0.7 * both / F.least("n", "m") + 0.3 * both / (F.col("n") + F.col("m") - both), 6)
    place = F.row_number().over(Window.partitionBy("id", "kind").orderBy(F.desc("similarity"), "concept"))
    kept = shared.withColumn("similarity", score).where(F.col("similarity") >= least).withColumn("place", place).where(F.col("place") <= k)
    return kept.select("id", "kind", "concept", "similarity", F.when(F.col("similarity") >= strong, "strong").otherwise("weak").alias("strength"), "place")


def completeness(text: Column, least: int = 6) -> Column:
    """How whole a text is by its characters that are no white space: 1 from 30 on, 0.8 from 15, 0.6 from the least on, 0.3 below, 0 for none."""
    n = F.length(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", ""))
    return F.when(n >= 30, 1.0).when(n >= 15, 0.8).when(n >= least, 0.6).when(n > 0, 0.3).otherwise(0.0)


#: Bases of an aspect that make a rule unclear.
UNCLEAR = ("declared_lexical_conflict", "invalid_declared_dimension", "unresolved")


def confidence(units: DataFrame, text: str = "text", fallback: Column | None = None) -> DataFrame:
    """Add confidence (M7): a weighted sum over polarity cues, aspect_confidence, completeness and clarity.

    units has lexicon, sentiment and what aspects() adds. Clarity loses 0.15 for mixed polarity, 0.35 for figurative cues, 0.25 for an
    aspect in conflict, invalid or unresolved, 0.1 for more than one contrast, and is 0 for no text. Where
    fallback holds, confidence is at most 0.71.
    """
    cues = F.when(F.col("lexicon.hits") >= 2, 1.0).when(F.col("lexicon.hits") == 1, 0.75).when(F.col("lexicon.neutral") > 0, 0.45).otherwise(0.15)
    lost = lambda condition, share: F.when(condition, share).otherwise(0.0)
    clarity = 1 - lost(F.col("sentiment") == "mixed", 0.15) - lost(F.col("lexicon.figurative") > 0, 0.35) - lost(F.col("aspect_basis").isin(*UNCLEAR), 0.25) - lost(F.col("lexicon.contrasts") > 1, 0.1)
    clarity = F.when(F.coalesce(F.col(text), F.lit("")) == "", 0.0).otherwise(F.greatest(clarity, F.lit(0.0)))
    total = 0.35 * cues + 0.30 * F.col("aspect_confidence") + 0.20 * completeness(F.col(text)) + 0.15 * clarity
    total = F.least(F.lit(1.0), F.greatest(F.lit(0.0), total))
    return units.withColumn("confidence", total if fallback is None else F.when(fallback, F.least(total, F.lit(0.71))).otherwise(total))
