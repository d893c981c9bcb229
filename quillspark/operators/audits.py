"""Audits of evidence: rollups, histograms, exhaustion and completion checks, status ladders."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.operators.contracts import reasons

#: Labels of confidence from the least on.
CONFIDENCE = ("none", "low", "medium", "medium_high", "high")
#: Dimension statuses that end the work on a dimension.
FINAL = ("sufficient", "sufficient_at_requested_target", "sufficient_at_medium_after_audit", "exhausted_with_shortfall", "retrieval_terminated_with_shortfall")


@dataclass(frozen=True)
class Checks:
    """What a dimension needs to count as searched out (R6), or as complete at medium."""

    rounds: int = 4
    queries: int = 8
    categories: int = 5
    low_yield: int = 2
    low_yield_rounds: int = 2
    pages: int = 12
    domains: int = 3
    page_categories: int = 3
    blocked_pages: int = 5
    blocked_domains: int = 2


EXHAUSTION = Checks()
MEDIUM = Checks(rounds=3, queries=10, categories=6, low_yield_rounds=3, pages=20, domains=5, page_categories=4, blocked_pages=10, blocked_domains=4)
MEDIUM_ROUNDS, SUBJECTS, TIMES = 5, 3, 3


def histograms(df: DataFrame, columns: list[str]) -> DataFrame:
    """(field, value, n) of each column in one pass (A22, A23); a null is a value of its own."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns])).alias("x")).select("x.*")
    return long.groupBy("field", "value").agg(F.count("*").alias("n"))


def key_figures(sources: DataFrame, evidence: DataFrame) -> DataFrame:
    """One row of the audit's figures.

    sources: entity, access, category, platform, published (text), user_source; evidence: dim, key, s, scored.
    """
    readable = F.col("access").isin("full", "partial")
    one = sources.agg(
        F.count_distinct("entity").alias("pages"),
        F.count_distinct(F.when(readable, F.col("entity"))).alias("readable_pages"),
        F.count_distinct("category").alias("categories"),
        F.count_distinct(F.when(readable, F.col("category"))).alias("readable_categories"),
        F.count_distinct(F.when(readable & F.col("user_source"), F.col("platform"))).alias("user_platforms"),
        F.array_sort(F.collect_set(F.when(F.col("published").rlike(r"^\d{4}(?:-\d{2}(?:-\d{2})?)?$"), F.left("published", F.lit(4))))).alias("years"),
    )
    two = evidence.where("scored").agg(
        F.count_distinct(F.struct("dim", "key")).alias("scored_units"),
        F.count_if(F.col("s") > 0).alias("positive"),
        F.count_if(F.col("s") < 0).alias("negative"),
        F.count_if(F.col("s") == 0).alias("neutral"),
    )
    return one.crossJoin(two)  # one row each


def search_checks(log: DataFrame, traced: DataFrame, gains: DataFrame, checks: Checks) -> DataFrame:
    """One row of check columns for each dimension of the log, and passed (R6; with MEDIUM, the common part of R7).

    log: dim, round (from 1), query, status, action, category. traced: dim, page, domain, category of the pages
    those queries led to. gains: dim, round, n of new evidence units.
    """
    by_round = log.groupBy("dim", "round").agg(
        F.count_distinct("query").alias("queries"), F.bool_and(F.col("status").isin("blocked", "no_results")).alias("empty"), F.bool_or(F.col("action") == "exhausted").alias("ended")
    )
    gained = by_round.join(gains, ["dim", "round"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    # at most as many rows as rounds in each array
    ordered = gained.groupBy("dim").agg(F.reverse(F.array_sort(F.collect_list(F.struct("round", "queries", "empty", "ended", "n")))).alias("r"))
    latest = F.slice("r", 1, checks.low_yield_rounds)
    rounds = ordered.select(
        "dim",
        (F.size("r") >= checks.rounds).alias("enough_rounds"),
        ((F.size("r") >= checks.rounds) & F.forall("r", lambda x: x["queries"] >= checks.queries)).alias("enough_queries"),
        F.col("r")[0]["ended"].alias("final_action_exhausted"),
        ((F.size(latest) == checks.low_yield_rounds) & F.forall(latest, lambda x: x["n"] < checks.low_yield)).alias("low_yield"),
        F.col("r")[0]["empty"].alias("blocked"),
    )
    categories = log.groupBy("dim").agg((F.count_distinct("category") >= checks.categories).alias("enough_categories"))
    pages = traced.groupBy("dim").agg(F.count_distinct("page").alias("pages"), F.count_distinct("domain").alias("domains"), F.count_distinct("category").alias("page_categories"))
    joined = rounds.join(categories, "dim").join(pages, "dim", "left").na.fill(0, ["pages", "domains", "page_categories"])
    low = F.col("low_yield") & (F.col("pages") >= checks.pages) & (F.col("domains") >= checks.domains) & (F.col("page_categories") >= checks.page_categories)
    blocked = F.col("blocked") & (F.col("pages") >= checks.blocked_pages) & (F.col("domains") >= checks.blocked_domains)
    passed = F.col("enough_rounds") & F.col("enough_queries") & F.col("enough_categories") & F.col("final_action_exhausted") & (F.col("low_yield_route") | F.col("blocked_route"))
    return (
        joined.withColumn("low_yield_route", low)
        .withColumn("blocked_route", blocked)
        .withColumn("passed", passed)
        .select("dim", "enough_rounds", "enough_queries", "enough_categories", "final_action_exhausted", "low_yield_route", "blocked_route", "passed")
    )


def medium_checks(log: DataFrame, traced: DataFrame, gains: DataFrame) -> DataFrame:
    """The checks of completion at medium (R7): log has also mode, polarity, subject and time; enhancement rounds are judged."""
    enhanced = log.where("mode = 'medium_enhancement'")
    base = search_checks(enhanced, traced, gains, MEDIUM).withColumnRenamed("passed", "_base")
    rounds = log.groupBy("dim").agg((F.count_distinct("round") >= MEDIUM_ROUNDS).alias("enough_total_rounds"))
    kinds = enhanced.groupBy("dim").agg(
        (F.bool_or(F.col("polarity") == "positive") & F.bool_or(F.col("polarity") == "negative")).alias("both_polarities"),
        (F.count_distinct("subject") >= SUBJECTS).alias("enough_subjects"),
        (F.count_distinct("time") >= TIMES).alias("enough_times"),
    )
    joined = base.join(rounds, "dim").join(kinds, "dim")
    return joined.withColumn("passed", F.col("_base") & F.col("enough_total_rounds") & F.col("both_polarities") & F.col("enough_subjects") & F.col("enough_times")).drop("_base")


def dimension_status(rank: Column, target: int, medium_audit: Column, exhausted: Column) -> Column:
    """The status of a dimension by its confidence rank, the rank asked for and the two audits."""
    reached = "sufficient_at_requested_target" if target == CONFIDENCE.index("medium") else "sufficient"
    medium = rank == CONFIDENCE.index("medium")
    return (
        F.when(rank >= target, reached)
        .when(medium & medium_audit, "sufficient_at_medium_after_audit")
        .when(medium, "needs_iteration")
        .when(exhausted, "exhausted_with_shortfall")
        .otherwise("needs_iteration")
    )


def lifecycle(status: Column, target_met: Column, medium_verified: Column, exhaustion_verified: Column, restricted_verified: Column, numeric: Column) -> Column:
    """struct(lifecycle, terminal, numeric, restricted): a status alone proves nothing without its verified fact."""
    name = (
        F.when(target_met & status.isin("sufficient", "sufficient_at_requested_target"), "requested_target_reached")
        .when((status == "sufficient_at_medium_after_audit") & medium_verified, "medium_audited_numeric_terminal")
        .when((status == "exhausted_with_shortfall") & exhaustion_verified, "verified_exhausted_shortfall")
        .when((status == "retrieval_terminated_with_shortfall") & restricted_verified, "retrieval_restricted_terminal")
        .when(status.isin(*FINAL, "needs_iteration", ""), "actionable")
        .otherwise("invalid")
    )
    restricted = name == "retrieval_restricted_terminal"
    return F.struct(
        name.alias("lifecycle"),
        (~name.isin("actionable", "invalid")).alias("terminal"),
        (name.isin("requested_target_reached", "medium_audited_numeric_terminal") | (restricted & numeric)).alias("numeric"),
        (restricted | (name == "verified_exhausted_shortfall")).alias("restricted"),
    )


def audit_status(errors: Column, bounded: Column, termination: Column, pending: Column, sample_met: Column, restricted_allowed: Column, exhausted: Column) -> Column:
    """struct(status, outcome) of the whole audit; the first rule that holds decides.

    pending and exhausted are numbers of dimensions; bounded says that retrieval ended within its bounds short of the target.
    """
    sample_exhausted = ~sample_met & restricted_allowed
    formal = termination == "all_dimensions_formally_terminal"

    def pick(status: str | Column, outcome: str | Column) -> Column:
        return F.struct(*[(F.lit(x) if isinstance(x, str) else x).alias(n) for x, n in ((status, "status"), (outcome, "outcome"))])

    return (
        F.when(errors > 0, pick("invalid", "invalid"))
        .when(bounded, pick("retrieval_terminated_with_shortfall", termination))
        .when(pending > 0, pick("needs_iteration", "continue_dimension_deep_search"))
        .when(formal, pick(F.when(sample_met, "valid").otherwise("valid_with_sample_shortfall"), "all_dimensions_formally_terminal"))
        .when(~sample_met & ~sample_exhausted, pick("needs_iteration", "continue_deep_search"))
        .when(sample_met & (exhausted == 0), pick("valid", "target_met"))
        .when(sample_met, pick("valid_with_dimension_shortfall", "dimension_exhausted_with_shortfall"))
        .when(exhausted == 0, pick("valid_with_sample_shortfall", "exhausted_with_shortfall"))
        .otherwise(pick("valid_with_sample_and_dimension_shortfall", "sample_and_dimension_exhausted_with_shortfall"))
    )


def restrict_unfinished(audit: DataFrame, stopped: Column) -> DataFrame:
    """Dimensions that still need iteration end as restricted when retrieval is stopped; a number is kept where the medium tier is met.

    audit has dim, status, rank, scored, pages, categories, platforms and numeric.
    """
    due = stopped & (F.col("status") == "needs_iteration")
    minimum = (F.col("rank") >= CONFIDENCE.index("medium")) & (F.col("scored") >= 25) & (F.col("pages") >= 12) & (F.col("categories") >= 3) & (F.col("platforms") >= 1)
    return audit.withColumn("numeric", F.when(due, minimum).otherwise(F.col("numeric"))).withColumn("status", F.when(due, "retrieval_terminated_with_shortfall").otherwise(F.col("status")))


def least_confidence(df: DataFrame, label: str) -> DataFrame:
    """One row: the least confidence label of all dimensions."""
    rank = F.array_position(F.array(*[F.lit(x) for x in CONFIDENCE]), F.col(label))
    return df.agg(F.min_by(label, rank).alias(label))


def verify_claims(claims: DataFrame, recomputed: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(keys, codes): claimed values that a recomputation does not give, missing and unfounded rows."""
    mine = recomputed.select(*keys, F.lit(True).alias("_there"), *[F.col(c).alias(f"_{c}") for c in columns])
    theirs = claims.select(*keys, F.lit(True).alias("_claimed"), *columns)
    joined = theirs.join(mine, keys, "full_outer")
    both = F.col("_there").isNotNull() & F.col("_claimed").isNotNull()
    codes = {"claim_missing": F.col("_claimed").isNull(), "claim_unfounded": F.col("_there").isNull()}
    codes |= {f"claim_differs:{c}": both & ~F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns}
    return joined.select(*keys, reasons(codes).alias("codes")).where("size(codes) > 0")


def displayed(conversion: Column, weight: Column) -> Column:
    """struct(tendency, contribution, shown): what a report prints of a score."""
    return F.struct((conversion / 10 - 5).alias("tendency"), (weight * conversion).alias("contribution"), F.round(conversion, 1).alias("shown"))
