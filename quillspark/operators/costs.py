"""Costs, yields and error manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Counters that are unknown, not 0, as long as nothing was observed.
OPTIONAL = ("tokens", "credits", "model_turn_count", "admitted_sources")
#: Fixed values (R17): layers whose faults need a new run, and scopes that a rebuild mends.
UPSTREAM = ("capture", "canonical", "semantic", "scoring", "truth_freeze", "state")
DOWNSTREAM = ("generator_code", "report_narrative", "office_rebuild")
TOLERANCE = 0.15


def totals(events: DataFrame, counters: list[str], optional: tuple[str, ...] = OPTIONAL) -> DataFrame:
    """One row of sums over idempotent events (event_id, counters): a replayed event counts once.

    A counter of the optional ones that was never observed is null, the others are 0.
    """
    once = events.groupBy("event_id").agg(*[F.max(c).alias(c) for c in counters])
    return once.agg(*[(F.sum(c) if c in optional else F.coalesce(F.sum(c), F.lit(0))).alias(c) for c in counters])


def ratio(numerator: Column, denominator: Column) -> Column:
    """null where the denominator is unknown or 0."""
    return F.when(denominator != 0, numerator / denominator)


def regressions(baseline: DataFrame, current: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """(metric, baseline, current, growth) of metrics (metric, value) that grew beyond the tolerance."""
    old = baseline.select("metric", F.col("value").cast("double").alias("baseline")).where("baseline > 0")
    joined = old.join(current.select("metric", F.col("value").cast("double").alias("current")), "metric")
    return joined.where(F.col("current") > F.col("baseline") * (1 + tolerance)).withColumn("growth", F.col("current") / F.col("baseline") - 1)


def yields(pages: Column, eligible: Column, scored: Column, target: Column, page_budget: Column) -> Column:
    """struct of conversion rates, pages still needed and the forecast."""
    rate = F.when((pages > 0) & (scored > 0), scored / pages)
    needed = F.when(rate.isNotNull(), F.ceil(F.greatest(F.lit(0), target - scored) / rate))
    forecast = (
        F.when(needed.isNotNull() & page_budget.isNotNull() & (needed > page_budget), "estimated_budget_shortfall")
        .when((pages > 0) & (scored == 0), "zero_observed_yield")
        .when(page_budget.isNull(), "insufficient_budget_data")
        .otherwise("within_estimated_budget")
    )
    return F.struct(
        F.when(pages > 0, scored / pages).alias("scored_rate"), F.when(pages > 0, eligible / pages).alias("eligible_rate"), needed.cast("long").alias("pages_needed"), forecast.alias("forecast")
    )


def manifest(errors: DataFrame, run: str) -> DataFrame:
    """Errors (code, subsystem, origin, artifacts) with an id that is the same in every run of the same fault."""
    identity = F.concat_ws("|", F.lit(run), "code", "subsystem", "origin", F.array_join("artifacts", ","))
    return errors.withColumn("error_id", F.concat(F.lit("VAL-"), F.left(F.sha2(identity, 256), F.lit(16))))


def root_causes(named: DataFrame) -> DataFrame:
    """(origin, errors, kinds, ids_sha256): the manifest by the layer where faults began; ids are distinct faults, not rows."""
    distinct = named.groupBy("origin", "error_id").agg(F.count("*").alias("n"))
    return distinct.groupBy("origin").agg(F.sum("n").alias("errors"), F.count("*").alias("kinds"), F.sha2(F.array_join(F.array_sort(F.collect_list("error_id")), ","), 256).alias("ids_sha256"))


def repair_plan(errors: DataFrame) -> DataFrame:
    """One row (status, automatic, next_action): what may be done about all errors together.

    errors has origin, scope, upstream_valid and new_run.
    """
    facts = errors.agg(
        F.count("*").alias("n"),
        F.coalesce(F.bool_or("new_run"), F.lit(False)).alias("new_run"),
        F.coalesce(F.bool_or(F.col("origin").isin(*UPSTREAM) & ~F.col("upstream_valid")), F.lit(False)).alias("upstream"),
        F.coalesce(F.bool_and(F.col("upstream_valid") & F.col("scope").isin(*DOWNSTREAM)), F.lit(True)).alias("downstream"),
    )
    status = (
        F.when(F.col("new_run") | F.col("upstream"), "terminal_root_cause_requires_new_run")
        .when((F.col("n") > 0) & ~F.col("downstream"), "manual_code_fix_required")
        .when(F.col("n") > 0, "one_downstream_rebuild_permitted")
        .otherwise("no_repair_needed")
    )
    action = (
        F.when(status == "terminal_root_cause_requires_new_run", "start_new_independent_run_after_root_cause_fix")
        .when(status == "manual_code_fix_required", "repair_released_validator_or_generator_then_rerun_validation")
        .when(status == "one_downstream_rebuild_permitted", "rebuild_from_frozen_scoring_output")
        .otherwise("none")
    )
    return facts.select(status.alias("status"), (status == "one_downstream_rebuild_permitted").alias("automatic"), action.alias("next_action"))
