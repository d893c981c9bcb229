"""Budgets of retrieval: use at six grains, accounts, targets, quotas, schedules and waves."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.operators.contracts import reasons
from quillspark.operators.execution import new_intents

DIMENSIONS = 7
#: Scored units, source pages and source categories that a tier needs in each dimension.
TIERS = {"medium": (25, 12, 3), "medium_high": (40, 20, 4), "high": (60, 30, 5)}
RANKS = {"none": 0, "low": 1, "medium": 2, "medium_high": 3, "high": 4}


@dataclass(frozen=True)
class Budgets:
    """The most intents, attempts and retries of each grain, and the rounds that are due."""

    baseline: tuple[int, int, int] = (120, 144, 24)
    deep: tuple[int, int, int] = (300, 360, 60)
    total: tuple[int | None, int, int] = (None, 504, 84)
    round: tuple[int, int, int] = (60, 72, 12)
    dimension: tuple[int, int, int] = (48, 62, 14)
    dimension_round: tuple[int, int, int] = (10, 13, 3)
    rounds: int = 5
    queries_a_round: int = 8
    enhancement_rounds: int = 3
    queries_an_enhancement_round: int = 10
    low_gain_rounds: int = 2
    wave: int = 24


COUNTERS = ("intents", "attempts", "retries")
GRAINS = ("baseline", "deep", "total", "round", "dimension", "dimension_round")


def limits(spark: SparkSession, budgets: Budgets | None = None) -> DataFrame:
    """(grain, counter, most)."""
    budgets = budgets or Budgets()
    rows = [(g, c, n) for g in GRAINS for c, n in zip(COUNTERS, getattr(budgets, g), strict=True) if n is not None]
    return spark.createDataFrame(rows, "grain string, counter string, most long")


def used(log: DataFrame) -> DataFrame:
    """(grain, dim, round, counter, actual) of a log (execution_id, ts, intent, dims, round, retry).

    Round 0 is the baseline. An execution counts once in the grains without dimension and once in each of its
    dimensions; its intent is new where it stands first in event order. Two passes of grouping sets.
    """
    rows = new_intents(log).withColumn("phase", F.when(F.col("round") == 0, "baseline").otherwise("deep")).select("phase", "round", "dims", "is_new", "retry")
    sums = [F.count_if("is_new").alias("intents"), F.count("*").alias("attempts"), F.count_if("retry").alias("retries"), F.grouping_id().alias("_set")]
    phase, number, dim = F.col("phase"), F.col("round"), F.col("dim")
    whole = rows.groupingSets([[phase], [], [phase, number]], phase, number).agg(*sums)
    whole = whole.where("_set <> 0 or phase = 'deep'").select(
        F.when(F.col("_set") == 3, "total").when(F.col("_set") == 0, "round").otherwise(phase).alias("grain"), F.lit(None).cast("int").alias("dim"), F.when(F.col("_set") == 0, number).alias("round"), *COUNTERS
    )
    spread = rows.where("phase = 'deep'").withColumn("dim", F.explode(F.array_distinct("dims")))
    by_dim = spread.groupingSets([[dim], [dim, number]], dim, number).agg(*sums)
    by_dim = by_dim.select(F.when(F.col("_set") == 0, "dimension_round").otherwise("dimension").alias("grain"), "dim", "round", *COUNTERS)
    return whole.unionByName(by_dim).unpivot(["grain", "dim", "round"], list(COUNTERS), "counter", "actual")


def over(measured: DataFrame, most: DataFrame) -> DataFrame:
    """(grain, dim, round, counter, actual, most) of counters above their limit (A20). The limits are at most 18 rows."""
    return measured.join(F.broadcast(most), ["grain", "counter"]).where("actual > most")


def account(intent_used: Column, intent_limit: Column, attempt_used: Column, attempt_limit: Column, retry_used: Column, retry_limit: Column, now: Column, future: Column) -> Column:
    """struct of what is left and why a plan is infeasible; unused retries are reserved out of the attempts."""
    intents, attempts, retries = intent_limit - intent_used, attempt_limit - attempt_used, retry_limit - retry_used
    why = reasons(
        {
            "independent_intent_budget_infeasible": intents < now + future,
            "actual_attempt_budget_infeasible": attempts < now + future + F.greatest(F.lit(0), retries),
            "retry_budget_infeasible": retries < 0,
        }
    )
    return F.struct(intents.alias("intents_left"), attempts.alias("attempts_left"), retries.alias("retries_left"), (F.size(why) == 0).alias("feasible"), why.alias("reasons"))


def target_status(results: DataFrame, tier: str) -> DataFrame:
    """(dim, scored, required, gap, met, total, theoretical, target_met) of every dimension.

    results has dim, scored and rank (of RANKS). The total is told but never makes up for one dimension; a
    dimension without a row has nothing.
    """
    required = TIERS[tier][0]
    every = results.sparkSession.range(DIMENSIONS).select(F.col("id").cast("int").alias("dim"))
    joined = every.join(results, "dim", "left").withColumn("scored", F.coalesce("scored", F.lit(0)).cast("long"))
    met = (F.col("scored") >= required) & (F.coalesce("rank", F.lit(0)) >= RANKS[tier])
    whole = Window.partitionBy()  # seven rows
    return joined.withColumn("met", met).select(
        "dim", "scored", F.lit(required).alias("required"), F.greatest(F.lit(0), required - F.col("scored")).cast("long").alias("gap"), "met",
        F.sum("scored").over(whole).alias("total"), F.lit(required * DIMENSIONS).alias("theoretical"), F.bool_and("met").over(whole).alias("target_met"),
    )


def quota(used_now: Column, targeted: Column, enhanced: Column, enhancement: Column, budgets: Budgets | None = None) -> Column:
    """struct(reserved, available, quota, reached): queries of a dimension in this round, with what later mandatory rounds need set aside.

    targeted and enhanced are the numbers of rounds with this one; enhancement says whether this one is such.
    """
    b = budgets or Budgets()
    later = F.greatest(F.lit(0), b.rounds - targeted)
    later_enhanced = F.least(later, F.greatest(F.lit(0), b.enhancement_rounds - enhanced))
    reserved = later_enhanced * b.queries_an_enhancement_round + (later - later_enhanced) * b.queries_a_round
    available = F.greatest(F.lit(0), b.dimension[0] - used_now - reserved)
    wanted = F.when(enhancement, b.queries_an_enhancement_round).otherwise(b.queries_a_round)
    return F.struct(reserved.alias("reserved"), available.alias("available"), F.least(wanted, available).alias("quota"), (used_now >= b.dimension[0]).alias("reached"))


def schedule(state: DataFrame, budgets: Budgets | None = None) -> DataFrame:
    """(dim, round, enhancement, planned) of every round that is left to a dimension.

    state has dim, used (intents), done (rounds) and enhanced (rounds). A round is an enhancement as soon as
    the enhancement rounds still due fill all that are left.
    """
    b = budgets or Budgets()
    rounds = state.where(F.col("done") < b.rounds).withColumn("round", F.explode(F.sequence(F.col("done") + 1, F.lit(b.rounds).cast("long"))))
    enhancement = F.greatest(F.lit(0), b.enhancement_rounds - F.col("enhanced")) >= b.rounds + 1 - F.col("round")
    return rounds.withColumn("enhancement", enhancement).withColumn("planned", F.when(enhancement, b.queries_an_enhancement_round).otherwise(b.queries_a_round)).select("dim", "used", "round", "enhancement", "planned")


def feasibility(state: DataFrame, global_used: int, budgets: Budgets | None = None) -> DataFrame:
    """(scope, id, needed, most, feasible): the schedule against the budget of each dimension, each round and all."""
    b = budgets or Budgets()
    planned = schedule(state, b)
    dims = planned.groupBy(F.col("dim").cast("long").alias("id")).agg((F.max("used") + F.sum("planned")).alias("needed")).select(F.lit("dimension").alias("scope"), "id", "needed", F.lit(b.dimension[0]).alias("most"))
    rounds = planned.groupBy(F.col("round").alias("id")).agg(F.sum("planned").alias("needed")).select(F.lit("round").alias("scope"), "id", "needed", F.lit(b.round[0]).alias("most"))
    whole = planned.agg((F.coalesce(F.sum("planned"), F.lit(0)) + global_used).alias("needed")).select(F.lit("all").alias("scope"), F.lit(None).cast("long").alias("id"), "needed", F.lit(b.deep[0]).alias("most"))
    return dims.unionByName(rounds).unionByName(whole).withColumn("feasible", F.col("needed") <= F.col("most"))


def round_reasons(log: DataFrame, expected: int, budgets: Budgets | None = None) -> DataFrame:
    """(dim, round, intents, codes) of every dimension and round from 1 to expected.

    log has dims, round, mode, intent, is_new and coverage; a round without an execution is missing.
    """
    b = budgets or Budgets()
    spread = log.where("round > 0").withColumn("dim", F.explode(F.array_distinct("dims")))
    seen = spread.groupBy("dim", "round").agg(F.count_if(F.col("is_new") & F.col("coverage")).alias("intents"), F.count_distinct("mode").alias("modes"), F.max("mode").alias("mode"))
    spark = log.sparkSession
    grid = spark.range(DIMENSIONS).select(F.col("id").cast("int").alias("dim")).withColumn("round", F.explode(F.sequence(F.lit(1), F.lit(expected))))
    joined = grid.join(F.broadcast(seen), ["dim", "round"], "left")  # at most seven dimensions by the rounds
    least = F.when(F.col("mode") == "medium_enhancement", b.queries_an_enhancement_round).otherwise(b.queries_a_round)
    there = F.col("modes").isNotNull()
    codes = reasons(
        {
            "missing_rounds": ~there,
            "dimension_round_mode_conflict": there & (F.coalesce("modes", F.lit(1)) > 1),
            "dimension_round_mode_invalid": there & ~F.coalesce(F.col("mode").isin("evidence_gap_fill", "medium_enhancement"), F.lit(True)),
            "dimension_round_query_minimum_not_met": there & (F.coalesce("intents", F.lit(0)) < least),
        }
    )
    return joined.select("dim", "round", F.coalesce("intents", F.lit(0)).alias("intents"), codes.alias("codes"))


def wave_size(gap: Column, found: Column, attempts: Column, budgets: Budgets | None = None) -> Column:
    """How many further pages to read: the gap over the yield so far, at most a wave."""
    cap = (budgets or Budgets()).wave
    rate = found / F.greatest(F.lit(1), attempts)
    return F.when(rate > 0, F.least(F.lit(cap), F.ceil(gap / rate))).otherwise(cap).cast("int")


def wave(candidates: DataFrame, by: str, order: list[str], size: Column) -> DataFrame:
    """The candidates that the queries take in turns, the first of each, then the second, up to a size.

    No query gives more than a wave, so few rows are left before the last, global order.
    """
    turn = F.row_number().over(Window.partitionBy(by).orderBy(*order))
    first = candidates.withColumn("turn", turn).withColumn("_size", size).where(F.col("turn") <= F.col("_size"))
    place = F.row_number().over(Window.orderBy("turn", by))
    # as many rows as queries at most in the first turn, so a global limit on (turn, by) keeps one wave
    return first.orderBy("turn", by).limit(Budgets().wave).withColumn("place", place).where(F.col("place") <= F.col("_size")).drop("_size")
