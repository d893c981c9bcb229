"""Execution logs: retry chains, intents, running totals, routes, rounds and budgets (W*, A19, A20, A24, M13, O1, R9).

An execution has execution_id, chain (the query it belongs to), route, ts, retry_number, round, status,
gain. Order is always explicit; arrival order never counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def retry_audit(log: DataFrame, most: int = 1) -> DataFrame:
    """Add chain codes and chain_valid: numbers 0..n-1, at most one retry, each after the one before it ended."""
    order = Window.partitionBy("chain").orderBy("retry_number", "ts", "execution_id")
    whole = Window.partitionBy("chain")
    numbered = log.withColumn("expected", F.row_number().over(order) - 1).withColumn("previous_end", F.lag("end_ts").over(order))
    bad = {
        "number_gap": F.col("retry_number") != F.col("expected"),
        "too_many_retries": F.col("retry_number") > most,
        "overlaps_previous": F.coalesce(F.col("ts") < F.col("previous_end"), F.lit(False)),
        "duplicate_number": F.count("*").over(Window.partitionBy("chain", "retry_number")) > 1,
    }
    codes = F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in bad.items()]))
    checked = numbered.withColumn("codes", codes)
    return checked.withColumn("chain_valid", ~F.bool_or(F.size("codes") > 0).over(whole)).drop("expected", "previous_end")


def new_intents(log: DataFrame, intent: str = "intent") -> DataFrame:
    """Add is_new: the first execution of its intent in event order."""
    return log.withColumn("is_new", F.row_number().over(Window.partitionBy(intent).orderBy("ts", "execution_id")) == 1)


def running_total(log: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Add running: the sum of value so far within each group, in event order."""
    frame = Window.partitionBy(*by).orderBy("ts", "execution_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return log.withColumn("running", F.sum(value).over(frame))


def latest_state(log: DataFrame, route: str = "route", failing: tuple[str, ...] = ("blocked", "failed")) -> DataFrame:
    """(route, status, ts, terminal): the last state of each route; terminal if its last two failed."""
    back = Window.partitionBy(route).orderBy(F.desc("ts"), F.desc("execution_id"))
    recent = log.withColumn("back", F.row_number().over(back)).where("back <= 2")
    return recent.groupBy(route).agg(
        F.max_by("status", -F.col("back")).alias("status"),
        F.max("ts").alias("ts"),
        ((F.count("*") == 2) & F.bool_and(F.col("status").isin(*failing))).alias("terminal"),
    )


def low_yield(rounds: DataFrame, by: list[str], k: int, least: float) -> DataFrame:
    """(by, low): whether each of the last k rounds gained less than least; false with fewer rounds."""
    back = Window.partitionBy(*by).orderBy(F.desc("round"))
    recent = rounds.withColumn("back", F.row_number().over(back)).where(F.col("back") <= k)
    return recent.groupBy(*by).agg(((F.count("*") == k) & F.bool_and(F.col("gain") < least)).alias("low"))


def missing_numbers(df: DataFrame, by: list[str], number: str) -> DataFrame:
    """(by, number): the numbers from 1 to each group's largest that no row has."""
    spans = df.groupBy(*by).agg(F.max(number).alias("_most")).select(*by, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_most").cast("long"))).alias(number))
    return spans.join(df.select(*by, F.col(number).cast("long").alias(number)).distinct(), [*by, number], "left_anti")


def metrics(log: DataFrame, first: str, second: str) -> DataFrame:
    """Attempts, retries and distinct intents for each first, second, both and all."""
    sums = [
        F.count("*").alias("attempts"),
        F.count_if(F.col("retry_number") > 0).alias("retries"),
        F.count_distinct("intent").alias("intents"),
        F.grouping_id().alias("grain"),
    ]
    return log.groupingSets([[F.col(first)], [F.col(second)], [F.col(first), F.col(second)], []], F.col(first), F.col(second)).agg(*sums)


def over_budget(measured: DataFrame, limits: DataFrame, keys: list[str], counters: list[str]) -> DataFrame:
    """(keys, counter, actual, most): counters above their limit."""
    long = measured.unpivot(keys, counters, "counter", "actual")
    return long.join(F.broadcast(limits), "counter").where("actual > most")


def gap_matrix(scored: DataFrame, rows: DataFrame, columns: DataFrame, success: DataFrame, least: int) -> DataFrame:
    """Every (platform, dim) with its gap to the least count and marginal gain.

    rows and columns are the small lists of platforms and dimensions.
    """
    grid = F.broadcast(rows).join(F.broadcast(columns), F.lit(True))
    joined = grid.join(scored, ["platform", "dim"], "left").join(success, ["platform", "dim"], "left")
    gap = F.greatest(F.lit(0), F.lit(least) - F.coalesce("n", F.lit(0)))
    return (
        joined.withColumn("gap", gap.cast("long"))
        .withColumn("met", F.col("gap") == 0)
        .withColumn("gain", F.round((least - F.col("gap") + 1) / least + F.coalesce("success_rate", F.lit(0.0)), 6))
        .select("platform", "dim", "met", "gap", "gain")
    )


#: Fixed values (R9): outcomes of retrieval in the order in which they are tried, and whether each ends it.
OUTCOMES = (
    ("unrecoverable_error", True),
    ("retrieval_control_invalid", False),
    ("target_met", True),
    ("dimension_exhausted_with_shortfall", True),
    ("all_dimensions_formally_terminal", True),
    ("round_sequence_incomplete", False),
    ("query_budget_reached_without_dimension_exhaustion", False),
    ("round_budget_reached_without_dimension_exhaustion", False),
    ("dimension_query_budgets_reached_without_exhaustion", False),
    ("source_blocked_pending_dimension_audit", False),
    ("route_exhausted_pending_dimension_audit", False),
    ("evidence_shortfall", False),
)


def termination(facts: dict[str, Column]) -> Column:
    """struct(outcome, terminal): the first of OUTCOMES whose fact is true; without any, evidence_shortfall."""
    missing = {name for name, _ in OUTCOMES[:-1]} - set(facts)
    if missing:
        raise ValueError(f"no fact for {sorted(missing)}")
    name = F.coalesce(*[F.when(facts[n], F.lit(n)) for n, _ in OUTCOMES[:-1]], F.lit(OUTCOMES[-1][0]))
    return F.struct(name.alias("outcome"), name.isin(*[n for n, ends in OUTCOMES if ends]).alias("terminal"))


def dimension_status(units: Column, medium: Column, high: Column, exhausted: Column) -> Column:
    """met_high, met_medium, restricted or open."""
    return F.when(units >= high, "met_high").when(units >= medium, "met_medium").when(exhausted, "restricted").otherwise("open")


def window_size(windows: DataFrame) -> DataFrame:
    """Next dispatch size of each key: 4 if its last two windows were unhealthy, 8 if both healthy, else 6."""
    back = Window.partitionBy("key").orderBy(F.desc("seq"))
    last = windows.withColumn("back", F.row_number().over(back)).where("back <= 2")
    two = F.count("*") == 2
    return last.groupBy("key").agg(F.when(two & ~F.bool_or("healthy"), 4).when(two & F.bool_and("healthy"), 8).otherwise(6).alias("size"))


def marginal(rounds: DataFrame, by: list[str], value: str) -> DataFrame:
    """Add gain: a round's largest value less that of the round before."""
    top = rounds.groupBy(*by, "round").agg(F.max(value).alias(value))
    return top.withColumn("gain", F.col(value) - F.coalesce(F.lag(value).over(Window.partitionBy(*by).orderBy("round")), F.lit(0)))


def budget_prefix(df: DataFrame, by: list[str], order: list[str], size: str, most_rows: int, most_size: int) -> DataFrame:
    """The leading rows of each group within a number of rows and a total size."""
    w = Window.partitionBy(*by).orderBy(*order)
    upto = F.sum(size).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumn("nth", F.row_number().over(w)).withColumn("upto", upto).where((F.col("nth") <= most_rows) & (F.col("upto") <= most_size))


def round_robin(df: DataFrame, group: str, order: list[str], budget: int) -> DataFrame:
    """The first budget rows when the groups take turns (W16, O4, O5): nth row of each group, groups in order."""
    nth = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn("turn", nth).where(F.col("turn") <= budget).orderBy("turn", group).limit(budget)


def conflicting(events: DataFrame, key: str, payload: str) -> DataFrame:
    """Events whose key was replayed with another payload: all of them are rejected (P5, X2). A null payload is one of its own."""
    same = Window.partitionBy(key)
    told = F.coalesce(F.concat(F.lit("+"), F.col(payload).cast("string")), F.lit("-"))
    return events.withColumn("rejected", F.min(told).over(same) != F.max(told).over(same))
