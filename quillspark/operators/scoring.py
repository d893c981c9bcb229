"""Scoring: eligible units to cells, platforms, dimensions and a composite.

A unit has platform, dim, s (score -5..5), w (weight 0..1), dedup key and an input order. Missing stays
missing: a cell under its minimum has no score, a composite needs all dimensions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Weights of the seven dimensions, and the dimensions whose low scores are flagged.
DIMENSION_WEIGHTS = (0.15, 0.15, 0.20, 0.15, 0.10, 0.15, 0.10)
BOTTOM_LINE = (0, 3, 5)
MIN_UNITS = 3
MIN_EFFECTIVE = 5
CAP = 0.5
#: Confidence tiers, highest first: name, units, pages, categories, platforms.
TIERS = (("high", 60, 30, 5, 3), ("medium_high", 40, 20, 4, 3), ("medium", 25, 12, 3, 2))
#: Mention levels: least share, name.
MENTION = ((0.5, "A"), (0.3, "B"), (0.15, "C"), (0.05, "D"))


def weight_of(dim: Column) -> Column:
    return F.element_at(F.array(*[F.lit(w) for w in DIMENSION_WEIGHTS]), (dim + 1).cast("int"))


def half_away(x: Column) -> Column:
    """Round half away from zero."""
    return F.when(x >= 0, F.floor(x + F.lit(0.5))).otherwise(F.ceil(x - F.lit(0.5))).cast("long")


def one_decimal(x: Column) -> Column:
    return F.round(x + F.lit(1e-12), 1)


def first_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in an explicit order."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def cells(units: DataFrame, least: int = MIN_UNITS) -> DataFrame:
    """(platform, dim, n, tendency, conversion) of the cells with enough units.

    Sums are of decimals, so they do not depend on the order of rows.
    """
    exact = "decimal(38,10)"
    grouped = units.groupBy("platform", "dim").agg(
        F.count("*").alias("n"),
        F.sum((F.col("s").cast("decimal(18,5)") * F.col("w").cast("decimal(18,5)")).cast(exact)).alias("sw"),
        F.sum(F.col("w").cast("decimal(18,5)").cast(exact)).alias("sum_w"),
    )
    mean = F.col("sw").cast("double") / F.col("sum_w").cast("double")
    return (
        grouped.where((F.col("n") >= least) & (F.col("sum_w") > 0))
        .withColumn("tendency", half_away(mean))
        .withColumn("conversion", (F.col("tendency") + 5) * 10)
        .select("platform", "dim", "n", "tendency", "conversion")
    )


def directions(units: DataFrame) -> DataFrame:
    """Positive, negative and neutral counts of each cell (A3)."""
    return units.groupBy("platform", "dim").agg(
        F.count_if(F.col("s") > 0).alias("positive"), F.count_if(F.col("s") < 0).alias("negative"), F.count_if(F.col("s") == 0).alias("neutral")
    )


def platform_scores(scored: DataFrame) -> DataFrame:
    """(platform, effective, dims, partial, full): weights renormalised over the dimensions present."""
    weight = weight_of(F.col("dim"))
    return scored.groupBy("platform").agg(
        F.sum("n").alias("effective"),
        F.count("*").alias("dims"),
        one_decimal(F.sum(weight * F.col("conversion")) / F.sum(weight)).alias("partial_score"),
    ).withColumn("full_score", F.when(F.col("dims") == len(DIMENSION_WEIGHTS), F.col("partial_score")))


def included(scores: DataFrame, least: int = MIN_EFFECTIVE) -> DataFrame:
    """The platforms with enough units, or all if none has."""
    any_large = F.max(F.col("effective") >= least).over(Window.partitionBy(F.lit(1)))
    return scores.withColumn("any_large", any_large).where("effective >= %d or not any_large" % least).drop("any_large")


def dimension_scores(scored: DataFrame, platforms: DataFrame) -> DataFrame:
    """(dim, platforms, score): the equal-weight mean over the included platforms (A10)."""
    kept = scored.join(platforms.select("platform"), "platform", "left_semi")
    return kept.groupBy("dim").agg(F.count("*").alias("platforms"), one_decimal(F.avg("conversion")).alias("score"))


def composite(dims: DataFrame) -> DataFrame:
    """One row: dimensions present, composite (null unless all are), flags of bottom-line dimensions at most 40."""
    return dims.agg(
        F.count("score").alias("dims"),
        F.sum(F.col("score") * weight_of(F.col("dim"))).alias("total"),
        F.array_join(F.sort_array(F.collect_list(F.when(F.col("dim").isin(*BOTTOM_LINE) & (F.col("score") <= 40), F.col("dim").cast("string")))), ",").alias("flags"),
    ).select("dims", F.when(F.col("dims") == len(DIMENSION_WEIGHTS), one_decimal(F.col("total"))).alias("composite"), "flags")


def capped_weights(counts: DataFrame, key: str = "platform", count: str = "effective", cap: float = CAP) -> DataFrame:
    """Shares of the counts with none over cap: what is over goes to the others by their counts.

    At most 1 / cap members can be capped, so the passes are unrolled. One member alone, or fewer than
    1 / cap, cannot be capped: weights are then null.
    """
    everyone = Window.partitionBy(F.lit(1))  # a row for each platform
    df = counts.select(key, F.col(count).cast("double").alias("_count")).withColumn("_fixed", F.lit(False))
    members = F.count("*").over(everyone)
    for _ in range(int(1 / cap) + 1):
        left = 1 - F.lit(cap) * F.count_if("_fixed").over(everyone)
        free = F.sum(F.when(~F.col("_fixed"), F.col("_count"))).over(everyone)
        share = F.when(F.col("_fixed"), F.lit(cap)).otherwise(left * F.col("_count") / free)
        df = df.withColumn("_share", share).withColumn("_fixed", F.col("_fixed") | (F.col("_share") > cap))
    feasible = (members >= 2) & (members * cap >= 1)
    return df.select(key, F.when(feasible, F.round("_share", 6)).alias("weight"))


def confidence_tier(units: Column, pages: Column, categories: Column, platforms: Column) -> Column:
    """The highest tier whose four minima hold (A5)."""
    out = F.lit("low")
    for name, *least in reversed(TIERS):
        holds = (units >= least[0]) & (pages >= least[1]) & (categories >= least[2]) & (platforms >= least[3])
        out = F.when(holds, name).otherwise(out)
    return out


def mention_level(share: Column) -> Column:
    """A to D by share, E if mentioned at all, else U."""
    out = F.when(share > 0, "E").otherwise("U")
    for least, name in reversed(MENTION):
        out = F.when(share >= least, name).otherwise(out)
    return out


def rescaled(value: Column, low: Column, high: Column) -> Column:
    """A native rating on -5..5; null outside its scale or for an empty scale (M4)."""
    return F.when((high > low) & value.between(low, high), -5 + 10 * (value - low) / (high - low))


def bounded(total: Column) -> Column:
    """5 x / sqrt(x^2 + 15), within -5..5 (M5)."""
    return F.greatest(F.lit(-5.0), F.least(F.lit(5.0), 5 * total / F.sqrt(total * total + 15)))


def sentiment_class(positive: Column, negative: Column, score: Column, hits: Column, neutral: Column) -> Column:
    """mixed, positive, negative, neutral or na (M9)."""
    minor, major = F.least(positive, negative), F.greatest(positive, negative)
    return (
        F.when((minor >= 1.0) & (minor >= 0.35 * major), "mixed")
        .when((hits > 0) & (score >= 0.5), "positive")
        .when((hits > 0) & (score <= -0.5), "negative")
        .when((hits > 0) | (neutral > 0), "neutral")
        .otherwise("na")
    )


def reliability(direct: Column, explicit: Column, relevance: Column, completeness: Column, time: Column, not_promotional: Column) -> Column:
    """Weighted sum of six parts (M6)."""
    return 0.25 * direct + 0.20 * explicit + 0.20 * relevance + 0.20 * completeness + 0.10 * time + 0.05 * not_promotional


def completeness(text: Column) -> Column:
    """Bands of the number of characters that are not white space."""
    n = F.length(F.regexp_replace(text, r"\s+", ""))
    return F.when(n >= 30, 1.0).when(n >= 15, 0.8).when(n >= 6, 0.6).when(n > 0, 0.3).otherwise(0.0)
