"""Query plans: the baseline matrix within its budget, and the queries of an iteration."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Dimensions that share queries of one mode.
CLUSTERS = ((0, 1), (2, 3), (4, 5, 6))


def matrix(names: DataFrame, modifiers: DataFrame) -> DataFrame:
    """(query, base, modifier, polarity, origin, seq) of every name (base, origin, n) with every modifier (modifier, polarity, origin, m) of its origin.

    Both are lists of tens of rows; the pairs of one origin are an equi-join. A query text that comes twice
    stays where it came first.
    """
    pairs = names.join(F.broadcast(modifiers), "origin")
    text = F.trim(F.regexp_replace(F.concat_ws(" ", "base", "modifier"), r"\s+", " "))
    rows = pairs.select(text.alias("query"), "base", "modifier", "polarity", "origin", (F.col("n") * 1000 + F.col("m")).alias("seq"))
    first = F.min(F.struct("seq", "base", "modifier", "polarity", "origin")).alias("x")
    return rows.groupBy("query").agg(first).select("query", "x.base", "x.modifier", "x.polarity", "x.origin", "x.seq")


def within_budget(rows: DataFrame, budget: int) -> DataFrame:
    """The plan's rows that fit a budget, numbered: mandatory ones first, then the groups in turns.

    Mandatory are all of source_diversity, the first of each (origin, base), and its first positive and negative.
    """
    group = Window.partitionBy("origin", "base").orderBy("seq")
    by_polarity = Window.partitionBy("origin", "base", "polarity").orderBy("seq")
    must = (F.col("origin") == "source_diversity") | (F.row_number().over(group) == 1) | (F.col("polarity").isin("positive", "negative") & (F.row_number().over(by_polarity) == 1))
    marked = rows.withColumn("mandatory", must)
    turn = F.when(F.col("mandatory"), 0).otherwise(F.row_number().over(Window.partitionBy("origin", "base", "mandatory").orderBy("seq")))
    # a group's first row is mandatory, so groups stand in the order of their first rows
    order = F.min("seq").over(Window.partitionBy("origin", "base"))
    chosen = marked.withColumn("turn", turn).withColumn("place", order).orderBy("turn", F.when(F.col("mandatory"), F.col("seq")).otherwise(F.col("place")), "seq").limit(budget)
    return chosen.withColumn("number", F.row_number().over(Window.orderBy("seq"))).drop("turn", "place")


def iteration(gaps: DataFrame, templates: DataFrame, executed: DataFrame) -> DataFrame:
    """(cluster, mode, intent, dims): the queries of a round.

    gaps: dim, mode, quota. templates: cluster, template, priority. executed: intent of earlier rounds. The
    dimensions of a cluster share queries of one mode; the nth query that is new is for those whose quota is n
    or more.
    """
    spark = gaps.sparkSession
    clusters = spark.createDataFrame([(d, c) for c, dims in enumerate(CLUSTERS) for d in dims], "dim int, cluster int")
    wanted = gaps.where("quota > 0").join(F.broadcast(clusters), "dim")
    most = wanted.groupBy("cluster", "mode").agg(F.max("quota").alias("most"))
    candidates = most.join(templates, "cluster").withColumn("intent", F.concat_ws(" ", F.col("template"), F.col("mode")))
    fresh = candidates.join(executed.select("intent").distinct(), "intent", "left_anti")
    nth = F.row_number().over(Window.partitionBy("cluster", "mode").orderBy("priority", "intent"))
    kept = fresh.withColumn("nth", nth).where(F.col("nth") <= F.col("most"))
    return kept.join(wanted, ["cluster", "mode"]).where(F.col("nth") <= F.col("quota")).groupBy("cluster", "mode", "intent").agg(F.array_sort(F.collect_list("dim")).alias("dims"))
