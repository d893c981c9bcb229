"""Agreement of coders: Cohen's kappa and Krippendorff's alpha."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cohen_kappa(pairs: DataFrame) -> DataFrame:
    """One row (n, observed, expected, kappa) of label pairs (a, b); null without pairs, 1 or null where chance is certain."""
    counted = pairs.groupBy("a", "b").agg(F.count("*").alias("n"))
    total = counted.agg(F.sum("n").alias("total"), F.sum(F.when(F.col("a") == F.col("b"), F.col("n")).otherwise(0)).alias("same"))
    left = counted.groupBy(F.col("a").alias("label")).agg(F.sum("n").alias("na"))
    right = counted.groupBy(F.col("b").alias("label")).agg(F.sum("n").alias("nb"))
    chance = left.join(right, "label").agg(F.sum(F.col("na") * F.col("nb")).alias("both"))
    both = total.join(chance, F.lit(True))  # one row each
    n = F.col("total").cast("double")
    po, pe = F.col("same") / n, F.coalesce("both", F.lit(0)) / (n * n)
    kappa = F.when(F.col("total") > 0, F.when(pe == 1, F.when(po == 1, 1.0)).otherwise((po - pe) / (1 - pe)))
    return both.select(F.coalesce("total", F.lit(0)).cast("long").alias("n"), F.round(po, 6).alias("observed"), F.round(pe, 6).alias("expected"), F.round(kappa, 6).alias("kappa"))


def krippendorff_alpha(ratings: DataFrame, levels: int | None = None) -> DataFrame:
    """One row (n, disagreement, expected, alpha) of (unit, label): nominal, or with levels the squared scaled rank distance.

    Units with one rating do not count. Pairs are weighted by 1 / (m - 1), counted by unit and label first,
    so a unit with many ratings gives as many rows as it has labels, not as pairs of ratings.
    """
    by_label = ratings.groupBy("unit", "label").agg(F.count("*").alias("k"))
    sized = by_label.join(by_label.groupBy("unit").agg(F.sum("k").alias("m")).where("m >= 2"), "unit")
    other = sized.select("unit", F.col("label").alias("label2"), F.col("k").alias("k2"))
    pairs = sized.join(other, "unit").select("label", "label2", (F.col("k") * F.when(F.col("label") == F.col("label2"), F.col("k2") - 1).otherwise(F.col("k2")) / (F.col("m") - 1)).alias("o"))
    coincidence = pairs.groupBy("label", "label2").agg(F.sum("o").alias("o"))
    margin = coincidence.groupBy("label").agg(F.sum("o").alias("n_label"))
    if levels is None:
        distance = lambda a, b: F.when(a == b, 0.0).otherwise(1.0)
    else:
        distance = lambda a, b: F.pow((a - b) / F.lit(float(levels - 1)), 2)
    seen = coincidence.agg(F.sum("o").alias("n"), F.sum(F.col("o") * distance(F.col("label"), F.col("label2"))).alias("d_o"))
    second = margin.select(F.col("label").alias("label2"), F.col("n_label").alias("n_label2"))
    chance = margin.join(second, F.lit(True)).agg(F.sum(F.col("n_label") * F.col("n_label2") * distance(F.col("label"), F.col("label2"))).alias("d_e"))  # labels are few
    n = F.col("n")
    do, de = F.col("d_o") / n, F.col("d_e") / (n * (n - 1))
    alpha = F.when(n > 1, F.when(de == 0, F.when(do == 0, 1.0)).otherwise(1 - do / de))
    return seen.join(chance, F.lit(True)).select(F.round("n", 6).alias("n"), F.round(do, 6).alias("disagreement"), F.round(de, 6).alias("expected"), F.round(alpha, 6).alias("alpha"))
