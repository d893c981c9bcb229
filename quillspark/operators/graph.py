"""Connected components of a link table, by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.session import cut

#: Links at one node beyond which its label is copied, and the links dealt to the copies.
HOT = 1 << 16


def connected(links: DataFrame) -> DataFrame:
    """(node, label) of every node of links (a, b): the least node that it reaches.

    A node takes the least label among its neighbours and then the label of its label, so labels travel
    twice as far in each round. Each round is written to the shared folder and the next one reads it.
    A label that most nodes share is a hot key of the jump only: its side has one row, so the join can split it.
    """
    links = links.select("a", "b").where("a <> b")
    both = cut(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    degrees = both.groupBy("b").agg(F.count("*").alias("n"))
    skewed = (degrees.agg(F.max("n")).first()[0] or 0) > HOT
    hot = degrees.where(F.col("n") > HOT).select("b", F.ceil(F.col("n") / HOT).cast("int").alias("copies"))
    hot = cut(hot) if skewed else hot
    if skewed:  # the links of a hot node are dealt to copies of its label
        both = cut(both.join(hot, "b", "left").select("a", "b", F.pmod(F.xxhash64("a"), F.coalesce("copies", F.lit(1))).cast("int").alias("copy")))
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label"))
    while True:
        seen = labels.select(F.col("node").alias("b"), "label")
        if skewed:
            seen = seen.join(hot, "b", "left").select("b", "label", F.explode(F.sequence(F.lit(0), F.coalesce("copies", F.lit(1)) - 1)).alias("copy"))
        near = both.join(seen, ["b", "copy"] if skewed else ["b"]).groupBy("a").agg(F.min("label").alias("near"))
        hooked = labels.join(near, labels.node == near.a).select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        ahead = hooked.select(F.col("node").alias("label"), F.col("label").alias("further"))
        labels = cut(hooked.join(ahead, "label").select("node", F.least("label", "further").alias("label"), (F.least("label", "further") < F.col("old")).alias("moved")))
        if labels.where("moved").isEmpty():
            return labels.select("node", "label")
        labels = labels.select("node", "label")
