"""Sinks: ledgers, chained logs, snapshots and their manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_ledger(df: DataFrame, path: str) -> None:
    """A CSV ledger in a folder; Spark's committer makes the replacement whole or not at all."""
    df.write.mode("overwrite").option("header", True).csv(path)


def append_log(events: DataFrame, path: str) -> None:
    """Append rows of a chained log; operators.chains chains them and reads the log again."""
    events.write.mode("append").json(path)


def write_blobs(df: DataFrame, path: str, body: str = "body") -> None:
    """Content-addressed bodies: SC-<sha256>, one row each, in folders by hash prefix."""
    key = F.sha2(F.col(body).cast("binary"), 256)
    named = df.select(F.concat(F.lit("SC-"), key).alias("blob_id"), F.col(body).alias("body"), F.left(key, F.lit(2)).alias("prefix")).dropDuplicates(["blob_id"])
    named.write.mode("append").partitionBy("prefix").parquet(path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, sha256) of the files of a folder, read by Spark."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"))


def changed(before: DataFrame, after: DataFrame) -> DataFrame:
    """(path, change): files that were added, removed or altered between two manifests."""
    both = before.select("path", F.col("sha256").alias("old")).join(after.select("path", F.col("sha256").alias("new")), "path", "full")
    kind = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(F.col("old") != F.col("new"), "altered")
    return both.select("path", kind.alias("change")).where("change is not null")


def rule_table(spark: SparkSession, sections: dict[str, dict[str, float]]) -> DataFrame:
    """A codebook's sections as rows (section, term, weight)."""
    return spark.createDataFrame([(s, t, float(w)) for s, terms in sections.items() for t, w in sorted(terms.items())], "section string, term string, weight double")


def replace_all(spark: SparkSession, ledgers: dict[str, DataFrame], root: str) -> str:
    """Replace several ledgers together: all are written to a new version, and one appended row makes it the current one.

    A run that ends early leaves the old version current and an unused folder.
    """
    import uuid

    version = f"v-{uuid.uuid4().hex}"
    for name, df in ledgers.items():
        df.write.parquet(f"{root}/{version}/{name}")
    try:
        seq = spark.read.json(f"{root}/current", schema="seq long, version string").agg(F.max("seq")).first()[0] or 0
    except Exception as error:  # the first version has none before it
        if "PATH_NOT_FOUND" not in str(error):
            raise
        seq = 0
    spark.createDataFrame([(seq + 1, version)], "seq long, version string").coalesce(1).write.mode("append").json(f"{root}/current")
    return version


def current(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A ledger of the current version."""
    version = spark.read.json(f"{root}/current", schema="seq long, version string").orderBy(F.desc("seq"), F.desc("version")).first()["version"]
    return spark.read.parquet(f"{root}/{version}/{name}")
