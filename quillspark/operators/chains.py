"""Hash chains of logs, the reading of cut logs, and chains of amendments.

A chain's hash can't be made in parallel: each event's covers the one before. Rows go to their chain's task
and are folded in order as they pass, so a task holds one hash however long its chain is. Checking needs no
fold: every event is checked against the hash that is told of the one before it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.session import cut

HASH, PREVIOUS = "event_sha256", "previous_event_sha256"
_FOLDED = ("_own", "_head", "_chain")


def _own(columns: list[str]) -> F.Column:
    """The digest of an event's columns; nulls differ from empty values, and no value can run into the next one."""
    parts = [F.coalesce(F.concat(F.octet_length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-")) for c in columns]
    return F.sha2(F.concat(*parts), 256)


def chained(events: DataFrame, by: str, seq: str, columns: list[str], heads: DataFrame | None = None) -> DataFrame:
    """Add previous_event_sha256 and event_sha256: sha256(previous hash | digest of the columns), '' before the first.

    heads (by, event_sha256) has the last hash of chains that go on, so appending batches equals building at
    once. Rows of a chain are folded in the order of seq, null first, and then of their digest; a null chain is a chain of its own.
    """
    spark = events.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    names = events.columns
    rows = events.withColumns({"_own": _own(columns), "_head": F.lit(None).cast("string")})
    if heads is not None:
        rows = rows.unionByName(heads.select(by, F.col(HASH).alias("_head")), allowMissingColumns=True)
    # a head stands before its chain's events
    rows = rows.withColumn("_chain", F.coalesce(F.sha2(F.col(by).cast("string"), 256), F.lit("")))
    dealt = rows.repartition(parts, "_chain").sortWithinPartitions("_chain", F.col("_head").desc_nulls_last(), F.col(seq).asc_nulls_first(), "_own")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain, last = None, ""
        for batch in batches:
            own, head, chains = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in _FOLDED)
            before, after = [], []
            for mine, start, now in zip(own, head, chains, strict=True):
                if now != chain:
                    chain, last = now, ""
                before.append(last)
                last = start if start is not None else hashlib.sha256(f"{last}|{mine}".encode()).hexdigest()
                after.append(last)
            out = [batch.column(batch.schema.get_field_index(c)) for c in names]
            told = pa.RecordBatch.from_arrays([*out, pa.array(before, pa.string()), pa.array(after, pa.string())], [*names, PREVIOUS, HASH])
            yield told.filter(pa.array([h is None for h in head]))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in events.schema.fields)
    return dealt.select(*names, *_FOLDED).mapInArrow(run, f"{kinds}, {PREVIOUS} string, {HASH} string")


def heads(log: DataFrame, by: str, seq: str) -> DataFrame:
    """(by, n, seq, event_sha256): the last event of each chain of a chained log in which no seq is told twice."""
    return log.groupBy(by).agg(F.count("*").alias("n"), F.max(seq).alias("seq"), F.max_by(HASH, seq).alias(HASH))


def broken(log: DataFrame, by: str, seq: str, columns: list[str], known: DataFrame | None = None) -> DataFrame:
    """Add faults, an array of codes, to the events of a chained log.

    number: seq does not count the chain's events from 1 (W14); previous_hash: the hash told of the event before
    is not its hash; event_hash: the event's columns give another hash. known (by, event_sha256) are heads that were recorded elsewhere: where a chain does not end in its own, its
    last event has the fault head_hash. Any change of an event's columns, its loss or its place shows.
    """
    order = Window.partitionBy(by).orderBy(F.col(seq).asc_nulls_first(), "_own")
    rows = log.withColumn("_own", _own(columns))
    before = F.coalesce(F.lag(HASH).over(order), F.lit(""))
    made = F.sha2(F.concat(F.col(PREVIOUS), F.lit("|"), F.col("_own")), 256)
    codes = {"number": F.col(seq) != F.row_number().over(order), "previous_hash": ~F.col(PREVIOUS).eqNullSafe(before), "event_hash": ~F.col(HASH).eqNullSafe(made)}
    if known is not None:
        rows = rows.withColumn("_last", F.lead(F.lit(1)).over(order).isNull()).join(known.select(F.col(by).alias("_of"), F.col(HASH).alias("_known")), F.col(by).eqNullSafe(F.col("_of")), "left").drop("_of")
        codes["head_hash"] = F.col("_last") & F.col("_known").isNotNull() & (F.col("_known") != F.col(HASH))
    return rows.withColumn("faults", F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in codes.items()]))).drop("_own", "_last", "_known")


def read_log(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """The whole records of a folder of JSON lines, and what is no record: (file, offset, length, reason, text).

    A last line without a line end is torn: its write was cut, so it is set aside even if it could be parsed.
    A whole line that is no JSON object is corrupt; empty lines are nothing. A file is not read into one
    row: a line is the last of its file if it is the last of its file's last split, and it is torn if the
    lines and their line ends make one byte more than the file has.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("nth"))
    ends = lines.groupBy("file").agg(F.sum(F.octet_length("value").cast("long") + 1).alias("bytes"), F.max(F.struct("split", "nth")).alias("last"))
    told = lines.join(ends, "file")
    torn = (F.struct("split", "nth") == F.col("last")) & (F.col("bytes") == F.col("size") + 1)
    row = F.from_json("value", schema)
    whole = F.get_json_object("value", "$").isNotNull() & F.ltrim("value").startswith("{")
    told = told.withColumn("reason", F.when(torn, "torn").when(F.trim(F.regexp_replace("value", r"\s+", "")) == "", "empty").when(~F.coalesce(whole, F.lit(False)), "corrupt"))
    records = told.where("reason is null").select(row.alias("r")).select("r.*")
    aside = told.where("reason in ('torn', 'corrupt')").select("file", F.when(F.col("reason") == "torn", F.col("size") - F.octet_length("value")).alias("offset"), F.octet_length("value").alias("length"), "reason", F.col("value").alias("text"))
    return records, aside


#: Rounds of pointer doubling at most: chains of 2^62 events.
MOST_ROUNDS = 62


def amendments(events: DataFrame) -> DataFrame:
    """Add root, rank, codes and effective to amendment events.

    events has event_id, target, previous (event_id of the amendment it follows, null or '' for none), seq,
    kind (retract or any other), old_sha256 and new_sha256. Codes of an event:
    missing_predecessor; other_target (it follows an event of another target); fork (an earlier event follows
    the same one, or the target has an earlier first event); reopened (it follows a retraction); record_hash (its old hash is not
    the new one of the event it follows); cycle (following back never ends).
    rank counts the events before it in its chain, root is the first of them; both are null in a cycle. An
    event is effective if neither it nor an event before it in its chain has a code. Rejected corrections have no part in it.

    Pointers are doubled: each round follows twice as many links, so a chain of n events takes log2(n) + 1
    rounds, each written to the shared folder. Of rows that repeat an event_id all but the one with the least seq are left out.
    """
    given = events.where("event_id is not null").withColumn("_nth", F.row_number().over(Window.partitionBy("event_id").orderBy(F.col("seq").asc_nulls_first(), "target", "previous"))).where("_nth = 1").drop("_nth")
    given = cut(given.withColumn("previous", F.nullif(F.col("previous").cast("string"), F.lit(""))).withColumn("event_id", F.col("event_id").cast("string")))
    parent = given.select(F.col("event_id").alias("previous"), F.col("target").alias("_target"), F.col("kind").alias("_kind"), F.col("new_sha256").alias("_new"), F.lit(True).alias("_there"))
    siblings = Window.partitionBy("target", "previous").orderBy(F.col("seq").asc_nulls_first(), "event_id")
    told = given.join(parent, "previous", "left").withColumn("_sibling", F.row_number().over(siblings))
    follows = F.col("previous").isNotNull()
    there = F.coalesce(F.col("_there"), F.lit(False))
    own = {
        "missing_predecessor": follows & ~there,
        "other_target": there & ~F.col("_target").eqNullSafe(F.col("target")),
        "fork": F.col("_sibling") > 1,
        "reopened": F.coalesce(F.col("_kind") == "retract", F.lit(False)),
        "record_hash": there & ~F.col("_new").eqNullSafe(F.col("old_sha256")),
    }
    told = told.withColumn("codes", F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in own.items()])))
    told = cut(told.select(*given.columns, "codes", there.alias("_follows")))

    # (event_id, ahead, root, rank, bad): ahead is the next event to follow to, bad the codes between
    state = told.select("event_id", F.when(F.col("_follows"), F.col("previous")).alias("ahead"), "event_id", F.lit(0).cast("long").alias("rank"), F.size("codes").cast("long").alias("bad")).toDF("event_id", "ahead", "root", "rank", "bad")
    state = cut(state.withColumns({"rank": F.when(F.col("ahead").isNotNull(), 1).otherwise(0).cast("long"), "root": F.coalesce("ahead", "event_id")}))
    ended = state.where("ahead is null")
    active = state.where("ahead is not null")
    most = max(1, told.count()).bit_length() + 1
    for _ in range(min(most, MOST_ROUNDS)):
        if active.isEmpty():
            break
        # every event that is followed to: those that have ended, and those on the way
        known = ended.unionByName(active).select(F.col("event_id").alias("ahead"), F.col("ahead").alias("_ahead"), F.col("root").alias("_root"), F.col("rank").alias("_rank"), F.col("bad").alias("_bad"))
        moved = cut(active.join(known, "ahead").select("event_id", F.col("_ahead").alias("ahead"), F.col("_root").alias("root"), (F.col("rank") + F.col("_rank")).alias("rank"), (F.col("bad") + F.col("_bad")).alias("bad")))
        ended, active = ended.unionByName(moved.where("ahead is null")), moved.where("ahead is not null")
    found = ended.select("event_id", "root", "rank", "bad")
    out = told.drop("_follows").join(found, "event_id", "left")
    codes = F.when(F.col("rank").isNull(), F.array_append("codes", F.lit("cycle"))).otherwise(F.col("codes"))
    return out.select(*given.columns, "root", "rank", codes.alias("codes"), F.coalesce(F.col("bad") == 0, F.lit(False)).alias("effective"))


def effective(told: DataFrame) -> DataFrame:
    """(target, event_id, kind, new_sha256): the amendment that holds for each target, the last effective one of its chain."""
    best = F.max_by(F.struct("event_id", "kind", "new_sha256"), F.struct("rank", "event_id"))
    return told.where("effective").groupBy("target").agg(best.alias("x")).select("target", "x.*")
