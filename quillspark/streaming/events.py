"""Structured Streaming over an event log: counts in windows, idempotent events, route states.

The batch queries read logs whole; these are the same questions asked of a growing log.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

SCHEMA = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def read_events(spark: SparkSession, folder: str, files_per_trigger: int = 8) -> DataFrame:
    """A folder of Parquet files as a stream; the number of files a trigger bounds a batch."""
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def plausible(events: DataFrame, latest: str) -> DataFrame:
    """Events that are not later than a moment: future times are rejected."""
    return events.where(F.col("ts") <= F.lit(latest).cast("timestamp"))


def once(events: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Each event_id once within the watermark."""
    return events.withWatermark("ts", lateness).dropDuplicatesWithinWatermark(["event_id"])


def windowed(events: DataFrame, size: str = "1 hour", slide: str | None = None, lateness: str = "1 hour") -> DataFrame:
    """(begin, event_type, n, total) in tumbling or sliding windows."""
    window = F.window("ts", size, slide) if slide else F.window("ts", size)
    grouped = events.withWatermark("ts", lateness).groupBy(window.alias("w"), "event_type")
    return grouped.agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("begin"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", lateness: str = "1 hour") -> DataFrame:
    """(user_id, begin, end, n) of sessions that end after a gap."""
    grouped = events.withWatermark("ts", lateness).groupBy("user_id", F.session_window("ts", gap).alias("w"))
    return grouped.agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("begin"), F.col("w.end").alias("end"), "n")


def route_states(events: DataFrame) -> DataFrame:
    """(user_id, event_type, n, terminal): each chain's last state, terminal after two failures in a row."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, failures, n = state.get if state.exists else ("", 0, 0)
        rows: list[Any] = [r for b in batches for r in b.sort_values(["ts", "event_id"]).itertuples()]
        for row in sorted(rows, key=lambda r: (r.ts, r.event_id)):
            last, n = row.event_type, n + 1
            failures = failures + 1 if row.event_type == "error" else 0
        state.update((last, failures, n))
        yield pd.DataFrame({"user_id": [key[0]], "event_type": [last], "n": [n], "terminal": [failures >= 2]})

    return events.groupBy("user_id").applyInPandasWithState(
        step, "user_id long, event_type string, n long, terminal boolean", "last string, failures long, n long", "update", GroupStateTimeout.NoTimeout
    )


#: Sizes of a dispatch window after two that failed, at first or after one of each kind, and after two that did not.
LEAST_WINDOW, USUAL_WINDOW, MOST_WINDOW = 4, 6, 8


def next_window(health: list[bool]) -> int:
    """The size of the window after others, by the last two of them."""
    last = health[-2:]
    if len(last) < 2 or last[0] != last[1]:
        return USUAL_WINDOW
    return MOST_WINDOW if last[0] else LEAST_WINDOW


def adaptive_windows(runs: DataFrame) -> DataFrame:
    """(key, nth, size, healthy): the dispatch windows of each key as they fill; each one's size follows from the two before it.

    runs is a stream of (key, at, execution_id, failed). A window is healthy if none of its runs failed; a null failed
    counts as a failure. Runs are taken in the order of (at, execution_id) within a micro-batch and of micro-batches. The state of a key is
    five numbers, however many runs it has.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        nth, held, failures, before, last = state.get if state.exists else (1, 0, 0, -1, -1)
        rows = pd.concat([b[["at", "execution_id", "failed"]] for b in batches]).sort_values(["at", "execution_id"], kind="stable")
        out = []
        for failed in rows["failed"]:
            size = next_window([bool(x) for x in (before, last) if x >= 0])
            held, failures = held + 1, failures + (failed is None or failed != failed or bool(failed))
            if held == size:
                out.append((key[0], nth, size, not failures))
                nth, before, last, held, failures = nth + 1, last, int(not failures), 0, 0
        state.update((nth, held, failures, before, last))
        yield pd.DataFrame(out, columns=["key", "nth", "size", "healthy"])

    kind = runs.schema["key"].dataType.simpleString()
    return runs.groupBy("key").applyInPandasWithState(step, f"key {kind}, nth long, size long, healthy boolean", "nth long, held long, failures long, before long, last long", "append", GroupStateTimeout.NoTimeout)


def settled(events: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """(event_id, n, rejected): each event once it can't be replayed any more; one replayed with another payload is rejected, first copy included.

    events is a stream of (event_id, ts, payload). An event waits in the state, as the hash of its payload,
    until the watermark passes its last copy by the lateness; so nothing is given out that a later copy
    could contradict. A copy that comes later than that begins anew. Null payloads equal each other only.
    """
    told = F.sha2(F.coalesce(F.concat(F.lit("+"), F.col("payload").cast("string")), F.lit("-")), 256)
    rows = events.withWatermark("ts", lateness).select("event_id", "ts", told.alias("told"))
    kind = events.schema["event_id"].dataType.simpleString()

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            _, n, rejected, _ = state.get
            state.remove()
            yield pd.DataFrame({"event_id": [key[0]], "n": [n], "rejected": [rejected]})
            return
        first, n, rejected, latest = state.get if state.exists else ("", 0, False, 0)
        for batch in batches:
            for ts, payload in zip(batch["ts"], batch["told"], strict=True):
                first = first or payload
                n, rejected, latest = n + 1, rejected or payload != first, max(latest, int(ts.timestamp() * 1000))
        state.update((first, n, rejected, latest))
        state.setTimeoutTimestamp(max(latest, state.getCurrentWatermarkMs()) + 1)

    return rows.groupBy("event_id").applyInPandasWithState(step, f"event_id {kind}, n long, rejected boolean", "first string, n long, rejected boolean, latest long", "append", GroupStateTimeout.EventTimeTimeout)
