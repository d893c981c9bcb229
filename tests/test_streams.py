"""Stateful streams against the batch operators on the same log."""

import random
from datetime import datetime, timedelta

import pytest

from quillspark.operators import execution
from quillspark.session import ship_package
from quillspark.streaming import events

START = datetime(2024, 1, 1)


def drained(spark, tmp_path, batches, schema, operator):
    """The rows that a stream over one file after the other gives."""
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / f"in-{k:03d}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in-*"))
    name = f"q{random.getrandbits(40)}"
    running = operator(stream).writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    running.awaitTermination(240)
    return spark.table(name).collect()


def plain_windows(runs):
    health, out, held = [], [], []
    for failed in runs:
        size = events.next_window(health)
        held.append(failed)
        if len(held) == size:
            out.append((len(health) + 1, size, not any(held)))
            health.append(not any(held))
            held = []
    return out


def test_adaptive_windows_are_those_of_the_batch(spark, tmp_path):
    ship_package(spark)
    rng = random.Random(5)
    runs = [(k, START + timedelta(seconds=i), i, None if rng.random() < 0.01 else rng.random() < (0.02 if i // 60 % 2 else 0.4)) for i in range(300) for k in ("a", "b")]
    batches = [runs[i : i + 150] for i in range(0, len(runs), 150)]
    got = drained(spark, tmp_path, batches, "key string, at timestamp, execution_id long, failed boolean", events.adaptive_windows)
    for key in "ab":
        found = sorted((r.nth, r.size, r.healthy) for r in got if r.key == key)
        assert found == plain_windows([f is None or f for k, _, _, f in runs if k == key])
        assert {s for _, s, _ in found} == {4, 6, 8}
        # the batch operator says the same of what comes next
        for n in (1, 2, 5, len(found) - 1):
            told = execution.window_size(spark.createDataFrame([(key, k, h) for k, _, h in found[:n]], "key string, seq long, healthy boolean")).first().size
            assert told == found[n][1]


def test_replays_are_settled_as_in_the_batch(spark, tmp_path):
    ship_package(spark)
    rng = random.Random(9)
    rows = [(i % 40, START + timedelta(seconds=30 * i), rng.choice(["x", "x", "x", "y", None]) if i % 3 else "x") for i in range(100)]
    last = (1000, START + timedelta(days=9), "end")
    got = drained(spark, tmp_path, [rows[:50], rows[50:], [last]], "event_id long, ts timestamp, payload string", events.settled)
    wanted = {r.event_id: r.rejected for r in execution.conflicting(spark.createDataFrame(rows, "event_id long, ts timestamp, payload string"), "event_id", "payload").collect()}
    assert {r.event_id: r.rejected for r in got} == wanted and any(wanted.values()) and not all(wanted.values())
    assert sum(r.n for r in got) == len(rows)


@pytest.mark.parametrize("health, size", [([], 6), ([True], 6), ([True, True], 8), ([True, False], 6), ([False, False], 4), ([False, False, True], 6)])
def test_next_window(health, size):
    assert events.next_window(health) == size
