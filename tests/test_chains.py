"""Chained logs, cut logs and amendment chains against plain Python."""

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from quillspark.operators import chains, execution
from quillspark.session import ship_package
from quillspark.sources import sinks

SCHEMA = "k string, seq long, body string, note string"
COLUMNS = ["body", "note"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def fold(bodies, last=""):
    out = []
    for values in bodies:
        own = sha("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in values))
        last = sha(f"{last}|{own}")
        out.append(last)
    return out


@pytest.fixture(scope="module")
def log(spark):
    ship_package(spark)
    rng = random.Random(3)
    rows = [(k, s, rng.choice(["a", "é|", "", None]), rng.choice(["x", None])) for k, n in (("a", 300), ("b", 1), (None, 3), ("", 2)) for s in range(1, n + 1)]
    rng.shuffle(rows)
    return rows


def by_chain(rows):
    return {k: [r[2:4] for r in sorted(r for r in rows if r[0] == k)] for k in {r[0] for r in rows}}


@pytest.mark.parametrize("parts", ["1", "5"])
def test_chain_carries_every_hash_on(spark, log, parts):
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = chains.chained(spark.createDataFrame(log, SCHEMA), "k", "seq", COLUMNS).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    for k, bodies in by_chain([(r[0], r[1], *r[2:]) for r in log]).items():
        hashes = [r.event_sha256 for r in sorted((r for r in got if r.k == k), key=lambda r: r.seq)]
        assert hashes == fold(bodies)
        assert [r.previous_event_sha256 for r in sorted((r for r in got if r.k == k), key=lambda r: r.seq)] == ["", *hashes[:-1]]


def test_an_edit_changes_every_later_hash(spark, log):
    rows = [("a", s, "b", None) for s in range(1, 50)]
    edited = [(k, s, "c" if s == 20 else b, n) for k, s, b, n in rows]
    one, two = ([r.event_sha256 for r in chains.chained(spark.createDataFrame(x, SCHEMA), "k", "seq", COLUMNS).orderBy("seq").collect()] for x in (rows, edited))
    assert one[:19] == two[:19] and not set(one[19:]) & set(two[19:])


def test_appending_equals_building_at_once(spark, log, tmp_path):
    frame = spark.createDataFrame([r for r in log if r[0] is not None], SCHEMA)
    whole = {(r.k, r.seq): r.event_sha256 for r in chains.chained(frame, "k", "seq", COLUMNS).collect()}
    path = str(tmp_path / "log")
    told = f"{SCHEMA}, previous_event_sha256 string, event_sha256 string"
    for low, high in ((0, 1), (1, 170), (170, 1000)):
        batch = frame.where((F.col("seq") > low) & (F.col("seq") <= high))
        before = chains.heads(chains.read_log(spark, path, told)[0], "k", "seq") if low else None
        sinks.append_log(chains.chained(batch, "k", "seq", COLUMNS, before), path)
    records, aside = chains.read_log(spark, path, told)
    assert {(r.k, r.seq): r.event_sha256 for r in records.collect()} == whole and aside.count() == 0
    assert chains.broken(records, "k", "seq", COLUMNS).where("size(faults) > 0").count() == 0


def test_faults_of_altered_and_lost_events(spark, log):
    whole = chains.chained(spark.createDataFrame([("a", s, f"b{s}", None) for s in range(1, 9)], SCHEMA), "k", "seq", COLUMNS)
    heads = chains.heads(whole, "k", "seq")
    faults = lambda log: {r.seq: r.faults for r in chains.broken(log, "k", "seq", COLUMNS, heads).collect() if r.faults}
    assert faults(whole) == {}
    assert faults(whole.withColumn("body", F.when(F.col("seq") == 3, "x").otherwise(F.col("body")))) == {3: ["event_hash"]}
    assert faults(whole.where("seq <> 3")) == {4: ["number", "previous_hash"], 5: ["number"], 6: ["number"], 7: ["number"], 8: ["number"]}
    assert faults(whole.where("seq < 8")) == {7: ["head_hash"]}
    forged = chains.chained(whole.select("k", "seq", F.when(F.col("seq") == 3, "x").otherwise(F.col("body")).alias("body"), "note"), "k", "seq", COLUMNS)
    assert faults(forged) == {8: ["head_hash"]}
    assert chains.broken(whole.limit(0), "k", "seq", COLUMNS).count() == 0 and chains.chained(whole.select("k", "seq", "body", "note").limit(0), "k", "seq", COLUMNS).count() == 0


def test_logs_cut_at_every_byte(spark, tmp_path):
    """The whole prefix is read, and only what is behind its last line end is set aside."""
    records = [{"k": "é", "seq": 1, "body": "x"}, {"k": "b", "seq": 2, "body": "y😀"}, {"k": "", "seq": 3}]
    raw = "".join(json.dumps(r, ensure_ascii=False) + "\n" for r in records).encode()
    for n in range(len(raw) + 1):
        (tmp_path / f"{n:04d}.json").write_bytes(raw[:n])
    read, aside = chains.read_log(spark, str(tmp_path), "k string, seq long, body string")
    found = {}
    for r in aside.collect():
        found[int(r.file[-9:-5])] = (r.offset, r.length, r.reason)
    assert found == {n: (raw[:n].rfind(b"\n") + 1, n - raw[:n].rfind(b"\n") - 1, "torn") for n in range(len(raw) + 1) if n and raw[n - 1 : n] != b"\n"}
    wanted = sorted((r["k"], r["seq"], r.get("body")) for n in range(len(raw) + 1) for r in records[: raw[:n].count(b"\n")])
    assert sorted(tuple(r) for r in read.collect()) == wanted


def test_corrupt_and_empty_lines_of_a_log_in_splits(spark, tmp_path):
    lines = [json.dumps({"k": str(i), "seq": i, "body": "b" * (i % 50)}) for i in range(3000)]
    lines[7], lines[1500], lines[2000] = "{no json", "", "[1]"
    (tmp_path / "a.json").write_text("\n".join(lines) + "\r\n" + '{"k": "torn"')
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        read, aside = chains.read_log(spark, str(tmp_path), "k string, seq long, body string")
        assert read.count() == 2997
        assert sorted((r.reason, r.text) for r in aside.collect()) == [("corrupt", "[1]"), ("corrupt", "{no json"), ("torn", '{"k": "torn"')]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_replays_with_another_payload(spark):
    rows = [(1, "a"), (1, "a"), (2, "a"), (2, "b"), (3, None), (3, ""), (4, None), (4, None)]
    got = execution.conflicting(spark.createDataFrame(rows, "k long, p string"), "k", "p").collect()
    assert {r.k for r in got if r.rejected} == {2, 3} and len(got) == 8


AMENDED = "event_id string, target long, seq long, kind string, previous string, old_sha256 string, new_sha256 string"


def plain(rows):
    """event_id -> (root, rank, codes, effective), following every link."""
    by_id = {}
    for r in sorted(rows, key=lambda r: r[2]):
        by_id.setdefault(r[0], r)
    out, first = {}, {}
    for r in sorted(by_id.values(), key=lambda r: (r[2], r[0])):
        first.setdefault((r[1], r[4] or None), r[0])
    codes = {}
    for e, target, _, _, previous, old, _ in by_id.values():
        p = by_id.get(previous) if previous else None
        codes[e] = [name for name, held in (("missing_predecessor", previous and not p), ("other_target", p and p[1] != target), ("fork", first[target, previous or None] != e), ("reopened", p and p[3] == "retract"), ("record_hash", p and p[6] != old)) if held]
    for e in by_id:
        at, seen, bad = e, [], 0
        while at not in seen:
            seen.append(at)
            bad += bool(codes[at])
            if not by_id[at][4] or by_id[at][4] not in by_id:
                break
            at = by_id[at][4]
        else:
            out[e] = (None, None, [*codes[e], "cycle"], False)
            continue
        out[e] = (at, len(seen) - 1, codes[e], not bad)
    return out


def told(frame):
    return {r.event_id: (r.root, r.rank, r.codes, r.effective) for r in frame.collect()}


def test_amendments_of_every_kind(spark):
    rng = random.Random(8)
    rows = []
    for i in range(400):
        previous = rng.choice([None, "", f"e{rng.randint(0, 420)}", *([f"e{i - 1}"] * 4)])
        before = next((r for r in rows if r[0] == previous), None)
        target = before[1] if before and rng.random() < 0.9 else i % 7
        rows.append((f"e{i}", target, i, rng.choice(["patch", "patch", "patch", "retract"]), previous, before[6] if before and rng.random() < 0.9 else "z", f"h{i}"))
    rows += [("c1", 1, 900, "patch", "c3", "h", "h"), ("c2", 1, 901, "patch", "c1", "h", "h"), ("c3", 1, 902, "patch", "c2", "h", "h"), ("c4", 1, 903, "patch", "c3", "h", "h"), ("s", 2, 904, "patch", "s", "h", "h"), ("e5", 3, 905, "patch", None, "", "")]
    got = chains.amendments(spark.createDataFrame(rows, AMENDED))
    wanted = plain(rows)
    assert told(got) == wanted and any(c[2] == ["cycle"] for c in wanted.values())
    holds = {r.target: r.event_id for r in chains.effective(got).collect()}
    by_id = {r[0]: r for r in reversed(rows)}
    assert holds == {t: max((w[1], e) for e, w in wanted.items() if w[3] and by_id[e][1] == t)[1] for t in {by_id[e][1] for e, w in wanted.items() if w[3]}}


def test_a_long_chain_of_amendments_ends_in_few_rounds(spark, monkeypatch):
    n = 100_000
    rounds = []
    real = chains.cut
    monkeypatch.setattr(chains, "cut", lambda df: rounds.append(1) or real(df))
    ids = spark.range(n)
    rows = ids.select(F.col("id").cast("string").alias("event_id"), F.lit(1).cast("long").alias("target"), F.col("id").alias("seq"), F.lit("patch").alias("kind"), F.when(F.col("id") > 0, (F.col("id") - 1).cast("string")).alias("previous"), F.lit("h").alias("old_sha256"), F.lit("h").alias("new_sha256"))
    got = chains.amendments(rows)
    assert got.where("rank <> cast(event_id as long) or not effective").count() == 0 and got.agg(F.max("rank")).first()[0] == n - 1
    assert len(rounds) <= 3 + 18


def test_no_amendments(spark):
    assert chains.amendments(spark.createDataFrame([], AMENDED)).count() == 0
