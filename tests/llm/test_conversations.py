"""Packing, conversation repair and the prefix trie against plain Python."""

import random
import zlib

import brute
import brute_conversations
import numpy as np
import pytest

from quillspark.llm import packing, prefix_trie, registry, repair, token_files

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, lost string, kind int, block int, turns string"
TEXTS = ["", " ", None, "a.", "b?", "no end", "x\n", "end! \t", "é😀.", "...", "a."]
ROLES = ["user", "assistant", "system", "tool", "", None, "User"]


def frame(spark, rows):
    """With extra columns whose names clash with those of results."""
    return spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], SCHEMA)


def made(seed, n_conversations, turns, roles=ROLES, texts=TEXTS, ids=None):
    rng = random.Random(seed)
    out = []
    for k in range(n_conversations):
        conv_id = ids[k] if ids else k
        for t in range(rng.randint(1, turns)):
            out.append((conv_id, rng.choice([t, t, t, None, t + 2, 0]), rng.choice(roles), rng.choice(texts)))
    return out + rng.sample(out, min(len(out), 9))


@pytest.fixture(scope="module")
def given(spark):
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    return turns, [tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()]


# 11


def whole(spark, docs, rows, **options):
    """The pieces, after the checks that hold for any packing."""
    pieces = packing.pack(docs, **options).collect()
    capacity = options.get("capacity", packing.CAPACITY)
    windows, found = {}, {}
    for p in pieces:
        windows.setdefault(p.sequence_id, []).append(p)
        assert p.length * 4 == len(p.ids) and p.length > 0
    for held in windows.values():
        at = 0
        for p in sorted(held, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= capacity and not at & (at - 1)  # no padding at all
    encode = token_files.encoder(token_files.tokenizer_path())
    for p in sorted(pieces, key=lambda p: p.start):
        found.setdefault(p.doc_id, []).append(p)
    by_text = {}
    for i, text in rows:
        by_text.setdefault(i, []).append(np.append(np.frombuffer(encode(text or ""), encode.kind), 0).astype("<u4"))
    assert set(found) == set(by_text)
    for i, texts in by_text.items():
        if len(texts) == 1:
            assert b"".join(bytes(p.ids) for p in found[i]) == texts[0].tobytes()
            assert all(p.doc_tokens == len(texts[0]) for p in found[i])
        assert sum(p.length for p in found[i]) == sum(map(len, texts))
    return pieces, windows


def test_packing_whole_documents(spark, docs, texts):
    pieces, windows = whole(spark, docs, texts)
    found = {(r.doc_id, r.start): r for r in registry.op11_packing(spark, SF).collect()}
    assert len(found) == len(pieces)
    assert all(found[p.doc_id, p.start].ids_crc32 == zlib.crc32(p.ids) for p in pieces)
    held = {r.sequence_id: r for r in packing.sequences(packing.pack(docs)).collect()}
    for k, window in windows.items():
        window.sort(key=lambda p: p.offset)
        assert bytes(held[k].ids) == b"".join(bytes(p.ids) for p in window)
        assert held[k].doc_starts == [p.offset for p in window] and held[k].n_tokens * 4 == len(held[k].ids)


@pytest.mark.parametrize("capacity,most_open", [(16, 4096), (16, 3), (1, 5), (1024, 1)])
def test_packing_edges(spark, capacity, most_open):
    whole(spark, brute.table(spark, brute.EDGES), brute.EDGES, capacity=capacity, most_open=most_open)


def test_packing_one_length_for_all(spark):
    """Rests that never fit two by two are cut; the open windows stay bounded."""
    packer = packing.Packer(1024, 50)
    full = sum(len(list(packer.add(i, np.zeros(600, "<u4")))) for i in range(5000))
    assert packer.n_open <= 50 and full * 1024 + sum(len(p[3]) for level in packer.windows for w in level for p in w) == 5000 * 600


def test_packing_empty_table_and_wrong_capacity(spark):
    assert packing.pack(brute.table(spark, brute.EDGES).limit(0)).count() == 0
    with pytest.raises(ValueError, match="power of two"):
        packing.pack(brute.table(spark, brute.EDGES), capacity=1000)


def test_packing_levels_minimise_squares():
    rng = random.Random(5)
    packer = packing.Packer(16)
    for _ in range(2000):
        counts = packer.counts.copy()
        size = rng.randint(1, 15)

        def squares(level):
            after = counts.copy()
            after[level] -= level > 0
            after[level + size] += level + size < 16
            return int((after**2).sum())

        allowed = [h for h in range(17 - size) if h == 0 or counts[h]]
        level = packer.level(size)
        assert level in allowed and squares(level) == min(map(squares, allowed))
        list(packer.add(0, np.zeros(size, "<u4")))


# 12


def held_repairs(frame):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in frame.collect()}


def test_repair_on_conversations(spark, given):
    turns, rows = given
    assert held_repairs(repair.report(turns)) == brute_conversations.repairs(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_repair_of_odd_conversations(spark, seed):
    ids = [*range(395), None, -1, -100, 2**40, 7_000]
    rows = made(seed, 400, 7, ids=ids)
    assert held_repairs(repair.report(frame(spark, rows))) == brute_conversations.repairs(rows)


def test_repair_of_likely_roles(spark):
    rows = made(3, 500, 8, ["user", "assistant", "system"], ["a.", "b.", "c", "d.", "e.", "f.", ""])
    assert held_repairs(repair.report(frame(spark, rows))) == brute_conversations.repairs(rows)


def test_repair_gives_fitting_turns(spark):
    rows = [(1, 0, "assistant", "late"), (1, 1, "assistant", "b."), (2, 0, "system", "s."), (3, 0, " ", "x.")]
    got = {r.conv_id: r for r in repair.repair(frame(spark, rows).drop("lost")).collect()}
    assert [(t.role, t.text) for t in got[1].repaired] == [("user", "late"), ("assistant", "b.")] and got[1].audit == "RK" and got[1].cost == 6
    assert got[2].audit == "D" and got[2].repaired == []
    assert got[3].audit == "D" and got[3].cost == 4


def test_repair_of_lost_and_no_conversations(spark):
    lost = [c for c in range(4000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:3]
    found = held_repairs(repair.report(frame(spark, [(c, 0, "user", "a.") for c in lost])))
    assert found == {c: (0, 0, 0, 0, 0, 0, "", brute.sha(b"")) for c in lost}
    assert repair.report(frame(spark, []).limit(0)).count() == 0


def test_repair_of_a_long_conversation(spark):
    rows = [(5, t, ["user", "assistant", "system"][t % 3], f"{t}.") for t in range(3000)]
    assert held_repairs(repair.report(frame(spark, rows))) == brute_conversations.repairs(rows)


# 13


def held_trie(frame):
    rows = frame.collect()
    found = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in rows}
    assert len(found) == len(rows)
    return found


def test_trie_of_conversations(spark, given):
    turns, rows = given
    assert held_trie(prefix_trie.report(turns)) == brute_conversations.trie(rows)


@pytest.mark.parametrize("seed,turns,texts", [(1, 6, TEXTS), (2, 9, ["a", "b"]), (3, 3, ["a"]), (4, 12, ["a", None])])
@pytest.mark.parametrize("parts", ["1", "7", "61"])
def test_trie_of_odd_conversations(spark, seed, turns, texts, parts):
    ids = [*range(90), *range(1000, 1300), None, -1, -100, -205, 2**40, 7_000]
    rows = made(seed, len(ids), turns, ["user", None], texts, ids)
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        assert held_trie(prefix_trie.report(frame(spark, rows))) == brute_conversations.trie(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_trie_of_copies_over_many_blocks(spark, monkeypatch):
    """Copies that fill several blocks, lists in pieces, and longer conversations behind them."""
    monkeypatch.setattr(prefix_trie, "PIECE", 5)
    rows = [(c, t, "user", "same") for c in range(1, 400) for t in range(6)] + [(c, t, "user", "same") for c in range(400, 500) for t in range(8)]
    rows += [(c, t, "user", f"{t if t < 7 else c}") for c in range(500, 600) for t in range(9)]
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        assert held_trie(prefix_trie.report(frame(spark, rows))) == brute_conversations.trie(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_trie_of_turnless_and_no_conversations(spark):
    assert prefix_trie.report(frame(spark, []).limit(0)).count() == 0
    bare = [c for c in range(1, 400) if zlib.crc32(str(c).encode()) % 6 == 5 and c % 100][:4]
    rows = [(c, 0, "user", "gone") for c in bare]
    assert held_trie(prefix_trie.report(frame(spark, rows))) == brute_conversations.trie(rows)
    assert held_trie(prefix_trie.report(frame(spark, rows)))[bare[0], 0][1:4] == (4, 0, 1)


@pytest.mark.parametrize("name", ["op12_repair", "op13_prefix_trie"])
def test_sql_gives_the_same_rows(spark, name):
    from compare import duck, rows

    found, wanted = registry.queries()[name](spark, SF).toPandas(), duck(SF).execute(registry.oracle_sql()[name]).df()
    assert sorted(found.columns) == sorted(wanted.columns) and rows(found) == rows(wanted)
