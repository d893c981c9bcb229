"""The ten operators against plain Python, on the smallest dataset and on edge cases."""

import hashlib
import random

import brute
import brute_pii
import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspark.llm import decontaminate, fingerprint, html_text, near_dedup, pieces, pii, quality, registry, sharding, shingles, token_files, url_filter

SF = "/root/testdata/sf0.001"


def by_id(frame):
    return {r.doc_id: r for r in frame.collect()}


# 1


def test_pii_base_spans(spark, docs, texts):
    found = by_id(pii.report(docs))
    for i, t in texts:
        assert found[i].base_sha256 == brute_pii.digest(t)
        assert set(brute_pii.base_spans(t)) <= set(found[i].spans.split(","))


def test_pii_random_texts(spark):
    rng = random.Random(3)
    parts = ["a", "B@", "@", ".", "-", "_", "+1 (906) 555-1234", "4111 1111 1111 1111", "4111111111111111", "1.2.3.4", "10.0.0.256", "x@y.com", "é", "😀", "\n", " ", "12", "0001.2.3.4.5", "+", "(", ")", "0" * 30, "a.b@d.e_f@g.h"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))) for i in range(600)] + [(700 + i, t) for i, (_, t) in enumerate(brute.EDGES)]
    found = by_id(pii.report(brute.table(spark, rows)))
    assert all(found[i].base_sha256 == brute_pii.digest(t) for i, t in rows)


def test_pii_further_spans_and_mask(spark):
    text = "call +1 (269) 555-3296 4524132264652876 iban GB82 WEST 1234 5698 7654 32 end GB83 WEST 1234 5698 7654 32"
    row = pii.report(brute.table(spark, [(1, text)])).first()
    assert row.n_phone == row.n_card == 0
    assert [text[int(a) : int(b)] for _, a, b in (s.split(":") for s in row.spans.split(","))] == ["4524132264652876", "+1 (269) 555-3296", "GB82 WEST 1234 5698 7654 32"]
    masked = pii.mask(brute.table(spark, [(1, text), (2, None), (3, "é😀 a@b.co!")]))
    assert masked.columns == ["doc_id", "text", "fingerprint", "shard", "n"]
    got = {r.doc_id: r.text for r in masked.collect()}
    assert got[2] is None and got[3] == "é😀 [EMAIL]!" and got[1] == "call [PHONE] [CARD] iban [IBAN] end GB83 WEST 1234 5698 7654 32"


def test_pii_context_decides(spark):
    """Weak proposals need a word before them, strong ones fall after a word that speaks against them."""
    amex = "378282246310005"
    texts = [f"x {amex}", f"my card: {amex}", f"order no {amex}", "x 020 7946 0958", "Tel. 020 7946 0958", *[f"{x} +1 (269) 555-3296 1234567890" for x in ("x", "serial", "call version")]]
    got = by_id(pii.report(brute.table(spark, list(enumerate(texts)))))
    assert [got[k].spans.split(":")[0] for k in range(len(texts))] == ["", "card", "", "", "phone", "phone", "", "phone"]
    assert all(r.n_phone == r.n_card == 0 for r in got.values())


def test_pii_empty_table(spark):
    docs = brute.table(spark, brute.EDGES).limit(0)
    assert pii.report(docs).count() == pii.mask(docs).count() == pieces.digests(docs).count() == 0


def test_pii_long_runs_end(spark):
    rows = [(1, "a" * 200000), (2, "1" * 200000), (3, "a@" + "b." * 60000 + "c"), (4, "+1" + " " * 100000), (5, "1 " * 100000)]
    assert {i: r.n_email for i, r in by_id(pii.report(brute.table(spark, rows))).items()} == {1: 0, 2: 0, 3: 1, 4: 0, 5: 0}


# 2


@pytest.mark.parametrize("shards", [1, 7, 40])
def test_sharding(spark, texts, shards):
    rows = texts + [(None, "n"), (5, texts[5][1]), (900, None)]
    got = sharding.shard(brute.table(spark, rows), shards).collect()
    assert sorted((r.size, r.text_crc32) for r in got) == sorted((len((t or "").encode()) + 16, brute.crc(t)) for _, t in rows)
    order = sorted(got, key=lambda r: (r.shard, r.slot))
    ids = [-1 if r.doc_id is None else r.doc_id for r in order]
    assert ids == sorted(ids)
    total, largest = sum(r.size for r in got), max(r.size for r in got)
    for s in range(shards):
        mine = [r for r in got if r.shard == s]
        assert sorted(r.slot for r in mine) == list(range(len(mine)))
        assert abs(sum(r.size for r in mine) - total / shards) <= largest


def test_sharding_empty(spark):
    assert sharding.shard(brute.table(spark, [(1, "a")]).limit(0)).count() == 0


# 3


def test_decontamination_finds_whole_and_edited_items(spark, docs, texts):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    listed = [(r.item_id, r.text) for r in items.collect()]
    rng = random.Random(1)
    planted = []
    for k, (i, t) in enumerate(listed):
        chars = [c if rng.random() > 0.04 else rng.choice("abcdefgh") for c in t]
        planted.append((5000 + k, f"{texts[k][1][:300]} {''.join(chars)} {texts[k + 1][1][:200]}"))
    got = {(r.doc_id, r.item_id) for r in decontaminate.report(brute.table(spark, texts + planted), items).collect()}
    assert {(d, i) for d, t in texts for i, b in listed if b in (t or "")} <= got
    assert sum((5000 + k, i) in got for k, (i, _) in enumerate(listed)) >= 0.9 * len(listed)
    for d, i in got:
        text, item = ("".join(map(chr, decontaminate.normalised([x])[0])).strip() for x in (dict(texts + planted)[d], dict(listed)[i]))
        if len(text) < 4000:
            assert brute.edit_distance_inside(item, text) <= 0.1 * len(item)


def test_decontamination_edges(spark):
    items = spark.createDataFrame([(1, "tiny item"), (2, None), (3, ""), (4, "a longer item of some words that goes on and on for a while, then ends.")], "item_id long, text string")
    rows = brute.EDGES + [(50, "has a Tiny, ITEM inside"), (51, "has tiny items"), (52, "So: A longer item of some words that goes on AND on for a while then ends")]
    docs = brute.table(spark, rows)
    hits = {r.doc_id: r for r in decontaminate.hits(docs, items).collect()}
    assert set(hits) == {50, 52}
    assert rows[-3][1][hits[50].start : hits[50].end] == "Tiny, ITEM"
    assert decontaminate.clean(docs, items).count() == len(rows) - 2
    assert decontaminate.hits(docs, items.limit(0)).count() == 0


@pytest.mark.parametrize("script", ["latin", "unspaced"])
@pytest.mark.parametrize("kind", ["replaced", "inserted", "deleted", "clustered"])
def test_decontamination_recall(script, kind):
    """Items of 16 to 300 characters with up to 9 % edits, glued into other text where the script has no spaces."""
    rng = random.Random(f"{script} {kind}")
    letters = "abcdefghijklmnopqrstuvwxyz" if script == "latin" else [chr(0x4E00 + i) for i in range(1200)]

    def prose(n):
        if script == "latin":
            return " ".join("".join(rng.choices(letters, k=rng.randint(2, 9))) for _ in range(n))[:n].strip()
        return "".join(rng.choices(letters, [1 / (i + 3) for i in range(len(letters))], k=n))

    def edited(text):
        chars, n = list(text), int(rng.choice([0, 0.03, 0.06, 0.09]) * len(text))
        place = rng.randrange(len(chars) - n)
        for k in range(n):
            at = place + k if kind == "clustered" else rng.randrange(len(chars))
            if kind == "inserted":
                chars.insert(at, rng.choice(letters))
            elif kind == "deleted":
                del chars[at]
            else:
                chars[at] = rng.choice(letters)
        return "".join(chars)

    items = [prose(rng.choice([16, 24, 40, 62, 90, 140, 300])) for _ in range(120)]
    index = decontaminate.Index(list(enumerate(items)))
    glue = " " if script == "latin" else ""
    texts = [f"{prose(200)}{glue}{edited(x)}{glue}{prose(200)}" for x in items]
    found = {(d, k): (a, b) for d, k, a, b, _ in index.find(texts)}
    due = 0
    for k, text in enumerate(texts):
        codes = np.concatenate([[32], decontaminate.normalised([text])[0]])
        distance, _ = decontaminate._best(decontaminate._pattern(index.items[k]), len(index.items[k]), codes)
        due += distance <= index.slack[k]
    assert due > 90
    assert sum((k, k) in found for k in range(len(items))) >= 0.95 * due
    assert all(d == k for d, k in found)


def test_decontamination_verbatim_without_spaces():
    item = "".join(chr(0x4E00 + i * 37 % 2000) for i in range(62))
    index = decontaminate.Index([(7, item), (8, "中文"), (9, "no"), (10, "ok then")])
    text = chr(0x5000) * 33 + item + chr(0x5001) * 20 + "中文字 nothing, NO! ok thence"
    got = {(k, text[a:b]) for _, k, a, b, _ in index.find(["", text])}
    assert got == {(7, item), (8, "中文"), (9, "NO")}


def test_decontamination_every_copy_of_a_run():
    item = "a sentence that is long enough to be taken for a benchmark item of its own kind"
    index = decontaminate.Index([(1, item)])
    text = f"{item} {item}. Other words between them, then {item.replace('long', 'lonk')} {item[:-30]}"
    assert [(text[a:b], n) for _, _, a, b, n in sorted(index.find([text]))] == [(item, 0), (item, 0), (item.replace("long", "lonk"), 1)]


def test_decontamination_by_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 300)
    items = spark.createDataFrame([(k, f"the item with number {k * 7919} is a text of some length {k * 104729} and ends here") for k in range(7)], "item_id long, text string")
    listed = {r.item_id: r.text for r in items.collect()}
    docs = brute.table(spark, [(k, f"before {listed[k]} after") for k in range(7)] + [(100, "clean"), (None, None)])
    assert {(r.doc_id, r.item_id) for r in decontaminate.report(docs, items).collect()} >= {(k, k) for k in range(7)}
    assert sorted(r.doc_id or -1 for r in decontaminate.clean(docs, items).collect()) == [-1, 100]
    assert decontaminate.report(docs.limit(0), items).count() == decontaminate.clean(docs.limit(0), items).count() == 0


def test_best_alignment_is_exact():
    rng = np.random.default_rng(0)
    for _ in range(200):
        a, b = ("".join(rng.choice(list("abc"), n)) for n in rng.integers(1, 14, 2))
        masks = decontaminate._pattern(np.array([ord(c) for c in a]))
        assert decontaminate._best(masks, len(a), np.array([ord(c) for c in b]))[0] == brute.edit_distance_inside(a, b)


# 4


def test_pieces_are_the_librarys(spark, texts):
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    rows = [(i, t) for i, t in texts] + [(1000 + k, t) for k, (_, t) in enumerate(brute.EDGES)]
    got = by_id(pieces.digests(brute.table(spark, rows)))
    for i, t in rows:
        ids = processor.encode(t or "", add_bos=True, add_eos=True)
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (len(ids), brute.sha(np.array(ids, "<u4").tobytes()), brute.sha(processor.decode(ids).encode()))


def test_pieces_random_texts():
    codec = pieces.Codec(pieces.model_path(), entries=50)
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab \n\t.▁é中😀<s>/ ") for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    for text, (ids, decoded) in zip(texts, codec.encode(texts), strict=True):
        wanted = codec.processor.encode(text, add_bos=True, add_eos=True)
        assert ids == pieces._packed(wanted) and decoded == codec.processor.decode(wanted)


# 5


def test_fingerprints(spark, texts):
    got = by_id(fingerprint.report(spark.createDataFrame(texts, "doc_id long, text string")))
    changed = brute.edited(texts)
    assert all(got[i].edited_sha256 == brute.sha(changed[i].encode()) and got[i].n_chars == len(t or "") for i, t in texts)
    same = {}
    for i, t in texts:
        assert same.setdefault(t or "", got[i].fingerprint) == got[i].fingerprint
    assert len(set(same.values())) == len(same)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got.values())
    assert np.mean([r.near_edited for r in got.values()]) > np.mean([r.near_next for r in got.values()]) + 0.2


def test_fingerprint_is_a_multiset_sum(spark):
    rows = spark.createDataFrame([("a\nb\nc", "c\na\nb", "a\nb", "c")], "x string, y string, p string, q string")
    words = rows.select(*[fingerprint.fingerprint(F.col(c)).alias(c) for c in rows.columns])
    row = words.select("*", fingerprint.plus(F.col("p"), F.col("q")).alias("sum"), fingerprint.minus(F.col("x"), F.col("q")).alias("rest")).first()
    assert row.x == row.y == row["sum"] and row.rest == row.p and row.x != row.p


def test_fingerprint_words_are_slices_of_a_wide_hash(spark):
    """Two paragraphs that agree in one word, or in a 64-bit hash, needn't agree in the others."""
    import hashlib

    rows = spark.createDataFrame([("a line",), ("",), ("Zeile \u00e9",)], "p string")
    for r in rows.select("p", fingerprint.fingerprint(F.col("p")).alias("w")).collect():
        digest = hashlib.sha512(r.p.encode()).hexdigest()
        words = [int(digest[15 * k : 15 * k + 15], 16) for k in range(fingerprint.WIDE + 1)]
        assert list(r.w[: fingerprint.WIDE]) == words[:-1]
        assert list(r.w[fingerprint.WIDE : -1]) == [words[-1] >> k & fingerprint.LANES for k in range(fingerprint.SHIFTS)]


def test_fingerprint_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "ROWS_PER_RANGE", 3)
    rows = [(i * 7 % 101, f"text {i}\nline") for i in range(101)] + [(5, "again"), (None, "none")]
    got = fingerprint.with_next(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    follows = {r: n[1] for r, n in zip(ordered, ordered[1:] + ordered[:1])}
    assert {(r.doc_id, r.text): r.next_text for r in got} == follows and len(got) == len(rows)


def test_fingerprint_edges(spark):
    got = fingerprint.report(brute.table(spark, brute.EDGES)).collect()
    assert len(got) == len(brute.EDGES)
    assert fingerprint.report(brute.table(spark, [(1, "abc")])).first().edited_sha256 == brute.sha(b"aba")
    assert fingerprint.report(brute.table(spark, brute.EDGES).limit(0)).count() == 0


# 6


def test_url_filter(spark):
    rules = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("b.co", "", "block"), ("b.co", "/x", "allow")]
    listed = ["http://A.Example.COM/en/7a?x=/en/", "http://example.com/en/8", "x://com/en/", "http://notcom/en/", None, "", "no scheme/en/", "http://", "https://a.b.co?q", "https://b.co/xy#t", "http://b.co:80/x", "http://com/EN/", "a://b://com/en/", "http://x.com/en"]
    pages = spark.createDataFrame([(k % 12, u, "h", "p") for k, u in enumerate(listed)], "page_id long, url string, host string, rule string")
    got = url_filter.judge(pages, url_filter.rules_frame(spark, rules)).collect()
    wanted = sorted((k % 12, *brute.url_parts(u), *(str(x) for x in brute.verdict(u, rules))) for k, u in enumerate(listed))
    assert sorted((r.page_id, r.host, r.path, str(r.rule), r.verdict) for r in got) == wanted
    assert {r.verdict for r in url_filter.judge(pages, url_filter.rules_frame(spark, rules).limit(0)).collect()} == {"allow"}


def test_url_filter_has_the_rules_of_its_contract(spark, tmp_path):
    """block com/en/, allow example.com/en/7, allow net/de/, block example.net/de/8, block org/es/."""
    wanted = {"http://a.com/en/1": "block", "http://www.example.com/en/7": "allow", "http://b.net/de/1": "allow", "http://example.net/de/7": "allow", "http://example.net/de/8": "block", "http://c.org/es/": "block", "http://c.org/de/": "allow"}
    rows = [(k, u, "") for k, u in enumerate(wanted)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = {r.page_id: r.verdict for r in registry.op6_url_filter(spark, str(tmp_path)).collect()}
    assert got == dict(enumerate(wanted.values()))


# 7


def test_token_files(spark, texts, tmp_path):
    import tokenizers

    library = tokenizers.Tokenizer.from_file(token_files.tokenizer_path())
    rows = texts + [(1000 + k, t) for k, (_, t) in enumerate(brute.EDGES)] + [(None, "x")]
    manifest = token_files.write(brute.table(spark, rows), str(tmp_path))
    got = token_files.read(manifest, str(tmp_path)).collect()
    start = 0
    for (i, t), r in zip(sorted(rows, key=lambda x: -1 if x[0] is None else x[0]), sorted(got, key=lambda r: r.start), strict=True):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, start, len(ids), token_files.zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert manifest.agg(F.sum("n_ids")).first()[0] == start


def test_token_encoder_random_texts():
    encoder = token_files.Encoder(token_files.tokenizer_path(), entries=50)
    rng = random.Random(2)
    for _ in range(3000):
        text = "".join(rng.choice(["a", "B", " ", " ", "\n", "\t", "'s", "'", "1", "_", ".", "é", "²", "中", "\x1f", "\xa0", "<|endoftext|>"]) for _ in range(rng.randint(0, 20)))
        assert np.frombuffer(encoder(text), encoder.kind).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


# 8


def test_near_dedup(spark, docs, texts):
    got = by_id(near_dedup.components(docs))
    wanted = brute.components(texts)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == wanted
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def test_near_dedup_chains_and_hot_buckets(spark):
    rng = random.Random(4)
    words = [f"w{k}" for k in range(4000)]
    shared = [rng.choice(words) for _ in range(60)]
    rows = [(k, " ".join(shared + [rng.choice(words) for _ in range(rng.choice([3, 8, 20]))])) for k in range(300)]
    chain = [rng.choice(words) for _ in range(200)]
    for k in range(40):
        rows.append((1000 + k, " ".join(chain)))
        at = rng.randrange(200)
        chain = chain[:at] + [rng.choice(words)] + chain[at + 1 :]
    got = by_id(near_dedup.components(brute.table(spark, rows)))
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == brute.components(rows)


def test_near_dedup_edges(spark):
    got = near_dedup.components(brute.table(spark, brute.EDGES)).collect()
    ids = {r.doc_id: r.component_id for r in got}
    assert len(got) == len(brute.EDGES) and ids[2] == 1 and ids[3] == 3 and ids[10] == 7 and ids[None] is None
    assert near_dedup.keep_one(brute.table(spark, brute.EDGES)).count() == len(brute.EDGES) - 3
    assert near_dedup.components(brute.table(spark, []).limit(0)).count() == 0


def test_pipeline_near_dedup_at_80_percent(spark):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = {r.doc_id for r in corpus_pipeline.near_dedup_stage(spark, docs, SF).collect()}
    at = {p: {i for i, (_, c) in brute.components(rows, p).items() if i == c} for p in (80, 85)}
    assert got == at[80] and len(at[80]) < len(at[85])


def test_near_dedup_reaches_the_threshold(spark):
    words = [f"w{k}" for k in range(200)]
    # 76 of 95 shingles are 0.8, 76 of 96 are less
    rows = [(1, " ".join(words[:80])), (2, " ".join(words[:99])), (3, " ".join(words[100:180])), (4, " ".join(words[100:199] + ["x"]))]
    got = {r.doc_id: r.component_id for r in near_dedup.components(brute.table(spark, rows), 80).collect()}
    assert got == {i: c for i, (_, c) in brute.components(rows, 80).items()} == {1: 1, 2: 1, 3: 3, 4: 4}


def test_near_dedup_large_open_buckets(spark, monkeypatch):
    """Buckets of many members that are not like their centre: further centres, hopeless members and blocks lose no link."""
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", 3000)
    monkeypatch.setattr(near_dedup, "CENTRE_ROUNDS", 1)
    rng = random.Random(4)
    base = [f"w{rng.randrange(5000)}" for _ in range(160)]

    def changed(words, n):
        words = list(words)
        for _ in range(n):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        return " ".join(words)

    rows = [(i, changed(base, rng.randrange(0, 7))) for i in range(60)] + [(100 + i, changed(changed(base, 3).split(), rng.randrange(0, 2))) for i in range(20)]
    want = {i: c for i, (_, c) in brute.components(rows).items()}
    got = {r.doc_id: r.component_id for r in near_dedup.components(brute.table(spark, rows)).collect()}
    assert got == want and len(set(want.values())) > 3


def test_connected_with_hot_nodes(spark, monkeypatch):
    from quillspark.operators import graph

    monkeypatch.setattr(graph, "HOT", 5)
    links = [(0, k) for k in range(1, 40)] + [(50, 51), (51, 52), (39, 60), (60, 61)]
    got = {r.node: r.label for r in graph.connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in [*range(40), 60, 61]}, 50: 50, 51: 50, 52: 50}


def test_block_links_match_pairs():
    rng = np.random.default_rng(5)
    base = np.unique(rng.integers(0, 2**63, 60, np.uint64))
    sets = [np.unique(np.concatenate([rng.permutation(base)[: rng.integers(45, 60)], rng.integers(0, 2**63, rng.integers(0, 8), np.uint64)])) for _ in range(40)]
    found = near_dedup.block_links(np.arange(40), sets, np.arange(40), 85)
    assert all(shingles.linked(sets[a], sets[b], 85) for a, b in found)
    reach = {k: k for k in range(40)}
    for pairs in (found, [(a, b) for a in range(40) for b in range(a) if shingles.linked(sets[a], sets[b], 85)]):
        before = dict(reach)
        for a, b in pairs:
            x, y = reach[a], reach[b]
            reach = {k: min(x, y) if v in (x, y) else v for k, v in reach.items()}
        assert pairs is found or reach == before


# 9


def test_quality_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.train(docs, labels.where("doc_id % 3 <> 0"))
    got = quality.grade(docs, model).join(labels.where("doc_id % 3 = 0"), "doc_id").toPandas()
    clean = (got.quality == 1) & (got.toxic == 0)
    assert got[clean].keep.mean() > 0.95 and got[got.quality == 0].keep.mean() < 0.25
    assert (got.expected_grade >= got.p_best).all() and got.p_best.between(0, 1).all()


def test_quality_threshold_at_its_size(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = quality.train(docs, labels.where("doc_id % 3 <> 0"))
    got = quality.grade(docs, model).join(labels.where("doc_id % 3 = 0"), "doc_id").toPandas()
    clean, toxic = (got.quality == 1) & (got.toxic == 0), (got.quality == 1) & (got.toxic == 1)
    assert got[clean].keep.mean() > 0.95 and got[got.quality == 0].keep.mean() < 0.25
    # even odds let more toxic texts through
    assert got[toxic].keep.mean() < (got[toxic].p_best >= 0.5).mean()


def test_quality_edges(spark):
    docs = brute.table(spark, brute.EDGES)
    labels = spark.createDataFrame([(1, 1, 0), (1, None, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels)
    assert quality.grade(docs, model).where("keep").count() == len(brute.EDGES)
    assert quality.train(docs, labels.limit(0)).weights == {}
    assert quality.select(docs, model).columns == docs.columns


def test_thresholds_are_ordered():
    rng = np.random.default_rng(1)
    grades = rng.integers(0, 3, 300)
    rows = [[int(g), 10 + int(rng.integers(0, 5))] for g in grades]
    model = quality.fit(np.concatenate([np.array(r) for r in rows]), np.full(300, 2), grades)
    assert model.thresholds[0] < model.thresholds[1]
    assert model.weights.get(2, 0) > model.weights.get(0, 0)


# 10


def test_html_on_templates():
    trees = html_text.model()
    pages = list(html_text.example_pages(150, seed=77))
    got = html_text.main_texts([p for p, _ in pages], trees)
    assert np.mean([g == "\n\n".join(b) for (_, b), g in zip(pages, got, strict=True)]) > 0.95


def test_html_on_pages(spark):
    import html
    import re

    def truth(page):
        inside = re.search(r"<article>(.*?)</article>", page or "", re.S)
        blocks = re.split(r"</?(?:p|h1)>", inside[1]) if inside else []
        return "\n\n".join(x for x in (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in blocks) if x)

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r for r in html_text.extract(pages).collect()}
    assert all(got[r.page_id].text == truth(r.html) and got[r.page_id].n_chars == len(truth(r.html)) for r in pages.collect())


def test_html_edges(spark):
    listed = [None, "", "<", "<p", "<!-- never", "<script>var a", "<div>" * 3000 + "x", '<article><h1 title="a>b">T &amp; U</h1><p>one<br>two  &#65;&nbsp;b<p>three']
    pages = spark.createDataFrame([(k, None, h, "t") for k, h in enumerate(listed)], "page_id long, url string, html string, text string")
    got = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    assert [got[k] for k in range(6)] == [""] * 6 and got[7] == "T & U\n\none two A b\n\nthree"


@pytest.mark.parametrize(
    "page",
    [
        '<div id="page"><div class="col"><p>{0}</p><p>{1}</p></div></div>',
        '<div class="layout"><span>{0}</span><p>{1}</p></div>',
        "<p>{0}</p><p>{1}</p>",
        '<table><tr><td><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></td><td><div>{0}</div><div>{1}</div></td></tr></table><div id="footer">All rights reserved</div>',
        '<nav><a href="/">Home</a></nav><section><h2>{0}</h2><noscript>{1}</noscript></section><div class="sidebar"><p>Other things</p></div>',
    ],
)
def test_html_layouts_without_telling_names(page):
    words = "The river rose again in the night, and by morning the lower road was under water. Nobody was hurt. "
    blocks = [words.strip(), (words * 3).strip()]
    assert html_text.main_texts([f"<html><body>{page.format(*blocks)}</body></html>"], html_text.model()) == ["\n\n".join(blocks)]


@pytest.mark.parametrize("flood", ["<a ", '<p x="', '<p a=">"', "<", "</p>", "<!-", "<svg>", "<div>", "<label><li></li>", "&amp", "<li><div><label>", "<title>", "<h1><p>", "a<b", "<td>"])
def test_html_floods_are_read_in_linear_time(flood):
    import time

    trees = html_text.model()
    began = time.time()
    html_text.main_texts([flood * (1_000_000 // len(flood)), "<p>x" + flood * 40_000 + ">"], trees)
    assert time.time() - began < 40


P = "The committee met again on Tuesday to discuss the long delayed bridge over the river, and agreed on a plan."
Q = "Several residents spoke in favour of the proposal, although some asked for more time and a second opinion."
LINKS = "<ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li><li><a href='/c'>Sport</a></li></ul>"
#: Articles in elements whose names have words for other parts.
MISLEADING = [
    (f'<html><body class="has-sidebar"><div class="wrap with-footer"><p>{P}</p><p>{Q}</p></div></body></html>', [P, Q]),
    (f'<div class="content"><h1>Bridge</h1><div class="comment-policy"><p>{P}</p></div></div>', ["Bridge", P]),
    (f'<body class="no-comments"><nav>{LINKS}</nav><div id="page" class="has-header"><div class="menu-open"><h1>Bridge plan</h1><p>{P}</p><p>{Q}</p></div></div><footer>&copy; 2024</footer></body>', ["Bridge plan", P, Q]),
    (f'<body><div class="with-sidebar"><div class="sidebar"><h3>More</h3>{LINKS}</div><div class="col"><p>{P}</p><p>{Q}</p></div></div></body>', [P, Q]),
    (f'<body class="ad-free"><header><h1>Site</h1>{LINKS}</header><section class="news-banner-story"><h2>Bridge plan</h2><p>{P}</p></section><div id="comments"><p>I do not like it at all.</p></div></body>', ["Bridge plan", P]),
    (f'<body id="nav-left"><table><tr><td>{LINKS}</td><td class="widget-area-left"><p>{P}</p><p>{Q}</p></td></tr></table></body>', [P, Q]),
    (f'<body><main class="cookie-policy"><h1>Cookies we bake</h1><p>{P}</p><ul><li>One cup of flour.</li><li>Two eggs.</li></ul></main></body>', ["Cookies we bake", P, "One cup of flour.", "Two eggs."]),
    (f'<body class="page-footer-layout"><article class="comments-open"><h1>Bridge</h1><p>{P}</p></article><aside><p>Read also this</p></aside></body>', ["Bridge", P]),
    (f'<body><div class="site-header"><h2>The Paper</h2></div><div class="has-related"><p>{P}</p><p>{Q}</p><p>{P}</p></div><div class="related"><h3>Related</h3>{LINKS}</div></body>', [P, Q, P]),
    (f'<body class="form-story share-left"><div class="breadcrumbs">Home / News</div><div><div><h1>Bridge plan</h1><p>{P}</p><blockquote><p>{Q}</p></blockquote></div></div></body>', ["Bridge plan", P, Q]),
    (f'<body><div class="notice-board-app"><h1>Bridge plan</h1><div>{P}</div><div>{Q}</div></div><div class="cookie-notice"><p>We use cookies.</p><button>OK</button></div></body>', ["Bridge plan", P, Q]),
    (f'<body class="has-comments"><div class="with-ads"><p>{P}</p><div class="ad">Buy now</div><p>{Q}</p></div><section class="comments"><h3>Comments</h3><ul><li class="comment">Nice one, thanks.</li></ul></section></body>', [P, Q]),
]


@pytest.mark.parametrize("page, blocks", MISLEADING)
def test_html_names_of_other_parts_on_harmless_ancestors(page, blocks):
    assert html_text.main_texts([page], html_text.model()) == ["\n\n".join(blocks)]


def test_html_empty_table(spark):
    found = html_text.extract(spark.createDataFrame([], "page_id long, url string, html string, text string"))
    assert found.columns == ["page_id", "url", "text", "n_chars"] and found.count() == 0


def test_html_deep_nesting_keeps_text(spark):
    words = "The river rose again in the night, and by morning the lower road was under water. Nobody was hurt."
    pages = spark.createDataFrame([(1, None, "<div>" * 100_000 + words + "</div>" * 100_000), (1, None, f"<p>{words}"), (None, "u", f"<p>{words}")], "page_id long, url string, html string")
    assert [r.text for r in html_text.extract(pages).collect()] == [words] * 3
    assert html_text.extract(pages.limit(0)).count() == 0


def test_kept_nodes_have_kept_parents():
    rng = np.random.default_rng(3)
    parent = np.array([-1, *[rng.integers(0, k) for k in range(1, 200)]])
    depth = np.zeros(200, int)
    for k in range(1, 200):
        depth[k] = depth[parent[k]] + 1
    state = html_text.decode(rng.normal(size=200), parent, depth)
    assert all(state[parent[k]] for k in range(1, 200) if state[k])


# registry and pipeline


def test_quality_of_repeated_rows_and_clashing_names(spark):
    """A doc_id that comes many times counts once in the fit, and columns of other operators' names stay."""
    docs = spark.createDataFrame([(k % 40, f"good words number {k % 40} and more of them", 7, "x") for k in range(400)], "doc_id long, text string, grade int, keep string")
    labels = spark.createDataFrame([(k, 1, 0) for k in range(39)] + [(39, 0, 0), (39, None, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels)
    assert model.keep <= quality.KEEP
    kept = quality.select(docs, model)
    assert kept.columns == docs.columns and kept.count() >= 390
    graded = quality.grade(docs, model)
    assert graded.count() == 400 and quality.grade(docs.limit(0), model).count() == quality.select(docs.limit(0), model).count() == 0


def test_quality_threshold_goes_down_for_clean_rows():
    rng = np.random.default_rng(0)
    grades = np.array([0, 1, 2, 2, 2] * 60)
    rows = [sorted({int(g) * 10 + int(rng.integers(0, 6)), 100 + int(rng.integers(0, 30))}) for g in grades]
    where, sizes = np.array([f for r in rows for f in r]), np.array([len(r) for r in rows])
    assert quality.STEP <= quality.threshold(where, sizes, grades) <= quality.KEEP
    assert quality.threshold(where[:0], sizes[:0], grades[:0]) == quality.KEEP


def test_token_files_of_null_and_least_ids(spark, tmp_path):
    docs = spark.createDataFrame([(None, "a b"), (-(2**63), "c"), (None, None), (3, "d")], "doc_id long, text string")
    got = token_files.read(token_files.write(docs, str(tmp_path / "files")), str(tmp_path / "files")).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, None, -(2**63), 3] and got[0].n_tokens == 1
    assert token_files.read(token_files.write(docs.limit(0), str(tmp_path / "none")), str(tmp_path / "none")).count() == 0


def test_html_repeated_rows_and_clashing_names(spark):
    pages = spark.createDataFrame([(1, "u", "<article><h1>A title</h1><p>Some words of an article, long enough to be one.</p></article>", "t", 3)] * 3, "page_id long, url string, html string, text string, n_chars int")
    assert len({r.text for r in html_text.extract(pages).collect()}) == 1 and html_text.extract(pages).count() == 3


def test_oracles(spark):
    from compare import duck, rows

    for name, sql in registry.oracle_sql().items():
        assert rows(registry.queries()[name](spark, SF).toPandas()) == rows(duck(SF).execute(sql).df()), name


def test_pipeline_stages(spark, docs, texts):
    import corpus_pipeline

    spark_docs, columns = docs, docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, spark_docs, SF)
        if name != "tokens":
            assert out.columns == columns
        spark_docs = out.cache()
        kept[name] = {r.doc_id: r for r in spark_docs.collect()}
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    junk = [i for i, x in labels.items() if x.quality == 0]
    assert sum(i in kept["quality"] for i in junk) < 0.3 * len(junk)
    groups = brute.components([(i, r.text) for i, r in kept["quality"].items()], corpus_pipeline.NEAR_PERCENT)
    assert set(kept["near_dedup"]) == {i for i, (_, c) in groups.items() if i == c}
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert not any(b in (r.text or "") for r in kept["decontamination"].values() for b in items)
    assert not any(brute_pii.base_spans(r.text) for r in kept["pii"].values() if "[" not in (dict(texts)[r.doc_id] or ""))
    assert set(kept["tokens"]) == set(kept["pii"])
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()} == set(kept["tokens"])




def test_pipeline_stages_on_edges(spark):
    """Null, empty and long texts, repeated rows, an empty table and clashing names pass every stage but the first."""
    import corpus_pipeline

    docs = brute.table(spark, brute.EDGES + brute.EDGES[:3])
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        assert stage(spark, docs.limit(0), SF).count() == 0, name
        out = stage(spark, docs.withColumn("n_chars", F.length("text").cast("long")), SF)
        assert set(docs.columns) <= set(out.columns), name
        assert {r.doc_id for r in out.select("doc_id").distinct().collect()} <= {i for i, _ in brute.EDGES}, name
    tokens = corpus_pipeline.tokens_stage(spark, docs, SF)
    assert tokens.count() == len(brute.EDGES) + 3 and tokens.where("n_tokens < 2").count() == 0
