"""Small fixtures with known answers for the scoring, log, identity, text and source operators."""

import collections
import difflib
import json
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspark.functions import privacy, times, urls
from quillspark.operators import agreement, contracts, execution, graph, identity, scoring, semantics, text
from quillspark.session import ship_package
from quillspark.sources import readers, sinks
from quillspark.streaming import events


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize("counts, weights", [((90, 5, 5), [0.5, 0.25, 0.25]), ((10, 10), [0.5, 0.5]), ((7,), [None]), ((80, 15, 5), [0.5, 0.375, 0.125])])
def test_capped_weights(spark, counts, weights):
    df = spark.createDataFrame([(str(i), c) for i, c in enumerate(counts)], "platform string, effective long")
    assert [r.weight for r in scoring.capped_weights(df).orderBy("platform").collect()] == weights


@pytest.mark.parametrize("x, y", [(2.5, 3), (-2.5, -3), (0.4, 0), (-0.5, -1)])
def test_half_away(spark, x, y):
    assert one(spark, scoring.half_away, x, "double") == y


def test_cell_minimum_and_composite(spark):
    rows = [(p, d, 1.0, 1.0) for p, n in (("a", 2), ("b", 3), ("c", 4)) for _ in range(n) for d in (0,)]
    cells = scoring.cells(spark.createDataFrame(rows, "platform string, dim int, s double, w double"))
    assert sorted((r.platform, r.n, r.conversion) for r in cells.collect()) == [("b", 3, 60), ("c", 4, 60)]
    six = spark.createDataFrame([(d, 50.0 if d else None) for d in range(7)], "dim int, score double")
    assert scoring.composite(six).first().composite is None


@pytest.mark.parametrize("value, wanted", [("Yes", True), ("否", False), ("maybe", None), (None, None), (" 1 ", True)])
def test_tri_state(spark, value, wanted):
    assert one(spark, contracts.tri_state, value) is wanted


@pytest.mark.parametrize("value, wanted", [("1.5", 1.5), ("nan", None), ("1e3", 1000.0), ("1e999", None), ("", None), ("1" * 200, None)])
def test_finite_double(spark, value, wanted):
    assert one(spark, contracts.finite_double, value) == wanted


def test_tags(spark):
    assert one(spark, contracts.tags, "a; b；c|| d") == ["a", "b", "c", "d"]


def test_unknown_condition_is_a_reason(spark):
    df = contracts.with_reasons(spark.createDataFrame([(1, None), (2, 5)], "id int, n int"), {"small": F.col("n") < 3})
    assert [(r.id, r.reasons, r.eligible) for r in df.orderBy("id").collect()] == [(1, ["small"], False), (2, [], True)]


def test_retry_chains(spark):
    rows = [(1, "a", 0, 0, 5), (2, "a", 1, 6, 9), (3, "b", 0, 0, 5), (4, "b", 1, 3, 9), (5, "c", 1, 0, 1), (6, "d", 0, 0, 1), (7, "d", 1, 2, 3), (8, "d", 2, 4, 5)]
    audited = execution.retry_audit(spark.createDataFrame(rows, "execution_id long, chain string, retry_number long, ts long, end_ts long"))
    got = {r.execution_id: (r.codes, r.chain_valid) for r in audited.collect()}
    assert got[1] == ([], True) and got[2] == ([], True)
    assert got[3] == ([], False) and got[4] == (["overlaps_previous"], False)
    assert got[5] == (["number_gap"], False)
    assert got[8] == (["too_many_retries"], False) and got[6] == ([], False)


def test_outcomes(spark):
    df = spark.createDataFrame([("failed", "retry", 0), ("failed", "stop", 1), ("odd", "x", 0)], "s string, a string, n int")
    assert [r.c for r in df.select(contracts.outcome_reasons(F.col("s"), F.col("a"), F.col("n")).alias("c")).collect()] == [["execution_retry_precondition_invalid"], ["execution_status_action_conflict", "execution_status_cannot_produce_sources"], ["execution_status_invalid"]]


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 101), (7, 7)], "a long, b long")
    labels = {r.node: r.label for r in graph.connected(links).collect()}
    assert {labels[i] for i in range(1, 41)} == {1} and labels[101] == 100 and len(labels) == 42


def test_page_entities_join_by_url_and_by_content(spark):
    rows = [(1, "u1", "f1"), (2, "u1", None), (3, "u2", "f1"), (4, "u3", None), (5, None, None)]
    got = {r.source_id: r.entity for r in identity.page_entities(spark.createDataFrame(rows, "source_id long, canonical string, fingerprint string")).collect()}
    assert got[1] == got[2] == got[3] == "PAGE-CONTENT-f1"
    assert got[4].startswith("PAGE-URL-") and got[5].startswith("PAGE-LEGACY-")


def test_tail_groups_need_three(spark):
    tail = "the very same ending here"
    rows = [(i, f"{'abcde'[i]} some start {tail}", "s") for i in range(3)] + [(8, "x other " + tail[::-1], "s"), (9, "y thing " + tail[::-1], "s")]
    got = {r.id: r.members for r in identity.collision_groups(spark.createDataFrame(rows, "doc_id long, text string, source string"), "doc_id").collect()}
    assert got[0] == got[1] == got[2] == 3 and got[8] == got[9] == 1


def test_similar_pairs(spark):
    ship_package(spark)
    a = "the quick brown fox jumps over the lazy dog again and again"
    rows = [(1, a), (2, a[:-1] + "m"), (3, "the quick" + a[::-1]), (4, "short")]
    assert [(r.a, r.b) for r in identity.similar_pairs(spark.createDataFrame(rows, "id long, text string")).collect()] == [(1, 2)]


def test_lexicon_hits_of_all_documents(spark, tmp_path):
    import __spark_entry__ as entry

    odd = [(9001, "the_the éthe theé THE of, the1 of\nthe", "fr"), (9002, None, "en"), (9003, "", "de")]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    docs.unionByName(spark.createDataFrame(odd, "doc_id long, text string, lang string")).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: (r.the_hits, r.of_hits) for r in entry.queries()["lexicon_hits_all_documents"](spark, str(tmp_path)).collect()}

    def hits(text, term):
        words = [w for w in re.split(r"[^A-Za-z0-9]+", text)]
        return sum(w.lower() == term for w in words)

    wanted = {i: (None, None) if t is None else (hits(t, "the"), hits(t, "of")) for i, t in [*((r.doc_id, r.text) for r in docs.collect()), *((i, t) for i, t, _ in odd)]}
    assert got == wanted and got[9001] == (6, 2)


def test_rescale_gives_a_row_for_each_document(spark, tmp_path):
    import __spark_entry__ as entry

    spark.createDataFrame([(k, n) for k, n in enumerate([0, 1, 40001, 40002, 128657])], "doc_id long, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in entry.queries()["native_rating_rescale_all_documents"](spark, str(tmp_path)).collect()}
    assert [got[k].score for k in range(5)] == [None, -5.0, 5.0, None, None]
    assert all(got[k].bounded == pytest.approx(5 * x / (x * x + 15) ** 0.5, abs=1e-6) for k, x in enumerate(n % 13 - 6 for n in [0, 1, 40001, 40002, 128657]))


def test_page_entities_by_the_whole_canonical_form(spark, tmp_path):
    import hashlib

    import __spark_entry__ as entry

    listed = ["http://a.com:80/x?utm_medium=1&b=2", "http://A.com/x?b=2&gclid=3#t", "http://a.com/%78?b=2", "http://10.0.0.1/x", "http://10.0.0.1/x", "http://b.com/", None]
    html = ["p0", "p1", "p2", "p3", "p4", "p5", "p3"]
    spark.createDataFrame([(k, u, h) for k, (u, h) in enumerate(zip(listed, html, strict=True))], "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = {r.source_id: r.entity for r in entry.queries()["page_entities_canonical"](spark, str(tmp_path)).collect()}

    def name(kind, text):
        return f"PAGE-{kind}-{hashlib.sha256(text.encode()).hexdigest()[:24]}"

    # 3 and 6 share their content only
    a = name("URL", urls.canonical(listed[0]))
    assert [got[k] for k in range(7)] == [a, a, a, name("LEGACY", "3|6"), name("LEGACY", "4"), name("URL", "http://b.com/"), name("LEGACY", "3|6")]


def near_texts(seed, n):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé😀") for _ in range(rng.randint(2, 7))) for _ in range(60)]
    out = []
    for _ in range(n):
        if out and rng.random() < 0.7:
            text = list(rng.choice(out))
            for _ in range(rng.choice([0, 1, 5, len(text) // 12]) if len(text) > 30 else 0):
                at = rng.randrange(8, max(9, len(text)))
                text[at : at + rng.randint(0, 3)] = rng.choice(["", "x", "yz"])
            out.append("".join(text))
        else:
            out.append(" ".join(rng.choice(words) for _ in range(rng.choice([4, 40, 200]))))
    return out


def brute_near(texts):
    """(a, b) -> ratio of all pairs of J8, on whole texts."""
    out = {}
    for b, y in enumerate(texts):
        for a, x in enumerate(texts[:b]):
            if min(len(x), len(y)) >= 16 and min(len(x), len(y)) >= 0.85 * max(len(x), len(y)) and (x[:8] == y[:8] or x[-10:] == y[-10:]):
                found = difflib.SequenceMatcher(None, x, y, False).ratio()
                if found >= 0.92:
                    out[a, b] = found
    return out


def test_matched_is_difflibs():
    texts = near_texts(1, 60)
    for x, y in zip(texts, texts[1:] + texts[:1], strict=True):
        wanted = sum(m.size for m in difflib.SequenceMatcher(None, x, y, False).get_matching_blocks())
        assert identity.matched(x, y, 0) == wanted and identity.matched(x, y, wanted + 1) is None


def test_half_a_common_subsequence_rules_out_no_pair():
    rng = random.Random(4)
    for _ in range(4000):
        x, y = ("".join(rng.choice("abc") for _ in range(rng.randint(0, 25))) for _ in "xy")
        if rng.random() < 0.5:
            y = "".join(rng.choice(["", c, c, c, c + "a"]) for c in x)
        table = [[0] * (len(y) + 1)]
        for c in x:
            row = [0]
            for k, d in enumerate(y):
                row.append(table[-1][k] + 1 if c == d else max(row[-1], table[-1][k + 1]))
            table.append(row)
        assert identity.common_subsequence(x, y) == table[-1][-1]
        m = sum(b.size for b in difflib.SequenceMatcher(None, x, y, False).get_matching_blocks())
        assert identity.may_match(x, y, m)
        value = 2 * m / (len(x) + len(y)) if x or y else 1.0
        assert not value or not (x or y) or identity.ratio(x, y, value) == value


@pytest.mark.parametrize("tile", [8, 4096])
def test_similar_pairs_of_whole_texts(spark, monkeypatch, tile):
    monkeypatch.setattr(identity, "TILE", tile)
    ship_package(spark)
    texts = near_texts(2, 120)
    least = [texts.index(t) for t in texts]
    wanted = brute_near(texts)
    got = {(r.a, r.b): r.ratio for r in identity.similar_pairs(spark.createDataFrame(list(enumerate(texts)), "id long, text string")).collect()}
    assert got == {p: r for p, r in wanted.items() if (least[p[0]], least[p[1]]) == p or p[0] == least[p[1]]}
    # every pair follows from the classes
    assert all(least[a] == least[b] or (min(least[a], least[b]), max(least[a], least[b])) in got for a, b in wanted)


def test_collision_groups_join_near_texts_with_other_tails(spark, tmp_path):
    import __spark_entry__ as entry

    texts = near_texts(5, 60) + ["A long enough text that only its very end tells from the other, one", "A long enough text that only its very end tells from the other, two", None, "", "short"]
    rows = [(i, t, "s" if i >= 60 else f"s{i % 2}") for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    forms = [re.sub(r"\s+", " ", re.sub(r"[\s.,;:!?]+$", "", t or "")).strip().lower() for t in texts]
    tails = collections.defaultdict(list)
    for i, f in enumerate(forms):
        tails[f[-20:] if len(f) >= 24 else i].append(i)
    links = [*brute_near(forms), *((g[0], x) for g in tails.values() if len(g) >= 3 for x in g), *((forms.index(f), i) for i, f in enumerate(forms) if f)]
    group = list(range(len(texts)))
    for a, b in links:
        low, high = sorted((group[a], group[b]))
        group = [low if g == high else g for g in group]
    got = {r.id: r for r in entry.queries()["collision_groups"](spark, str(tmp_path)).collect()}
    assert [got[i].group for i in range(len(texts))] == group
    assert got[60].status == got[61].status == "duplicated_extraction" and got[64].status == "unique"


def test_near_dup_pairs_compare_what_follows_the_first_line(spark):
    import __spark_entry__ as entry

    texts = {f"turn:{r.conv_id}:{r.turn}": r.text for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").collect()}
    texts |= {f"document:{r.doc_id}": r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = entry.queries()["near_dup_pairs_blocked"](spark, "/root/testdata/sf0.001").collect()
    assert any(r.a.startswith("document:") and r.ratio < 1 for r in got)
    assert all(r.ratio < 1 or texts[r.a] == texts[r.b] for r in got)


@pytest.mark.parametrize(
    "url, wanted",
    [
        ("HTTP://Www.Example.COM:80/a//b/../c/?utm_source=x&b=2&b=1#top", "http://www.example.com/a//b/../c/?b=2&b=1"),
        ("https://example.com/%7Euser/%2E%2e/x", "https://example.com/~user/%2E%2E/x"),
        ("https://example.com/?utm_medium=a", "https://example.com/"),
        ("https://example.com/?", "https://example.com/?"),
        ("https://example.com/p?token=1&utm_source=a", "https://example.com/p?token=1&utm_source=a"),
        ("https://user@example.com/", None),
        ("http://127.0.0.1/x", None),
        ("ftp://example.com/", None),
        ("http://host.local/", None),
        (None, None),
    ],
)
def test_canonical(url, wanted):
    assert urls.canonical(url) == wanted


def test_registrable(spark):
    assert one(spark, urls.registrable, "a.b.example.co.uk") == "example.co.uk"
    assert one(spark, urls.registrable, "a.example.com") == "example.com"


@pytest.mark.parametrize("value, wanted", [("hello", "latin"), ("你好世界", "cjk"), ("你好 abcde", "mixed"), ("123", "none")])
def test_language(spark, value, wanted):
    assert one(spark, text.language, value) == wanted


def test_tokens_and_clauses(spark):
    assert sorted(one(spark, text.token_set, "Walking tried walked boxes cats 你好吗")) == sorted(["walk", "try", "box", "cat", "你好", "好吗", "你好吗"])
    assert one(spark, text.clauses, "one! two；three\n ; four") == ["one", "two", "three", "four"]
    assert one(spark, text.without_repeats, "a\na\n\nb\na") == "a\nb\na"


def test_term_boundaries(spark):
    assert one(spark, lambda c: text.term_hits(c, "cat"), "Cat concat cat. cats") == 2


@pytest.mark.parametrize(
    "value, wanted",
    [("good", 1.0), ("not good", -1.0), ("very good", 1.4), ("good!", 1.0), ("maybe good", 0.75), ("bad but good", 1.25 - 0.75), ("非常好", 1.5), ("no hits here at all x", 0.0)],
)
def test_lexicon(value, wanted):
    book = semantics.Codebook(positive={"good": 1.0, "好": 1.0}, negative={"bad": 1.0})
    assert semantics.Reader(book).read(value)[6] == pytest.approx(wanted)


def test_sentiment_columns(spark):
    ship_package(spark)
    rows = semantics.sentiment(spark.createDataFrame([("good good good",), ("bad",), (None,), ("good good good bad",)], "text string"), semantics.Codebook(positive={"good": 1.0}, negative={"bad": 1.0})).collect()
    assert [r.sentiment for r in rows] == ["positive", "negative", "na", "positive"]


def test_kappa_and_alpha(spark):
    same = spark.createDataFrame([(1, 1), (0, 0)], "a int, b int")
    assert agreement.cohen_kappa(same).first().kappa == 1.0
    assert agreement.cohen_kappa(same.where("a > 5")).first().kappa is None
    assert agreement.cohen_kappa(spark.createDataFrame([(1, 1), (1, 1)], "a int, b int")).first().kappa == 1.0
    ratings = spark.createDataFrame([(1, 0), (1, 0), (2, 1), (2, 1), (3, 1)], "unit int, label int")
    assert agreement.krippendorff_alpha(ratings).first().alpha == 1.0


def test_times(spark):
    assert one(spark, times.strict_timestamp, "2024-01-01 10:00") is None
    assert one(spark, times.strict_timestamp, "2024-01-01T10:00:00+02:00") is not None
    assert one(spark, times.partial_date, "2024-02").precision == "month"
    assert one(spark, times.partial_date, "2024-02-31") is None


CONTACTS = [
    ("write to a.b@example.com now", ["email"]), ("+86 13912345678!", ["mobile"]), ("x13912345678", []), ("phone: +1 (202) 555-0100 or", ["contact"]), ("微信：abc_12345。", ["account"]), ("account  user.name-1", ["account"]),
    ("see https://x.org/users/anna?a=1，now", ["profile", "url_identifier"]), ("https://x.org/item/13912345678 ok", []), ("https://x.org/?id=13912345678", []), ("https://x.org/?tel=13912345678", ["contact", "mobile", "url_identifier"]), ("https://x.org/?q=a%40b.org", ["url_identifier"]),
    ("https://x.org/a#13912345678", ["mobile", "url_identifier"]), ("https://[bad/13912345678", ["mobile", "url_identifier"]), ("https://x.org/phone/12", []), ("https://x.org/contact/13912345678", ["mobile", "url_identifier"]), ("é😀 a@b.org é", ["email"]), ("", []), (None, []),
    ("a@b.org c@d.org 13912345678", ["email", "email", "mobile"]), ("nothing here", []),
]


def test_contact_spans_and_exemptions(spark):
    ship_package(spark)
    got = spark.createDataFrame([(t,) for t, _ in CONTACTS], "t string").select(privacy.contact_spans(F.col("t")).alias("s"), privacy.masked(F.col("t")).alias("m")).collect()
    for (given, kinds), r in zip(CONTACTS, got, strict=True):
        assert sorted(x.kind for x in r.s) == kinds, given
        wanted = given and "".join(privacy.MARK if any(x.start <= i < x.end for x in r.s) else c for i, c in enumerate(given))
        assert r.m == wanted
        assert privacy.spans_of(r.m) == []
    assert spark.createDataFrame(CONTACTS[:3], "t string, k array<string>").where(privacy.has_private(F.lit(None).cast("string"), F.col("t"))).count() == 2


def test_contact_mask_leaves_nothing(spark):
    import __spark_entry__ as entry

    rows = entry.queries()["contact_mask"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 200 and all(r.same_length and not r.left for r in rows)


def test_spans_of_a_long_text_are_found_in_linear_time():
    import time

    began = time.process_time()
    assert len(privacy.spans_of("a@b.org 13912345678 https://x.org/?id=13912345678 " * 20_000)) == 40_000
    assert time.process_time() - began < 30


def test_strict_json(spark):
    ship_package(spark)
    df = spark.createDataFrame([('{"a": 1}',), ('{"a": 1, "a": 2}',), ('{"a": NaN}',), ("{",)], "x string")
    assert [r.y for r in df.select(readers.strict_json(F.col("x")).alias("y")).collect()] == [None, "duplicate_key", "not_finite", "not_json"]


def test_provider_results(spark):
    bodies = [json.dumps({"organic": [{"link": "http://a.com/1", "title": "t"}]}), json.dumps({"web": {"results": [{"url": "http://b.com"}]}}), "see http://c.com/x and http://d.com."]
    df = spark.createDataFrame(list(enumerate(bodies)), "id int, body string")
    assert sorted((r.id, r.url) for r in readers.provider_results(df).collect()) == [(0, "http://a.com/1"), (1, "http://b.com"), (2, "http://c.com/x"), (2, "http://d.com.")]


def test_visible_text_holds_few_pages(spark):
    import pyarrow as pa

    pages = [f"<p>{k}<p>{k}<script></script>" if k % 2 else None for k in range(3 * readers.ROWS + 5)]
    parts = list(readers.visible_text.func(iter([pa.array(pages, pa.string()), pa.array([], pa.string())])))
    assert max(map(len, parts)) == readers.ROWS
    assert [x for part in parts for x in part.to_pylist()] == [{"text": str(k), "level": "unconfirmed"} if k % 2 else {"text": "", "level": "confirmed"} for k in range(len(pages))]
    got = spark.createDataFrame(list(enumerate(pages)), "k int, h string").select("k", readers.visible_text("h").alias("v")).collect()
    assert {r.k: r.v.text for r in got} == {k: str(k) if k % 2 else "" for k in range(len(pages))}


def test_visible_text(spark):
    ship_package(spark)
    page = "<head><title>x</title></head><body><p>Hello&nbsp;you</p><p>Hello you</p><div style='display:none'>no<p>no</p></div><script>var a</script>tail"
    row = spark.createDataFrame([(page,)], "h string").select(readers.visible_text("h").alias("v")).first().v
    assert (row.text, row.level) == ("Hello you\ntail", "unconfirmed")


def test_ledger_blobs_and_manifest(spark, tmp_path):
    (tmp_path / "l.csv").write_text("﻿id,name\n1, a \n2,\n", encoding="utf-8")
    assert [tuple(r) for r in readers.read_ledger(spark, str(tmp_path / "l.csv")).collect()] == [("1", "a"), ("2", "")]
    sinks.write_blobs(spark.createDataFrame([("x",), ("x",), ("y",)], "body string"), str(tmp_path / "b"))
    assert spark.read.parquet(str(tmp_path / "b")).count() == 2
    before = sinks.manifest(spark, str(tmp_path / "b")).where("path like '%.parquet'")
    assert sinks.changed(before, before).count() == 0


def test_overlay(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, v string")
    sha = base.select("id", F.sha2("v", 256).alias("h")).collect()
    by = {r.id: r.h for r in sha}
    changes = [(1, 1, "retract", None, None), (2, 1, "patch", by[2], "B"), (3, 1, "patch", "stale", "C")]
    got = identity.overlay(base, spark.createDataFrame(changes, "id int, seq int, action string, before_sha256 string, v string"), "id", ["v"])
    assert sorted(tuple(r) for r in got.collect()) == [(2, "B"), (3, "c")]


def test_streaming_counts_match_batch(spark, tmp_path):
    source = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    source.unionByName(source.limit(50)).repartition(3).write.parquet(str(tmp_path / "in"))
    stream = events.windowed(events.read_events(spark, str(tmp_path / "in")), "1 day")
    query = stream.writeStream.format("memory").queryName("windows").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    query.awaitTermination(60)
    assert spark.table("windows").agg(F.sum("n")).first()[0] == source.count() + 50


def test_streaming_states(spark, tmp_path):
    ship_package(spark)
    source = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    source.write.parquet(str(tmp_path / "in"))
    query = (
        events.route_states(events.read_events(spark, str(tmp_path / "in"), 100))
        .writeStream.format("memory").queryName("states").outputMode("update").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    )
    query.awaitTermination(90)
    assert spark.table("states").agg(F.sum("n")).first()[0] == source.count()


def test_termination_needs_every_fact_and_takes_the_first(spark):
    facts = {n: F.lit(False) for n, _ in execution.OUTCOMES[:-1]}
    row = spark.range(1).select(
        execution.termination(facts).alias("none"), execution.termination(facts | {"target_met": F.lit(True), "round_sequence_incomplete": F.lit(True)}).alias("met")
    ).first()
    assert (row.none.outcome, row.none.terminal) == ("evidence_shortfall", False) and (row.met.outcome, row.met.terminal) == ("target_met", True)
    with pytest.raises(ValueError):
        execution.termination({})


def test_planning_account_reserves_unused_retries(spark):
    from quillspark.operators import budgets

    told = budgets.account(*[F.lit(x) for x in (50, 60, 60, 72, 2, 5, 6, 4)])
    row = spark.range(1).select(told.alias("x")).first().x
    assert (row.intents_left, row.attempts_left, row.retries_left, row.feasible) == (10, 12, 3, False)
    assert row.reasons == ["actual_attempt_budget_infeasible"]


def test_quota_sets_later_rounds_aside(spark):
    from quillspark.operators import budgets

    # two of five rounds are done, none an enhancement: three enhancement rounds of 10 are still due
    row = spark.range(1).select(budgets.quota(F.lit(16), F.lit(2), F.lit(0), F.lit(False)).alias("q")).first().q
    assert (row.reserved, row.available, row.quota, row.reached) == (30, 2, 2, False)


def test_target_is_met_only_by_every_dimension(spark):
    from quillspark.operators import budgets

    rows = [(d, 100 if d else 24, 4) for d in range(7)]
    got = budgets.target_status(spark.createDataFrame(rows, "dim int, scored int, rank int"), "medium").orderBy("dim").collect()
    assert [r.met for r in got] == [False] + [True] * 6 and got[0].total == 624 and not got[0].target_met and got[0].gap == 1
    assert all(r.scored == 0 for r in budgets.target_status(spark.createDataFrame([], "dim int, scored int, rank int"), "high").collect())


def test_lifecycle_wants_proof(spark):
    from quillspark.operators import audits

    rows = [("exhausted_with_shortfall", True), ("exhausted_with_shortfall", False), ("made_up", True), ("", True)]
    df = spark.createDataFrame(rows, "s string, ok boolean")
    no = F.lit(False)
    got = [r.x.lifecycle for r in df.select(audits.lifecycle(F.col("s"), no, no, F.col("ok"), no, no).alias("x")).collect()]
    assert got == ["verified_exhausted_shortfall", "actionable", "invalid", "actionable"]


def test_repair_plans(spark):
    from quillspark.operators import costs

    schema = "origin string, scope string, upstream_valid boolean, new_run boolean"
    plans = {
        "no_repair_needed": [], "one_downstream_rebuild_permitted": [("report", "generator_code", True, False)], "manual_code_fix_required": [("report", "elsewhere", True, False)],
        "terminal_root_cause_requires_new_run": [("report", "generator_code", True, False), ("semantic", "x", False, False)],
    }
    for status, rows in plans.items():
        assert costs.repair_plan(spark.createDataFrame(rows, schema)).first().status == status


def test_costs_count_a_replayed_event_once(spark):
    from quillspark.operators import costs

    events = spark.createDataFrame([("a", 2, None), ("a", 2, None), ("b", 3, None)], "event_id string, calls long, tokens long")
    row = costs.totals(events, ["calls", "tokens"]).first()
    assert row.calls == 5 and row.tokens is None
    assert costs.totals(events.limit(0), ["calls"]).first().calls == 0


def test_bindings_do_not_depend_on_order(spark):
    from quillspark.operators import links

    rows = [(i, f"t{i % 3}") for i in range(50)]
    one, two, three = (spark.createDataFrame(r, "id long, t string") for r in (rows, rows[::-1], rows[:-1]))
    seals = [links.seal(links.bound({"x": (df, ["id", "t"])})).first().seal for df in (one, two, three)]
    assert seals[0] == seals[1] != seals[2]


def test_replace_all_keeps_the_old_version_until_the_end(spark, tmp_path):
    from quillspark.sources import sinks

    root = str(tmp_path / "ledgers")
    first, second = ({"a": spark.range(n), "b": spark.range(n + 1)} for n in (3, 5))
    sinks.replace_all(spark, first, root)
    spark.range(9).write.parquet(f"{root}/v-unfinished/a")
    assert sinks.current(spark, root, "a").count() == 3
    sinks.replace_all(spark, second, root)
    assert sinks.current(spark, root, "a").count() == 5 and sinks.current(spark, root, "b").count() == 6


def scattered(seed, n, letters, size):
    """Texts that are edited at both ends and anywhere, cut or lengthened down to 0.76 of one another."""
    rng = random.Random(seed)
    out = ["", "a", "ab"]
    while len(out) < n:
        base = "".join(rng.choice(letters) for _ in range(rng.randint(20, size)))
        out.append(base)
        for _ in range(rng.randint(0, 4)):
            text = list("".join(rng.choice(letters) for _ in range(2)) + base[2:-2] + "".join(rng.choice(letters) for _ in range(2)))
            for _ in range(rng.randint(0, max(1, len(base) // rng.choice([8, 12, 20])))):
                at = rng.randrange(len(text))
                text[at : at + rng.randint(0, 2)] = rng.choice(["", rng.choice(letters), rng.choice(letters) * 2])
            cut = rng.choice([0, 0, rng.randint(0, len(base) // 5)])
            out.append("".join(text)[cut:] or "x")
    return out


def brute_ratios(texts, least):
    matchers = [difflib.SequenceMatcher(None, "", y, False) for y in texts]

    def compared(x, matcher):
        matcher.set_seq1(x)
        return matcher.ratio() if matcher.real_quick_ratio() >= least and matcher.quick_ratio() >= least else 0

    return {(a, b): r for b, m in enumerate(matchers) for a, x in enumerate(texts[:b]) if (r := compared(x, m)) >= least}


@pytest.mark.parametrize("letters,tile", [("abcdefghijklmnopqrstuvwxyz", 16), ("ab", 4096), ("the quick brown fox", 4096)])
def test_best_earlier_is_complete(spark, monkeypatch, letters, tile):
    """No pair is lost, wherever the texts differ: equal to the comparison of all pairs."""
    monkeypatch.setattr(identity, "TILE", tile)
    ship_package(spark)
    texts = scattered(len(letters), 110, letters, 80) + ["x" * 40, None]
    known = [t for t in texts if t is not None]
    wanted = brute_ratios(known, 0.92)
    assert sum(x[:8] != y[:8] and x[-10:] != y[-10:] for x, y in ((known[a], known[b]) for a, b in wanted)) > 10
    got = {r.id: (r.of, r.ratio) for r in identity.best_earlier(spark.createDataFrame(list(enumerate(texts)), "id long, text string")).collect()}
    best = {}
    for (a, b), r in sorted(wanted.items()):
        if r > best.get(b, (0, 0))[1]:
            best[b] = (a, r)
    assert got == best


@pytest.mark.parametrize("letters", ["abcdefghijklmnopqrstuvwxyz", "天地人日月山水火木金土上下左右大小多少"])
def test_narratives_are_complete(spark, letters):
    ship_package(spark)
    texts = [t for t in scattered(7, 90, letters, 200) if t]
    rng = random.Random(11)
    longer = [t + "".join(rng.choice(letters) for _ in range(len(t) * k // 100)) for t in texts[:40] for k in (12, 30)]
    texts += longer
    grams = [{t[i : i + 5] for i in range(len(t) - 4)} for t in texts]
    kept = {i for i, t in enumerate(texts) if len(t) >= 80}
    jaccard = lambda a, b: len(grams[a] & grams[b]) / len(grams[a] | grams[b]) if grams[a] | grams[b] else 0.0
    least = {t: i for i, t in reversed(list(enumerate(texts)))}
    near = {p: r for p, r in brute_ratios(texts, 0.86).items() if set(p) <= kept and (r >= 0.92 or jaccard(*p) >= 0.78)}
    assert min(near.values()) < 0.92
    wanted = set(near)
    wanted = {p for p in wanted if texts[p[0]] == texts[p[1]] and least[texts[p[1]]] == p[0] or texts[p[0]] != texts[p[1]] and all(least[texts[i]] == i for i in p)}
    units = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    found = identity.narrative_pairs(units, least_cjk=0 if letters < "\x7f" else 60).collect()
    assert {(r.a, r.b) for r in found} == wanted
    assert all(abs(r.jaccard - jaccard(r.a, r.b)) < 1e-9 for r in found)


def test_char_grams_of_short_texts(spark):
    got = spark.createDataFrame([("abcd",), ("abcde",), ("aaaaaaa",), ("",), (None,)], "t string").select(text.char_grams(F.col("t")).alias("g")).collect()
    assert [r.g for r in got] == [[], ["abcde"], ["aaaaa"], [], []]


def test_best_earlier_and_narratives(spark):
    ship_package(spark)
    prose = "the quick brown fox jumps over the lazy dog again and again until the evening comes and it sleeps at last"
    rows = [(1, prose), (2, prose[:-1] + "m"), (3, prose), (4, "another text that is not like any of the others at all"), (5, None)]
    units = spark.createDataFrame(rows, "id long, text string")
    best = {r.id: (r.of, r.ratio) for r in identity.best_earlier(units).collect()}
    assert best[3] == (1, 1.0) and best[2][0] == 1 and set(best) == {2, 3}
    pairs = {(r.a, r.b): r.jaccard for r in identity.narrative_pairs(units, least=60, least_cjk=0).collect()}
    assert set(pairs) == {(1, 2), (1, 3)} and pairs[1, 3] == 1.0
    assert identity.narrative_pairs(units).count() == 0


def test_token_set_of_short_cjk_runs(spark):
    df = spark.createDataFrame([("很好吃 walking",), ("非常",)], "t string")
    assert [set(r.x) for r in df.select(text.token_set(F.col("t")).alias("x")).collect()] == [{"很好吃", "很好", "好吃", "walk"}, set()]


def test_degree_of_two_words_at_one_place():
    reader = semantics.Reader(semantics.Codebook(degrees={"very": 1.4, "very much": 1.7}))
    assert reader.degree("slightly, very ") == 1.4 and reader.degree("none") == 1.0


def test_wave_size(spark):
    from quillspark.operators import budgets

    row = spark.range(1).select(budgets.wave_size(F.lit(10), F.lit(5), F.lit(10)).alias("a"), budgets.wave_size(F.lit(10), F.lit(0), F.lit(3)).alias("b")).first()
    assert (row.a, row.b) == (20, 24)


def test_tables_of_one_file_are_dealt_to_all_cores(spark, monkeypatch):
    from quillspark import session

    few = session.table(spark, "/root/testdata/sf0.001", "documents")
    assert few.rdd.getNumPartitions() == 1
    monkeypatch.setattr(session, "SPREAD_BYTES", 1)
    spread = session.table(spark, "/root/testdata/sf0.001", "documents")
    assert spread.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and spread.count() == few.count()


def test_best_earlier_of_every_twentieth(spark):
    """Queries are the ids divisible by 20, compared with all earlier texts: the same as those rows of the whole answer."""
    ship_package(spark)
    texts = scattered(3, 60, "the quick brown fox", 80)
    units = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    whole = {r.id: (r.of, r.ratio) for r in identity.best_earlier(units).collect()}
    some = {r.id: (r.of, r.ratio) for r in identity.best_earlier(units, every=20).collect()}
    assert some == {k: v for k, v in whole.items() if k % 20 == 0}


def test_tiles_hold_each_text_at_most_twice_in_a_block(spark):
    """A text of a small block is in one tile of it, and a text without a partner of its length in none."""
    rows = [(k, "A beginning " + str(k) * 30) for k in range(5)] + [(9, "A beginning " + "x" * 900)]
    tiles, _, _ = identity.block_tiles(spark.createDataFrame(rows, "id long, text string"), "id", 0.92, True, 16)
    assert sorted(r.id for r in tiles.where("not suffix").collect()) == [0, 1, 2, 3, 4]


def test_links_join_what_pairs_do_with_few_of_them(spark):
    ids, texts = np.arange(40), np.array([("the same words " * 12)[:150] + f"{k:02d}" for k in range(40)], object)
    tile = identity.Tile(ids, texts, np.zeros(40, bool), np.zeros(40, int), 0, 0, False, False)
    assert len(list(identity.pairs_of(0.92)(tile))) == 780 and len(list(identity.links_of(0.92)(tile))) == 39


def test_many_partners_are_ruled_out_as_one_by_one():
    rng = random.Random(5)
    for size, letters in ((40, "ab"), (300, "the quick brown"), (1200, "abcdefghijklmnop天地"), (700, "a")):
        text = "".join(rng.choice(letters) for _ in range(size))
        others = ["".join(c if rng.random() > p else rng.choice(["", "x", c + "y"]) for c in text) for p in (0, 0.02, 0.05, 0.1, 0.15, 0.3) for _ in range(8)]
        others += ["".join(rng.choice(letters) for _ in range(size + k)) for k in range(-5, 6)] + ["", text[: size // 2]]
        got = identity.may_match_all(text, others, 0.92)
        for other, fits in zip(others, got.tolist(), strict=True):
            n, m = size, len(other)
            needed = 0.92 * (n + m) / 2 - 1e-6
            missed, ahead = int(np.floor(n - needed)), int(np.floor(m - needed))
            kept = n // 4 - missed
            assert fits == (missed >= 0 and ahead >= 0 and (kept <= 0 or identity.common_subsequence(text[: n // 4], other, kept + ahead) >= kept))
            assert fits or not identity.ratio(text, other)
        assert 10 < got.sum() <= len(others)


def test_best_earlier_pages_asks_for_every_page(spark, tmp_path):
    """A page whose id 20 does not divide has its earlier one too."""
    from quillspark.plans.content_queries import best_earlier_pages

    words = "the quick brown fox jumps over the lazy dog again and again until the evening comes"
    pages = [(7, f"<p>{words}</p>"), (13, f"<p>{words}!</p>"), (20, "<p>no other page has anything like this text</p>"), (40, f"<p>{words}</p>")]
    spark.createDataFrame(pages, "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert {(r.id, r.of) for r in best_earlier_pages(spark, str(tmp_path)).collect()} == {(13, 7), (40, 7)}


@pytest.mark.parametrize("stretch,sketched", [(20, 0), (20, 1 << 20), (1 << 20, 0)])
def test_bounds_of_best_earlier_rule_no_near_pair_out(monkeypatch, stretch, sketched):
    """Whatever is left out of either text, and wherever: a long part at one end, or single characters all over."""
    monkeypatch.setattr(identity, "STRETCH", stretch)
    monkeypatch.setattr(identity, "SKETCHED", sketched)
    rng = random.Random(stretch + sketched)
    texts = scattered(4, 60, "the quick brown fox", 300)
    for size in (100, 400, 900):
        base = "".join(rng.choice("abcdefghijklmno pqr") for _ in range(size))
        part = int(size * 0.079)
        other = "".join(rng.choice("uvwxyz") for _ in range(part))
        gaps = set(rng.sample(range(size), part))
        texts += [base, base[part:] + other, other + base[:-part], base[: size // 2] + other + base[size // 2 + part :]]
        texts += ["".join(c for k, c in enumerate(base) if k not in gaps), "".join(rng.choice("uvw") if k in gaps else c for k, c in enumerate(base)), base + other + other]
    near = brute_ratios(texts, 0.92)
    assert len(near) > 40
    layers = identity.Layers(list(range(len(texts))), texts, max(map(len, texts)), 0.92)
    flags, found = np.zeros(layers.flags, bool), {}
    for x, row in enumerate(layers.rows.tolist()):
        places, bounds = layers.near(x, layers, x + 1, flags)
        assert not flags.any()
        fits = identity.may_align(texts[row], [layers.texts[y] for y in places.tolist()], 0.92) if len(places) else []
        found |= {tuple(sorted((row, int(layers.rows[y])))): b for y, b, f in zip(places.tolist(), bounds.tolist(), fits, strict=True) if f}
    assert all(found.get(pair, 0) >= value - 1e-9 for pair, value in near.items())
    assert len(found) < len(texts) * (len(texts) - 1) / 4


def prose(rng, words, n, start):
    made = start
    while len(made) < n:
        made += rng.choice(words) + " "
    return made[:n]


def test_unlike_texts_of_a_block_are_told_apart_by_their_long_blocks(monkeypatch):
    """collision_groups and near_dup_pairs_blocked: texts of one beginning and few words share their grams, but no common subsequence is made of them (F1, F2)."""
    rng = random.Random(5)
    words = ["".join(rng.choice("etaoinshr") for _ in range(rng.randint(2, 6))) for _ in range(60)]
    texts = [prose(rng, words, rng.randint(5000, 5400), "one beginning for all of them: ") for _ in range(90)]
    texts.append(texts[0][:2000] + texts[0][2100:])
    tile = identity.Tile(np.arange(len(texts)), np.array(texts, object), np.zeros(len(texts), bool), np.zeros(len(texts), int), 0, 0, False, False)
    tried = []
    for name in ("may_match_all", "may_match"):
        plain = getattr(identity, name)
        monkeypatch.setattr(identity, name, lambda a, b, needed, plain=plain: tried.extend([b] if isinstance(b, str) else b) or plain(a, b, needed))
    assert [(a, b) for a, b, _ in identity.pairs_of(0.92)(tile)] == [(0, 90)]
    assert len(tried) < 400  # of 4,095 pairs


@pytest.mark.parametrize("outlined", [1, 1000])
def test_candidates_rule_no_near_pair_out(monkeypatch, outlined):
    """pairs_of gives what difflib gives for all pairs, whichever bounds are tried (F1, F2)."""
    monkeypatch.setattr(identity, "OUTLINED", outlined)
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdeé漢") for _ in range(rng.randint(1, 5))) for _ in range(25)]
    texts = []
    for n in (40, 300, 320, 700):
        for _ in range(4):
            base = prose(rng, words, n, "same head ")
            texts.append(base)
            for share in (0.03, 0.06, 0.09):
                out = list(base)
                for _ in range(int(share * n)):
                    k = rng.randrange(len(out))
                    out[k : k + 1] = rng.choice(["", "x", out[k] + "e"])
                texts.append("".join(out))
            cut = rng.randrange(n)
            texts.append(base[cut:] + base[:cut])
    rng.shuffle(texts)
    tile = identity.Tile(np.arange(len(texts)), np.array(texts, object), np.zeros(len(texts), bool), np.zeros(len(texts), int), 0, 0, False, False)
    got = {(a, b): r for a, b, r in identity.pairs_of(0.92)(tile)}
    want = brute_ratios(texts, 0.92)
    assert len(want) > 10 and got.keys() == want.keys()
    assert all(abs(got[pair] - want[pair]) < 1e-9 for pair in want)


def test_comparison_forms_are_those_of_the_plain_patterns(spark):
    texts = ["", None, " ", "a  b", "a \n b.", "\n\n a\t", "x. ", "x.\n", "x. \u0085", "x.\u2028", "**", "***a**. ", "a*b█.!", "。！ ", "é。\r\n", " . ", "a\x0bb", "a\x1cb \x1c", "b\n. ", "x\u3000。", "*.*", "a.**", "x **."]
    plain = F.regexp_replace(F.regexp_replace("text", r"\*{2,}|█+", ""), r"(?<![\s.,;:!?。！？；，、])[\s.,;:!?。！？；，、]+$", "")
    plain = F.lower(F.trim(F.regexp_replace(plain, r"\s+", " ")))
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select("text", plain.alias("plain"), text.comparison_form(F.col("text")).alias("form")).collect()
    assert [(r.text, r.form) for r in rows] == [(r.text, r.plain) for r in rows]


def test_narratives_of_few_letters_are_told_apart_by_their_characters(monkeypatch):
    """narrative_near_duplicates: the characters of two texts are counted before their sketches are compared."""
    rng = random.Random(3)
    texts = [prose(rng, ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 7))) for _ in range(40)], rng.randint(280, 300), "") for _ in range(200)]
    texts.append(texts[0][:100] + texts[0][110:])
    tile = identity.Tile(np.arange(len(texts)), np.array(texts, object), np.zeros(len(texts), bool), np.zeros(len(texts), int), 0, 0, False, False)
    compared, plain = [], identity.shared_bits
    monkeypatch.setattr(identity, "shared_bits", lambda rows, one: compared.append(rows.size) or plain(rows, one))
    assert [(a, b) for a, b, *_ in identity.templates_of(0.92, 0.86, 0.78)(tile)] == [(0, 200)]
    assert sum(compared) < 1_000_000  # words


def test_shared_bits_are_counted_in_lanes():
    rng = np.random.default_rng(1)
    for words in (8, 16, 72, 1016, 1024, 4000):
        rows = rng.integers(0, 1 << 63, (5, words), dtype=np.uint64)
        rows[4] = np.uint64((1 << 64) - 1)
        for one in rows:
            assert identity.shared_bits(rows, one).tolist() == np.bitwise_count(rows & one).sum(axis=1, dtype=np.int64).tolist()


def test_narrative_forms_are_those_of_the_plain_patterns(spark):
    texts = ["", None, "See HTTPS://a.b/c?d e", "http:/x", "x://y", "a--b  c", "天 地1人", "hTTp://", "É é", "a\nhttp://b\nc"]
    plain = F.lower(F.regexp_replace(F.regexp_replace("text", r"(?i)https?://\S+", ""), r"[^\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}A-Za-z]", ""))
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select("text", plain.alias("plain"), text.narrative_form(F.col("text")).alias("form")).collect()
    assert [(r.text, r.form) for r in rows] == [(r.text, r.plain) for r in rows]


def test_long_unlike_pages_are_told_apart_before_a_subsequence_is_tried(monkeypatch):
    """best_earlier_pages: long texts of few words share their grams, but where their long blocks stand tells them apart."""
    rng = random.Random(8)
    words = ["".join(rng.choice("etaoinshr") for _ in range(rng.randint(2, 6))) for _ in range(60)]
    texts = [prose(rng, words, rng.randint(8000, 8400), "") for _ in range(40)]
    texts.append(texts[3][:2000] + texts[3][2100:])
    tile = identity.Tile(np.arange(len(texts)), np.array(texts, object), np.zeros(len(texts), bool), np.zeros(len(texts), int), 0, 0, False, True)
    tried, plain = [], identity.may_align
    monkeypatch.setattr(identity, "may_align", lambda own, others, accept: tried.extend(others) or plain(own, others, accept))
    assert [(id_, of) for id_, of, _ in identity.best_of(0.92, 1)(tile)] == [(40, 3)]
    assert len(tried) < 100  # of 820 pairs
