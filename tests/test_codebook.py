"""The codebook: rows, the automaton against one pattern for each term, and the trace against plain Python."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from quillspark.operators import codebook, semantics
from quillspark.session import ship_package


def pattern(term):
    out = re.escape(term)
    if re.match("[A-Za-z0-9]", term):
        out = "(?<![A-Za-z0-9])" + out
    if re.search("[A-Za-z0-9]$", term):
        out += "(?![A-Za-z0-9])"
    return re.compile(out, re.IGNORECASE)


def apart(text, terms):
    """(start, end, term) of the longest hits that do not overlap."""
    hits = sorted(((m.start() - m.end(), m.start(), t, m.end()) for t in terms for m in pattern(t).finditer(text)))
    taken, out = set(), []
    for _, start, term, end in hits:
        if not taken & set(range(start, end)):
            taken |= set(range(start, end))
            out.append((start, end, term))
    return sorted(out)


def scope(part, start, size):
    return re.split(r"[，,、：:（）()\[\]【】]", part[max(0, start - size) : start])[-1]


def brute(text, book):
    """(positive, negative, cues and contributions, contrasts)."""
    weights = {**book.positive, **{t: -w for t, w in book.negative.items()}}
    contrast = re.compile("|".join(re.escape(t) for t in sorted(book.contrast, key=len, reverse=True)) or "(?!)", re.IGNORECASE)
    positive = negative = 0.0
    trace, contrasts = [], 0
    for sentence in re.split(r"[。！？!?；;\n]+", text):
        marks = list(contrast.finditer(sentence))
        pieces = [(sentence.strip(), 1.0, False)]
        if marks:
            ends = [*(m.start() for m in marks[1:]), len(sentence)]
            pieces = [(sentence[: marks[0].start()].strip("，,、 "), 0.75, False)] + [(sentence[m.end() : e].strip("，,、 "), 1.25, True) for m, e in zip(marks, ends, strict=True)]
        for part, place, behind in pieces:
            if not part:
                continue
            contrasts += behind
            for start, _, term in apart(part, weights):
                value = weights[term] * place
                if len(apart(scope(part, start, 6), book.negators)) % 2:
                    value = -value
                found = [(m.start(), len(t), v) for t, v in book.degrees.items() for m in list(pattern(t).finditer(scope(part, start, 6)))[-1:]]
                value *= max(found)[2] if found else 1.0
                if any(pattern(t).search(scope(part, start, 10)) for t in book.hedges):
                    value *= 0.75
                positive, negative = (positive + value, negative) if value >= 0 else (positive, negative - value)
                trace.append((term, round(value, 9)))
    return round(positive, 9), round(negative, 9), trace, contrasts


BOOK = codebook.Codebook(
    positive={"good": 1.0, "good thing": 2.0, "aa": 1.0, "好": 1.0, "很好": 1.5, "a-b": 0.5, "!x": 1.0}, negative={"bad": 1.0, "thing": 0.5, "差": 1.0, "a": 0.25}, degrees={"very": 1.4, "so": 1.2, "有点": 0.7},
    negators=("not", "no", "不"), hedges=("maybe", "也许"), contrast=("but", "but then", "但是"), neutral=("so so", "一般"), figurative=("haha",), aspects=(("good", "x"), ("bad",), ("aa", "很")), dimensions=("one", "two", "three"),
)
PARTS = ["good", "Good", "bad", "thing", "aa", "a", "aaa", "a-b", "!x", "好", "很好", "差", "very", "so", "not", "no", "不", "maybe", "也许", "but", "But then", "但是", "haha", "so so", ",", "，", "(", ".", "!", "\n", "。", "İ", "x", "_", "9", "  "]


def test_reader_is_the_plain_one():
    rng = random.Random(2)
    reader = codebook.Reader(BOOK)
    for _ in range(4000):
        text = rng.choice(["", " "]).join(rng.choice(PARTS) for _ in range(rng.randint(0, 14)))
        got = reader.read(text)
        plain = codebook.folded(text)
        assert (round(got[0], 9), round(got[1], 9), [(x[1], round(x[8], 9)) for x in got[8]], got[5]) == brute(plain, BOOK), text
        assert all(plain[x[0] :].startswith(x[1]) for x in got[8])
        assert got[3:5] == (sum(len(pattern(t).findall(plain)) for t in BOOK.neutral), len(pattern("haha").findall(plain)))
        assert got[7] == [sum(len(pattern(t).findall(plain)) for t in terms) for terms in BOOK.aspects]


def test_codebook_as_rows(spark):
    assert codebook.load(codebook.table(spark, BOOK)).rows() and set(codebook.load(codebook.table(spark, BOOK)).rows()) == {r if r[3] else (*r[:3], None) for r in BOOK.rows()}
    again = spark.createDataFrame([*BOOK.rows(), ("positive", None, "good", 0.5), ("hedge", None, "  ", None), ("negator", None, None, None)], codebook.SCHEMA)
    assert codebook.load(again).positive == BOOK.positive


@pytest.mark.parametrize("row, why", [(("mood", None, "x", 1.0), "unknown kind"), (("positive", None, "bad", 1.0), "both polarities"), (("negative", None, "y", 0.0), "weight"), (("degree", None, "y", None), "weight"), (("dimension", " ", "y", None), "dimension")])
def test_wrong_codebooks(spark, row, why):
    with pytest.raises(ValueError, match=why):
        codebook.load(spark.createDataFrame([*BOOK.rows(), row], codebook.SCHEMA))


def test_empty_and_too_large_codebooks(spark, monkeypatch):
    with pytest.raises(ValueError, match="both polarities"):
        codebook.load(codebook.table(spark, BOOK).limit(0))
    monkeypatch.setattr(codebook, "MOST_TERMS", 5)
    with pytest.raises(ValueError, match="at most"):
        codebook.load(codebook.table(spark, BOOK))


def test_time_grows_with_the_text_and_not_with_the_terms():
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgh") for _ in range(7)) for _ in range(20_000)]
    text = " ".join(rng.choice(words) for _ in range(20_000))

    def took(terms):
        reader = codebook.Reader(codebook.Codebook(positive={w: 1.0 for w in words[:terms]}, negative={"zz": 1.0}, aspects=()))
        began = time.process_time()
        hits = reader.read(text)[2]
        return (time.process_time() - began) / max(1, hits)

    took(200)
    assert took(20_000) < 20 * took(2_000) and took(20_000) < 1e-3


def test_traces_in_columns(spark):
    ship_package(spark)
    rows = [("not very good, but bad",), (None,), ("",), ("good " * 3,)]
    got = semantics.sentiment(spark.createDataFrame(rows, "text string"), BOOK).select("lexicon.*", "sentiment").collect()
    assert [(t.start, t.cue, t.negation, t.degree, t.contrast) for t in got[0].trace] == [(9, "good", 1.0, 1.4, 0.75), (19, "bad", 1.0, 1.0, 1.25)]
    assert got[1].trace == got[2].trace == [] and got[1].sentiment == "na" and got[3].aspects == [3, 0, 0]


def test_aspects_of_declared_dimensions(spark):
    ship_package(spark)
    book = codebook.Codebook(aspects=(("price",), ("staff",), ("food",)), dimensions=("cost", "people", "meals"))
    rows = [("price price staff", None, "cost", "lexical_candidate", 0.45 + 0.35 * 2 / 3 + 0.2 / 2), ("price price staff", "cost", "cost", "declared+lexical_agreement", 0.65 + 0.2 * 2 / 3 + 0.15 / 2), ("price staff", None, "people", "lexical_candidate", 0.45 + 0.35 / 2), ("price", "meals", "meals", "declared_lexical_conflict", 0.4), ("x", "meals", "meals", "declared_only", 0.65), ("price", "weather", "cost", "invalid_declared_dimension", 0.0), (None, " ", None, "unresolved", 0.0)]
    got = semantics.aspects(spark.createDataFrame([r[:2] for r in rows], "text string, own string"), book, declared="own").collect()
    assert [(r.aspect, r.aspect_basis) for r in got] == [r[2:4] for r in rows]
    assert [r.aspect_confidence for r in got] == pytest.approx([r[4] for r in rows])


def test_confidence_and_its_penalties(spark):
    ship_package(spark)
    book = codebook.Codebook(positive={"good": 1.0}, negative={"bad": 1.0}, neutral=("fair",), figurative=("haha",), contrast=("but",), aspects=(("price",), ("staff",)), dimensions=("cost", "people"))
    rows = [
        ("good good price and so on and on and on for long", 0.35 + 0.3 * 1 + 0.2 + 0.15),
        ("good bad price and so on and on and on for long", 0.35 + 0.3 * 1 + 0.2 + 0.15 * 0.85),
        ("good haha price", 0.35 * 0.75 + 0.3 * 1 + 0.2 * 0.6 + 0.15 * 0.65),
        ("fair", 0.35 * 0.45 + 0.2 * 0.3 + 0.15 * 0.75),
        ("good but good but good", 0.35 + 0.2 * 0.8 + 0.15 * 0.65),
        ("", 0.35 * 0.15), (None, 0.35 * 0.15),
    ]
    units = semantics.aspects(semantics.sentiment(spark.createDataFrame([r[:1] for r in rows], "text string"), book), book)
    assert [r.confidence for r in semantics.confidence(units).collect()] == pytest.approx([r[1] for r in rows])
    capped = semantics.confidence(units, fallback=F.lit(True)).collect()
    assert max(r.confidence for r in capped) == 0.71
