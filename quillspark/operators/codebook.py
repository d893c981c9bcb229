"""A codebook as rows, one automaton over its terms, and the trace of every hit in a text.

A codebook is a table (kind, label, term, weight): polarity terms with weights, negators, degree words with
multipliers, hedges, contrast markers, neutral and figurative cues, and cues of each dimension. Its size does
not follow the data; load() refuses more than MOST_TERMS. All terms are in one Aho-Corasick automaton,
which reads a text once however many terms there are.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Terms that a codebook may have: it is sent to every task.
MOST_TERMS = 1_000_000
KINDS = ("positive", "negative", "negator", "degree", "hedge", "contrast", "neutral", "figurative", "dimension")
SCHEMA = "kind string, label string, term string, weight double"
#: Characters before a term in which a negator, a degree word or a hedge counts; what the parts around a contrast marker and a hedge weigh.
NEGATION_WINDOW, DEGREE_WINDOW, HEDGE_WINDOW = 6, 6, 10
BEFORE, AFTER, HEDGED = 0.75, 1.25, 0.75
#: Where the scope of a modifier ends, what ends a sentence, and what is trimmed around a contrast marker.
STOPS, SENTENCE_END, TRIMMED = "，,、：:（）()[]【】", re.compile(r"[。！？!?；;\n]+"), "，,、 "


@dataclass(frozen=True)
class Codebook:
    """Terms of each kind; the defaults are a small one of this library's own."""

    positive: dict[str, float] = field(default_factory=lambda: {"good": 1.0, "great": 1.5, "excellent": 2.0, "pleasant": 1.0, "safe": 1.0, "clean": 1.0, "recommend": 1.5, "helpful": 1.0, "friendly": 1.0, "beautiful": 1.5, "quiet": 1.0, "gut": 1.0, "schön": 1.5, "bueno": 1.0, "bien": 1.0, "好": 1.0, "很好": 1.5, "方便": 1.0})
    negative: dict[str, float] = field(default_factory=lambda: {"bad": 1.0, "terrible": 2.0, "poor": 1.0, "dirty": 1.0, "unsafe": 1.5, "noisy": 1.0, "差": 1.0, "很差": 1.5, "rude": 1.5, "broken": 1.0, "idiot": 1.5, "worthless": 1.5, "schlecht": 1.0, "malo": 1.0, "mauvais": 1.0})
    negators: tuple[str, ...] = ("not", "no", "never", "without", "不", "没")
    degrees: dict[str, float] = field(default_factory=lambda: {"very": 1.4, "extremely": 1.7, "slightly": 0.7, "somewhat": 0.8, "非常": 1.5, "有点": 0.7})
    hedges: tuple[str, ...] = ("maybe", "perhaps", "possibly", "seems", "可能", "也许")
    contrast: tuple[str, ...] = ("but", "however", "although", "但是", "不过")
    neutral: tuple[str, ...] = ("average", "ordinary", "neutral", "一般")
    figurative: tuple[str, ...] = ("yeah right", "as if", "呵呵")
    aspects: tuple[tuple[str, ...], ...] = (("price", "cost"), ("staff", "service"), ("place", "location"), ("safe", "security"), ("clean", "hygiene"), ("quiet", "noise"), ("food", "meal"))
    dimensions: tuple[str, ...] = ()

    def names(self) -> tuple[str, ...]:
        """The dimensions' names; their numbers where they have none."""
        return self.dimensions or tuple(str(k) for k in range(len(self.aspects)))

    def rows(self) -> list[tuple[str, str | None, str, float | None]]:
        weighted = [(kind, None, t, w) for kind, terms in (("positive", self.positive), ("negative", self.negative), ("degree", self.degrees)) for t, w in terms.items()]
        plain = [(kind, None, t, None) for kind, terms in (("negator", self.negators), ("hedge", self.hedges), ("contrast", self.contrast), ("neutral", self.neutral), ("figurative", self.figurative)) for t in terms]
        return weighted + plain + [("dimension", name, t, None) for name, terms in zip(self.names(), self.aspects, strict=True) for t in terms]


def table(spark: SparkSession, book: Codebook) -> DataFrame:
    """A codebook as a table."""
    return spark.createDataFrame(book.rows(), SCHEMA)


def load(rows: DataFrame) -> Codebook:
    """A codebook from its table (kind, label, term, weight).

    Null and empty terms are ignored, and of a repeated term the greatest weight holds. Wrong are: an unknown
    kind, no positive or no negative term, a term with both polarities, a weight that is not above 0, a cue
    without a dimension, more than MOST_TERMS rows. An empty table is no codebook. The order of dimensions is that of their names.
    """
    found = rows.select("kind", "label", "term", "weight").where("trim(term) <> ''").limit(MOST_TERMS + 1).collect()
    if len(found) > MOST_TERMS:
        raise ValueError(f"a codebook has at most {MOST_TERMS} terms")
    terms: dict[str, dict[str, float]] = defaultdict(dict)
    cues: dict[str, set[str]] = defaultdict(set)
    for kind, label, term, weight in found:
        if kind not in KINDS:
            raise ValueError(f"unknown kind of term: {kind}")
        if kind in ("positive", "negative", "degree") and not (weight or 0) > 0:
            raise ValueError(f"{kind} term without a weight above 0: {term}")
        if kind == "dimension":
            if not (label or "").strip():
                raise ValueError(f"cue without a dimension: {term}")
            cues[label].add(term.strip())
        else:
            terms[kind][term.strip()] = max(weight or 0.0, terms[kind].get(term.strip(), 0.0))
    if not terms["positive"] or not terms["negative"]:
        raise ValueError("a codebook needs terms of both polarities")
    if both := sorted(set(terms["positive"]) & set(terms["negative"])):
        raise ValueError(f"terms of both polarities: {', '.join(both)}")
    plain = {name: tuple(sorted(terms[kind])) for name, kind in (("negators", "negator"), ("hedges", "hedge"), ("contrast", "contrast"), ("neutral", "neutral"), ("figurative", "figurative"))}
    names = tuple(sorted(cues))
    return Codebook(positive=terms["positive"], negative=terms["negative"], degrees=terms["degree"], aspects=tuple(tuple(sorted(cues[n])) for n in names), dimensions=names, **plain)


#: Letters beyond ASCII that fold to ASCII ones.
_ASCII = str.maketrans("İıſK", "iisk")


def folded(text: str) -> str:
    """Lower case, character for character, so that places stay the same."""
    text = text.translate(_ASCII)
    lowered = text.lower()
    return lowered if len(lowered) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def _letter(c: str) -> bool:
    return c.isascii() and c.isalnum()


class Terms:
    """An automaton over terms; a term that begins or ends with an ASCII letter or digit needs a boundary there."""

    def __init__(self, terms: dict[str, object]):
        self.automaton = ahocorasick.Automaton()
        by_form: dict[str, list] = defaultdict(list)
        for term, value in terms.items():
            by_form[folded(term)].append((term, value))
        for form, values in by_form.items():
            if form:
                self.automaton.add_word(form, (len(form), _letter(form[0]), _letter(form[-1]), values))
        self.any = bool(len(self.automaton))
        if self.any:
            self.automaton.make_automaton()

    def found(self, text: str) -> list[tuple[int, int, str, object]]:
        """(start, end, term, value) of all occurrences of a folded text; those of one term do not overlap."""
        if not self.any:
            return []
        out, upto = [], {}
        for last, (size, left, right, values) in self.automaton.iter(text):
            start, end = last - size + 1, last + 1
            if left and start and _letter(text[start - 1]) or right and end < len(text) and _letter(text[end]):
                continue
            term = values[0][0]
            if start >= upto.get(term, 0):
                upto[term] = end
                out += [(start, end, t, v) for t, v in values]
        return out

    def apart(self, text: str, first=lambda hit: 0) -> list[tuple[int, int, str, object]]:
        """The longest occurrences that do not overlap, in the order of the text; of equals the earliest, then the least by first."""
        taken = bytearray(len(text))
        out = []
        hits = self.found(text)
        if len(hits) < 2:
            return hits
        for hit in sorted(hits, key=lambda h: (h[0] - h[1], h[0], first(h), h[2])):
            if not any(taken[hit[0] : hit[1]]):
                taken[hit[0] : hit[1]] = b"\1" * (hit[1] - hit[0])
                out.append(hit)
        return sorted(out, key=lambda h: h[0])


TRACE = "array<struct<start:int,cue:string,polarity:string,weight:double,negation:double,degree:double,contrast:double,hedge:double,contribution:double>>"
RESULT = f"struct<positive:double,negative:double,hits:int,neutral:int,figurative:int,contrasts:int,raw:double,aspects:array<int>,trace:{TRACE}>"
TRACED = ("start", "cue", "polarity", "weight", "negation", "degree", "contrast", "hedge", "contribution")


class Reader:
    """Reads one text after the other by a codebook."""

    def __init__(self, book: Codebook):
        self.book = book
        self.polarity = Terms({**{t: ("positive", w) for t, w in book.positive.items()}, **{t: ("negative", w) for t, w in book.negative.items()}})
        self.negators, self.degrees, self.hedges = Terms(dict.fromkeys(book.negators)), Terms(book.degrees), Terms(dict.fromkeys(book.hedges))
        marks: dict[str, list] = defaultdict(list)
        for kind, terms in (("neutral", book.neutral), ("figurative", book.figurative), *enumerate(book.aspects)):
            for term in terms:
                marks[term].append(kind)
        self.marks = Terms(marks)
        self.contrast = re.compile("|".join(re.escape(folded(t)) for t in sorted(filter(None, set(book.contrast)), key=len, reverse=True)) or r"(?!)")

    def degree(self, prefix: str) -> float:
        """The multiplier of the last degree word of a prefix; of two at one place, the longer."""
        found = self.degrees.found(prefix)
        return max(found, key=lambda h: (h[0], h[1]))[3] if found else 1.0

    def parts(self, text: str) -> list[tuple[int, str, float, bool]]:
        """(start, part, weight, behind a marker): sentences, cut at contrast markers (T4, T5)."""
        out = []

        def add(start: int, end: int, weight: float, behind: bool) -> None:
            part = text[start:end]
            bare = part.strip(TRIMMED) if weight != 1 else part.strip()
            if bare:
                out.append((start + part.index(bare), bare, weight, behind))

        at = 0
        for end in [*SENTENCE_END.finditer(text), None]:
            stop = end.start() if end else len(text)
            marks = list(self.contrast.finditer(text, at, stop))
            if marks:
                add(at, marks[0].start(), BEFORE, False)
                for mark, following in zip(marks, [*marks[1:], None], strict=True):
                    add(mark.end(), following.start() if following else stop, AFTER, True)
            else:
                add(at, stop, 1.0, False)
            at = end.end() if end else stop
        return out

    def read(self, text: str | None) -> tuple[float, float, int, int, int, int, float, list[int], list[tuple]]:
        """The fields of RESULT."""
        lowered = folded(text or "")
        positive = negative = 0.0
        contrasts, trace = 0, []
        for at, part, weight, behind in self.parts(lowered):
            contrasts += behind
            for start, _, cue, (polarity, base) in self.polarity.apart(part, lambda h: -h[3][1]):
                negation = -1.0 if self.negators.any and len(self.negators.apart(self._scope(part, start, NEGATION_WINDOW))) % 2 else 1.0
                degree = self.degree(self._scope(part, start, DEGREE_WINDOW)) if self.degrees.any else 1.0
                hedge = HEDGED if self.hedges.any and self.hedges.found(self._scope(part, start, HEDGE_WINDOW)) else 1.0
                value = (1.0 if polarity == "positive" else -1.0) * base * negation * degree * weight * hedge
                positive, negative = (positive + value, negative) if value >= 0 else (positive, negative - value)
                trace.append((at + start, cue, polarity, base, negation, degree, weight, hedge, value))
        marks = Counter(kind for *_, kinds in self.marks.found(lowered) for kind in kinds)
        aspects = [marks[k] for k in range(len(self.book.aspects))]
        return positive, negative, len(trace), marks["neutral"], marks["figurative"], contrasts, positive - negative, aspects, trace

    @staticmethod
    def _scope(part: str, end: int, size: int) -> str:
        scope = part[max(0, end - size) : end]
        return scope[max(scope.rfind(c) for c in STOPS) + 1 :]


def as_arrow(read: list[tuple]) -> pa.StructArray:
    """What a Reader says of texts, as a column of RESULT."""
    *sums, aspects, traces = zip(*read, strict=True)
    hits = [hit for trace in traces for hit in trace]
    upto = pa.array(np.concatenate([[0], np.cumsum([len(t) for t in traces])]), pa.int32())
    kinds = [pa.int32(), pa.string(), pa.string(), *[pa.float64()] * 6]
    fields = zip(*hits, strict=True) if hits else [[] for _ in kinds]
    each = pa.StructArray.from_arrays([pa.array(f, k) for f, k in zip(fields, kinds, strict=True)], TRACED)
    types = [pa.float64(), pa.float64(), *[pa.int32()] * 4, pa.float64()]
    columns = [*map(pa.array, sums, types), pa.array(aspects, pa.list_(pa.int32())), pa.ListArray.from_arrays(upto, each)]
    return pa.StructArray.from_arrays(columns, ["positive", "negative", "hits", "neutral", "figurative", "contrasts", "raw", "aspects", "trace"])
