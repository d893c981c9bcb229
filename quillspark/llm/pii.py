"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

Everything is built from Spark SQL functions. The matches of a pattern and the text between them
(regexp_extract_all and split) give the spans by running sums of lengths; Luhn and mod-97 are folds over
the digits of a candidate; the words before a span raise or lower its score.

Base kinds (email, ip, card, phone) are leftmost and non-overlapping, and those that fail their validator
are dropped. Further proposals are kept if their score reaches the threshold and no kept span of the same
kind overlaps them: cards of 13 to 19 digits in one of the printed groupings, phone numbers in the printed
form and IBANs, all also inside longer runs of digits that fail as a whole. Weak ones start below the
threshold and need a context word: plain runs of 13 to 15 digits that pass Luhn, and phone numbers without
a country code. Others start above it and fall below it after a word that speaks against them.

A null text counts as empty and has no spans; rows are mapped one by one, so repeated rows, null ids and
other columns do no harm, and an empty table gives an empty result. Patterns use possessive quantifiers,
so a text of any length is scanned in linear time and without deep recursion.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 70
#: Characters before a span in which context words count.
CONTEXT = 40
RAISE, LOWER = 15, 20

#: Words that make a kind likelier, and words that make it unlikelier.
CONTEXT_WORDS = {
    "email": ("mail", "contact", "write to", "reach"),
    "ip": ("ip", "host", "server", "address", "login"),
    "card": ("card", "visa", "mastercard", "credit", "payment", "cc"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "contact"),
    "iban": ("iban", "account", "bank", "transfer", "bic"),
}
AGAINST_WORDS = ("version", "order no", "invoice no", "serial", "isbn", "example only")

NAME = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{NAME}]))[{NAME}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
MORE_PATTERNS = {
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4} [0-9]{4} [0-9]{4} [0-9]{4}|[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{4}|[0-9]{4} [0-9]{6} [0-9]{5})(?![0-9])",
    "phone": r"\+[0-9]{1,3}[ .-]?\([0-9]{2,4}\)[ .-]?[0-9]{3}[ .-][0-9]{4}(?![0-9])|(?<![0-9+.-])\(?0[0-9]{2,4}\)?[ /-][0-9]{3,4}[ -]?[0-9]{3,4}(?![0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
}
BASE_SCORE = {"email": 80, "ip": 70, "card": 90, "phone": 70}
#: Where a further proposal starts: (pattern of the weak ones, their score, the score of the others).
MORE_SCORE = {"card": (r"^[0-9]{13,15}$", 60, 75), "phone": (r"^[(0]", 60, 75), "iban": (r"(?!)", 0, 95)}
KINDS = ("email", "ip", "card", "phone", "iban")
SPAN = "array<struct<kind:int,start:int,end:int,base:boolean,score:int>>"


def _luhn(match: Column) -> Column:
    digits = F.reverse(F.regexp_replace(match, "[^0-9]", ""))

    def add(total: Column, place: Column) -> Column:
        digit = F.substring(digits, place, F.lit(1)).cast("int") * F.when(place % 2 == 0, 2).otherwise(1)
        return total + digit - F.when(digit > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _mod97(match: Column) -> Column:
    packed = F.replace(match, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(packed, F.lit(5), F.length(packed)), F.left(packed, F.lit(4)))

    def add(rest: Column, place: Column) -> Column:
        code = F.ascii(F.substring(turned, place, F.lit(1)))
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise((rest * 10 + code - 48) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) == 1


def _digits(match: Column) -> Column:
    return F.length(F.regexp_replace(match, "[^0-9]", ""))


#: Whether a match of a kind counts.
VALID = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: m.rlike(r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})){3}$"),
    "card": lambda m: F.when(_digits(m).between(16, 19), _luhn(m)).otherwise(False),
    "phone": lambda m: _digits(m).between(8, 15),
}
MORE_VALID = {"card": _luhn, "phone": VALID["phone"], "iban": _mod97}


def _matches(text: Column, pattern: str) -> Column:
    """array<struct<m, start, end>>: code points, end exclusive."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    steps = F.arrays_zip(found.alias("m"), F.slice(gaps, F.lit(1), F.size(found)).alias("gap"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<m:string,start:int,end:int>>").alias("out"))

    def add(acc: Column, step: Column) -> Column:
        begin = acc["at"] + F.length(step["gap"])
        end = begin + F.length(step["m"])
        return F.struct(end.alias("at"), F.array_append(acc["out"], F.struct(step["m"].alias("m"), begin.alias("start"), end.alias("end"))).alias("out"))

    return F.aggregate(steps, start, add, lambda acc: acc["out"])


def _score(text: Column, kind: str, span: Column, base: bool) -> Column:
    lead = F.least(span["start"], F.lit(CONTEXT))
    before = F.lower(F.substring(text, span["start"] - lead + 1, lead))
    near = "|".join(CONTEXT_WORDS[kind])
    if base:
        start = F.lit(BASE_SCORE[kind])
    else:
        weak, low, high = MORE_SCORE[kind]
        start = F.when(span["m"].rlike(weak), low).otherwise(high)
    return (
        start
        + F.when(before.rlike(rf"(?:^|[^a-z])(?:{near})(?:$|[^a-z])"), RAISE).otherwise(0)
        - F.when(before.rlike("|".join(AGAINST_WORDS)), LOWER).otherwise(0)
    )


def _valid(spans: str, kind: str) -> Column:
    return F.filter(spans, lambda s: VALID[kind](s["m"]))


#: A cheap look at the text before a pattern is run.
HINT = {
    "email": lambda t: F.contains(t, F.lit("@")),
    "phone": lambda t: F.contains(t, F.lit("+")),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9](?:[ -]?[0-9]){12}"),
    "iban": lambda t: t.rlike(r"[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4}"),
}
MORE_HINT = {**HINT, "phone": lambda t: t.rlike(r"\+|0[0-9]{2,4}\)?[ /-]")}
NONE = "array<struct<m:string,start:int,end:int>>"


@dataclass(frozen=True)
class _Columns:
    base: dict[str, str]
    more: dict[str, str]


def find(docs: DataFrame, text: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """Add base_spans and spans: array<struct<kind, start, end, base, score>>, by kind in the order of KINDS, then start."""
    t = F.coalesce(F.col(text), F.lit(""))
    names = _Columns({k: f"_base_{k}" for k in PATTERNS}, {k: f"_more_{k}" for k in MORE_PATTERNS})
    df = docs.withColumns({names.base[k]: F.when(HINT[k](t), _matches(t, p)).otherwise(F.array().cast(NONE)) for k, p in PATTERNS.items()})
    df = df.withColumns({n: _valid(n, k) for k, n in names.base.items()})
    df = df.withColumns({names.more[k]: F.when(MORE_HINT[k](t), _matches(t, p)).otherwise(F.array().cast(NONE)) for k, p in MORE_PATTERNS.items()})

    def further(kind: str) -> Column:
        kept = F.col(names.base[kind]) if kind in names.base else None
        return F.filter(
            names.more[kind],
            lambda s: (
                (F.lit(True) if kept is None else ~F.exists(kept, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
                & MORE_VALID[kind](s["m"])
                & (_score(t, kind, s, False) >= threshold)
            ),
        )

    def told(kind: str, spans: Column, base: bool) -> Column:
        return F.transform(
            spans,
            lambda s: F.struct(
                F.lit(KINDS.index(kind)).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.lit(base).alias("base"), _score(t, kind, s, base).cast("int").alias("score")
            ),
        ).cast(SPAN)

    base = F.concat(*[told(k, F.col(names.base[k]), True) for k in PATTERNS])
    more = F.concat(*[told(k, further(k), False) for k in MORE_PATTERNS])
    df = df.withColumn("base_spans", base)
    df = df.withColumn("spans", F.array_sort(F.concat("base_spans", more)))
    return df.drop(*names.base.values(), *names.more.values())


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_more, scores)."""
    found = find(docs.select("doc_id", "text"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base_spans", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(k) for k in PATTERNS],
        F.sha2(written(F.col("base_spans")).cast("binary"), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size("base_spans")).cast("long").alias("n_more"),
        F.array_join(F.transform("spans", lambda s: s["score"].cast("string")), ",").alias("scores"),
    )


def mask(docs: DataFrame, text: str = "text") -> DataFrame:
    """The same rows and columns with every span of the text replaced by its kind in brackets.

    Of overlapping spans the one that starts first (then the longest) names the replacement, and all of
    their characters go. A null text stays null.
    """
    columns = docs.columns
    rest = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"), F.col(text).alias("_text"))
    found = find(rest, "_text")
    ordered = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), s["kind"].alias("kind"))))
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def add(acc: Column, s: Column) -> Column:
        end = F.greatest(-s["back"], acc["at"])
        piece = F.concat(F.substring(F.col("_text"), acc["at"] + 1, s["start"] - acc["at"]), F.get(names, s["kind"]))
        return F.struct(end.alias("at"), F.when(s["start"] >= acc["at"], F.array_append(acc["out"], piece)).otherwise(acc["out"]).alias("out"))

    def end(acc: Column) -> Column:
        return F.concat(F.array_join(acc["out"], ""), F.substring(F.col("_text"), acc["at"] + 1, F.length("_text")))

    new = F.when(F.size("spans") > 0, F.aggregate(ordered, start, add, end)).otherwise(F.col("_text"))
    return found.withColumn("_new", new).select(*[F.col("_new").alias(c) if c == text else F.col(f"_row.`{c}`").alias(c) for c in columns])
