"""Text: language, clauses, tokens, n-grams, similarity."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CJK = r"[\x{4e00}-\x{9fff}]"
LATIN = r"[A-Za-z\x{00c0}-\x{024f}]"
CLAUSE_END = r"[。！？!?；;\n]"


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once: inside a lambda Spark would compute it again for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def language(text: Column) -> Column:
    """cjk, latin, mixed (the rarer script has at least 12 percent) or none."""
    cjk, latin = F.regexp_count(text, F.lit(CJK)), F.regexp_count(text, F.lit(LATIN))
    return F.when(cjk + latin == 0, "none").when(F.least(cjk, latin) >= 0.12 * (cjk + latin), "mixed").when(cjk > latin, "cjk").otherwise("latin")


def normal_form(text: Column) -> Column:
    """Lower case, white space collapsed; a lone space stays, so it is not matched."""
    return F.lower(F.trim(F.regexp_replace(text, r"(?: \s|[\t\n\x0B\f\r])\s*", " ")))


def comparison_form(text: Column) -> Column:
    """The normal form without masks and trailing punctuation; patterns are tried only where they can match."""
    bare = F.when(F.contains(text, F.lit("**")) | F.contains(text, F.lit("█")), F.regexp_replace(text, r"\*{2,}|█+", "")).otherwise(text)
    pattern = F.regexp_replace(bare, r"(?<![\s.,;:!?。！？；，、])[\s.,;:!?。！？；，、]+$", "")
    # before a last one of these an end stands, too
    return normal_form(F.when(F.right(bare, F.lit(1)).isin("\u0085", "\u2028", "\u2029"), pattern).otherwise(F.rtrim(bare, F.lit(" \t\n\x0b\f\r.,;:!?。！？；，、"))))


def clauses(text: Column) -> Column:
    """The clauses of a text, trimmed, without empty ones."""
    return F.filter(F.transform(F.split(text, CLAUSE_END), lambda x: F.trim(x)), lambda x: x != "")


def stem(word: Column) -> Column:
    """A light English stem: -ing, -ied to -y, -ed, -es, -s."""
    n = F.length(word)
    return (
        F.when(word.endswith("ing") & (n > 5), F.left(word, n - 3))
        .when(word.endswith("ied") & (n > 4), F.concat(F.left(word, n - 3), F.lit("y")))
        .when(word.endswith("ed") & (n > 4), F.left(word, n - 2))
        .when(word.endswith("es") & (n > 4), F.left(word, n - 2))
        .when(word.endswith("s") & ~word.endswith("ss") & (n > 3), F.left(word, n - 1))
        .otherwise(word)
    )


#: CJK pieces that carry nothing.
CJK_STOPS = ("一个", "一些", "这里", "那里", "这个", "那个", "可以", "感觉", "觉得", "比较", "非常", "以及", "还是", "就是", "因为", "所以", "但是", "不过", "体验", "地方")
#: Runs up to this length are tokens as a whole, too.
SHORT_RUN = 8


def token_set(text: Column) -> Column:
    """Distinct stems of Latin words of two letters or more, short CJK runs, and CJK 2- and 3-grams."""
    words = F.transform(F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]{2,}"), F.lit(0)), stem)
    runs = F.regexp_extract_all(text, F.lit(CJK + "{2,}"), F.lit(0))

    def pieces(run: Column, size: int) -> Column:
        starts = F.when(F.length(run) >= size, F.sequence(F.lit(1), F.length(run) - (size - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.substring(run, i, F.lit(size)))

    def grams(run: Column) -> Column:
        whole = F.when(F.length(run) <= SHORT_RUN, F.array(run)).otherwise(F.array().cast("array<string>"))
        return F.filter(F.concat(whole, pieces(run, 2), pieces(run, 3)), lambda x: ~x.isin(*CJK_STOPS))

    return F.array_distinct(F.concat(words, F.flatten(F.transform(runs, grams))))


def similarity(a: Column, b: Column) -> Column:
    """0.7 overlap coefficient + 0.3 Jaccard of two token sets; 0 if one is empty."""
    both = F.size(F.array_intersect(a, b))
    least, union = F.least(F.size(a), F.size(b)), F.size(F.array_union(a, b))
    return F.when(least > 0, 0.7 * both / least + 0.3 * both / union).otherwise(0.0)


def char_grams(text: Column, n: int = 5) -> Column:
    """The distinct character n-grams (T12); none if the text is shorter."""
    starts = F.when(F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - (n - 1))).otherwise(F.array().cast("array<int>"))
    return bound(text, lambda own: F.array_distinct(F.transform(starts, lambda i: F.substring(own, i, F.lit(n)))))


def jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(0.0)


def without_repeats(text: Column) -> Column:
    """The lines of a text without those equal to the line before them and without empty ones."""
    lines = F.transform(F.split(text, "\n"), lambda x: F.trim(x))
    return bound(lines, lambda own: F.array_join(F.filter(own, lambda x, i: (x != "") & ((i == 0) | (x != F.get(own, i - 1)))), "\n"))


def term_hits(text: Column, term: str) -> Column:
    """Occurrences of a term, case-insensitive, with a word boundary where its edge is a letter or digit."""
    import re

    left = r"(?<![A-Za-z0-9])" if term[0].isascii() and term[0].isalnum() else ""
    right = r"(?![A-Za-z0-9])" if term[-1].isascii() and term[-1].isalnum() else ""
    return F.regexp_count(text, F.lit(f"(?i){left}{re.escape(term)}{right}"))


def shared_grams(left: DataFrame, right: DataFrame, key: str, text: str, words: int = 8) -> DataFrame:
    """(left key, right key, n): word n-grams of left rows that stand in right rows; joined on their hash, not on pairs of rows."""

    def grams(df: DataFrame, name: str, column: str) -> DataFrame:
        parts = F.filter(F.split(F.lower(column), r"[^\p{L}\p{N}]+"), lambda x: x != "")

        def hashes(own: Column) -> Column:
            starts = F.when(F.size(own) >= words, F.sequence(F.lit(1), F.size(own) - (words - 1))).otherwise(F.array().cast("array<int>"))
            return F.transform(starts, lambda i: F.xxhash64(F.array_join(F.slice(own, i, words), " ")))

        spread = bound(parts, hashes)
        return df.select(F.col(name), F.explode(F.array_distinct(spread)).alias("gram"))

    return grams(left, key, text).join(grams(right, "item_id", "item_text"), "gram").groupBy(key, "item_id").agg(F.count("*").alias("n"))


def narrative_form(text: Column) -> Column:
    """Letters only, CJK or Latin, without URLs, lower-cased."""
    plain = F.when(F.contains(text, F.lit("://")), F.regexp_replace(text, r"(?i)https?://\S+", "")).otherwise(text)
    return F.lower(F.regexp_replace(plain, r"[^\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}A-Za-z]+", ""))


def located(body: Column, part: Column) -> Column:
    """struct(start, status) of a part in a body: found, ambiguous (it stands there again) or missing; start from 0."""
    first = F.instr(body, part)
    again = F.instr(F.substring(body, first + 1, F.length(body)), part)
    status = F.when((part == "") | part.isNull() | (first == 0), "missing").when(again > 0, "ambiguous").otherwise("found")
    return F.struct(F.when(status == "found", first - 1).alias("start"), status.alias("status"))


def compact(body: Column, terms: list[str], before: int = 100, size: int = 900) -> Column:
    """A view of a body from a little before its first term on."""
    places = [F.when(F.instr(F.lower(body), F.lit(t.lower())) > 0, F.instr(F.lower(body), F.lit(t.lower()))) for t in terms]
    first = F.least(*places) if len(places) > 1 else places[0]
    return F.substring(body, F.greatest(F.lit(1), F.coalesce(first, F.lit(1)) - before), F.lit(size))


def keyword_groups(text: Column, groups: dict[str, tuple[str, ...]]) -> Column:
    """The names of the groups of which the text holds a word, in their order."""
    lowered = F.lower(text)
    hits = []
    for name, words in groups.items():
        held = F.lit(False)
        for w in words:
            held = held | F.contains(lowered, F.lit(w.lower()))
        hits.append(F.when(held, F.lit(name)))
    return F.array_compact(F.array(*hits))


def localised(value: Column, names: dict[str, str]) -> Column:
    """The name of an enum value in another language; an unknown value stays as it is."""
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(F.element_at(table, value), value)


def distinct_in_order(values: Column) -> Column:
    """The distinct values of an array, each where it stood first, without empty ones."""
    return F.array_distinct(F.filter(F.transform(values, lambda x: F.trim(x)), lambda x: x != ""))


def overlaps(blocks: Column) -> Column:
    """How many blocks, array<struct<start, end, id>>, run into the one that follows them."""

    def count(own: Column) -> Column:
        return F.size(F.filter(own, lambda b, i: F.coalesce(F.get(own, i + 1)["start"] < b["end"], F.lit(False))))

    return bound(F.array_sort(blocks), count)
