"""Identity, text and semantics queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions import privacy, times, urls
from quillspark.operators import codebook, identity, scoring, semantics, text
from quillspark.plans.registry import query
from quillspark.session import ship_package, table
from quillspark.sources import readers
from quillspark.sources.html_places import page_places


@query()
def canon_url_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    known = pages.select("url").distinct().withColumn("canonical", urls.canonical_url("url"))
    return pages.join(known, "url", "left").select("page_id", "url", "canonical", urls.url_privacy(F.col("url")).alias("privacy"))


def _simple_canonical(url):
    """The canonical form where only tracking and fragments differ, in columns."""
    bare = F.regexp_replace(F.regexp_replace(url, r"#.*$", ""), r"\?utm_source=[^&]*$", "")
    return F.regexp_replace(bare, r"^(https?://[^/?#]+)", F.lower(F.regexp_extract(bare, r"^(https?://[^/?#]+)", 1)))


@query(
    r"""WITH c AS (SELECT page_id, regexp_replace(regexp_replace(url, '#.*$', ''), '\?utm_source=[^&]*$', '') AS u, sha256(html) AS f FROM pages),
p AS (SELECT page_id, min(page_id) OVER (PARTITION BY u) AS a, min(page_id) OVER (PARTITION BY f) AS b, u, f FROM c), l AS (SELECT page_id, least(a, b) AS label, u, f FROM p),
g AS (SELECT label, count(DISTINCT u) AS k, min(u) AS u, min(f) AS f FROM l GROUP BY label)
SELECT l.page_id AS source_id, CASE WHEN k > 1 THEN 'PAGE-CONTENT-' || g.f[1:24] ELSE 'PAGE-URL-' || sha256(g.u)[1:24] END AS entity FROM l JOIN g USING (label)"""
)
def page_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that share a canonical URL or a fingerprint are one."""
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("source_id"), _simple_canonical(F.col("url")).alias("canonical"), F.sha2("html", 256).alias("fingerprint"))
    return identity.page_entities(pages)


@query()
def page_entities_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_entities by the library's whole canonical form (D1-D5); a URL that is no public one joins nothing."""
    ship_package(spark)
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("source_id"), "url", F.sha2("html", 256).alias("fingerprint"))
    known = pages.select("url").distinct().withColumn("canonical", urls.canonical_url("url"))
    return identity.page_entities(pages.join(known, "url", "left").select("source_id", "canonical", "fingerprint"))


EXACT = {"spam-farm.example.org": "spam"}
PREFIXES = {"www.cheap-pills.example.com/en/": "shop"}
SUFFIXES = {"example.net": "network", "cheap-pills.example.com": "pills"}


@query(
    r"""WITH h AS (SELECT page_id, lower(regexp_extract(url, '^[A-Za-z]+://([^/?#:]*)', 1)) AS host, regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1) AS path FROM pages)
SELECT page_id, CASE WHEN host = 'spam-farm.example.org' THEN 'spam' WHEN starts_with(host || path, 'www.cheap-pills.example.com/en/') THEN 'shop' WHEN host = 'cheap-pills.example.com' OR ends_with(host, '.cheap-pills.example.com') THEN 'pills'
WHEN host = 'example.net' OR ends_with(host, '.example.net') THEN 'network' ELSE regexp_replace(host, '^www\.', '') END AS platform, array_to_string(string_split(host, '.')[-2:], '.') AS domain FROM h"""
)
def platform_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = urls.platform(table(spark, sf_dir, "pages").select("page_id", "url"), EXACT, PREFIXES, SUFFIXES)
    return pages.select("page_id", "platform", urls.registrable(urls.host_of(F.col("url"))).alias("domain"))


@query()
def html_visible_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    read = table(spark, sf_dir, "pages").select("page_id", readers.visible_text("html").alias("v"))
    return read.select("page_id", F.col("v.level").alias("level"), F.length("v.text").alias("n_chars"), F.sha2("v.text", 256).alias("text_sha256"))


@query()
def html_text_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the visible text of each page stands in its source, and whether cutting it there gives it again."""
    ship_package(spark)
    read = table(spark, sf_dir, "pages").select("page_id", "html", page_places(F.col("html")).alias("v"))
    cut = F.transform(F.filter("v.pieces", lambda p: p["kind"] == "text"), lambda p: F.substring("html", p["source_start"] + 1, p["source_end"] - p["source_start"]) == F.substring("v.text", p["start"] + 1, p["end"] - p["start"]))
    kept = F.forall(cut, lambda x: x)
    return read.select("page_id", F.col("v.level").alias("level"), F.size("v.pieces").cast("long").alias("pieces"), F.size("v.uncertain").cast("long").alias("uncertain"), kept.alias("kept"), F.sha2("v.text", 256).alias("text_sha256"))


@query(
    r"""WITH c AS (SELECT doc_id, len(regexp_extract_all(text, '[\x{4e00}-\x{9fff}]')) AS cjk, len(regexp_extract_all(text, '[A-Za-z\x{00c0}-\x{024f}]')) AS latin FROM documents)
SELECT doc_id, CASE WHEN cjk + latin = 0 THEN 'none' WHEN least(cjk, latin) >= 0.12 * (cjk + latin) THEN 'mixed' WHEN cjk > latin THEN 'cjk' ELSE 'latin' END AS script FROM c"""
)
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.language(F.col("text")).alias("script"))


@query(r"WITH c AS (SELECT doc_id, unnest(regexp_split_to_array(text, '[。！？!?；;\n]')) AS clause FROM documents) SELECT doc_id, count(*) AS clauses, sum(length(trim(clause)))::BIGINT AS chars FROM c WHERE trim(clause) <> '' GROUP BY doc_id")
def clause_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    spread = table(spark, sf_dir, "documents").select("doc_id", F.explode(text.clauses(F.col("text"))).alias("clause"))
    return spread.groupBy("doc_id").agg(F.count("*").alias("clauses"), F.sum(F.length("clause")).alias("chars"))


@query(
    r"""WITH w AS (SELECT conv_id, turn, list_distinct(list_transform(regexp_extract_all(lower(text), '[a-z0-9]{2,}'), lambda w: CASE WHEN ends_with(w, 'ing') AND length(w) > 5 THEN w[:-4] WHEN ends_with(w, 'ied') AND length(w) > 4 THEN w[:-4] || 'y'
WHEN ends_with(w, 'ed') AND length(w) > 4 THEN w[:-3] WHEN ends_with(w, 'es') AND length(w) > 4 THEN w[:-3] WHEN ends_with(w, 's') AND NOT ends_with(w, 'ss') AND length(w) > 3 THEN w[:-2] ELSE w END)) AS t FROM conversations),
p AS (SELECT a.conv_id, a.turn, len(list_intersect(a.t, b.t)) AS k, len(a.t) AS x, len(b.t) AS y FROM w a JOIN w b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)
SELECT conv_id, turn, CASE WHEN least(x, y) > 0 THEN round(0.7 * k / least(x, y)::DOUBLE + 0.3 * k / (x + y - k)::DOUBLE, 6) ELSE 0.0 END AS similarity FROM p"""
)
def token_jaccard_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarity of each turn to the next of its conversation."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", text.token_set(F.col("text")).alias("t"))
    later = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("t").alias("u"))
    return turns.join(later, ["conv_id", "turn"]).select("conv_id", "turn", F.round(text.similarity(F.col("t"), F.col("u")), 6).alias("similarity"))


FORM = r"""WITH f AS (SELECT doc_id AS id, source, lower(trim(regexp_replace(regexp_replace(regexp_replace(text, '\*{2,}|█+', '', 'g'), '[\s.,;:!?。！？；，、]+$', ''), '\s+', ' ', 'g'))) AS form FROM documents)"""


@query(
    FORM
    + """, s AS (SELECT id, min(id) OVER (PARTITION BY form) AS a FROM f WHERE form <> ''), t AS (SELECT id, min(id) OVER (PARTITION BY form[-20:]) AS a, count(*) OVER (PARTITION BY form[-20:]) AS n FROM f WHERE length(form) >= 24)
SELECT id, a, 'same' AS edge FROM s WHERE a <> id UNION ALL SELECT id, a, 'tail' FROM t WHERE n >= 3 AND a <> id"""
)
def exact_and_tail_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Star links of equal texts and of common tails."""
    keys = identity.collision_keys(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    same = identity._stars(keys, "form_key", "id").withColumn("edge", F.lit("same"))
    tails = identity.tail_links(keys).withColumn("edge", F.lit("tail"))
    return same.unionByName(tails).select(F.col("b").alias("id"), "a", "edge")


@query()
def collision_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents by equal text, common tail and near-duplicate text."""
    ship_package(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return identity.collision_groups(docs, "doc_id", identity.near_links(docs, "doc_id"))


@query()
def near_dup_pairs_blocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-equal documents and turns, whole texts."""
    ship_package(spark)
    docs = table(spark, sf_dir, "documents").select(F.concat_ws(":", F.lit("document"), "doc_id").alias("id"), "text")
    turns = table(spark, sf_dir, "conversations").select(F.concat_ws(":", F.lit("turn"), "conv_id", "turn").alias("id"), "text")
    pairs = identity.similar_pairs(docs).unionByName(identity.similar_pairs(turns))
    return pairs.withColumn("ratio", F.round("ratio", 6))


@query(
    r"""WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents), v AS (SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark),
p AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM w), q AS (SELECT item_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM v),
g AS (SELECT DISTINCT doc_id, x || ' ' || lead(x) OVER o || ' ' || lead(x, 2) OVER o || ' ' || lead(x, 3) OVER o || ' ' || lead(x, 4) OVER o || ' ' || lead(x, 5) OVER o || ' ' || lead(x, 6) OVER o || ' ' || lead(x, 7) OVER o AS gram FROM p WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
h AS (SELECT DISTINCT item_id, x || ' ' || lead(x) OVER o || ' ' || lead(x, 2) OVER o || ' ' || lead(x, 3) OVER o || ' ' || lead(x, 4) OVER o || ' ' || lead(x, 5) OVER o || ' ' || lead(x, 6) OVER o || ' ' || lead(x, 7) OVER o AS gram FROM q WINDOW o AS (PARTITION BY item_id ORDER BY i))
SELECT doc_id, item_id, count(*) AS n FROM g JOIN h USING (gram) GROUP BY ALL"""
)
def ngram_containment_vs_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word 8-grams that documents share with benchmark items."""
    items = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("item_text"))
    return text.shared_grams(table(spark, sf_dir, "documents").select("doc_id", "text"), items, "doc_id", "text")


@query(
    r"""SELECT doc_id, len(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+')) AS emails,
sha256(regexp_replace(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+', '', 'g')) AS rest_sha256 FROM documents WHERE regexp_matches(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+')"""
)
def contact_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E-mail addresses by the short pattern that SQL has, and the text without them; contact_spans_all has every kind."""
    docs = table(spark, sf_dir, "documents").where(F.col("text").rlike(SHORT_EMAIL))
    return docs.select("doc_id", F.regexp_count("text", F.lit(SHORT_EMAIL)).cast("long").alias("emails"), F.sha2(F.regexp_replace("text", SHORT_EMAIL, ""), 256).alias("rest_sha256"))


@query()
def contact_spans_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contact data of every kind in every document, with what URLs exempt."""
    ship_package(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", privacy.contact_spans(F.col("text")).alias("spans"))
    told = F.array_join(F.transform("spans", lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    return docs.select("doc_id", F.size("spans").cast("long").alias("n"), told.alias("spans"))


@query()
def contact_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with all its contact data hidden, and what is left of it: nothing."""
    ship_package(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", privacy.masked(F.col("text")).alias("masked"))
    left = F.size(privacy.contact_spans(F.col("masked"))).cast("long")
    return docs.select("doc_id", F.length("text").eqNullSafe(F.length("masked")).alias("same_length"), left.alias("left"), F.sha2("masked", 256).alias("masked_sha256"))


@query(
    r"""WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents), s AS (SELECT doc_id, i, lines[i] AS line, coalesce(list_sum(list_transform(lines[:i - 1], lambda x: length(x) + 1)), 0) AS begin FROM (SELECT doc_id, lines, unnest(generate_series(1, len(lines))) AS i FROM l)),
o AS (SELECT doc_id, begin, begin + length(line) AS stop FROM s)
SELECT d.doc_id, count(*) AS holders FROM documents d JOIN o ON o.doc_id = d.doc_id AND o.begin <= d.n_chars // 2 AND d.n_chars // 2 < o.stop GROUP BY d.doc_id"""
)
def interval_locate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line that holds each document's middle character (J11): containment is tested inside the row's own blocks."""
    lines = F.split("text", "\n")
    ends = F.aggregate(lines, F.array(F.lit(0)), lambda acc, x: F.array_append(acc, F.element_at(acc, -1) + F.length(x) + 1))
    docs = table(spark, sf_dir, "documents").select("doc_id", F.floor(F.col("n_chars") / 2).alias("middle"), F.posexplode(F.arrays_zip(lines.alias("line"), F.slice(ends, F.lit(1), F.size(lines)).alias("begin"))).alias("i", "b"))
    inside = (F.col("b.begin") <= F.col("middle")) & (F.col("middle") < F.col("b.begin") + F.length("b.line"))
    return docs.where(inside).groupBy("doc_id").agg(F.count("*").alias("holders"))


@query(
    r"""SELECT doc_id, len(regexp_extract_all(lower(text), '\bthe\b'))::BIGINT AS the_hits, len(regexp_extract_all(lower(text), '\bof\b'))::BIGINT AS of_hits FROM documents WHERE lang = 'en' AND NOT regexp_matches(text, '[^\x00-\x7f]|_')"""
)
def lexicon_hits_by_theme(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").where("lang = 'en'").where(~F.col("text").rlike(r"[^\x00-\x7f]|_"))
    return docs.select("doc_id", text.term_hits(F.col("text"), "the").cast("long").alias("the_hits"), text.term_hits(F.col("text"), "of").cast("long").alias("of_hits"))


@query()
def lexicon_hits_all_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lexicon_hits_by_theme over the documents of every language and script, by the operator's own boundaries."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", "lang", text.term_hits(F.col("text"), "the").cast("long").alias("the_hits"), text.term_hits(F.col("text"), "of").cast("long").alias("of_hits"))


@query()
def lexicon_sentiment_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    read = semantics.sentiment(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return read.select("doc_id", F.round("score_raw", 6).alias("score_raw"), "score", "sentiment", F.col("lexicon.hits").alias("hits"))


SHORT_EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
#: Frequent words as cues, so that the given texts have hits of every kind.
CUES = codebook.Codebook(
    positive={"the": 1.0, "la": 1.0, "es": 1.5, "und": 1.0}, negative={"of": 1.0, "le": 1.0, "el": 1.5, "der": 1.0}, negators=(), degrees={}, hedges=(), contrast=(), neutral=("and", "et", "y"), figurative=("to", "un"),
    aspects=(("the", "el"), ("of",), ("and", "und"), ("de",), ("der", "die"), ("que",), ("en", "in")),
)
#: Occurrences of words in SQL; no underscore is a letter of a word here.
COUNTED = r"""WITH t AS (SELECT *, replace(lower(coalesce(text, '')), '_', ' ') AS t FROM documents), n AS (SELECT *, {counts} FROM t), a AS (SELECT *, [{aspects}] AS c FROM n),
r AS (SELECT *, list_reverse_sort(list_transform(c, lambda x, i: {{'n': x, 'name': CAST(i - 1 AS VARCHAR)}})) AS k, list_sum(c) AS total FROM a),
m AS (SELECT *, CASE WHEN k[1].n > 0 THEN k[1].name END AS top, CASE WHEN doc_id % 9 < 8 THEN CAST(doc_id % 9 AS VARCHAR) ELSE '' END AS own FROM r),
b AS (SELECT *, CASE WHEN own IN ('7') THEN 'invalid_declared_dimension' WHEN own <> '' AND own = top THEN 'declared+lexical_agreement' WHEN own <> '' AND top IS NOT NULL THEN 'declared_lexical_conflict' WHEN own <> '' THEN 'declared_only' WHEN top IS NOT NULL THEN 'lexical_candidate' ELSE 'unresolved' END AS basis FROM m),
g AS (SELECT *, CASE WHEN basis LIKE 'declared%' THEN own ELSE top END AS aspect, CASE basis WHEN 'declared+lexical_agreement' THEN 0.65::DOUBLE + 0.2::DOUBLE * k[1].n / total + 0.15::DOUBLE * (k[1].n - k[2].n) / k[1].n WHEN 'lexical_candidate' THEN 0.45::DOUBLE + 0.35::DOUBLE * k[1].n / total + 0.2::DOUBLE * (k[1].n - k[2].n) / k[1].n
WHEN 'declared_lexical_conflict' THEN 0.4 WHEN 'declared_only' THEN 0.65 ELSE 0.0 END AS ac FROM b)
""".format(
    counts=", ".join(f"len(regexp_extract_all(t, '\\b{w}\\b')) AS n_{w}" for w in sorted({*CUES.positive, *CUES.negative, *CUES.neutral, *CUES.figurative, *(t for terms in CUES.aspects for t in terms)})),
    aspects=", ".join(" + ".join(f"n_{t}" for t in terms) for terms in CUES.aspects),
)
_WEIGHED = {kind: " + ".join(f"{w}::DOUBLE * n_{t}" for t, w in terms.items()) for kind, terms in (("pos", CUES.positive), ("neg", CUES.negative))}


def _declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = F.col("doc_id") % 9
    return table(spark, sf_dir, "documents").select("doc_id", "text", F.when(own < 8, own.cast("string")).otherwise("").alias("own"))


@query(COUNTED + "SELECT doc_id, aspect, basis, round(ac, 6) AS confidence FROM g")
def aspect_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension of each document; some declare one, one of the eight is none of the codebook's."""
    ship_package(spark)
    found = semantics.aspects(_declared(spark, sf_dir), CUES, declared="own")
    return found.select("doc_id", "aspect", F.col("aspect_basis").alias("basis"), F.round("aspect_confidence", 6).alias("confidence"))


@query(
    COUNTED
    + f""", p AS (SELECT *, {_WEIGHED["pos"]} AS pos, {_WEIGHED["neg"]} AS neg, {" + ".join(f"n_{t}" for t in [*CUES.positive, *CUES.negative])} AS hits, {" + ".join(f"n_{t}" for t in CUES.neutral)} AS neutral, {" + ".join(f"n_{t}" for t in CUES.figurative)} AS fig, length(regexp_replace(coalesce(text, ''), '\\s+', '', 'g')) AS len FROM g),
q AS (SELECT *, least(pos, neg) >= 1.0 AND least(pos, neg) >= 0.35 * greatest(pos, neg) AS mixed, 1.0::DOUBLE AS one FROM p),
z AS (SELECT *, CASE WHEN coalesce(text, '') = '' THEN 0.0 ELSE greatest(0.0, one - CASE WHEN mixed THEN 0.15 ELSE 0 END - CASE WHEN fig > 0 THEN 0.35 ELSE 0 END - CASE WHEN basis IN ('declared_lexical_conflict', 'invalid_declared_dimension', 'unresolved') THEN 0.25 ELSE 0 END) END AS clear FROM q)
SELECT doc_id, hits, mixed, round(0.35::DOUBLE * CASE WHEN hits >= 2 THEN 1.0 WHEN hits = 1 THEN 0.75 WHEN neutral > 0 THEN 0.45 ELSE 0.15 END + 0.3::DOUBLE * ac + 0.2::DOUBLE * CASE WHEN len >= 30 THEN 1.0 WHEN len >= 15 THEN 0.8 WHEN len >= 6 THEN 0.6 WHEN len > 0 THEN 0.3 ELSE 0.0 END + 0.15::DOUBLE * clear, 6) AS confidence FROM z"""
)
def semantic_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confidence of each document's coding, from its cues, aspect, completeness and clarity (M7)."""
    ship_package(spark)
    read = semantics.confidence(semantics.aspects(semantics.sentiment(_declared(spark, sf_dir), CUES), CUES, declared="own"))
    return read.select("doc_id", F.col("lexicon.hits").cast("long").alias("hits"), (F.col("sentiment") == "mixed").alias("mixed"), F.round("confidence", 6).alias("confidence"))


#: The words of the benchmark as a codebook: weights by length, polarity by the first letter.
BENCHMARK_TERMS = r"""SELECT DISTINCT w, CASE WHEN w < 'n' THEN 'positive' ELSE 'negative' END AS kind, length(w) / 4.0::DOUBLE AS weight FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]{4,}')) AS w FROM benchmark)"""


@query(
    f"WITH b AS ({BENCHMARK_TERMS}), "
    + r"""w AS (SELECT doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+')) AS w, unnest(generate_series(1, len(regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+')))) AS i FROM documents), h AS (SELECT doc_id, i, b.w, kind, weight FROM w JOIN b USING (w)),
s AS (SELECT doc_id, count(*) AS hits, round(sum(CASE kind WHEN 'positive' THEN weight ELSE -weight END), 6) AS raw, sha256(string_agg(w || ':' || kind, ',' ORDER BY i)) AS cues_sha256 FROM h GROUP BY doc_id)
SELECT doc_id, coalesce(hits, 0) AS hits, coalesce(raw, 0.0) AS raw, coalesce(cues_sha256, sha256('')) AS cues_sha256 FROM documents LEFT JOIN s USING (doc_id)"""
)
def codebook_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hit, in order, of a codebook of a thousand terms and more: the words of the benchmark, read as rows."""
    ship_package(spark)
    words = table(spark, sf_dir, "benchmark").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("([a-z]{4,})"))).alias("term")).distinct()
    rows = words.select(F.when(F.col("term") < "n", "positive").otherwise("negative").alias("kind"), F.lit(None).cast("string").alias("label"), "term", (F.length("term") / 4.0).alias("weight"))
    read = semantics.sentiment(table(spark, sf_dir, "documents").select("doc_id", "text"), codebook.load(rows))
    cues = F.array_join(F.transform("lexicon.trace", lambda x: F.concat(x["cue"], F.lit(":"), x["polarity"])), ",")
    return read.select("doc_id", F.col("lexicon.hits").cast("long").alias("hits"), F.round("lexicon.raw", 6).alias("raw"), F.sha2(cues, 256).alias("cues_sha256"))


@query(
    r"""WITH c AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y') WHEN 1 THEN strftime(ts, '%Y-%m') WHEN 2 THEN strftime(ts, '%Y-%m-%d') ELSE strftime(ts, '%d.%m.%Y') END AS cell FROM events)
SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'year' WHEN 1 THEN 'month' WHEN 2 THEN 'day' END AS precision, CASE event_id % 4 WHEN 0 THEN cell || '-01-01' WHEN 1 THEN cell || '-01' WHEN 2 THEN cell END AS earliest FROM c"""
)
def strict_time_and_partial_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_id") % 4
    cell = F.when(kind == 0, F.date_format("ts", "yyyy")).when(kind == 1, F.date_format("ts", "yyyy-MM")).when(kind == 2, F.date_format("ts", "yyyy-MM-dd")).otherwise(F.date_format("ts", "dd.MM.yyyy"))
    date = times.partial_date(cell)
    return table(spark, sf_dir, "events").select("event_id", date["precision"].alias("precision"), date["earliest"].cast("string").alias("earliest"))


@query("SELECT doc_id, CASE WHEN x = 0 THEN 'na' WHEN x > 0 THEN 'positive' ELSE 'negative' END AS class FROM (SELECT doc_id, n_chars % 5 - 2 AS x FROM documents)")
def bounded_sentiment_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5 and M9 on totals in columns."""
    x = (F.col("n_chars") % 5 - 2).cast("double")
    zero = F.lit(0.0)
    named = scoring.sentiment_class(F.greatest(x, zero), F.greatest(-x, zero), scoring.bounded(x), F.abs(x), zero)
    return table(spark, sf_dir, "documents").select("doc_id", named.alias("class"))
