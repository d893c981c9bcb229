"""Scoring queries: documents are units, languages platforms, doc_id % 7 the dimension, labels the flags."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.operators import agreement, contracts, identity, scoring, text
from quillspark.plans.registry import query
from quillspark.session import table


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units with their flags; a document without labels has unknown flags."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    return docs.join(labels, "doc_id", "left").select(
        "doc_id",
        F.col("lang").alias("platform"),
        "source",
        (F.col("doc_id") % 7).cast("int").alias("dim"),
        (-5 + 10 * (F.col("n_chars") % 101).cast("double") / 100).alias("s"),
        F.least(F.lit(1.0), F.col("n_chars") / F.lit(2000.0)).alias("w"),
        F.sha2(text.normal_form(F.col("text")), 256).alias("form"),
        "n_chars",
        "quality",
        "toxic",
    )


RULES = {
    "quality_unknown": lambda: F.col("quality").isNull(),
    "low_quality": lambda: F.coalesce(F.col("quality") == 0, F.lit(False)),
    "toxic_or_unknown": lambda: F.coalesce(F.col("toxic") != 0, F.lit(True)),
    "too_short": lambda: F.col("n_chars") < 40,
}


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contracts.with_reasons(units(spark, sf_dir), {k: rule() for k, rule in RULES.items()})


def eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eligible units, the first of each text in its dimension."""
    return scoring.first_wins(judged(spark, sf_dir).where("eligible"), ["dim", "form"], ["doc_id"])


UNITS = r"""
WITH units AS (
  SELECT d.doc_id, d.lang AS platform, d.source, CAST(d.doc_id % 7 AS INTEGER) AS dim,
    -5 + 10 * CAST(d.n_chars % 101 AS DOUBLE) / 100 AS s, least(1.0::DOUBLE, d.n_chars / 2000.0::DOUBLE) AS w,
    sha256(lower(trim(regexp_replace(d.text, '\s+', ' ', 'g')))) AS form, d.n_chars, l.quality, l.toxic
  FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id) l USING (doc_id)
), judged AS (
  SELECT *, list_filter([CASE WHEN quality IS NULL THEN 'quality_unknown' END, CASE WHEN quality = 0 THEN 'low_quality' END,
    CASE WHEN coalesce(toxic <> 0, true) THEN 'toxic_or_unknown' END, CASE WHEN n_chars < 40 THEN 'too_short' END], lambda x: x IS NOT NULL) AS reasons
  FROM units
), eligible AS (
  SELECT * FROM judged WHERE len(reasons) = 0 QUALIFY row_number() OVER (PARTITION BY dim, form ORDER BY doc_id) = 1
), cell_sums AS (
  SELECT platform, dim, count(*) AS n, CAST(sum(CAST(s AS DECIMAL(18,5)) * CAST(w AS DECIMAL(18,5))) AS DOUBLE) / CAST(sum(CAST(w AS DECIMAL(18,5))) AS DOUBLE) AS mean
  FROM eligible GROUP BY ALL HAVING count(*) >= 3
), cells AS (
  SELECT platform, dim, n, CAST(CASE WHEN mean >= 0 THEN floor(mean + 0.5) ELSE ceil(mean - 0.5) END AS BIGINT) AS tendency FROM cell_sums
), scored AS (
  SELECT *, (tendency + 5) * 10 AS conversion, [0.15::DOUBLE, 0.15, 0.20, 0.15, 0.10, 0.15, 0.10][dim + 1] AS weight FROM cells
), platforms AS (
  SELECT platform, CAST(sum(n) AS BIGINT) AS effective, count(*) AS dims, round(sum(weight * conversion) / sum(weight) + 1e-12, 1) AS partial_score FROM scored GROUP BY platform
), included AS (
  SELECT * FROM platforms QUALIFY effective >= 5 OR NOT max(effective >= 5) OVER ()
), dims AS (
  SELECT dim, count(*) AS platforms, round(avg(conversion) + 1e-12, 1) AS score FROM scored WHERE platform IN (SELECT platform FROM included) GROUP BY dim
)
"""


@query(UNITS + "SELECT platform, dim, count(*) AS n, count(CASE WHEN s > 0 THEN 1 END) AS positive, count(CASE WHEN s < 0 THEN 1 END) AS negative FROM eligible GROUP BY ALL HAVING count(*) >= 3")
def eligible_units_by_platform_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = eligible(spark, sf_dir).groupBy("platform", "dim")
    return grouped.agg(F.count("*").alias("n"), F.count_if(F.col("s") > 0).alias("positive"), F.count_if(F.col("s") < 0).alias("negative")).where("n >= 3")


@query(
    UNITS
    + """, counted AS (SELECT platform, unnest(reasons) AS reason FROM judged), sums AS (SELECT platform, reason, count(*) AS n FROM counted GROUP BY ALL)
SELECT platform, reason, n, CAST(row_number() OVER (PARTITION BY platform ORDER BY n DESC, reason) AS INTEGER) AS place FROM sums QUALIFY place <= 3"""
)
def exclusion_reasons_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contracts.top_reasons(judged(spark, sf_dir), ["platform"])


@query(UNITS + "SELECT dim, count(*) AS n, sum(doc_id)::BIGINT AS ids FROM eligible GROUP BY dim")
def first_wins_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eligible(spark, sf_dir).groupBy("dim").agg(F.count("*").alias("n"), F.sum("doc_id").alias("ids"))


@query(UNITS + "SELECT platform, dim, n, tendency, conversion FROM scored")
def platform_dimension_tendency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.cells(eligible(spark, sf_dir))


@query(UNITS + "SELECT platform, effective, dims, partial_score, CASE WHEN dims = 7 THEN partial_score END AS full_score FROM platforms")
def platform_partial_and_full_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.platform_scores(scoring.cells(eligible(spark, sf_dir)))


@query(UNITS + "SELECT platform, effective FROM included")
def platform_inclusion_exception(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.included(scoring.platform_scores(scoring.cells(eligible(spark, sf_dir)))).select("platform", "effective")


@query(UNITS + "SELECT dim, platforms, score FROM dims")
def equal_weight_dimension_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = scoring.cells(eligible(spark, sf_dir))
    return scoring.dimension_scores(scored, scoring.included(scoring.platform_scores(scored)))


@query(
    UNITS
    + """, p0 AS (SELECT platform, effective::DOUBLE AS c, effective::DOUBLE / sum(effective) OVER () AS sh0, count(*) OVER () AS m FROM platforms),
p1 AS (SELECT *, CASE WHEN sh0 > 0.5 THEN 0.5 ELSE (1 - 0.5 * count(CASE WHEN sh0 > 0.5 THEN 1 END) OVER ()) * c / sum(CASE WHEN sh0 <= 0.5 THEN c END) OVER () END AS sh1 FROM p0),
p2 AS (SELECT *, CASE WHEN sh0 > 0.5 OR sh1 > 0.5 THEN 0.5 ELSE (1 - 0.5 * count(CASE WHEN sh0 > 0.5 OR sh1 > 0.5 THEN 1 END) OVER ()) * c / sum(CASE WHEN NOT (sh0 > 0.5 OR sh1 > 0.5) THEN c END) OVER () END AS sh2 FROM p1)
SELECT platform, CASE WHEN m >= 2 THEN round(sh2, 6) END AS weight FROM p2"""
)
def capped_sample_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.capped_weights(scoring.platform_scores(scoring.cells(eligible(spark, sf_dir))))


@query(
    UNITS
    + """SELECT dim, count(*) AS units, count(DISTINCT form) AS pages, count(DISTINCT source) AS categories, count(DISTINCT platform) AS platforms,
CASE WHEN count(*) >= 60 AND count(DISTINCT form) >= 30 AND count(DISTINCT source) >= 5 AND count(DISTINCT platform) >= 3 THEN 'high'
WHEN count(*) >= 40 AND count(DISTINCT form) >= 20 AND count(DISTINCT source) >= 4 AND count(DISTINCT platform) >= 3 THEN 'medium_high'
WHEN count(*) >= 25 AND count(DISTINCT form) >= 12 AND count(DISTINCT source) >= 3 AND count(DISTINCT platform) >= 2 THEN 'medium' ELSE 'low' END AS tier
FROM eligible GROUP BY dim"""
)
def dimension_confidence_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = eligible(spark, sf_dir).groupBy("dim").agg(
        F.count("*").alias("units"), F.count_distinct("form").alias("pages"), F.count_distinct("source").alias("categories"), F.count_distinct("platform").alias("platforms")
    )
    return sums.withColumn("tier", scoring.confidence_tier(*[F.col(c) for c in ("units", "pages", "categories", "platforms")]))


@query(
    UNITS
    + """SELECT j.dim, count(DISTINCT j.form) AS retrieved, count(DISTINCT CASE WHEN j.n_chars >= 40 THEN j.form END) AS topic,
count(DISTINCT CASE WHEN len(j.reasons) = 0 THEN j.form END) AS eligible, count(DISTINCT CASE WHEN len(j.reasons) = 0 AND c.n IS NOT NULL THEN j.form END) AS scored
FROM judged j LEFT JOIN cells c USING (platform, dim) GROUP BY j.dim"""
)
def funnel_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four nested counts of distinct pages for each dimension."""
    every = judged(spark, sf_dir).join(scoring.cells(eligible(spark, sf_dir)).select("platform", "dim", "n"), ["platform", "dim"], "left")

    def pages(condition):
        return F.count_distinct(F.when(condition, F.col("form")))

    return every.groupBy("dim").agg(
        F.count_distinct("form").alias("retrieved"),
        pages(F.col("n_chars") >= 40).alias("topic"),
        pages(F.col("eligible")).alias("eligible"),
        pages(F.col("eligible") & F.col("n").isNotNull()).alias("scored"),
    )


@query(
    UNITS
    + """, n AS (SELECT source, count(*) AS n, count(*) / sum(count(*)) OVER () AS share FROM eligible GROUP BY source)
SELECT source, n, CASE WHEN share >= 0.5 THEN 'A' WHEN share >= 0.3 THEN 'B' WHEN share >= 0.15 THEN 'C' WHEN share >= 0.05 THEN 'D' WHEN share > 0 THEN 'E' ELSE 'U' END AS level FROM n"""
)
def mention_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = eligible(spark, sf_dir).groupBy("source").agg(F.count("*").alias("n"))
    total = counted.agg(F.sum("n").alias("total"))
    return counted.join(F.broadcast(total), F.lit(True)).select("source", "n", scoring.mention_level(F.col("n") / F.col("total")).alias("level"))


@query(
    UNITS
    + """, t AS (SELECT source AS theme, count(*) AS n, count(CASE WHEN len(reasons) = 0 THEN 1 END) AS scored, count(CASE WHEN s > 0 THEN 1 END) AS pos, count(CASE WHEN s < 0 THEN 1 END) AS neg, count(CASE WHEN s = 0 THEN 1 END) AS neu,
arg_min(dim, doc_id) AS first_dim FROM judged GROUP BY source)
SELECT theme, n, scored, pos, neg, neu, CASE WHEN neg >= pos AND neg >= neu THEN 'negative' WHEN pos >= neu THEN 'positive' ELSE 'neutral' END AS direction, first_dim FROM t"""
)
def theme_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of each theme and its main direction; ties: negative, positive, neutral."""
    sums = judged(spark, sf_dir).groupBy(F.col("source").alias("theme")).agg(
        F.count("*").alias("n"), F.count_if("eligible").alias("scored"), F.count_if(F.col("s") > 0).alias("pos"), F.count_if(F.col("s") < 0).alias("neg"),
        F.count_if(F.col("s") == 0).alias("neu"), F.min_by("dim", "doc_id").alias("first_dim"),
    )
    direction = F.when((F.col("neg") >= F.col("pos")) & (F.col("neg") >= F.col("neu")), "negative").when(F.col("pos") >= F.col("neu"), "positive").otherwise("neutral")
    return sums.withColumn("direction", direction)


FLAGSHIP = """SELECT c.dims, CASE WHEN c.dims = 7 THEN round(c.total + 1e-12, 1) END AS composite, c.flags FROM (
SELECT count(score) AS dims, sum(score * [0.15::DOUBLE, 0.15, 0.20, 0.15, 0.10, 0.15, 0.10][dim + 1]) AS total,
coalesce(string_agg(CASE WHEN dim IN (0, 3, 5) AND score <= 40 THEN dim::VARCHAR END, ',' ORDER BY dim), '') AS flags FROM dims) c"""


@query(UNITS + FLAGSHIP)
def flagship_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = scoring.cells(eligible(spark, sf_dir))
    return scoring.composite(scoring.dimension_scores(scored, scoring.included(scoring.platform_scores(scored))))


@query(
    UNITS
    + """SELECT source, count(*) AS n, count(DISTINCT platform) AS platforms, count(DISTINCT form) AS pages, min(n_chars) AS shortest, max(n_chars) AS longest,
count(CASE WHEN len(reasons) = 0 THEN 1 END) AS used FROM judged GROUP BY source ORDER BY n DESC, source LIMIT 8"""
)
def source_group_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eight largest sources (A21); the limit is the report's."""
    sums = judged(spark, sf_dir).groupBy("source").agg(
        F.count("*").alias("n"), F.count_distinct("platform").alias("platforms"), F.count_distinct("form").alias("pages"), F.min("n_chars").alias("shortest"), F.max("n_chars").alias("longest"), F.count_if("eligible").alias("used")
    )
    return sums.orderBy(F.desc("n"), "source").limit(8)


@query(
    """WITH p AS (SELECT doc_id, max(quality) AS a, max(toxic) AS b FROM labels GROUP BY doc_id), c AS (SELECT count(*) AS n, count(CASE WHEN a = b THEN 1 END) AS same FROM p),
l AS (SELECT a AS label, count(*) AS na FROM p GROUP BY a), r AS (SELECT b AS label, count(*) AS nb FROM p GROUP BY b), e AS (SELECT sum(na * nb) AS pe FROM l JOIN r USING (label))
SELECT n, round(same / n::DOUBLE, 6) AS observed, round(pe / (n::DOUBLE * n), 6) AS expected, round((same / n::DOUBLE - pe / (n::DOUBLE * n)) / (1 - pe / (n::DOUBLE * n)), 6) AS kappa FROM c, e"""
)
def cohen_kappa_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("a"), F.max("toxic").alias("b"))
    return agreement.cohen_kappa(pairs)


@query(
    """WITH r AS (SELECT doc_id AS unit, quality AS label FROM labels UNION ALL SELECT doc_id, toxic FROM labels), m AS (SELECT unit, count(*) AS m FROM r GROUP BY unit HAVING count(*) >= 2),
k AS (SELECT unit, label, count(*) AS k FROM r GROUP BY ALL), o AS (SELECT x.label AS a, y.label AS b, sum(x.k * (CASE WHEN x.label = y.label THEN y.k - 1 ELSE y.k END) / (m - 1)::DOUBLE) AS o
FROM k x JOIN k y USING (unit) JOIN m USING (unit) GROUP BY ALL), g AS (SELECT a, sum(o) AS n FROM o GROUP BY a), s AS (SELECT sum(o) AS n, sum(CASE WHEN a <> b THEN o ELSE 0 END) AS d FROM o),
e AS (SELECT sum(CASE WHEN x.a <> y.a THEN x.n * y.n ELSE 0 END) AS d FROM g x, g y)
SELECT round(s.n, 6) AS n, round(s.d / s.n, 6) AS disagreement, round(e.d / (s.n * (s.n - 1)), 6) AS expected, round(1 - (s.d / s.n) / (e.d / (s.n * (s.n - 1))), 6) AS alpha FROM s, e"""
)
def krippendorff_alpha_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    ratings = labels.select(F.col("doc_id").alias("unit"), F.col("quality").alias("label")).unionByName(labels.select(F.col("doc_id").alias("unit"), F.col("toxic").alias("label")))
    return agreement.krippendorff_alpha(ratings)


@query(UNITS + "SELECT count(*) AS rows_compared, 0::BIGINT AS only_left, 0::BIGINT AS only_right FROM scored")
def independent_recompute_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cells by columns against the cells by SQL, row for row."""
    rows = eligible(spark, sf_dir)
    first = scoring.cells(rows)
    rows.createOrReplaceTempView("quill_eligible")
    second = spark.sql(
        """WITH m AS (SELECT platform, dim, count(*) AS n, CAST(sum(CAST(s AS DECIMAL(18,5)) * CAST(w AS DECIMAL(18,5))) AS DOUBLE) / CAST(sum(CAST(w AS DECIMAL(18,5))) AS DOUBLE) AS mean
        FROM quill_eligible GROUP BY platform, dim HAVING count(*) >= 3), t AS (SELECT platform, dim, n, CAST(sign(mean) * floor(abs(mean) + 0.5D) AS BIGINT) AS tendency FROM m)
        SELECT platform, dim, n, tendency, (tendency + 5) * 10 AS conversion FROM t"""
    )
    one, left, right = (x.agg(F.count("*").alias(name)) for x, name in ((first, "rows_compared"), (first.exceptAll(second), "only_left"), (second.exceptAll(first), "only_right")))
    return one.join(left, F.lit(True)).join(right, F.lit(True))  # one row each


@query(
    r"""WITH h AS (SELECT lang, sha256(concat_ws(chr(31), doc_id::VARCHAR, coalesce(source, chr(0)), coalesce(text, chr(0)))) AS r FROM documents),
b AS (SELECT lang, r[1:3] AS bucket, sha256(string_agg(r, '' ORDER BY r)) AS part, count(*) AS n FROM h GROUP BY ALL)
SELECT lang, sha256(string_agg(part, '' ORDER BY bucket)) AS recordset, sum(n)::BIGINT AS n FROM b GROUP BY lang"""
)
def recordset_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.recordset_hash(table(spark, sf_dir, "documents"), ["doc_id", "source", "text"], ["lang"])


@query("SELECT doc_id, round(-5 + 10 * (n_chars - 1) / 40000.0, 6)::DOUBLE AS score, round(greatest(-5, least(5, 5 * (n_chars % 13 - 6) / sqrt((n_chars % 13 - 6) ^ 2 + 15))), 6) AS bounded FROM documents WHERE n_chars BETWEEN 1 AND 40001")
def native_rating_rescale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4 and M5 over document lengths."""
    docs = table(spark, sf_dir, "documents")
    total = (F.col("n_chars") % 13 - 6).cast("double")
    scaled = scoring.rescaled(F.col("n_chars").cast("double"), F.lit(1.0), F.lit(40001.0))
    return docs.select("doc_id", F.round(scaled, 6).alias("score"), F.round(scoring.bounded(total), 6).alias("bounded")).where("score is not null")


@query()
def native_rating_rescale_all_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """native_rating_rescale with a row for each document: score is null off the scale, bounded is always given."""
    docs = table(spark, sf_dir, "documents")
    scaled = scoring.rescaled(F.col("n_chars").cast("double"), F.lit(1.0), F.lit(40001.0))
    return docs.select("doc_id", F.round(scaled, 6).alias("score"), F.round(scoring.bounded((F.col("n_chars") % 13 - 6).cast("double")), 6).alias("bounded"))


@query(
    r"""WITH t AS (SELECT doc_id, length(regexp_replace(text, '\s+', '', 'g')) AS k FROM documents),
c AS (SELECT doc_id, CASE WHEN k >= 30 THEN 1.0 WHEN k >= 15 THEN 0.8 WHEN k >= 6 THEN 0.6 WHEN k > 0 THEN 0.3 ELSE 0.0 END::DOUBLE AS complete FROM t)
SELECT doc_id, complete, round(0.25 + 0.20 * complete + 0.20 * complete + 0.20 * complete + 0.10 * 0.5 + 0.05, 6) AS reliability FROM c"""
)
def completeness_and_reliability(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = F.lit(1.0)
    df = table(spark, sf_dir, "documents").select("doc_id", scoring.completeness(F.col("text")).alias("complete"))
    c = F.col("complete")
    return df.withColumn("reliability", F.round(scoring.reliability(one, c, c, c, F.lit(0.5), one), 6))
