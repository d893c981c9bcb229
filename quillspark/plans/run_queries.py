"""Queries over a retrieval run: events are executions of queries in seven dimensions, pages their sources, documents the units."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.operators import audits, budgets, contracts, costs, execution, links
from quillspark.plans.registry import query
from quillspark.plans.scoring_queries import UNITS, eligible
from quillspark.session import table

STATUS = {"view": "completed", "click": "partial", "signup": "no_results", "purchase": "blocked", "error": "failed"}
ACTIONS = ("continue", "exhausted", "retry", "not_applicable", "target_met")
ERRORS = ("timeout", "server_error", "parse_error")


def _nth(values: tuple[str, ...], at: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), at.cast("int"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Executions with their dimensions, round (0 is the baseline), outcome and page counts."""
    i = F.col("event_id")
    status = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(v)) for k, v in STATUS.items()])
    number = F.floor((F.dayofmonth("ts") - 1) / 5).cast("int")
    return table(spark, sf_dir, "events").select(
        i.alias("execution_id"), "user_id", "ts", (F.col("ts") + F.expr("interval 30 minutes")).alias("end_ts"), number.alias("round"), status.alias("status"),
        _nth(ACTIONS, i % 5).alias("action"), _nth(ERRORS, i % 3).alias("error"), F.array_distinct(F.array((i % 7).cast("int"), (F.floor(i / 7) % 7).cast("int"))).alias("dims"),
        F.concat(F.lit("c"), (i % 16).cast("string")).alias("category"), F.when(number >= 3, "medium_enhancement").otherwise("evidence_gap_fill").alias("mode"), (i % 9 == 0).alias("retry"),
        F.get_json_object("props", "$.k").cast("long").alias("intent"), _nth(("positive", "negative", "neutral"), i % 3).alias("polarity"), (i % 7).alias("subject"), (i % 10).alias("time"),
        (i % 6).alias("opened"), (i % 4).alias("relevant_pages"), (i % 3).alias("duplicates"), (i % 8).alias("returned"), F.col("value").alias("gain"),
    )


RUNS = """
WITH runs AS (SELECT event_id AS execution_id, user_id, ts, ts + INTERVAL 30 MINUTE AS end_ts, CAST((day(ts) - 1) // 5 AS INTEGER) AS round,
  CASE event_type WHEN 'view' THEN 'completed' WHEN 'click' THEN 'partial' WHEN 'signup' THEN 'no_results' WHEN 'purchase' THEN 'blocked' ELSE 'failed' END AS status,
  ['continue', 'exhausted', 'retry', 'not_applicable', 'target_met'][event_id % 5 + 1] AS action, ['timeout', 'server_error', 'parse_error'][event_id % 3 + 1] AS error,
  list_distinct([CAST(event_id % 7 AS INTEGER), CAST((event_id // 7) % 7 AS INTEGER)]) AS dims, 'c' || CAST(event_id % 16 AS VARCHAR) AS category,
  CASE WHEN (day(ts) - 1) // 5 >= 3 THEN 'medium_enhancement' ELSE 'evidence_gap_fill' END AS mode, event_id % 9 = 0 AS retry, CAST(json_extract_string(props, '$.k') AS BIGINT) AS intent,
  ['positive', 'negative', 'neutral'][event_id % 3 + 1] AS polarity, event_id % 7 AS subject, event_id % 10 AS time, event_id % 6 AS opened, event_id % 4 AS relevant_pages, event_id % 3 AS duplicates, event_id % 8 AS returned, value AS gain
  FROM events),
fresh AS (SELECT *, row_number() OVER (PARTITION BY intent ORDER BY ts, execution_id) = 1 AS is_new FROM runs),
deep AS (SELECT *, unnest(dims) AS dim FROM fresh WHERE round > 0),
sources AS (SELECT page_id AS source_id, page_id * 3 AS execution_id, url, page_id % 5 <> 0 AS relevant, 'c' || CAST(page_id % 16 AS VARCHAR) AS category, lower(regexp_extract(url, '^[A-Za-z]+://([^/?#:]*)', 1)) AS domain, html FROM pages)
"""


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as sources of every third execution."""
    i = F.col("page_id")
    return table(spark, sf_dir, "pages").select(
        i.alias("source_id"), (i * 3).alias("execution_id"), "url", (i % 5 != 0).alias("relevant"), F.concat(F.lit("c"), (i % 16).cast("string")).alias("category"),
        F.lower(F.regexp_extract("url", r"^[A-Za-z]+://([^/?#:]*)", 1)).alias("domain"), "html",
    )


@query(
    RUNS
    + """, g AS (SELECT CASE WHEN round = 0 THEN 'baseline' ELSE 'deep' END AS grain, NULL::INTEGER AS dim, NULL::INTEGER AS n, count(*) FILTER (is_new) AS intents, count(*) AS attempts, count(*) FILTER (retry) AS retries FROM fresh GROUP BY 1
UNION ALL SELECT 'total', NULL, NULL, count(*) FILTER (is_new), count(*), count(*) FILTER (retry) FROM fresh UNION ALL SELECT 'round', NULL, round, count(*) FILTER (is_new), count(*), count(*) FILTER (retry) FROM fresh WHERE round > 0 GROUP BY round
UNION ALL SELECT 'dimension', dim, NULL, count(*) FILTER (is_new), count(*), count(*) FILTER (retry) FROM deep GROUP BY dim UNION ALL SELECT 'dimension_round', dim, round, count(*) FILTER (is_new), count(*), count(*) FILTER (retry) FROM deep GROUP BY dim, round),
l(grain, counter, most) AS (VALUES ('baseline','intents',120),('baseline','attempts',144),('baseline','retries',24),('deep','intents',300),('deep','attempts',360),('deep','retries',60),('total','attempts',504),('total','retries',84),('round','intents',60),('round','attempts',72),
('round','retries',12),('dimension','intents',48),('dimension','attempts',62),('dimension','retries',14),('dimension_round','intents',10),('dimension_round','attempts',13),('dimension_round','retries',3)),
u AS (UNPIVOT g ON intents, attempts, retries INTO NAME counter VALUE actual)
SELECT u.grain, dim, n AS round, u.counter, actual, CAST(most AS BIGINT) AS most FROM u JOIN l ON u.grain = l.grain AND u.counter = l.counter WHERE actual > most"""
)
def budget_compliance_by_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intents, attempts and retries over their limits at six grains."""
    log = runs(spark, sf_dir).select("execution_id", "ts", "intent", "dims", "round", "retry")
    return budgets.over(budgets.used(log), budgets.limits(spark))


@query(
    RUNS
    + """, u AS (SELECT user_id, count(DISTINCT intent) AS i, count(*) AS a, count(*) FILTER (retry) AS r FROM runs GROUP BY user_id)
SELECT user_id, 60 - i AS intents_left, 80 - a AS attempts_left, 8 - r AS retries_left, NOT (60 - i < 12 OR 80 - a < 12 + greatest(0, 8 - r) OR r > 8) AS feasible,
concat_ws(',', CASE WHEN 60 - i < 12 THEN 'independent_intent_budget_infeasible' END, CASE WHEN 80 - a < 12 + greatest(0, 8 - r) THEN 'actual_attempt_budget_infeasible' END, CASE WHEN r > 8 THEN 'retry_budget_infeasible' END) AS reasons FROM u"""
)
def planning_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Budget account of each user's log."""
    used = runs(spark, sf_dir).groupBy("user_id").agg(F.count_distinct("intent").alias("i"), F.count("*").alias("a"), F.count_if("retry").alias("r"))
    told = used.select("user_id", budgets.account(F.col("i"), F.lit(60), F.col("a"), F.lit(80), F.col("r"), F.lit(8), F.lit(4), F.lit(8)).alias("x"))
    return told.select("user_id", "x.intents_left", "x.attempts_left", "x.retries_left", "x.feasible", F.array_join("x.reasons", ",").alias("reasons"))


@query(
    UNITS
    + """, c AS (SELECT dim, count(*) AS scored FROM eligible GROUP BY dim), r AS (SELECT d AS dim, coalesce(scored, 0) AS scored FROM (SELECT unnest(range(7))::INTEGER AS d) LEFT JOIN c ON c.dim = d)
SELECT dim, scored, 25 AS required, CAST(greatest(0, 25 - scored) AS BIGINT) AS gap, scored >= 25 AS met, CAST(sum(scored) OVER () AS BIGINT) AS total, 175 AS theoretical, min(scored) OVER () >= 25 AS target_met FROM r"""
)
def target_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each dimension, and so the whole, reaches the medium tier."""
    counted = eligible(spark, sf_dir).groupBy("dim").agg(F.count("*").alias("scored"))
    rank = F.when(F.col("scored") >= 60, 4).when(F.col("scored") >= 40, 3).when(F.col("scored") >= 25, 2).otherwise(1)
    return budgets.target_status(counted.withColumn("rank", rank), "medium")


@query(
    RUNS
    + """, s AS (SELECT dim, round, count(*) FILTER (is_new) AS n, round >= 3 AS e FROM deep GROUP BY dim, round),
w AS (SELECT dim, round, e, n, coalesce(sum(n) OVER (PARTITION BY dim ORDER BY round ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used, count(*) OVER p AS t, count(*) FILTER (e) OVER p AS x FROM s WINDOW p AS (PARTITION BY dim ORDER BY round)),
q AS (SELECT dim, round, CAST(used AS BIGINT) AS used, e, greatest(0, 5 - t) AS later, least(greatest(0, 5 - t), greatest(0, 3 - x)) AS le FROM w)
SELECT dim, round, used, le * 10 + (later - le) * 8 AS reserved, greatest(0, 48 - used - (le * 10 + (later - le) * 8)) AS available, least(CASE WHEN e THEN 10 ELSE 8 END, greatest(0, 48 - used - (le * 10 + (later - le) * 8))) AS quota, used >= 48 AS reached FROM q"""
)
def round_quotas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries of each dimension in each round, with later rounds' needs set aside."""
    log = execution.new_intents(runs(spark, sf_dir)).where("round > 0").select(F.explode("dims").alias("dim"), "round", "is_new", (F.col("mode") == "medium_enhancement").alias("e"))
    by = log.groupBy("dim", "round").agg(F.count_if("is_new").alias("n"), F.bool_or("e").alias("e"))
    w = Window.partitionBy("dim").orderBy("round")
    seen = by.withColumn("used", F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("t", F.count("*").over(w)).withColumn("x", F.count_if("e").over(w))
    return seen.select("dim", "round", "used", budgets.quota(F.col("used"), F.col("t"), F.col("x"), F.col("e")).alias("q")).select("dim", "round", "used", "q.*")


@query(
    RUNS
    + """, s AS (SELECT dim, count(*) FILTER (is_new) AS used, count(DISTINCT round) AS done FROM deep WHERE round <= 1 + dim % 2 GROUP BY dim),
p AS (SELECT dim, used, unnest(generate_series(done + 1, 5)) AS round FROM s), q AS (SELECT *, CASE WHEN 3 >= 6 - round THEN 10 ELSE 8 END AS planned FROM p),
o AS (SELECT 'dimension' AS scope, CAST(dim AS BIGINT) AS id, max(used) + sum(planned) AS needed, 48 AS most FROM q GROUP BY dim UNION ALL SELECT 'round', round, sum(planned), 60 FROM q GROUP BY round UNION ALL SELECT 'all', NULL, sum(planned) + 90, 300 FROM q)
SELECT scope, id, CAST(needed AS BIGINT) AS needed, most, needed <= most AS feasible FROM o"""
)
def search_feasibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the rounds still due fit the budgets of dimensions, rounds and all."""
    log = execution.new_intents(runs(spark, sf_dir)).where("round > 0").select(F.explode("dims").alias("dim"), "round", "is_new").where("round <= 1 + dim % 2")
    state = log.groupBy("dim").agg(F.count_if("is_new").alias("used"), F.count_distinct("round").alias("done"), F.lit(0).alias("enhanced"))
    return budgets.feasibility(state, 90)


@query(
    RUNS
    + """, s AS (SELECT dim, round, count(*) FILTER (is_new AND status <> 'failed') AS intents FROM deep GROUP BY dim, round), g AS (SELECT d::INTEGER AS dim, r::INTEGER AS round FROM (SELECT unnest(range(7)) AS d) CROSS JOIN (SELECT unnest(range(1, 7)) AS r))
SELECT g.dim, g.round, coalesce(intents, 0) AS intents, CASE WHEN intents IS NULL THEN 'missing_rounds' WHEN intents < CASE WHEN g.round >= 3 THEN 10 ELSE 8 END THEN 'dimension_round_query_minimum_not_met' ELSE '' END AS codes FROM g LEFT JOIN s ON s.dim = g.dim AND s.round = g.round"""
)
def round_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of each dimension and round against the contract of a round."""
    log = execution.new_intents(runs(spark, sf_dir)).withColumn("coverage", contracts.coverage(F.col("status")))
    return budgets.round_reasons(log, 6).withColumn("codes", F.array_join("codes", ","))


TRACED = """, traced AS (SELECT dim, source_id AS page, s.domain, s.category FROM deep JOIN sources s USING (execution_id)), gains AS (SELECT dim, round, count(*) AS n FROM deep JOIN sources s USING (execution_id) WHERE s.relevant GROUP BY ALL)"""


def _searched(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    log = runs(spark, sf_dir).where("round > 0").withColumn("dim", F.explode("dims")).drop("dims").withColumn("query", F.col("intent"))
    joined = log.select("execution_id", "dim", "round").join(sources(spark, sf_dir), "execution_id")
    traced = joined.select("dim", F.col("source_id").alias("page"), "domain", "category")
    return log, traced, joined.where("relevant").groupBy("dim", "round").agg(F.count("*").alias("n"))


@query(
    RUNS
    + TRACED
    + """, r AS (SELECT dim, round, count(DISTINCT intent) AS q, bool_and(status IN ('blocked', 'no_results')) AS empty, bool_or(action = 'exhausted') AS ended FROM deep GROUP BY dim, round),
o AS (SELECT r.*, coalesce(n, 0) AS n, row_number() OVER (PARTITION BY r.dim ORDER BY r.round DESC) AS back FROM r LEFT JOIN gains g ON g.dim = r.dim AND g.round = r.round),
d AS (SELECT dim, count(*) >= 4 AS er, count(*) >= 4 AND min(q) >= 8 AS eq, bool_or(ended AND back = 1) AS fe, count(*) >= 2 AND max(n) FILTER (back <= 2) < 2 AS low, bool_or(empty AND back = 1) AS blocked FROM o GROUP BY dim),
c AS (SELECT dim, count(DISTINCT category) >= 5 AS ec FROM deep GROUP BY dim), t AS (SELECT dim, count(DISTINCT page) AS p, count(DISTINCT domain) AS h, count(DISTINCT category) AS k FROM traced GROUP BY dim),
x AS (SELECT d.dim, er, eq, ec, fe, low AND coalesce(p >= 12 AND h >= 3 AND k >= 3, false) AS lr, blocked AND coalesce(p >= 5 AND h >= 2, false) AS br FROM d JOIN c USING (dim) LEFT JOIN t USING (dim))
SELECT dim, er AS enough_rounds, eq AS enough_queries, ec AS enough_categories, fe AS final_action_exhausted, lr AS low_yield_route, br AS blocked_route, er AND eq AND ec AND fe AND (lr OR br) AS passed FROM x"""
)
def exhaustion_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each dimension is searched out."""
    return audits.search_checks(*_searched(spark, sf_dir), audits.EXHAUSTION)


@query(
    RUNS
    + TRACED
    + """, e AS (SELECT * FROM deep WHERE round >= 3), r AS (SELECT dim, round, count(DISTINCT intent) AS q, bool_and(status IN ('blocked', 'no_results')) AS empty, bool_or(action = 'exhausted') AS ended FROM e GROUP BY dim, round),
o AS (SELECT r.*, coalesce(n, 0) AS n, row_number() OVER (PARTITION BY r.dim ORDER BY r.round DESC) AS back FROM r LEFT JOIN gains g ON g.dim = r.dim AND g.round = r.round),
d AS (SELECT dim, count(*) >= 3 AS er, count(*) >= 3 AND min(q) >= 10 AS eq, bool_or(ended AND back = 1) AS fe, count(*) >= 3 AND max(n) FILTER (back <= 3) < 2 AS low, bool_or(empty AND back = 1) AS blocked FROM o GROUP BY dim),
c AS (SELECT dim, count(DISTINCT category) >= 6 AS ec, bool_or(polarity = 'positive') AND bool_or(polarity = 'negative') AS pol, count(DISTINCT subject) >= 3 AS sub, count(DISTINCT time) >= 3 AS tim FROM e GROUP BY dim),
a AS (SELECT dim, count(DISTINCT round) >= 5 AS tr FROM deep GROUP BY dim), t AS (SELECT dim, count(DISTINCT page) AS p, count(DISTINCT domain) AS h, count(DISTINCT category) AS k FROM traced GROUP BY dim),
x AS (SELECT d.dim, er, eq, ec, fe, low AND coalesce(p >= 20 AND h >= 5 AND k >= 4, false) AS lr, blocked AND coalesce(p >= 10 AND h >= 4, false) AS br, tr, pol, sub, tim FROM d JOIN c USING (dim) JOIN a USING (dim) LEFT JOIN t USING (dim))
SELECT dim, er AS enough_rounds, eq AS enough_queries, ec AS enough_categories, fe AS final_action_exhausted, lr AS low_yield_route, br AS blocked_route, tr AS enough_total_rounds, pol AS both_polarities, sub AS enough_subjects, tim AS enough_times,
er AND eq AND ec AND fe AND (lr OR br) AND tr AND pol AND sub AND tim AS passed FROM x"""
)
def medium_completion_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each dimension is complete at medium."""
    return audits.medium_checks(*_searched(spark, sf_dir))


@query(
    RUNS
    + """, d AS (SELECT dim, count(DISTINCT round) AS rounds FROM deep GROUP BY dim), claims AS (SELECT dim, CASE WHEN dim % 3 = 0 THEN rounds + 1 ELSE rounds END AS rounds FROM d WHERE dim <> 5 UNION ALL SELECT 9, 1)
SELECT coalesce(d.dim, c.dim) AS dim, CASE WHEN c.dim IS NULL THEN 'claim_missing' WHEN d.dim IS NULL THEN 'claim_unfounded' ELSE 'claim_differs:rounds' END AS codes FROM d FULL JOIN claims c ON c.dim = d.dim WHERE c.rounds IS DISTINCT FROM d.rounds"""
)
def claims_recomputed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claimed round counts against those of the log."""
    found = runs(spark, sf_dir).where("round > 0").select(F.explode("dims").alias("dim"), "round").groupBy("dim").agg(F.count_distinct("round").alias("rounds"))
    claims = found.where("dim <> 5").withColumn("rounds", F.when(F.col("dim") % 3 == 0, F.col("rounds") + 1).otherwise(F.col("rounds")))
    claims = claims.unionByName(spark.createDataFrame([(9, 1)], "dim int, rounds long"))
    return audits.verify_claims(claims, found, ["dim"], ["rounds"]).withColumn("codes", F.array_join("codes", ","))


STATUSES = ("sufficient", "sufficient_at_requested_target", "sufficient_at_medium_after_audit", "exhausted_with_shortfall", "retrieval_terminated_with_shortfall", "needs_iteration", "", "other")


@query(
    """WITH u AS (SELECT doc_id, ['sufficient', 'sufficient_at_requested_target', 'sufficient_at_medium_after_audit', 'exhausted_with_shortfall', 'retrieval_terminated_with_shortfall', 'needs_iteration', '', 'other'][doc_id % 8 + 1] AS status,
n_chars % 2 = 0 AS met, n_chars % 3 = 0 AS medium, n_chars % 5 < 2 AS exhausted, n_chars % 7 < 3 AS restricted, n_chars % 11 < 5 AS numeric FROM documents),
l AS (SELECT *, CASE status WHEN 'sufficient' THEN CASE WHEN met THEN 'requested_target_reached' ELSE 'actionable' END WHEN 'sufficient_at_requested_target' THEN CASE WHEN met THEN 'requested_target_reached' ELSE 'actionable' END
WHEN 'sufficient_at_medium_after_audit' THEN CASE WHEN medium THEN 'medium_audited_numeric_terminal' ELSE 'actionable' END WHEN 'exhausted_with_shortfall' THEN CASE WHEN exhausted THEN 'verified_exhausted_shortfall' ELSE 'actionable' END
WHEN 'retrieval_terminated_with_shortfall' THEN CASE WHEN restricted THEN 'retrieval_restricted_terminal' ELSE 'actionable' END WHEN 'other' THEN 'invalid' ELSE 'actionable' END AS lifecycle FROM u)
SELECT doc_id, lifecycle, lifecycle NOT IN ('actionable', 'invalid') AS terminal, CASE lifecycle WHEN 'requested_target_reached' THEN true WHEN 'medium_audited_numeric_terminal' THEN true WHEN 'retrieval_restricted_terminal' THEN numeric ELSE false END AS numeric,
lifecycle IN ('retrieval_restricted_terminal', 'verified_exhausted_shortfall') AS restricted FROM l"""
)
def dimension_lifecycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lifecycle of a dimension on every combination of status and verified facts."""
    n = F.col("n_chars")
    state = audits.lifecycle(_nth(STATUSES, F.col("doc_id") % 8), n % 2 == 0, n % 3 == 0, n % 5 < 2, n % 7 < 3, n % 11 < 5)
    return table(spark, sf_dir, "documents").select("doc_id", state.alias("x")).select("doc_id", "x.lifecycle", "x.terminal", "x.numeric", "x.restricted")


@query(
    """WITH u AS (SELECT doc_id, CAST(n_chars % 5 AS INTEGER) AS rank, n_chars % 3 = 0 AS audited, n_chars % 7 < 4 AS exhausted, n_chars % 40 AS scored, n_chars % 20 AS pages, n_chars % 6 AS categories, n_chars % 2 AS platforms FROM documents),
s AS (SELECT *, CASE WHEN rank >= 3 THEN 'sufficient' WHEN rank = 2 THEN CASE WHEN audited THEN 'sufficient_at_medium_after_audit' ELSE 'needs_iteration' END WHEN exhausted THEN 'exhausted_with_shortfall' ELSE 'needs_iteration' END AS status FROM u)
SELECT doc_id, CASE WHEN status = 'needs_iteration' AND doc_id % 2 = 0 THEN 'retrieval_terminated_with_shortfall' ELSE status END AS status,
CASE WHEN status = 'needs_iteration' AND doc_id % 2 = 0 THEN rank >= 2 AND scored >= 25 AND pages >= 12 AND categories >= 3 AND platforms >= 1 ELSE rank >= 2 END AS numeric FROM s"""
)
def dimension_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status ladder of a dimension, and its end when retrieval is stopped."""
    n = F.col("n_chars")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (n % 5).cast("int").alias("rank"), (n % 3 == 0).alias("audited"), (n % 7 < 4).alias("exhausted"), (n % 40).alias("scored"), (n % 20).alias("pages"), (n % 6).alias("categories"), (n % 2).alias("platforms")
    )
    told = docs.withColumn("status", audits.dimension_status(F.col("rank"), 3, F.col("audited"), F.col("exhausted"))).withColumn("numeric", F.col("rank") >= 2)
    return audits.restrict_unfinished(told, F.col("doc_id") % 2 == 0).select("doc_id", "status", "numeric")


@query(
    """WITH u AS (SELECT doc_id, n_chars % 11 = 0 AS err, n_chars % 13 = 0 AS bounded, ['target_met', 'all_dimensions_formally_terminal', 'evidence_shortfall'][n_chars % 3 + 1] AS t, n_chars % 17 < 3 AS pending, doc_id % 2 = 0 AS met, doc_id % 3 = 0 AS allowed, doc_id % 5 < 2 AS ex FROM documents),
k AS (SELECT doc_id, t, met, CASE WHEN err THEN 'invalid invalid' WHEN bounded THEN 'retrieval_terminated_with_shortfall ' || t WHEN pending THEN 'needs_iteration continue_dimension_deep_search'
WHEN t = 'all_dimensions_formally_terminal' AND met THEN 'valid all_dimensions_formally_terminal' WHEN t = 'all_dimensions_formally_terminal' THEN 'valid_with_sample_shortfall all_dimensions_formally_terminal'
WHEN met AND NOT ex THEN 'valid target_met' WHEN met THEN 'valid_with_dimension_shortfall dimension_exhausted_with_shortfall' WHEN NOT allowed THEN 'needs_iteration continue_deep_search'
WHEN NOT ex THEN 'valid_with_sample_shortfall exhausted_with_shortfall' ELSE 'valid_with_sample_and_dimension_shortfall sample_and_dimension_exhausted_with_shortfall' END AS said FROM u)
SELECT doc_id, split_part(said, ' ', 1) AS status, split_part(said, ' ', 2) AS outcome FROM k"""
)
def audit_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nine branches of the final audit's status."""
    n, i = F.col("n_chars"), F.col("doc_id")
    told = audits.audit_status(
        (n % 11 == 0).cast("int"), n % 13 == 0, _nth(("target_met", "all_dimensions_formally_terminal", "evidence_shortfall"), n % 3), (n % 17 < 3).cast("int"), i % 2 == 0, i % 3 == 0, (i % 5 < 2).cast("int")
    )
    return table(spark, sf_dir, "documents").select("doc_id", told.alias("x")).select("doc_id", "x.status", "x.outcome")


@query(
    UNITS
    + """, s AS (SELECT regexp_replace(url, '[?#].*$', '') AS entity, ['full', 'partial', 'blocked'][page_id % 3 + 1] AS access, 'c' || CAST(page_id % 16 AS VARCHAR) AS category, regexp_extract(url, '^[A-Za-z]+://([^/?#:]*)', 1) AS platform,
[CAST(2000 + page_id % 20 AS VARCHAR), '2024-0' || CAST(page_id % 9 + 1 AS VARCHAR), 'n.d.'][page_id % 3 + 1] AS published, page_id % 2 = 0 AS user_source FROM pages)
SELECT (SELECT count(DISTINCT entity) FROM s) AS pages, (SELECT count(DISTINCT entity) FROM s WHERE access <> 'blocked') AS readable_pages, (SELECT count(DISTINCT category) FROM s) AS categories, (SELECT count(DISTINCT category) FROM s WHERE access <> 'blocked') AS readable_categories,
(SELECT count(DISTINCT platform) FROM s WHERE access <> 'blocked' AND user_source) AS user_platforms, (SELECT string_agg(DISTINCT published[:4], ',' ORDER BY published[:4]) FROM s WHERE published <> 'n.d.') AS years,
(SELECT count(*) FROM (SELECT DISTINCT dim, form FROM eligible)) AS scored_units, (SELECT count(*) FROM eligible WHERE s > 0) AS positive, (SELECT count(*) FROM eligible WHERE s < 0) AS negative, (SELECT count(*) FROM eligible WHERE s = 0) AS neutral"""
)
def audit_key_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit's figures over sources and units."""
    i = F.col("page_id")
    found = table(spark, sf_dir, "pages").select(
        F.regexp_replace("url", "[?#].*$", "").alias("entity"), _nth(("full", "partial", "blocked"), i % 3).alias("access"), F.concat(F.lit("c"), (i % 16).cast("string")).alias("category"),
        F.regexp_extract("url", r"^[A-Za-z]+://([^/?#:]*)", 1).alias("platform"),
        F.get(F.array((2000 + i % 20).cast("string"), F.concat(F.lit("2024-0"), (i % 9 + 1).cast("string")), F.lit("n.d.")), (i % 3).cast("int")).alias("published"), (i % 2 == 0).alias("user_source"),
    )
    units = eligible(spark, sf_dir).select("dim", F.col("form").alias("key"), "s", F.lit(True).alias("scored"))
    return audits.key_figures(found, units).withColumn("years", F.array_join("years", ","))


@query(RUNS + "SELECT 'status' AS field, status AS value, count(*) AS n FROM runs GROUP BY 2 UNION ALL SELECT 'action', action, count(*) FROM runs GROUP BY 2 UNION ALL SELECT 'error', error, count(*) FROM runs GROUP BY 2 UNION ALL SELECT 'category', category, count(*) FROM runs GROUP BY 2 UNION ALL SELECT 'mode', mode, count(*) FROM runs GROUP BY 2")
def status_histograms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of each value of five status columns."""
    return audits.histograms(runs(spark, sf_dir), ["status", "action", "error", "category", "mode"])


@query(UNITS + ", c AS (SELECT dim, count(*) AS n FROM eligible GROUP BY dim) SELECT CASE WHEN min(n) >= 60 THEN 'high' WHEN min(n) >= 40 THEN 'medium_high' WHEN min(n) >= 25 THEN 'medium' ELSE 'low' END AS confidence FROM c")
def overall_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The least confidence of the dimensions."""
    n = F.col("n")
    counted = eligible(spark, sf_dir).groupBy("dim").agg(F.count("*").alias("n"))
    return audits.least_confidence(counted.withColumn("confidence", F.when(n >= 60, "high").when(n >= 40, "medium_high").when(n >= 25, "medium").otherwise("low")), "confidence")


@query(UNITS + "SELECT platform, dim, conversion / 10.0::DOUBLE - 5 AS tendency, weight * conversion AS contribution, round(conversion::DOUBLE, 1) AS shown FROM scored")
def displayed_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a report prints of each cell."""
    from quillspark.plans.scoring_queries import platform_dimension_tendency

    weight = F.get(F.array(*[F.lit(w) for w in (0.15, 0.15, 0.20, 0.15, 0.10, 0.15, 0.10)]), F.col("dim"))
    cells = platform_dimension_tendency(spark, sf_dir)
    shown = audits.displayed(((F.col("tendency") + 5) * 10).cast("double"), weight)
    return cells.select("platform", "dim", shown.alias("x")).select("platform", "dim", "x.tendency", "x.contribution", "x.shown")


@query(
    RUNS
    + """, c AS (SELECT execution_id, status, action, error, CASE status WHEN 'completed' THEN ['continue', 'exhausted', 'not_applicable', 'target_met'] WHEN 'partial' THEN ['continue', 'retry', 'exhausted'] WHEN 'blocked' THEN ['continue', 'exhausted', 'not_applicable']
WHEN 'no_results' THEN ['continue', 'exhausted', 'not_applicable', 'target_met'] ELSE ['continue', 'retry', 'exhausted', 'not_applicable'] END AS ok, opened, relevant_pages AS rel, duplicates AS dup, returned AS ret,
status IN ('failed', 'partial') AND action NOT IN ('exhausted', 'target_met', 'not_applicable') AND error <> 'parse_error' AND user_id % 4 <> 0 AS again FROM runs)
SELECT execution_id, again AS retryable, status <> 'failed' AS coverage, concat_ws(',', CASE WHEN NOT list_contains(ok, action) THEN 'execution_status_action_conflict' END, CASE WHEN action = 'retry' AND NOT again THEN 'execution_retry_precondition_invalid' END,
CASE WHEN rel > 0 AND status IN ('no_results', 'failed') THEN 'execution_status_cannot_produce_sources' END, CASE WHEN dup > opened THEN 'execution_duplicate_pages_exceed_opened' END, CASE WHEN rel > opened THEN 'execution_relevant_pages_exceed_opened' END,
CASE WHEN status = 'no_results' AND opened + rel + dup + ret > 0 THEN 'execution_no_results_has_output' END, CASE WHEN status = 'failed' AND opened + rel + dup > 0 THEN 'execution_failed_has_pages' END) AS codes FROM c"""
)
def outcome_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Executions against the matrix of statuses, actions, sources and counts."""
    log = runs(spark, sf_dir)
    again = contracts.retryable(F.col("status"), F.col("action"), F.col("error"), F.col("user_id") % 4 == 0)
    counts = {"opened": F.col("opened"), "relevant": F.col("relevant_pages"), "duplicate": F.col("duplicates"), "returned": F.col("returned")}
    codes = contracts.outcome_reasons(F.col("status"), F.col("action"), F.col("relevant_pages"), again, counts)
    return log.select("execution_id", again.alias("retryable"), contracts.coverage(F.col("status")).alias("coverage"), F.array_join(codes, ",").alias("codes"))


BLOCK_TYPES = ("page_body", "official_fact", "user_review", "comment", "metadata", "banner")
UNIT_TYPES = ("user_review", "official_fact", "page_body", "source_native_numeric")


@query(
    """WITH u AS (SELECT doc_id, ['page_body', 'official_fact', 'user_review', 'comment', 'metadata', 'banner'][n_chars % 6 + 1] AS b, CASE doc_id % 3 WHEN 0 THEN true WHEN 1 THEN false END AS g, ['user_review', 'official_fact', 'page_body', 'source_native_numeric'][doc_id % 4 + 1] AS unit,
['user_review', 'official_fact', 'page_body', 'rating_only'][n_chars % 4 + 1] AS layer FROM documents)
SELECT doc_id, CASE WHEN b = 'banner' THEN 'invalid_block_type' WHEN g IS NULL THEN 'block_user_status_must_be_boolean' WHEN b IN ('user_review', 'comment') AND NOT g OR b IN ('official_fact', 'metadata') AND g THEN 'block_type_user_status_conflict' ELSE '' END AS block_codes,
CASE unit WHEN 'source_native_numeric' THEN concat_ws(',', CASE WHEN layer <> 'rating_only' THEN 'native_numeric_content_layer_conflict' END, 'native_numeric_locator_conflict')
WHEN 'user_review' THEN concat_ws(',', CASE WHEN layer <> unit THEN 'unit_content_layer_conflict' END, CASE WHEN b <> unit THEN 'unit_block_type_conflict' END, CASE WHEN g IS NOT TRUE THEN 'user_block_locator_required' END)
WHEN 'official_fact' THEN concat_ws(',', CASE WHEN layer <> unit THEN 'unit_content_layer_conflict' END, CASE WHEN layer <> unit OR b <> unit THEN 'official_fact_content_identity_conflict' END, CASE WHEN g IS NOT FALSE THEN 'official_fact_user_status_conflict' END, 'official_fact_not_formally_scorable')
ELSE concat_ws(',', CASE WHEN layer <> unit OR b <> unit THEN 'page_body_content_identity_conflict' END, CASE WHEN g IS NOT TRUE THEN 'page_body_lacks_user_origin' END) END AS unit_codes FROM u"""
)
def block_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf blocks and the units that name them against the matrix of types, origin and layers."""
    n, i = F.col("n_chars"), F.col("doc_id")
    block, by_user = _nth(BLOCK_TYPES, n % 6), F.when(i % 3 == 0, True).when(i % 3 == 1, False)
    layer = _nth(("user_review", "official_fact", "page_body", "rating_only"), n % 4)
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.array_join(contracts.block_reasons(block, by_user), ",").alias("block_codes"), F.array_join(contracts.unit_reasons(_nth(UNIT_TYPES, i % 4), layer, block, by_user, scoring=True), ",").alias("unit_codes")
    )


@query(
    """WITH p AS (SELECT page_id, ['大众点评', '小红书', 'other'][page_id % 3 + 1] AS platform, ['dianping.com', 'm.xiaohongshu.com', 'notdianping.com', 'example.org'][page_id % 4 + 1] AS domain FROM pages)
SELECT page_id, platform <> 'other' OR domain IN ('dianping.com', 'm.xiaohongshu.com') AS excluded FROM p"""
)
def default_exclusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources left out by default, by platform or parent domain."""
    i = F.col("page_id")
    out = contracts.default_excluded(_nth(("大众点评", "小红书", "other"), i % 3), _nth(("dianping.com", "m.xiaohongshu.com", "notdianping.com", "example.org"), i % 4))
    return table(spark, sf_dir, "pages").select("page_id", out.alias("excluded"))


@query(UNITS + "SELECT doc_id, dim, s FROM units WHERE quality = 1 AND toxic = 0 AND dim BETWEEN 0 AND 6")
def research_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units that are valid, direct and of a known dimension (F2)."""
    from quillspark.plans.scoring_queries import units

    return units(spark, sf_dir).where("quality = 1 and toxic = 0 and dim between 0 and 6").select("doc_id", "dim", "s")


# links


@query(
    RUNS
    + """, plan AS (SELECT intent, user_id, CASE WHEN intent % 10 = 0 THEN 'c0' ELSE min(category) END AS category, min(mode) AS mode FROM runs WHERE intent % 7 <> 0 GROUP BY intent, user_id)
SELECT r.execution_id, CASE WHEN p.intent IS NULL THEN 'query_plan_unregistered_or_query_missing' ELSE concat_ws(',', CASE WHEN r.category <> p.category THEN 'query_plan_execution_mismatch:category' END, CASE WHEN r.mode <> p.mode THEN 'query_plan_execution_mismatch:mode' END) END AS codes
FROM runs r LEFT JOIN plan p ON p.intent = r.intent AND p.user_id = r.user_id"""
)
def plan_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Executions against the registered plan."""
    log = runs(spark, sf_dir)
    plan = log.where("intent % 7 <> 0").groupBy("intent", "user_id").agg(F.min("category").alias("category"), F.min("mode").alias("mode"))
    plan = plan.withColumn("category", F.when(F.col("intent") % 10 == 0, "c0").otherwise(F.col("category")))
    return links.against_plan(log, plan, ["intent", "user_id"], ["category", "mode"]).select("execution_id", F.array_join("codes", ",").alias("codes"))


@query(
    RUNS
    + """, found AS (SELECT s.*, CASE WHEN source_id % 11 <> 0 THEN r.ts + CAST(source_id % 50 AS INTEGER) * INTERVAL 1 MINUTE END AS t FROM sources s LEFT JOIN runs r ON r.execution_id = s.execution_id)
SELECT source_id, CASE WHEN r.execution_id IS NULL THEN 'source_execution_missing_or_invalid' ELSE concat_ws(',', CASE WHEN t IS NULL THEN 'source_retrieved_time_invalid' END, CASE WHEN t NOT BETWEEN r.ts AND r.end_ts THEN 'source_outside_execution_window' END,
CASE WHEN found.category <> r.category THEN 'source_execution_mismatch:category' END) END AS codes FROM found LEFT JOIN runs r ON r.execution_id = found.execution_id AND r.status <> 'failed'"""
)
def execution_window_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources against the executions that they name: fields, and the time within its window."""
    log = runs(spark, sf_dir)
    times = log.select("execution_id", "ts")
    minutes = (F.col("source_id") % 50).cast("int")
    found = sources(spark, sf_dir).join(times, "execution_id", "left").withColumn("retrieved_at", F.when(F.col("source_id") % 11 != 0, F.col("ts") + F.make_dt_interval(mins=minutes)))
    known = log.where("status <> 'failed'").select("execution_id", F.col("ts").alias("started_at"), F.col("end_ts").alias("finished_at"), "category")
    return links.against_execution(found, known, ["category"]).select("source_id", F.array_join("codes", ",").alias("codes"))


@query(RUNS + ", u AS (SELECT doc_id // 4 AS source_id, count(*) AS n FROM documents GROUP BY 1), x AS (SELECT s.execution_id, sum(n) AS n FROM sources s JOIN u USING (source_id) GROUP BY 1) SELECT r.execution_id, CAST(coalesce(n, 0) AS BIGINT) AS n FROM runs r LEFT JOIN x USING (execution_id)")
def attributed_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units by the execution of their source."""
    units = table(spark, sf_dir, "documents").select(F.floor(F.col("doc_id") / 4).alias("source_id"))
    return links.attributed(units, sources(spark, sf_dir), runs(spark, sf_dir))


@query(
    RUNS
    + """, c AS (SELECT execution_id * 3 // 9 * 3 AS e, count(DISTINCT url) AS p, count(DISTINCT url) FILTER (relevant) AS k FROM sources GROUP BY 1)
SELECT execution_id, coalesce(p, 0) AS pages, coalesce(k, 0) AS relevant, concat_ws(',', CASE WHEN coalesce(p, 0) > opened THEN 'source_pages_exceed_execution_opened' END, CASE WHEN coalesce(k, 0) > relevant_pages THEN 'source_relevant_pages_exceed_execution_relevant' END) AS codes
FROM runs LEFT JOIN c ON e = execution_id"""
)
def page_count_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct pages of each execution against what it opened."""
    found = sources(spark, sf_dir).withColumn("execution_id", F.floor(F.col("execution_id") / 3) * 3)
    return links.page_counts(runs(spark, sf_dir), found).withColumn("codes", F.array_join("codes", ","))


@query(
    """WITH c AS (SELECT page_id AS capture_id, sha256(html) AS h FROM pages WHERE page_id % 9 <> 0), d AS (SELECT page_id, CASE WHEN page_id % 13 = 0 THEN sha256('') ELSE sha256(html) END AS h FROM pages)
SELECT page_id AS source_id, CASE WHEN c.h IS NULL THEN 'capture_not_found' WHEN c.h <> d.h THEN 'capture_text_mismatch' ELSE '' END AS codes FROM d LEFT JOIN c ON capture_id = page_id"""
)
def capture_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate sources against captures."""
    pages = table(spark, sf_dir, "pages").select("page_id", F.sha2("html", 256).alias("body_sha256"))
    candidates = pages.select(F.col("page_id").alias("source_id"), F.col("page_id").alias("capture_id"), F.when(F.col("page_id") % 13 == 0, F.sha2(F.lit(""), 256)).otherwise(F.col("body_sha256")).alias("body_sha256"))
    captures = pages.where("page_id % 9 <> 0").select(F.col("page_id").alias("capture_id"), "body_sha256")
    return links.captured(candidates, captures).select("source_id", F.array_join("codes", ",").alias("codes"))


@query("SELECT doc_id FROM documents WHERE doc_id // 4 IN (SELECT page_id FROM pages WHERE page_id % 3 <> 0)")
def active_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units whose source is active."""
    units = table(spark, sf_dir, "documents").select("doc_id", F.floor(F.col("doc_id") / 4).alias("source_id"))
    return links.active(units, table(spark, sf_dir, "pages").where("page_id % 3 <> 0").select(F.col("page_id").alias("source_id"))).select("doc_id")


@query(
    """SELECT doc_id + CASE WHEN doc_id % 19 = 0 THEN 1000000 ELSE 0 END AS doc_id, concat_ws(',', CASE WHEN doc_id % 19 = 0 THEN 'raw_record_missing' END, CASE WHEN doc_id % 19 <> 0 AND doc_id % 5 = 0 AND text <> trim(text) || '.' THEN 'field_changed:text' END,
CASE WHEN doc_id % 19 <> 0 AND doc_id % 7 = 0 AND lang <> 'en' THEN 'field_changed:lang' END) AS codes FROM documents WHERE doc_id % 19 = 0 OR doc_id % 5 = 0 AND text <> trim(text) || '.' OR doc_id % 7 = 0 AND lang <> 'en'"""
)
def immutable_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units of a later ledger that changed a field of the raw one, or are missing there."""
    i = F.col("doc_id")
    raw = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    later = raw.select(
        F.when(i % 19 == 0, i + 1000000).otherwise(i).alias("doc_id"), F.when(i % 5 == 0, F.concat(F.trim("text"), F.lit("."))).otherwise(F.col("text")).alias("text"), F.when(i % 7 == 0, "en").otherwise(F.col("lang")).alias("lang")
    )
    return links.changed_fields(later, raw, "doc_id", ["text", "lang"]).withColumn("codes", F.array_join("codes", ","))


def _binding(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledgers = {"documents": (table(spark, sf_dir, "documents"), ["doc_id", "text"]), "pages": (table(spark, sf_dir, "pages"), ["page_id", "url"]), "labels": (table(spark, sf_dir, "labels"), ["doc_id", "quality", "toxic"])}
    return links.bound(ledgers)


BINDING = """WITH rows AS (SELECT 'documents' AS ledger, sha256(CAST(doc_id AS VARCHAR) || chr(31) || coalesce(text, chr(0))) AS row FROM documents UNION ALL SELECT 'pages', sha256(CAST(page_id AS VARCHAR) || chr(31) || coalesce(url, chr(0))) FROM pages
UNION ALL SELECT 'labels', sha256(CAST(doc_id AS VARCHAR) || chr(31) || CAST(quality AS VARCHAR) || chr(31) || CAST(toxic AS VARCHAR)) FROM labels),
parts AS (SELECT ledger, row[:3] AS bucket, sha256(string_agg(row, '' ORDER BY row)) AS part, count(*) AS n FROM rows GROUP BY 1, 2), bound AS (SELECT ledger, sha256(string_agg(part, '' ORDER BY bucket)) AS recordset, CAST(sum(n) AS BIGINT) AS n FROM parts GROUP BY 1)
"""


@query(BINDING + "SELECT sha256(string_agg(ledger || ':' || recordset || ':' || CAST(n AS VARCHAR), chr(10) ORDER BY ledger) || chr(10) || 'audit') AS seal FROM bound")
def ledger_seal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One hash that binds an audit to its three ledgers, whatever the order of their rows."""
    return links.seal(_binding(spark, sf_dir), F.lit("audit"))


@query("SELECT unnest(['documents', 'labels', 'pages']) AS ledger, unnest([false, true, true]) AS same")
def broken_bindings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which ledgers are no longer those that were bound: a document was edited."""
    now = _binding(spark, sf_dir)
    edited = table(spark, sf_dir, "documents").withColumn("text", F.concat("text", F.lit(" ")))
    changed = links.bound({"documents": (edited, ["doc_id", "text"])}).unionByName(now.where("ledger <> 'documents'"))
    return links.broken_bindings(now, changed)


@query(
    RUNS
    + """SELECT execution_id, sha256('{"decision":"' || action || '","execution_id":"' || CAST(execution_id AS VARCHAR) || '","mode":"' || mode || '","round":"' || CAST(round AS VARCHAR) || '","status":"' || status || '"}') AS fingerprint FROM runs"""
)
def decision_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hash of what each next action was decided from."""
    return links.fingerprint(runs(spark, sf_dir), "action", ["execution_id", "mode", "round", "status"]).select("execution_id", "fingerprint")


@query(
    RUNS
    + """, f AS (SELECT execution_id, 'topic ' || CAST(intent AS VARCHAR) || ' ' || polarity || '|category=' || category || '|language=zh' AS intent_key, * EXCLUDE (execution_id) FROM runs)
SELECT execution_id, intent_key, 'ROUTE-' || sha256('{"access_policy":"public_only_no_access_barrier_bypass","gap_target":"g' || CAST(subject AS VARCHAR) || '","iteration_mode":"' || mode || '","normalized_query_intent":"' || intent_key || '","place_identity_sha256":"","polarity":"' || polarity
|| '","query_dimension_targets":"' || array_to_string(list_sort(dims), ';') || '","retrieval_entry":"web","source_category_target":"' || category || '","target_platform_id":"","target_subject":"' || CAST(subject AS VARCHAR) || '","target_time_range":"' || CAST(time AS VARCHAR) || '","task_run_id":"run"}') AS route FROM f"""
)
def route_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query intents with their facets, and the routes they belong to."""
    text = F.concat(F.lit("  Ｔopic: "), F.col("intent").cast("string"), F.lit(" 查询, "), F.upper("polarity"), F.lit(" !"))
    key = links.intent(text, {"category": F.col("category"), "language": F.lit("ZH ")})
    fields = {
        "task_run_id": F.lit("run"), "place_identity_sha256": F.lit(None), "retrieval_entry": F.lit("web"), "target_platform_id": F.lit(None), "source_category_target": F.col("category"), "iteration_mode": F.col("mode"),
        "gap_target": F.concat(F.lit("g"), F.col("subject").cast("string")), "target_time_range": F.col("time"), "target_subject": F.col("subject"), "polarity": F.col("polarity"), "query_dimension_targets": F.array_join(F.transform(F.array_sort("dims"), lambda d: d.cast("string")), ";"),
    }
    return runs(spark, sf_dir).select("*", key.alias("intent_key")).select("execution_id", "intent_key", links.route_id(fields, F.col("intent_key")).alias("route"))


@query(RUNS + ", m AS (SELECT round AS r, max(end_ts) AS e FROM runs GROUP BY 1) SELECT execution_id, coalesce(ts < (SELECT max(e) FROM m WHERE r < round), false) AS early FROM runs")
def round_barrier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Executions that began before all of the earlier rounds had ended."""
    return links.barrier(runs(spark, sf_dir)).select("execution_id", "early")


@query(
    RUNS
    + ", f AS (SELECT category, domain, min(source_id) AS o FROM sources GROUP BY 1, 2) SELECT category, domain, place FROM (SELECT *, CAST(row_number() OVER (PARTITION BY category ORDER BY o, domain) AS INTEGER) AS place FROM f) WHERE place <= 5"
)
def first_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five distinct domains of each category."""
    return links.first_distinct(sources(spark, sf_dir), "category", "domain", "source_id")


@query(RUNS + "SELECT source_id, CAST(row_number() OVER (PARTITION BY domain ORDER BY source_id) AS INTEGER) AS version FROM sources")
def capture_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number of each capture of its domain."""
    return links.versions(sources(spark, sf_dir), "domain", "source_id").select("source_id", "version")


@query("SELECT row_number() OVER (ORDER BY lang, h) AS place, h AS row_sha256 FROM (SELECT lang, sha256(lang || chr(31) || CAST(doc_id AS VARCHAR)) AS h FROM documents) QUALIFY place <= 20")
def deterministic_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 20 rows by language and row hash: a top-k report (O3)."""
    listed = links.ordered(table(spark, sf_dir, "documents").select("lang", "doc_id"), "lang", ["lang", "doc_id"]).limit(20)
    return listed.select(F.row_number().over(Window.orderBy("lang", "row_sha256")).cast("long").alias("place"), "row_sha256")


@query(
    "WITH u AS (SELECT 'document' AS kind, doc_id AS id, lang, NULL AS url FROM documents UNION ALL SELECT 'page', page_id, NULL, url FROM pages) SELECT kind, count(*) AS n, count(lang) AS with_lang, count(url) AS with_url FROM u GROUP BY kind"
)
def united_ledgers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledgers with different columns as one."""
    docs = table(spark, sf_dir, "documents").select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), "lang")
    pages = table(spark, sf_dir, "pages").select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), "url")
    return links.united(docs, pages).groupBy("kind").agg(F.count("*").alias("n"), F.count("lang").alias("with_lang"), F.count("url").alias("with_url"))


# costs


@query(
    """WITH e AS (SELECT DISTINCT event_id // 2 AS id, CAST(event_id // 2 % 50 AS BIGINT) AS bytes, CASE WHEN event_type = 'none' THEN 1 END AS tokens FROM events), t AS (SELECT CAST(sum(bytes) AS BIGINT) AS bytes, count(*) AS calls, CAST(sum(tokens) AS BIGINT) AS tokens FROM (SELECT id, max(bytes) AS bytes, max(tokens) AS tokens FROM e GROUP BY id))
SELECT bytes, CAST(calls AS BIGINT) AS calls, tokens, bytes / calls::DOUBLE AS bytes_a_call, NULL::DOUBLE AS tokens_a_call FROM t"""
)
def cost_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums over idempotent events; tokens were never observed."""
    i = F.floor(F.col("event_id") / 2)
    events = table(spark, sf_dir, "events").select(i.alias("event_id"), (i % 50).alias("bytes"), F.lit(1).cast("long").alias("calls"), F.when(F.col("event_type") == "none", 1).cast("long").alias("tokens"))
    return costs.totals(events, ["bytes", "calls", "tokens"]).select("*", costs.ratio(F.col("bytes"), F.col("calls")).alias("bytes_a_call"), costs.ratio(F.col("tokens"), F.col("calls")).cast("double").alias("tokens_a_call"))


@query(
    """WITH h AS (SELECT event_type AS metric, count(*) FILTER (day(ts) <= 15)::DOUBLE AS a, count(*) FILTER (day(ts) > 15 OR event_type < 'd')::DOUBLE AS b FROM events GROUP BY 1)
SELECT metric, a AS baseline, b AS current, b / a - 1 AS growth FROM h WHERE a > 0 AND b > a * 1.15"""
)
def cost_regressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics that grew by more than 15 %."""
    events = table(spark, sf_dir, "events")
    late = events.where((F.dayofmonth("ts") > 15) | (F.col("event_type") < "d"))
    old, new = (x.groupBy(F.col("event_type").alias("metric")).agg(F.count("*").alias("value")) for x in (events.where(F.dayofmonth("ts") <= 15), late))
    return costs.regressions(old, new)


@query(
    """WITH u AS (SELECT source, count(DISTINCT doc_id // 4) AS pages, count(*) FILTER (quality = 1) AS eligible, count(*) FILTER (quality = 1 AND toxic = 0) AS scored FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source),
n AS (SELECT *, CASE WHEN scored > 0 THEN CAST(ceil(greatest(0, 60 - scored) / (scored / pages::DOUBLE)) AS BIGINT) END AS need FROM u)
SELECT source, scored / pages::DOUBLE AS scored_rate, eligible / pages::DOUBLE AS eligible_rate, need AS pages_needed, CASE WHEN need > 120 THEN 'estimated_budget_shortfall' WHEN scored = 0 THEN 'zero_observed_yield' ELSE 'within_estimated_budget' END AS forecast FROM n"""
)
def yield_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversion of pages to units of each source, and the pages still needed."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.floor(F.col("doc_id") / 4).alias("page")).join(table(spark, sf_dir, "labels"), "doc_id", "left")
    sums = docs.groupBy("source").agg(F.count_distinct("page").alias("pages"), F.count_if(F.col("quality") == 1).alias("eligible"), F.count_if((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("scored"))
    told = costs.yields(F.col("pages"), F.col("eligible"), F.col("scored"), F.lit(60), F.lit(120))
    return sums.select("source", told.alias("x")).select("source", "x.*")


def _errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = runs(spark, sf_dir).where("status = 'failed'")
    return log.select(
        F.col("error").alias("code"), "category", F.col("mode").alias("subsystem"), _nth(("capture", "report", "semantic"), F.col("subject") % 3).alias("origin"), F.array(F.concat(F.lit("ledger-"), F.col("category"))).alias("artifacts"),
        _nth(("generator_code", "office_rebuild", "source"), F.col("time") % 3).alias("scope"), (F.col("subject") % 3 == 1).alias("upstream_valid"), F.lit(False).alias("new_run"),
    )


@query(
    RUNS
    + """, e AS (SELECT ['capture', 'report', 'semantic'][subject % 3 + 1] AS origin, 'VAL-' || sha256('run|' || error || '|' || mode || '|' || ['capture', 'report', 'semantic'][subject % 3 + 1] || '|ledger-' || category)[:16] AS id FROM runs WHERE status = 'failed'),
d AS (SELECT origin, id, count(*) AS n FROM e GROUP BY ALL) SELECT origin, CAST(sum(n) AS BIGINT) AS errors, count(*) AS kinds, sha256(string_agg(id, ',' ORDER BY id)) AS ids_sha256 FROM d GROUP BY origin"""
)
def error_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stable ids of faults by the layer where they began."""
    return costs.root_causes(costs.manifest(_errors(spark, sf_dir), "run"))


@query(
    """SELECT unnest(['all', 'none', 'report', 'source']) AS kind, unnest(['terminal_root_cause_requires_new_run', 'no_repair_needed', 'one_downstream_rebuild_permitted', 'manual_code_fix_required']) AS status, unnest([false, false, true, false]) AS automatic,
unnest(['start_new_independent_run_after_root_cause_fix', 'none', 'rebuild_from_frozen_scoring_output', 'repair_released_validator_or_generator_then_rerun_validation']) AS next_action"""
)
def repair_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What may be done about all errors, none, those of the report, and those with a source scope."""
    errors = _errors(spark, sf_dir)
    report = errors.where("origin = 'report'")
    kinds = {"all": errors, "none": errors.where("false"), "report": report.where("scope <> 'source'"), "source": report}
    return links.united(*[costs.repair_plan(e).withColumn("kind", F.lit(k)) for k, e in kinds.items()])
