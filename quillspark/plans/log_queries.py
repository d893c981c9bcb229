"""Execution-log queries over events: user_id is the chain, event_type the status, value the gain, the day the round."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.operators import chains, execution, identity
from quillspark.plans.registry import query
from quillspark.session import table


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Executions; each run of three events of a user and type is a chain of retries."""
    events = table(spark, sf_dir, "events")
    nth = F.row_number().over(Window.partitionBy("user_id", "event_type").orderBy("ts", "event_id"))
    return events.withColumn("nth", nth).select(
        F.col("event_id").alias("execution_id"),
        "user_id",
        F.concat_ws(":", "user_id", "event_type", F.floor((F.col("nth") - 1) / 3)).alias("chain"),
        F.when(F.col("event_id") % 11 == 0, F.lit(1).cast("long")).otherwise((F.col("nth") - 1) % 3).cast("long").alias("retry_number"),
        "ts",
        (F.col("ts") + F.expr("interval 30 minutes")).alias("end_ts"),
        F.col("event_type").alias("status"),
        F.col("value").alias("gain"),
        F.dayofmonth("ts").alias("round"),
        F.get_json_object("props", "$.k").cast("long").alias("intent"),
    )


LOG = """
WITH n AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS nth FROM events),
log AS (SELECT event_id AS execution_id, user_id, user_id || ':' || event_type || ':' || CAST((nth - 1) // 3 AS VARCHAR) AS chain,
  CASE WHEN event_id % 11 = 0 THEN 1 ELSE (nth - 1) % 3 END AS retry_number, ts, ts + INTERVAL 30 MINUTE AS end_ts, event_type AS status, value AS gain,
  CAST(day(ts) AS INTEGER) AS round, CAST(json_extract_string(props, '$.k') AS BIGINT) AS intent FROM n)
"""


@query(
    LOG
    + """, a AS (SELECT *, row_number() OVER (PARTITION BY chain ORDER BY retry_number, ts, execution_id) - 1 AS expected, lag(end_ts) OVER (PARTITION BY chain ORDER BY retry_number, ts, execution_id) AS pe,
count(*) OVER (PARTITION BY chain, retry_number) AS same FROM log),
b AS (SELECT execution_id, chain, concat_ws(',', CASE WHEN retry_number <> expected THEN 'number_gap' END, CASE WHEN retry_number > 1 THEN 'too_many_retries' END, CASE WHEN ts < pe THEN 'overlaps_previous' END, CASE WHEN same > 1 THEN 'duplicate_number' END) AS codes FROM a)
SELECT execution_id, codes, NOT bool_or(codes <> '') OVER (PARTITION BY chain) AS chain_valid FROM b"""
)
def retry_chain_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    audited = execution.retry_audit(log(spark, sf_dir))
    return audited.select("execution_id", F.array_join("codes", ",").alias("codes"), "chain_valid")


@query(LOG + ", f AS (SELECT *, row_number() OVER (PARTITION BY intent ORDER BY ts, execution_id) = 1 AS is_new FROM log) SELECT round, count(*) AS attempts, count(CASE WHEN is_new THEN 1 END) AS new_intents FROM f GROUP BY round")
def new_intents_by_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    return execution.new_intents(log(spark, sf_dir)).groupBy("round").agg(F.count("*").alias("attempts"), F.count_if("is_new").alias("new_intents"))


@query(LOG + "SELECT execution_id, CAST(sum(CAST(gain AS DECIMAL(18,2))) OVER (PARTITION BY user_id ORDER BY ts, execution_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running FROM log")
def running_scored_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = log(spark, sf_dir).withColumn("gain", F.col("gain").cast("decimal(18,2)"))
    return execution.running_total(rows, "gain", ["user_id"]).select("execution_id", F.col("running").cast("double").alias("running"))


@query(
    LOG
    + """, r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, execution_id DESC) AS back FROM log QUALIFY back <= 2)
SELECT user_id, arg_min(status, back) AS status, max(ts) AS ts, count(*) = 2 AND bool_and(status IN ('error', 'signup')) AS terminal FROM r GROUP BY user_id"""
)
def latest_route_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return execution.latest_state(log(spark, sf_dir), "user_id", ("error", "signup"))


@query(
    LOG
    + """, g AS (SELECT user_id, round, sum(CAST(gain AS DECIMAL(18,2)))::DOUBLE AS gain FROM log GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round DESC) AS back FROM g QUALIFY back <= 3)
SELECT user_id, count(*) = 3 AND bool_and(gain < 40.0) AS low FROM r GROUP BY user_id"""
)
def low_yield_last_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rounds = log(spark, sf_dir).groupBy("user_id", "round").agg(F.sum(F.col("gain").cast("decimal(18,2)")).cast("double").alias("gain"))
    return execution.low_yield(rounds, ["user_id"], 3, 40.0)


@query(
    LOG
    + """, m AS (SELECT user_id, max(round) AS most FROM log GROUP BY user_id), s AS (SELECT user_id, unnest(generate_series(1, most))::BIGINT AS round FROM m)
SELECT user_id, round FROM s WHERE (user_id, round) NOT IN (SELECT (user_id, round::BIGINT) FROM log)"""
)
def missing_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return execution.missing_numbers(log(spark, sf_dir), ["user_id"], "round")


@query(
    LOG
    + """SELECT status, round, count(*) AS attempts, count(CASE WHEN retry_number > 0 THEN 1 END) AS retries, count(DISTINCT intent) AS intents, grouping(status, round)::BIGINT AS grain
FROM log GROUP BY GROUPING SETS ((status), (round), (status, round), ())"""
)
def query_metrics_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return execution.metrics(log(spark, sf_dir), "status", "round")


@query(
    LOG
    + """, m AS (SELECT round, count(*) AS attempts, count(CASE WHEN retry_number > 0 THEN 1 END) AS retries, count(DISTINCT intent) AS intents FROM log GROUP BY round),
u AS (UNPIVOT m ON attempts, retries, intents INTO NAME counter VALUE actual), l(counter, most) AS (VALUES ('attempts', 300::BIGINT), ('retries', 200), ('intents', 60))
SELECT round, counter, actual, most FROM u JOIN l USING (counter) WHERE actual > most"""
)
def budget_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = log(spark, sf_dir).groupBy("round").agg(F.count("*").alias("attempts"), F.count_if(F.col("retry_number") > 0).alias("retries"), F.count_distinct("intent").alias("intents"))
    limits = spark.createDataFrame([("attempts", 300), ("retries", 200), ("intents", 60)], "counter string, most long")
    return execution.over_budget(measured, limits, ["round"], ["attempts", "retries", "intents"])


@query(
    """WITH u AS (SELECT lang AS platform, CAST(doc_id % 7 AS INTEGER) AS dim, n_chars FROM documents), c AS (SELECT platform, dim, count(*) AS n, avg(CASE WHEN n_chars > 1000 THEN 1.0 ELSE 0.0 END) AS r FROM u GROUP BY ALL),
g AS (SELECT p.platform, d.dim, CAST(greatest(0, 60 - coalesce(n, 0)) AS BIGINT) AS gap, coalesce(r, 0) AS r FROM (SELECT DISTINCT platform FROM u) p CROSS JOIN (SELECT unnest(generate_series(0, 6))::INTEGER AS dim) d LEFT JOIN c USING (platform, dim))
SELECT platform, dim, gap = 0 AS met, gap, round((60 - gap + 1) / 60.0::DOUBLE + r, 6) AS gain FROM g"""
)
def gap_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = table(spark, sf_dir, "documents").select(F.col("lang").alias("platform"), (F.col("doc_id") % 7).cast("int").alias("dim"), "n_chars")
    scored = units.groupBy("platform", "dim").agg(F.count("*").alias("n"))
    success = units.groupBy("platform", "dim").agg(F.avg(F.when(F.col("n_chars") > 1000, 1.0).otherwise(0.0)).alias("success_rate"))
    dims = spark.range(7).select(F.col("id").cast("int").alias("dim"))
    return execution.gap_matrix(scored, units.select("platform").distinct(), dims, success, 60)


@query(
    LOG
    + """, u AS (SELECT user_id, count(*) AS attempts, max(round) AS rounds, count(DISTINCT intent) AS intents, max_by(status, ts) AS last, sum(CAST(gain AS DECIMAL(18,2)))::DOUBLE AS gain FROM log GROUP BY user_id),
o AS (SELECT user_id, CASE WHEN attempts > 85 THEN 1 WHEN gain > 3000 THEN 2 WHEN intents >= 50 THEN 3 WHEN intents >= 48 AND last = 'view' THEN 4 WHEN intents >= 48 THEN 5 WHEN rounds < 28 THEN 6 WHEN attempts >= 76 THEN 7
WHEN rounds = 28 THEN 8 WHEN attempts >= 70 THEN 9 WHEN last = 'error' THEN 10 WHEN last = 'signup' THEN 11 ELSE 12 END AS k FROM u)
SELECT user_id, ['unrecoverable_error', 'retrieval_control_invalid', 'target_met', 'dimension_exhausted_with_shortfall', 'all_dimensions_formally_terminal', 'round_sequence_incomplete', 'query_budget_reached_without_dimension_exhaustion',
'round_budget_reached_without_dimension_exhaustion', 'dimension_query_budgets_reached_without_exhaustion', 'source_blocked_pending_dimension_audit', 'route_exhausted_pending_dimension_audit', 'evidence_shortfall'][k] AS outcome, k IN (1, 3, 4, 5) AS terminal FROM o"""
)
def termination_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twelve outcomes of a user's retrieval, on facts from its log."""
    sums = log(spark, sf_dir).groupBy("user_id").agg(
        F.count("*").alias("attempts"), F.max("round").alias("rounds"), F.count_distinct("intent").alias("intents"), F.max_by("status", "ts").alias("last"), F.sum(F.col("gain").cast("decimal(18,2)")).cast("double").alias("gain")
    )
    formal = F.col("intents") >= 48
    facts = {
        "unrecoverable_error": F.col("attempts") > 85,
        "retrieval_control_invalid": F.col("gain") > 3000,
        "target_met": F.col("intents") >= 50,
        "dimension_exhausted_with_shortfall": formal & (F.col("last") == "view"),
        "all_dimensions_formally_terminal": formal,
        "round_sequence_incomplete": F.col("rounds") < 28,
        "query_budget_reached_without_dimension_exhaustion": F.col("attempts") >= 76,
        "round_budget_reached_without_dimension_exhaustion": F.col("rounds") == 28,
        "dimension_query_budgets_reached_without_exhaustion": F.col("attempts") >= 70,
        "source_blocked_pending_dimension_audit": F.col("last") == "error",
        "route_exhausted_pending_dimension_audit": F.col("last") == "signup",
    }
    return sums.select("user_id", execution.termination(facts).alias("t")).select("user_id", "t.outcome", "t.terminal")


#: Events of each user as a chain: the digest of an event's columns, and the hash that carries all before it on.
CHAIN = """WITH RECURSIVE o AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq, sha256(strlen(event_id::VARCHAR) || ':' || event_id || coalesce(strlen(event_type) || ':' || event_type, '-') || coalesce(strlen(props) || ':' || props, '-')) AS own FROM events),
c AS (SELECT event_id, user_id, event_type, props, value, seq, own, '' AS previous, sha256('|' || own) AS h FROM o WHERE seq = 1 UNION ALL SELECT o.event_id, o.user_id, o.event_type, o.props, o.value, o.seq, o.own, c.h, sha256(c.h || '|' || o.own) FROM c JOIN o ON o.user_id = c.user_id AND o.seq = c.seq + 1)
"""
CHAINED = ["event_id", "event_type", "props"]


def _chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("seq", F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")))
    return chains.chained(events, "user_id", "seq", CHAINED)


@query(CHAIN + "SELECT event_id, previous AS previous_event_sha256, h AS event_sha256, seq <> row_number() OVER w OR previous <> coalesce(lag(h) OVER w, '') AS broken FROM c WINDOW w AS (PARTITION BY user_id ORDER BY seq)")
def hash_chain_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chain the events of each user, each hash over the one before, and follow the chain again."""
    log = chains.broken(_chain(spark, sf_dir), "user_id", "seq", CHAINED)
    return log.select("event_id", chains.PREVIOUS, chains.HASH, (F.size("faults") > 0).alias("broken"))


@query(
    CHAIN
    + """, d AS (SELECT * REPLACE (CASE WHEN value > 80 THEN 'view' ELSE event_type END AS event_type) FROM c WHERE value >= 0.5),
e AS (SELECT *, sha256(previous || '|' || sha256(strlen(event_id::VARCHAR) || ':' || event_id || coalesce(strlen(event_type) || ':' || event_type, '-') || coalesce(strlen(props) || ':' || props, '-'))) AS made, row_number() OVER w AS nth, coalesce(lag(h) OVER w, '') AS before FROM d WINDOW w AS (PARTITION BY user_id ORDER BY seq))
SELECT event_id, concat_ws(',', CASE WHEN seq <> nth THEN 'number' END, CASE WHEN previous <> before THEN 'previous_hash' END, CASE WHEN h <> made THEN 'event_hash' END) AS faults FROM e"""
)
def hash_chain_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the check says of a log of which events were altered (of high values) and lost (of low ones)."""
    altered = _chain(spark, sf_dir).where("value >= 0.5").withColumn("event_type", F.when(F.col("value") > 80, "view").otherwise(F.col("event_type")))
    return chains.broken(altered, "user_id", "seq", CHAINED).select("event_id", F.array_join("faults", ",").alias("faults"))


#: Each event amends the user's one before it; a sign-up the one before that, a purchase of a high value none.
AMENDED = """WITH RECURSIVE o AS (SELECT event_id::VARCHAR AS event_id, user_id AS target, event_id AS seq, CASE event_type WHEN 'error' THEN 'retract' ELSE 'patch' END AS kind, value, event_type, coalesce(props, '') AS new_sha256,
lag(event_id, 1) OVER w AS p1, lag(event_id, 2) OVER w AS p2, lag(coalesce(props, ''), 1) OVER w AS n1, lag(coalesce(props, ''), 2) OVER w AS n2 FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
a AS (SELECT event_id, target, seq, kind, new_sha256, CASE WHEN event_type = 'purchase' AND value > 60 THEN NULL WHEN event_type = 'signup' THEN p2 ELSE p1 END::VARCHAR AS previous, CASE WHEN event_type = 'view' AND value > 60 THEN 'none' WHEN event_type = 'signup' THEN n2 ELSE n1 END AS old_sha256 FROM o),
k AS (SELECT a.*, p.kind AS pk, p.new_sha256 AS pn, row_number() OVER (PARTITION BY a.target, a.previous ORDER BY a.seq) > 1 AS fork FROM a LEFT JOIN a p ON p.event_id = a.previous),
z AS (SELECT *, concat_ws(',', CASE WHEN fork THEN 'fork' END, CASE WHEN pk = 'retract' THEN 'reopened' END, CASE WHEN previous IS NOT NULL AND pn IS DISTINCT FROM old_sha256 THEN 'record_hash' END) AS codes FROM k),
r AS (SELECT event_id, event_id AS root, 0 AS rank, codes = '' AS effective, target, codes FROM z WHERE previous IS NULL UNION ALL SELECT z.event_id, r.root, r.rank + 1, r.effective AND z.codes = '', z.target, z.codes FROM r JOIN z ON z.previous = r.event_id)
"""


@query(AMENDED + "SELECT event_id, root, rank::BIGINT AS rank, codes, effective FROM r")
def amendment_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rank and faults of amendments that fork, go on after a retraction and name another record."""
    events = table(spark, sf_dir, "events")
    order = Window.partitionBy("user_id").orderBy("event_id")
    body = F.coalesce("props", F.lit(""))
    kind, high = F.col("event_type"), F.col("value") > 60
    previous = F.when((kind == "purchase") & high, None).when(kind == "signup", F.lag("event_id", 2).over(order)).otherwise(F.lag("event_id", 1).over(order))
    old = F.when((kind == "view") & high, "none").when(kind == "signup", F.lag(body, 2).over(order)).otherwise(F.lag(body, 1).over(order))
    rows = events.select("event_id", F.col("user_id").alias("target"), F.col("event_id").alias("seq"), F.when(kind == "error", "retract").otherwise("patch").alias("kind"), previous.alias("previous"), old.alias("old_sha256"), body.alias("new_sha256"))
    return chains.amendments(rows).select("event_id", "root", "rank", F.array_join("codes", ",").alias("codes"), "effective")


@query(LOG + "SELECT execution_id, round, nth, CAST(upto AS BIGINT) AS upto FROM (SELECT execution_id, round, CAST(row_number() OVER w AS INTEGER) AS nth, sum(intent) OVER (PARTITION BY round ORDER BY ts, execution_id ROWS UNBOUNDED PRECEDING) AS upto FROM log WINDOW w AS (PARTITION BY round ORDER BY ts, execution_id)) WHERE nth <= 12 AND upto <= 400")
def budgeted_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return execution.budget_prefix(log(spark, sf_dir), ["round"], ["ts", "execution_id"], "intent", 12, 400).select("execution_id", "round", "nth", "upto")


@query(LOG + ", t AS (SELECT execution_id, status, CAST(row_number() OVER (PARTITION BY status ORDER BY ts, execution_id) AS INTEGER) AS turn FROM log) SELECT * FROM t ORDER BY turn, status LIMIT 40")
def round_robin_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 40 when the statuses take turns; the limit is the budget."""
    return execution.round_robin(log(spark, sf_dir), "status", ["ts", "execution_id"], 40).select("execution_id", "status", "turn")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(json_extract_string(props, '$.k') AS BIGINT) BETWEEN 0 AND 99 AS valid FROM events")
def json_cell_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON cells parsed with a schema and checked."""
    cell = F.from_json("props", "k long")
    return table(spark, sf_dir, "events").select("event_id", cell["k"].alias("k"), cell["k"].between(0, 99).alias("valid"))


@query(
    """WITH b AS (SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders), e AS (SELECT * FROM b WHERE o_orderkey % 5 IN (0, 1)), own AS (SELECT *, sha256(o_orderstatus || '|' || o_orderpriority) AS h FROM b)
SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 1 AND o_orderkey % 2 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_orderpriority FROM b WHERE o_orderkey % 5 <> 0"""
)
def active_view_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders under correction events: keys of 5n retracted, of 5n + 1 patched if the event names the row's hash (which those with even keys do)."""
    base = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    own = F.sha2(F.concat_ws("|", "o_orderstatus", "o_orderpriority"), 256)
    events = base.where("o_orderkey % 5 in (0, 1)").select(
        "o_orderkey",
        F.lit(1).alias("seq"),
        F.when(F.col("o_orderkey") % 5 == 0, "retract").otherwise("patch").alias("action"),
        F.when(F.col("o_orderkey") % 2 == 0, own).otherwise("stale").alias("before_sha256"),
        F.lit("X").alias("o_orderstatus"),
        F.lit(None).cast("string").alias("o_orderpriority"),
    )
    return identity.overlay(base, events, "o_orderkey", ["o_orderstatus", "o_orderpriority"])


@query(
    """SELECT 'order_without_customer' AS code, count(*) AS n FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'line_without_order', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders) UNION ALL SELECT 'label_without_document', count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)
UNION ALL SELECT 'customer_without_order', count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)"""
)
def orphan_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillspark.operators.contracts import orphans

    t = lambda name: table(spark, sf_dir, name)
    pairs = {
        "order_without_customer": (t("orders"), t("customer").withColumnRenamed("c_custkey", "o_custkey"), "o_custkey"),
        "line_without_order": (t("lineitem"), t("orders").withColumnRenamed("o_orderkey", "l_orderkey"), "l_orderkey"),
        "label_without_document": (t("labels"), t("documents"), "doc_id"),
        "customer_without_order": (t("customer"), t("orders").withColumnRenamed("o_custkey", "c_custkey"), "c_custkey"),
    }
    out = None
    for code, (child, parent, key) in pairs.items():
        part = orphans(child, parent, key).agg(F.count("*").alias("n")).select(F.lit(code).alias("code"), "n")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    LOG
    + """, h AS (SELECT user_id AS key, round AS seq, avg(gain) < 60 AS healthy FROM log GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY seq DESC) AS back FROM h QUALIFY back <= 2)
SELECT key, CASE WHEN count(*) = 2 AND NOT bool_or(healthy) THEN 4 WHEN count(*) = 2 AND bool_and(healthy) THEN 8 ELSE 6 END AS size FROM r GROUP BY key"""
)
def adaptive_window_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = log(spark, sf_dir).groupBy(F.col("user_id").alias("key"), F.col("round").alias("seq")).agg((F.avg("gain") < 60).alias("healthy"))
    return execution.window_size(windows)


@query(LOG + ", m AS (SELECT status, round, max(intent) AS intent FROM log GROUP BY ALL) SELECT status, round, intent, intent - coalesce(lag(intent) OVER (PARTITION BY status ORDER BY round), 0) AS gain FROM m")
def marginal_yield(spark: SparkSession, sf_dir: str) -> DataFrame:
    return execution.marginal(log(spark, sf_dir), ["status"], "intent")


@query("WITH e AS (SELECT event_id, props AS key, event_type FROM events) SELECT event_id, count(DISTINCT event_type) OVER (PARTITION BY key) > 1 AS rejected FROM e")
def conflicting_replays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return execution.conflicting(table(spark, sf_dir, "events"), "props", "event_type").select("event_id", "rejected")
