"""Links between ledgers, and hashes that bind them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.operators.contracts import reasons
from quillspark.operators.identity import recordset_hash

#: Fixed values (D10): words of a query that carry no intent.
IGNORED = ("有关", "相关", "查询", "搜索", "资料")
#: Fixed values (R13): the fields of a route besides its intent.
ROUTE = (
    "gap_target", "iteration_mode", "place_identity_sha256", "polarity", "query_dimension_targets", "retrieval_entry", "source_category_target", "target_platform_id", "target_subject",
    "target_time_range", "task_run_id",
)


def active(evidence: DataFrame, sources: DataFrame, key: str = "source_id") -> DataFrame:
    """Evidence whose source is active."""
    return evidence.join(sources.select(key).distinct(), key, "left_semi")


def against_plan(executions: DataFrame, plan: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Executions with codes: no registered plan row, or a field that is not as planned."""
    known = plan.select(*keys, F.lit(True).alias("_planned"), *[F.col(c).alias(f"_plan_{c}") for c in fields])
    joined = executions.join(known, keys, "left")
    planned = F.coalesce("_planned", F.lit(False))
    codes = {"query_plan_unregistered_or_query_missing": ~planned}
    codes |= {f"query_plan_execution_mismatch:{c}": planned & ~F.col(c).eqNullSafe(F.col(f"_plan_{c}")) for c in fields}
    return joined.select(*executions.columns, reasons(codes).alias("codes"))


def against_execution(sources: DataFrame, executions: DataFrame, fields: list[str], at: str = "retrieved_at") -> DataFrame:
    """Sources with codes: no execution, a field that differs from it, or a time outside it."""
    known = executions.select("execution_id", F.lit(True).alias("_known"), F.col("started_at").alias("_from"), F.col("finished_at").alias("_to"), *[F.col(c).alias(f"_run_{c}") for c in fields])
    joined = sources.join(known, "execution_id", "left")
    there = F.coalesce("_known", F.lit(False))
    inside = F.col(at).between(F.col("_from"), F.col("_to"))
    codes = {"source_execution_missing_or_invalid": ~there, "source_retrieved_time_invalid": there & F.col(at).isNull(), "source_outside_execution_window": there & F.coalesce(~inside, F.lit(False))}
    codes |= {f"source_execution_mismatch:{c}": there & ~F.col(c).eqNullSafe(F.col(f"_run_{c}")) for c in fields}
    return joined.select(*sources.columns, reasons(codes).alias("codes"))


def attributed(evidence: DataFrame, sources: DataFrame, executions: DataFrame) -> DataFrame:
    """(execution_id, n): units that each execution's sources gave, 0 where none.

    Units are counted for each source before the join, so a source with many units is no hot key.
    """
    counted = evidence.groupBy("source_id").agg(F.count("*").alias("n"))
    by_run = sources.select("source_id", "execution_id").join(counted, "source_id").groupBy("execution_id").agg(F.sum("n").alias("n"))
    return executions.select("execution_id").join(by_run, "execution_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def page_counts(executions: DataFrame, sources: DataFrame) -> DataFrame:
    """(execution_id, pages, relevant, codes): distinct URLs of an execution against what it says it opened.

    executions has opened and relevant_pages; sources has execution_id, url and relevant.
    """
    seen = sources.groupBy("execution_id").agg(F.count_distinct("url").alias("pages"), F.count_distinct(F.when(F.col("relevant"), F.col("url"))).alias("relevant"))
    joined = executions.select("execution_id", "opened", "relevant_pages").join(seen, "execution_id", "left").na.fill(0, ["pages", "relevant"])
    codes = {"source_pages_exceed_execution_opened": F.col("pages") > F.col("opened"), "source_relevant_pages_exceed_execution_relevant": F.col("relevant") > F.col("relevant_pages")}
    return joined.select("execution_id", "pages", "relevant", reasons(codes).alias("codes"))


def captured(candidates: DataFrame, captures: DataFrame) -> DataFrame:
    """Candidates with the capture that they name, or the code capture_not_found or capture_text_mismatch."""
    known = captures.select("capture_id", F.lit(True).alias("_known"), F.col("body_sha256").alias("_body"))
    joined = candidates.join(known, "capture_id", "left")
    there = F.coalesce("_known", F.lit(False))
    return joined.select(*candidates.columns, reasons({"capture_not_found": ~there, "capture_text_mismatch": there & ~F.col("body_sha256").eqNullSafe(F.col("_body"))}).alias("codes"))


def changed_fields(later: DataFrame, raw: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, codes) of rows that changed a field which must stay as in the raw ledger, or that it lacks."""
    known = raw.select(key, F.lit(True).alias("_known"), *[F.col(c).alias(f"_raw_{c}") for c in fields])
    joined = later.join(known, key, "left")
    there = F.coalesce("_known", F.lit(False))
    codes = {"raw_record_missing": ~there} | {f"field_changed:{c}": there & ~F.col(c).eqNullSafe(F.col(f"_raw_{c}")) for c in fields}
    return joined.select(key, reasons(codes).alias("codes")).where("size(codes) > 0")


def canonical_json(fields: dict[str, Column]) -> Column:
    """JSON of text fields with sorted keys, no spaces and raw characters; a null is an empty text."""
    pairs = [F.coalesce(fields[k].cast("string"), F.lit("")).alias(k) for k in sorted(fields)]
    return F.to_json(F.struct(*pairs))


def canonical_sha(fields: dict[str, Column]) -> Column:
    return F.sha2(canonical_json(fields), 256)


def intent(query: Column, facets: dict[str, Column]) -> Column:
    """The identity of a query: its words in order without empty ones, and its facets.

    Words are lower-cased; full-width Latin letters and digits are folded, as of all compatibility forms they
    are the ones that queries hold.
    """
    wide = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "　"
    plain = "".join(chr(c) for c in range(0x21, 0x7F)) + " "
    folded = F.lower(F.translate(query, wide, plain))
    words = F.filter(F.split(folded, r"[^\p{L}\p{N}_]+"), lambda w: (w != "") & ~w.isin(*IGNORED))
    return F.concat_ws("|", F.array_join(words, " "), *[F.concat(F.lit(f"{k}="), F.lower(F.trim(F.coalesce(facets[k], F.lit(""))))) for k in sorted(facets)])


def route_id(fields: dict[str, Column], intent_key: Column) -> Column:
    """The id of a planned intent and access route over all attempts."""
    missing = set(ROUTE) - set(fields)
    if missing:
        raise ValueError(f"a route needs {sorted(missing)}")
    named = {k: fields[k] for k in ROUTE} | {"normalized_query_intent": intent_key, "access_policy": F.lit("public_only_no_access_barrier_bypass")}
    return F.concat(F.lit("ROUTE-"), canonical_sha(named))


def fingerprint(df: DataFrame, decision: str, columns: list[str]) -> DataFrame:
    """Add fingerprint: the hash of what a decision was made from."""
    return df.withColumn("fingerprint", canonical_sha({c: F.col(c) for c in columns} | {"decision": F.col(decision)}))


def bound(ledgers: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """(ledger, recordset, n): hashes of the ledgers that do not depend on the order of rows."""
    parts = [recordset_hash(df, columns).select(F.lit(name).alias("ledger"), "recordset", "n") for name, (df, columns) in ledgers.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def seal(binding: DataFrame, payload: Column | None = None) -> DataFrame:
    """One row (seal): the hash of a binding of ledgers, and of a payload (P10). A row for each ledger."""
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ledger", "recordset", "n"))), lambda x: F.concat_ws(":", x["ledger"], x["recordset"], x["n"])), "\n")
    return binding.agg(F.sha2(F.concat(lines, F.lit("\n"), F.lit("") if payload is None else payload), 256).alias("seal"))


def broken_bindings(claimed: DataFrame, now: DataFrame) -> DataFrame:
    """(ledger, same): whether each ledger is still the one that was bound."""
    return claimed.select("ledger", F.col("recordset").alias("_old")).join(now, "ledger", "full_outer").select("ledger", F.col("_old").eqNullSafe(F.col("recordset")).alias("same"))


def barrier(log: DataFrame) -> DataFrame:
    """Add early: whether an execution began before all of earlier rounds had ended.

    Rounds are few: their latest ends are prefix maxima over one row for each round.
    """
    ends = log.groupBy("round").agg(F.max("end_ts").alias("end"))
    before = Window.orderBy("round").rowsBetween(Window.unboundedPreceding, -1)
    latest = ends.select("round", F.max("end").over(before).alias("_barrier"))
    return log.join(F.broadcast(latest), "round").withColumn("early", F.coalesce(F.col("ts") < F.col("_barrier"), F.lit(False))).drop("_barrier")


def first_distinct(df: DataFrame, by: str, value: str, order: str, k: int = 5) -> DataFrame:
    """(by, value, place): the first k distinct values of each group, by their first appearance."""
    firsts = df.groupBy(by, value).agg(F.min(order).alias("_first"))
    return firsts.withColumn("place", F.row_number().over(Window.partitionBy(by).orderBy("_first", value))).where(F.col("place") <= k).select(by, value, "place")


def versions(captures: DataFrame, key: str = "url", order: str = "seq") -> DataFrame:
    """Add version: the number of each capture of its URL."""
    return captures.withColumn("version", F.row_number().over(Window.partitionBy(key).orderBy(order)))


def ordered(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """The rows by key and then by their hash: an order that does not depend on how they came (O3)."""
    row = F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns]), 256)
    return df.withColumn("row_sha256", row).orderBy(key, "row_sha256")


def united(*ledgers: DataFrame) -> DataFrame:
    """All rows of ledgers or batches; a column that one lacks is null there."""
    out = ledgers[0]
    for other in ledgers[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out
