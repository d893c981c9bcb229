"""Row contracts: every rule that a row breaks becomes a reason code."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tri_state(value: Column) -> Column:
    """true, false or null (unknown) of a text cell."""
    cell = F.lower(F.trim(value.cast("string")))
    return F.when(cell.isin("true", "1", "yes", "y", "是"), True).when(cell.isin("false", "0", "no", "n", "否"), False)


def finite_double(value: Column) -> Column:
    """A finite number of at most 128 characters, else null."""
    cell = F.trim(value.cast("string"))
    good = cell.rlike(r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$") & (F.length(cell) <= 128)
    number = F.when(good, cell.try_cast("double"))
    return F.when(~F.isnan(number) & (F.abs(number) < float("inf")), number)


def tags(value: Column) -> Column:
    """The parts of a cell between ; fullwidth ; and |, trimmed, without empty ones."""
    return F.filter(F.transform(F.split(value, "[;；|]"), lambda x: F.trim(x)), lambda x: x != "")


def reasons(rules: Mapping[str, Column]) -> Column:
    """The codes whose condition is true; a condition that is unknown counts as true, so that nulls fail."""
    codes = [F.when(F.coalesce(broken, F.lit(True)), F.lit(code)) for code, broken in rules.items()]
    return F.array_compact(F.array(*codes))


def with_reasons(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add reasons and eligible."""
    return df.withColumn("reasons", reasons(rules)).withColumn("eligible", F.size("reasons") == 0)


def violations(df: DataFrame, key: str) -> DataFrame:
    """(key, code): one row for each reason of each row."""
    return df.select(key, F.explode("reasons").alias("code"))


def top_reasons(df: DataFrame, by: list[str], k: int = 3) -> DataFrame:
    """The k most frequent reasons of each group; ties by name."""
    from pyspark.sql import Window

    counted = df.select(*by, F.explode("reasons").alias("reason")).groupBy(*by, "reason").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("n"), "reason"))
    return counted.withColumn("place", place).where(F.col("place") <= k)


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows of child whose key no row of parent has."""
    return child.join(parent.select(key).distinct(), key, "left_anti")


#: Fixed values (F6): status -> (allowed next actions, whether sources may be attached, whether it counts as coverage).
OUTCOMES = {
    "completed": (("continue", "exhausted", "not_applicable", "target_met"), True, True),
    "partial": (("continue", "retry", "exhausted"), True, True),
    "blocked": (("continue", "exhausted", "not_applicable"), True, True),
    "no_results": (("continue", "exhausted", "not_applicable", "target_met"), False, True),
    "failed": (("continue", "retry", "exhausted", "not_applicable"), False, False),
}
#: Fixed values (R12): errors that allow one controlled retry.
RETRY_REASONS = ("transient_network_error", "timeout", "temporary_rate_limit", "server_error")
#: Fixed values (F7): sources left out by default.
EXCLUDED_PLATFORMS = ("大众点评", "小红书")
EXCLUDED_DOMAINS = ("dianping.com", "xiaohongshu.com")
#: Fixed values (F5): block types by what is_user_generated must be; page_body may be either.
USER_BLOCKS = ("user_post", "user_review", "comment", "reply")
OTHER_BLOCKS = ("official_fact", "news_article", "academic_text", "metadata")


def coverage(status: Column) -> Column:
    """Whether an execution with this status counts as coverage; false for an unknown one."""
    return status.isin(*[name for name, (_, _, counts) in OUTCOMES.items() if counts])


def retryable(status: Column, action: Column, error: Column, restricted: Column) -> Column:
    """Whether the execution may be tried again once."""
    ended = action.isin("exhausted", "target_met", "not_applicable")
    known = status.isin("failed", "partial") & ~F.coalesce(restricted, F.lit(False)) & ~ended & error.isin(*RETRY_REASONS)
    return F.coalesce(known, F.lit(False))


def outcome_reasons(status: Column, action: Column, sources: Column, retry_allowed: Column | None = None, counts: Mapping[str, Column] | None = None, scored: Column | None = None) -> Column:
    """Codes of an execution row against the outcome matrix.

    counts may have opened, relevant, duplicate and returned pages; scored is the number of new scored units.
    """
    known = status.isin(*OUTCOMES)
    allowed = F.lit(False)
    for name, (actions, _, _) in OUTCOMES.items():
        allowed = allowed | ((status == name) & action.isin(*actions))
    may_have = status.isin(*[name for name, (_, with_sources, _) in OUTCOMES.items() if with_sources])
    rules = {
        "execution_status_invalid": ~known,
        "execution_status_action_conflict": known & ~allowed,
        "execution_retry_precondition_invalid": known & (action == "retry") & ~(F.lit(False) if retry_allowed is None else retry_allowed),
        "execution_status_cannot_produce_sources": (sources > 0) & ~may_have,
    }
    if counts:
        opened, relevant, duplicate, returned = (counts[k] for k in ("opened", "relevant", "duplicate", "returned"))
        rules |= {
            "execution_duplicate_pages_exceed_opened": known & (duplicate > opened),
            "execution_relevant_pages_exceed_opened": known & (relevant > opened),
            "execution_no_results_has_output": (status == "no_results") & (opened + relevant + duplicate + returned > 0),
            "execution_failed_has_pages": (status == "failed") & (opened + relevant + duplicate > 0),
        }
    if scored is not None:
        rules["execution_without_sources_has_scored_evidence"] = known & ~may_have & (scored > 0)
    return reasons(rules)


def default_excluded(platform: Column, domain: Column) -> Column:
    """Whether a source is left out by default: by its platform, or by its domain or a parent of it."""
    host = F.lower(F.trim(F.coalesce(domain, F.lit(""))))
    out = F.trim(F.coalesce(platform, F.lit(""))).isin(*EXCLUDED_PLATFORMS)
    for d in EXCLUDED_DOMAINS:
        out = out | (host == d) | host.endswith(f".{d}")
    return out


def block_reasons(block: Column, by_user: Column) -> Column:
    """Codes of a leaf block's type against who made it."""
    known = F.coalesce(block.isin("page_body", *USER_BLOCKS, *OTHER_BLOCKS), F.lit(False))
    conflict = (block.isin(*USER_BLOCKS) & ~by_user) | (block.isin(*OTHER_BLOCKS) & by_user)
    return reasons({"invalid_block_type": ~known, "block_user_status_must_be_boolean": known & by_user.isNull(), "block_type_user_status_conflict": known & by_user.isNotNull() & conflict})


def unit_reasons(unit: Column, layer: Column, block: Column, by_user: Column, scoring: bool = False) -> Column:
    """Codes of a text unit that names a block, against its content layer and the block."""
    users, user = unit.isin(*USER_BLOCKS), F.coalesce(by_user, F.lit(False))
    official, body = unit == "official_fact", unit == "page_body"
    named = F.coalesce(block, F.lit("")) != ""
    rules = {
        "native_numeric_content_layer_conflict": (unit == "source_native_numeric") & (layer != "rating_only"),
        "native_numeric_locator_conflict": (unit == "source_native_numeric") & named,
        "unit_content_layer_conflict": named & (users | official) & (layer != unit),
        "unit_block_type_conflict": named & users & (block != unit),
        "user_block_locator_required": named & users & ~user,
        "official_fact_content_identity_conflict": named & official & ((layer != "official_fact") | (block != "official_fact")),
        "official_fact_user_status_conflict": named & official & ~F.coalesce(~by_user, F.lit(False)),
        "page_body_content_identity_conflict": named & body & ((layer != "page_body") | (block != "page_body")),
    }
    if scoring:
        rules |= {"official_fact_not_formally_scorable": named & official, "page_body_lacks_user_origin": named & body & ~user}
    return reasons(rules)
