"""Conversation structure repair: the cheapest edits that make a conversation `(s?(ua)+)?`.

Window functions flag each row's first fault: blank (nothing but white space), duplicate (role and text seen
earlier in the conversation) or truncated (the last character that is no white space does not end a
sentence). The sorted rows of a conversation are then one array, and aggregate() folds them: four states
(nothing yet, after a system, a user, an assistant turn) each carry the least (cost, audit) as a struct, and
least() picks among the edits that lead to a state. Blank and duplicate rows can only be deleted.

The audit has a letter for each edit: D (delete, 4), I (insert an empty user or assistant turn, 3), K (keep,
0), R (give the role user or assistant, 3); a truncated row that stays costs 3 more. Of equal costs the
audit that comes first in ASCII wins. Beside it a plan tells which role an I or R gives (u, a and U, A).

Rows are ordered by turn, null first, then by role and text, so repeated rows stand together. A null role or
text reads as one space, so such a row is blank or has no fitting role. Rows with a null conv_id are one
conversation. Rows whose column `lost` is true count for nothing but keep their conversation in the result.
An empty table gives no rows. Other columns are not read.

A conversation is one row of the fold, as a document is one text: one shuffle by conv_id, no further one.
An audit is copied at each turn, so a conversation's cost grows with the square of its number of turns,
though with a few bytes for each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: White space, as the faults know it.
BLANKS = " \t\n\v\f\r"
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
STATES = ("none", "s", "u", "a")
_STATE = "struct<cost:bigint,audit:string,plan:string>"


def damage(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, lost): rows spoiled by the checksum of `conv_id:turn` modulo 20.

    0 loses the row, 1 empties its text, 2 takes its sentence ends, 3 repeats it, 4 makes its role user.
    """
    name = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(name[0], F.lit(":"), name[1]).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")], kind.alias("kind"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.array_repeat(F.col("kind") == 0, F.when(F.col("kind") == 3, 2).otherwise(1))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("lost"))


def flagged(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, lost, nth, new_turn, initial, fault, illegal): each row's place, first fault and whether its role may not follow the one before."""
    lost = F.coalesce(F.col("lost"), F.lit(False)) if "lost" in turns.columns else F.lit(False)
    rows = turns.select("conv_id", "turn", *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")], lost.alias("lost"))
    # dealt by conversation once; the windows' finer keys need no shuffle of their own
    rows = rows.repartition("conv_id").withColumns({"initial": F.left("role", F.lit(1)), "said": F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)})
    order = Window.partitionBy("conv_id", "lost").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    before = F.lag("initial").over(order)
    illegal = before.isNotNull() & ~F.concat(before, "initial").isin("su", "ua", "au")
    new = F.col("turn").isNotNull() & ~F.lag("turn").over(order).eqNullSafe(F.col("turn"))
    rows = rows.withColumns({"nth": F.row_number().over(order), "new_turn": new, "illegal": illegal})
    # by the places given, so that of equal rows the later one is the duplicate
    earlier = Window.partitionBy("conv_id", "lost", "said").orderBy("nth")
    bare = F.rtrim("text", F.lit(BLANKS))
    fault = F.when(bare == "", "blank").when(F.row_number().over(earlier) > 1, "duplicate").when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), "truncated")
    return rows.withColumn("fault", fault).select("conv_id", "turn", "role", "text", "lost", "nth", "new_turn", "initial", "fault", "illegal")


def _edit(state: Column, cost: Column | int, letter: str, plan: str = "") -> Column:
    """A state after one more edit; null stays null, which least() passes over."""
    added = F.struct((state["cost"] + cost).alias("cost"), F.concat(state["audit"], F.lit(letter)).alias("audit"), F.concat(state["plan"], F.lit(plan or letter)).alias("plan"))
    return F.when(state.isNotNull(), added)


def _inserted(states: Column) -> dict[str, Column]:
    """The states with any turns inserted that can pay: never more than a user and an assistant turn at one place."""
    user = F.least(states["u"], *[_edit(states[s], INSERT, "I", "u") for s in ("none", "s", "a")])
    return {"none": states["none"], "s": states["s"], "u": user, "a": F.least(states["a"], _edit(user, INSERT, "I", "a"))}


def _step(states: Column, row: Column) -> Column:
    """The states after a row: deleted, kept or given a role."""
    at = _inserted(states)
    stays = ~F.coalesce(row["fault"].isin("blank", "duplicate"), F.lit(False))
    more = F.when(row["fault"] == "truncated", TRUNCATED).otherwise(0)

    def kept(state: Column, initial: str) -> Column:
        return F.when(stays & (row["initial"] == initial), _edit(state, more, "K"))

    def given(state: Column, plan: str) -> Column:
        return F.when(stays, _edit(state, more + REROLE, "R", plan))

    before_user = [at[s] for s in ("none", "s", "a")]
    none, s, u, a = (_edit(at[x], DELETE, "D") for x in STATES)
    return F.struct(
        none.alias("none"),
        F.least(s, kept(at["none"], "s")).alias("s"),
        F.least(u, *[kept(x, "u") for x in before_user], *[given(x, "U") for x in before_user]).alias("u"),
        F.least(a, kept(at["u"], "a"), given(at["u"], "A")).alias("a"),
    )


def _cheapest(rows: Column) -> Column:
    start = F.struct(F.struct(F.lit(0).cast("bigint").alias("cost"), F.lit("").alias("audit"), F.lit("").alias("plan")).alias("none"), *[F.lit(None).cast(_STATE).alias(s) for s in STATES[1:]])
    return F.aggregate(rows, start, _step, lambda states: F.least(states["none"], _inserted(states)["a"]))


def _turns(rows: Column, plan: Column) -> Column:
    """The repaired turns: a plan's token is what is inserted before a row, and the row's own edit."""
    role = lambda letter: F.when(F.upper(letter) == "U", "user").otherwise("assistant")
    turn = lambda role, text: F.struct(role.alias("role"), text.alias("text"))

    def new(letters: Column) -> Column:
        return F.transform(F.filter(F.split(letters, ""), lambda x: x.isin("u", "a")), lambda x: turn(role(x), F.lit("")))

    def token(value: Column, at: Column) -> Column:
        row, edit = F.get(rows, at), F.right(value, F.lit(1))
        own = turn(F.when(edit == "K", row["role"]).otherwise(role(edit)), row["text"])
        return F.concat(new(value), F.when(edit != "D", F.array(own)).otherwise(F.filter(F.array(own), lambda x: F.lit(False))))

    return F.concat(F.flatten(F.transform(F.regexp_extract_all(plan, F.lit("([ua]*[KDUA])")), token)), new(F.regexp_extract(plan, "[ua]*$", 0)))


def repair(turns: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired): one row for each conversation, with its repaired turns."""
    there = ~F.col("lost")
    count = lambda condition: F.count_if(there & condition)
    gaps = F.max(F.when(there, F.col("turn"))) - F.min(F.when(there, F.col("turn"))) + 1 - count(F.col("new_turn"))
    rows = F.sort_array(F.collect_list(F.when(there, F.struct("nth", "initial", "fault", "role", "text"))))
    held = flagged(turns).groupBy("conv_id").agg(
        F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"),
        *[count(F.coalesce(F.col("fault") == name, F.lit(False))).alias(name) for name in ("blank", "duplicate", "truncated")],
        count(F.col("illegal")).alias("illegal"),
        rows.alias("rows"),
    )
    best = held.withColumn("best", _cheapest(F.col("rows")))
    return best.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", F.col("best.cost").alias("cost"), F.col("best.audit").alias("audit"), _turns(F.col("rows"), F.col("best.plan")).alias("repaired"))


def report(turns: DataFrame) -> DataFrame:
    """The repair of damaged conversations, with a hash of the repaired turns."""
    lines = F.array_join(F.transform("repaired", lambda x: F.concat(x["role"], F.lit(":"), x["text"])), "\n")
    return repair(damage(turns)).withColumn("repaired_sha256", F.sha2(lines, 256)).drop("repaired")


#: The same by a recursive query; the checksum by its definition: a table made from the polynomial, and a fold over the bytes.
ORACLE_SQL = r"""
WITH RECURSIVE steps(i, k, v) AS (
  SELECT i, 0, i FROM range(256) r(i) UNION ALL SELECT i, k + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM steps WHERE k < 8
), tab AS (SELECT list(v ORDER BY i) AS t FROM steps WHERE k = 8
), c AS (
  SELECT coalesce(conv_id::VARCHAR, ' ') AS conv, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_transform(regexp_extract_all(hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))), '..'), lambda h: CAST('0x' || h AS BIGINT)), lambda acc, b: xor(acc // 256, t[xor(acc % 256, b) + 1]), 4294967295), 4294967295) % 20 AS kind FROM conversations CROSS JOIN tab
), d AS (
  SELECT conv, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text FROM c CROSS JOIN range(2) r(copy) WHERE kind > 0 AND (copy = 0 OR kind = 3)
), f AS (
  SELECT *, row_number() OVER w AS k, left(role, 1) AS i, lag(left(role, 1)) OVER w AS before, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM d WINDOW w AS (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text)
), g AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY k) > 1 THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault, before IS NOT NULL AND before || i NOT IN ('su', 'ua', 'au') AS illegal FROM f
), sums AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal, max(k) AS n FROM g GROUP BY conv
), fold AS (
  -- a state is its cost in 12 digits, the audit and the plan, so that the least text is the cheapest; u and a come with what is inserted after a row
  SELECT conv, 0::BIGINT AS k, lpad('0', 12, '0') || '||' AS none, NULL::VARCHAR AS s, lpad('3', 12, '0') || '|I|u' AS u, lpad('6', 12, '0') || '|II|ua' AS a FROM sums
  UNION ALL
  SELECT conv, k, none, s, u, least(a, regexp_replace(lpad((u[:12]::BIGINT + 3)::VARCHAR, 12, '0') || u[13:], '\|([^|]*)\|(.*)$', '|\1I|\2a')) AS a FROM (
    SELECT conv, k, none, s, least(u, list_aggregate(list_transform([none, s, a], lambda x: regexp_replace(lpad((x[:12]::BIGINT + 3)::VARCHAR, 12, '0') || x[13:], '\|([^|]*)\|(.*)$', '|\1I|\2u')), 'min')) AS u, a FROM (
      SELECT conv, g.k,
        regexp_replace(lpad((none[:12]::BIGINT + 4)::VARCHAR, 12, '0') || none[13:], '\|([^|]*)\|(.*)$', '|\1D|\2D') AS none,
        least(regexp_replace(lpad((s[:12]::BIGINT + 4)::VARCHAR, 12, '0') || s[13:], '\|([^|]*)\|(.*)$', '|\1D|\2D'), CASE WHEN stays AND i = 's' THEN regexp_replace(lpad((none[:12]::BIGINT + more)::VARCHAR, 12, '0') || none[13:], '\|([^|]*)\|(.*)$', '|\1K|\2K') END) AS s,
        least(regexp_replace(lpad((u[:12]::BIGINT + 4)::VARCHAR, 12, '0') || u[13:], '\|([^|]*)\|(.*)$', '|\1D|\2D'),
          CASE WHEN stays AND i = 'u' THEN list_aggregate(list_transform([none, s, a], lambda x: regexp_replace(lpad((x[:12]::BIGINT + more)::VARCHAR, 12, '0') || x[13:], '\|([^|]*)\|(.*)$', '|\1K|\2K')), 'min') END,
          CASE WHEN stays THEN list_aggregate(list_transform([none, s, a], lambda x: regexp_replace(lpad((x[:12]::BIGINT + more + 3)::VARCHAR, 12, '0') || x[13:], '\|([^|]*)\|(.*)$', '|\1R|\2U')), 'min') END) AS u,
        least(regexp_replace(lpad((a[:12]::BIGINT + 4)::VARCHAR, 12, '0') || a[13:], '\|([^|]*)\|(.*)$', '|\1D|\2D'),
          CASE WHEN stays AND i = 'a' THEN regexp_replace(lpad((u[:12]::BIGINT + more)::VARCHAR, 12, '0') || u[13:], '\|([^|]*)\|(.*)$', '|\1K|\2K') END,
          CASE WHEN stays THEN regexp_replace(lpad((u[:12]::BIGINT + more + 3)::VARCHAR, 12, '0') || u[13:], '\|([^|]*)\|(.*)$', '|\1R|\2A') END) AS a
      FROM fold JOIN (SELECT *, fault NOT IN ('blank', 'duplicate') AS stays, CASE fault WHEN 'truncated' THEN 3 ELSE 0 END AS more FROM g) g USING (conv) WHERE g.k = fold.k + 1
    )
  )
), best AS (SELECT conv, least(none, a) AS x FROM fold JOIN sums USING (conv) WHERE k = n
), told AS (SELECT conv, x[:12]::BIGINT AS cost, split_part(x, '|', 2) AS audit, split_part(x, '|', 3) AS plan FROM best
), edits AS (SELECT *, plan[pos] AS e, length(regexp_replace(plan[:pos], '[ua]', '', 'g')) AS k FROM (SELECT conv, plan, unnest(range(1, length(plan) + 1)) AS pos FROM told)
), lines AS (
  SELECT conv, string_agg(CASE e WHEN 'u' THEN 'user:' WHEN 'a' THEN 'assistant:' WHEN 'U' THEN 'user:' || text WHEN 'A' THEN 'assistant:' || text ELSE role || ':' || text END, chr(10) ORDER BY pos) AS body FROM edits LEFT JOIN g USING (conv, k) WHERE e <> 'D' GROUP BY conv
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv, conv_id FROM c) o LEFT JOIN sums USING (conv) LEFT JOIN told USING (conv) LEFT JOIN lines USING (conv)
"""
