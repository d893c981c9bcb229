"""Conversation prefix trie: which conversations begin with the same turns.

A conversation is the string of its turns' digests. Conversations sorted by these strings have, between
neighbours, the lengths of their longest common prefixes in turns (LCP). The Cartesian tree over this array
is the trie: a node of depth d that starts at position l ends at the next position whose LCP is smaller than
d. Equal LCPs are one node, and depths that the tree skips are expanded, so each distinct prefix is a node.

All nearest smaller values are found in parallel. A block is one sorted range of the table. In it a stack
closes the nodes that end there and sums up their intervals; what is open at its end looks for the next block whose least
LCP is smaller, and in that block for the place where its depth ends. The least LCPs and sums of the blocks
are one row of numbers for each block. Parents come from a second pass in the order (start, depth), in which
a node comes after its parent; each block starts from the path that is open at its first conversation.

The ids of the conversations that end at a node are hashed in pieces of PIECE ids, in order, so a
conversation that has very many copies is no large row or group; its copies are spread over the blocks.

Turns are ordered by turn, null first, then by role and digest. Null roles and texts are empty. Rows without
conv_id belong to no conversation and are left out; repeated rows are turns of their own. An empty table has
no nodes. Other columns are not read. A conversation's digests are one row, as a document's text is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.session import cut, ship_package

#: Bytes of a turn's digest.
DIGEST = 16
#: Ids in a piece of a list that is hashed.
PIECE = 1024
#: Conversations that share their first turns with the first of their hundred, and how many turns at most.
FAMILY, HEADS = 100, 6
NO_ENDS = hashlib.sha256(b"").hexdigest()
BATCH_ROWS = 10_000


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as (digest in hex, n_chars of the text)."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.left(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), F.lit(2 * DIGEST))
    rows = turns.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.struct("turn", role.alias("role"), digest.alias("digest"), F.length(text).cast("long").alias("n_chars")).alias("row"))
    held = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    return held.select("conv_id", F.transform("rows", lambda x: F.struct(x["digest"].alias("digest"), x["n_chars"].alias("n_chars"))).alias("turns"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): the first h turns of the first conversation of its hundred, then its own after its first h.

    h is the checksum of the decimal conv_id modulo 6; of the first conversations only so many turns are joined.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    own = conversations.withColumns({"h": h, "first": F.col("conv_id") - F.col("conv_id") % FAMILY})
    heads = conversations.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("first"), F.slice("turns", 1, HEADS - 1).alias("head"))
    joined = own.join(heads, "first", "left")
    head = F.when(F.col("head").isNotNull(), F.slice("head", F.lit(1), F.col("h"))).otherwise(F.slice("turns", 1, 0))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return joined.select("conv_id", F.concat(head, rest).alias("turns"))


def _blocks(conversations: DataFrame) -> DataFrame:
    """(block, conv_id, key, n_chars, base, lcp, before): sorted, in blocks that are partitions.

    base is the position of the block's first row, lcp its LCP with the row before it and before that row's
    number of turns; both are null in the first block.
    """
    parts = max(int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    key = F.unhex(F.array_join(F.transform("turns", lambda x: x["digest"]), ""))
    keyed = conversations.select("conv_id", key.alias("key"), F.transform("turns", lambda x: x["n_chars"]).alias("n_chars"))
    rows = cut(keyed.repartitionByRange(parts, "key", "conv_id").sortWithinPartitions("key", "conv_id").withColumn("part", F.spark_partition_id()))
    ends = rows.groupBy("part").agg(F.min("key").alias("first"), F.max("key").alias("last"), F.count("*").alias("n"))
    order = Window.orderBy("part")  # a row for each partition
    ends = ends.select("part", "first", (F.row_number().over(order) - 1).alias("block"), F.lag("last").over(order).alias("previous"), F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    turns = lambda x: (F.octet_length(x) / DIGEST).cast("int")
    shorter = F.when(F.col("previous").isNotNull(), F.least(turns(F.col("first")), turns(F.col("previous"))))
    digest = lambda x, k: F.substring(x, k * DIGEST + 1, F.lit(DIGEST))
    differs = F.filter(F.sequence(F.lit(0), shorter - 1), lambda k: digest(F.col("first"), k) != digest(F.col("previous"), k))
    lcp = F.when(shorter > 0, F.coalesce(F.array_min(differs), shorter)).otherwise(shorter)
    heads = ends.select("part", "block", "base", lcp.alias("lcp"), turns(F.col("previous")).alias("before"))
    return rows.join(F.broadcast(heads), "part").select("block", "conv_id", "key", "n_chars", "base", "lcp", "before")


@dataclass
class _Sum:
    """What is summed up over an interval of positions."""

    n: int = 0
    least: int | None = None
    total: int = 0
    fresh: int = 0
    leaves: int = 0

    def add(self, other: _Sum) -> None:
        self.n += other.n
        self.total += other.total
        self.fresh += other.fresh
        self.leaves += other.leaves
        if self.least is None or other.least is not None and other.least < self.least:
            self.least = other.least


@dataclass
class _Run:
    """Nodes of the depths low + 1 to high that start at one position; of a block's first run, at an earlier one."""

    start: int | None
    low: int
    high: int
    chars: np.ndarray | None = None
    kids: int = 0
    ends: str | None = None
    sum: _Sum = field(default_factory=_Sum)


NODE, OPEN, CLOSE, BLOCK, ENDS = range(5)
_PASS = "kind int, block int, start long, depth long, n long, least long, total long, fresh long, leaves long, kids long, chars long, ends string, at long"


class _Block:
    """One pass over a sorted block; rows gives the nodes, and what other blocks must know."""

    def __init__(self, block: int, base: int, lcp: int | None, before: int | None):
        self.block, self.position, self.lcp, self.length = block, base, -1 if lcp is None else lcp, before
        self.key: bytes | None = None
        self.stack = [] if lcp is None else [_Run(None, -1, before)]
        self.group: list[str] = []
        self.group_at, self.pieced, self.group_run = base, False, self.stack[0] if self.stack else None
        self.rows: list[tuple] = []

    def _emit(self, kind: int, run: _Run, depth: int, held: _Sum, kids: int, ends: str | None = NO_ENDS) -> None:
        chars = fresh = 0
        if run.chars is not None:  # the characters that all members share before the node's own turn
            chars = int(run.chars[max(depth - 1, 0)])
            fresh = int(run.chars[max(run.low, 0)]) - chars
        self.rows.append((kind, self.block, run.start, depth, held.n, held.least, held.total, held.fresh + fresh, held.leaves, kids, chars, ends, None))

    def _nodes(self, kind: int, run: _Run, above: int, held: _Sum) -> None:
        """The nodes of a run that are deeper than above."""
        for depth in range(run.high, above, -1):
            full = run.chars is not None and depth == len(run.chars) - 1
            deepest = depth == run.high
            self._emit(kind, run, depth, held, run.kids if deepest else int(run.start is not None), run.ends if full else NO_ENDS)

    def _piece(self) -> None:
        if self.group:
            self.rows.append((ENDS, self.block, self.group_run.start, self.length, None, None, None, None, None, None, None, ",".join(self.group), self.group_at))
            self.group_at += len(self.group)
            self.group, self.pieced = [], True

    def _end_group(self, last: bool = False) -> None:
        """Hash the ids of equal conversations, or leave a piece where there are more of them."""
        run = self.group_run
        if run is None:
            return
        if self.pieced or last or run.start is None:
            self._piece()
        else:
            run.ends = hashlib.sha256(",".join(self.group).encode()).hexdigest()

    def add(self, conv_id: int, key: bytes, n_chars: Any) -> None:
        length = len(key) // DIGEST
        lcp = self.lcp if self.key is None else common(self.key, key)
        copy = lcp == length and self.length == length
        if not copy:
            self._end_group()
        if self.stack and lcp < self.length:
            self.stack[-1].sum.leaves += 1
        while self.stack and self.stack[-1].high > lcp:
            run = self.stack[-1]
            self._nodes(CLOSE if run.start is None else NODE, run, max(run.low, lcp), run.sum)
            if run.low >= lcp:
                self.stack.pop()
                self.stack[-1].sum.add(run.sum)
            else:
                run.high, run.kids = lcp, int(run.start is not None)
        chars = np.concatenate([[0], np.cumsum(np.asarray(n_chars, np.int64))]).astype(np.int64)
        total = int(chars[-1])
        own = _Sum(1, conv_id, total, total - int(chars[max(lcp, 0)]), 0)
        if copy:
            self.stack[-1].sum.add(own)
            if len(self.group) >= PIECE:
                self._piece()
        else:
            if self.stack:
                self.stack[-1].kids += 1
            self.stack.append(_Run(self.position, lcp, length, chars, sum=own))
            self.group, self.group_at, self.pieced, self.group_run = [], self.position, False, self.stack[-1]
        self.group.append(str(conv_id))
        self.key, self.length = key, length
        self.position += 1

    def end(self) -> None:
        """The nodes that are open at the block's end, and the block's own row."""
        self._end_group(last=True)
        held = _Sum()
        for run in reversed(self.stack):
            held.add(run.sum)
            if run.start is not None:
                self._nodes(OPEN, run, run.low, held)
        first = self.stack[0]
        whole = first.start is None
        self.rows.append((BLOCK, self.block, None, first.high if whole else -1, held.n, held.least, held.total, held.fresh, held.leaves, first.kids if whole else 0, 0, None, None))


def common(a: bytes, b: bytes) -> int:
    """Turns that two keys have in common."""
    n = min(len(a), len(b)) // DIGEST
    if a[: n * DIGEST] == b[: n * DIGEST]:
        return n
    k = 0
    while a[k * DIGEST : (k + 1) * DIGEST] == b[k * DIGEST : (k + 1) * DIGEST]:
        k += 1
    return k


def _batches(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*[f.split() for f in schema.split(", ")], strict=True)
    types = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
    return pa.RecordBatch.from_arrays([pa.array(c, types[k]) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], list(names))


def _pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block = None
    for batch in batches:
        for n, conv_id, key, n_chars, base, lcp, before in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if block is None:
                block = _Block(n, base, lcp, before)
            elif block.block != n:
                raise ValueError("a partition holds several blocks")
            block.add(conv_id, key, n_chars)
            if len(block.rows) >= BATCH_ROWS:
                yield _batches(block.rows, _PASS)
                block.rows = []
    if block is not None:
        block.end()
        yield _batches(block.rows, _PASS)


_CLOSED = "block int, start long, depth long, n long, least long, total long, fresh long, leaves long, kids long, chars long, ends string, closing int"


def _closed(opened: DataFrame, blocks: list[Any]) -> DataFrame:
    """Nodes open at their block's end, with the sums of the whole blocks that they span and the block in which they end (null: none).

    blocks has one row of numbers for each block.
    """
    values = {c: np.array([r[c] for r in blocks], np.int64) for c in ("depth", "n", "least", "total", "fresh", "leaves", "kids")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floor = values["depth"]
        for batch in batches:
            out = []
            for block, start, depth, n, least, total, fresh, leaves, kids, chars, ends in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                low = np.flatnonzero(floor[block + 1 :] < depth)
                upto = block + 1 + int(low[0]) if len(low) else len(floor)
                span = slice(block + 1, upto)
                n, total, fresh, leaves = (x + int(values[c][span].sum()) for x, c in ((n, "n"), (total, "total"), (fresh, "fresh"), (leaves, "leaves")))
                least = min(least, int(values["least"][span].min())) if upto > block + 1 else least
                kids += int(values["kids"][span][floor[span] == depth].sum())
                # the last conversation of all is a leaf's
                out.append((block, start, depth, n, least, total, fresh, leaves + (not len(low)), kids, chars, ends, upto if len(low) else None))
            if out:
                yield _batches(out, _CLOSED)

    return opened.mapInArrow(run, _CLOSED)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, start, depth, ends) of lists that come in pieces, sorted by (start, depth, at)."""
    now, state = None, None
    for batch in batches:
        out = []
        for block, start, depth, ids in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if now is None or now[1:] != (start, depth):
                if now is not None:
                    out.append((*now, state.hexdigest()))
                now, state = (block, start, depth), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if out:
            yield _batches(out, "block int, start long, depth long, ends string")
    if now is not None:
        yield _batches([(*now, state.hexdigest())], "block int, start long, depth long, ends string")


_RESULT = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def _parents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of blocks in the order (block, start, depth), with their parents; rows without a start are the path that a block starts from."""
    path: list[int] = []
    ends: tuple | None = None
    for batch in batches:
        out = []
        for _, start, depth, node, conv_id, n, kids, leaves, saved, told in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if not node:
                if start is None:
                    path[depth:] = [conv_id]
                else:
                    ends = (start, depth, told)
                continue
            if told is None:
                told = ends[2] if ends and ends[:2] == (start, depth) else NO_ENDS
            out.append((conv_id, depth, path[depth - 1] if depth else None, n, kids, leaves, saved, told))
            path[depth:] = [conv_id]
        if out:
            yield _batches(out, _RESULT)


def trie(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256): one row for each distinct prefix of conversations (conv_id, turns)."""
    spark = conversations.sparkSession
    ship_package(spark)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    passed = cut(_blocks(conversations).mapInArrow(_pass, _PASS))
    kind = lambda k: passed.where(F.col("kind") == k)
    numbers = ("n", "least", "total", "fresh", "leaves", "kids", "chars")
    # one row of numbers for each block
    blocks = kind(BLOCK).select("block", "depth", *numbers).orderBy("block").collect()
    floors = [r["depth"] for r in blocks]

    opened = cut(_closed(kind(OPEN).select("block", "start", "depth", *numbers, "ends"), blocks)) if blocks else kind(OPEN).select("block", "start", "depth", *numbers, "ends", F.lit(None).cast("int").alias("closing"))
    closing = kind(CLOSE).select(F.col("block").alias("closing"), "depth", *[F.col(c).alias(f"more_{c}") for c in numbers if c != "chars"])
    more = lambda c: F.col(c) + F.coalesce(F.col(f"more_{c}"), F.lit(0))
    opened = opened.join(closing, ["closing", "depth"], "left").withColumns({c: F.least(c, f"more_{c}") if c == "least" else more(c) for c in numbers if c != "chars"})

    # the path at a block's first conversation: the nodes that began before and go on there
    upto = F.when(F.col("more_n") > 0, F.col("closing")).otherwise(F.coalesce(F.col("closing"), F.lit(len(floors))) - 1)
    paths = opened.select(F.col("least").alias("conv_id"), "depth", (F.col("block") + 1).alias("from"), upto.alias("upto")).where(F.col("from") <= F.col("upto"))
    paths = paths.select(F.explode(F.sequence("from", "upto")).alias("block"), F.lit(None).cast("long").alias("start"), "depth", F.lit(0).alias("node"), "conv_id", *_empty("n", "kids", "leaves", "saved"), F.lit(None).cast("string").alias("ends"))

    def earlier(blocks_: pa.Array, depths: pa.Array) -> list[int]:
        return [max(k for k in range(b) if floors[k] < d) for b, d in zip(blocks_.to_pylist(), depths.to_pylist(), strict=True)]

    def begun(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(earlier(batch.column(0), batch.column(1)), pa.int32()), *batch.columns[1:]], ["block", "depth", "at", "ends"])

    pieces = kind(ENDS)
    here = pieces.where("start is not null").select("block", "start", "depth", "at", "ends")
    later = pieces.where("start is null").select("block", "depth", "at", "ends").mapInArrow(begun, "block int, depth long, at long, ends string")
    later = later.join(opened.select("block", "depth", "start"), ["block", "depth"]).select("block", "start", "depth", "at", "ends")
    sorted_pieces = here.unionByName(later).repartition(parts, "start", "depth").sortWithinPartitions("start", "depth", "at").select("block", "start", "depth", "ends")
    lists = sorted_pieces.mapInArrow(_hashed, "block int, start long, depth long, ends string")
    lists = lists.select("block", "start", "depth", F.lit(0).alias("node"), *_empty("conv_id", "n", "kids", "leaves", "saved"), "ends")

    saved = F.col("total") - F.col("fresh") - F.col("n") * F.col("chars")
    columns = ["block", "start", "depth", F.lit(1).alias("node"), F.col("least").alias("conv_id"), "n", "kids", "leaves", saved.alias("saved"), "ends"]
    nodes = kind(NODE).select(*columns).unionByName(opened.select(*columns)).unionByName(paths).unionByName(lists)
    return nodes.repartition(parts, "block").sortWithinPartitions("block", F.col("start").asc_nulls_first(), "depth", "node").mapInArrow(_parents, _RESULT)


def _empty(*names: str) -> list[Column]:
    return [F.lit(None).cast("long").alias(name) for name in names]


def report(turns: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return trie(rebuilt(sequences(turns)))


#: The same by grouping all prefixes; the checksum by its definition: a table made from the polynomial, and a fold over the bytes.
ORACLE_SQL = r"""
WITH RECURSIVE steps(i, k, v) AS (
  SELECT i, 0, i FROM range(256) r(i) UNION ALL SELECT i, k + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM steps WHERE k < 8
), tab AS (SELECT list(v ORDER BY i) AS t FROM steps WHERE k = 8
), t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS x,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), x) AS k FROM conversations WHERE conv_id IS NOT NULL
), h AS (
  SELECT conv_id, conv_id - conv_id % 100 AS first, xor(list_reduce(list_transform(regexp_extract_all(hex(encode(conv_id::VARCHAR)), '..'), lambda h: CAST('0x' || h AS BIGINT)), lambda acc, b: xor(acc // 256, t[xor(acc % 256, b) + 1]), 4294967295), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM t) CROSS JOIN tab
), s AS (
  SELECT h.conv_id, 0 AS part, k, x, text FROM h JOIN t ON t.conv_id = h.first AND k <= h.h UNION ALL SELECT h.conv_id, 1, k, x, text FROM h JOIN t ON t.conv_id = h.conv_id AND k > h.h
), z AS (
  SELECT conv_id, row_number() OVER w AS d, length(text) AS len, string_agg(x, '') OVER w AS key FROM s WINDOW w AS (PARTITION BY conv_id ORDER BY part, k) UNION ALL SELECT conv_id, 0, 0, '' FROM h
), m AS (SELECT key, d, min(conv_id) AS conv_id, count(*) AS n, any_value(len) AS len FROM z GROUP BY key, d
), ends AS (SELECT key, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends FROM (SELECT * FROM z QUALIFY d = max(d) OVER (PARTITION BY conv_id)) GROUP BY key
), kids AS (SELECT left(key, length(key) - 64) AS key, count(*) AS kids FROM m WHERE d > 0 GROUP BY ALL
), o AS (SELECT m.*, coalesce(kids, 0) AS kids, coalesce(ends, sha256('')) AS ends FROM m LEFT JOIN kids USING (key) LEFT JOIN ends USING (key)
), below AS (SELECT left(key, 64 * up) AS key, count(*) FILTER (kids = 0) AS leaves, sum((n - 1) * len) AS saved FROM (SELECT *, unnest(range(d + 1)) AS up FROM o) GROUP BY ALL
)
SELECT o.conv_id, o.d AS depth, p.conv_id AS parent_conv_id, o.n AS n_convs, o.kids AS n_children, b.leaves AS n_leaves, b.saved::BIGINT AS saved_tokens, o.ends AS ends_sha256
FROM o JOIN below b ON b.key = o.key LEFT JOIN m p ON o.d > 0 AND p.key = left(o.key, length(o.key) - 64)
"""
