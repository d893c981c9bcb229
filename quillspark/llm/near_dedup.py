"""Near-duplicates: one-permutation MinHash, banded buckets, star-shaped candidate edges, exact confirmation.

1. Each text becomes its set of 5-word shingles (64-bit hashes) and one-permutation minima with optimal
   densification, of which keys are made: so many, each of so many minima, as BANDING has for the threshold. Texts with the same set are one class, which
   its least doc_id stands for.
2. Classes that share a band key form a bucket; each bucket gives the edges from its least member to the
   others (a star), so the number of candidates is linear in the size of a bucket. Each edge is confirmed on
   the full sets, and the links give components.
3. A bucket whose members are not all in one component by now may still hide a link between two members
   that are not like its centre. If more than BLOCK members of such a bucket are outside its largest
   component, CENTRES of them are further centres, compared with all members of other components (linear in
   the bucket; CENTRE_ROUNDS times), and members of which too few shingles stand in any other set are out, as they can have no
   link. What is then left is exact: the members outside the largest component are compared with all, those
   inside it not with each other. Both are cut into blocks of bounded numbers of members and shingles, and
   a pair of blocks is one task's matrix product of full sets, which writes a spanning forest of its links.

A pair at the threshold misses all bands with a chance of 1e-6; everything after the bands is exact.

Rows with one doc_id are one document that has the links of all its texts. A null doc_id cannot be a
component's id: such a row gets the component of its equals, or null. Null and empty texts, and texts
without words, have an empty set and stand alone. Only doc_id and text are read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm import shingles
from quillspark.llm.worker_tables import claim
from quillspark.operators.graph import connected
from quillspark.session import cut, ship_package

#: The threshold of op8_near_dedup.
PERCENT = 85
#: Threshold -> keys, and minima of each.
BANDING = {85: (36, 7), 80: (35, 5)}
#: Members of a block, and their shingles; a task compares two blocks.
BLOCK, BLOCK_SHINGLES = 256, 2_000_000
#: Further centres of a large open bucket in each round, and rounds.
CENTRES, CENTRE_ROUNDS = 8, 1
#: Columns of the matrices that are multiplied at once.
COLUMNS = 4096


def signatures(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, class, keys) of each row; class and keys are null for an empty set."""
    ship_package(docs.sparkSession)
    count, rows_of_band = BANDING[percent]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        claim("shingles", shingles._HASHES)
        for batch in batches:
            sizes, classes, keys = [], [], []
            for text in batch.column(1):
                hashes = shingles.shingle_set(text.as_py())
                sizes.append(len(hashes))
                classes.append(xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None)
                keys.append(shingles.bands(hashes, count, rows_of_band).view(np.int64) if len(hashes) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(classes, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "class", "keys"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n_shingles long, class binary, keys array<long>")


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(rep, shingles) of the wanted documents, from their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("shingles", shingles._HASHES)
        for batch in batches:
            sets = [shingles.shingle_set(t.as_py()).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["rep", "shingles"])

    rows = docs.select(F.col("doc_id").cast("long").alias("rep"), "text").join(wanted, "rep", "left_semi")
    return rows.mapInArrow(run, "rep long, shingles binary")


def _confirm(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The edges (a, b, n) that are links; n is the number of b's shingles. A hot centre's edges are dealt to copies of its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = ([np.frombuffer(x.as_py(), np.uint64) for x in batch.column(k)] for k in (2, 3))
            keep = pa.array([shingles.linked(x, y, percent) for x, y in zip(a, b, strict=True)], pa.bool_())
            yield batch.select([0, 1]).filter(keep)

    parts = edges.groupBy("a").agg(F.ceil(F.greatest(F.sum("n") / BLOCK_SHINGLES, F.count("*") / BLOCK)).cast("int").alias("parts"))
    one = parts.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).join(sets.select(F.col("rep").alias("a"), F.col("shingles").alias("a_set")), "a")
    dealt = edges.join(parts, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"))
    two = dealt.join(sets.select(F.col("rep").alias("b"), F.col("shingles").alias("b_set")), "b")
    return two.join(one, ["a", "part"]).select("a", "b", "a_set", "b_set").mapInArrow(run, "a long, b long")


def block_links(reps: np.ndarray, sets: list[np.ndarray], labels: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between the sets, beyond the components that the labels give."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    columns, where = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(n), sizes)
    shared = np.bincount(where, minlength=len(columns)) > 1
    keep = shared[where]
    row, where = row[keep], (np.cumsum(shared) - 1)[where[keep]]
    order = np.argsort(where, kind="stable")
    row, where = row[order], where[order]
    both = np.zeros((n, n), np.float32)
    for begin in range(0, int(shared.sum()), COLUMNS):
        a, b = np.searchsorted(where, [begin, begin + COLUMNS])
        part = np.zeros((n, COLUMNS), np.float32)
        part[row[a:b], where[a:b] - begin] = 1
        both += part @ part.T
    both = both.astype(np.int64)
    hit = 100 * both >= percent * (sizes[:, None] + sizes[None, :] - both)
    parent = {}

    def root(x: int) -> int:
        while parent.get(x, x) != x:
            parent[x] = x = parent.get(parent[x], parent[x])
        return x

    out = []
    for i, j in np.argwhere(np.triu(hit, 1) & (labels[:, None] != labels[None, :])).tolist():
        x, y = root(int(labels[i])), root(int(labels[j]))
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append((int(reps[i]), int(reps[j])))
    return out


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    return members.join(labels, members.rep == labels.node, "left").select("key", "rep", "n", F.coalesce("label", "rep").alias("label"))


def _open_buckets(labelled: DataFrame) -> DataFrame:
    """(key, main, inside, inside_n, outside, outside_n) of each bucket of several components: the label of the largest, and members and shingles in and outside it.

    Of buckets with the same members one is given.
    """
    by_label = labelled.groupBy("key", "label").agg(
        F.count("*").alias("m"), F.sum("n").alias("n"), F.bit_xor(F.xxhash64("rep")).alias("x"), F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("y")
    )
    by_key = by_label.groupBy("key").agg(
        F.max(F.struct("m", (-F.col("label")).alias("back"), "n")).alias("top"), F.sum("m").alias("m"), F.sum("n").alias("n"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"), F.count("*").alias("labels")
    )
    kept = by_key.where("labels > 1").groupBy("m", "x", "y").agg(F.min(F.struct("key", "top", "n")).alias("b"))
    return kept.select(
        "b.key", (-F.col("b.top.back")).alias("main"), F.col("b.top.m").alias("inside"), F.col("b.top.n").alias("inside_n"), (F.col("m") - F.col("b.top.m")).alias("outside"), (F.col("b.n") - F.col("b.top.n")).alias("outside_n")
    )


def _further_edges(labelled: DataFrame, buckets: DataFrame, turn: int, percent: int) -> DataFrame:
    """Edges (a, b, n) from CENTRES members outside the largest component of each bucket to all members of other components."""
    here = labelled.join(buckets.select("key", "main"), "key")
    draw = F.struct(F.xxhash64("rep", F.lit(turn)).alias("draw"), "rep", "n", "label")
    # the least few of each bucket, by partial aggregation: one for each of CENTRES groups of hashes
    lot = F.pmod(F.xxhash64("rep", F.lit(-turn)), F.lit(CENTRES))
    centres = here.where("label <> main").groupBy("key", lot.alias("lot")).agg(F.min(draw).alias("c")).select("key", F.col("c.rep").alias("a"), F.col("c.n").alias("a_n"), F.col("c.label").alias("a_label"))
    alike = (F.col("rep") != F.col("a")) & (F.col("label") != F.col("a_label")) & (100 * F.least("n", "a_n") >= percent * F.greatest("n", "a_n"))
    return here.join(centres, "key").where(alike).select("a", F.col("rep").alias("b"), "n").distinct()


def _hopeless(reps: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(rep) of sets of which fewer than percent of the shingles stand in any other of the sets."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rep, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = np.frombuffer(data, np.int64)
                for k in range(0, len(own), 100_000):
                    part = own[k : k + 100_000]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), rep)), pa.array(part)], names=["rep", "shingle"])

    rows = cut(sets.join(reps.select("rep").distinct(), "rep", "left_semi").mapInArrow(spread, "rep long, shingle long"))
    alone = rows.groupBy("shingle").agg(F.count("*").alias("holders"), F.min("rep").alias("rep")).where("holders = 1").groupBy("rep").agg(F.count("*").alias("alone"))
    sizes = rows.groupBy("rep").agg(F.count("*").alias("n"))
    return sizes.join(alone, "rep").where(100 * (F.col("n") - F.col("alone")) < percent * F.col("n")).select("rep")


def _rest(labelled: DataFrame, buckets: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between the components of the open buckets."""

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        if group["label"].nunique() < 2:
            found = []
        else:
            found = block_links(group["rep"].to_numpy(), [np.frombuffer(x, np.uint64) for x in group["shingles"]], group["label"].to_numpy(), percent)
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    def blocks(rows: str, size: str) -> Column:
        return F.ceil(F.greatest(F.col(rows) / BLOCK, F.col(size) / BLOCK_SHINGLES)).cast("int")

    small = (F.col("inside") + F.col("outside") <= BLOCK) & (F.col("inside_n") + F.col("outside_n") <= BLOCK_SHINGLES)
    cuts = buckets.select("key", "main", small.alias("small"), F.when(small, 1).otherwise(blocks("outside", "outside_n")).alias("outer"), F.when(small, 0).otherwise(blocks("inside", "inside_n")).alias("inner"))
    # blocks 0 to outer - 1 are outside the largest component; each is compared with all, the later ones only with these
    inside = ~F.col("small") & (F.col("label") == F.col("main"))
    lot = F.xxhash64("rep", F.lit(2))
    own = F.when(inside, F.col("outer") + F.pmod(lot, F.col("inner"))).otherwise(F.pmod(lot, F.col("outer"))).cast("int")
    others = F.sequence(F.lit(0), F.when(inside, F.col("outer")).otherwise(F.col("outer") + F.col("inner")) - 1)
    dealt = labelled.join(cuts, "key").withColumn("own", own).withColumn("other", F.explode(others)).select("key", "rep", "label", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    return dealt.join(sets, "rep").groupBy("key", "i", "j").applyInPandas(run, "a long, b long")


def components(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row; percent is a key of BANDING."""
    found = cut(signatures(docs, percent))
    classes = found.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("keys").alias("keys"))
    banded = classes.where("rep is not null").select("rep", "n", F.explode("keys").alias("key"))
    centres = banded.groupBy("key").agg(F.min(F.struct("rep", "n")).alias("centre"), F.count("*").alias("size")).where("size > 1").select("key", "centre")
    members = cut(banded.join(centres, "key").select("key", "rep", "n", F.col("centre.rep").alias("centre"), F.col("centre.n").alias("centre_n")))
    alike = (F.col("rep") != F.col("centre")) & (100 * F.least("n", "centre_n") >= percent * F.greatest("n", "centre_n"))
    edges = members.where(alike).select(F.col("centre").alias("a"), F.col("rep").alias("b"), "n").distinct()
    sets = cut(_sets(docs, members.select("rep").distinct()))
    links = cut(_confirm(edges, sets, percent))
    members = members.select("key", "rep", "n")
    for turn in range(CENTRE_ROUNDS + 1):
        labels = connected(links)
        labelled = _labelled(members, labels)
        buckets = cut(_open_buckets(labelled))
        large = buckets.where(F.col("outside") > BLOCK)
        if large.isEmpty():
            break
        if turn == CENTRE_ROUNDS:
            held = labelled.join(large.select("key"), "key", "left_semi").select("key", "rep")
            gone = cut(held.join(_hopeless(held, sets, percent), "rep").select("key", "rep"))
            labelled = labelled.join(gone, ["key", "rep"], "left_anti")
            buckets = cut(_open_buckets(labelled))
        else:
            links = cut(links.unionByName(_confirm(_further_edges(labelled, large, turn + 1, percent), sets, percent)).distinct())
    labels = connected(links.unionByName(cut(_rest(labelled, buckets, sets, percent))))
    by_class = classes.select("class", "rep").join(labels, F.col("rep") == F.col("node"), "left").select("class", F.coalesce("label", "rep").alias("label"))
    return (
        found.select("doc_id", "n_shingles", "class")
        .join(by_class, "class", "left")
        .withColumn("component_id", F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("label")))
        .select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
    )


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of docs, all columns, of which one document of each component stays; repeated rows go to one.

    Rows without a doc_id cannot be named by a component and only go where another row repeats them.
    """
    judged = components(docs, percent).select("doc_id", "kept")
    gone = judged.where("doc_id is not null and not kept").select("doc_id").distinct()
    # the side of ids is hashed, so the texts are shuffled once and need no sort
    stays = docs.join(gone.hint("shuffle_hash"), docs["doc_id"] == gone["doc_id"], "left_anti")
    repeated = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    return stays if repeated.isEmpty() else stays.dropDuplicates(["doc_id", "text"])
