"""Benchmark decontamination: CGK walks, repeated bit sampling over windows of items, exact edit verification.

Texts and items are normalised (lower case, runs of other characters than letters and digits to one
space). An item of n characters is in a document if some stretch of it is at most floor(MAX_RATIO * n)
edits away. The space before and after an item counts where the item's edge is in a script that is written
with spaces, so a short item must stand there as words, and one of a script without spaces need not.

Candidates: a window is embedded by the CGK random walk. At each step the current character is written and
the walk moves on or stays by a random bit of (step, character), which turns a small edit distance into a
small Hamming distance. The walk is hashed on several samples of its steps; windows with an equal hash are
candidates. The walk's length goes with the item's (CLASSES). All windows that begin anywhere in an item are
entered; in documents a window begins at every STRIDE-th character of the class, whatever stands there. So
every copy of an item meets several windows in any script, and neither words nor exact first characters
matter. A walk over a whole long item was tried first: after a few edits it does not find back, so walks see
at most about 20 characters and a long item has more of them.

Verification: the places that candidates of one item point to are widened by the allowed edits, overlapping
ones are joined, and an exact bit-parallel alignment finds every stretch within the bound there.

The items are streamed to the tasks in blocks of at most BLOCK_BYTES; each block is one scan of the
documents without a shuffle, and the driver holds two blocks at most. Null and empty texts hold nothing;
items that are null or have no letter or digit match nothing; equal items are all reported. Rows are judged
one by one, so repeated rows, null ids and other columns do no harm. An empty benchmark or table gives no
hits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.worker_tables import claim
from quillspark.session import cut, ship_package

MAX_RATIO = 0.1


@dataclass(frozen=True)
class Class:
    """Steps of a walk, sampled steps of a hash, hashes of a walk, and the stride of the windows in documents."""

    steps: int
    sample: int
    repeats: int
    stride: int

    @property
    def reach(self) -> int:
        """Characters that a walk is expected to see, with some reserve."""
        return max(1, self.steps // 2 + self.steps // 8)


#: An item takes the first class whose steps are at most two thirds of its length, or the last one.
CLASSES = (Class(60, 12, 5, 5), Class(40, 12, 5, 5), Class(20, 8, 4, 2), Class(10, 7, 3, 1), Class(4, 4, 1, 1), Class(2, 2, 1, 1), Class(1, 1, 1, 1))
#: Bytes of items that one scan of the documents carries.
BLOCK_BYTES = 16 << 20
#: Characters that are normalised and embedded together, and windows that are.
PORTION, WINDOWS = 2_000_000, 1 << 14
#: Scripts that are written without spaces.
UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))
SPACE = 32

@lru_cache
def _wordly() -> np.ndarray:
    return np.array([chr(i).isalnum() for i in range(0x110000)])


def normalised(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, origin, starts): the texts one after another, the place of each code in its joined source, and where each text's codes begin."""
    lowered = [t.lower() if len(t.lower()) == len(t) else "".join(c.lower() if len(c.lower()) == 1 else c for c in t) for t in texts]
    codes = np.frombuffer(" ".join(lowered).encode("utf-32-le", "surrogatepass") + b" \0\0\0", np.uint32)
    wordly = _wordly()[codes]
    keep = wordly.copy()
    keep[1:] |= wordly[:-1]
    origin = np.flatnonzero(keep)
    begins = np.cumsum([0, *[len(t) + 1 for t in texts]])
    return np.where(wordly, codes, 32)[origin].astype(np.uint32), origin, np.searchsorted(origin, begins)


@lru_cache
def _walk_values() -> np.ndarray:
    """A random 64-bit value of each character class: its bits are the walk's moves, and it stands for the character in hashes."""
    return np.random.default_rng(7).integers(0, 2**64, 4096, np.uint64)


@lru_cache
def _samples(kind: Class) -> list[list[tuple[int, np.uint64]]]:
    """For each repeat the sampled steps, each with an odd factor."""
    rng = np.random.default_rng(kind.steps)
    return [
        [(int(step), np.uint64(rng.integers(1, 2**63)) * np.uint64(2) + np.uint64(1)) for step in sorted(rng.choice(kind.steps, kind.sample, replace=False))] for _ in range(kind.repeats)
    ]


def _walk(values: np.ndarray, at: np.ndarray, steps: int) -> list[np.ndarray]:
    """What the walk of each window writes, step by step; a shorter walk is the beginning of a longer one."""
    place = at.astype(np.int64)
    seen = []
    for step in range(steps):
        seen.append(values[place])
        place += ((seen[-1] >> np.uint64(step)) & np.uint64(1)).view(np.int64)
    return seen


def _hashes(seen: list[np.ndarray], kind: Class) -> np.ndarray:
    """(repeats, windows): the hashes of the sampled steps of each window's walk."""
    out = np.empty((kind.repeats, len(seen[0])), np.uint64)
    for r, chosen in enumerate(_samples(kind)):
        total = np.full(len(seen[0]), r + 1, np.uint64)
        for step, factor in chosen:
            total += seen[step] * factor
        total ^= total >> np.uint64(29)
        out[r] = total * np.uint64(0x9E3779B97F4A7C15)
    return out


def _spaced(code: int) -> bool:
    return not any(a <= code <= b for a, b in UNSPACED)


def pattern_of(codes: np.ndarray) -> np.ndarray:
    """A normalised item with the spaces that count."""
    before = [SPACE] if len(codes) and _spaced(int(codes[0])) else []
    after = [SPACE] if len(codes) and _spaced(int(codes[-1])) else []
    return np.concatenate([np.array(before, np.uint32), codes, np.array(after, np.uint32)])


class _Table:
    """The windows of the items of one class: hashes in order, the item and the offset of each."""

    def __init__(self, kind: Class, patterns: dict[int, np.ndarray]):
        self.kind = kind
        gap = np.full(kind.steps, SPACE, np.uint32)
        codes = np.concatenate([x for p in patterns.values() for x in (p, gap)])
        sizes = np.array([len(p) for p in patterns.values()])
        begins = np.cumsum([0, *(sizes + kind.steps)])[:-1]
        counts = np.maximum(sizes - kind.reach + 1, 1)
        owner = np.repeat(np.array(list(patterns)), counts)
        offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        at = np.repeat(begins, counts) + offset
        values = _walk_values()[codes & 4095]
        hashes = np.concatenate([_hashes(_walk(values, at[k : k + WINDOWS], kind.steps), kind) for k in range(0, len(at), WINDOWS)], axis=1)
        order = np.argsort(hashes, axis=None, kind="stable")
        self.hashes = hashes.reshape(-1)[order]
        which = order % len(at)
        self.owner, self.offset = owner[which].astype(np.int32), offset[which].astype(np.int32)
        bits = max(10, int(8 * len(order)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.known = np.zeros(1 << bits, bool)
        self.known[(self.hashes >> self.shift).astype(np.int64)] = True

    def candidates(self, at: np.ndarray, seen: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(item, begin) of each item that one of the windows points to."""
        hashes = _hashes(seen, self.kind)
        row, column = np.nonzero(self.known[(hashes >> self.shift).view(np.int64)])
        own = hashes[row, column]
        first, last = np.searchsorted(self.hashes, own, "left"), np.searchsorted(self.hashes, own, "right")
        times = last - first
        entry = np.repeat(first, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        return self.owner[entry], np.repeat(at[column], times) - self.offset[entry]


class Index:
    """The items of a block."""

    def __init__(self, items: list[tuple[int, str]]):
        codes, _, starts = normalised([t for _, t in items])
        bare = [codes[a:b] for a, b in zip(starts[:-1], starts[1:], strict=True)]
        bare = [x[:-1] if len(x) and x[-1] == SPACE else x for x in bare]
        self.ids = [i for i, _ in items]
        self.slack = [int(MAX_RATIO * len(x)) for x in bare]
        self.items = [pattern_of(x) for x in bare]
        by_class: dict[Class, dict[int, np.ndarray]] = {}
        for k, x in enumerate(self.items):
            if len(x):
                kind = next((c for c in CLASSES if 3 * c.steps <= 2 * len(x)), CLASSES[-1])
                by_class.setdefault(kind, {})[k] = x
        #: stride -> the tables of its classes, which share their walks
        self.tables: dict[int, list[_Table]] = {}
        for kind, patterns in by_class.items():
            self.tables.setdefault(kind.stride, []).append(_Table(kind, patterns))
        self.masks: dict[int, tuple[dict[int, int], dict[int, int]]] = {}
        self.grams = [np.unique(_grams(x), return_counts=True) for x in self.items]

    def _near(self, k: int, grams: np.ndarray) -> bool:
        """Whether enough of the item's 3-grams stand there: an edit spoils at most three of them."""
        own, counts = self.grams[k]
        needed = len(self.items[k]) - 2 - 3 * self.slack[k]
        if needed <= 0 or not len(own):
            return True
        at = np.minimum(np.searchsorted(own, grams), len(own) - 1)
        there = np.zeros(len(own), bool)
        there[at[own[at] == grams]] = True
        return int(counts[there].sum()) >= needed

    def _aligned(self, k: int, codes: np.ndarray, grams: np.ndarray, low: int, high: int) -> Iterator[tuple[int, int, int]]:
        """(start, end, distance) of the disjoint stretches within the bound, the best first, then those beside it."""
        size, slack = len(self.items[k]), self.slack[k]
        if k not in self.masks:
            self.masks[k] = _pattern(self.items[k]), _pattern(self.items[k][::-1])
        left = [(low, high)]
        while left:
            low, high = left.pop()
            if high - low < size - slack or not self._near(k, grams[low : high - 2]):
                continue
            distance, end = _best(self.masks[k][0], size, codes[low:high])
            if distance <= slack:
                _, back = _best(self.masks[k][1], size, codes[low : low + end][::-1])
                start, end = low + end - back, low + end
                yield start, end, distance
                # neighbours may share the space between them
                left += [(low, start + int(codes[start] == SPACE)), (end - int(codes[end - 1] == SPACE), high)]

    def _candidates(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, begin) of the places where an item may stand; for an item that allows no edit, those where it does."""
        values = _walk_values()[np.concatenate([codes, np.full(CLASSES[0].steps, SPACE, np.uint32)]) & 4095]
        found = [(np.zeros(0, np.int32), np.zeros(0, np.int64))]
        for stride, tables in self.tables.items():
            every, steps = np.arange(0, len(codes), stride), max(t.kind.steps for t in tables)
            for k in range(0, len(every), WINDOWS):
                at = every[k : k + WINDOWS]
                seen = _walk(values, at, steps)
                found += [t.candidates(at, seen) for t in tables]
        item, begin = (np.concatenate(x) for x in zip(*found, strict=True))
        keep = np.ones(len(item), bool)
        exact = np.flatnonzero(np.array(self.slack)[item] == 0) if len(item) else item
        for k in np.unique(item[exact]).tolist():  # equality is seen at once for all places
            own = exact[item[exact] == k]
            fits = (begin[own] >= 0) & (begin[own] + len(self.items[k]) <= len(codes))
            for j, c in enumerate(self.items[k].tolist()):
                fits &= codes[np.clip(begin[own] + j, 0, len(codes) - 1)] == c
            keep[own] = fits
        return item[keep], begin[keep]

    def find(self, texts: list[str]) -> Iterator[tuple[int, int, int, int, int]]:
        """(text number, item id, start, end, distance) of the hits, in code points of the text, end exclusive."""
        codes, origin, starts = normalised(texts)
        begins = np.cumsum([0, *[len(t) + 1 for t in texts]])
        # a space ahead of the first text, as there is one after each
        codes, origin, starts = np.concatenate([[SPACE], codes]).astype(np.uint32), np.concatenate([[0], origin]), starts + 1
        item, begin = self._candidates(codes)
        if not len(item):
            return
        grams = _grams(codes)
        sizes, slacks = np.array([len(x) for x in self.items]), np.array(self.slack)
        middle = np.clip(begin + sizes[item] // 2, 0, len(codes) - 1)
        doc = np.maximum(np.searchsorted(starts, middle, "right") - 1, 0)
        margin = slacks[item] + 2
        low = np.maximum(begin - margin, starts[doc] - 1)
        high = np.minimum(begin + sizes[item] + margin, starts[np.minimum(doc + 1, len(texts))])
        order = np.lexsort((low, item, doc))
        joined: list[list[int]] = []
        for d, k, a, b in zip(doc[order].tolist(), item[order].tolist(), low[order].tolist(), high[order].tolist(), strict=True):
            if joined and joined[-1][:2] == [d, k] and a <= joined[-1][3]:
                joined[-1][3] = max(b, joined[-1][3])
            else:
                joined.append([d, k, a, b])
        for d, k, a, b in joined:
            for start, end, distance in self._aligned(k, codes, grams, a, b):
                start, end = start + int(codes[start] == SPACE), end - int(codes[end - 1] == SPACE)
                yield d, self.ids[k], int(origin[start] - begins[d]), int(origin[end - 1] + 1 - begins[d]), distance


def _grams(codes: np.ndarray) -> np.ndarray:
    wide = codes.astype(np.int64)
    return (wide[:-2] << 42) | (wide[1:-1] << 21) | wide[2:]


def _pattern(item: np.ndarray) -> dict[int, int]:
    masks: dict[int, int] = {}
    for i, c in enumerate(item.tolist()):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def _best(masks: dict[int, int], size: int, codes: np.ndarray) -> tuple[int, int]:
    """(edits, end) of the cheapest alignment of the whole item with some stretch of the codes."""
    if not size:
        return 1, 0
    full, last = (1 << size) - 1, 1 << size - 1
    up, down, distance, best, end = full, 0, size, size, 0
    for at, c in enumerate(codes.tolist(), 1):
        eq = masks.get(c, 0)
        d0 = (((eq & up) + up) ^ up) | eq | down
        plus, minus = down | ~(d0 | up) & full, up & d0
        if plus & last:
            distance += 1
        elif minus & last:
            distance -= 1
        plus, minus = plus << 1 & full, minus << 1 & full
        up, down = minus | ~(d0 | plus) & full, plus & d0
        if distance < best:
            best, end = distance, at
    return best, end


def _blocks(items: DataFrame) -> Iterator[tuple[list[tuple[int, str]], bool]]:
    """The items in blocks of BLOCK_BYTES, one after another, each with whether it is the last."""
    ahead, block, size = None, [], 0
    for row in items.select(F.col("item_id").cast("long"), "text").where("text is not null").orderBy("item_id", "text").toLocalIterator():
        if size and size + len(row[1]) * 4 > BLOCK_BYTES:
            if ahead:
                yield ahead, False
            ahead, block, size = block, [], 0
        block.append((row[0], row[1]))
        size += len(row[1]) * 4
    if ahead:
        yield ahead, False
    yield block, True


def _portions(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[str]]]:
    first, some, size = 0, [], 0
    for k, text in enumerate(batch.column(column)):
        some.append(text.as_py() or "")
        size += len(some[-1])
        if size >= PORTION:
            yield first, some
            first, some, size = k + 1, [], 0
    if some:
        yield first, some


_INDEXES: dict[int, Index] = {}


def _index(name: int, items: list[tuple[int, str]]) -> Index:
    """The last index of this worker is kept for its next task."""
    claim("decontaminate", _INDEXES)
    if name not in _INDEXES:
        _INDEXES.clear()
        _INDEXES[name] = Index(items)
    return _INDEXES[name]


def hits(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, start, end, distance) of each place of a text that holds an item."""
    ship_package(docs.sparkSession)
    rows, out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), None
    for block, last in _blocks(items):
        name = hash(tuple(block))

        def run(batches: Iterator[pa.RecordBatch], block=block, name=name) -> Iterator[pa.RecordBatch]:
            index = _index(name, block)
            for batch in batches:
                ids = batch.column(0).to_pylist()
                found = [(ids[first + d], *rest) for first, texts in _portions(batch, 1) for d, *rest in index.find(texts)]
                columns = list(zip(*found, strict=True)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "item_id", "start", "end", "distance"])

        part = rows.mapInArrow(run, "doc_id long, item_id long, start long, end long, distance long")
        # one block is one plan; of several, each is computed before the next one is fetched
        part = part if last and out is None else cut(part)
        out = part if out is None else out.unionByName(part)
    return out


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, places, distance): each contaminated document and item, with the least number of edits."""
    return hits(docs, items).groupBy("doc_id", "item_id").agg(F.count("*").alias("places"), F.min("distance").alias("distance"))


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of docs, all columns, whose text holds no item. No shuffle."""
    ship_package(docs.sparkSession)
    column = docs.columns.index("text")
    for block, last in _blocks(items):
        name = hash(tuple(block))

        def run(batches: Iterator[pa.RecordBatch], block=block, name=name) -> Iterator[pa.RecordBatch]:
            index = _index(name, block)
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for first, texts in _portions(batch, column):
                    keep[[first + d for d, *_ in index.find(texts)]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
        docs = docs if last else cut(docs)
    return docs
