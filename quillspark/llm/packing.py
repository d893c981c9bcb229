"""Packing: the token ids of whole documents into windows of at most 1024, by online sums of squares.

A document's ids and the end id are cut at multiples of the capacity; what fills a window whole is one. The
rest goes where the sum, over the fill levels, of the squared counts of open windows becomes least: into an
open window of the level that says so, or into a new one. A level array holds the counts. A window that is
full is given out. Equal changes go to the fullest level.

A task packs its own split of the table, so nothing is shuffled; it holds at most OPEN_WINDOWS open windows.
Beyond that a document's rest is cut to fill the fullest one, however many documents have one length. What is
still open at a task's end is joined in the order of its fill, cut into full windows, and the last stretch
into lengths that are powers of two. So no window is padded.

Null texts count as empty and have the end id only. Null doc_ids and repeated rows are packed like any
other. An empty table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.token_files import encoded, encoder, tokenizer_path
from quillspark.session import ship_package

CAPACITY = 1024
#: Open windows that a task holds; one is at most 4 KB of ids.
OPEN_WINDOWS = 4096
#: Rows and bytes of ids after which a task hands on a batch.
BATCH_ROWS, BATCH_BYTES = 10_000, 4 << 20
#: A task numbers its windows from its partition's number times this.
WINDOWS_PER_TASK = 1 << 33
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"

#: doc_id, the document's ids in all, ids before the piece, the piece's ids.
Piece = tuple[int | None, int, int, np.ndarray]


class Packer:
    """The open windows of one task, by fill level."""

    def __init__(self, capacity: int = CAPACITY, most_open: int = OPEN_WINDOWS):
        self.capacity, self.most_open, self.n_open = capacity, most_open, 0
        self.counts = np.zeros(capacity + 1, np.int64)
        self.windows: list[list[list[Piece]]] = [[] for _ in range(capacity)]

    def level(self, size: int) -> int:
        """The level that an item of a size goes to; 0 is a new window."""
        counts, last = self.counts, self.capacity - size
        change = 2 * counts[size:] - 2 * counts[: last + 1] + 2
        change[counts[: last + 1] == 0] = np.iinfo(np.int64).max
        if counts[last]:  # the window closes: its square goes and no other comes
            change[last] = 1 - 2 * counts[last]
        change[0] = 2 * counts[size] + 1
        return int(last - np.argmin(change[::-1]))

    def put(self, piece: Piece, level: int) -> list[Piece] | None:
        """Place a piece; the window, if it is full now."""
        window: list[Piece] = []
        if level:
            window = self.windows[level].pop()
            self.counts[level] -= 1
            self.n_open -= 1
        window.append(piece)
        level += len(piece[3])
        if level == self.capacity:
            return window
        self.windows[level].append(window)
        self.counts[level] += 1
        self.n_open += 1
        return None

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[list[Piece]]:
        """Pack one document; the windows that are full."""
        start, n = len(ids) // self.capacity * self.capacity, len(ids)
        for at in range(0, start, self.capacity):
            yield [(doc_id, n, at, ids[at : at + self.capacity])]
        while start < n:
            size = n - start
            level = self.level(size) if self.n_open < self.most_open else int(np.flatnonzero(self.counts)[-1])
            size = min(size, self.capacity - level)
            full = self.put((doc_id, n, start, ids[start : start + size]), level)
            start += size
            if full:
                yield full

    def rest(self) -> Iterator[list[Piece]]:
        """The open windows' pieces, cut anew: full windows, then powers of two."""
        pieces = [piece for level in reversed(self.windows) for window in level for piece in window]
        left = sum(len(piece[3]) for piece in pieces)
        window: list[Piece] = []
        room = 0
        for doc_id, n, start, ids in pieces:
            while len(ids):
                if not room:
                    room = self.capacity if left >= self.capacity else 1 << (left.bit_length() - 1)
                    left -= room
                window.append((doc_id, n, start, ids[:room]))
                start, ids, room = start + len(ids[:room]), ids[room:], room - len(ids[:room])
                if not room:
                    yield window
                    window = []


def pack(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, most_open: int = OPEN_WINDOWS) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset): every piece, its ids as little-endian unsigned 32-bit integers.

    The capacity is a power of two. A sequence_id is given once in the whole result, with gaps between tasks.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("the capacity is no power of two")
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, packer = encoder(path or tokenizer_path()), Packer(capacity, most_open)
        names = [field.split()[0] for field in SCHEMA.split(", ")]
        number = TaskContext.get().partitionId() * WINDOWS_PER_TASK
        rows: list[tuple] = []

        doc_ids: deque[int | None] = deque()

        def texts() -> Iterator[str]:
            for batch in batches:
                doc_ids.extend(batch.column(0).to_pylist())
                for text in batch.column(1):
                    yield text.as_py() or ""

        def windows() -> Iterator[list[Piece]]:
            for document in encoded(texts(), encode):
                yield from packer.add(doc_ids.popleft(), document.astype("<u4"))
            yield from packer.rest()

        def batch() -> pa.RecordBatch:
            kinds = [pa.binary() if name == "ids" else pa.int64() for name in names]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        held = 0
        for window in windows():
            offset = 0
            for doc_id, n, start, ids in window:
                rows.append((doc_id, start, len(ids), ids.tobytes(), n, number, offset))
                offset += len(ids)
            number += 1
            held += offset * 4
            if len(rows) >= BATCH_ROWS or held >= BATCH_BYTES:
                yield batch()
                rows, held = [], 0
        if rows:
            yield batch()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, ids, doc_starts): the windows themselves, one row each, with the offsets at which pieces begin.

    A group is one window, so it is bounded by the capacity.
    """
    ordered = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate("parts", F.lit(b""), lambda ids, part: F.concat(ids, part["ids"]))
    held = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), ordered.alias("parts"))
    return held.select("sequence_id", "n_tokens", joined.alias("ids"), F.transform("parts", lambda part: part["offset"]).alias("doc_starts"))


def report(docs: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pack(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
