"""Token ids in flat binary files.

Layout of a folder: for each sorted range of doc_id one `part-*.bin` (the ids of its documents, one after
the other, little-endian unsigned integers of 16 bits, or 32 where the vocabulary needs them) and one
`part-*.idx` (64-bit integers: magic, id width, number of documents, number of null doc_ids, the doc_ids,
offsets of the documents in ids, one more for the end). The manifest has a row for each part: its file, its ids, its
documents and its base, the prefix sum of the ids of the parts before it. Readers map the files into memory.

A part's name holds the attempt that wrote it and only parts named in the manifest are read, so a task
that is run again after the loss of an executor leaves at most an unused file.

Null texts count as empty and get the end id only. Null doc_ids sort first; a part's header says how many
it has, and their places in the list of doc_ids hold 0. Rows with equal doc_ids are ordered by their text. An empty table gives no documents.
Other columns are not read. Texts are encoded whole.
"""

from __future__ import annotations

import posixpath
import re
import sys
import uuid
import zlib
from array import array
from collections.abc import Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.llm.worker_tables import claim
from quillspark.session import cut, shared_dir, ship_package

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
MAGIC = 0x325844494B4F54
#: Entries of a task's table of distinct words; one is about 200 bytes.
TABLE_ENTRIES = 1_500_000
#: The words of the byte-level pre-tokenizer, for the characters that OTHER allows.
WORD = re.compile(r"'(?:s|t|re|ve|m|ll|d)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
#: A space that does not stand alone before a word: elsewhere a text may be cut before each space.
LOOSE = re.compile(r" (?:\s|\Z)")
#: White space that the pre-tokenizer may take together, as a space or two line ends at a text's end: other texts may be cut before each space and line end.
TOGETHER = ("\t", "\r", "  ", " \n", "\n\n\n", "\n\n ")
#: All but characters about whose classes Python and the library agree; a text with others is encoded whole.
OTHER = re.compile("[^\t\n\r -~¡-±´-¸º»¿-ɏ‐-‧]")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The printable character by which a byte-level vocabulary writes each byte."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class _Words(dict):
    """word of the pre-tokenizer -> ids as bytes of the given type."""

    def __init__(self, model: Any, kind: str):
        super().__init__()
        self.model, self.code, self.letters = model, "H" if kind == "<u2" else "I", byte_letters()
        self.plain = {b: letter for b, letter in enumerate(self.letters[:128]) if letter != chr(b)}

    def __missing__(self, word: str) -> bytes:
        spelled = word.translate(self.plain) if word.isascii() else "".join([self.letters[b] for b in word.encode()])
        self[word] = ids = array(self.code, [x.id for x in self.model.tokenize(spelled)]).tobytes()
        return ids


class _Stretches(dict):
    """What stands between two single spaces -> ids, with the space before it. Those over line ends hardly recur and aren't kept."""

    def __init__(self, words: _Words):
        super().__init__()
        self.words = words

    def __missing__(self, stretch: str) -> bytes:
        ids = b"".join(map(self.words.__getitem__, WORD.findall(" " + stretch)))
        if "\n" not in stretch:
            self[stretch] = ids
        return ids


class Encoder:
    """Whole texts to ids, as the tokenizers library gives them; its model segments each distinct word once."""

    def __init__(self, path: str, entries: int = TABLE_ENTRIES):
        import json

        import tokenizers

        self.entries = entries
        self.tokenizer = tokenizers.Tokenizer.from_file(path)
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        pre = spec["pre_tokenizer"] or {}
        self.by_word = sys.byteorder == "little" and not spec["normalizer"] and (pre.get("type"), pre.get("add_prefix_space"), pre.get("use_regex")) == ("ByteLevel", False, True)
        self.special = [x["content"] for x in spec["added_tokens"]]
        self.words = _Words(self.tokenizer.model, self.kind)
        self.stretches = _Stretches(self.words)

    def __call__(self, text: str) -> bytes:
        if not self.by_word or OTHER.search(text) or any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()
        if len(self.stretches) + len(self.words) > self.entries:
            self.stretches.clear()
            self.words.clear()
        if LOOSE.search(text):
            return b"".join(map(self.words.__getitem__, WORD.findall(text)))
        first, *rest = text.split(" ")
        return b"".join([*map(self.words.__getitem__, WORD.findall(first)), *map(self.stretches.__getitem__, rest)])

    def _loose(self, text: str) -> bool:
        """Whether a text can't be cut at its spaces and line ends."""
        return not self.by_word or any(x in text for x in TOGETHER) or text.endswith((" ", "\n\n")) or bool(OTHER.search(text)) or any(s in text for s in self.special)

    def _piece(self, piece: str) -> bytes:
        """The ids of a piece, which is in the table of words by its own text."""
        words = WORD.findall(piece)
        if len(words) == 1:
            return self.words[piece]
        found = self.words[piece] = b"".join(map(self.words.__getitem__, words))
        return found

    def many(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts, one after the other, and the offsets at which each begins, with the end.

        Pieces of texts are told apart and their ids put together by Arrow; only distinct ones are looked up.
        """
        cut = [k for k, t in enumerate(texts) if not self._loose(t)]
        flat, offsets = self._cut([texts[k] for k in cut])
        if len(cut) == len(texts):
            return flat, offsets
        ids: list[np.ndarray] = [flat[:0]] * len(texts)
        for k, a, b in zip(cut, offsets[:-1], offsets[1:], strict=True):
            ids[k] = flat[a:b]
        for k in set(range(len(texts))) - set(cut):
            ids[k] = np.frombuffer(self(texts[k]), self.kind)
        return np.concatenate(ids), np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64)

    def _cut(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if not texts:
            return np.zeros(0, self.kind), np.zeros(1, np.int64)
        marked = pa.array([t.replace(" ", "\0 ").replace("\n", "\0\n") for t in texts], pa.large_string())
        parts = pc.split_pattern(marked, "\0")
        pieces = parts.values.dictionary_encode()
        distinct = pieces.dictionary.to_pylist()
        if len(self.stretches) + len(self.words) > self.entries:
            self.stretches.clear()
            self.words.clear()
        table = self.words.get
        known = [table(p) or self._piece(p) for p in distinct]
        width = np.dtype(self.kind).itemsize
        sizes = np.array([len(x) // width for x in known], np.int64)
        each = pa.LargeListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes)]), np.frombuffer(b"".join(known), self.kind))
        flat = each.take(pieces.indices).flatten().to_numpy()
        upto = np.concatenate([[0], np.cumsum(sizes[pieces.indices.to_numpy()])])
        return flat, upto[parts.offsets.to_numpy()]


#: Characters of texts that are encoded at once.
PORTION = 8 << 20


def encoded(texts: Iterable[str], encode: Encoder) -> Iterator[np.ndarray]:
    """The ids of each text with the end id, in portions of bounded size."""
    held: list[str] = []
    size = 0

    def portion() -> Iterator[np.ndarray]:
        flat, offsets = encode.many(held)
        end = np.array([END_ID], encode.kind)
        for a, b in zip(offsets[:-1], offsets[1:], strict=True):
            yield np.concatenate([flat[a:b], end])

    for text in texts:
        held.append(text)
        size += len(text)
        if size >= PORTION:
            yield from portion()
            held, size = [], 0
    yield from portion()


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each Python worker, kept from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    claim("token_files", _ENCODERS[path].words, _ENCODERS[path].stretches)
    return _ENCODERS[path]


def _open(folder: str) -> tuple[Any, str]:
    """The file system of a folder's address, and the folder's path there; Spark's names for the S3 scheme are known by another one."""
    from pyarrow import fs

    folder = re.sub(r"^s3[an]://", "s3://", folder)
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def write(docs: DataFrame, folder: str, path: str | None = None) -> DataFrame:
    """Write the files; the manifest (file, part, n_docs, n_ids, base), one row for each part, in doc_id order.

    One shuffle: the texts go to sorted ranges of doc_id, and each range is encoded as it is written.
    """
    spark = docs.sparkSession
    ship_package(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        encode = encoder(path or tokenizer_path())
        store, at = _open(folder)
        store.create_dir(at, recursive=True)
        name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}"
        ids, lengths, nulls = [], [], 0
        with store.open_output_stream(posixpath.join(at, f"{name}.bin")) as out:

            def texts() -> Iterator[str]:
                nonlocal nulls
                for batch in batches:
                    nulls += batch.column(0).null_count
                    ids.extend(x or 0 for x in batch.column(0).to_pylist())
                    for text in batch.column(1):
                        yield text.as_py() or ""

            for document in encoded(texts(), encode):
                out.write(document.tobytes())
                lengths.append(len(document))
        offsets = np.concatenate([[0], np.cumsum(lengths, dtype="<i8")]).astype("<i8")
        with store.open_output_stream(posixpath.join(at, f"{name}.idx")) as out:
            out.write(np.array([MAGIC, np.dtype(encode.kind).itemsize, len(ids), nulls], "<i8").tobytes() + np.array(ids, "<i8").tobytes() + offsets.tobytes())
        if ids:
            yield pa.RecordBatch.from_pydict({"file": [name], "part": [context.partitionId()], "n_docs": [len(ids)], "n_ids": [int(offsets[-1])]})

    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    order = [F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(parts, order[0]).sortWithinPartitions(*order)
    written = cut(rows.mapInArrow(run, "file string, part long, n_docs long, n_ids long"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part
    return written.withColumn("base", F.coalesce(F.sum("n_ids").over(ahead), F.lit(0)))


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    ship_package(manifest.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, at = _open(folder)
        for batch in batches:
            for row in batch.to_pylist():
                index = np.frombuffer(_mapped(store, posixpath.join(at, f"{row['file']}.idx")), "<i8")
                if index[0] != MAGIC:
                    raise ValueError(f"{row['file']}.idx is no index")
                n, nulls = int(index[2]), int(index[3])
                doc_ids, offsets = index[4 : 4 + n], index[4 + n :]
                ids = np.frombuffer(_mapped(store, posixpath.join(at, f"{row['file']}.bin")), f"<u{index[1]}")
                sums = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, mask=np.arange(n) < nulls), pa.array(row["base"] + offsets[:-1]), pa.array(np.diff(offsets)), pa.array(sums, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    parts = max(int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    return manifest.select("file", "base").repartition(parts, "file").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _mapped(store: Any, path: str) -> Any:
    """A file's bytes: memory-mapped where the store is a local or mounted folder, else read."""
    from pyarrow import fs, memory_map

    if isinstance(store, fs.LocalFileSystem):
        with memory_map(path) as file:
            return file.read_buffer()
    with store.open_input_file(path) as file:
        return file.read_buffer()


def new_folder(spark: SparkSession) -> str:
    return posixpath.join(shared_dir(spark), f"token-files-{uuid.uuid4().hex}")
