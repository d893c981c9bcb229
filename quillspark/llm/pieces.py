"""SentencePiece encoding and decoding with a distinct-chunk table.

No piece of the model crosses from other characters into a whitespace marker, so a text falls into chunks
(a run of markers and what follows it) that are segmented independently. Each task keeps a table of the
distinct chunks it has met, has the library segment and decode every new one once, and joins the table's
entries back by position. The table is emptied when it is full, which costs time and changes nothing.
A model for which this does not hold (a piece that crosses, a normaliser that rewrites or trims text) is
recognised when it is loaded, and whole texts then go through the library.

Null texts count as empty. Rows are mapped one by one: repeated rows, null ids, ties and other columns do
no harm, an empty table gives an empty result, and texts of any length are taken whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quillspark.llm.worker_tables import claim
from quillspark.session import ship_package

MODEL = "piece_bpe_32k.model"
#: Entries of a task's table; one is about 300 bytes.
TABLE_ENTRIES = 400_000
#: Characters whose chunks are looked up together.
PORTION = 1_000_000
SPACE = "▁"
CHUNK = re.compile(r" *[^ ]+| +")


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


class Codec:
    """Encodes and decodes whole texts exactly as the library does, with begin and end ids."""

    def __init__(self, path: str, entries: int = TABLE_ENTRIES):
        import sentencepiece

        self.processor = p = sentencepiece.SentencePieceProcessor(model_file=path)
        self.entries = entries
        self.begin, self.end, self.marker = _packed([p.bos_id()]), _packed([p.eos_id()]), p.piece_to_id(SPACE)
        pieces = [p.id_to_piece(i) for i in range(p.get_piece_size())]
        crossing = any(re.search(f"[^{SPACE}]{SPACE}", x) for x in pieces)
        probe = "  Ａﬁ é  x "
        plain = p.decode(p.encode(probe)) == probe and p.encode("a", out_type=str)[0].startswith(SPACE)
        self.by_chunk = plain and not crossing
        # ahead of a chunk it keeps the decoder from treating the chunk's own first space as the text's first one
        self.anchor = p.encode("a")[-1]
        self.anchor_length = len(p.decode([self.anchor]))
        #: chunk without its first space -> (ids as little-endian unsigned 32-bit integers, decoded text)
        self.table: dict[str, tuple[bytes, str]] = {}

    def _learn(self, chunks: list[str]) -> None:
        """Segment and decode chunks that the table lacks, given without their first space, which the library adds."""
        ids = self.processor.encode(chunks, num_threads=1)
        ids = [i if x else [self.marker] for x, i in zip(chunks, ids, strict=True)]
        texts = self.processor.decode([[self.anchor, *i] for i in ids], num_threads=1)
        self.table.update((x, (_packed(i), t[self.anchor_length :])) for x, i, t in zip(chunks, ids, texts, strict=True))

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, str]]:
        """Of each text: (ids with begin and end as little-endian unsigned 32-bit integers, decoded text)."""
        if not self.by_chunk:
            for text in texts:
                ids = self.processor.encode(text, add_bos=True, add_eos=True)
                yield _packed(ids), self.processor.decode(ids)
            return
        for some in _portions(texts):
            chunks = [_chunks(x) for x in some]
            if len(self.table) > self.entries:
                self.table.clear()
            if new := list(set().union(*chunks).difference(self.table)):
                self._learn(new)
            for own in chunks:
                found = list(map(self.table.__getitem__, own))
                # the text's own dummy prefix is the first character of the first chunk
                yield b"".join([self.begin, *[x[0] for x in found], self.end]), "".join([x[1] for x in found])[1:]


def _chunks(text: str) -> list[str]:
    """The chunks of the text behind its dummy prefix, each without its first space."""
    if not text:
        return []
    text = " " + text.replace(SPACE, " ")
    if "  " in text or text[-1] == " ":
        return [x[1:] for x in CHUNK.findall(text)]
    return text[1:].split(" ")


def _portions(texts: list[str]) -> Iterator[list[str]]:
    """Runs of texts of PORTION characters, or single longer ones."""
    some, size = [], 0
    for text in texts:
        some.append(text)
        size += len(text)
        if size >= PORTION:
            yield some
            some, size = [], 0
    if some:
        yield some


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One codec for each Python worker, kept from task to task."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    claim("pieces", _CODECS[path].table)
    return _CODECS[path]


def encode_decode(docs: DataFrame, path: str | None = None, key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, ids, decoded): the ids as little-endian unsigned 32-bit integers. No shuffle."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = codec(path or model_path()).encode
        for batch in batches:
            out = list(encode([t or "" for t in batch.column(1).to_pylist()]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x[0]) // 4 for x in out], pa.int64()), pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.string())],
                names=[key, "n_tokens", "ids", "decoded"],
            )

    kind = dict(docs.dtypes)[key]
    return docs.select(key, "text").mapInArrow(run, f"{key} {kind}, n_tokens long, ids binary, decoded string")


def digests(docs: DataFrame, path: str | None = None, key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): as encode_decode, with the digests made beside the ids."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = codec(path or model_path()).encode
        for batch in batches:
            counts, ids_hex, text_hex = [], [], []
            for ids, decoded in encode([t or "" for t in batch.column(1).to_pylist()]):
                counts.append(len(ids) // 4)
                ids_hex.append(hashlib.sha256(ids).hexdigest())
                text_hex.append(hashlib.sha256(decoded.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_hex, pa.string()), pa.array(text_hex, pa.string())],
                names=[key, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = dict(docs.dtypes)[key]
    return docs.select(key, "text").mapInArrow(run, f"{key} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
