"""SentencePiece encoding and decoding over a distinct-chunk table.

No piece of the model crosses from another character into a whitespace marker, so a text falls
into chunks (a run of markers and what follows it) that are segmented independently. Each task
keeps a table from chunk to packed ids: a distinct chunk is segmented once, and the ids of a text
are its chunks' ids joined by position. The table is emptied when it holds ``TABLE_CHUNKS``
chunks, so its memory is bounded; results do not depend on it. A model with pieces that do cross
a marker is refused.

The table lives in the tasks: joining every chunk position of the corpus with one global table
would shuffle several times the text itself.

Edge cases: a NULL text encodes as the empty text (begin and end ids only); whitespace runs,
literal markers, control characters and characters outside the vocabulary (byte pieces) give the
library's own ids; an empty table gives an empty result; further columns pass through, and a
column named like a result is replaced.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame

from barframe.llm.words import SLICE_BYTES

#: Bounds of a task's table: distinct chunks and their characters.
TABLE_CHUNKS = 300_000
TABLE_CHARS = 16 << 20
MARK = "▁"
_CHUNK = re.compile(f"[ {MARK}]*[^ {MARK}]*")


class ChunkTable:
    """Encodes and decodes like the library's processor, each distinct chunk segmented once."""

    def __init__(self, model_path: str):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_file=model_path)
        pieces = [self.processor.id_to_piece(i) for i in range(self.processor.get_piece_size())]
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("pieces of this model cross whitespace markers")
        self.begin = self._pack([self.processor.bos_id()])
        self.end = self._pack([self.processor.eos_id()])
        self.mark = self._pack([self.processor.piece_to_id(MARK)])
        self.table: dict[str, bytes] = {}
        self.chars = 0

    @staticmethod
    def _pack(ids: list[int]) -> bytes:
        return np.array(ids, "<u4").tobytes()

    def segment(self, chunks: list[str]) -> list[bytes]:
        """Packed ids of chunks that begin with a marker; the library adds that marker itself."""
        encoded = self.processor.encode([c[1:] for c in chunks], num_threads=1)
        return [self._pack(ids) if len(c) > 1 else self.mark for c, ids in zip(chunks, encoded)]

    @staticmethod
    def split(text: str) -> list[str]:
        """The chunks of a text, which begins with a marker of its own."""
        if not text:
            return []
        if "  " in text or MARK in text or text[0] == " " or text[-1] == " ":
            return [c for c in _CHUNK.findall(" " + text) if c]
        return (" " + text.replace(" ", "\0 ")).split("\0") if "\0" not in text else [" " + c for c in text.split(" ")]

    def encode_packed(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text, with begin and end ids."""
        if len(self.table) > TABLE_CHUNKS or self.chars > TABLE_CHARS:
            self.table, self.chars = {}, 0
        split = [self.split(t) for t in texts]
        new = [c for c in set().union(*split) if c not in self.table]
        for i in range(0, len(new), 20_000):
            part = new[i : i + 20_000]
            self.table.update(zip(part, self.segment(part)))
            self.chars += sum(map(len, part))
        ids = self.table.__getitem__
        return [b"".join([self.begin, *map(ids, chunks), self.end]) for chunks in split]

    def decode_packed(self, packed: bytes) -> str:
        return self.processor.decode(np.frombuffer(packed, "<u4").tolist())


@functools.cache
def chunk_table(model_path: str) -> ChunkTable:
    """The table of this Python worker."""
    return ChunkTable(model_path)


def _mapped(df: DataFrame, text_col: str, added: list[tuple[str, str, pa.DataType]], of_texts) -> DataFrame:
    """``df`` with columns that ``of_texts`` makes from lists of texts, a few megabytes at a time."""
    names = [c for c in df.columns if c not in {a[0] for a in added}]
    kept = df.select(*[f"`{c}`" for c in names])
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema), *(f"{n} {t}" for n, t, _ in added)])

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            texts = batch.column(names.index(text_col))
            sizes = pa.compute.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
            cuts = np.searchsorted(np.cumsum(sizes), np.arange(0, sizes.sum() + 1, SLICE_BYTES))
            for a, b in zip(cuts, [*cuts[1:], len(texts)]):
                if a < b:
                    part = batch.slice(a, b - a)
                    columns = of_texts([t or "" for t in texts[a:b].to_pylist()])
                    new = [pa.array(c, t) for c, (_, _, t) in zip(columns, added)]
                    yield pa.RecordBatch.from_arrays([*part.columns, *new], names=[*names, *(a[0] for a in added)])

    return kept.mapInArrow(batches, schema)


def encode(df: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``df`` with ``ids_col``: the text's ids (array<int>), begin and end ids included."""

    def of_texts(texts):
        return [[np.frombuffer(p, "<u4").astype(np.int32) for p in chunk_table(model_path).encode_packed(texts)]]

    return _mapped(df, text_col, [(ids_col, "array<int>", pa.list_(pa.int32()))], of_texts)


def decode(df: DataFrame, model_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``df`` with ``text_col``: the text of the ids (NULL ids: the empty text)."""
    names = [c for c in df.columns if c != text_col]
    kept = df.select(*[f"`{c}`" for c in names])
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema), f"{text_col} string"])

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            ids = batch.column(names.index(ids_col))
            texts = [chunk_table(model_path).processor.decode(x.as_py() or []) for x in ids]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*names, text_col])

    return kept.mapInArrow(batches, schema)


def encode_digests(df: DataFrame, model_path: str, text_col: str = "text") -> DataFrame:
    """``df`` with ``n_tokens, ids_sha256, decoded_sha256`` of the encoded and decoded texts."""

    def of_texts(texts):
        table = chunk_table(model_path)
        packed = table.encode_packed(texts)
        return [
            [len(p) // 4 for p in packed],
            [hashlib.sha256(p).hexdigest() for p in packed],
            [hashlib.sha256(table.decode_packed(p).encode()).hexdigest() for p in packed],
        ]

    return _mapped(
        df, text_col,
        [("n_tokens", "bigint", pa.int64()), ("ids_sha256", "string", pa.string()), ("decoded_sha256", "string", pa.string())],
        of_texts,
    )
