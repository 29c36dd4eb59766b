"""Packing by concatenating and cutting.

All documents' tokens, in the order of the input's partitions and rows, form one long line that is
cut into windows of ``window`` tokens. The first pass writes each document's ids with its place in
its partition's line; the partitions' totals, one number each, give by prefix sums where every
partition begins in the whole line. The second pass cuts each document at the windows' bounds, so a
document that crosses them has a record in each window. The last window is cut once more, by the
binary digits of its length: a sequence whose length is a power of two needs no padding, so none has any.

Words between spaces and line feeds are tokenized independently, as no token of the vocabulary
crosses whitespace and nothing composes across it; each task keeps bounded tables of distinct
chunks and of their parts. Results do not depend on the tables.

Edge cases: a NULL or empty text has the end id alone; a document longer than a window spans
several; equal rows are packed each; an empty table gives an empty result. Only the named columns
are read, so further columns cannot clash. With ``order_by`` the line follows that column whatever the
input's partitions are, for a shuffle of the texts (ties in any order).
"""

from __future__ import annotations

import functools
import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barframe.llm.scan import partition_offsets
from barframe.llm.words import SLICE_BYTES
from barframe.plans.workspace import scratch_path

WINDOW = 4096
END_ID = 2
#: Bounds of each of a task's two tables: entries and their characters.
TABLE_CHUNKS = 600_000
TABLE_CHARS = 16 << 20
#: Characters whose chunks fall apart by a plain pattern: normalization only lower-cases them.
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]*")
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^0-9a-zß-öø-ÿ]+")
_PROBE = "The ÉCOLE's 1789, ça&là--don't! Straße\nöl (I'LL) [x] 'stop 'S ÿ×÷"


class ChunkTokenizer:
    """Ids of texts as the tokenizers library gives them, each distinct word tokenized once.

    A chunk, what stands between spaces or line feeds, is looked up in one table; a new one is
    joined from its parts (words, digits, punctuation), which go to the library's model itself and
    have a table of their own. Chunks with characters beyond ``_PLAIN``, or with a special token's
    brackets, go to the library whole, and so do all if the tokenizer does not cut ``_PROBE`` into these
    parts. A tokenizer that does not cut it at whitespace is refused.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        #: How the byte-level step writes the letters beyond ASCII; plain ASCII stands for itself.
        letters = [chr(i) for i in range(0xDF, 0x100) if i != 0xF7]
        self.written = {ord(c): self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in letters}
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.chunks: dict[str, bytes] = {"": b""}
        self.parts: dict[str, bytes] = {}
        self.chars = [0, 0]
        self.plain = True
        whole = self.encode([_PROBE, *_PROBE.split()])
        if whole.pop(_PROBE) != b"".join(whole[c] for c in _PROBE.split()):
            raise ValueError("tokens of this vocabulary depend on whitespace")
        self.learn(list(whole))
        self.plain = all(self.chunks[c] == ids for c, ids in whole.items())
        self.chunks, self.parts, self.chars = {"": b""}, {}, [0, 0]

    def encode(self, texts: list[str]) -> dict[str, bytes]:
        """Packed ids of each text by the library."""
        out = {}
        for i in range(0, len(texts), 20_000):
            part = texts[i : i + 20_000]
            found = self.tokenizer.encode_batch_fast(part, add_special_tokens=False)
            out.update((c, np.array(e.ids, self.kind).tobytes()) for c, e in zip(part, found))
        return out

    def learn(self, chunks: list[str]) -> None:
        """Add new chunks to the table."""
        plain = {c: _PARTS.findall(c.lower()) for c in chunks if self.plain and _PLAIN.fullmatch(c) and "<|" not in c}
        parts = list(set().union(*plain.values()).difference(self.parts))
        tokenize, written, pack = self.tokenizer.model.tokenize, self.written, "<%d" + ("H" if self.kind.itemsize == 2 else "I")
        for p in parts:
            found = tokenize(p if p.isascii() else p.translate(written))
            self.parts[p] = struct.pack(pack % len(found), *[t.id for t in found])
        ids = self.parts.__getitem__
        self.chunks.update((c, ids(p[0]) if len(p) == 1 else b"".join(map(ids, p))) for c, p in plain.items())
        self.chunks.update(self.encode([c for c in chunks if c not in plain]))
        self.chars[0] += sum(map(len, chunks))
        self.chars[1] += sum(map(len, parts))

    def packed(self, texts: list[str], end_id: int) -> list[bytes]:
        """Little-endian ids (of ``kind``) of each text, the end id included."""
        if len(self.chunks) > TABLE_CHUNKS or self.chars[0] > TABLE_CHARS:
            self.chunks, self.chars[0] = {"": b""}, 0
        if len(self.parts) > TABLE_CHUNKS or self.chars[1] > TABLE_CHARS:
            self.parts, self.chars[1] = {}, 0
        split = [t.replace("\n", " ").split(" ") for t in texts]
        self.learn(list(set().union(*split).difference(self.chunks)))
        ids, end = self.chunks.__getitem__, np.array([end_id], self.kind).tobytes()
        return [b"".join([*map(ids, chunks), end]) for chunks in split]


@functools.cache
def chunk_tokenizer(path: str) -> ChunkTokenizer:
    """The tokenizer of this Python worker."""
    return ChunkTokenizer(path)


def token_table(df: DataFrame, id_col: str, text_col: str, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """``id, part, at, size, ids`` of every row, written: its ids, and the tokens before it in its partition."""
    kind = df.schema[id_col].dataType.simpleString()

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        tokenizer = chunk_tokenizer(tokenizer_path)
        for batch in found:
            texts = batch.column(1)
            sizes = pa.compute.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
            cuts = np.searchsorted(np.cumsum(sizes), np.arange(0, sizes.sum() + 1, SLICE_BYTES))
            for a, b in zip(cuts, [*cuts[1:], len(texts)]):
                if a < b:
                    ids = tokenizer.packed([t or "" for t in texts[a:b].to_pylist()], end_id)
                    size = np.array([len(x) // tokenizer.kind.itemsize for x in ids], np.int64)
                    places = at + np.cumsum(size) - size
                    at += int(size.sum())
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(a, b - a), pa.array(np.full(b - a, part, np.int32)), pa.array(places), pa.array(size), pa.array(ids, pa.binary())],
                        names=["id", "part", "at", "size", "ids"],
                    )

    path = scratch_path(df.sparkSession, "tokens")
    schema = f"id {kind}, part int, at bigint, size bigint, ids binary"
    df.select(id_col, text_col).mapInArrow(batches, schema).write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def tail_bounds(total: int, window: int) -> np.ndarray:
    """Begins of the sequences of the last, incomplete window: its length's binary digits, the largest first."""
    rest = total % window
    digits = [1 << i for i in range(rest.bit_length() - 1, -1, -1) if rest >> i & 1]
    return total - rest + np.cumsum([0, *digits])[:-1]


def pack(
    df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
    end_id: int = END_ID, order_by: str | None = None,
) -> DataFrame:
    """One row for each piece: ``id_col, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` are the piece's ids as little-endian unsigned 32-bit integers.
    """
    if order_by is not None:
        df = df.repartitionByRange(order_by).sortWithinPartitions(order_by)
    kind = df.schema[id_col].dataType.simpleString()
    table = token_table(df, id_col, text_col, tokenizer_path, end_id)
    offsets, total = partition_offsets(table, "part", "size")
    tail = tail_bounds(total, window)
    shared = df.sparkSession.sparkContext.broadcast(offsets)

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            if not batch.num_rows:
                continue
            size = batch.column("size").to_numpy()
            begin = shared.value[batch.column("part").to_numpy()] + batch.column("at").to_numpy()
            rows, starts, bounds = [], [], []
            for row, (g, n) in enumerate(zip(begin.tolist(), size.tolist())):
                inner = np.arange(g // window * window + window, g + n, window)
                cuts = np.unique(np.concatenate([[g], inner, tail[(tail > g) & (tail < g + n)]]))
                rows.append(np.full(len(cuts), row))
                starts.append(cuts)
                bounds.append(np.append(cuts[1:], g + n))
            rows, starts, bounds = map(np.concatenate, (rows, starts, bounds))
            late = starts >= total // window * window
            place = np.searchsorted(tail, starts, side="right") - 1
            sequence = np.where(late, total // window + place, starts // window)
            offset = np.where(late, starts - (tail[np.maximum(place, 0)] if len(tail) else 0), starts % window)
            packed = batch.column("ids").to_pylist()
            held, pieces = None, []
            low, high = starts - begin[rows], bounds - begin[rows]
            for row, a, b in zip(rows.tolist(), low.tolist(), high.tolist()):
                if held is None or held[0] != row:
                    held = row, np.frombuffer(packed[row], f"<u{len(packed[row]) // int(size[row])}").astype("<u4")
                pieces.append(held[1][a:b].tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(rows)), pa.array(low), pa.array(high - low), pa.array(pieces, pa.binary()),
                    pa.array(size[rows]), pa.array(sequence), pa.array(offset),
                ],
                names=["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

    return table.mapInArrow(
        batches, f"id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
    ).withColumnRenamed("id", id_col)


def sequences(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """``sequence_id, length, padded, n_pieces`` of every sequence; ``padded`` is its length with padding."""
    sums = pieces.groupBy("sequence_id").agg(F.sum("length").alias("length"), F.count("*").alias("n_pieces"))
    whole = F.col("length").bitwiseAND(F.col("length") - 1) == 0
    return sums.select("sequence_id", "length", F.when(whole, F.col("length")).otherwise(F.lit(window)).alias("padded"), "n_pieces")
