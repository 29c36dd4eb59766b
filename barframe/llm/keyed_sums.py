"""Sums by 64-bit key over all rows, with an answer to each row for each of its keys.

A row of the table asks about many keys. They are sorted and dealt out by their highest bits, a
packed array of bytes for each row and bucket; a task adds up one bucket at a time, and its answers
go back in the order in which the keys were sent, so they need no keys. The answers of a row lie in
a folder of their own below the shared work folder, which every task reaches through pyarrow's file
systems (as for the archives of ``warc``).

Arrays are packed as planes of bytes, lowest first, under zstd: sorted hashes as their differences.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs, parquet
from pyspark.sql import DataFrame

from barframe.llm.warc import _open_fs, _uri

#: A bucket holds about so many keys of all rows, and there are at least so many buckets (a power of two).
BUCKET_KEYS = 1 << 21
LEAST_BUCKETS = 64
_SENT = "slice bigint, bucket int, a binary, b binary, c binary, d binary"
_ANSWERED = "slice bigint, bucket int, a binary, b binary, c binary, total bigint, kinds bigint"


def pack(values: np.ndarray) -> bytes:
    """Unsigned integers, in as many bytes each as the largest one needs."""
    n = len(values)
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if n else 0
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    return n.to_bytes(8, "little") + bytes([width]) + (pa.compress(planes, codec="zstd", asbytes=True) if n else b"")


def unpack(blob: bytes) -> np.ndarray:
    n, width = int.from_bytes(blob[:8], "little"), blob[8]
    out = np.zeros((n, 8), np.uint8)
    if n:
        planes = np.frombuffer(pa.decompress(blob[9:], decompressed_size=n * width, codec="zstd"), np.uint8)
        out[:, :width] = planes.reshape(width, n).T
    return out.reshape(-1).view("<u8")


def pack_sorted(keys: np.ndarray) -> bytes:
    return int(keys[0]).to_bytes(8, "little") + pack(np.diff(keys)) if len(keys) else b""


def unpack_sorted(blob: bytes) -> np.ndarray:
    if not blob:
        return np.zeros(0, np.uint64)
    steps = unpack(blob[8:])
    steps = np.concatenate([np.frombuffer(blob[:8], "<u8"), steps])
    return np.cumsum(steps, dtype=np.uint64)


def numbered(codes: np.ndarray, below: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct codes (from 0, less than ``below``) and each entry's place among them.

    Code and place share a 64-bit integer if they fit, which sorts several times as fast.
    """
    places = max(1, len(codes)).bit_length()
    if below.bit_length() + places > 63:
        return np.unique(codes, return_inverse=True)
    both = np.sort((codes << places) | np.arange(len(codes)))
    codes, at = both >> places, both & ((1 << places) - 1)
    new = np.ones(len(codes), bool)
    new[1:] = codes[1:] != codes[:-1]
    out = np.empty(len(codes), np.int64)
    out[at] = np.cumsum(new) - 1
    return codes[new], out


def bucket_count(keys: int) -> int:
    return max(LEAST_BUCKETS, 1 << max(0, -(-keys // BUCKET_KEYS) - 1).bit_length())


def bounds(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins in the sorted keys, and their number."""
    return np.searchsorted(keys >> np.uint64(65 - buckets.bit_length()), np.arange(buckets + 1, dtype=np.uint64))


def by_key(rows: list[np.ndarray]) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of distinct keys in all rows, each entry's key as a number, and each key's first entry."""
    kinds, first, number = np.unique(np.concatenate(rows), return_index=True, return_inverse=True)
    return len(kinds), number, first


def sums(number: np.ndarray, values: list[np.ndarray], kinds: int) -> np.ndarray:
    """Sums by key number; exact below 2**53."""
    return np.bincount(number, np.concatenate(values), kinds).astype(np.uint64)


def split(values: np.ndarray, like: list[np.ndarray]) -> list[np.ndarray]:
    return np.split(values, np.cumsum([len(x) for x in like])[:-1])


def ask_and_answer(
    rows: DataFrame, ask: Callable[[dict], Iterator[tuple]], answer: Callable[[int, list[dict]], tuple[list[tuple], int, int]], path: str
) -> None:
    """Write the answers to all rows of ``rows`` (with a unique ``slice``) below ``path``.

    ``ask(row)`` gives ``(bucket, a, b, c, d)``, packed arrays or None. ``answer(bucket, asked)``
    gets what was asked of one bucket, by slice, and gives ``(a, b, c)`` for each and the sum and the
    number of keys (columns ``total`` and ``kinds`` of the bucket's first row).
    """

    def asked(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                sent = list(zip(*ask(row)))
                kinds = [pa.int32(), *[pa.binary()] * 4]
                columns = [pa.array(list(c), k) for c, k in zip(sent, kinds)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(sent[0]), row["slice"])), *columns], names=["slice", "bucket", "a", "b", "c", "d"]
                )

    def answered(table: pa.Table) -> pa.Table:
        found = table.sort_by("slice").to_pylist()  # the same order in every attempt
        bucket = found[0]["bucket"]
        blobs, total, kinds = answer(bucket, found)
        once = [0] * (len(found) - 1)
        return pa.table(
            {
                "slice": pa.array([r["slice"] for r in found], pa.int64()), "bucket": pa.array([bucket] * len(found), pa.int32()),
                **{n: pa.array([b[k] for b in blobs], pa.binary()) for k, n in enumerate("abc")},
                "total": pa.array([total, *once], pa.int64()), "kinds": pa.array([kinds, *once], pa.int64()),
            }
        )

    sent = rows.mapInArrow(asked, _SENT)
    sent.groupBy("bucket").applyInArrow(answered, _ANSWERED).repartition("slice").write.partitionBy("slice").parquet(path)


def answers(path: str, row: int) -> list[dict]:
    """``bucket, a, b, c`` of one row's answers, by bucket."""
    system, base = _open_fs(_uri(path))
    found = system.get_file_info(fs.FileSelector(f"{base}/slice={row}", allow_not_found=True))
    out = []
    for f in found:
        if f.is_file and f.base_name[0] not in "._":
            with system.open_input_file(f.path) as file:
                out += parquet.ParquetFile(file).read(["bucket", "a", "b", "c"]).to_pylist()
    return sorted(out, key=lambda r: r["bucket"])


def joined(found: list[dict], column: str) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.uint64), *[unpack(r[column]) for r in found]])
