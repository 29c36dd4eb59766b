"""Words and word hashes of whole Arrow batches, in numpy.

A word is a maximal run of bytes other than space and \\t \\n \\v \\f \\r. All functions here run
inside Python tasks on slices of a batch, so memory follows the slice and not the partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20
BATCH_ROWS = 2000
#: Longer words are hashed by the library.
LANE_BYTES = 64

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
_powers: dict[str, np.ndarray] = {}


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, bytes, offsets)`` for runs of rows of about ``limit`` bytes; a row stays whole.

    NULL counts as the empty text.
    """
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        to = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        to = min(max(to, row + 1), len(column))
        yield row, data[offsets[row] : offsets[to]], offsets[row : to + 1] - offsets[row]
        row = to


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z in lower case."""
    return _LOWER[data]


def lower_latin(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z and the two-byte letters from U+00C0 to U+00DE in lower case."""
    out = _LOWER[data]
    second = np.flatnonzero(data[:-1] == 0xC3) + 1
    second = second[(data[second] >= 0x80) & (data[second] <= 0x9E) & (data[second] != 0x97)]
    out[second] += 0x20
    return out


def find_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each row the index of its first word (one more entry)."""
    return find_spans(~_SPACE[data], offsets)


def find_spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that are ``inside``, none beyond its row, and each row's first run."""
    filled = np.flatnonzero(np.diff(offsets) > 0)
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    heads, tails = offsets[filled], offsets[filled + 1] - 1
    first[heads] = inside[heads]
    last[tails] = inside[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words ``data[start:end]``: eight bytes at a time through ``mix``, long words by XXH64.

    Unlike the polynomial of ``span_hashes`` it has no words that agree for every base.
    """
    from xxhash import xxh64_intdigest

    size = ends - starts
    out = mix(size.astype(np.uint64) * _BASE + np.uint64(1))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    lanes = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    live, at = np.flatnonzero((size > 0) & (size <= LANE_BYTES)), 0
    while len(live):
        left = size[live] - at
        lane = lanes[starts[live] + at].copy()
        short = np.flatnonzero(left < 8)
        lane[short] &= (np.uint64(1) << (8 * left[short]).astype(np.uint64)) - np.uint64(1)
        out[live] = mix(out[live] * _BASE ^ lane)
        at += 8
        live = live[left > 8]
    long_words = np.flatnonzero(size > LANE_BYTES)
    if len(long_words):
        text = data.tobytes()
        out[long_words] = [xxh64_intdigest(text[a:b], 42) for a, b in zip(starts[long_words].tolist(), ends[long_words].tolist())]
    return out


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """Powers 0..n-1 of the odd hash base (or of its inverse) modulo 2**64."""
    key = "inverse" if inverse else "base"
    if key not in _powers or len(_powers[key]) < n:
        base = np.uint64(pow(int(_BASE), -1, 1 << 64)) if inverse else _BASE
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        _powers[key] = np.multiply.accumulate(steps)
    return _powers[key][:n]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
    """64-bit polynomial hashes of ``values[start:end]``, from one running sum over all values.

    For spans of hashes; for words see ``word_hashes``.
    """
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers(len(values)), out=total[1:])
    raw = (total[ends] - total[starts]) * powers(len(values) + 1, inverse=True)[starts]
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(salt))
