"""SimHash near-dedup by a self-join of binary tries.

Fingerprints: the majority, bit by bit, of the XXH64 (seed 42) of a text's word shingles. Distinct
fingerprints within ``max_bits`` differing bits are linked; components of links are the classes.

The join walks binary tries of the fingerprints, node pairs together, adding up differing bits and
pruning a pair beyond the error budget. The 64 bits are cut into ``max_bits + 1`` segments, and
there is one trie for each rotation of the segments. Of any two fingerprints within ``max_bits``,
some rotation has at most ``j`` differing bits in its first ``j + 1`` segments, for every j (the
cycle lemma); so the budget may grow from 0 along the path and no link is lost. The first segment,
with budget 0, deals the tries out over Spark's tasks; no fingerprint meets another without it.
Node pairs whose remaining bits fit the budget are linked by a star, and a task returns a spanning
forest of its links, not all pairs.

Edge cases: texts that are NULL, empty or blank have fingerprint 0 and are linked like any other;
a text with fewer words than a shingle gives one shingle of all its words; equal texts share one
fingerprint, joined once however many there are; repeated rows stay repeated; an empty table gives
an empty result. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barframe.llm.components import connected_components
from barframe.llm.words import find_words, lower_ascii, text_slices
from barframe.plans.workspace import scratch_path

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
#: Pairs of trie nodes that a task expands at a time.
FRONTIER_PAIRS = 2_000_000


def slice_fingerprints(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE_WORDS) -> np.ndarray:
    """Fingerprints (uint64) of the texts of one slice."""
    from xxhash import xxh64_intdigest

    data = lower_ascii(data)
    starts, ends, first = find_words(data, offsets)
    # All words of the slice, joined by one space, so that a shingle is one run of bytes.
    lengths = ends - starts
    at = np.concatenate([[0], np.cumsum(lengths + 1)])
    joined = np.full(max(int(at[-1]), 1), 0x20, np.uint8)
    where = np.repeat(at[:-1] - starts, lengths) + _ranges(starts, lengths)
    joined[where] = data[_ranges(starts, lengths)]
    text = joined.tobytes()
    counts = np.diff(first)
    shingles = np.where(counts > 0, np.maximum(counts - k + 1, 1), 0)
    rows = np.repeat(np.arange(len(counts)), shingles)
    begin = first[rows] + _ranges(np.zeros(len(counts), np.int64), shingles)
    last = np.minimum(begin + k, first[rows + 1]) - 1
    total = np.zeros((len(counts), 64), np.int64)
    bounds = np.concatenate([[0], np.cumsum(shingles)])
    for a in range(0, len(begin), 65536):
        b = min(a + 65536, len(begin))
        hashes = np.array(
            [xxh64_intdigest(text[s:e], SEED) for s, e in zip(at[begin[a:b]].tolist(), (at[last[a:b] + 1] - 1).tolist())],
            np.uint64,
        )
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        own = np.unique(rows[a:b])
        cuts = np.maximum(bounds[own], a) - a
        total[own] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int32)
    set_bits = 2 * total > shingles[:, None]
    return np.packbits(set_bits, axis=1).view(">u8").ravel().astype(np.uint64)


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each of the lengths, one after another."""
    before = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) - np.repeat(before - starts, lengths)


def fingerprints(df: DataFrame, id_col: str, text_col: str, k: int = SHINGLE_WORDS) -> DataFrame:
    """``id, fp`` (the fingerprint's 64 bits as a signed long) for every row."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for row, data, offsets in text_slices(batch.column(1)):
                fps = slice_fingerprints(data, offsets, k).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(fps)), pa.array(fps)], names=["id", "fp"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(batches, f"id {kind}, fp bigint")


def segments(max_bits: int) -> list[int]:
    """Bits of each of the ``max_bits + 1`` segments."""
    n = max_bits + 1
    return [64 // n + (i < 64 % n) for i in range(n)]


def _rotated(fps: np.ndarray, by: int) -> np.ndarray:
    return fps if by == 0 else (fps << np.uint64(by)) | (fps >> np.uint64(64 - by))


def trie_links(fps: np.ndarray, widths: list[int], max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between rows of the sorted distinct ``fps`` whose first segment agrees, as index pairs.

    ``widths`` are the segments' bits in this rotation. Every link that the budget reaches is
    connected by the returned pairs, though not always directly.
    """
    budget = np.repeat(np.arange(len(widths)), widths)  # differing bits allowed up to and including this depth
    top = fps >> np.uint64(64 - widths[0])
    heads = np.flatnonzero(np.concatenate([[True], top[1:] != top[:-1]]))
    tails = np.concatenate([heads[1:], [len(fps)]])
    many = tails - heads > 1
    roots = np.stack([heads[many], tails[many], heads[many], tails[many], np.zeros(many.sum(), np.int64)])
    work = [(widths[0], roots)]
    found = []
    while work:
        depth, pairs = work.pop()
        if pairs.shape[1] > FRONTIER_PAIRS:  # the rest waits, so memory stays bounded
            work.append((depth, pairs[:, FRONTIER_PAIRS:]))
            pairs = pairs[:, :FRONTIER_PAIRS]
        alo, ahi, blo, bhi, err = pairs
        same = alo == blo
        leaf = (ahi - alo == 1) & (bhi - blo == 1)
        ends = leaf & ~same
        if ends.any():
            x, y = alo[ends], blo[ends]
            near = np.bitwise_count(fps[x] ^ fps[y]) <= max_bits
            found.append((x[near], y[near]))
        # All the rest of both nodes fits the budget: a star links them all.
        whole = ~leaf & (err + 64 - depth <= max_bits)
        for i in np.flatnonzero(whole):
            a, b = np.arange(alo[i], ahi[i]), np.arange(blo[i], bhi[i])
            found.append((np.concatenate([np.full(len(b), a[0]), a]), np.concatenate([b, np.full(len(a), b[0])])))
        go = ~leaf & ~whole
        if depth == 64 or not go.any():
            continue
        alo, ahi, blo, bhi, err, same = alo[go], ahi[go], blo[go], bhi[go], err[go], same[go]
        bit = np.uint64(1) << np.uint64(63 - depth)
        above = ~((bit << np.uint64(1)) - np.uint64(1)) if depth else np.uint64(0)
        amid = np.searchsorted(fps, (fps[alo] & above) | bit)
        bmid = np.searchsorted(fps, (fps[blo] & above) | bit)
        amid, bmid = np.clip(amid, alo, ahi), np.clip(bmid, blo, bhi)
        children = np.concatenate([
            np.stack([alo, amid, blo, bmid, err]),
            np.stack([amid, ahi, bmid, bhi, err]),
            np.stack([alo, amid, bmid, bhi, err + 1]),
            np.stack([amid, ahi, blo, bmid, err + 1])[:, ~same],
        ], axis=1)
        full = (children[0] < children[1]) & (children[2] < children[3]) & (children[4] <= budget[depth])
        alone = (children[0] == children[2]) & (children[1] - children[0] == 1)
        children = children[:, full & ~alone]
        if children.shape[1]:
            work.append((depth + 1, children))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def spanning_forest(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For each of ``n`` nodes, the smallest node that the links reach."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        while not np.array_equal(new, jumped := new[new]):
            new = jumped
        if np.array_equal(new, label):
            return label
        label = new


def near_links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``src, dst`` between the distinct fingerprints ``fp``: enough links to connect all within ``max_bits``."""
    widths = segments(max_bits)
    starts = [sum(widths[:i]) for i in range(len(widths))]

    def rotations(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            fps = batch.column(0).to_numpy().view(np.uint64)
            for i, start in enumerate(starts):
                turned = _rotated(fps, start)
                head = (turned >> np.uint64(64 - widths[i])).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(fps), i, np.int32)), pa.array(head), pa.array(turned.view(np.int64))],
                    names=["rotation", "head", "turned"],
                )

    def join(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rotation = [], None

        def links(values: np.ndarray, rotation: int) -> Iterator[pa.RecordBatch]:
            fps = np.sort(values)
            own = widths[rotation:] + widths[:rotation]
            x, y = trie_links(fps, own, max_bits)
            label = spanning_forest(len(fps), x, y)
            child = np.flatnonzero(label != np.arange(len(fps)))
            if len(child):
                back = _rotated(fps, (64 - starts[rotation]) % 64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(back[child]), pa.array(back[label[child]])], names=["src", "dst"])

        # Rows come sorted by rotation and head; whole tries are joined together, many small ones at a time.
        for batch in found:
            rotations, heads = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            values = batch.column(2).to_numpy().view(np.uint64)
            cuts = np.flatnonzero((np.diff(rotations) != 0) | (np.diff(heads) != 0)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(values)]):
                here = (int(rotations[a]), int(heads[a]))
                if held and (rotation[0] != here[0] or (rotation != here and sum(map(len, held)) > 50_000)):
                    yield from links(np.concatenate(held), rotation[0])
                    held = []
                held.append(values[a:b])
                rotation = here
        if held:
            yield from links(np.concatenate(held), rotation[0])

    turned = distinct.select("fp").mapInArrow(rotations, "rotation int, head bigint, turned bigint")
    dealt = turned.repartition("rotation", "head").sortWithinPartitions("rotation", "head")
    return dealt.mapInArrow(join, "src bigint, dst bigint")


def simhash_classes(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
) -> DataFrame:
    """``id_col, fp, component_id`` of every row; the component is its smallest id."""
    spark = df.sparkSession
    path = scratch_path(spark, "simhash-fingerprints")
    fingerprints(df, id_col, text_col, k).write.parquet(path)
    fps = spark.read.parquet(path)
    distinct = fps.groupBy("fp").agg(F.min("id").alias("first_id"))
    links = scratch_path(spark, "simhash-links")
    near_links(distinct, max_bits).distinct().write.parquet(links)
    roots = connected_components(spark.read.parquet(links))
    classes = distinct.join(roots.withColumnsRenamed({"node": "fp", "component": "root"}), "fp", "left")
    classes = classes.withColumn("root", F.coalesce("root", "fp"))
    named = classes.groupBy("root").agg(F.min("first_id").alias("component_id"))
    members = classes.select("fp", "root").join(named, "root").select("fp", "component_id")
    return fps.join(members, "fp").select(F.col("id").alias(id_col), "fp", "component_id")
