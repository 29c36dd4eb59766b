"""Benchmark decontamination by greedy string tiling.

Seeds are the shared runs of ``MIN_MATCH`` words (lower-case A-Z). Each document emits only seeds
that a fixed-size bitmap of the benchmark's seeds lets through; the others cannot match. A join on
the seed itself finds the pairs of document and item: those that share one of the item's rarer
seeds, without which the coverage is out of reach. For each pair, greedy string tiling marks the
longest common runs of words first, never the same word twice, found by running Karp-Rabin over the
seeded parts of the document. An item counts as leaked when its tiles cover at least
``MIN_COVERAGE`` of its words, in whatever order they stand.

Edge cases: NULL and blank texts on either side match nothing; an item with fewer words than
``MIN_MATCH`` is seeded by its whole word sequence; repeated items or documents (equal ids) count
as one with the words of all its rows; ties between equally long matches go to the first in item,
then document order; empty tables give an empty result. Only the named columns are read.
"""

from __future__ import annotations

import heapq
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barframe.llm.words import find_words, lower_ascii, mix, span_hashes, text_slices
from barframe.plans.workspace import scratch_path

MIN_MATCH = 5
MIN_COVERAGE = 0.8
#: Bits of the bitmap (2 MB). More seeds than it can hold make it let more through, nothing else.
BITMAP_BITS = 24
_MODULUS = (1 << 61) - 1
_FACTOR = 1_000_003


def _seeds(sizes: list[int], bitmap: np.ndarray | None, whole_texts_shorter_than: int = 0):
    """A mapper from ``id, text`` to ``id, pos, size, seed, bit`` of the seeds that the bitmap lets through."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for row, raw, offsets in text_slices(batch.column(1)):
                data = lower_ascii(raw)
                starts, ends, first = find_words(data, offsets)
                hashes = span_hashes(data, starts, ends)
                counts = np.diff(first)
                word_row = np.repeat(np.arange(len(counts)), counts)
                text = data.tobytes()
                for size in sizes:
                    begin = np.arange(max(len(starts) - size + 1, 0))
                    begin = begin[word_row[begin] == word_row[begin + size - 1]]
                    if whole_texts_shorter_than:  # of items: the usual size, or a shorter item's own
                        own = np.minimum(counts, whole_texts_shorter_than)
                        begin = begin[own[word_row[begin]] == size]
                    bit = (mix(span_hashes(hashes, begin, begin + size, size)) >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)
                    if bitmap is not None:
                        hit = (bitmap[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1) == 1
                        begin, bit = begin[hit], bit[hit]
                    if not len(begin):
                        continue
                    words = [text[s:e] for s, e in zip(starts.tolist(), ends.tolist())] if len(begin) * 8 > len(starts) else None
                    seeds = [
                        b" ".join(words[i : i + size] if words else [text[starts[j] : ends[j]] for j in range(i, i + size)])
                        for i in begin.tolist()
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).slice(row, len(counts)).take(pa.array(word_row[begin])),
                            pa.array(begin - first[word_row[begin]], pa.int64()), pa.array(np.full(len(begin), size, np.int32)),
                            pa.array([s.decode() for s in seeds], pa.string()), pa.array(bit),
                        ],
                        names=["id", "pos", "size", "seed", "bit"],
                    )

    return batches


def greedy_tiles(item: list[str], doc: list[str | None], min_match: int) -> list[tuple[int, int, int]]:
    """Tiles ``(item start, doc start, length)``; None in ``doc`` stands for a word that matches nothing.

    Runs of at least ``min_match`` equal words, longest first, each word in one tile at most.
    """
    free_item, free_doc = [True] * len(item), [w is not None for w in doc]
    ids: dict[str, int] = {}
    a = [ids.setdefault(w, len(ids) + 1) for w in item]
    b = [ids.get(w, 0) for w in doc]

    def windows(codes: list[int], free: list[bool], size: int) -> Iterator[tuple[int, int]]:
        """Start and rolling Karp-Rabin hash of every run of ``size`` free words."""
        lead = pow(_FACTOR, size, _MODULUS)
        value = length = 0
        for i, code in enumerate(codes):
            if not free[i]:
                value = length = 0
                continue
            value, length = (value * _FACTOR + code) % _MODULUS, length + 1
            if length > size:
                value, length = (value - codes[i - size] * lead) % _MODULUS, size
            if length == size:
                yield i - size + 1, value

    tiles: list[tuple[int, int, int]] = []
    size = max(min_match, min(len(item), 32))
    while True:
        table: dict[int, list[int]] = {}
        for i, value in windows(a, free_item, size):
            table.setdefault(value, []).append(i)
        matches = []
        for j, value in windows(b, free_doc, size):
            for i in table.get(value, ()):
                if i and j and a[i - 1] == b[j - 1] and free_item[i - 1] and free_doc[j - 1]:
                    continue  # the match began earlier
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and free_item[i + n] and free_doc[j + n]:
                    n += 1
                if n >= size:  # else the hashes agree, the words do not
                    matches.append((-n, i, j))
        heapq.heapify(matches)
        while matches:
            n, i, j = heapq.heappop(matches)
            # What longer tiles left of the match; it waits again if it has become shorter.
            free = [free_item[i + k] and free_doc[j + k] for k in range(-n)]
            if all(free):
                free_item[i : i - n] = free_doc[j : j - n] = [False] * -n
                tiles.append((i, j, -n))
                continue
            at = 0
            for is_free, run in itertools.groupby(free):
                length = len(list(run))
                if is_free and length >= size:
                    heapq.heappush(matches, (-length, i + at, j + at))
                at += length
        if size == min_match:
            return sorted(tiles)
        size = size // 2 if size > 2 * min_match else min_match


def words_needed(n_words: int, min_coverage: float) -> int:
    """The fewest covered words that reach the coverage."""
    need = math.ceil(min_coverage * n_words)
    while need / n_words < min_coverage:
        need += 1
    while need > 0 and (need - 1) / n_words >= min_coverage:
        need -= 1
    return need


def probe_seeds(n_words: int, size: int, seeds: list[tuple[int, str, list[int]]], min_coverage: float) -> list[str]:
    """The seeds of an item of which a document with enough coverage has at least one.

    ``seeds``: how often each occurs in the documents, and its places in the item. The most frequent
    ones are left out as long as their places cover too few words: a tile consists of seeds, so a
    document with only these cannot reach the coverage.
    """
    need, covered, probes = words_needed(n_words, min_coverage), set(), []
    for _, seed, places in sorted(seeds, key=lambda s: (-s[0], s[1])):
        more = {p + k for p in places for k in range(size)} - covered
        if len(covered) + len(more) < need:
            covered |= more
        else:
            probes.append(seed)
    return probes


def _probed(min_coverage: float):
    """A mapper from ``item, n_words, size, seeds`` to ``item, size, seed`` of the probe seeds."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            chosen = [
                probe_seeds(n.as_py(), size.as_py(), [(s["n"], s["seed"], s["places"]) for s in seeds.as_py()], min_coverage)
                for n, size, seeds in zip(*batch.columns[1:])
            ]
            rows = pa.array(np.repeat(np.arange(len(chosen)), [len(c) for c in chosen]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(2).take(rows), pa.array([s for c in chosen for s in c], pa.string())],
                names=["item", "size", "seed"],
            )

    return batches


def _tiled(min_match: int):
    """A mapper from pairs with their seeds to pairs with their tiles."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            out = {"n_words": [], "n_covered": [], "tiles": []}
            for text, hits in zip(batch.column(2), batch.column(3)):
                item = text.as_py().split(" ")
                doc: list[str | None] = []
                end = None
                for hit in sorted(hits.as_py(), key=lambda h: h["pos"]):
                    pos, words = hit["pos"], hit["seed"].split(" ")
                    if end is None or pos > end:
                        doc.append(None)
                        end = pos
                        doc.extend(words)
                        end += len(words)
                    elif pos + len(words) > end:
                        doc.extend(words[end - pos :])
                        end = pos + len(words)
                tiles = greedy_tiles(item, doc, min(min_match, len(item)))
                out["n_words"].append(len(item))
                out["n_covered"].append(sum(n for _, _, n in tiles))
                out["tiles"].append([{"item_pos": i, "words": n} for i, _, n in tiles])
            kind = pa.list_(pa.struct([("item_pos", pa.int32()), ("words", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out["n_words"], pa.int64()), pa.array(out["n_covered"], pa.int64()), pa.array(out["tiles"], kind)],
                names=["doc", "item", "n_words", "n_covered", "tiles"],
            )

    return batches


def contaminated_pairs(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", min_match: int = MIN_MATCH, min_coverage: float = MIN_COVERAGE,
) -> DataFrame:
    """``id_col, item_col, n_words, n_covered, coverage, tiles, text_mark`` of the leaked pairs.

    A document is known by its id and ``text_mark``, the XXH64 of its text, so rows that share an id are documents each.
    """
    spark = docs.sparkSession
    item_kind = items.schema[item_col].dataType.simpleString()
    doc_kind = f"struct<id:{docs.schema[id_col].dataType.simpleString()},mark:bigint>"
    own_words = F.array_remove(F.split(F.translate(item_text_col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), "[\\x20\\x09-\\x0D]+"), "")
    # Equal item ids count as one item: its texts in a fixed order, one after another.
    texts = (
        items.select(F.col(item_col).alias("item"), F.array_join(own_words, " ").alias("words"))
        .where("item is not null and words <> ''")
        .groupBy("item").agg(F.array_join(F.array_sort(F.collect_set("words")), " ").alias("words"))
    )
    base = scratch_path(spark, "decontaminate")
    texts.write.parquet(f"{base}/items")
    texts = spark.read.schema(f"item {item_kind}, words string").parquet(f"{base}/items")
    lengths = F.least(F.size(F.split("words", " ")), F.lit(min_match))
    sizes = sorted(r[0] for r in texts.select(lengths.alias("n")).distinct().collect())
    schema = "id {}, pos bigint, size int, seed string, bit bigint"
    texts.select("item", "words").mapInArrow(_seeds(sizes, None, min_match), schema.format(item_kind)).select(
        F.col("id").alias("item"), "pos", "size", "seed", "bit"
    ).write.parquet(f"{base}/seeds")
    seeds = spark.read.schema(f"item {item_kind}, pos bigint, size int, seed string, bit bigint").parquet(f"{base}/seeds")
    blocks = seeds.groupBy(F.shiftright("bit", 6).alias("block")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")
    ).toArrow()
    bitmap = np.zeros(1 << (BITMAP_BITS - 6), np.uint64)
    bitmap[blocks.column(0).to_numpy()] = blocks.column(1).to_numpy().view(np.uint64)
    docs.select(F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("mark")).alias("id"), text_col).mapInArrow(_seeds(sizes, bitmap), schema.format(doc_kind)).select(
        F.col("id").alias("doc"), "pos", "size", "seed"
    ).write.parquet(f"{base}/hits")
    hits = spark.read.schema(f"doc {doc_kind}, pos bigint, size int, seed string").parquet(f"{base}/hits")

    # Pairs come from each item's rare seeds only, so a phrase of many items and documents makes none by itself.
    frequency = hits.groupBy("size", "seed").agg(F.count("*").alias("n"))
    rare = (
        seeds.groupBy("item", "size", "seed").agg(F.collect_set("pos").alias("places"))
        .join(frequency, ["size", "seed"], "left")
        .groupBy("item", "size").agg(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "seed", "places")).alias("seeds"))
        .join(texts, "item").select("item", F.size(F.split("words", " ")).alias("n_words"), "size", "seeds")
        .mapInArrow(_probed(min_coverage), f"item {item_kind}, size int, seed string")
    )
    hits.join(rare, ["size", "seed"]).select("doc", "item").distinct().write.parquet(f"{base}/candidates")
    candidates = spark.read.schema(f"doc {doc_kind}, item {item_kind}").parquet(f"{base}/candidates")
    asked = candidates.join(seeds.select("item", "size", "seed").distinct(), "item").alias("asked")
    own = hits.alias("own")
    same = F.col("asked.doc").eqNullSafe(F.col("own.doc"))
    pairs = (
        asked.join(own, same & (F.col("asked.size") == F.col("own.size")) & (F.col("asked.seed") == F.col("own.seed")))
        .groupBy("asked.doc", "item").agg(F.collect_set(F.struct("own.pos", "own.seed")).alias("hits"))
        .join(texts, "item").select("doc", "item", "words", "hits")
    )
    tiled = pairs.mapInArrow(
        _tiled(min_match),
        f"doc {doc_kind}, item {item_kind}, n_words bigint, n_covered bigint, tiles array<struct<item_pos:int,words:int>>",
    )
    coverage = F.col("n_covered") / F.col("n_words")
    return tiled.withColumn("coverage", coverage).where(F.col("coverage") >= min_coverage).select(
        F.col("doc.id").alias(id_col), F.col("item").alias(item_col), "n_words", "n_covered", "coverage", "tiles", F.col("doc.mark").alias("text_mark")
    )
