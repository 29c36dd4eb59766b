"""Spelling variants of a corpus' words, by a bit-sliced position index.

Two words are near if they differ by exactly one inserted, deleted or replaced code point. The index
of a block of words holds, for each position and letter, the set of the words with that letter
there, as a bitset. A recurrence over the letters of a word carries two kinds of sets: the words
that agree so far (zero errors), and those with one error, whether replaced, or with a letter more or
less, whose further letters are looked up one position on or back. It runs for all words of the
block at once, 64 of the index at a time.

Blocks: let m be the shorter length of two near words and e the length of their common prefix; then
e <= m, and for e in [lo, hi) they share the first lo letters and the last m - hi. Each word
enters, for m its own length and one less, a block for each half of the range of e. A block with
more than ``BLOCK_WORDS`` words is split again by halving its range, down to a single place, where a
block is bounded by the alphabet. A pair belongs to the one block whose m and range it has, so each
is found once, and no block is quadratic in the vocabulary. Small blocks share an index: a word
starts with the bitset of its own block.

Of its near words a task returns a word's count and its best, never the pairs.

Edge cases: NULL and empty texts have no words; of near words equally frequent the smallest in
code-point order is the form; forms are strictly more frequent, so following them ends; repeated
rows count each; an empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barframe.llm.words import find_spans, lower_ascii, text_slices
from barframe.plans.workspace import scratch_path

MIN_LETTERS = 5
MIN_COUNT = 3
FORM_RATIO = 2
#: Of so many runs one loses a letter.
DROP_ONE_IN = 97
#: Words of a block, and of the index that small blocks share.
BLOCK_WORDS = 2048
#: A task adds up this many distinct words before it passes them on.
HELD_WORDS = 500_000


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _crc_steps(longest: int) -> np.ndarray:
    """``[n, byte, value]``: what each byte of a CRC-32 becomes when n zero bytes follow."""
    one = np.array([zlib.crc32(bytes([i])) ^ zlib.crc32(b"\0") for i in range(256)], np.uint32)  # the table of the polynomial
    out = np.empty((longest + 1, 4, 256), np.uint32)
    for k in range(4):
        out[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    for n in range(longest):
        out[n + 1] = (out[n] >> np.uint32(8)) ^ one[out[n] & np.uint32(255)]
    return out


_STEPS = _crc_steps(64)


def joined_crc(before: np.ndarray, after: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of two joined byte strings from the CRC-32 of each and the second's size (64 at most)."""
    out = after.copy()
    for k in range(4):
        out ^= _STEPS[size, k, (before >> np.uint32(8 * k)) & np.uint32(255)]
    return out


def slice_words(ids: list[str], data: np.ndarray, offsets: np.ndarray, drop: bool) -> tuple[pa.Array, np.ndarray]:
    """The words of a slice of texts and how often each occurs; words may repeat in the result.

    With ``drop``, of one in ``DROP_ONE_IN`` runs, by the CRC-32 of ``id:run``, the letter of that number is left out.
    """
    data = lower_ascii(data)
    lead = data == 0xC3
    inside = (data >= 0x61) & (data <= 0x7A) | lead
    inside[1:] |= lead[:-1]
    starts, ends, first = find_spans(inside, offsets)
    sizes = ends - starts
    flat = data[inside].tobytes()
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    runs = pa.Array.from_buffers(pa.large_string(), len(sizes), [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(flat)])
    coded = runs.dictionary_encode()
    kinds, code = coded.dictionary, coded.indices.to_numpy()
    if not drop:
        return kinds, np.bincount(code, minlength=len(kinds))
    words = kinds.to_pylist()
    crc = np.array([zlib.crc32(w.encode()) for w in words], np.uint32)
    heads = np.array([zlib.crc32(f"{i}:".encode()) for i in ids], np.uint32)
    row = np.repeat(np.arange(len(ids)), np.diff(first))
    h = joined_crc(heads[row], crc[code], np.minimum(sizes, 64))
    for i in np.flatnonzero(sizes > 64).tolist():
        h[i] = zlib.crc32(words[code[i]].encode(), int(heads[row[i]]))
    hit = h % np.uint32(DROP_ONE_IN) == 0
    n = np.bincount(code[~hit], minlength=len(kinds))
    cut = []
    for w, k in zip(code[hit].tolist(), h[hit].tolist()):
        word = words[w]
        at = k % len(word)
        cut.append(word[:at] + word[at + 1 :])
    return pa.concat_arrays([kinds, pa.array(cut, kinds.type)]), np.concatenate([n, np.ones(len(cut), np.int64)])


def word_counts(df: DataFrame, id_col: str, text_col: str, drop: bool = False, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n`` of the words with at least ``min_letters`` code points and ``min_count`` occurrences in all texts."""

    def summed(parts: list[pa.Table]) -> pa.Table:
        out = pa.concat_tables(parts).group_by("word").aggregate([("n", "sum")])
        return pa.table({"word": out.column("word").combine_chunks(), "n": out.column("n_sum").combine_chunks()})

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in found:
            ids = batch.column(0).fill_null("").to_pylist()
            for row, data, offsets in text_slices(batch.column(1)):
                words, n = slice_words(ids[row : row + len(offsets) - 1], data, offsets, drop)
                keep = pc.greater_equal(pc.utf8_length(words), min_letters)
                keep = pc.and_(keep, pa.array(n > 0))
                held.append(pa.table({"word": words.filter(keep), "n": pa.array(n).filter(keep)}))
                size += len(held[-1])
                if size > 2 * HELD_WORDS:
                    held = [summed(held)]
                    size = len(held[0])
                    if size > HELD_WORDS:
                        yield from as_strings(held[0])
                        held, size = [], 0
        if held:
            yield from as_strings(summed(held))

    def as_strings(table: pa.Table) -> Iterator[pa.RecordBatch]:
        return table.set_column(0, "word", table.column(0).cast(pa.string())).to_batches(max_chunksize=50_000)

    found = df.select(F.col(id_col).cast("string"), text_col).mapInArrow(batches, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _block_rows(words: DataFrame) -> DataFrame:
    """``word, n, m, lo, hi, block`` of the two halves of the range, for both shorter lengths that a word can have."""
    size = F.char_length("word")
    sides = words.withColumn("m", F.explode(F.array(size, size - 1))).withColumn("half", F.shiftright(F.col("m") + 1, 1))
    low = F.struct(F.lit(0).alias("lo"), F.col("half").alias("hi"))
    high = F.struct(F.col("half").alias("lo"), (F.col("m") + 1).alias("hi"))
    halves = sides.withColumn("range", F.explode(F.array(low, high)))
    return _with_block(halves.select("word", "n", "m", "range.lo", "range.hi"))


def _with_block(rows: DataFrame) -> DataFrame:
    """A block's words share the range, the first ``lo`` and the last ``m - hi`` letters.

    Blocks are named by a 64-bit hash: a collision puts more words into a block and changes no result.
    """
    shared = F.greatest(F.col("m") - F.col("hi"), F.lit(0))
    last = F.expr("right(word, greatest(m - hi, 0))")
    return rows.withColumn("block", F.xxhash64("m", "lo", "hi", F.expr("left(word, lo)"), shared, last))


def block_table(words: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``block, m, lo, hi, word, n``: the words of all blocks that hold more than one, at most ``block_words`` each.

    A block over a single place may hold more, as far as the alphabet goes.
    """
    out, rows = [], _written(_block_rows(words), "blocks")
    while True:
        sizes = rows.groupBy("block").agg(F.count("*").alias("size"))
        sized = rows.join(sizes.where("size > 1"), "block")
        done = (F.col("size") <= block_words) | (F.col("hi") - F.col("lo") <= 1)
        sized = _written(sized, "blocks")
        out.append(sized.where(done).select("block", "m", "lo", "hi", "word", "n"))
        wide = sized.where(~done)
        if wide.isEmpty():
            break
        half = F.shiftright(F.col("lo") + F.col("hi"), 1)
        ranges = F.array(F.struct(F.col("lo").alias("lo"), half.alias("hi")), F.struct(half.alias("lo"), F.col("hi").alias("hi")))
        split = wide.withColumn("range", F.explode(ranges)).select("word", "n", "m", "range.lo", "range.hi")
        rows = _written(_with_block(split), "blocks")
    table = out[0]
    for more in out[1:]:
        table = table.unionByName(more)
    return table


def near_in_index(words: list[str], n: np.ndarray, block: np.ndarray, m: np.ndarray, lo: np.ndarray, hi: np.ndarray):
    """For each word of one index, how many near words its block gives it, and the place of the best (-1: none).

    ``block`` numbers the blocks; words are in the order of preference, the best first. A near pair
    counts only if the shorter length is ``m`` and the common prefix has a length in ``[lo, hi)``.
    """
    size = len(words)
    width = (size + 63) // 64
    letters = [np.frombuffer(w.encode("utf-32-le"), np.uint32) for w in words]
    length = np.array([len(w) for w in letters], np.int64)
    longest = int(length.max())
    place = np.arange(size)
    bit = np.uint64(1) << (place % 64).astype(np.uint64)
    # One row for each (position, letter) that occurs; row 0 is the empty set.
    position = np.concatenate([np.arange(k) for k in length.tolist()])
    owner = np.repeat(place, length)
    symbols, symbol = np.unique(np.concatenate(letters), return_inverse=True)
    codes, row = np.unique(position * len(symbols) + symbol, return_inverse=True)
    index = np.zeros((len(codes) + 1, width), np.uint64)
    np.bitwise_or.at(index, (row + 1, owner // 64), bit[owner])
    matrix = np.full((size, longest + 2), -1, np.int64)
    matrix[owner, position] = symbol

    def with_letter(q: np.ndarray, at: int, shift: int) -> np.ndarray:
        """Words that have, ``shift`` places on, the letter that each query has at ``at``."""
        if at + shift < 0:
            return index[np.zeros(len(q), np.int64)]
        wanted = (at + shift) * len(symbols) + matrix[q, at]
        i = np.minimum(np.searchsorted(codes, wanted), len(codes) - 1)
        return index[np.where(codes[i] == wanted, i + 1, 0)]

    def sets_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        kinds, of = np.unique(values, return_inverse=True)
        out = np.zeros((len(kinds), width), np.uint64)
        np.bitwise_or.at(out, (of, place // 64), bit)
        return kinds, out

    _, by_block = sets_of(block)
    lengths, by_length = sets_of(length)
    by_length = np.vstack([by_length, np.zeros((1, width), np.uint64)])

    def of_length(k: np.ndarray) -> np.ndarray:
        i = np.minimum(np.searchsorted(lengths, k), len(lengths) - 1)
        return by_length[np.where(lengths[i] == k, i, len(lengths))]

    queries = np.argsort(-length, kind="stable")  # the longest first, so that those still read are a prefix
    sorted_length = length[queries]
    zero = by_block[np.unique(block, return_inverse=True)[1][queries]].copy()
    replaced, less, more = (np.zeros_like(zero) for _ in range(3))
    within = np.zeros_like(zero)  # words whose common prefix with the query is lo at least
    beyond = np.zeros_like(zero)  # ... hi at least
    low, high = lo[queries], hi[queries]
    for at in range(longest + 1):
        within[low == at] = zero[low == at]
        ended = (high == at) & (sorted_length >= at)
        beyond[ended] = zero[ended]
        live = int(np.searchsorted(-sorted_length, -at, side="left"))  # queries with a letter at this place
        if not live:
            continue
        q = queries[:live]
        same, back, on = with_letter(q, at, 0), with_letter(q, at, -1), with_letter(q, at, 1)
        z = zero[:live]
        replaced[:live] = replaced[:live] & same | z & ~same
        # One letter less: the query's letter is passed over, and the rest stands one place back.
        less[:live] = less[:live] & back | z
        # One letter more: the other's letter is passed over, and the rest stands one place on.
        more[:live] = (more[:live] | z) & on
        zero[:live] = z & same
    own = sorted_length
    shorter = m[queries]
    exact = (own == shorter)[:, None]
    near = np.where(exact, replaced & of_length(own) | (more | zero) & of_length(own + 1), np.uint64(0))
    near |= np.where(exact, np.uint64(0), less & of_length(own - 1))
    near &= within & ~beyond
    counts = np.zeros(size, np.int64)
    best = np.full(size, -1)
    counts[queries] = np.bitwise_count(near).sum(axis=1)
    some = np.flatnonzero(near.any(axis=1))
    word_at = (near[some] != 0).argmax(axis=1)
    held = near[some, word_at]
    lowest = np.bitwise_count((held & (~held + np.uint64(1))) - np.uint64(1)).astype(np.int64)
    best[queries[some]] = word_at * 64 + lowest
    return counts, best


def _packs(block: np.ndarray, index_words: int, final: bool) -> list[tuple[int, int]]:
    """Ranges of whole blocks with up to ``index_words`` rows (or one larger block); the last block may go on unless ``final``."""
    ends = np.append(np.flatnonzero(np.diff(block) != 0) + 1, len(block))
    ends = ends if final else ends[:-1]
    out, done = [], 0
    while len(ends) and done < ends[-1] and (final or ends[-1] - done >= index_words):
        fits = int(np.searchsorted(ends, done + index_words, side="right")) - 1
        to = int(ends[fits]) if fits >= 0 and ends[fits] > done else int(ends[np.searchsorted(ends, done, side="right")])
        out.append((done, to))
        done = to
    return out


def _near(index_words: int):
    """A mapper from blocks in order to ``word, n_near, best_n, best`` for each word with near words in its block."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in found:
            held.append(pa.Table.from_batches([batch]))
            if sum(map(len, held)) >= 2 * index_words:
                table = pa.concat_tables(held).combine_chunks()
                packs = _packs(table.column("block").to_numpy(), index_words, False)
                yield from (one(table.slice(a, b - a)) for a, b in packs)
                held = [table.slice(packs[-1][1] if packs else 0)]
        if held:
            table = pa.concat_tables(held).combine_chunks()
            packs = _packs(table.column("block").to_numpy(), index_words, True) if len(table) else []
            yield from (one(table.slice(a, b - a)) for a, b in packs)

    def one(table: pa.Table) -> pa.RecordBatch:
        order = pc.sort_indices(table, sort_keys=[("n", "descending"), ("word", "ascending")])
        table = table.take(order)
        words, n = table.column("word").to_pylist(), table.column("n").to_numpy()
        counts, best = near_in_index(words, n, *(table.column(c).to_numpy() for c in ("block", "m", "lo", "hi")))
        some = np.flatnonzero(counts)
        other = best[some]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([words[i] for i in some], pa.string()), pa.array(counts[some]), pa.array(n[other]),
                pa.array([words[i] for i in other], pa.string()),
            ],
            names=["word", "n_near", "best_n", "best"],
        )

    return batches


def spelling_forms(words: DataFrame, ratio: int = FORM_RATIO, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of a vocabulary ``word, n`` of distinct words.

    A word's form is its most frequent near word, if that is at least ``ratio`` times as frequent as
    the word; the root is where following forms ends. ``ratio`` is at least 2.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 or more")
    words = _written(words.select("word", "n"), "words")
    blocks = block_table(words, block_words)
    found = blocks.repartition("block").sortWithinPartitions("block").mapInArrow(
        _near(block_words), "word string, n_near bigint, best_n bigint, best string"
    )
    best = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("o"), "best")).alias("top"))
    form = F.when(-F.col("top.o") >= ratio * F.col("n"), F.col("top.best"))
    forms = _written(
        words.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), form.alias("form"),
            F.when(form.isNotNull(), -F.col("top.o")).alias("form_n"),
        ),
        "forms",
    )
    # Each round goes twice as far; a chain has at most log2(n) forms, as n at least doubles.
    roots = forms.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        step = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = _written(
            roots.join(step, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
            "roots",
        )
        if roots.where("moved").isEmpty():
            break
        roots = roots.select("word", "root")
    return forms.join(roots.select("word", "root"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
