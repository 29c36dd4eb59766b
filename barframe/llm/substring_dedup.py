"""Substring dedup by recompression.

A text's words are level 0. A round of recompression first names runs of equal symbols, then, by a
coin for each symbol, splits the symbols into left and right ones and names every pair of a left
and a following right one. A name is a hash of what it stands for, so a round gives equal
substrings equal names in all documents without exchanging anything; only the symbols at a
substring's ends may depend on what surrounds it. Every symbol therefore carries the range of
words that decides it (its context).

Each window of ``window`` words is given one symbol that its own words decide: of the highest
level with such a symbol, the longest one (of equally long ones that with the smallest hash). Equal windows get equal symbols at equal
offsets. Repeats within a few megabytes of texts are settled before any shuffle. A first round then counts
the symbols' names alone: most occur once and are not heard of again. Occurrences of the others meet by a
second shuffle, each with the hashes of its windows, and all but the first of equal windows are
marked. The windows of symbols that hold a large share of all rows meet by their own keys, so no task
gets a passage of many documents whole; words that marked windows cover are removed.
A shared name reveals a repeat, and a 64-bit hash of each window's words, made apart from the names, verifies it.

Edge cases: NULL and blank texts have no words; texts shorter than the window lose nothing;
windows are judged on the input, not on what is left; rows go by id, a NULL id before all others,
and rows of one id by the hash of their text, each cleaned by its own windows; of equal rows with
one id, each is the first occurrence for the other, so repeats of a whole row lose nothing by each other; an empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barframe.llm.words import find_words, mix, span_hashes, text_slices, word_hashes
from barframe.plans.workspace import scratch_path

WINDOW = 20
ROUNDS = 2
#: A symbol with so many rows, and this share of all rows, is spread over the tasks by its windows.
HOT_ROWS = 64
HOT_SHARE = 1 / 65536
#: The Bloom filter of repeated names, which goes to every task, has 2 ** BLOOM_BITS bits (32 MB).
BLOOM_BITS = 28
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def _salt(i: int) -> np.uint64:
    return np.uint64(i * int(_PAIR) & 0xFFFFFFFFFFFFFFFF)


def _window_keys(name: np.ndarray, before: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """A window is known by its symbol's name, the words before the symbol, and its own hash."""
    return mix(name ^ mix(hashes + _PAIR * before.astype(np.uint64)))


class Symbols:
    """One level: names, spans and contexts (word ranges) of the symbols of several documents.

    ``edge`` marks symbols whose context reaches beyond their document; no window decides them.
    """

    def __init__(self, name, start, end, low, high, edge, doc):
        self.name, self.start, self.end = name, start, end
        self.low, self.high, self.edge, self.doc = low, high, edge, doc

    @staticmethod
    def words(hashes: np.ndarray, doc: np.ndarray) -> Symbols:
        at = np.arange(len(hashes))
        return Symbols(hashes, at, at + 1, at, at + 1, np.zeros(len(at), bool), doc)

    def neighbours(self) -> np.ndarray:
        """Whether a symbol and the next belong to one document."""
        return self.doc[1:] == self.doc[:-1]

    def name_runs(self) -> Symbols:
        n = len(self.name)
        if not n:
            return self
        near = self.neighbours()
        head = np.concatenate([[True], ~(near & (self.name[1:] == self.name[:-1]))])
        first = np.flatnonzero(head)
        last = np.concatenate([first[1:], [n]]) - 1
        length = (last - first + 1).astype(np.uint64)
        name = np.where(length > 1, mix(self.name[first] * _PAIR + length), self.name[first])
        # A run ends where its neighbours differ, so both neighbours belong to its context.
        left, right = np.maximum(first - 1, 0), np.minimum(last + 1, n - 1)
        has_left, has_right = (first > 0) & (self.doc[left] == self.doc[first]), (last < n - 1) & (self.doc[right] == self.doc[last])
        edge = ~has_left | ~has_right | self.edge[first] | self.edge[last]
        edge |= (has_left & self.edge[left]) | (has_right & self.edge[right])
        return Symbols(
            name, self.start[first], self.end[last], np.where(has_left, self.low[left], self.low[first]),
            np.where(has_right, self.high[right], self.high[last]), edge, self.doc[first],
        )

    def name_pairs(self, coin: int) -> Symbols:
        n = len(self.name)
        if not n:
            return self
        near = self.neighbours()
        is_left = mix(self.name + _salt(coin)) & np.uint64(1) == 1
        pair = near & is_left[:-1] & ~is_left[1:]
        second = np.concatenate([[False], pair])
        first = np.flatnonzero(~second)
        paired = np.concatenate([pair, [False]])[first]
        last = first + paired
        name = np.where(paired, mix(mix(self.name[first] + _PAIR) ^ (self.name[last] * _PAIR)), self.name[first])
        # A symbol that stays alone does so because of the neighbour on its open side.
        left, right = np.maximum(first - 1, 0), np.minimum(first + 1, n - 1)
        looks_right, looks_left = ~paired & is_left[first], ~paired & ~is_left[first]
        has_left, has_right = (first > 0) & (self.doc[left] == self.doc[first]), (first < n - 1) & (self.doc[right] == self.doc[first])
        edge = self.edge[first] | self.edge[last] | (looks_left & ~has_left) | (looks_right & ~has_right)
        edge |= (looks_left & has_left & self.edge[left]) | (looks_right & has_right & self.edge[right])
        return Symbols(
            name, self.start[first], self.end[last], np.where(looks_left & has_left, self.low[left], self.low[first]),
            np.where(looks_right & has_right, self.high[right], self.high[last]), edge, self.doc[first],
        )


def levels(hashes: np.ndarray, doc: np.ndarray, rounds: int = ROUNDS) -> list[Symbols]:
    """The symbols of each level, from the words up."""
    out = [Symbols.words(hashes, doc)]
    for i in range(rounds):
        out.append(out[-1].name_runs().name_pairs(i + 1))
    return out


def _lowest(priority: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Index of the (first) lowest priority in each range begin:end; ranges are not empty."""
    table = [np.arange(len(priority))]
    span = 1
    longest = int((end - begin).max()) if len(begin) else 1
    while 2 * span <= longest:
        a = table[-1][:-span] if span < len(table[-1]) else table[-1][:0]
        b = table[-1][span:]
        table.append(np.where(priority[b] < priority[a], b, a))
        span *= 2
    power = np.frexp((end - begin).astype(float))[1] - 1
    out = np.empty(len(begin), np.int64)
    for k, best in enumerate(table):
        own = power == k
        a, b = best[begin[own]], best[end[own] - (1 << k)]
        out[own] = np.where(priority[b] < priority[a], b, a)
    return out


def window_symbols(hashes: np.ndarray, first: np.ndarray, window: int = WINDOW, rounds: int = ROUNDS):
    """For every window start: its symbol's name and first word. ``first`` bounds the documents' words."""
    n = len(hashes)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    starts = np.arange(max(n - window + 1, 0))
    starts = starts[doc[starts] == doc[starts + window - 1]] if len(starts) else starts
    name, at = np.zeros(len(starts), np.uint64), np.zeros(len(starts), np.int64)
    todo = np.arange(len(starts))
    for level, symbols in reversed(list(enumerate(levels(hashes, doc, rounds)))):
        if not len(todo):
            break
        # Symbols whose context is not within their document have none of the words to decide them.
        sound = np.flatnonzero(~symbols.edge)
        low, high = symbols.low[sound], symbols.high[sound]
        named = mix(symbols.name[sound] + _salt(level + 1))
        p = starts[todo]
        # The longest symbol first: the more words a symbol stands for, the fewer places share it.
        words = np.minimum(symbols.end[sound] - symbols.start[sound], 63).astype(np.uint64)
        priority = ((np.uint64(63) - words) << np.uint64(58)) | (named >> np.uint64(6))
        begin, end = np.searchsorted(low, p), np.searchsorted(high, p + window, side="right")
        some = begin < end
        own = todo[some]
        best = _lowest(priority, begin[some], end[some])
        name[own], at[own] = named[best], symbols.start[sound][best]
        todo = todo[~some]
    return starts, name, at


def _ranked(ids: pa.Array) -> np.ndarray:
    """Each id's place in Spark's order (NULL first); equal ids share theirs."""
    codes = pa.compute.dictionary_encode(ids, null_encoding="encode")
    order = pa.compute.sort_indices(codes.dictionary, null_placement="at_start").to_numpy()
    places = np.empty(len(order), np.int64)
    places[order] = np.arange(len(order))
    return places[codes.indices.to_numpy()]


def _slices(batch: pa.RecordBatch, window: int, rounds: int) -> Iterator[tuple]:
    """For each slice of texts (``id, mark, text``): ids, marks, first words, and by window its start, symbol, symbol's first word, hash, row, key and whether it is a repeat."""
    for row, data, offsets in text_slices(batch.column(2)):
        begin, end, first = find_words(data, offsets)
        hashes = word_hashes(data, begin, end)
        starts, name, at = window_symbols(hashes, first, window, rounds)
        if not len(starts):
            continue
        own = span_hashes(hashes, starts, starts + window)
        rows = np.searchsorted(first, starts, side="right") - 1
        ids, marks = (batch.column(c).slice(row, len(first) - 1) for c in (0, 1))
        # Rows go by id, and rows of one id by the hash of their text.
        pairs = np.stack([_ranked(ids), marks.to_numpy()], axis=1)
        rank = np.unique(pairs, axis=0, return_inverse=True)[1].ravel()
        key = _window_keys(name, at - starts, own)
        # In the order of ids and starts, the first of a key is the earliest of this slice.
        place = starts - first[rows]
        order = np.argsort((rank[rows] << 40) + place, kind="stable")
        _, index, inverse = np.unique(key[order], return_index=True, return_inverse=True)
        earliest = order[index][inverse]
        again = np.empty(len(starts), bool)
        again[order] = (rank[rows[order]] != rank[rows[earliest]]) | (place[order] != place[earliest])
        yield ids, marks, first, starts, name, at, own, rows, key, again


def _runs(starts: np.ndarray, name: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where runs of windows begin that share one occurrence of a symbol."""
    return np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (name[1:] != name[:-1]) | (starts[1:] != starts[:-1] + 1)]))


def _bloom_bits(names: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of a filter of ``2 ** bits`` that stand for each name."""
    again = mix(names + _PAIR)
    shift = np.uint64(64 - bits)
    return (names >> shift).astype(np.int64), (again >> shift).astype(np.int64)


class SharedSymbols:
    """What the tasks know of the symbols of all texts: the hot ones, and which may occur twice."""

    def __init__(self, hot: np.ndarray, bits: np.ndarray | None):
        self.hot, self.bits = hot, bits

    def is_hot(self, names: np.ndarray) -> np.ndarray:
        if not len(self.hot):
            return np.zeros(len(names), bool)
        return self.hot[np.minimum(np.searchsorted(self.hot, names), len(self.hot) - 1)] == names

    def is_shared(self, names: np.ndarray) -> np.ndarray:
        """False only for names that occur once."""
        if self.bits is None:
            return np.ones(len(names), bool)
        out = np.ones(len(names), bool)
        for bit in _bloom_bits(names, len(self.bits).bit_length() + 5):
            out &= self.bits[bit >> 6] >> (bit & 63).astype(np.uint64) & np.uint64(1) == 1
        return out


def shared_symbols(df: DataFrame, id_col: str, text_col: str, window: int = WINDOW, rounds: int = ROUNDS) -> SharedSymbols:
    """The hot symbols, and a Bloom filter of all names with two or more rows.

    Hot are those with at least ``HOT_ROWS`` rows and the share ``HOT_SHARE`` of all rows, at most ``1 /
    HOT_SHARE`` of them. Every task sends its names alone, added up by slice, with no windows. The
    filter has ``2 ** BLOOM_BITS`` bits whatever the corpus; a name that it takes for shared costs a row and
    changes no result.
    """
    spark, filter_bits = df.sparkSession, BLOOM_BITS

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for _, _, _, starts, name, at, _, _, _, again in _slices(batch, window, rounds):
                starts, name, at = starts[~again], name[~again], at[~again]
                kinds, n = np.unique(name[_runs(starts, name, at)], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(kinds.view(np.int64)), pa.array(n)], names=["name", "n"])

    def bits(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            both = np.concatenate(_bloom_bits(batch.column(0).to_numpy().view(np.uint64), filter_bits))
            yield pa.RecordBatch.from_arrays([pa.array(both >> 6), pa.array(both & 63)], names=["block", "bit"])

    path = scratch_path(spark, "symbol-counts")
    # The tasks have added up their slices, so another map-side table would only grow.
    named = _rows(df, id_col, text_col).mapInArrow(batches, "name bigint, n bigint").repartition("name").groupBy("name").agg(F.sum("n").alias("n"))
    # Names that occur once count for the total only.
    named.select(F.when(F.col("n") > 1, F.col("name")).alias("name"), "n").write.parquet(path)
    counts = spark.read.schema("name bigint, n bigint").parquet(path)
    total = counts.agg(F.sum("n")).first()[0] or 0
    repeated = counts.where(F.col("name").isNotNull())
    hot = repeated.where(F.col("n") >= max(HOT_ROWS, total * HOT_SHARE)).toArrow()
    blocks = repeated.select("name").mapInArrow(bits, "block bigint, bit bigint").groupBy("block").agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit as int))")).alias("bits")
    ).toArrow()
    bitmap = np.zeros(1 << (filter_bits - 6), np.uint64)
    bitmap[blocks.column(0).to_numpy()] = blocks.column(1).to_numpy().view(np.uint64)
    return SharedSymbols(np.sort(hot.column("name").to_numpy().view(np.uint64)), bitmap)


def _rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, mark, text``: the mark, a hash of the text, tells rows of one id apart."""
    return df.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("mark"), F.col(text_col).alias("text"))


def _anchors(window: int, rounds: int, shared=None):
    """A mapper from ``id, mark, text`` to one row for each chosen symbol that may be shared, with its windows' hashes.

    Windows that occurred before in the same slice of texts are settled here; they come as ranges, rows
    with the negative length as ``offset``, dealt by document. ``shared`` holds the ``SharedSymbols``: rows of
    a symbol that occurs once are not sent, and the windows of hot symbols go each by its own key, so what
    many documents share is dealt over as many tasks as it has different windows, and a window goes
    there once a slice.
    """

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value if shared is not None else SharedSymbols(np.zeros(0, np.uint64), None)
        for batch in found:
            for ids, marks, first, starts, name, at, own, rows, key, again in _slices(batch, window, rounds):
                if again.any():
                    where = np.flatnonzero(again)
                    cut = np.flatnonzero(np.concatenate([[True], (np.diff(starts[where]) != 1) | (np.diff(rows[where]) != 0)]))
                    low = where[cut]
                    length = starts[where[np.concatenate([cut[1:], [len(where)]]) - 1]] - starts[low] + 1
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(mix(key[low] + mix(rows[low])).view(np.int64)), ids.take(pa.array(rows[low])), marks.take(pa.array(rows[low])),
                            pa.array(starts[low] - first[rows[low]]), pa.array((-length).astype(np.int32)), pa.array([b""] * len(low), pa.binary()),
                        ],
                        names=["name", "id", "mark", "start", "offset", "hashes"],
                    )
                sent = ~again & known.is_shared(name)
                starts, name, at, own, rows, key = (x[sent] for x in (starts, name, at, own, rows, key))
                if not len(starts):
                    continue
                spread = known.is_hot(name)
                name, at = np.where(spread, key, name), np.where(spread, starts, at)
                cut = _runs(starts, name, at)
                sizes = np.concatenate([cut, [len(starts)]]).astype(np.int32) * 8
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(name[cut].view(np.int64)), ids.take(pa.array(rows[cut])), marks.take(pa.array(rows[cut])),
                        pa.array(starts[cut] - first[rows[cut]]), pa.array((at[cut] - starts[cut]).astype(np.int32)),
                        pa.Array.from_buffers(pa.binary(), len(cut), [None, pa.py_buffer(sizes.tobytes()), pa.py_buffer(own.tobytes())]),
                    ],
                    names=["name", "id", "mark", "start", "offset", "hashes"],
                )

    return batches


def _repeats(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From symbols sorted by name, id, mark and start to ranges of window starts that occurred before.

    Of a name that goes on in the next batch only the distinct windows seen so far are kept, each
    with its first occurrence.
    """
    held_name, held_keys, held_ids, held_starts = None, np.zeros(0, np.uint64), [], np.zeros(0, np.int64)
    for batch in found:
        settled = pa.compute.less(batch.column("offset"), 0)
        if pa.compute.any(settled).as_py():
            ranges = batch.filter(settled)
            low = ranges.column("start").to_numpy()
            high = low - ranges.column("offset").to_numpy() - 1
            yield pa.RecordBatch.from_arrays([ranges.column("id"), ranges.column("mark"), pa.array(low), pa.array(high)], names=["id", "mark", "low", "high"])
            batch = batch.filter(pa.compute.invert(settled))
        if not batch.num_rows:
            continue
        name = batch.column(0).to_numpy()
        ids, marks = batch.column("id"), batch.column("mark")
        start, offset = batch.column("start").to_numpy(), batch.column("offset").to_numpy()
        binary = batch.column("hashes")
        bounds = np.frombuffer(binary.buffers()[1], np.int32)[binary.offset : binary.offset + len(binary) + 1]
        hashes = np.frombuffer(binary.buffers()[2], np.uint64, count=bounds[-1] // 8)[bounds[0] // 8 :]
        sizes = np.diff(bounds) // 8
        row = np.repeat(np.arange(len(name)), sizes)
        step = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        key = _window_keys(name.view(np.uint64)[row], offset[row] - step, hashes)
        at = start[row] + step
        code = pa.compute.dictionary_encode(ids, null_encoding="encode").indices.to_numpy()
        code = np.unique(np.stack([code, marks.to_numpy()], axis=1), axis=0, return_inverse=True)[1].ravel()[row]
        kinds, index, inverse = np.unique(key, return_index=True, return_inverse=True)
        # The rows are sorted, so the first of a kind is its first occurrence; the same occurrence again is no repeat.
        first = index[inverse]
        again = (at != at[first]) | (code != code[first])
        if held_name is not None and name[0] == held_name:
            here = np.searchsorted(held_keys, kinds)
            known = (here < len(held_keys)) & (held_keys[np.minimum(here, len(held_keys) - 1)] == kinds)
            seen = known[inverse]
            again |= seen
            same_start = np.flatnonzero(seen & (held_starts[np.minimum(here, len(held_keys) - 1)][inverse] == at))
            for i in same_start:  # perhaps the first occurrence itself, in a repeated row
                again[i] = held_ids[here[inverse[i]]] != (ids[int(row[i])].as_py(), marks[int(row[i])].as_py())
        else:
            known = np.zeros(len(kinds), bool)
        tail = name[row[index]] == name[-1]
        keep = tail & ~known
        new_ids = [(ids[int(i)].as_py(), marks[int(i)].as_py()) for i in row[index[keep]]]
        if held_name is not None and held_name == name[-1]:
            keys = np.concatenate([held_keys, kinds[keep]])
            order = np.argsort(keys)
            held_keys, held_starts = keys[order], np.concatenate([held_starts, at[index[keep]]])[order]
            both = [*held_ids, *new_ids]
            held_ids = [both[i] for i in order]
        else:
            held_keys, held_starts, held_ids = kinds[keep], at[index[keep]], new_ids
        held_name = name[-1]
        where = np.flatnonzero(again)
        if len(where):
            cut = np.concatenate([[True], (np.diff(where) != 1) | (np.diff(row[where]) != 0)])
            head = where[cut]
            last = where[np.concatenate([np.flatnonzero(cut)[1:], [len(where)]]) - 1]
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(row[head])), marks.take(pa.array(row[head])), pa.array(at[head]), pa.array(at[last])],
                names=["id", "mark", "low", "high"],
            )


def repeated_windows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, rounds: int = ROUNDS) -> DataFrame:
    """``id, mark, low, high``: ranges of window starts whose words also start earlier; ``mark`` is the XXH64 of the row's text."""
    kind = df.schema[id_col].dataType.simpleString()
    shared = df.sparkSession.sparkContext.broadcast(shared_symbols(df, id_col, text_col, window, rounds))
    anchors = _rows(df, id_col, text_col).mapInArrow(
        _anchors(window, rounds, shared), f"name bigint, id {kind}, mark bigint, start bigint, offset int, hashes binary"
    )
    dealt = anchors.repartition("name").sortWithinPartitions("name", "id", "mark", "start")
    return dealt.mapInArrow(_repeats, f"id {kind}, mark bigint, low bigint, high bigint")


def _cleaned(window: int, texts: bool):
    """A mapper from ``id, text, lows, highs`` to the counts and the kept words, as a text or its digest."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            n_words, n_removed, kept = [], [], []
            lows, highs = batch.column(2), batch.column(3)
            for row, data, offsets in text_slices(batch.column(1)):
                begin, end, first = find_words(data, offsets)
                gone = np.zeros(len(begin) + 1, np.int64)
                for i in range(len(first) - 1):
                    if (low := lows[row + i]).is_valid:
                        size = first[i + 1] - first[i]
                        low, high = low.values.to_numpy(), highs[row + i].values.to_numpy() + window
                        np.add.at(gone, first[i] + np.minimum(low, size), 1)
                        np.add.at(gone, first[i] + np.minimum(high, size), -1)
                stay = np.cumsum(gone[:-1]) == 0
                text = data.tobytes()
                words = [text[a:b] for a, b in zip(begin[stay].tolist(), end[stay].tolist())]
                bounds = np.concatenate([[0], np.cumsum(stay)])[first]
                for i in range(len(first) - 1):
                    left = b" ".join(words[bounds[i] : bounds[i + 1]])
                    kept.append(left.decode() if texts else hashlib.sha256(left).hexdigest())
                n_words.append(np.diff(first))
                n_removed.append(np.diff(first) - np.diff(bounds))
            join = lambda x: pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), join(n_words), join(n_removed), pa.array(kept, pa.string())],
                names=["id", "n_words", "n_removed", "kept"],
            )

    return batches


def dedup_substrings(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, rounds: int = ROUNDS,
    kept: str = "text",
) -> DataFrame:
    """``id_col, n_words, n_removed, kept`` of every row: the kept words joined by one space (``kept="sha256"``: their digest)."""
    if kept not in ("text", "sha256"):
        raise ValueError("kept is 'text' or 'sha256'")
    kind = df.schema[id_col].dataType.simpleString()
    ranges = repeated_windows(df, id_col, text_col, window, rounds).groupBy(F.col("id").alias("own"), F.col("mark").alias("own_mark")).agg(
        F.collect_list(F.struct("low", "high")).alias("ranges")
    )
    ranges = ranges.select("own", "own_mark", F.col("ranges.low").alias("lows"), F.col("ranges.high").alias("highs"))
    same = F.col("id").eqNullSafe(F.col("own")) & (F.col("mark") == F.col("own_mark"))
    joined = _rows(df, id_col, text_col).join(ranges, same, "left").select("id", "text", "lows", "highs")
    return joined.mapInArrow(
        _cleaned(window, kept == "text"), f"id {kind}, n_words bigint, n_removed bigint, kept string"
    ).withColumnRenamed("id", id_col)
