"""Language-model scoring by a weighted backoff automaton.

Word n-grams (orders 1 to 3) are counted over all training texts, smoothed by absolute discounting
and laid out as an automaton: a state for each context, an arc for each kept n-gram with the
logarithm of its probability, and a failure arc to the shorter context with the logarithm of the
backoff weight. A text is read once from left to right; a word without an arc follows failure arcs
and adds their weights. The root gives every word its add-one-half probability, exactly
``(c + 0.5) / (N + 0.5 (V + 1))``, which is also the base model.

Every pair and triple of the training texts is a candidate, whatever its words. An n-gram becomes an
arc when it occurs at least ``MIN_COUNT`` times, whatever the size of the corpus. An n-gram is counted only if
its shorter parts reach the cutoff, without which it cannot. Unigrams have no cutoff.

No task holds the whole automaton. The texts are cut into slices of whole texts, about ``SLICE_TOKENS``
tokens, read once and stored as word numbers. A slice asks ``keyed_sums`` for the counts of its own words, then of its
pairs, then of its triples, and for what the arcs of its contexts add up to anywhere. Of that it lays out
the part of the automaton that its texts can reach: the same states, arcs, weights and failure arcs, so
the scores are those of the whole. Memory in a task follows the slice (or its longest text) and the bucket,
and nothing of the model goes through the driver but the number of tokens and of distinct words.

Words are known by 64-bit hashes. Edge cases: a NULL text is the empty text, whose only token is
the end; without training texts N = V = 0 and every token has probability 1; repeated rows are
scored and counted each; ties in frequency go by hash; an empty table gives an empty result.
Only the named columns are read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barframe.llm.keyed_sums import (
    answers,
    ask_and_answer,
    bounds,
    bucket_count,
    by_key,
    joined,
    numbered,
    pack,
    pack_sorted,
    split,
    sums,
    unpack,
    unpack_sorted,
)
from barframe.llm.words import find_words, lower_ascii, mix, text_slices, word_hashes
from barframe.plans.workspace import scratch_path

#: A slice of texts is closed when it has so many tokens.
SLICE_TOKENS = 1 << 20
#: Bytes of text that are cut into words at once.
PIECE_BYTES = 1 << 20
MIN_COUNT = 2
DISCOUNT = 0.75
#: Lanes of the traversal hold so many tokens; a lane begins with the state that its text has there.
LANE = 512
#: The end of a text, as a word hash.
END = np.uint64(0x51ED270B9F1C2D35)
#: The begin of a text as a context, in the sums by context.
BEGIN = np.uint64(0xA24BAED4963EE407)
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: The third word of a triple goes by the lower five bytes of its hash, beside the hash of its pair.
_WORD_BYTES = 5
_WORD_MASK = np.uint64((1 << 8 * _WORD_BYTES) - 1)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens (words in lower case, then the end, for each text) and each text's first token."""
    data = lower_ascii(data)
    starts, ends, first = find_words(data, offsets)
    out = np.insert(word_hashes(data, starts, ends), first[1:], END)
    return out, first + np.arange(len(first))


@dataclass
class Dictionary:
    """The most frequent words: sorted hashes, their counts, and their rank by frequency."""

    words: np.ndarray
    counts: np.ndarray
    ranks: np.ndarray

    @staticmethod
    def of(words: np.ndarray, counts: np.ndarray) -> Dictionary:
        order = np.argsort(words, kind="stable")
        words, counts = words[order], counts[order]
        ranks = np.empty(len(words), np.int64)
        ranks[np.lexsort((words, -counts))] = np.arange(len(words))
        return Dictionary(words, counts, ranks)


def _indices(ordered: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Place of each key in the sorted array, or -1."""
    if not len(ordered):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(ordered, keys), len(ordered) - 1)
    return np.where(ordered[at] == keys, at, -1)


def pair_codes(rank: np.ndarray, first: np.ndarray, words: int, frequent: int) -> np.ndarray:
    """``context * (words + 1) + word`` at each token, -1 where a word is not among the ``frequent``.

    ``rank`` are the tokens' ranks, ``first`` each text's first token; the begin of a text is the
    context ``words``.
    """
    before = np.concatenate([[words], rank[:-1]])
    before[first] = words
    usable = (rank < frequent) & ((before < frequent) | (before == words))
    return np.where(usable, np.where(usable, before, 0) * (words + 1) + np.where(usable, rank, 0), -1)


@dataclass
class BackoffAutomaton:
    """States: 0 the root, then a state for each of the W dictionary words, W + 1 the begin, then pairs of words.

    The whole automaton, or the part of it that some texts reach.
    """

    dictionary: Dictionary
    unigram: np.ndarray  # log10 probability by dictionary index
    arcs: np.ndarray  # sorted state * (W + 1) + word rank
    weights: np.ndarray  # log10 probability of each arc
    failure: np.ndarray  # by state: the shorter context
    failure_weight: np.ndarray  # by state: log10 of the backoff weight
    pairs: np.ndarray = field(repr=False)  # sorted codes of the pairs that are states

    @property
    def words(self) -> int:
        return len(self.dictionary.words)

    def next_state(self, state: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The longest context that ends with the word just read."""
        last, known = self.last[state], rank < self.words
        word = np.where(known, rank, 0)
        pair = _indices(self.pairs, np.where(known & (last >= 0), last * (self.words + 1) + word, -1))
        return np.where(pair >= 0, self.words + 2 + pair, np.where(known, word + 1, 0))

    @functools.cached_property
    def last(self) -> np.ndarray:
        """By state: the code of its last word (-1 for the root)."""
        return np.concatenate([[-1], np.arange(self.words + 1), self.pairs % (self.words + 1)])

    @functools.cached_property
    def branches(self) -> np.ndarray:
        """By state: whether it has arcs, here or in the whole automaton (which leaves a backoff weight below 1)."""
        out = self.failure_weight < 0
        out[self.arcs // (self.words + 1)] = True
        return out

    def step(self, state: np.ndarray, at: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Read one token in each lane: log10 probabilities and next states.

        A token outside the dictionary (``at`` -1) adds its failure weights only. A state without
        arcs has a backoff weight of 1 and fails to the root.
        """
        total = np.zeros(len(state))
        here = state.copy()
        target = np.minimum(rank, self.words)
        open_ = np.flatnonzero(self.branches[here])
        hit = np.zeros(len(state), bool)
        while len(open_):
            i = _indices(self.arcs, here[open_] * (self.words + 1) + target[open_])
            found = i >= 0
            total[open_[found]] += self.weights[i[found]]
            hit[open_[found]] = True
            open_ = open_[~found]
            total[open_] += self.failure_weight[here[open_]]
            here[open_] = self.failure[here[open_]]
            open_ = open_[here[open_] > 0]
        root = ~hit & (at >= 0)
        total[root] += self.unigram[at[root]]
        return total, self.next_state(state, rank)

    def score(self, at: np.ndarray, rank: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Log10 probability of each text; tokens outside the dictionary add no unigram part."""
        per_text = -(-np.diff(first) // LANE)
        lane_text = np.repeat(np.arange(len(per_text)), per_text)
        within = np.arange(len(lane_text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
        begin = first[lane_text] + within * LANE
        end = np.minimum(begin + LANE, first[lane_text + 1])
        # The state at a lane's begin follows from the text's two tokens before it.
        state = np.full(len(begin), self.words + 1)
        for back in (2, 1):
            inner = np.flatnonzero(within > 0)
            state[inner] = self.next_state(state[inner] if back == 1 else np.zeros(len(inner), np.int64), rank[begin[inner] - back])
        order = np.argsort(begin - end, kind="stable")  # the longest lanes first
        begin, end, state, lane_text = begin[order], end[order], state[order], lane_text[order]
        out = np.zeros(len(first) - 1)
        sums = np.zeros(len(begin))
        lengths = end - begin
        for i in range(int(lengths[0]) if len(lengths) else 0):
            n = int(np.searchsorted(-lengths, -i, side="left"))  # lanes with more than i tokens
            p, state[:n] = self.step(state[:n], at[begin[:n] + i], rank[begin[:n] + i])
            sums[:n] += p
        np.add.at(out, lane_text, sums)
        return out


def build_automaton(
    dictionary: Dictionary, pairs: np.ndarray, pair_n: np.ndarray, triples: np.ndarray, triple_n: np.ndarray,
    texts: int, total: int, kinds: int,
) -> BackoffAutomaton:
    """The whole automaton of smoothed n-grams, from the sorted codes of all kept pairs and triples.

    A pair's code is ``pair_codes``'; a triple's is the place of its first pair times ``words + 1``, plus the
    word. ``texts, total, kinds``: training texts, tokens, distinct tokens.
    """
    base = len(dictionary.words) + 1
    after_word = np.bincount(pairs // base, pair_n, base), np.bincount(pairs // base, minlength=base)
    after_pair = np.bincount(triples // base, triple_n, len(pairs)), np.bincount(triples // base, minlength=len(pairs))
    return lay_out(dictionary, pairs, pair_n, triples, triple_n, after_word, after_pair, texts, total, kinds)


def lay_out(
    dictionary: Dictionary, pairs: np.ndarray, pair_n: np.ndarray, triples: np.ndarray, triple_n: np.ndarray,
    after_word: tuple[np.ndarray, np.ndarray], after_pair: tuple[np.ndarray, np.ndarray], texts: int, total: int, kinds: int,
) -> BackoffAutomaton:
    """States and arcs for some of the n-grams; each context comes with the counts and the number of all its arcs.

    ``after_word`` is by rank of the context (the begin last), ``after_pair`` by pair.
    """
    words = len(dictionary.words)
    base = words + 1
    by_rank = np.argsort(dictionary.ranks)
    p1 = (dictionary.counts + 0.5) / (total + 0.5 * (kinds + 1))
    unigram, p1 = np.log10(p1), p1[by_rank]
    context_count = np.concatenate([dictionary.counts[by_rank], [texts]]).astype(float)
    rest = 1 - (after_word[0] - DISCOUNT * after_word[1]) / np.maximum(context_count, 1)
    context, word = pairs // base, pairs % base
    p2 = (pair_n - DISCOUNT) / context_count[context] + rest[context] * p1[word]

    first, word3 = triples // base, triples % base
    second = word[first]
    rest3 = 1 - (after_pair[0] - DISCOUNT * after_pair[1]) / pair_n
    lower_at = _indices(pairs, second * base + word3)
    lower = rest[second] * p1[word3]
    lower = np.where(lower_at >= 0, p2[lower_at], lower) if len(pairs) else lower
    p3 = (triple_n - DISCOUNT) / pair_n[first] + rest3[first] * lower

    present = np.flatnonzero(after_pair[1])
    states = words + 2 + len(present)
    failure, weight = np.zeros(states, np.int64), np.zeros(states)
    weight[1 : words + 2] = np.log10(rest)
    failure[words + 2 :] = word[present] + 1
    weight[words + 2 :] = np.log10(rest3[present])
    arcs = np.concatenate([(context + 1) * base + word, (words + 2 + np.searchsorted(present, first)) * base + word3])
    order = np.argsort(arcs)
    return BackoffAutomaton(
        dictionary, unigram, arcs[order], np.log10(np.concatenate([p2, p3]))[order], failure, weight, pairs[present]
    )


def cut_slices(df: DataFrame, text_col: str, learn: Column, keep: dict[str, Column], path: str, first_id: int = 0) -> None:
    """Write the texts as slices of word numbers, with which of them to learn from and the columns ``keep``."""
    texts = df.select(*[c.alias(n) for n, c in keep.items()], F.coalesce(learn, F.lit(False)).alias("__learn"), F.col(text_col).alias("__text"))
    names = list(keep)

    def closed(row_id: int, held: list) -> pa.RecordBatch:
        words, place = np.unique(np.concatenate([w for w, *_ in held]), return_inverse=True)
        begin = np.cumsum([0, *(len(w) for w, *_ in held)])
        at = np.concatenate([place[b:][own] for b, (_, own, *_) in zip(begin, held)])
        lengths = np.concatenate([np.diff(first) for _, _, first, _ in held])
        rows = pa.Table.from_batches([r for *_, r in held]).combine_chunks()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(rows)
        learned = rows.column("__learn").to_numpy().astype(np.uint64)
        values = [[row_id], [len(at)], [pack_sorted(words)], [pack(at)], [pack(lengths)], [pack(learned)], [sink.getvalue().to_pybytes()]]
        kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 5]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=columns)

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row_id = first_id + (TaskContext.get().partitionId() << 24)
        held, size = [], 0
        for batch in found:
            rows = pa.RecordBatch.from_arrays(batch.columns[:-1], names=[*names, "__learn"])
            for row, data, offsets in text_slices(batch.column(len(names) + 1), PIECE_BYTES):
                own, first = tokens(data, offsets)
                held.append((*np.unique(own, return_inverse=True), first, rows.slice(row, len(first) - 1)))
                size += len(own)
                if size >= SLICE_TOKENS:
                    yield closed(row_id, held)
                    row_id, held, size = row_id + 1, [], 0
        if held:
            yield closed(row_id, held)

    columns = ["slice", "n_tokens", "words", "at", "lengths", "learn", "rows"]
    kinds = ["bigint", "bigint", *["binary"] * 5]
    texts.mapInArrow(batches, ", ".join(f"{n} {k}" for n, k in zip(columns, kinds))).write.parquet(path)


class Slice:
    """The tokens of some texts, and step by step what the other slices know of their n-grams."""

    def __init__(self, row: dict):
        self.id = row["slice"]
        self.words = unpack_sorted(row["words"])
        self.at = unpack(row["at"]).astype(np.int64)
        lengths = unpack(row["lengths"]).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(lengths)])
        self.learn = np.repeat(unpack(row["learn"]), lengths)

    def read_words(self, path: str) -> None:
        """With the counts of the words: all pairs of frequent words, by code."""
        found = joined(answers(path, self.id), "a").astype(np.int64)
        self.dictionary = Dictionary.of(self.words, found)
        self.base = len(self.words) + 1
        self.rank = self.dictionary.ranks[self.at]
        self.by_rank = np.append(self.words[np.argsort(self.dictionary.ranks)], BEGIN)
        codes = pair_codes(self.rank, self.first[:-1], len(self.words), int((found >= MIN_COUNT).sum()))
        self.usable = np.flatnonzero(codes >= 0)
        self.codes, self.place = numbered(codes[self.usable], self.base**2)
        self.hashes = mix(self.by_rank[self.codes // self.base] * _BASE + self.by_rank[self.codes % self.base])
        self.order = np.argsort(self.hashes)

    def read_pairs(self, path: str) -> None:
        """With the counts of the pairs: all triples of kept pairs, by code."""
        found = answers(path, self.id)
        n, owned = np.zeros(len(self.codes), np.int64), np.zeros(len(self.codes), bool)
        n[self.order], owned[self.order] = joined(found, "a"), joined(found, "b") > 0
        kept = n > 0
        self.pairs, self.pair_n, self.owned = self.codes[kept], n[kept], owned[kept]
        at = self.pair = np.full(len(self.at), -1)
        at[self.usable] = np.where(kept, np.cumsum(kept) - 1, -1)[self.place]
        self.before = np.concatenate([[-1], at[:-1]])
        self.before[self.first[:-1]] = -1
        self.inner = np.flatnonzero((at >= 0) & (self.before >= 0))
        triples = self.before[self.inner] * self.base + self.rank[self.inner]
        self.triples, self.triple_place = numbered(triples, len(self.pairs) * self.base)
        # Contexts by hash; the triples by context, then by word.
        self.contexts = self.hashes[kept]
        self.context_order = np.argsort(self.contexts)
        turn = np.empty(len(self.contexts), np.int64)
        turn[self.context_order] = np.arange(len(turn))
        self.turn = turn[self.triples // self.base]
        self.third = self.by_rank[self.triples % self.base] & _WORD_MASK
        if len(turn) < 1 << (64 - 8 * _WORD_BYTES):
            self.triple_order = np.argsort((self.turn.astype(np.uint64) << np.uint64(8 * _WORD_BYTES)) | self.third)
        else:
            self.triple_order = np.lexsort((self.third, self.turn))
        del self.codes, self.place, self.hashes, self.order
        self.all_words = np.append(self.words, BEGIN)
        self.word_order = np.argsort(self.all_words)

    def ask_words(self, buckets: int) -> Iterator[tuple]:
        n, cuts = np.bincount(self.at, self.learn, len(self.words)), bounds(self.words, buckets)
        for b, (i, j) in enumerate(zip(cuts, cuts[1:])):
            yield b, pack_sorted(self.words[i:j]), pack(n[i:j]), None, None

    def ask_pairs(self, buckets: int) -> Iterator[tuple]:
        n = np.bincount(self.place, self.learn[self.usable], len(self.codes))[self.order]
        keys = self.hashes[self.order]
        cuts = bounds(keys, buckets)
        for b, (i, j) in enumerate(zip(cuts, cuts[1:])):
            yield b, pack_sorted(keys[i:j]), pack(n[i:j]), None, None

    def ask_triples(self, buckets: int) -> Iterator[tuple]:
        """The triples by context, and (from bucket ``buckets`` on) the arcs of this slice's own pairs by word."""
        n = np.bincount(self.triple_place, self.learn[self.inner], len(self.triples))[self.triple_order]
        third = self.third[self.triple_order]
        keys, each = self.contexts[self.context_order], np.bincount(self.turn, minlength=len(self.contexts))
        cuts, ends = bounds(keys, buckets), np.concatenate([[0], np.cumsum(each)])
        for b, (i, j) in enumerate(zip(cuts, cuts[1:])):
            x, y = ends[i], ends[j]
            yield b, pack_sorted(keys[i:j]), pack(each[i:j]), pack(third[x:y]), pack(n[x:y])
        rank = np.append(self.dictionary.ranks, self.base - 1)[self.word_order]
        context = (self.pairs // self.base)[self.owned]
        total = np.bincount(context, self.pair_n[self.owned], self.base)[rank]
        arcs = np.bincount(context, minlength=self.base)[rank]
        words = self.all_words[self.word_order]
        cuts = bounds(words, buckets)
        for b, (i, j) in enumerate(zip(cuts, cuts[1:])):
            yield buckets + b, pack_sorted(words[i:j]), pack(total[i:j]), pack(arcs[i:j]), None

    def read_triples(self, path: str, buckets: int, total: int, kinds: int) -> None:
        """With the counts of the triples and the arcs of the contexts: the part of the automaton that the texts reach."""
        found = answers(path, self.id)
        by_pair, by_word = [r for r in found if r["bucket"] < buckets], [r for r in found if r["bucket"] >= buckets]
        n = np.zeros(len(self.triples), np.int64)
        n[self.triple_order] = joined(by_pair, "c")
        after_pair, after_word = np.zeros((2, len(self.pairs))), np.zeros((2, self.base))
        after_pair[:, self.context_order] = [joined(by_pair, c) for c in "ab"]
        rank = np.append(self.dictionary.ranks, self.base - 1)[self.word_order]
        after_word[:, rank] = [joined(by_word, c) for c in "ab"]
        texts = int(self.dictionary.counts[np.searchsorted(self.words, END)])
        kept = n > 0
        self.automaton = lay_out(
            self.dictionary, self.pairs, self.pair_n, self.triples[kept], n[kept], tuple(after_word), tuple(after_pair), texts, total, kinds
        )
        triple = np.full(len(self.at), -1)
        triple[self.inner] = np.where(kept, np.cumsum(kept) - 1, -1)[self.triple_place]
        self.triples, self.triple = self.triples[kept], triple

    def score(self) -> np.ndarray:
        """``automaton.score`` of the texts, whose states and arcs are known by place and not searched."""
        a, base = self.automaton, self.base
        state_of = _indices(a.pairs, self.pairs)
        state_of = np.where(state_of >= 0, state_of + base + 1, self.pairs % base + 1)
        state = np.concatenate([[0], self.rank[:-1] + 1])
        inner = self.before >= 0
        state[inner] = state_of[self.before[inner]]
        state[self.first[:-1]] = base
        short = _indices(a.arcs, (self.pairs // base + 1) * base + self.pairs % base)
        long = _indices(a.arcs, state_of[self.triples // base] * base + self.triples % base)
        # Each token goes by the arc of its state, or by failure arcs to that of a shorter context or to the root.
        total, done = np.zeros(len(state)), self.triple >= 0
        total[done] = a.weights[long[self.triple[done]]]
        fails = ~done & (state > base)
        total[fails] = a.failure_weight[state[fails]]
        state[fails] = a.failure[state[fails]]
        found = ~done & (self.pair >= 0)
        total[found] += a.weights[short[self.pair[found]]]
        rest = ~done & ~found
        total[rest] += a.failure_weight[state[rest]] + a.unigram[self.at[rest]]
        return np.add.reduceat(total, self.first[:-1])


def word_totals(bucket: int, asked: list[dict]) -> tuple[list[tuple], int, int]:
    """To each slice the counts of its words."""
    keys, n = [unpack_sorted(r["a"]) for r in asked], [unpack(r["b"]) for r in asked]
    kinds, number, _ = by_key(keys)
    total = sums(number, n, kinds)
    return [(pack(x), None, None) for x in split(total[number], keys)], int(total.sum()), int((total > 0).sum())


def pair_totals(bucket: int, asked: list[dict]) -> tuple[list[tuple], int, int]:
    """To each slice the counts of its pairs (0 below the cutoff), and which it owns: a kept pair has one owner."""
    keys, n = [unpack_sorted(r["a"]) for r in asked], [unpack(r["b"]) for r in asked]
    kinds, number, first = by_key(keys)
    total = sums(number, n, kinds)
    total[total < MIN_COUNT] = 0
    owned = np.zeros(len(number), np.uint64)
    owned[first[total > 0]] = 1
    return [(pack(x), pack(o), None) for x, o in zip(split(total[number], keys), split(owned, keys))], int(total.sum()), kinds


def context_totals(bucket: int, asked: list[dict]) -> tuple[list[tuple], int, int]:
    """To each slice the counts and the number of the arcs of its contexts, and the counts of its triples (0 below the cutoff)."""
    keys = [unpack_sorted(r["a"]) for r in asked]
    kinds, number, _ = by_key(keys)
    if asked[0]["d"] is None:  # words, with what each slice adds
        found = [sums(number, [unpack(r[c]) for r in asked], kinds)[number] for c in "bc"]
        return [(pack(x), pack(y), None) for x, y in zip(*(split(f, keys) for f in found))], 0, kinds
    third, n = [unpack(r["c"]) for r in asked], [unpack(r["d"]) for r in asked]
    context = np.repeat(number, np.concatenate([unpack(r["b"]) for r in asked]).astype(np.int64)).astype(np.uint64)
    triples, triple, first = by_key([(context << np.uint64(8 * _WORD_BYTES)) | np.concatenate(third)])
    total = sums(triple, n, triples)
    total[total < MIN_COUNT] = 0
    of = context[first].astype(np.int64)
    found = [np.bincount(of, total, kinds).astype(np.uint64)[number], np.bincount(of, total > 0, kinds).astype(np.uint64)[number]]
    parts = zip(*(split(f, keys) for f in found), split(total[triple], third))
    return [tuple(pack(x) for x in part) for part in parts], int(total.sum()), triples


@dataclass
class Model:
    """The slices of the texts it was trained on, the answers to their words, and the totals."""

    slices: str
    words: str
    buckets: int
    total: int
    kinds: int
    kept: str  # the columns of the slices' rows, as a schema


def _count_words(spark: SparkSession, slices: list[str]) -> tuple[str, int, int, int]:
    path = scratch_path(spark, "lm-words")
    rows = spark.read.parquet(*slices)
    buckets = bucket_count(rows.agg(F.sum("n_tokens")).first()[0] or 0)
    ask_and_answer(rows.select("slice", "words", "at", "lengths", "learn"), lambda row: Slice(row).ask_words(buckets), word_totals, path)
    total, kinds = spark.read.schema("total bigint, kinds bigint").parquet(path).agg(F.sum("total"), F.sum("kinds")).first()
    return path, buckets, int(total or 0), int(kinds or 0)


def train(df: DataFrame, text_col: str, learn: Column, keep: dict[str, Column] | None = None) -> Model:
    """Learn from all texts of ``df`` for which ``learn`` holds.

    With ``keep`` the other texts are read along, and ``score_own`` scores all rows of ``df``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "lm-slices")
    cut_slices(df if keep is not None else df.where(learn), text_col, learn, keep or {}, path)
    words, buckets, total, kinds = _count_words(spark, [path])
    return Model(path, words, buckets, total, kinds, _schema(df, keep or {}))


def _schema(df: DataFrame, keep: dict[str, Column]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*[c.alias(n) for n, c in keep.items()]).schema)


def score(df: DataFrame, model: Model, text_col: str, keep: dict[str, Column]) -> DataFrame:
    """The columns ``keep`` and ``n_tokens, n_known, train_tokens, base_score, score`` of every text."""
    spark = df.sparkSession
    path = scratch_path(spark, "lm-slices")
    cut_slices(df, text_col, F.lit(False), keep, path, 1 << 60)
    words, buckets, total, kinds = _count_words(spark, [model.slices, path])
    own = Model(path, words, buckets, total, kinds, _schema(df, keep))
    return _scored(spark, own, [model.slices, path])


def score_own(spark: SparkSession, model: Model) -> DataFrame:
    """As ``score``, of the rows that the model was trained with, by their columns ``keep``; each text is read once."""
    return _scored(spark, model, [model.slices])


def _scored(spark: SparkSession, model: Model, slices: list[str]) -> DataFrame:
    buckets, total, kinds, words = model.buckets, model.total, model.kinds, model.words
    pairs, contexts = scratch_path(spark, "lm-pairs"), scratch_path(spark, "lm-contexts")

    def ask_pairs(row: dict) -> Iterator[tuple]:
        own = Slice(row)
        own.read_words(words)
        return own.ask_pairs(buckets)

    def ask_triples(row: dict) -> Iterator[tuple]:
        own = Slice(row)
        own.read_words(words)
        own.read_pairs(pairs)
        return own.ask_triples(buckets)

    asking = spark.read.parquet(*slices).select("slice", "words", "at", "lengths", "learn")
    ask_and_answer(asking, ask_pairs, pair_totals, pairs)
    ask_and_answer(asking, ask_triples, context_totals, contexts)

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                own = Slice(row)
                own.read_words(words)
                own.read_pairs(pairs)
                own.read_triples(contexts, buckets, total, kinds)
                rows = pa.ipc.open_stream(row["rows"]).read_all().drop_columns("__learn")
                n = len(own.first) - 1
                text = np.repeat(np.arange(n), np.diff(own.first))
                values = [
                    np.diff(own.first), np.bincount(text, own.dictionary.counts[own.at] > 0, n).astype(np.int64), np.full(n, total),
                    np.bincount(text, own.automaton.unigram[own.at], n), own.score(),
                ]
                for name, value in zip(added, values):
                    rows = rows.append_column(name, pa.array(value))
                yield from rows.to_batches()

    added = {"n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double"}
    schema = ", ".join([*([model.kept] if model.kept else []), *(f"{n} {k}" for n, k in added.items())])
    return spark.read.parquet(model.slices).select("slice", "words", "at", "lengths", "learn", "rows").mapInArrow(batches, schema)
