"""Language identification by a byte convolutional network, trained here in numpy.

Bytes are embedded, convolved by filters of several widths, max-pooled over a fixed-length window
and classified by a softmax. Letters are seen in lower case. A text is cut into windows from end to end; its prediction is the
mean of its windows' probabilities, weighted by their bytes.

Training takes at most ``SAMPLE_DOCS`` labelled texts per language, chosen by a hash of the id, and
one excerpt of each; the bound is a parameter. Prediction covers every byte of every text and sees
nothing but the text.

Edge cases: a text that is NULL or has no letter is ``und`` with score 0; without any labelled
training text everything is ``und``; with one language, every text with a letter gets it; ties go
to the first label in alphabetical order; repeated rows get equal predictions; an empty table gives
an empty result; columns named like a result are replaced, others pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barframe.llm.words import lower_latin, text_slices

WINDOW = 256
SAMPLE_DOCS = 1500
#: More distinct labels than this are refused: a label column is meant to hold few.
MAX_LABELS = 500
WIDTHS = (2, 3, 4)
EMBEDDING = 8
FILTERS = 16
EPOCHS = 8
BATCH = 64
LEARNING_RATE = 0.004
UNKNOWN = "und"
_PAD = 256


@dataclass
class ByteConvNet:
    """Weights of the network; ``labels`` are in alphabetical order."""

    labels: list[str]
    embedding: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    dense: np.ndarray
    bias: np.ndarray

    @staticmethod
    def new(labels: list[str], seed: int = 7) -> ByteConvNet:
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        embedding = rng.standard_normal((257, EMBEDDING)).astype(np.float32)
        embedding[_PAD] = 0
        return ByteConvNet(
            labels, embedding, [draw(w * EMBEDDING, FILTERS) for w in WIDTHS], [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
            draw(FILTERS * len(WIDTHS), len(labels)), np.zeros(len(labels), np.float32),
        )

    def forward(self, windows: np.ndarray) -> tuple[np.ndarray, list]:
        """Probabilities of windows (n x WINDOW byte codes), and what training needs."""
        embedded = self.embedding[windows]
        pooled, kept = [], []
        for w, filters, bias in zip(WIDTHS, self.filters, self.biases):
            patches = np.lib.stride_tricks.sliding_window_view(embedded, w, axis=1)  # n, positions, EMBEDDING, w
            flat = patches.transpose(0, 1, 3, 2).reshape(len(windows), -1, w * EMBEDDING)
            conv = flat @ filters
            best = conv.max(axis=1)
            pooled.append(np.maximum(best + bias, 0))
            kept.append((flat, conv, best))
        hidden = np.concatenate(pooled, axis=1)
        scores = hidden @ self.dense + self.bias
        scores -= scores.max(axis=1, keepdims=True)
        p = np.exp(scores)
        return p / p.sum(axis=1, keepdims=True), [hidden, kept]

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, *self.biases, self.dense, self.bias]

    def gradients(self, windows: np.ndarray, truth: np.ndarray) -> list[np.ndarray]:
        p, (hidden, kept) = self.forward(windows)
        n = len(windows)
        p[np.arange(n), truth] -= 1
        p /= n
        d_dense, d_bias = hidden.T @ p, p.sum(axis=0)
        d_hidden = (p @ self.dense.T) * (hidden > 0)
        d_embedding = np.zeros_like(self.embedding)
        d_filters, d_biases = [], []
        rows = np.arange(n)[:, None]
        for i, (w, (flat, conv, _)) in enumerate(zip(WIDTHS, kept)):
            d = d_hidden[:, i * FILTERS : (i + 1) * FILTERS]
            at = conv.argmax(axis=1)  # n, FILTERS
            d_filters.append(np.einsum("nfk,nf->kf", flat[rows, at], d))
            d_biases.append(d.sum(axis=0))
            d_patch = (d[:, :, None] * self.filters[i].T[None]).reshape(n, FILTERS, w, EMBEDDING)
            codes = windows[rows[:, :, None], at[:, :, None] + np.arange(w)]
            np.add.at(d_embedding, codes.ravel(), d_patch.reshape(-1, EMBEDDING))
        d_embedding[_PAD] = 0
        return [d_embedding, *d_filters, *d_biases, d_dense, d_bias]


def train(texts: list[bytes], labels: list[str], epochs: int = EPOCHS, seed: int = 7) -> ByteConvNet:
    """A network fitted to excerpts by Adam; half of them are shortened at random, so that short texts are known too."""
    names = sorted(set(labels))
    net = ByteConvNet.new(names, seed)
    truth = np.searchsorted(names, labels)
    rng = np.random.default_rng(seed)
    codes = np.full((len(texts), WINDOW), _PAD, np.int64)
    sizes = np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        part = lower_latin(np.frombuffer(t[:WINDOW], np.uint8))
        codes[i, : len(part)] = part
        sizes[i] = len(part)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parameters()]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for a in range(0, len(order), BATCH):
            own = order[a : a + BATCH]
            windows = codes[own].copy()
            short = np.where(rng.random(len(own)) < 0.5, rng.integers(6, WINDOW, len(own)), WINDOW)
            windows[np.arange(WINDOW)[None] >= short[:, None]] = _PAD
            step += 1
            for p, g, (m, v) in zip(net.parameters(), net.gradients(windows, truth[own]), moments):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= (LEARNING_RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def training_sample(df: DataFrame, id_col: str, text_col: str, label_col: str, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """``label, excerpt`` of at most ``sample_docs`` texts of each label, by smallest hash of the id."""
    rows = df.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull())
    counts = rows.groupBy(F.col(label_col).cast("string").alias("label")).count().limit(MAX_LABELS + 1).collect()
    if len(counts) > MAX_LABELS:
        raise ValueError(f"{label_col} holds more than {MAX_LABELS} labels")
    if not counts:
        return rows.select(F.col(label_col).cast("string").alias("label"), F.col(text_col).alias("excerpt"))
    span = 1 << 30
    draw = F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(span))
    # The share of rows that is looked at follows from the counts, so few rows meet in the last step.
    share = {r["label"]: min(span, int(span * (1.3 * sample_docs + 50) / r["count"])) for r in counts}
    limit = F.element_at(F.create_map(*[F.lit(x) for kv in share.items() for x in kv]), F.col(label_col).cast("string"))
    size = F.length(text_col)
    begin = F.pmod(F.xxhash64(F.lit(3), F.col(id_col).cast("string")), F.greatest(size - WINDOW, F.lit(0)).cast("long") + 1)
    few = rows.where(draw < limit).select(
        F.col(label_col).cast("string").alias("label"), draw.alias("draw"), F.col(id_col).cast("string").alias("id"),
        F.substring(F.col(text_col), (begin + 1).cast("int"), F.lit(WINDOW)).alias("excerpt"),
    )
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy("label").orderBy("draw", "id", "excerpt"))
    return few.withColumn("rank", rank).where(F.col("rank") <= sample_docs).select("label", "draw", "id", "excerpt")


def fit(df: DataFrame, id_col: str, text_col: str, label_col: str, sample_docs: int = SAMPLE_DOCS) -> ByteConvNet | None:
    """The network fitted to ``df``'s labelled texts; None if it has none."""
    sample = training_sample(df, id_col, text_col, label_col, sample_docs)
    rows = sorted((tuple(r) for r in sample.where(F.col("excerpt").rlike(r"\p{L}")).collect()), key=str)
    if not rows:
        return None
    return train([r[-1].encode() for r in rows], [r[0] for r in rows])


def slice_probabilities(net: ByteConvNet, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean probabilities (rows x labels) over the windows of each text; empty texts get zeros."""
    data = lower_latin(data)
    lengths = np.diff(offsets)
    per_row = -(-lengths // WINDOW)
    rows = np.repeat(np.arange(len(lengths)), per_row)
    within = np.arange(len(rows)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    begin = offsets[rows] + within * WINDOW
    size = np.minimum(offsets[rows + 1] - begin, WINDOW)
    total = np.zeros((len(lengths), len(net.labels)))
    for a in range(0, len(rows), 256):
        at = begin[a : a + 256, None] + np.arange(WINDOW)
        codes = data[np.minimum(at, len(data) - 1)].astype(np.int64)
        codes[np.arange(WINDOW)[None] >= size[a : a + 256, None]] = _PAD
        p = net.forward(codes)[0].astype(float)
        np.add.at(total, rows[a : a + 256], p * size[a : a + 256, None])
    return total / np.maximum(lengths, 1)[:, None]


def predict(df: DataFrame, net: ByteConvNet | None, text_col: str = "text") -> DataFrame:
    """``df`` with ``lang_pred`` and ``score`` (the mean probability of that label)."""
    names = [c for c in df.columns if c not in ("lang_pred", "score", "__letter")]
    letter: Column = F.coalesce(F.col(f"`{text_col}`").rlike(r"\p{L}"), F.lit(False))
    kept = df.select(*[f"`{c}`" for c in names], letter.alias("__letter"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema[:-1]), "lang_pred string", "score double"])

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            texts, letters = batch.column(names.index(text_col)), batch.column(len(names)).to_numpy(zero_copy_only=False)
            for row, data, offsets in text_slices(texts):
                n = len(offsets) - 1
                part, seen = batch.slice(row, n), letters[row : row + n]
                if net is None:
                    labels, scores = [UNKNOWN] * n, np.zeros(n)
                else:
                    p = slice_probabilities(net, data, offsets)
                    best = p.argmax(axis=1)
                    labels = [net.labels[i] if s else UNKNOWN for i, s in zip(best, seen)]
                    scores = np.where(seen, np.minimum(p[np.arange(n), best], 1.0), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(labels, pa.string()), pa.array(scores)], names=[*names, "lang_pred", "score"]
                )

    return kept.mapInArrow(batches, schema)
