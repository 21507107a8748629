"""Toxicity of texts by subword bags.

A word is the mean of the vectors of its character n-grams, so a misspelling
nobody labelled shares most of them with the word it stands for. The mean over a
window of words goes through a linear softmax; vectors and softmax are trained
together. A label holds for a whole text while few of its words may be toxic, so
training alternates: the model picks the windows that speak most for the label,
then learns from those. A text's score is that of its strongest window,
calibrated on labelled texts left out of training.

Training takes at most ``TRAIN_TEXTS`` labelled texts of each class, of a text over
``TRAIN_CHARS`` characters pieces spread over it; scoring takes every text, whole. Null texts count as
empty; an id with several texts teaches by one; an empty text has no window and gets the calibrated score of the bias.
Every row is scored on its own, repeated ones alike. Of several labels of one id
the highest holds; null labels and ids teach nothing. Without labels of both
classes every score is the share of toxic labels (0 without any).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import char_ngrams, numbered, on_executors, pieces, sample_order, spread_texts, sums_by, utf8, written

TRAIN_TEXTS = 1000
TRAIN_CHARS = 40_000
BUCKETS = 1 << 18
SIZES = (3, 4, 5)
DIMENSIONS = 4
WINDOW = 8
STRIDE = 4
_ROUNDS = 3
_BATCH = 512
_STEPS = 60  # at least, in a round
# An n-gram of fewer training texts than this says nothing.
_MIN_TEXTS = 3


@dataclass
class Model:
    vectors: np.ndarray  # one per bucket
    softmax: np.ndarray  # two classes by dimensions
    bias: np.ndarray
    slope: float  # calibration of a text's best logit
    offset: float

    def word_logits(self, words: list[bytes]) -> np.ndarray:
        """What each word adds to a window's logit: the softmax is linear in the mean, so words can be taken apart."""
        bucket, word = _buckets(words)
        weight = self.vectors @ (self.softmax[1] - self.softmax[0])
        n = np.maximum(np.bincount(word, minlength=len(words)), 1)
        return np.bincount(word, weight[bucket], len(words)) / n

    def score(self, logits: np.ndarray) -> float:
        """Score of a text from its words' logits."""
        x = self.slope * (_strongest(logits) + self.bias[1] - self.bias[0]) + self.offset
        return float(1 / (1 + np.exp(-np.clip(x, -60, 60))))


def _buckets(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    plain = [w.decode("utf-8", "replace").lower().strip(".,;:!?\"'()[]{}*_-") for w in words]
    hashes, word = char_ngrams(plain, SIZES)
    return (hashes % np.uint64(BUCKETS)).astype(np.int64), word


def _starts(n: int, stride: int = STRIDE) -> np.ndarray:
    """Where the windows of a text begin; the last one reaches its end. Training steps, scoring takes every window."""
    return np.arange(0, max(1, n - WINDOW + stride), stride) if n else np.zeros(0, np.int64)


def _windowed(logits: np.ndarray, stride: int = STRIDE) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(logits)])
    start = _starts(len(logits), stride)
    end = np.minimum(start + WINDOW, len(logits))
    return (total[end] - total[start]) / (end - start)


def _strongest(logits: np.ndarray) -> float:
    return float(_windowed(logits, 1).max()) if len(logits) else 0.0


def _fit(windows: list[np.ndarray], labels: np.ndarray, model: Model, words: tuple[np.ndarray, np.ndarray, np.ndarray], squares: list[np.ndarray], rng) -> None:
    """One pass of Adagrad over windows of word numbers; ``words`` has the buckets of all words, their ends and counts."""
    bucket, ends, n_grams = words
    silent = ~model.vectors.any(axis=1)
    for at in np.array_split(rng.permutation(len(windows)), max(1, len(windows) // _BATCH)):
        length = np.array([len(windows[i]) for i in at])
        used, token = np.unique(np.concatenate([windows[i] for i in at]), return_inverse=True)
        window = np.repeat(np.arange(len(at)), length)
        n = n_grams[used]
        gram = np.repeat(ends[used] - np.cumsum(n), n) + np.arange(n.sum())
        gram_bucket, gram_word = bucket[gram], np.repeat(np.arange(len(used)), n)
        mean = sums_by(gram_word, model.vectors[gram_bucket], len(used)) / np.maximum(n, 1)[:, None]
        bag = sums_by(window, mean[token], len(at)) / length[:, None]
        z = bag @ model.softmax.T + model.bias
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(at)), labels[at]] -= 1
        p /= len(at)
        to_word = sums_by(token, ((p @ model.softmax) / length[:, None])[window], len(used))
        to_bucket = sums_by(gram_bucket, (to_word / np.maximum(n, 1)[:, None])[gram_word], BUCKETS)
        for x, s, g, rate in zip((model.vectors, model.softmax, model.bias), squares, (to_bucket, p.T @ bag, p.sum(axis=0)), (0.1, 0.1, 0.1), strict=True):
            s += np.square(g)
            x -= rate * g / np.sqrt(s)
        model.vectors[silent] = 0


def _calibrate(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, with a weak prior; scaled first so that few steps do.

    Either class weighs the same, however many of its texts there are: few toxic
    labels say little about how rare toxic texts are, and must not silence the score.
    """
    centre, spread = float(x.mean()), float(x.std()) or 1.0
    z = np.stack([(x - centre) / spread, np.ones_like(x)], axis=1)
    weight = np.where(y == 1, len(y) / max(1.0, 2 * y.sum()), len(y) / max(1.0, 2 * (1 - y).sum()))
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (weight * (p - y)) + 0.01 * w
        curve = (z * (weight * p * (1 - p))[:, None]).T @ z + 0.01 * np.eye(2)
        w -= np.linalg.solve(curve, slope)
    return float(w[0] / spread), float(w[1] - w[0] * centre / spread)


def train(texts: list[bytes], labels: list[int], seed: int = 11) -> Model:
    rng = np.random.default_rng(seed)
    y = np.array(labels, np.int64)
    model = Model(rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)), rng.normal(0, 0.1, (2, DIMENSIONS)), np.zeros(2), 0.0, 0.0)
    if len(set(labels)) < 2:
        share = (y.sum() + 1e-6) / (len(y) + 1) if len(y) else 1e-9
        model.offset = float(np.log(share / (1 - share)))
        return model
    docs, words = numbered(texts)
    bucket, word = _buckets(words)
    order = np.argsort(word, kind="stable")
    n_grams = np.bincount(word, minlength=len(words))
    grams = (bucket[order], np.cumsum(n_grams), n_grams)
    texts_with = np.zeros(len(words), np.int64)
    for d in docs:
        texts_with[np.unique(d)] += 1
    model.vectors[np.bincount(bucket, texts_with[word], BUCKETS) < _MIN_TEXTS] = 0
    held = np.zeros(len(docs), bool)
    for label in (0, 1):
        held[np.flatnonzero(y == label)[::5]] = True
    cut = [[d[s : s + WINDOW] for s in _starts(len(d))] for d in docs]
    squares = [np.full_like(x, 1e-12) for x in (model.vectors, model.softmax, model.bias)]
    for turn in range(_ROUNDS):
        logits = model.word_logits(words)
        windows, of = [], []
        for i in np.flatnonzero(~held):
            some = cut[i]
            if not turn:  # a share of the many clean windows is enough to begin with
                some = [w for w in some if y[i] or rng.random() < 0.3]
            elif some:
                value = _windowed(logits[docs[i]])
                # Of a toxic text the windows near its best; of any other the ones the model errs on, and some at random.
                near = value >= value.max() / 2 if y[i] and value.max() > 0 else value >= value.max()
                near |= (rng.random(len(some)) < 0.2) if not y[i] else False
                some = [w for w, use in zip(some, near, strict=True) if use]
            windows += some
            of += [y[i]] * len(some)
        toxic = [w for w, label in zip(windows, of, strict=True) if label]
        more = rng.integers(0, max(1, len(toxic)), max(0, len(windows) - 2 * len(toxic)) if toxic else 0)
        windows += [toxic[i] for i in more]
        of += [1] * len(more)
        for _ in range(max(2, -(-_STEPS * _BATCH // max(1, len(windows))))):
            _fit(windows, np.array(of, np.int64), model, grams, squares, rng)
    logits = model.word_logits(words)
    best = np.array([_strongest(logits[d]) for d in docs]) + model.bias[1] - model.bias[0]
    model.slope, model.offset = _calibrate(best[held], y[held].astype(float))
    return model


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, n_texts: int = TRAIN_TEXTS, n_chars: int = TRAIN_CHARS) -> Model:
    """Train on a bounded sample of the labelled texts, the same number of each class where there are enough."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic")
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg((F.max("toxic") > 0).cast("int").alias("label"))
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.col("text").isNotNull())
    # Only ids that have a text use up the sample.
    known = written(texts.select("doc_id").join(known, "doc_id").distinct(), "toxicity-labels")
    picked = [known.where(F.col("label") == c).orderBy(sample_order("doc_id"), "doc_id").limit(n_texts) for c in (0, 1)]
    # At most 2 * n_texts ids, so the broadcast is bounded.
    rows = texts.join(F.broadcast(picked[0].union(picked[1])), "doc_id").select("doc_id", "text", "label")
    # Of an id's rows one, however many there are.
    rows = spread_texts(rows, n_chars).groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text")).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["text"], r["label"]))
    return train([r["text"].encode() for r in rows], [r["label"] for r in rows])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row."""
    load = on_executors(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = load()
        for batch in pieces(batches, 1):
            numbers, words = numbered(utf8(batch.column(1)))
            logits = m.word_logits(words)
            scores = [m.score(logits[d]) for d in numbers]
            yield pa.record_batch({"doc_id": batch.column(0), "score": pa.array(scores, pa.float64())})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
