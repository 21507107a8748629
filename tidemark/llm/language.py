"""Language of texts by a linear-chain conditional random field.

Each word is labelled, so text that switches language is followed word by word.
A word's features are its affixes, its character n-grams and what a lexicon of
the training texts says of it; transitions between labels are learned with them.
The training labels are those of whole texts, so sequences are spliced from
segments of texts of several languages: that is where the transitions see a
switch. Marginals come from forward-backward. A text's language is the one with
the highest mean marginal over its words, and that mean is its score. The shares
of the other languages and the runs of words of one language can be had as well.

Training takes at most ``TRAIN_TEXTS`` texts of each language, of a text over
``TRAIN_CHARS`` characters pieces spread over it; prediction takes every text, whole,
a long one piece by piece with the messages carried on. Null texts and
texts without a letter are ``und`` with score 0, and so is everything where no
language could be learned. Equal means go to the language that sorts first.
Every row is labelled on its own, repeated ones alike; null languages and ids
teach nothing.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark.llm.common import char_ngrams, mix64, numbered, on_executors, pieces, sample_order, spread_texts, sums_by, utf8

TRAIN_TEXTS = 200
_SALTS = 32
TRAIN_CHARS = 40_000
BUCKETS = 1 << 16
UNDETERMINED = "und"
LEAST_SCORE = 0.35
_GRAMS = (1, 2, 3)
_AFFIXES = (1, 2, 3, 4)
_SEQUENCE = 48
_BATCH = 128
_STEPS = 240
# What a worker holds beside its batch: the words and the distinct words of a piece, with their features.
_PIECE_BYTES = 8 << 20
_WORDS_AT_ONCE = 1 << 17
_TYPES_AT_ONCE = 1 << 12
_LETTER = re.compile(r"[^\W\d_]")


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # of a bucket for each language
    lexicon: dict[str, np.ndarray]  # log odds of words seen in training
    lexicon_weight: np.ndarray
    transitions: np.ndarray

    def emissions(self, words: list[str]) -> np.ndarray:
        """Score of each language for each word; some words at a time, as each has dozens of features."""
        out = np.zeros((len(words), len(self.languages)))
        for i in range(0, len(words), _TYPES_AT_ONCE):
            some = words[i : i + _TYPES_AT_ONCE]
            bucket, word = _buckets(some)
            n = np.maximum(np.bincount(word, minlength=len(some)), 1)[:, None]
            out[i : i + len(some)] = sums_by(word, self.weights[bucket], len(some)) / np.sqrt(n) + self.lexicon_weight * self.look_up(some)
        return out

    def look_up(self, words: list[str]) -> np.ndarray:
        none = np.zeros(len(self.languages))
        return np.array([self.lexicon.get(w, none) for w in words]).reshape(-1, len(self.languages))


def _plain(words: list[bytes]) -> list[str]:
    return [w.decode("utf-8", "replace").lower().strip(".,;:!?\"'()[]{}*_-") for w in words]


def _buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The features of each word as buckets: n-grams anywhere, and the affixes told apart from them."""
    hashes, word = char_ngrams(words, _GRAMS)
    affixes, of = [], []
    for n in _AFFIXES:
        for mark, cut in ((n, [w[:n] for w in words]), (n + 16, [w[-n:] for w in words])):
            distinct, at = np.unique(cut, return_inverse=True)
            affixes.append(mix64(np.array(_whole(distinct.tolist()), np.uint64) + np.uint64(mark))[at])
            of.append(np.arange(len(words)))
    hashes, word = np.concatenate([hashes, *affixes]), np.concatenate([word, *of])
    order = np.argsort(word, kind="stable")
    return (hashes[order] % np.uint64(BUCKETS)).astype(np.int64), word[order]


def _whole(strings: list[str]) -> list[int]:
    """A hash of each whole string."""
    out = []
    for s in strings:
        h = 0xCBF29CE484222325
        for c in s:
            h = ((h ^ ord(c)) * 0x100000001B3) & 0xFFFFFFFFFFFFFFFF
        out.append(h)
    return out


def marginals(emissions: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of every position of some sequences, and the expected transitions over all of them.

    ``emissions`` has the sequences one after the other, the longest first. The
    passes go over positions, all sequences that reach a position at once.
    """
    steps = int(lengths[0]) if len(lengths) else 0
    alive = np.searchsorted(-lengths, -np.arange(steps), side="left")  # how many sequences are longer than t
    begin = np.concatenate([[0], np.cumsum(alive)])
    within = np.arange(len(emissions)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    place = begin[within] + np.repeat(np.arange(len(lengths)), lengths)
    e = np.empty_like(emissions)
    e[place] = np.exp(emissions - emissions.max(axis=1, keepdims=True)) + 1e-30
    a = np.exp(transitions - transitions.max())
    forward, backward = np.empty_like(e), np.ones_like(e)
    for t in range(steps):
        now = slice(begin[t], begin[t + 1])
        x = e[now] if not t else (forward[begin[t - 1] : begin[t - 1] + alive[t]] @ a) * e[now]
        forward[now] = x / x.sum(axis=1, keepdims=True)
    expected = np.zeros_like(a)
    for t in range(steps - 2, -1, -1):
        then = slice(begin[t + 1], begin[t + 2])
        n = alive[t + 1]
        seen = e[then] * backward[then]
        x = seen @ a.T
        back = x / x.sum(axis=1, keepdims=True)
        before = forward[begin[t] : begin[t] + n]
        expected += (before / np.einsum("ij,ij->i", before, x)[:, None]).T @ seen
        backward[begin[t] : begin[t] + n] = back
    both = forward * backward
    both /= both.sum(axis=1, keepdims=True)
    return both[place], expected * a


def train(texts: list[bytes], languages: list[str], seed: int = 13) -> Model:
    names = sorted(set(languages))
    size = len(names)
    if not names:
        return Model([], np.zeros((BUCKETS, 0)), {}, np.zeros(0), np.zeros((0, 0)))
    rng = np.random.default_rng(seed)
    docs, raw = numbered(texts)
    words = _plain(raw)
    docs = [d[[bool(_LETTER.search(words[i])) for i in d]] if len(d) else d for d in docs]
    label = np.array([names.index(x) for x in languages], np.int64)
    used = [i for i, d in enumerate(docs) if len(d)]
    seen = np.zeros((len(words), size))
    for i in used:
        numbers, times = np.unique(docs[i], return_counts=True)
        seen[numbers, label[i]] += np.minimum(times, 5)
    share = (seen + 0.5) / (seen.sum(axis=0) + 0.5 * len(words) + 1)
    odds = np.log(share / share.mean(axis=1, keepdims=True))
    common = np.flatnonzero(seen.sum(axis=1) >= 5)
    lexicon = {words[i]: odds[i] for i in common}
    model = Model(names, np.zeros((BUCKETS, size)), lexicon, np.ones(size), np.zeros((size, size)))
    if size < 2 or not used:
        return model
    by_label = [[i for i in used if label[i] == k] for k in range(size)]
    present = [k for k in range(size) if by_label[k]]
    squares = [np.full_like(x, 1e-8) for x in (model.weights, model.lexicon_weight, model.transitions)]
    for _ in range(_STEPS):
        tokens, truth = [], []
        for _ in range(_BATCH):
            sequence, labels = [], []
            while len(sequence) < _SEQUENCE:
                k = present[rng.integers(len(present))]
                d = docs[by_label[k][rng.integers(len(by_label[k]))]]
                n = int(rng.integers(4, 2 * _SEQUENCE))
                start = int(rng.integers(max(1, len(d) - n + 1)))
                piece = d[start : start + min(n, _SEQUENCE - len(sequence))].tolist()
                sequence += piece
                labels += [k] * len(piece)
            tokens += sequence
            truth += labels
        y = np.array(truth)
        types, token = np.unique(np.array(tokens), return_inverse=True)
        plain = [words[i] for i in types]
        bucket, word = _buckets(plain)
        root = np.sqrt(np.maximum(np.bincount(word, minlength=len(plain)), 1))[:, None]
        known = model.look_up(plain)
        # The lexicon knows its training words too well; half of them are hidden each time.
        known[rng.random(len(plain)) < 0.5] = 0
        by_type = sums_by(word, model.weights[bucket], len(plain)) / root + model.lexicon_weight * known
        lengths = np.full(_BATCH, _SEQUENCE)
        p, expected = marginals(by_type[token], lengths, model.transitions)
        p[np.arange(len(y)), y] -= 1
        steps = np.zeros((size, size))
        rows = y.reshape(_BATCH, _SEQUENCE)
        np.add.at(steps, (rows[:, :-1].ravel(), rows[:, 1:].ravel()), 1)
        to_type = sums_by(token, p, len(plain))
        gradients = (
            sums_by(bucket, (to_type / root)[word], BUCKETS) + 1e-3 * model.weights,
            (to_type * known).sum(axis=0),
            expected - steps,
        )
        for x, s, g, rate in zip((model.weights, model.lexicon_weight, model.transitions), squares, gradients, (0.1, 0.05, 0.1), strict=True):
            s += np.square(g)
            x -= rate * g / np.sqrt(s)
    return model


def _long(emissions: Callable[[int, int], np.ndarray], n: int, transitions: np.ndarray, at_once: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first position, marginals) of the pieces of one sequence, the last piece first.

    On the way forward only the message into each piece is kept; on the way back
    the messages within a piece are computed again. So a sequence of any length
    holds one piece at a time.
    """
    a = np.exp(transitions - transitions.max())
    begins = range(0, n, at_once)

    def potentials(begin: int) -> np.ndarray:
        e = emissions(begin, min(n, begin + at_once))
        return np.exp(e - e.max(axis=1, keepdims=True)) + 1e-30

    def forwards(e: np.ndarray, into: np.ndarray) -> np.ndarray:
        out, last = np.empty_like(e), into
        for t in range(len(e)):
            x = last * e[t]
            out[t] = x / x.sum()
            last = out[t] @ a
        return out

    into = [np.ones(len(a))]
    for begin in begins[:-1]:
        into.append(forwards(potentials(begin), into[-1])[-1] @ a)
    back = np.ones(len(a))
    for begin, message in zip(reversed(begins), reversed(into), strict=True):
        e = potentials(begin)
        both = forwards(e, message)
        for t in range(len(e) - 1, -1, -1):
            both[t] *= back
            back = a @ (e[t] * back)
            back /= back.sum()
        yield begin, both / both.sum(axis=1, keepdims=True)


def _follow(model: Model, texts: list[bytes], use: Callable[[int, int, np.ndarray], None], at_once: int) -> list[np.ndarray]:
    """Calls ``use(text, begin, marginals)`` for the words with a letter of each text, maybe in several pieces.

    ``begin`` counts such words only; the result tells which words of each text they are.
    """
    docs, raw = numbered(texts)
    words = _plain(raw)
    lettered = np.fromiter((bool(_LETTER.search(w)) for w in words), bool, len(words))
    marked = [lettered[d] for d in docs]
    if not model.languages:
        return marked
    scores = np.zeros((len(words), len(model.languages)))
    scores[lettered] = model.emissions([w for w, ok in zip(words, lettered, strict=True) if ok])
    docs = [d[m] for d, m in zip(docs, marked, strict=True)]
    order = sorted((i for i, d in enumerate(docs) if len(d)), key=lambda i: -len(docs[i]))
    while order and len(docs[order[0]]) > at_once:
        i = order.pop(0)
        for begin, p in _long(lambda x, y, d=docs[i]: scores[d[x:y]], len(docs[i]), model.transitions, at_once):
            use(i, begin, p)
    while order:
        size, n = 0, 0
        while n < len(order) and size + len(docs[order[n]]) <= at_once:
            size += len(docs[order[n]])
            n += 1
        some, order = order[:n], order[n:]
        lengths = np.array([len(docs[i]) for i in some])
        p, _ = marginals(scores[np.concatenate([docs[i] for i in some])], lengths, model.transitions)
        for i, own in zip(some, np.split(p, np.cumsum(lengths)[:-1]), strict=True):
            use(i, 0, own)
    return marked


def shares(model: Model, texts: list[bytes], at_once: int = _WORDS_AT_ONCE) -> list[np.ndarray | None]:
    """The mean marginal of each language over the words of each text; None for texts without a letter."""
    sums = np.zeros((len(texts), len(model.languages)))
    n = np.zeros(len(texts), np.int64)

    def use(i: int, begin: int, p: np.ndarray) -> None:
        sums[i] += p.sum(axis=0)
        n[i] += len(p)

    _follow(model, texts, use, at_once)
    return [total / k if k else None for total, k in zip(sums, n.tolist(), strict=True)]


def _best(model: Model, share: np.ndarray | None) -> tuple[str, float]:
    if share is None:
        return UNDETERMINED, 0.0
    return model.languages[int(share.argmax())], float(min(1.0, share.max()))


def predict(model: Model, texts: list[bytes], at_once: int = _WORDS_AT_ONCE) -> list[tuple[str, float]]:
    """Language and score of each text."""
    return [_best(model, share) for share in shares(model, texts, at_once)]


def switches(model: Model, texts: list[bytes], at_once: int = _WORDS_AT_ONCE) -> list[list[tuple[int, int, str]]]:
    """(first word, word after the last, language) of the runs of one language in each text, by the likeliest label of each word.

    Words without a letter go with the word before them, leading ones with the
    first that has one. A text without a letter is one ``und`` run, an empty one none.
    """
    found: dict[int, dict[int, np.ndarray]] = {}

    def use(i: int, begin: int, p: np.ndarray) -> None:
        found.setdefault(i, {})[begin] = p.argmax(axis=1).astype(np.int16)

    out = []
    for i, marked in enumerate(_follow(model, texts, use, at_once)):
        if i not in found:
            out.append([(0, len(marked), UNDETERMINED)] if len(marked) else [])
            continue
        label = np.concatenate([found[i][begin] for begin in sorted(found[i])])
        each = label[np.maximum(np.cumsum(marked) - 1, 0)]
        cuts = [0, *(np.flatnonzero(np.diff(each)) + 1).tolist(), len(each)]
        out.append([(x, y, model.languages[each[x]]) for x, y in pairwise(cuts)])
    return out


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, n_texts: int = TRAIN_TEXTS, n_chars: int = TRAIN_CHARS) -> Model:
    """Train on a bounded sample of the texts of each language."""
    doc_id = F.col("doc_id").cast("long")
    known = docs.select(doc_id.alias("doc_id"), "lang", F.length("text").alias("n")).where(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & (F.col("n") > 0) & ~held_out(F.col("doc_id"))
    )
    picked = known.distinct().withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(_SALTS)))
    # A language is put in order by parts first, so that one task sees no more than their best.
    for keys in (("lang", "salt"), ("lang",)):
        turn = Window.partitionBy(*keys).orderBy(sample_order("doc_id"), "doc_id", "n")
        picked = picked.withColumn("turn", F.row_number().over(turn)).where(F.col("turn") <= n_texts)
    # The sample is bounded by the number of languages, and so is its broadcast.
    picked = F.broadcast(picked.select("doc_id", F.col("lang").alias("_lang"), "n"))
    texts = docs.select(doc_id.alias("doc_id"), "lang", "text", F.length("text").alias("n"))
    rows = texts.join(picked, ["doc_id", "n"]).where(F.col("lang") == F.col("_lang")).select("lang", "doc_id", "n", "text")
    # Of an id's rows of one length one, however many there are.
    one = F.min_by("text", F.xxhash64("text")).alias("text")
    rows = spread_texts(rows, n_chars).groupBy("lang", "doc_id", "n").agg(one).select("lang", "text").collect()
    rows.sort()
    return train([r["text"].encode() for r in rows], [r["lang"] for r in rows])


def label(docs: DataFrame, model: Model, names: tuple[str, ...] = ("lang_pred", "score")) -> DataFrame:
    """The rows with two more columns, language and score; columns of these names are replaced.

    A third name adds the share of each language, as a map that is empty for ``und``.
    """
    docs = docs.drop(*names)
    load = on_executors(docs.sparkSession, model)
    at = docs.columns.index("text")
    kinds = (T.StringType(), T.DoubleType(), T.MapType(T.StringType(), T.DoubleType()))
    schema = T.StructType([*docs.schema.fields, *map(T.StructField, names, kinds)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = load()
        for batch in pieces(batches, at, most=_PIECE_BYTES):
            found = shares(m, utf8(batch.column(at)))
            best = [_best(m, x) for x in found]
            parts = [[] if x is None else list(zip(m.languages, x.tolist(), strict=True)) for x in found]
            more = [
                pa.array([x for x, _ in best], pa.string()),
                pa.array([s for _, s in best], pa.float64()),
                pa.array(parts, pa.map_(pa.string(), pa.float64())),
            ][: len(names)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, *names])

    return docs.mapInArrow(run, schema)


def runs(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, first_word, end_word, lang) of the runs of one language in every text, as ``switches`` gives them."""
    load = on_executors(docs.sparkSession, model)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = load()
        for batch in pieces(batches, 1, most=_PIECE_BYTES):
            found = [(at, *one) for at, several in enumerate(switches(m, utf8(batch.column(1)))) for one in several]
            at, first, end, lang = zip(*found, strict=True) if found else [()] * 4
            ids = batch.column(0).take(pa.array(at, pa.int32()))
            columns = [ids, pa.array(first, pa.int64()), pa.array(end, pa.int64()), pa.array(lang, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "first_word", "end_word", "lang"])

    return rows.mapInArrow(run, "doc_id long, first_word long, end_word long, lang string")


def accepted(docs: DataFrame, model: Model, least: float = LEAST_SCORE) -> DataFrame:
    """The rows whose language can be told: not ``und``, and the mean marginal is at least ``least``."""
    names = ("_language", "_language_score")
    known = (F.col(names[0]) != UNDETERMINED) & (F.col(names[1]) >= least)
    return label(docs, model, names).where(known).select(*docs.columns)
