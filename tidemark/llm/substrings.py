"""Removal of repeated passages by compacting a De Bruijn graph of words.

Edges are runs of ``WINDOW`` words. Of the edges only those matter that occur
again, so each is first judged by its anchor, the smallest hash among its inner
runs of ``ANCHOR`` words: an edge that occurs twice has an anchor that does. Along
a text, edges with repeated anchors chain into paths; a path also ends before
every edge whose hash says so, so that copies of a passage fall into the same
paths whatever surrounds them. Equal paths are compacted into their first
occurrence. What the paths leave open, edges shared by different paths at the
branches, is settled edge by edge among the first occurrences. Every occurrence
carries its coordinates, document and place, and the words are taken out there.

An edge is identified by 96 bits of hash. The first occurrence is the one in the
smallest doc_id, there the first; a null doc_id comes after all others. Rows that
repeat an id and its text are one occurrence and give the same result each;
other texts of one id are told apart, and the earlier place comes first. Null
texts have no words; texts of fewer than ``WINDOW`` words lose none. An empty
table gives an empty result.

Groups of copies never meet in one task: what a task finds repeated within its
own rows is settled there, and only one occurrence of it is shuffled on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import mix64, numbered, pieces, utf8, written

WINDOW = 20
ANCHOR = 8
_CUT = np.uint64(15)  # one edge in 16 begins a path
_PLACE_BITS = 24
_REF_MASK = (1 << (64 - _PLACE_BITS)) - 1
_LAST = (1 << 63) - 1
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


class _Texts:
    """The words of some texts as one array of hashes, with each text's place in it."""

    def __init__(self, texts: list[bytes]):
        numbers, words = numbered(texts)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
        self.lengths = np.array([len(n) for n in numbers], np.int64)
        self.ends = np.cumsum(self.lengths)
        self.starts = self.ends - self.lengths
        self.words = hashes[np.concatenate([*numbers, np.zeros(0, np.int64)])]
        self.of = np.repeat(np.arange(len(texts)), self.lengths)

    def runs(self, length: int, base: np.uint64 = _BASES[0]) -> np.ndarray:
        """Hash of the words from each place on; those that reach over a text's end mean nothing."""
        n = max(0, len(self.words) - length + 1)
        h = np.zeros(n, np.uint64)
        for i in range(length):
            h = h * base + self.words[i : i + n]
        return mix64(h)

    def edges(self) -> np.ndarray:
        """Places of all edges."""
        return np.flatnonzero(self.ends[self.of] - np.arange(len(self.words)) >= WINDOW)

    def anchors(self, edges: np.ndarray, inner: np.ndarray) -> np.ndarray:
        """The place of each edge's anchor."""
        if not len(edges):
            return edges
        near = np.lib.stride_tricks.sliding_window_view(inner, WINDOW - ANCHOR + 1)
        out = np.empty(len(edges), np.int64)
        for i in range(0, len(edges), 1 << 18):
            some = edges[i : i + (1 << 18)]
            out[i : i + len(some)] = some + near[some].argmin(axis=1)
        return out


def _unpacked(batch: pa.RecordBatch, column: str = "z") -> list[bytes]:
    unpack = zstandard.ZstdDecompressor()
    return [unpack.decompress(z) for z in batch.column(column).to_pylist()]


def _sizes_unpacked(packed: pa.Array) -> np.ndarray:
    return np.array([zstandard.frame_content_size(z) if z else 0 for z in packed.to_pylist()], np.int64)


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All values of a list column, and the row each is of."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(column)), lengths)


def _repeated_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, at, known) of each anchor; ``at`` is the text's reference and the place in it.

    An anchor with equals among the same rows is known to be repeated: one of
    them keeps the hash to tell other tasks, the others get one of their own.
    """
    for part in pieces(batches, 1):
        texts = _Texts(utf8(part.column(1)))
        inner = texts.runs(ANCHOR)
        places = np.unique(texts.anchors(texts.edges(), inner))
        ref = part.column(0).to_numpy().view(np.uint64) & np.uint64(_REF_MASK)
        within = (places - texts.starts[texts.of[places]]).astype(np.uint64) & np.uint64((1 << _PLACE_BITS) - 1)
        at = (ref[texts.of[places]] << np.uint64(_PLACE_BITS)) | within
        h = inner[places]
        _, first, group, count = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
        known = count[group] > 1
        other = np.arange(len(h)) != first[group]
        h = np.where(other, mix64(at + _BASES[1]), h)
        yield pa.record_batch({"h": pa.array(h.view(np.int64)), "at": pa.array(at.view(np.int64)), "known": pa.array(known)})


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text compressed, with its number of words and the digest of all of them."""
    pack = zstandard.ZstdCompressor(level=3, write_content_size=True)
    for batch in pieces(batches, 2):
        texts = utf8(batch.column(2))
        words = [t.split() for t in texts]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array([len(w) for w in words], pa.int64()),
                pa.array([hashlib.sha256(b" ".join(w)).hexdigest() for w in words], pa.string()),
                pa.array([pack.compress(t) for t in texts], pa.binary()),
            ],
            ["key", "doc_id", "n_words", "digest", "z"],
        )


def _settled(hashes: list[np.ndarray], doc: np.ndarray, place: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which rows repeat an earlier one among these rows, and first hashes that keep such rows apart."""
    order = np.lexsort((key, place, doc, *reversed(hashes)))
    fresh = np.ones(len(order), bool)
    for h in hashes:
        fresh[1:] &= h[order][1:] == h[order][:-1]
    fresh[1:] = ~fresh[1:]
    first = order[np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))]
    lost = np.empty(len(order), bool)
    lost[order] = (doc[order] != doc[first]) | (place[order] != place[first]) | (key[order] != key[first])
    apart = mix64(key.view(np.uint64) + mix64(place.astype(np.uint64) + _BASES[1]))
    return lost, np.where(lost, apart, hashes[0])


def _documents(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Keys, and doc_ids with null as the last."""
    return batch.column("key").to_numpy(), batch.column("doc_id").fill_null(_LAST).to_numpy()


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, doc, key, start, n, lost) of each path of edges with repeated anchors."""
    for part in pieces(batches, 2, _sizes_unpacked):
        keys, docs = _documents(part)
        texts = _Texts(_unpacked(part))
        edges = texts.edges()
        marked = np.zeros(len(texts.words) + 1, bool)
        within, row = _lists(part.column("places"))
        while len(row):
            fits = within < texts.lengths[row]
            within, row = within[fits], row[fits]
            marked[texts.starts[row] + within] = True
            within = within + (1 << _PLACE_BITS)  # places in longer texts are known up to this much
        edges = edges[marked[texts.anchors(edges, texts.runs(ANCHOR))]]
        if not len(edges):
            continue
        hashes = [texts.runs(WINDOW, base)[edges] for base in _BASES]
        begin = np.concatenate([[True], (np.diff(edges) != 1) | ((hashes[0][1:] & _CUT) == 0)])
        begin |= np.concatenate([[True], np.diff(texts.of[edges]) != 0])
        s = np.flatnonzero(begin)
        n = np.diff(np.append(s, len(edges)))
        step = (np.arange(len(edges)) - np.repeat(s, n)).astype(np.uint64)
        a, b = (mix64(np.add.reduceat(mix64(h + step * _BASES[0]), s)) for h in hashes)
        b >>= np.uint64(32)
        of, start = texts.of[edges[s]], edges[s] - texts.starts[texts.of[edges[s]]]
        lost, a = _settled([a, b], docs[of], start, keys[of])
        yield pa.record_batch(
            {
                "a": pa.array(a.view(np.int64)),
                "b": pa.array(b.astype(np.int64)),
                "doc": pa.array(docs[of]),
                "key": pa.array(keys[of]),
                "start": pa.array(start),
                "n": pa.array(n),
                "lost": pa.array(lost),
            }
        )


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same for each edge of the paths listed in ``spans``, as paths of one."""
    for part in pieces(batches, 2, _sizes_unpacked):
        keys, docs = _documents(part)
        texts = _Texts(_unpacked(part))
        spans, row = _lists(part.column("spans"))
        n = spans & 0xFFFFFFFF
        of = np.repeat(row, n)
        start = np.repeat((spans >> 32) - np.cumsum(n) + n, n) + np.arange(n.sum())
        at = texts.starts[of] + start
        a, b = (texts.runs(WINDOW, base)[at] for base in _BASES)
        b = b >> np.uint64(32)
        lost, a = _settled([a, b], docs[of], start, keys[of])
        yield pa.record_batch(
            {
                "a": pa.array(a.view(np.int64)),
                "b": pa.array(b.astype(np.int64)),
                "doc": pa.array(docs[of]),
                "key": pa.array(keys[of]),
                "start": pa.array(start),
                "n": pa.array(np.ones(len(of), np.int64)),
                "lost": pa.array(lost),
            }
        )


_OCCURRENCE = "a long, b long, doc long, key long, start long, n long, lost boolean"


def _without_first(occurrences: DataFrame) -> DataFrame:
    """(key, span, lost): all occurrences but the first of their kind are lost."""
    where = F.struct("doc", "start", "key")
    first = F.min(where).over(Window.partitionBy("a", "b"))
    span = F.shiftleft(F.col("start"), 32).bitwiseOR(F.col("n"))
    return occurrences.select("key", span.alias("span"), (F.col("lost") | (where != first)).alias("lost"))


def _spans(occurrences: DataFrame) -> DataFrame:
    # Rows that repeat an id and its text have one key; each of its spans is needed once.
    return occurrences.groupBy("key").agg(F.collect_set("span").alias("spans"))


def _result(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, 3, _sizes_unpacked):
        removed, digests, kept_texts = [], batch.column("digest").to_pylist(), []
        unpack = zstandard.ZstdDecompressor()
        for i, (z, spans) in enumerate(zip(batch.column("z"), batch.column("spans"), strict=True)):
            if not spans.is_valid:
                removed.append(0)
                kept_texts.append(None)
                continue
            words = unpack.decompress(z.as_py()).split()
            packed = spans.values.to_numpy()
            start, n = packed >> 32, (packed & 0xFFFFFFFF) + WINDOW - 1
            change = np.bincount(start, minlength=len(words) + 1) - np.bincount(start + n, minlength=len(words) + 1)
            kept = np.cumsum(change)[: len(words)] == 0
            removed.append(int(len(words) - kept.sum()))
            digests[i] = hashlib.sha256(text := b" ".join(w for w, k in zip(words, kept, strict=True) if k)).hexdigest()
            kept_texts.append(text.decode())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("n_words"),
                pa.array(removed, pa.int64()),
                pa.array(digests, pa.string()),
                pa.array(kept_texts, pa.string()),
            ],
            ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"],
        )


def _key() -> Column:
    return F.xxhash64(F.col("doc_id").cast("long"), "text").alias("key")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept_text) of every row; kept_text is null where nothing is removed."""
    rows = docs.select(_key(), F.col("doc_id").cast("long").alias("doc_id"), "text")
    anchors = rows.select("key", "text").mapInArrow(_repeated_anchors, "h long, at long, known boolean")
    times = F.count("*").over(Window.partitionBy("h"))
    repeated = anchors.withColumn("times", times).where("known OR times > 1")
    places = repeated.select(
        F.shiftrightunsigned("at", _PLACE_BITS).alias("ref"), F.col("at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).alias("place")
    )
    places = places.groupBy("ref").agg(F.collect_set("place").alias("places"))
    packed = rows.mapInArrow(_packed, "key long, doc_id long, n_words long, digest string, z binary")
    joined = packed.join(places, packed["key"].bitwiseAND(F.lit(_REF_MASK)) == places["ref"], "left").drop("ref")
    texts = written(joined.withColumn("z", F.when(F.col("places").isNotNull(), F.col("z"))), "texts")
    open_texts = texts.where("places IS NOT NULL")

    paths = open_texts.select("key", "doc_id", "z", "places").mapInArrow(_paths, _OCCURRENCE)
    paths = written(_without_first(paths), "paths")
    firsts = open_texts.select("key", "doc_id", "z").join(_spans(paths.where("NOT lost")), "key")
    edges = _without_first(firsts.mapInArrow(_edges, _OCCURRENCE)).where("lost")
    removed = _spans(paths.where("lost").union(edges).select("key", "span"))
    left = texts.select("key", "doc_id", "n_words", "digest", "z").join(removed, "key", "left")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"
    return left.select("doc_id", "n_words", "digest", "z", "spans").mapInArrow(_result, schema)
