"""Benchmark passages in texts, by greedy string tiling.

Runs of words that a text shares with a benchmark item are its seeds. Where the
seeds could cover enough of an item, the two are tiled: the longest common runs
that nothing covers yet are marked, again and again, down to the length of a
seed; running Karp-Rabin hashes find them. The share of the item under tiles does
not depend on their order, so reordered passages count in full.

A pair is listed where the tiles cover enough of the item, or where one of them
has ``LONG_RUN`` words: a long verbatim passage counts, however long its item.
Items of fewer than ``MIN_MATCH`` words match as a whole; those of fewer than
``SHORTEST`` name nothing and do not match unless ``shortest`` is lower.

Words are compared in lower case and without the punctuation around them. Null
texts count as empty. The texts are read once, whatever the size of the benchmark:
a Bloom filter of its seeds tells which runs of a text are worth keeping, and a
join on the seeds tells which items they are of. The filter has a largest size,
beyond which more runs are kept than need be. Words are told apart by 63 bits of
hash. Every row counts on its own, repeated ones alike; a pair of ids is listed
once for each pair of rows. Without texts or items the result is empty.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import mix64, numbered, on_executors, pieces, utf8, written

MIN_MATCH = 5
SHORTEST = 3
COVERAGE = 0.6
LONG_RUN = 25
# 16 MB; with 32 bits a seed, four of them set, one run in some 4,000 is kept by mistake.
MOST_FILTER_BITS = 1 << 27
_BITS_A_SEED = 4
# Ids of documents to be taken out that are broadcast at most; a row of a hashed relation is about so long.
BROADCAST_BYTES = 64 << 20
_ID_BYTES = 64
_BASE = 0x9E3779B97F4A7C15


def _plain(words: list[bytes]) -> list[bytes]:
    return [w.decode().lower().strip(".,;:!?\"'()[]{}").encode() for w in words]


def _powers(n: int) -> np.ndarray:
    steps = np.full(n + 1, _BASE, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


class Rolling:
    """Karp-Rabin hashes of all runs of a sequence: from one array of prefix hashes, for any length."""

    def __init__(self, numbers: np.ndarray):
        values = mix64(numbers.astype(np.uint64) + np.uint64(1))
        self.power = _powers(len(values))
        # Word i is weighted by the i-th power; a run's sum is compared after scaling back to power 0.
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * self.power[: len(values)], dtype=np.uint64)])

    def hashes(self, length: int) -> np.ndarray:
        """The hash of each run of this length, comparable between sequences."""
        n = len(self.sums) - 1 - length + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        return (self.sums[length:] - self.sums[:n]) * _INVERSE[n]


class _Inverses:
    """Powers of the base's inverse modulo 2^64, as many as are asked for."""

    def __init__(self):
        self.values = np.ones(1, np.uint64)

    def __getitem__(self, n: int) -> np.ndarray:
        if len(self.values) < n:
            step = np.full(2 * n, pow(_BASE, -1, 1 << 64), np.uint64)
            step[0] = 1
            self.values = np.multiply.accumulate(step)
        return self.values[:n]


_INVERSE = _Inverses()


def tile(text: np.ndarray, item: np.ndarray, least: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Tiles (place in the text, place in the item, length), longest first.

    Each round looks for runs of one length, takes what it finds to its full
    length, and marks the longest; when longer runs may hide, it looks again at
    that length. Numbers below zero match nothing.
    """
    free_text, free_item = text >= 0, item >= 0
    rolling_text, rolling_item = Rolling(text), Rolling(item)
    out: list[tuple[int, int, int]] = []
    length = max(least, min(len(item), len(text)))
    while length >= least:
        longest = 0
        found: list[tuple[int, int, int]] = []
        starts: dict[int, list[int]] = {}
        begins = _free_runs(free_item, length)
        for j, h in zip(begins.tolist(), rolling_item.hashes(length)[begins].tolist(), strict=True):
            starts.setdefault(h, []).append(j)
        at = _free_runs(free_text, length)
        if starts and len(at):
            hashes = rolling_text.hashes(length)[at]
            hit = np.isin(hashes, np.fromiter(starts, np.uint64, len(starts)))
            for i, h in zip(at[hit].tolist(), hashes[hit].tolist(), strict=True):
                for j in starts[h]:
                    # Only where a run begins; what follows inside it is part of the same one.
                    if i and j and free_text[i - 1] and free_item[j - 1] and text[i - 1] == item[j - 1]:
                        continue
                    n = _common(text, item, free_text, free_item, i, j)
                    if n >= length:
                        found.append((n, i, j))
                        longest = max(longest, n)
        if longest > 2 * length:
            length = longest
            continue
        clash = False
        for n, i, j in sorted(found, key=lambda x: (-x[0], x[1], x[2])):
            if free_text[i : i + n].all() and free_item[j : j + n].all():
                free_text[i : i + n] = False
                free_item[j : j + n] = False
                out.append((i, j, n))
            else:  # a tile took part of it; what is left of it is met in another round
                clash = True
                break
        if not clash:
            length = length // 2 if length > 2 * least else least if length > least else 0
    return sorted(out, key=lambda x: -x[2])


def _free_runs(free: np.ndarray, length: int) -> np.ndarray:
    """Where runs of this length begin that nothing has marked."""
    if len(free) < length:
        return np.zeros(0, np.int64)
    taken = np.concatenate([[0], np.cumsum(~free)])
    return np.flatnonzero(taken[length:] == taken[:-length])


def _common(text: np.ndarray, item: np.ndarray, free_text: np.ndarray, free_item: np.ndarray, i: int, j: int) -> int:
    """Length of the common free run from these places; it also verifies what the hashes said."""
    n = min(len(text) - i, len(item) - j)
    same = (text[i : i + n] == item[j : j + n]) & free_text[i : i + n] & free_item[j : j + n]
    return n if same.all() else int(same.argmin())


def _word_hashes(words: list[bytes]) -> np.ndarray:
    """A number of 63 bits for each word, the same in every task."""
    return np.fromiter((xxhash.xxh64_intdigest(w) >> 1 for w in _plain(words)), np.int64, len(words))


def _seeds(rolling: Rolling, length: int) -> np.ndarray:
    """The keys of all runs of this length; runs of two lengths have keys of their own."""
    return mix64(rolling.hashes(length) + np.uint64(length))


def _positions(seeds: np.ndarray, n_bits: int) -> Iterator[np.ndarray]:
    """The bits of a filter that stand for each seed."""
    step = (seeds >> np.uint64(32)) | np.uint64(1)
    for i in range(_BITS_A_SEED):
        yield (seeds + np.uint64(i) * step) & np.uint64(n_bits - 1)


def _may_hold(bits: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Places of the seeds that the filter may hold; it never misses one."""
    at = np.arange(len(seeds))
    for position in _positions(seeds, 64 * len(bits)):
        position = position[at]
        at = at[(bits[position >> np.uint64(6)] >> (position & np.uint64(63))) & np.uint64(1) > 0]
    return at


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)])
    values = np.concatenate([*rows, np.zeros(0, np.int64)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values.view(np.int64), pa.int64()))


def _items(benchmark: DataFrame, shortest: int) -> DataFrame:
    """(_item, words) of each distinct text of the benchmark; words are numbers."""
    text = F.coalesce("text", F.lit(""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1):
            numbers, words = numbered(utf8(batch.column(1)))
            hashes = _word_hashes(words)
            kept = [i for i, n in enumerate(numbers) if len(n) >= shortest]
            yield pa.record_batch({"_item": batch.column(0).take(pa.array(kept, pa.int32())), "words": _lists([hashes[numbers[i]] for i in kept])})

    distinct = benchmark.select(F.sha2(text, 256).alias("_item"), text.alias("text")).distinct()
    return written(distinct.mapInArrow(run, "_item string, words array<long>"), "benchmark-items")


def _item_seeds(items: DataFrame, least: int, coverage: float, long_run: int) -> DataFrame:
    """(seed, _item, places, length, need): how often the item has the seed, and how many of its places a match must hit.

    A tile of n words hits n - least + 1 places, no fewer than n / least.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, words in zip(batch.column(0), batch.column(1), strict=True):
                item = words.values.to_numpy()
                length = min(least, len(item))
                seeds, places = np.unique(_seeds(Rolling(item), length), return_counts=True)
                need = max(1, min(math.ceil(coverage * len(item) / least - 1e-9), long_run - least + 1)) if len(item) >= least else 1
                yield pa.record_batch(
                    {
                        "seed": pa.array(seeds.view(np.int64)),
                        "_item": pa.array([name.as_py()] * len(seeds), pa.string()),
                        "places": pa.array(places, pa.int64()),
                        "length": pa.array(np.full(len(seeds), length), pa.int32()),
                        "need": pa.array(np.full(len(seeds), need), pa.int64()),
                    }
                )

    return written(items.mapInArrow(run, "seed long, _item string, places long, length int, need long"), "benchmark-seeds")


def _filter(seeds: DataFrame, n_bits: int) -> np.ndarray:
    """A Bloom filter of the seeds; the driver gets its words only, so it is bounded by ``n_bits``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            at = np.unique(np.concatenate(list(_positions(own, n_bits))))
            yield pa.record_batch({"slot": pa.array((at >> np.uint64(6)).astype(np.int64)), "mask": pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))})

    words = seeds.select("seed").mapInArrow(run, "slot long, mask long").groupBy("slot").agg(F.bit_or("mask").alias("mask")).toArrow()
    bits = np.zeros(n_bits // 64, np.uint64)
    bits[words.column("slot").to_numpy()] = words.column("mask").to_numpy().view(np.uint64)
    return bits


def _near(docs: DataFrame, lengths: list[int], bits: np.ndarray) -> DataFrame:
    """(doc_id, key, near, seeds) of the texts with a run that the filter may hold.

    ``near`` has the words of such runs in their order, with -1 where others are
    left out: tiles lie where seeds lie. Texts alike in it have one key.
    """
    load = on_executors(docs.sparkSession, bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = load()
        for batch in pieces(batches, 1):
            numbers, raw = numbered(utf8(batch.column(1)))
            hashes = _word_hashes(raw)
            rows: list[tuple] = []
            for row, n in enumerate(numbers):
                rolling = Rolling(words := hashes[n])
                shared = np.zeros(len(words), bool)
                found = []
                for length in lengths:
                    seeds = _seeds(rolling, length)
                    at = _may_hold(held, seeds)
                    for i in range(length):
                        shared[at + i] = True
                    found.append(seeds[at])
                kept = np.flatnonzero(shared)
                if len(kept):
                    near = np.insert(words[kept], np.flatnonzero(np.diff(kept) > 1) + 1, -1)
                    rows.append((row, xxhash.xxh3_128_hexdigest(near.tobytes()), near, np.unique(np.concatenate(found)).view(np.int64)))
            at, keys, nears, seeds = zip(*rows, strict=True) if rows else [()] * 4
            yield pa.record_batch(
                {
                    "doc_id": batch.column(0).take(pa.array(at, pa.int32())),
                    "key": pa.array(keys, pa.string()),
                    "near": _lists(list(nears)),
                    "seeds": _lists(list(seeds)),
                }
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return written(texts.mapInArrow(run, "doc_id long, key string, near array<long>, seeds array<long>"), "near-benchmark")


def _candidates(texts: DataFrame, seeds: DataFrame) -> DataFrame:
    """(key, _item) of the pairs that share enough places of the item.

    Of what a match must hit, up to half may be the places of the commonest
    seeds. Those are not joined, and the others must be hit the more often: a
    phrase that many texts and items share makes no pairs by itself.
    """
    held = texts.select("key", F.explode("seeds").alias("seed")).join(seeds.select("seed").distinct(), "seed", "left_semi")
    held = written(held, "shared-seeds")
    counts = held.groupBy("seed").agg(F.count("*").alias("texts"))
    commonest = Window.partitionBy("_item").orderBy(F.desc("texts"), "seed").rowsBetween(Window.unboundedPreceding, 0)
    ranked = seeds.join(counts, "seed").withColumn("upto", F.sum("places").over(commonest))
    left_out = F.col("upto") <= F.floor((F.col("need") - 1) / 2)
    rest = F.col("need") - F.coalesce(F.max(F.when(left_out, F.col("upto"))).over(Window.partitionBy("_item")), F.lit(0))
    index = ranked.select("seed", "_item", "places", rest.alias("rest"), left_out.alias("out")).where("NOT out")
    hits = held.join(index, "seed").groupBy("key", "_item").agg(F.sum("places").alias("hits"), F.max("rest").alias("rest"))
    return hits.where("hits >= rest").select("key", "_item")


def _match(near: np.ndarray, item: np.ndarray, least: int, coverage: float, long_run: int) -> tuple[float, int, int] | None:
    """(coverage, tiles, longest) of an item that a text covers enough of."""
    if len(item) < least:
        at = _free_runs(near >= 0, len(item))
        whole = at[Rolling(near).hashes(len(item))[at] == Rolling(item).hashes(len(item))[0]] if len(at) else at
        return (1.0, 1, len(item)) if any(np.array_equal(near[i : i + len(item)], item) for i in whole.tolist()) else None
    tiles = tile(near, item, least)
    share = sum(n for _, _, n in tiles) / len(item)
    return (share, len(tiles), tiles[0][2]) if tiles and (share >= coverage or tiles[0][2] >= long_run) else None


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    least: int = MIN_MATCH,
    coverage: float = COVERAGE,
    long_run: int = LONG_RUN,
    shortest: int = SHORTEST,
    filter_bits: int | None = None,
) -> DataFrame:
    """(doc_id, item_id, coverage, tiles, longest) of every text that covers an item or has a long run of it.

    ``filter_bits`` is a power of two, 64 at least; it decides what is read
    beyond need, never what is found.
    """
    items = _items(benchmark, shortest)
    seeds = _item_seeds(items, least, coverage, long_run)
    n_seeds, lengths = seeds.agg(F.count("*"), F.collect_set("length")).first()
    n_bits = filter_bits or min(MOST_FILTER_BITS, max(1 << 10, 1 << (32 * n_seeds).bit_length()))
    near = _near(docs, sorted(lengths), _filter(seeds, n_bits))
    texts = written(near.dropDuplicates(["key"]).select("key", "near", "seeds"), "distinct-near")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for key, name, words, text in zip(*(batch.column(i) for i in range(4)), strict=True):
                if match := _match(text.values.to_numpy(), words.values.to_numpy(), least, coverage, long_run):
                    found.append((key.as_py(), name.as_py(), *match))
            columns = zip(*found, strict=True) if found else [[]] * 5
            kinds = (pa.string(), pa.string(), pa.float64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["key", "_item", "coverage", "tiles", "longest"])

    pairs = _candidates(texts, seeds).join(items, "_item").join(texts.select("key", "near"), "key").select("key", "_item", "words", "near")
    found = written(pairs.mapInArrow(run, "key string, _item string, coverage double, tiles int, longest int"), "tiled")
    # An item's text is compared once, however many rows have it, and so are texts alike; their ids come back here.
    ids = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("_item"))
    return near.select("doc_id", "key").join(found, "key").join(ids, "_item").select("doc_id", "item_id", "coverage", "tiles", "longest")


def clean(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The rows of documents in which no item is covered or copied at length; rows without a doc_id are judged together."""
    found = written(find(docs, benchmark, **how).select(F.col("doc_id").alias("_found")).distinct(), "contaminated")
    # Few ids go to the documents; the documents are dealt out only where the ids are too many for that.
    few = found.count() * _ID_BYTES <= BROADCAST_BYTES
    gone = F.broadcast(found) if few else found.hint("merge")
    return docs.join(gone, docs["doc_id"].cast("long").eqNullSafe(found["_found"]), "left_anti")
