"""Near duplicates by HyperMinHash sketches, banded, estimated, and verified on whole sets.

A document is the set of its word shingles, each known by 64 bits of hash. A
sketch deals the hashes over buckets by their first bits and keeps of each
bucket's smallest hash only its leading zeros and the ten bits that follow
(0: empty bucket). Four registers make a band; an empty bucket takes the register
of the first filled one in an order of its own, so that small sets have whole
bands as well. Of two sets with similarity 0.85 no band agrees with probability
(1 - 0.85^4)^32 = 6e-11.

Sets that share a band are compared inside one task: equal registers, less those
expected to be equal by compression alone, must reach what a linked pair falls
short of with probability 1e-9, and what passes is verified on the whole sets.
First each set is compared with the smallest of its bands only, which is linear
and joins most groups; then, in bands whose sets are not all in one component
yet, those outside the component of the band's smallest set meet all others.
A task is a cell of bounded bytes, and hands on at most one link for each set.

Equal sets are one class, told by 64 bits of hash, so copies are compared once.
Rows that repeat a doc_id are documents of their own. A row without doc_id is
linked like any other but names a component only if no member has an id, in
which case all of them are kept. A null text counts as empty; documents without
words are linked with nothing. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import groupby
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import components, forest, mix64, numbered, pieces, utf8, written

SHINGLE = 5
PERCENT = 85
BUCKETS = 128
BAND = 4
_INDEX_BITS = 7
_MANTISSA = 10
# Chance that the estimate turns a linked pair away.
_MISS = 1e-9
# Bytes of sets on either side of a cell, and cells of the matrices that count common shingles.
CELL_BYTES = 8 << 20
_MATRIX = 1 << 22

HASHED = "doc_id long, id long, n_shingles long, text_id long, keys array<long>"


def shingle_sets(texts: list[bytes], shingle: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct hashes of each text's word shingles; of fewer words the whole sequence, of none nothing."""
    numbers, words = numbered([t.lower() for t in texts])
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    odd = mix64(np.arange(1, shingle + 1, dtype=np.uint64)) | np.uint64(1)
    for number in numbers:
        h, n = hashes[number], len(number)
        size = min(n, shingle)
        if not n:
            yield h
            continue
        total = np.full(n - size + 1, size, np.uint64)
        for i in range(size):
            total += h[i : n - size + 1 + i] * odd[i]
        yield np.unique(mix64(total))


def sketch(shingles: np.ndarray) -> np.ndarray:
    """The registers of a sorted set: 1 + leading zeros, then ten bits, of each bucket's smallest hash; 0 if empty."""
    bucket = (shingles >> np.uint64(64 - _INDEX_BITS)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))  # sorted: a bucket's smallest comes first
    value = (shingles[first] << np.uint64(_INDEX_BITS)) >> np.uint64(11)  # 53 bits, which a float holds exactly
    _, length = np.frexp(value.astype(np.float64))
    zeros = (53 - length).astype(np.uint64)
    mantissa = ((value << zeros) >> np.uint64(52 - _MANTISSA)) & np.uint64((1 << _MANTISSA) - 1)
    out = np.zeros(BUCKETS, np.uint16)
    out[bucket[first]] = ((zeros + np.uint64(1)) << np.uint64(_MANTISSA)) | mantissa
    return out


@cache
def _orders() -> np.ndarray:
    """For each bucket the order in which it looks for a filled one, itself first."""
    rng = np.random.default_rng(12)
    return np.stack([np.concatenate(([i], rng.permutation(np.delete(np.arange(BUCKETS), i)))) for i in range(BUCKETS)])


def band_keys(registers: np.ndarray) -> np.ndarray:
    """The key of each band: its four registers and its number, hashed."""
    filled = registers > 0
    if not filled.all():
        orders = _orders()
        registers = registers[orders[np.arange(BUCKETS), filled[orders].argmax(axis=1)]]
    bands = registers.reshape(-1, BAND).astype(np.uint64)
    key = np.zeros(len(bands), np.uint64)
    for i in range(BAND):
        key = key << np.uint64(16) | bands[:, i]
    return mix64(mix64(key) + np.arange(len(bands), dtype=np.uint64))


@cache
def least_matches(percent: int) -> np.ndarray:
    """By the number of buckets filled on either side: the matches below which a linked pair stays with probability 1e-9 at most."""
    p, out = percent / 100, [0]
    for n in range(1, BUCKETS + 1):
        below, c = 0.0, 0
        while c <= n and (below := below + comb(n, c) * p**c * (1 - p) ** (n - c)) <= _MISS:
            c += 1
        out.append(c)
    return np.array(out, np.float64)


@cache
def chance_of_match(n: int) -> float:
    """Probability that the registers of two different smallest hashes are equal, both of sets of n shingles.

    A register stands for an interval of hashes; those with as many leading zeros
    share the probability of their level evenly.
    """
    level = np.arange(54.0)
    above = lambda x: np.exp(n / BUCKETS * np.log1p(-np.minimum(x, 1 - 1e-16)))
    share = above(2.0 ** -(level + 1)) - above(2.0**-level)
    return float(np.square(share).sum()) / 2**_MANTISSA


def _possible(one: np.ndarray, one_n: int, many: np.ndarray, many_n: np.ndarray, percent: int) -> np.ndarray:
    """Which of many sketches may belong to sets that are linked with one set, by sizes and corrected matches."""
    equal = ((many == one) & (one > 0)).sum(axis=1)
    both = ((many > 0) & (one > 0)).sum(axis=1)
    either = ((many > 0) | (one > 0)).sum(axis=1)
    sizes = 100 * np.minimum(many_n, one_n) >= percent * np.maximum(many_n, one_n)
    # Of a linked pair at most this many filled buckets hold different hashes; some of them match by chance.
    by_chance = np.maximum(both - percent / 100 * either, 0) * chance_of_match(one_n)
    return sizes & (equal - by_chance >= least_matches(percent)[either])


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many elements each set on the left shares with each on the right, by matrix products over parts of the vocabulary."""
    sets = [*left, *right]
    sizes = np.array([len(s) for s in sets])
    words, number = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    # What only one set has is in no intersection.
    seen = np.bincount(number, minlength=len(words)) > 1
    place = np.cumsum(seen) - 1
    kept = seen[number]
    owner, number = owner[kept], place[number[kept]]
    by_word = np.argsort(number, kind="stable")
    owner, number = owner[by_word], number[by_word]
    total = np.zeros((len(left), len(right)))
    n_words = int(seen.sum())
    step = max(64, _MATRIX // len(sets))
    for begin in range(0, n_words, step):
        lo, hi = np.searchsorted(number, (begin, begin + step))
        part = np.zeros((len(sets), min(step, n_words - begin)), np.float32)
        part[owner[lo:hi], number[lo:hi] - begin] = 1
        total += part[: len(left)] @ part[len(left) :].T
    return total


def verified(left: list[tuple], right: list[tuple], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links (id, id) between the two sides, at most one for each set; an item is (id, component, sorted set).

    Pairs of one component are left out, and links that join nothing new.
    """
    right_ids, right_component = (np.array([r[i] for r in right], np.int64) for i in (0, 1))
    sketches = np.stack([sketch(s) for *_, s in right])
    sizes = np.array([len(s) for *_, s in right], np.float64)
    open_ = np.stack(
        [_possible(sketch(s), len(s), sketches, sizes, percent) & (right_component != c) & (right_ids != i) for i, c, s in left]
    )
    rows, columns = np.flatnonzero(open_.any(axis=1)), np.flatnonzero(open_.any(axis=0))
    pairs: list[tuple[int, int]] = []
    for at in range(0, len(rows), 512):
        some = rows[at : at + 512]
        common = _common([left[i][2] for i in some], [right[j][2] for j in columns])
        union = np.array([len(left[i][2]) for i in some])[:, None] + sizes[columns] - common
        found = open_[np.ix_(some, columns)] & (100 * common >= percent * union)
        pairs += [(left[some[i]][0], right[columns[j]][0]) for i, j in np.argwhere(found)]
    return [(x, root) for x, root in forest(iter(pairs)).items() if x != root]


def _cells(percent: int):
    """Rows come cell by cell; links come back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in pieces(batches, 7) for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
        links: list[tuple[int, int]] = []
        for _, members in groupby(rows, key=lambda row: row[:3]):
            left, right = [], []
            for *_, is_left, is_right, node, component, shingles in members:
                item = (node, component, np.frombuffer(shingles, np.uint64))
                left += [item] if is_left else []
                right += [item] if is_right else []
            if left and right:
                links += verified(left, right, percent)
            if len(links) >= 10_000:
                yield _batch(links)
                links = []
        yield _batch(links)

    return run


def _batch(links: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*links, strict=True) if links else ((), ())
    return pa.record_batch({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _compared(cells: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of the cells' rows (g, i, j, is_left, is_right, id, component)."""
    columns = ["g", "i", "j", "is_left", "is_right", "id", "component", "shingles"]
    whole = cells.join(sets.select("id", "shingles"), "id").select(*columns)
    return whole.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j").mapInArrow(_cells(percent), "a long, b long")


def _n_cells(bytes_):
    return F.ceil(bytes_ / F.lit(CELL_BYTES)).cast("int")


def _dealt(count):
    """Which of ``count`` parts an id belongs to."""
    return F.pmod(F.xxhash64("id"), count).cast("int")


def _from_zero(count):
    return F.sequence(F.lit(0), count - 1)


def _links(classes: DataFrame, sets_of, percent: int) -> DataFrame:
    """Links (a, b) that join every class of (id, bytes, key) with all that are at least ``percent`` similar, directly or over others.

    ``sets_of`` gives the (id, shingles) of a table of ids.
    """
    banded = written(classes.distinct(), "bands")
    bands = banded.groupBy("key").agg(
        F.min("id").alias("head"), F.count("*").alias("n"), F.sum("bytes").alias("all_bytes"), F.bit_xor(F.xxhash64("id")).alias("members")
    )
    # Bands with the same members are one.
    shared = bands.where("n > 1").groupBy("head", "n", "members", "all_bytes").agg(F.min("key").alias("key"))
    rows = written(banded.join(shared, "key").select("key", "id", "bytes", "head", "n", "all_bytes"), "shared-bands")
    sets = sets_of(rows.select("id").distinct())

    # Every set against the smallest of its bands.
    spokes = rows.where("id <> head").select("head", "id", "bytes").distinct()
    hubs = spokes.groupBy("head").agg(_n_cells(F.sum("bytes")).alias("parts"))
    star = spokes.join(hubs, "head").select("head", _dealt(F.col("parts")).alias("j"), F.lit(False).alias("is_left"), "id")
    centre = hubs.select("head", F.explode(_from_zero(F.col("parts"))).alias("j"), F.lit(True).alias("is_left"), F.col("head").alias("id"))
    cells = star.union(centre).selectExpr("head AS g", "0 AS i", "j", "is_left", "NOT is_left AS is_right", "id", "id AS component")
    near = written(_compared(cells, sets, percent), "star-links")

    # What is outside the component of a band's smallest set, against all of the band.
    named = components(near)
    name = lambda column, out: named.select(F.col("node").alias(column), F.col("root").alias(out))
    placed = (
        rows.where("n > 2")
        .join(name("id", "own"), "id", "left")
        .join(name("head", "main"), "head", "left")
        .select("key", "id", "bytes", "all_bytes", F.coalesce("own", "id").alias("component"), F.coalesce("main", "head").alias("main"))
        .withColumn("outside", F.col("component") != F.col("main"))
    )
    outside = placed.where("outside").groupBy("key").agg(F.sum("bytes").alias("outside_bytes"))
    sized = placed.join(outside, "key").withColumns({"rows": _n_cells(F.col("outside_bytes")), "columns": _n_cells(F.col("all_bytes"))})
    dealt = sized.withColumns({"row": _dealt(F.col("rows")), "column": _dealt(F.col("columns"))})
    as_right = F.transform(_from_zero(F.col("rows")), lambda i: F.struct(i.alias("i"), F.col("column").alias("j")))
    as_left = F.transform(_from_zero(F.col("columns")), lambda j: F.struct(F.col("row").alias("i"), j.alias("j")))
    met = F.array_distinct(F.when(F.col("outside"), F.concat(as_right, as_left)).otherwise(as_right))
    cells = dealt.select("*", F.inline(met)).select(
        F.col("key").alias("g"),
        "i",
        "j",
        (F.col("outside") & (F.col("row") == F.col("i"))).alias("is_left"),
        (F.col("column") == F.col("j")).alias("is_right"),
        "id",
        "component",
    )
    return near.union(_compared(cells, sets, percent))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row; kept is whether it names its component.

    Sets are not stored: a first pass leaves sizes and band keys, a second one
    makes the sets again of one document of each class that shares a band.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_id"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1):
            sets = list(shingle_sets(utf8(batch.column(1)), shingle))
            keys = [band_keys(sketch(s)).view(np.int64) if len(s) else None for s in sets]
            yield pa.record_batch(
                {
                    "doc_id": batch.column(0),
                    "id": pa.array([_named(s) for s in sets], pa.int64()),
                    "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "text_id": batch.column(2),
                    "keys": pa.array(keys, pa.list_(pa.int64())),
                }
            )

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1):
            sets = list(shingle_sets(utf8(batch.column(1)), shingle))
            yield pa.record_batch({"id": pa.array([_named(s) for s in sets], pa.int64()), "shingles": pa.array([s.tobytes() for s in sets], pa.binary())})

    rows = written(texts.mapInArrow(hashed, HASHED), "sketches")
    worded = rows.where("id IS NOT NULL")
    classes = written(worded.groupBy("id").agg(F.min("doc_id").alias("first"), F.min(F.struct("doc_id", "text_id")).alias("pick")), "classes")

    def sets_of(ids: DataFrame) -> DataFrame:
        picked = classes.join(ids, "id").select(F.col("pick.doc_id").alias("_doc"), F.col("pick.text_id").alias("_text")).distinct()
        found = texts.join(picked, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_id") == F.col("_text")), "left_semi")
        return written(found.mapInArrow(whole, "id long, shingles binary").dropDuplicates(["id"]), "shingle-sets")

    banded = worded.select("id", (8 * F.col("n_shingles")).alias("bytes"), F.explode("keys").alias("key"))
    roots = components(_links(banded, sets_of, percent))
    rooted = classes.join(roots, classes.id == roots.node, "left").select("id", "first", F.coalesce("root", "id").alias("root"))
    names = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(names, "root").select("id", "component_id")
    linked = worded.join(named, "id").select("doc_id", "n_shingles", "component_id")
    alone = rows.where("id IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _named(shingles: np.ndarray) -> int | None:
    """The class of a set; none of an empty one."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).astype(np.int64)) if len(shingles) else None
