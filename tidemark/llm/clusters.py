"""Centroid clustering with integer vectors, each assigned by an equal-average equal-variance search.

The centroids are sorted by the sum of their components, i.e. by their mean. A
vector starts at its own sum and looks at the centroids outward on both sides.
With k components, sums s and t, and deviations d and e (the norms about the
mean), the squared distance is at least ((s - t)^2 / k) + (d - e)^2. Once the
first part alone exceeds the best distance, a side is finished; where both parts
do, that centroid is passed over. All other distances are computed in integers,
so the search finds the nearest centroid exactly, and of equals the smaller number.

Vectors that are null, of another size, or hold null or non-finite components
take no part. Rows that repeat a vec_id are vectors of their own; a null vec_id
is kept, and comes last among the starting centroids, where ties are broken by
the vector. With fewer vectors than centroids there are fewer centroids, without
vectors no rows. Integers of any size are added up exactly; a distance or inertia
beyond the range of a long is given as the largest long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import on_executors, written

CENTROIDS = 16
ROUNDS = 3
SIZE = 64
SCALE = 64
SEED = 1
# Up to this amount every square and sum of 64 of them fits 64 bits; larger integers are Python's own.
_SMALL = 1 << 24
_ROWS = 4096
_LIMB = 32
_LONG = (1 << 63) - 1


def integers(x: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of a float64 matrix; int64 where all are small, else Python integers."""
    if not x.size or np.abs(x).max() * scale < _SMALL:
        return np.floor(scale * x).astype(np.int64)
    # The product is exact as a ratio of integers.
    ratios = ((v.as_integer_ratio() for v in row) for row in x.tolist())
    return np.array([[scale * p // q for p, q in row] for row in ratios], object)


class Codebook:
    """Centroids in the order of their sums, and the search among them."""

    def __init__(self, centroids: list[list[int]]):
        big = any(abs(v) >= _SMALL for c in centroids for v in c)
        matrix = np.array(centroids, object if big else np.int64).reshape(len(centroids), -1)
        sums = matrix.sum(axis=1)
        # Python's sort: sums may be integers of any size.
        self.number = np.array(sorted(range(len(centroids)), key=lambda i: (sums[i], i)), np.int64)
        self.matrix, self.sums = matrix[self.number], sums[self.number]
        self.deviations = _deviations(self.matrix, self.sums)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, squared distance) of the centroid nearest to each row."""
        matrix, sums, deviations = self.matrix, self.sums, self.deviations
        if x.dtype == object or matrix.dtype == object:
            x, matrix, sums = x.astype(object), matrix.astype(object), sums.astype(object)
        n, size = x.shape
        own = x.sum(axis=1)
        spread = _deviations(x, own)
        if x.dtype == object:  # no float holds these: the sums alone decide
            spread, deviations = np.zeros(n), np.zeros(len(sums))
        right = np.searchsorted(sums, own)
        left = right - 1
        best = np.full(n, -1, x.dtype)  # -1: none yet
        number = np.full(n, -1, np.int64)
        rows = np.arange(n)
        while len(rows):
            lo, hi = left[rows], right[rows]
            s = own[rows]
            down = np.where(lo >= 0, np.abs(s - sums[np.maximum(lo, 0)]), -1)
            up = np.where(hi < len(sums), np.abs(sums[np.minimum(hi, len(sums) - 1)] - s), -1)
            # The nearer side in the sum; a side that is over has -1.
            take_down = (down >= 0) & ((up < 0) | (down <= up))
            gap = np.where(take_down, down, up)
            at = np.where(take_down, lo, hi)
            # Both sides are sorted, so once the nearer gap is too wide, all that is left is.
            going = (gap >= 0) & ((best[rows] < 0) | (gap * gap <= size * best[rows]))
            rows, at, gap, take_down = rows[going], at[going], gap[going], take_down[going]
            left[rows[take_down]] -= 1
            right[rows[~take_down]] += 1
            bound = gap.astype(np.float64) ** 2 / size + (spread[rows] - deviations[at]) ** 2 if x.dtype != object else np.zeros(len(rows))
            # The margin covers the rounding of the float bound.
            open_ = (best[rows] < 0) | (bound * (1 - 1e-9) - 1 <= best[rows].astype(np.float64) if x.dtype != object else True)
            some, centroid = rows[open_], at[open_]
            found = np.square(x[some] - matrix[centroid]).sum(axis=1)
            named = self.number[centroid]
            better = (best[some] < 0) | (found < best[some]) | ((found == best[some]) & (named < number[some]))
            best[some[better]], number[some[better]] = found[better], named[better]
        return number, best


def _deviations(x: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Norms about the mean, as floats; zeros where the components are Python integers."""
    if x.dtype == object:
        return np.zeros(len(x))
    size = x.shape[1]
    return np.sqrt((size * np.square(x).sum(axis=1) - np.square(sums)).astype(np.float64) / size)


def usable(vectors: DataFrame, size: int = SIZE) -> DataFrame:
    """(vec_id, embedding) of the vectors that take part, as doubles."""
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.cast("array<double>").alias("embedding")).where(
        x.isNotNull() & (F.size(x) == size) & finite
    )


def starting(kept: DataFrame, k: int, scale: int, seed: int) -> list[list[int]]:
    """The k vectors whose ids have the smallest hashes, in that order, as integers."""
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = kept.orderBy(draw.asc_nulls_last(), "embedding").limit(k).select("embedding").collect()
    return [integers(np.array([r["embedding"]], np.float64), scale)[0].tolist() for r in first]


def _blocks(batches: Iterator[pa.RecordBatch], scale: int, size: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            some = batch.slice(at, _ROWS)
            flat = some.column(1).flatten().to_numpy(zero_copy_only=False)
            yield some.column(0), integers(flat.reshape(-1, size), scale)


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    """(place, digit) of an integer to the base 2^32; the last digit has the sign."""
    place = 0
    while not -(1 << _LIMB) < value < (1 << _LIMB):
        yield place, value & ((1 << _LIMB) - 1)
        value >>= _LIMB
        place += 1
    yield place, value


def _sums(kept: DataFrame, centroids: list[list[int]], scale: int) -> dict[int, tuple[int, list[int]]]:
    """Count and exact component sums of each centroid's vectors.

    A task adds up its own vectors and hands on a row for each centroid,
    component and digit, so that sums of any size pass through long columns.
    """
    book = on_executors(kept.sparkSession, Codebook(centroids))
    size = len(centroids[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codebook, totals = book(), {}
        for _, x in _blocks(batches, scale, size):
            number, _ = codebook.nearest(x)
            for c in np.unique(number).tolist():
                own = x[number == c]
                n, before = totals.get(c, (0, [0] * size))
                totals[c] = n + len(own), [a + int(b) for a, b in zip(before, own.sum(axis=0), strict=True)]
        rows = [(c, i, p, d) for c, (n, sums) in totals.items() for i, v in enumerate([n, *sums]) for p, d in _limbs(v)]
        columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
        yield pa.record_batch(dict(zip(("cluster", "component", "place", "digit"), (pa.array(c, pa.int64()) for c in columns), strict=True)))

    parts = kept.mapInArrow(run, "cluster long, component long, place long, digit long")
    out: dict[int, tuple[int, list[int]]] = {}
    # At most a row for each centroid, component and digit comes back.
    for c, i, place, digit in parts.groupBy("cluster", "component", "place").agg(F.sum("digit")).collect():
        n, sums = out.get(c, (0, [0] * size))
        value = digit << (_LIMB * place)
        if i:
            sums[i - 1] += value
        out[c] = (n + (0 if i else value), sums)
    return out


def _assigned(kept: DataFrame, centroids: list[list[int]], scale: int) -> DataFrame:
    """(vec_id, cluster, distance); a distance no long holds is the largest long."""
    book = on_executors(kept.sparkSession, Codebook(centroids))
    size = len(centroids[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codebook = book()
        for ids, x in _blocks(batches, scale, size):
            number, best = codebook.nearest(x)
            distance = best if best.dtype != object else [min(v, _LONG) for v in best.tolist()]
            yield pa.record_batch({"vec_id": ids, "cluster": pa.array(number, pa.int32()), "distance": pa.array(distance, pa.int64())})

    return kept.mapInArrow(run, "vec_id long, cluster int, distance long")


def cluster(
    vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, size: int = SIZE, scale: int = SCALE, seed: int = SEED
) -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, cluster, distance) of each vector that takes part, and the final centroids.

    A round reads the vectors once and brings back only counts and sums of the
    centroids. The last assignment is written, so that it is computed once.
    """
    kept = usable(vectors, size)
    centroids = starting(kept, k, scale, seed)
    if not centroids:
        return kept.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).limit(0), []
    for _ in range(rounds):
        for c, (n, sums) in _sums(kept, centroids, scale).items():
            centroids[c] = [s // n for s in sums]
    return written(_assigned(kept, centroids, scale), "clusters"), centroids


def clustering(vectors: DataFrame, **options) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each vector that takes part."""
    assigned, centroids = cluster(vectors, **options)
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    totals = {r["cluster"]: int(r["total"]) for r in assigned.groupBy("cluster").agg(exact.alias("total")).collect()}
    inertia = min(sum(totals.values()), _LONG)
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    named = [(c, min(total, _LONG), inertia, digest[c]) for c, total in totals.items()]
    # One row for each centroid.
    about = assigned.sparkSession.createDataFrame(named, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
