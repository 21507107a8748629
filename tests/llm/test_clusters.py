import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from tests.llm.cases import empty
from tidemark.llm import clusters

VECTORS = "vec_id long, embedding array<double>"


def brute(rows, k=16, rounds=3, size=64):
    """The same by its definition, in Python integers."""
    kept = [
        (i, tuple(math.floor(64 * v) if abs(v) < 1e300 else 64 * int(v) for v in x), tuple(x))
        for i, x in rows
        if x is not None and len(x) == size and all(v is not None and math.isfinite(v) for v in x)
    ]
    draw = lambda i: (i is None, "" if i is None else hashlib.sha256(f"1:{i}".encode()).hexdigest())
    centroids = [list(q) for _, q, _ in sorted(kept, key=lambda r: (draw(r[0]), r[2]))[:k]]

    def assign():
        out = []
        for i, q, _ in kept:
            d, c = min((sum((a - b) ** 2 for a, b in zip(q, m, strict=True)), c) for c, m in enumerate(centroids))
            out.append((i, c, d, q))
        return out

    for _ in range(rounds):
        groups = {}
        for _, c, _, q in assign():
            groups.setdefault(c, []).append(q)
        for c, own in groups.items():
            centroids[c] = [sum(col) // len(own) for col in zip(*own, strict=True)]
    final = assign()
    top = lambda n: min(n, 2**63 - 1)
    return sorted(
        (
            (
                str(i), c, top(d), top(sum(top(e) for _, b, e, _ in final if b == c)), top(sum(top(e) for _, _, e, _ in final)),
                hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest(),
            )
            for i, c, d, _ in final
        )
    )


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, VECTORS).withColumns({n: F.lit("x") for n in ("cluster", "distance", "digit", "number")}).repartition(3)
    out = clusters.clustering(df, **options)
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((str(r[0]), *r[1:]) for r in out.collect())


def vectors(n, seed=1, scale=1.0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, scale) for _ in range(64)] for _ in range(9)]
    return [(i, [v + rng.gauss(0, scale / 3) for v in rng.choice(centres)]) for i in range(n)]


def test_equals_brute_force(spark):
    rows = vectors(400)
    assert found(spark, rows) == brute(rows)


def test_odd_rows(spark):
    inf, nan = math.inf, math.nan
    rows = vectors(40, 2)
    rows += rows[:5] + [(3, rows[9][1]), (None, rows[1][1]), (None, [0.5] * 64), (50, [0.0] * 64), (51, [-0.01] * 64)]
    rows += [(60, None), (61, []), (62, [1.0] * 63), (63, [1.0] * 63 + [None]), (64, [inf] * 64), (65, [nan] + [0.0] * 63), (66, [1.0] * 65)]
    assert found(spark, rows) == brute(rows)


def test_ties_go_to_the_smaller_number(spark):
    rows = [(i, [float(i % 3)] * 64) for i in range(60)]
    assert found(spark, rows) == brute(rows)


def test_few_vectors_and_none(spark):
    rows = vectors(5, 3)
    assert found(spark, rows) == brute(rows)
    assert clusters.clustering(empty(spark, VECTORS)).collect() == []
    assert found(spark, [(1, None), (2, [1.0])]) == []


def test_integers_of_any_size(spark):
    rows = vectors(60, 4, 3e5) + vectors(10, 5, 1e40) + [(900, [1.7e308] * 64), (901, [-1.7e308] * 64), (902, [2.0**50 + 0.25] * 64)]
    assert found(spark, rows) == brute(rows)


def test_other_parameters(spark):
    rows = [(i, x[:8]) for i, x in vectors(200, 6)]
    got = found(spark, rows, k=30, rounds=1, size=8)
    assert got == brute(rows, 30, 1, 8)


@pytest.mark.parametrize("n", [1, 2, 17, 60])
def test_search_finds_the_nearest(n):
    import numpy as np

    rng = np.random.default_rng(n)
    centroids = rng.integers(-40, 40, (n, 64))
    centroids[n // 2 :] = centroids[0] + rng.integers(-1, 2, (n - n // 2, 64))
    x = np.concatenate([rng.integers(-60, 60, (300, 64)), centroids, centroids + rng.integers(-2, 3, centroids.shape)])
    number, distance = clusters.Codebook(centroids.tolist()).nearest(x)
    d = ((x[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    assert (number == d.argmin(axis=1)).all() and (distance == d.min(axis=1)).all()


def test_sums_pass_in_digits():
    for value in (0, 1, -1, 2**31, 2**32, -(2**32), 2**64 + 5, -(2**70) - 3, 10**60):
        digits = list(clusters._limbs(value))
        assert sum(d << (32 * p) for p, d in digits) == value and all(abs(d) < 2**33 for _, d in digits)
