import numpy as np
from pyspark.sql import functions as F

from tests.llm.cases import empty
from tidemark.llm import ann

VECTORS = "vec_id long, embedding array<float>, label int"


def brute(rows, k):
    seen, good = set(), []
    for i, v, *_ in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v) or not any(v) or (i, tuple(v)) in seen:
            continue
        seen.add((i, tuple(v)))
        good.append((i, np.array(v, np.float32).astype(float)))
    out = []
    for q in sorted({i for i, _ in good if i % 20 == 0}):
        found = []
        for i, v in good:
            if i != q:
                found += [(-float(np.cumsum(u * v)[-1]), i) for j, u in good if j == q and len(u) == len(v)]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(found)[:k], 1)]
    return out


def rows_of(df):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect())


def test_exact_on_many_tiles(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 24)).astype(np.float32)
    x[100:140] = x[0]  # ties
    x[7] *= 1e-30
    x[8] *= 1e18
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    got = ann.nearest(spark.createDataFrame(rows, VECTORS).repartition(4), F.col("vec_id") % 20 == 0, 20, query_block=7, candidate_block=100)
    assert rows_of(got) == brute(rows, 20)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0], 0), (0, [1.0, 2.0], 0), (20, [1.0, 0.0], 1), (20, [0.0, 3.0], 1), (1, None, 0), (2, [0.0, 0.0], 0),
        (3, [nan, 1.0], 0), (4, [inf, 1.0], 0), (5, [None, 1.0], 0), (None, [1.0, 1.0], 0), (6, [5.0], 0), (7, [2.0, 2.0], None),
        (8, [2.0, 2.0], 0), (40, [], 0), (9, [-1.0, -1.0], 0),
    ]
    df = spark.createDataFrame(rows, VECTORS).selectExpr("*", "'x' AS row", "1 AS size", "2 AS score")
    assert rows_of(ann.nearest(df, F.col("vec_id") % 20 == 0, 3)) == brute(rows, 3)


def test_long_vectors_add_up_exactly(spark):
    rng = np.random.default_rng(3)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(rng.normal(size=(60, 2500)).astype(np.float32))]
    assert rows_of(ann.nearest(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 20 == 0, 5)) == brute(rows, 5)


def test_empty_table(spark):
    assert ann.nearest(empty(spark, VECTORS), F.col("vec_id") % 20 == 0).collect() == []


def test_huge_doubles_lose_no_neighbour(spark):
    """Squares beyond a double leave no bound; all such pairs are computed."""
    rng = np.random.default_rng(3)
    rows = [(0, [1.0, 0.0])] + [(i, rng.normal(size=2).tolist()) for i in range(1, 25)] + [(25, [1e200, 1.0]), (26, [1e308, -1e308]), (40, [1e308, 1e308])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in ann.nearest(df, F.col("vec_id") % 20 == 0, k=3).orderBy("query_id", "rank").collect()]
    want = []
    for q, x in rows:
        if q % 20 == 0:
            with np.errstate(over="ignore", invalid="ignore"):
                scores = [(float(np.float64(x[0]) * c[0] + np.float64(x[1]) * c[1]), v) for v, c in rows if v != q]
            scores = [(-np.inf if np.isnan(s) else s, v) for s, v in scores]
            best = sorted((-s, v) for s, v in scores)[:3]
            want += [(q, n, v, -s) for n, (s, v) in enumerate(best, 1)]
    assert got == want


def test_many_vectors_of_one_id_are_dealt_over_the_tiles(spark, monkeypatch):
    monkeypatch.setattr(ann, "_QUERIES_AT_ONCE", 3)
    rng = np.random.default_rng(8)
    rows = [(i if i % 3 else 40, rng.normal(size=6).round(2).tolist(), 0) for i in range(120)]
    df = spark.createDataFrame(rows, VECTORS)
    assert rows_of(ann.nearest(df, F.col("vec_id") % 20 == 0, 3, query_block=16, candidate_block=16)) == brute(rows, 3)
