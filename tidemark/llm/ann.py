"""Nearest neighbours by inner product, as a join of matrix blocks.

Queries and candidates are cut into blocks, and each pair of blocks is one tile.
A tile is first multiplied in int8; the rounding errors of the two sides bound
how far such a product can be off. Candidates whose upper bound reaches the
query's k-th best lower bound survive, are computed again in double precision,
and the best k of each tile are merged with a heap of k per query. The bounds
hold for every pair, so the result is exact.

Vectors that are null, zero, or hold null or non-finite components take no part;
neither do rows without an id. Only vectors of one length are compared. Rows
that repeat an id with the same vector count once; other vectors of one id are
vectors of their own, and none of them is a candidate for a query of that id.
Equal scores go to the smaller id. A score beyond a double is infinite, one of
infinite terms of either sign comes last, as minus infinity. Without vectors the
result is empty.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

K = 20
# Candidates are copied once a query block, so the blocks of a tile are alike in size;
# its queries are multiplied some at a time.
QUERY_BLOCK = 8192
CANDIDATE_BLOCK = 8192
_QUERIES_AT_ONCE = 1024
# Sums of products of int8 values are exact in float32 below 2^24: up to this many components at a time.
_EXACT = 1024

FOUND = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the vectors that take part."""
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & (F.abs(v) < F.lit(float("inf"))) & ~F.isnan(v))
    return (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
        .where(F.col("vec_id").isNotNull() & x.isNotNull() & finite & F.exists(x, lambda v: v != 0))
        .dropDuplicates(["vec_id", "embedding"])
    )


def _int8(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rounded components as float32, the scale of each row, the norm of its error and of its rounded form."""
    scale = np.abs(x).max(axis=1) / 127
    scale[scale == 0] = 1  # components too small to divide
    q = np.rint(x / scale[:, None])
    near = q * scale[:, None]
    with np.errstate(over="ignore"):
        return q.astype(np.float32), scale, np.sqrt(np.square(x - near).sum(axis=1)), np.sqrt(np.square(near).sum(axis=1))


def tile(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> Iterator[tuple[int, int, float]]:
    """The k best (query_id, vec_id, score) of each query among the tile's candidates."""
    q8, q_scale, q_error, q_norm = _int8(queries)
    c8, c_scale, c_error, c_norm = _int8(vectors)
    about = np.zeros((len(queries), len(vectors)))
    for d in range(0, queries.shape[1], _EXACT):
        about += q8[:, d : d + _EXACT] @ c8[:, d : d + _EXACT].T
    with np.errstate(over="ignore", invalid="ignore"):
        about *= q_scale[:, None] * c_scale
    # q.c - q'.c' = (q - q').c + q'.(c - c'); the last term is for rounding in double precision.
    norm = c_norm + c_error
    with np.errstate(over="ignore", invalid="ignore"):
        bound = q_error[:, None] * norm + q_norm[:, None] * c_error + 1e-12 * (q_norm + q_error)[:, None] * norm
        lowest, highest = about - bound, about + bound
    # Of huge components the squares are beyond a double; such pairs survive.
    unknown = ~np.isfinite(lowest) | ~np.isfinite(highest)
    lowest[unknown], highest[unknown] = -np.inf, np.inf
    for i, query in enumerate(query_ids):
        allowed = np.flatnonzero(ids != query)
        low = lowest[i, allowed]
        if len(low) > k:
            least = np.partition(low, len(low) - k)[len(low) - k]
            allowed = allowed[highest[i, allowed] >= least]
        # Added up one component after the other, so equal vectors score alike.
        with np.errstate(over="ignore", invalid="ignore"):
            scores = np.cumsum(vectors[allowed] * queries[i], axis=1)[:, -1] if len(allowed) else np.zeros(0)
        scores[np.isnan(scores)] = -np.inf  # infinite terms of either sign: no order, so last
        best = heapq.nsmallest(k, zip(-scores, ids[allowed], strict=True))
        yield from ((int(query), int(v), -float(s)) for s, v in best)


def _tiles(k: int):
    def run(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        rows: list[tuple] = []
        if len(queries) and len(candidates):
            one, many = (np.array([np.asarray(v, np.float64) for v in side["embedding"]]) for side in (queries, candidates))
            asked, ids = queries["vec_id"].to_numpy(), candidates["vec_id"].to_numpy()
            for i in range(0, len(one), _QUERIES_AT_ONCE):
                rows += tile(asked[i : i + _QUERIES_AT_ONCE], one[i : i + _QUERIES_AT_ONCE], ids, many, k)
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"]).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"}
        )

    return run


def _merge(k: int):
    """Rows come query by query; a heap holds the best k of the current one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
        some: list[tuple] = []
        for query, found in groupby(rows, key=lambda row: row[0]):
            best = heapq.nsmallest(k, ((-score, vec_id) for _, vec_id, score in found))
            some += ((query, rank, vec_id, -s) for rank, (s, vec_id) in enumerate(best, 1))
            if len(some) >= 10_000:
                yield _batch(some)
                some = []
        if some:
            yield _batch(some)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    query, rank, vec, score = zip(*rows, strict=True)
    return pa.record_batch(
        {"query_id": pa.array(query, pa.int64()), "rank": pa.array(rank, pa.int32()), "vec_id": pa.array(vec, pa.int64()), "score": pa.array(score, pa.float64())}
    )


def nearest(vectors: DataFrame, is_query: Column, k: int = K, query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest of each query row among all rows but its own.

    Block numbers come from the counts of rows; every query block meets every
    candidate block once, in a task of its own.
    """
    vectors = usable(vectors)
    n_queries, n = (int(x or 0) for x in vectors.agg(F.count_if(is_query), F.count("*")).first())
    rows, columns = max(1, -(-n_queries // query_block)), max(1, -(-n // candidate_block))
    v = vectors.withColumn("size", F.size("embedding"))
    block = lambda parts: F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(parts))
    spread = lambda parts: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))
    queries = v.where(is_query).withColumn("row", block(rows)).withColumn("column", spread(columns))
    candidates = v.withColumn("column", block(columns)).withColumn("row", spread(rows))
    keys = ["size", "row", "column"]
    found = queries.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInPandas(_tiles(k), FOUND)
    merged = found.repartition("query_id").sortWithinPartitions("query_id")
    return merged.mapInArrow(_merge(k), "query_id long, rank int, vec_id long, score double")
