"""Mixing sources to target weights.

The words of each source form one stream, packed into blocks of fixed length.
Each output shard draws how many blocks it takes of each source from a
multinomial. The slots of a source are numbered over all shards, and a
pseudorandom permutation of the block indices, another one for every pass over
the source, says which block a slot takes. Blocks and slots meet in a join on
the block index.

A null text has no words and is never taken; a null source is a source of its
own, the last. Every row counts on its own, also where doc_ids repeat or are
null. Without rows the result is empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window, functions as F

from tidemark.llm.common import WORD, mix64, n_words, written

BLOCK_WORDS = 512
SHARDS = 64
WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2.0
SEED = 20240305
# Copies of a row that are numbered in one array.
_COPIES = 1 << 16


def targets(sizes: list[int], weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> list[float]:
    """Words to take of each source: ``share`` of all words by repeating weights, none above ``most`` times its size."""
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    goal, left, open_ = [0.0] * len(sizes), share * sum(sizes), set(range(len(sizes)))
    while open_:
        scale = left / sum(weight[i] for i in open_)
        above = {i for i in open_ if scale * weight[i] > most * sizes[i]}
        for i in above or open_:
            goal[i] = float(most * sizes[i]) if above else scale * weight[i]
        left -= sum(goal[i] for i in above)
        open_ -= above or open_
    return goal


def permuted(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A bijection of 0..n-1 for each key: a Feistel network over the next even number of bits, walked until it is below n."""
    x, n, key = (np.array(v, np.uint64, ndmin=1) for v in (index, n, key))
    sizes, at = np.unique(n, return_inverse=True)
    half = np.array([max(1, ((int(v) - 1).bit_length() + 1) // 2) for v in sizes], np.uint64)[at]
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = x.copy(), np.arange(len(x))
    while len(todo):
        h, m, v = half[todo], mask[todo], out[todo]
        left, right = v >> h, v & m
        for turn in range(4):
            left, right = right, left ^ (mix64(right + mix64(key[todo] * np.uint64(8) + np.uint64(turn + 1))) & m)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= n[todo]]
    return out.astype(np.int64)


@dataclass
class Plan:
    """What each source gives: its number of blocks and slots, and the words of its last slot."""

    sources: list[str | None]
    rows: list[int]
    sizes: list[int]
    targets: list[float]
    blocks: list[int]
    slots: list[int]
    last_words: list[int]
    counts: np.ndarray  # slots by shard and source


def _key(source: int, turn: int, seed: int) -> int:
    return (seed * 1_000_003 + source) * 16 + turn


def plan(stats: list[Row], block_words: int = BLOCK_WORDS, shards: int = SHARDS, seed: int = SEED, **how) -> Plan:
    """``stats`` has source, size and rows of each source; null sorts last."""
    stats = sorted(stats, key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [int(r["size"]) for r in stats]
    goal = targets(sizes, **how)
    blocks, slots, last = [], [], []
    for s, (size, words) in enumerate(zip(sizes, map(round, goal), strict=True)):
        n = -(-size // block_words)
        passes, rest = divmod(words, size) if size else (0, 0)
        k, cut = 0, block_words
        if rest:
            # The source's last block is shorter; where this pass meets it decides how many slots make up the rest.
            short = n * block_words - size
            met = _place_of(n - 1, n, _key(s, passes, seed))
            k = max(0, rest // block_words - 1)
            given = [i * block_words - (short if met < i else 0) for i in range(k, k + 4)]
            more = next(i for i, words in enumerate(given) if words >= rest)
            k, cut = k + more, rest - given[more - 1]
        blocks.append(n)
        slots.append(passes * n + k)
        last.append(cut)
    return Plan([r["source"] for r in stats], [int(r["rows"]) for r in stats], sizes, goal, blocks, slots, last, _draw(slots, shards, seed))


def _place_of(block: int, n: int, key: int) -> int:
    """The index that the permutation takes to ``block``: the network run backwards."""
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    x = block
    while True:
        left, right = x >> half, x & mask
        for turn in reversed(range(4)):
            inner = mix64(np.array([key * 8 + turn + 1], np.uint64))
            left, right = right ^ (int(mix64(np.array([left], np.uint64) + inner)[0]) & mask), left
        x = (left << half) | right
        if x < n:
            return x


def _draw(slots: list[int], shards: int, seed: int) -> np.ndarray:
    """Multinomial counts by shard and source, then settled so that each source gives exactly its slots."""
    total = sum(slots)
    if not total:
        return np.zeros((shards, len(slots)), np.int64)
    rng = np.random.default_rng(seed)
    size = np.diff(np.arange(shards + 1) * total // shards)
    counts = np.stack([rng.multinomial(n, np.array(slots) / total) for n in size]).astype(np.int64)
    for over in range(len(slots)):
        for under in range(len(slots)):
            move = min(counts[:, over].sum() - slots[over], slots[under] - counts[:, under].sum())
            if move > 0:
                have = np.cumsum(counts[:, over])
                moved = np.diff(np.concatenate([[0], [int(move) * int(h) // int(have[-1]) for h in have]]))
                counts[:, over] -= moved
                counts[:, under] += moved
    return counts


def _slots(plan: Plan, docs: DataFrame, seed: int) -> DataFrame:
    """(sid, block, words, shard, slot) of every slot; ``words`` is how many of the block's first words it takes."""
    ends = np.cumsum(plan.slots)
    by_shard = np.cumsum(plan.counts, axis=0)  # of a source, slots up to and with a shard
    before = np.cumsum(plan.counts, axis=1) - plan.counts  # in a shard, slots of earlier sources
    n_blocks, n_slots, last = (np.array(x, np.int64) for x in (plan.blocks, plan.slots, plan.last_words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            i = batch.column(0).to_numpy()
            sid = np.searchsorted(ends, i, side="right")
            j = i - (ends - n_slots)[sid]
            turn, index = j // n_blocks[sid], j % n_blocks[sid]
            keys = np.array([_key(int(s), int(t), seed) for s, t in zip(sid, turn, strict=True)], np.uint64)
            shard = np.empty_like(j)
            for s in np.unique(sid):
                shard[sid == s] = np.searchsorted(by_shard[:, s], j[sid == s], side="right")
            yield pa.record_batch(
                {
                    "sid": pa.array(sid.astype(np.int64)),
                    "block": pa.array(permuted(index, n_blocks[sid], keys)),
                    "words": pa.array(np.where(j == n_slots[sid] - 1, last[sid], np.iinfo(np.int64).max)),
                    "shard": pa.array(shard),
                    "slot": pa.array(before[shard, sid] + j - (by_shard - plan.counts)[shard, sid]),
                }
            )

    return docs.sparkSession.range(int(sum(plan.slots))).mapInArrow(run, "sid long, block long, words long, shard long, slot long")


def _numbered_copies(docs: DataFrame, text: bool) -> DataFrame:
    """(doc_id, source, size, text_id, copy) of every row, and its text if asked for; rows alike are numbered.

    Rows that repeat an id, or have none, are told apart by a hash of their text
    and by their number, so they spread over the bins like any others, and the
    same rows come in the same order in every run.
    """
    rows = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("text_id"), *(["text"] if text else []))
    alike = rows.groupBy("doc_id", "source", "size", "text_id").agg(F.count("*").alias("n"), *([F.first("text").alias("text")] if text else []))
    # Two steps, so that no array grows with the number of copies beyond its root.
    many = alike.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {_COPIES}"))))
    last = F.least(F.lit(_COPIES).cast("long"), F.col("n") - F.col("part") * _COPIES) - 1
    copy = F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("place")
    return many.select("*", copy).withColumn("copy", F.col("part") * _COPIES + F.col("place")).drop("n", "part", "place")


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS, shards: int = SHARDS, seed: int = SEED, text: bool = False, **how) -> DataFrame:
    """The pieces of the mix, one row for each document in a slot, and one with null shard for each not taken.

    Columns: sid, bin, row (together one document), doc_id, size, source,
    source_size, target, shard, slot, first (word of the document, from 0) and
    taken. With ``text`` there is also the piece's text.

    The place of a document in its source's stream is a prefix sum over two
    levels, bins of a source and rows of a bin; either has about the square
    root of the source's rows, so no task holds a whole source.
    """
    rows = written(_numbered_copies(docs, text), "sizes")
    p = plan(rows.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("rows")).collect(), block_words, shards, seed, **how)
    known = docs.sparkSession.createDataFrame(
        [(i, *x, int(np.ceil(np.sqrt(x[1])))) for i, x in enumerate(zip(p.sources, p.rows, p.sizes, p.targets, strict=True))],
        "sid long, name string, rows long, source_size long, target double, bins long",
    )
    rows = rows.join(known, rows["source"].eqNullSafe(known["name"])).drop("name", "rows")
    rows = rows.withColumn("bin", F.pmod(F.xxhash64("doc_id", "size", "text_id", "copy"), "bins")).drop("bins")
    bins = rows.groupBy("sid", "bin").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("sid").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.select("sid", "bin", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset"))
    place = Window.partitionBy("sid", "bin").orderBy("doc_id", "size", "text_id", "copy")
    rows = (
        rows.withColumn("row", F.row_number().over(place))
        .withColumn("end", F.sum("size").over(place.rowsBetween(Window.unboundedPreceding, 0)))
        .join(bins, ["sid", "bin"])
        .withColumn("start", F.col("offset") + F.col("end") - F.col("size"))
        .drop("offset", "end", "text_id", "copy")
    )
    b = F.lit(block_words).cast("long")
    span = F.when(F.col("size") > 0, F.sequence(F.expr(f"start div {block_words}"), F.expr(f"(start + size - 1) div {block_words}")))
    pieces = rows.withColumn("block", F.explode_outer(span))
    found = pieces.join(_slots(p, docs, seed), ["sid", "block"], "left")
    lo = F.greatest("start", F.col("block") * b)
    hi = F.least(F.col("start") + F.col("size"), F.col("block") * b + F.least("words", b))
    given = F.when(F.col("words").isNotNull(), F.greatest(hi - lo, F.lit(0))).otherwise(0)
    found = found.withColumn("first", lo - F.col("start")).withColumn("taken", given)
    if text:
        words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
        found = found.withColumn("text", F.array_join(F.slice(words, F.col("first").cast("int") + 1, F.col("taken").cast("int")), " "))
    return found.drop("words", "start", "block")


def blocks(docs: DataFrame, **how) -> DataFrame:
    """(shard, slot, source, text) of every slot of the mix; its words are joined by single spaces."""
    pieces = mix(docs, text=True, **how).where("taken > 0")
    parts = F.array_sort(F.collect_list(F.struct("bin", "row", "first", "text")))
    return pieces.groupBy("shard", "slot", "source").agg(parts.alias("parts")).select(
        "shard", "slot", "source", F.array_join("parts.text", " ").alias("text")
    )


def taken(docs: DataFrame, **how) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) of every row: the words that the mix takes of it."""
    keys = ["sid", "bin", "row", "doc_id", "source", "size", "source_size", "target"]
    return mix(docs, **how).groupBy(*keys).agg(F.sum("taken").alias("taken")).drop("sid", "bin", "row")
