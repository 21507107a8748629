"""What the operators share: reading, work tables, words, connected components."""

from __future__ import annotations

import ctypes
import pickle
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from itertools import count
from typing import TypeVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.session import shared_dir

PIECE_BYTES = 4 << 20
T = TypeVar("T")
# A word is a run of characters other than ASCII white space; bytes.split() cuts the same way.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows from a Parquet table in the folder all executors share.

    It cuts the lineage: a lost executor does not bring back the work above it,
    and rows used twice are computed once.
    """
    path = shared_dir(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def on_executors(spark: SparkSession, value: T) -> Callable[[], T]:
    """Sends a value of bounded size to the executors, its class included; the result loads it there."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(sent.value)


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def utf8(column: pa.Array) -> list[bytes]:
    """Texts as bytes; null is empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [t or b"" for t in column.cast(kind).to_pylist()]


def hand_back() -> None:
    """Returns freed memory to the system.

    Python workers outlive their tasks, and Arrow and the C library keep what a
    task has freed: it would count beside whatever the executor does next.
    """
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def pieces(
    batches: Iterator[pa.RecordBatch], column: int, size: Callable[[pa.Array], np.ndarray] | None = None, most: int | None = None
) -> Iterator[pa.RecordBatch]:
    """The batches' rows in pieces of bounded text size, so that what a worker holds is bounded too.

    ``size`` tells the bytes of each row from the column, its own length unless
    given, and ``most`` how many a piece has. A longer text is a piece of its own.
    What earlier pieces and tasks have freed is handed back with each batch.
    """
    most = most or PIECE_BYTES
    hand_back()
    for batch in batches:
        own = batch.column(column)
        bytes_ = size(own) if size else pc.fill_null(pc.binary_length(own), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(bytes_, dtype=np.int64)
        begin = 0
        while begin < batch.num_rows:
            before = total[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(total, before + most, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end
        hand_back()


def forest(pairs: Iterator[tuple[int, int]]) -> dict[int, int]:
    """Union-find: each node of the pairs and its root, the smallest node it is linked with."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while x != top:
            parent[x], x = top, parent[x]
        return top

    for a, b in pairs:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in parent}


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A batch's links as stars; at most one row per node, whatever the number of links."""
    for batch in batches:
        roots = forest(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        stars = [(x, r) for x, r in roots.items() if x != r]
        yield pa.record_batch(
            {"a": pa.array([x for x, _ in stars], pa.int64()), "b": pa.array([r for _, r in stars], pa.int64())}
        )


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.join(least, "a").where("b > a AND b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of each linked node but the roots; a root is its component's smallest node.

    ``links`` has two long columns. Alternating large-star and small-star passes
    run until the links are stars; each pass writes its links, and the driver
    sees only their number and a digest.
    """
    a, b = links.columns
    now = written(
        links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .where("a <> b")
        .mapInArrow(_contract, "a long, b long"),
        "links",
    )
    digest = None
    while digest != (digest := tuple(now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())):
        if not digest[0]:
            break
        now = written(_small_star(_large_star(now)), "links")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def numbered(texts: list[bytes]) -> tuple[list[np.ndarray], list[bytes]]:
    """The words of each text as numbers, and the distinct words in the order of their numbers."""
    numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
    out = []
    for text in texts:
        words = text.split()
        out.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
    return out, list(numbers)


def char_ngrams(words: list[str], sizes: Iterable[int]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the character n-grams of each word with a mark at either end, and the word each is of."""
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    codes = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    word = np.repeat(np.arange(len(words)), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(codes))  # characters up to the word's end
    hashes, of, h, n = [], [], codes.copy(), 1
    for size in sorted(sizes):
        while n < size:
            h[:-n] = h[:-n] * np.uint64(0x100000001B3) + codes[n:]
            n += 1
        whole = left >= size
        hashes.append(mix64(h[whole] + np.uint64(size)))
        of.append(word[whole])
    return np.concatenate(hashes), np.concatenate(of)


def mix64(x: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit hash of each number."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def spread(text: str, n_chars: int, parts: int = 8) -> str:
    """The text, or of a longer one pieces at even steps, cut at white space where there is some; ``n_chars`` at most."""
    if len(text) <= n_chars:
        return text
    size = max(1, n_chars // parts - 1)
    out = []
    for i in range(parts):
        start = i * (len(text) - size) // (parts - 1)
        piece = text[start : start + size]
        head = 0 if not start or text[start - 1].isspace() else next((j for j, c in enumerate(piece[: size // 2], 1) if c.isspace()), 0)
        end = start + size
        tail = size if end >= len(text) or text[end].isspace() else next((j for j in range(size - 1, size // 2, -1) if piece[j].isspace()), size)
        out.append(piece[head:tail])
    return " ".join(out)


def spread_texts(rows: DataFrame, n_chars: int) -> DataFrame:
    """The rows with their texts cut by ``spread``."""
    at = rows.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, at):
            columns = list(batch.columns)
            columns[at] = pa.array([spread(t, n_chars) for t in batch.column(at).to_pylist()], batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return rows.mapInArrow(run, rows.schema)


def sums_by(group: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows of a matrix by group."""
    return np.stack([np.bincount(group, values[:, d], n) for d in range(values.shape[1])], axis=1)


def sample_order(*columns: str) -> Column:
    """An order of rows that is the same in every run and unrelated to their contents."""
    return F.xxhash64(*columns, F.lit(7))
