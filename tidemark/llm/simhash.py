"""Near duplicates by SimHash fingerprints.

A fingerprint is cut into segments, and the number of set bits of each segment
is a coordinate. The Manhattan distance of two such points never exceeds the
number of differing bits, so a range join on a grid of the points finds every
pair in reach; the pairs it finds are verified on the bits themselves.

A null text counts as empty and has fingerprint zero. Rows with one doc_id are
rows of their own, and keep theirs; a null doc_id is kept but never names a
component unless all its members are null. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.llm.common import components, pieces, utf8, written

SEED = 42
SHINGLE = 3
MAX_BITS = 3
_CHUNK = 1 << 16
# Keys of rows to be taken out that are broadcast at most; a row of a hashed relation is about so long.
BROADCAST_BYTES = 64 << 20
_KEY_BYTES = 96
# Two-bit segments, 16 in each half of a fingerprint. Points within three steps
# are within one step in one of the halves.
_SEGMENTS = 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The 64 bits, as unsigned integer; a bit is set if more than half of the shingle hashes have it."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        shingles = iter([b" ".join(words)])
        n = 1
    else:
        n = len(words) - shingle + 1
        shingles = map(b" ".join, zip(*(words[i : i + n] for i in range(shingle)), strict=True))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, _CHUNK):
        octets = hashes[i : i + _CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, hashed: bool = False) -> DataFrame:
    """(doc_id, fp) of every row, with text_hash where asked for; fp is the fingerprint's bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1):
            bits = np.array([fingerprint(t, shingle) for t in utf8(batch.column(1))], np.uint64)
            names = ["doc_id", "fp", "text_hash"][: 2 + hashed]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits.view(np.int64)), *batch.columns[2:]], names)

    rows = docs.select(F.col("doc_id").cast("long"), "text", *[F.xxhash64("text")] * hashed)
    return rows.mapInArrow(run, "doc_id long, fp long" + ", text_hash long" * hashed)


def _cells(fp: Column, half: int) -> tuple[Column, list[Column]]:
    """The grid cell of one half of a fingerprint, and the cells one step up from it."""
    counts = [
        F.bit_count(F.shiftrightunsigned(fp, 2 * (half * _SEGMENTS + i)).bitwiseAND(F.lit(3))) for i in range(_SEGMENTS)
    ]
    own = F.lit(half * 3**_SEGMENTS).cast("long")
    for i, c in enumerate(counts):
        own = own + c * F.lit(3**i).cast("long")
    return own, [F.when(c < 2, own + F.lit(3**i).cast("long")) for i, c in enumerate(counts)]


def links(distinct_fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints that differ in at most ``max_bits`` bits, three at most.

    Of two cells one step apart one is above the other, so it is enough to look
    upwards. A pair may come twice.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("the grid is laid out for distances up to 3")
    fp = F.col("fp")
    grid = [_cells(fp, half) for half in (0, 1)]
    at = distinct_fps.select(fp.alias("a"), F.explode(F.array(*(own for own, _ in grid))).alias("cell"))
    reach = F.array(*(c for own, ups in grid for c in (own, *ups)))
    near = distinct_fps.select(
        fp.alias("b"), F.explode(F.array_compact(reach)).alias("cell")
    )
    bits = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    # Spark takes either side to be as large as what was exploded, and would broadcast some 26 rows a fingerprint.
    return at.join(near.hint("merge"), "cell").where((F.col("a") != F.col("b")) & (bits <= max_bits)).select("a", "b")


def _named(docs: DataFrame, shingle: int, max_bits: int, hashed: bool = False) -> tuple[DataFrame, DataFrame]:
    """The fingerprints of every row; (fp, root, component_id) of every fingerprint, the root one to a component."""
    prints = written(fingerprints(docs, shingle, hashed), "fingerprints")
    firsts = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    roots = components(links(firsts.select("fp"), max_bits))
    # Files of longs are far smaller than the same rows hashed, so their size does not tell what fits the driver.
    rooted = firsts.join(roots.hint("merge"), firsts.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return prints, rooted.join(names, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id) of every row; component_id is the smallest doc_id reachable over links."""
    prints, named = _named(docs, shingle, max_bits)
    return prints.join(named.hint("merge"), "fp").select("doc_id", "fp", "component_id")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _id(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long").cast("string"), F.lit("")).alias("_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each component, with its smallest doc_id; of several the one of the smallest fp, then of the smallest text hash.

    Rows without a doc_id stay only if their component has no doc_id at all. Of
    rows that repeat an id and its text one stays, that with the smallest hash
    over its plain columns. The rows themselves are dealt out only where those that go are too many
    to be sent to them by key.
    """
    prints, named = _named(docs, shingle, max_bits, hashed=True)
    heads = (
        prints.join(named.hint("merge"), "fp")
        .where("doc_id <=> component_id")
        .groupBy("root")
        .agg(F.first("doc_id").alias("doc_id"), F.min(F.struct("fp", "text_hash")).alias("least"))
        .select(_id(F.col("doc_id")), F.col("least.text_hash").alias("_text"), F.lit(True).alias("_head"))
    )
    counts = prints.groupBy(_id(F.col("doc_id")), F.col("text_hash").alias("_text")).agg(F.count("*").alias("n"))
    # What is not a row of its own to be kept: rows that go, and repeated ones of which one stays.
    judged = counts.join(heads, ["_id", "_text"], "left").where("_head IS NULL OR n > 1")
    judged = written(judged.select("_id", "_text", "_head"), "judged")
    few = judged.count() * _KEY_BYTES <= BROADCAST_BYTES
    near = F.broadcast if few else (lambda side: side.hint("merge"))
    rows = docs.withColumn("_id", _id(F.col("doc_id"))).withColumn("_text", F.xxhash64("text"))
    single = rows.join(near(judged), ["_id", "_text"], "left_anti").select(*docs.columns)
    plain = [f.name for f in docs.schema if isinstance(f.dataType, (T.StringType, T.NumericType, T.BooleanType, T.DateType, T.TimestampType))]
    one = F.min_by(F.struct(*docs.columns), F.xxhash64(*plain)).alias("_row")
    repeated = rows.join(near(judged.where("_head")), ["_id", "_text"], "left_semi").groupBy("_id", "_text").agg(one)
    return single.union(repeated.select("_row.*"))
