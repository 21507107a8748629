"""How filters of documents interact: what each removes in every order of application.

A document is told by its mask, the set of filters it fails, so a table becomes
weights by part and mask. Over the masks a matrix has 0 where a filter is failed
and infinity elsewhere; over the orders another has the step at which each
filter is applied, the inverse of the permutation. Their min-plus product is the
step that removes a mask in an order. The weights are scattered to these steps.

Counts are of rows. A null text counts as empty, a null source as the empty
string, and both meet what is empty already. A row without doc_id is never a
copy nor the first of copies, and has no label; rows that repeat a doc_id count
each, and do not make each other copies. A document is good or toxic if any of
its labels says so. A table without rows has no parts and gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

# Filters in the order of their bits in a mask.
FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT = 50  # percent of the words
MAX_CAPITALS = 2  # percent of the code points
MARKS = r"[#$%&*|]"
_SPACE = r"[\x20\x09-\x0D]+"

_NEVER = 1 << 20
# What is counted of the rows of a part and mask.
WEIGHTS = ("n", "good", "toxic")
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
AUDIT = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS)


def fails(text: Column, words: Column) -> list[Column]:
    """Whether a text fails each filter that looks at it alone; ``words`` are its words."""
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return [
        n < MIN_WORDS,
        100 * distinct.cast("long") < MIN_DISTINCT * n.cast("long"),
        100 * capitals.cast("long") > MAX_CAPITALS * F.length(text).cast("long"),
        text.rlike(MARKS),
    ]


def _bits(flags: Sequence[Column]) -> Column:
    total = F.lit(0)
    for bit, flag in enumerate(flags):
        total = total + F.when(flag, 1 << bit).otherwise(0)
    return total


def masked(docs: DataFrame) -> DataFrame:
    """(part, doc_id, text_id, own, n): rows of one part, id and text, the text by its digest, with the mask of its own filters."""
    text = F.coalesce("text", F.lit(""))
    # The words are a column below the counts, so that a text is cut once.
    cut = docs.select(
        F.coalesce("source", F.lit("")).alias("part"),
        F.col("doc_id").cast("long").alias("doc_id"),
        text.alias("text"),
        F.array_remove(F.split(text, _SPACE), "").alias("words"),
    )
    seen = cut.select("part", "doc_id", F.unhex(F.sha2("text", 256)).alias("text_id"), _bits(fails(F.col("text"), F.col("words"))).alias("own"))
    return seen.groupBy("part", "doc_id", "text_id", "own").agg(F.count("*").alias("n"))


def weights(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): how many rows of each part fail which filters.

    Rows of one text and part are added up before they meet the first id of the
    text, so a text that holds a third of the table is a row for each part and
    label there. Rows without an id are dealt by their text, as they match no label.
    """
    marked = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id"), F.lit(0).alias("deal")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    deal = F.when(F.col("doc_id").isNull(), F.xxhash64("text_id")).otherwise(F.lit(0))
    rows = masked(docs).withColumn("deal", deal).join(marked, ["doc_id", "deal"], "left").na.fill(False, ["good", "toxic"])
    # Of a part's rows of a text only those of the smallest id can be first.
    copies = rows.groupBy("text_id", "part", "own", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("without_id"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("least"),
    )
    first = copies.groupBy("text_id").agg(F.min("least.doc_id").alias("first"))
    own = F.col("without_id") + F.when(F.col("least.doc_id") == F.col("first"), F.col("least.n")).otherwise(0)
    fresh = copies.join(first, "text_id").withColumn("fresh", own)
    last = 1 << (len(FILTERS) - 1)
    halves = F.inline(
        F.array(
            F.struct(F.col("own").alias("mask"), F.col("fresh").alias("rows")),
            F.struct((F.col("own") + last).alias("mask"), (F.col("n") - F.col("fresh")).alias("rows")),
        )
    )
    if_ = lambda flag: F.sum(F.when(F.col(flag), F.col("rows")).otherwise(0)).alias(flag)
    return fresh.select("part", "good", "toxic", halves).groupBy("part", "mask").agg(F.sum("rows").alias("n"), if_("good"), if_("toxic"))


def removal_steps(n_filters: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(orders, masks, steps): the filters of each order by step, which filters a mask fails, and the min-plus product of masks and orders.

    A step is counted from 0; what no filter removes has the number of filters.
    """
    orders = np.array(list(permutations(range(n_filters))), np.int64)
    position = np.argsort(orders, axis=1)  # the inverse permutations
    failed = (np.arange(1 << n_filters)[:, None] >> np.arange(n_filters)) & 1 == 1
    infinite = np.where(failed, 0, _NEVER)
    steps = np.min(infinite[:, None, :] + position[None, :, :], axis=2)
    return orders, failed, np.minimum(steps, n_filters)


def scattered(weight: np.ndarray, steps: np.ndarray, n_filters: int) -> np.ndarray:
    """[part, order, step]: the weights of each part's masks, added up at the steps that remove them."""
    out = np.zeros((len(weight), steps.shape[1], n_filters + 1), np.int64)
    order = np.arange(steps.shape[1])
    for mask in range(steps.shape[0]):
        out[:, order, steps[mask]] += weight[:, mask, None]
    return out


def audited(weight: np.ndarray) -> dict[str, np.ndarray]:
    """Every count as [part, order, step], from weights [kind, part, mask]."""
    n_filters = (weight.shape[2] - 1).bit_length()
    orders, failed, steps = removal_steps(n_filters)
    removed, good, toxic = (scattered(w, steps, n_filters)[:, :, :-1] for w in weight)
    rows = weight[0]
    # Failing a filter, here or before: removed at its step, or redundant.
    failing = rows @ failed.astype(np.int64)
    shapley = np.zeros((len(rows), n_filters), np.int64)
    for step in range(n_filters):
        for f in range(n_filters):
            shapley[:, f] += removed[:, orders[:, step] == f, step].sum(axis=1)
    return {
        "kept": rows.sum(axis=1)[:, None, None] - np.cumsum(removed, axis=2),
        "removed": removed,
        "redundant": failing[:, orders] - removed,
        "unique_fails": rows[:, 1 << np.arange(n_filters)][:, orders],
        "good_lost": good,
        "toxic_lost": toxic,
        "shapley": shapley[:, orders],
    }


def _parts(filters: str):
    names = ["".join(p) for p in permutations(filters)]
    n_rows = len(names) * len(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                weight = np.stack([np.array(some.column(i).to_pylist(), np.int64) for i in range(1, 4)])
                counts = audited(weight)
                parts = some.num_rows
                yield pa.record_batch(
                    {
                        "part": pa.array(np.repeat(np.array(some.column(0).to_pylist(), object), n_rows), pa.string()),
                        "filter_order": pa.array(np.tile(np.repeat(names, len(filters)), parts), pa.string()),
                        "step": pa.array(np.tile(np.arange(1, len(filters) + 1), parts * len(names)), pa.int32()),
                        **{c: pa.array(counts[c].reshape(-1)) for c in COUNTS},
                    }
                )

    return run


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order of the filters and step, with the columns of ``AUDIT``."""
    by_mask = weights(docs, labels)
    # A part is one row: the weights of its masks side by side, 0 where it has none.
    vectors = [
        F.array(*(F.sum(F.when(F.col("mask") == m, F.col(w)).otherwise(0)) for m in range(1 << len(FILTERS)))).alias(w) for w in WEIGHTS
    ]
    return by_mask.groupBy("part").agg(*vectors).mapInArrow(_parts(FILTERS), AUDIT)
