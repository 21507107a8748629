"""Documents that are odd in every way an operator has to stand."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession, types as T

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside or return.
EXTRA = ("fp", "key", "size", "score", "lang_pred", "row", "target", "spans", "a", "b", "n", "component_id")


def prose(seed: int, n: int, words: str = "the of and in to it on be are was for that this by as an at or a from") -> str:
    rng = random.Random(seed)
    vocabulary = words.split()
    return " ".join(rng.choice(vocabulary) + rng.choice(["", "", "ing", "ed", "ly"]) for _ in range(n))


def odd_rows() -> list[tuple]:
    long = prose(1, 30_000)
    copy = prose(2, 60)
    rows = [
        (1, None, "en", "a"),
        (2, "", "en", None),
        (3, " \t\n ", None, "a"),
        (4, long, "en", "b"),
        (5, copy, "en", "a"),
        (6, copy, None, "c"),
        (6, copy, None, "c"),
        (7, copy + " more", "de", "ä"),
        (8, "one two", "de", "b"),
        (9, "12 34 -- 5.6", "de", "b"),
        (10, "é ü 漢字 \U0001f600 x y", "fr", "b"),
        (11, "same " * 200, "en", "b"),
        (None, prose(3, 50), "en", "a"),
        (None, None, None, None),
    ]
    return [(*r, None if r[1] is None else len(r[1])) for r in rows]


def documents(spark: SparkSession, rows: list[tuple] | None = None, extra: bool = True) -> DataFrame:
    df = spark.createDataFrame(odd_rows() if rows is None else rows, DOCUMENTS)
    if extra:
        for name in EXTRA:
            df = df.selectExpr("*", f"'extra' AS {name}")
    return df.repartition(3)


def empty(spark: SparkSession, schema: str = DOCUMENTS) -> DataFrame:
    return spark.createDataFrame([], T.StructType.fromDDL(schema))


def words(text: str | None) -> list[str]:
    return [w.decode() for w in (text or "").encode().split()]
