"""Column expressions used by several operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schemas import MONEY


def is_type(*event_types: str) -> Column:
    return F.col("event_type").isin(*event_types)


def count_type(*event_types: str) -> Column:
    return F.count_if(is_type(*event_types))


def line_total() -> Column:
    """Price times quantity; 0 where either is missing."""
    total = F.col("sale_price").cast(MONEY) * F.col("quantity")
    return F.coalesce(total, F.lit(0).cast(MONEY))


def revenue() -> Column:
    """Purchase revenue of a group, summed as decimal so that order never matters."""
    return F.sum(F.when(is_type("purchase"), line_total()).otherwise(F.lit(0).cast(MONEY)))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, and 0.0 where the whole is not positive."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0)).cast("double")


# Over how many tasks the rows of one hot key are spread before they meet.
SALTS = 16


def salt(column: str) -> Column:
    """A small number that differs between rows of one key; the same on every retry."""
    return F.pmod(F.xxhash64(column), F.lit(SALTS))
