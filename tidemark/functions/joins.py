"""Broadcast hints that are given only after looking at the size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def size_in_bytes(df: DataFrame) -> int:
    """The optimizer's estimate; for a plain scan, the size of the files it reads."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def broadcast_limit(df: DataFrame) -> int:
    return df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def broadcast_if_small(df: DataFrame, source: DataFrame) -> DataFrame:
    """Hint a broadcast when ``source``, the scan that sets the row count, is small.

    For a side that was itself joined, the optimizer multiplies sizes and would
    shuffle the large side for nothing. Beyond the limit nothing is hinted: the
    join shuffles, and AQE splits hot keys.
    """
    return F.broadcast(df) if size_in_bytes(source) <= broadcast_limit(df) else df
