"""Sessions: a user's events with less than 30 idle minutes between them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.schemas import SESSION_IDLE_SECONDS

# session_window joins events at a distance of exactly its gap; an idle time of
# exactly the limit must start a new session, hence one microsecond less.
_STREAM_GAP = f"{SESSION_IDLE_SECONDS - 1} seconds 999 milliseconds 999 microseconds"


def _micros(column: str) -> Column:
    return F.unix_micros(F.col(column).cast("timestamp"))


def _result(grouped: DataFrame, *extra: str) -> DataFrame:
    duration = _micros("session_end") - _micros("session_start")
    return grouped.select(
        "user_id",
        "session_start",
        "session_end",
        "event_count",
        duration.alias("duration_us"),
        *extra,
    )


def sessions(events: DataFrame, attribute: str | None = None) -> DataFrame:
    """Batch sessions, exact for any key distribution.

    Two events of a user in the same half-hour slot always belong together, so
    each slot is first reduced to its ends. What is left per user is at most 48
    rows a day however busy the user is; only those are ordered per user.
    ``attribute`` adds a column with its value at the start of the session.
    """
    extra = [attribute] if attribute else []
    slots = events.groupBy(
        "user_id", F.window("timestamp", f"{SESSION_IDLE_SECONDS} seconds").alias("slot"), *extra
    ).agg(
        F.min("timestamp").alias("first"),
        F.max("timestamp").alias("last"),
        F.count("*").alias("events"),
    )
    by_time = Window.partitionBy("user_id").orderBy("first", *extra)
    before = F.max("last").over(by_time.rowsBetween(Window.unboundedPreceding, -1))
    idle = F.col("first") - before >= F.make_dt_interval(secs=F.lit(SESSION_IDLE_SECONDS))
    numbered = slots.withColumn("starts", F.coalesce(idle, F.lit(True)).cast("int")).withColumn(
        "session_no", F.sum("starts").over(by_time)
    )
    at_start = [
        F.min(F.struct("first", attribute))[attribute].alias(attribute) for attribute in extra
    ]
    grouped = numbered.groupBy("user_id", "session_no").agg(
        F.min("first").alias("session_start"),
        F.max("last").alias("session_end"),
        F.sum("events").alias("event_count"),
        *at_start,
    )
    return _result(grouped, *extra)


def session_stream(events: DataFrame) -> DataFrame:
    """Sessions of a watermarked stream; emitted once closed (append mode)."""
    grouped = events.groupBy("user_id", F.session_window("timestamp", _STREAM_GAP)).agg(
        F.min("timestamp").alias("session_start"),
        F.max("timestamp").alias("session_end"),
        F.count("*").alias("event_count"),
    )
    return _result(grouped)
