from __future__ import annotations

import random
from datetime import timedelta

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from shop import at, event, frame
from tidemark.operators.sessions import sessions

IDLE = timedelta(minutes=30)


def expected(rows: list[dict]) -> list[tuple]:
    """Brute force: walk each user's events in order."""
    found = []
    for user in {r["user_id"] for r in rows}:
        mine = sorted(r["timestamp"] for r in rows if r["user_id"] == user)
        current = [mine[0]]
        for moment in mine[1:]:
            if moment - current[-1] < IDLE:
                current.append(moment)
            else:
                found.append((user, current[0], current[-1], len(current)))
                current = [moment]
        found.append((user, current[0], current[-1], len(current)))
    return sorted(found)


def actual(df) -> list[tuple]:
    rows = df.collect()
    return sorted((r.user_id, r.session_start, r.session_end, r.event_count) for r in rows)


def test_exactly_thirty_minutes_starts_a_new_session(spark):
    rows = [event(1, "click", at(1)), event(2, "click", at(31))]
    assert len(actual(sessions(frame(spark, rows)))) == 2
    rows[1]["timestamp"] -= timedelta(microseconds=1)
    assert len(actual(sessions(frame(spark, rows)))) == 1


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.integers(0, 2), st.integers(0, 20), st.sampled_from([0, 1, -1, 400])),
        min_size=1,
        max_size=30,
    )
)
def test_equals_brute_force(spark, moments):
    """Steps of a quarter hour hit the limit exactly, just below and just above."""
    rows = [
        event(i, "click", at(15 * step) + timedelta(microseconds=shift), user_id=f"u{user}")
        for i, (user, step, shift) in enumerate(moments)
    ]
    assert actual(sessions(frame(spark, rows))) == expected(rows)


def test_equals_session_window(spark):
    rng = random.Random(3)
    rows = [
        event(i, "click", at(rng.uniform(0, 5000)), user_id=f"u{rng.randint(0, 4)}")
        for i in range(400)
    ]
    df = frame(spark, rows)
    built_in = df.groupBy("user_id", F.session_window("timestamp", "30 minutes")).agg(
        F.min("timestamp").alias("session_start"),
        F.max("timestamp").alias("session_end"),
        F.count("*").alias("event_count"),
    )
    assert actual(sessions(df)) == actual(built_in)


def test_attribute_is_the_one_at_the_start(spark):
    rows = [
        event(1, "click", at(1), user_segment="vip"),
        event(2, "click", at(2), user_segment="casual"),
        event(3, "click", at(3), user_segment="vip"),
        event(4, "click", at(50), user_segment=None),
    ]
    got = sessions(frame(spark, rows), "user_segment").orderBy("session_start").collect()
    assert [(r.user_segment, r.event_count) for r in got] == [("vip", 3), (None, 1)]
    assert got[0].duration_us == 120_000_000


def test_busy_user_is_reduced_before_ordering(spark, plan):
    """One user with all events: 48 rows a day at most reach the ordered step."""
    busy = spark.range(0, 86400 * 2, 1, 8).select(
        F.lit("bot").alias("user_id"), F.timestamp_seconds("id").alias("timestamp")
    )
    (row,) = sessions(busy).collect()
    assert row.event_count == 86400 * 2
    text = plan(sessions(busy))
    assert text.count("partial_min") >= 1 and text.index("Window") < text.rindex("partial_min")
