"""Sketches that add up, marts of increments, boards of a stream, state, point reads, unknown fields."""

from __future__ import annotations

import json
import random
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from shop import at, event, frame, message, write_messages
from tidemark.operators import ingest, metrics as m
from tidemark.plans import marts, rollups
from tidemark.plans.deltas import DeltaMarts
from tidemark.sources import files
from tidemark.sources.streams import read_events_stream
from tidemark.streaming import run, sinks, state, top
from tidemark.streaming.event_store import EventStore
from tidemark.streaming.metric_table import MetricTable

ONCE = sinks.Trigger(available_now=True)


def rows_of(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=str)


def staged(spark, rows):
    renamed = frame(spark, rows).withColumnRenamed("category", "category_name")
    return renamed.withColumn("event_date", F.to_date("timestamp"))


def shop_rows(n: int, step: float = 9.7, seed: int = 5) -> list[dict]:
    rng = random.Random(seed)
    kinds = ["click", "purchase", "add_to_cart", "product_view", "page_view"]
    return [
        event(
            i,
            rng.choice(kinds),
            at(i * step),
            user_id=f"u{rng.randint(1, 9)}",
            user_segment=rng.choice(["casual", "vip", None]),
            category=rng.choice(["books", "toys", None]),
            product_id=rng.choice(["p1", "p2", None]),
            sale_price=rng.choice([None, 3.25, 10]),
            quantity=rng.randint(1, 3),
        )
        for i in range(n)
    ]


# -- sketches --------------------------------------------------------------------


def test_days_and_hours_come_from_minutes(spark, folder):
    rows = shop_rows(600)
    events = staged(spark, rows)
    rollups.rollup_minutes(events).write.parquet(f"{folder}/minutes")
    minutes = spark.read.parquet(f"{folder}/minutes")
    days = rollups.daily_summary(minutes)
    # With so few users the sketches know each.
    assert rows_of(days) == rows_of(marts.daily_summary(events).select(days.columns))
    assert all(f"{folder}/minutes" in name for name in days.inputFiles())
    hours = rollups.hourly_kpi(minutes)
    assert rows_of(hours) == rows_of(marts.hourly_kpi(events).select(hours.columns))
    # Rolled up in steps it is the same.
    steps = rollups.rolled_up(rollups.rolled_up(minutes, "1 hour"), "1 day")
    assert rows_of(rollups.daily_summary(steps)) == rows_of(days)
    exact = rollups.rollup_minutes(events, exact=True)
    assert exact.filter(rollups.users_of() != F.col("user_count")).count() == 0


def test_the_error_is_as_stated(spark):
    """100,000 users, each in ten minutes of a day."""
    users = spark.range(1_000_000).select(
        F.concat(F.lit("u"), F.pmod(F.col("id"), F.lit(100_000))).alias("user_id"),
        F.timestamp_seconds(F.lit(1_700_006_400) + F.pmod(F.xxhash64("id"), F.lit(86_400))).alias("timestamp"),
        F.lit("click").alias("event_type"),
        F.lit(None).cast("decimal(18,2)").alias("sale_price"),
        F.lit(1).alias("quantity"),
    )
    found = rollups.daily_summary(rollups.rollup_minutes(users)).agg(F.sum("unique_users"), F.count("*")).first()
    assert found[1] == 1 and abs(found[0] - 100_000) <= 3 * rollups.RELATIVE_ERROR * 100_000


def test_rollup_of_batches(spark, folder):
    """Parts of a minute that come in several batches, one of them twice."""
    rows = shop_rows(200, 0.4)
    table = rollups.MinuteRollup(spark, f"{folder}/rollup")
    write = table.batch_writer("q")
    for n in (0, 1, 1, 2):
        write(rollups.rollup_minutes(frame(spark, rows[n::3])), n)
        if n == 0:
            table.compact()
    minutes = table.current()
    want = rollups.rollup_minutes(frame(spark, rows))
    columns = ["window_start", "total_events", "total_purchases", "clicks", "carts", "revenue"]
    assert rows_of(minutes.select(*columns)) == rows_of(want.select(*columns))
    assert rows_of(minutes.select("window_start", rollups.users_of())) == rows_of(want.select("window_start", rollups.users_of()))


# -- marts of increments ------------------------------------------------------------


def products(spark):
    return spark.createDataFrame([("p1", "pen", "office")], "product_id STRING, product_name STRING, category_name STRING")


def all_marts(kept, spark):
    return [kept.daily_summary(), kept.product_performance(products(spark)), kept.funnel_analysis(), kept.hourly_kpi(), kept.segment_counts()]


def rebuilt(spark, rows):
    events = staged(spark, rows)
    segments = marts.user_segments(events, _no_sessions(spark)).drop("avg_session_duration")
    return [marts.daily_summary(events), marts.product_performance(events, products(spark)), marts.funnel_analysis(events), marts.hourly_kpi(events), segments]


def _no_sessions(spark):
    return spark.createDataFrame([], "session_start TIMESTAMP, user_segment STRING, duration_us LONG")


def same(kept, spark, rows):
    for have, want in zip(all_marts(kept, spark), rebuilt(spark, rows), strict=True):
        assert rows_of(have.select(want.columns)) == rows_of(want)


def test_increments_equal_a_rebuild(spark, folder):
    rows = shop_rows(400, 11.3)
    late = rows[10:14]
    kept = DeltaMarts(spark, f"{folder}/deltas")
    kept.add(staged(spark, [r for r in rows[:250] if r not in late]), 0)
    same(kept, spark, [r for r in rows[:250] if r not in late])
    kept.add(staged(spark, rows[250:]), 1)
    kept.upkeep()
    # The late events touch their dates alone, and nothing is read again of what was there.
    kept.add(staged(spark, late), 2)
    same(kept, spark, rows)
    kept.add(staged(spark, late), 2)
    same(kept, spark, rows)
    kept.upkeep()
    same(kept, spark, rows)
    first = kept.daily_summary(date(2024, 3, 1), date(2024, 3, 1)).collect()
    assert [r.date for r in first] == [date(2024, 3, 1)]


def test_an_increment_reads_only_itself(spark, folder, plan):
    from tidemark.plans import deltas

    staged(spark, shop_rows(50)).write.parquet(f"{folder}/new")
    text = plan(deltas.sums_of(spark.read.parquet(f"{folder}/new")))
    assert text.count("FileScan") == 1


# -- boards of a stream ---------------------------------------------------------------


def purchases(n: int, hours: int, skus: int) -> list[dict]:
    rng = random.Random(3)
    return [
        event(i, rng.choice(["purchase", "purchase", "click"]), at(rng.random() * 60 * hours), sku=f"s{min(rng.randrange(skus), rng.randrange(skus))}")
        for i in range(n)
    ]


def test_boards_of_closed_hours_equal_the_batch(spark, folder):
    rows = sorted(purchases(300, 5, 20), key=lambda r: r["timestamp"])
    rows.append(event(999, "click", at(60 * 9)))
    for i in range(5):
        part = rows[i * 61 : (i + 1) * 61]
        write_messages(f"{folder}/in", f"{i}.json", [message(r) for r in part], i)
    stream = read_events_stream(spark, "json", f"{folder}/in", maxFilesPerTrigger="1")
    clean, _ = run.clean_stream(stream, "5 minutes")
    table = top.TopProducts(spark, f"{folder}/boards")
    top.start_top_products(clean, table, f"{folder}/checkpoint", ONCE).awaitTermination()
    want = m.top_products_1h(frame(spark, rows)).select("window_start", F.col("dimension_value").alias("sku"), F.col("metric_value").cast("long").alias("purchase_count"), "position")
    assert rows_of(table.current().select(want.columns)) == rows_of(want) and table.current().count() > 40


def test_counts_of_a_small_sketch_are_within_the_bound(spark):
    """3,000 products against a sketch that tracks 100."""
    rng = random.Random(7)
    skus = [f"s{int(rng.paretovariate(0.9))}" for _ in range(40_000)]
    bought = spark.createDataFrame([(s,) for s in skus], "sku STRING").selectExpr("sku", "'purchase' AS event_type", "TIMESTAMP '2024-03-01 10:00:00' AS timestamp")
    found = top.ranked(top.hourly_sketches(bought, tracked=100), tracked=100).collect()
    true = Counter(skus)
    allowed = top.error_bound(100) * len(skus)
    assert len(found) == 10 and all(abs(r.purchase_count - true[r.sku]) <= allowed for r in found)
    # Whatever is ahead of the last of the board by twice the bound is on it.
    last = min(true[r.sku] for r in found)
    assert {s for s, n in true.items() if n > last + 2 * allowed} <= {r.sku for r in found}


# -- state ------------------------------------------------------------------------------


def test_state_stays_bounded_over_many_batches(spark, folder):
    """Fifty batches of ten minutes each; a minute goes five minutes later."""
    rows = [event(i, "click", at(i * 2), user_id=f"u{i % 3}") for i in range(250)]
    layout = run.Layout(f"{folder}/out")
    for i in range(50):
        write_messages(f"{folder}/in", f"{i:02}.json", [message(r) for r in rows[i * 5 : (i + 1) * 5]], i)
    stream = read_events_stream(spark, "json", f"{folder}/in", maxFilesPerTrigger="1")
    run.start_all(spark, stream, layout, ONCE, only=("counts_1m", "raw_events")).wait()
    held = state.all_state(spark, layout, ("counts_1m", "raw_events")).collect()
    assert [(r.query, r.operator) for r in held] == [("counts_1m", "stateStoreSave")]
    assert 0 < held[0].rows <= 8
    last = held[0].batch_id
    before = [state.state_rows(spark, "counts_1m", layout.checkpoint("counts_1m"), n).first().rows for n in (last - 1, last - 2)]
    assert max(before) <= 10
    states = state.all_state(spark, layout, ("counts_1m",))
    assert state.too_large(states, {"counts_1m": 10}).count() == 0
    assert [r.limit for r in state.too_large(states, {"counts_1m": 0}).collect()] == [0]


def test_no_state_no_rows(spark, folder):
    assert state.all_state(spark, run.Layout(f"{folder}/nothing"), ("counts_1m",)).collect() == []


# -- point reads --------------------------------------------------------------------------


def test_a_point_read_takes_few_files(spark, folder):
    rows = [event(i, "click", at(i % 600), sku=f"s{i % 40:02}") for i in range(3000)]
    table = MetricTable(spark, f"{folder}/t")
    write = table.batch_writer("q")
    metrics = m.product_counts_1h(frame(spark, rows), "click")
    packed = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(packed, "false")
    try:
        write(metrics, 0)
        table.compact()
    finally:
        spark.conf.unset(packed)
    every = files.matching(spark, f"{folder}/t/base/*/*/part-*")
    one = table.point("product_click_count", "sku", "s07")
    assert 1 <= len(one.inputFiles()) < len(every) / 2
    want = metrics.filter("dimension_value = 's07'")
    assert rows_of(one.select(want.columns)) == rows_of(want)
    # What came after the compaction counts as well, newer values first.
    write(metrics.withColumn("metric_value", F.lit(0.0)), 1)
    assert {r.metric_value for r in table.point("product_click_count", "sku", "s07").collect()} == {0.0}
    assert table.point("product_click_count", "sku", "none").count() == 0
    assert table.point("product_click_count", "sku", "s07", date(2024, 3, 2)).count() == 0
    assert MetricTable(spark, f"{folder}/empty").point("x").collect() == []


# -- unknown fields -------------------------------------------------------------------------


@pytest.mark.parametrize("place", ["top", "user", "none"])
def test_unknown_fields_are_kept(spark, folder, place):
    sent = json.loads(message(event(1, "click", at(0))))
    more = {"top": sent, "user": sent["user"], "none": {}}[place]
    more["campaign"] = {"id": 7, "path": [1, "b"]}
    raw = spark.createDataFrame([(json.dumps(sent).encode(), at(0)), (b"no json", at(0))], "value BINARY, timestamp TIMESTAMP")
    clean, _ = ingest.route(ingest.flatten(ingest.parse(raw, unknown=True)))
    store = EventStore(spark, f"{folder}/events")
    store.batch_writer("q")(clean, 0)
    store.compact()
    path = {"top": "$.campaign", "user": "$.user.campaign", "none": "$.campaign"}[place]
    got = store.current().select("event_id", F.try_variant_get("extra", f"{path}.id", "int"), F.try_variant_get("extra", f"{path}.path[1]", "string"), F.isnull("extra")).collect()
    want = ("e1", None, None, True) if place == "none" else ("e1", 7, "b", False)
    assert [tuple(r) for r in got] == [want]


def test_known_messages_have_no_unknown_fields(spark):
    sent = spark.createDataFrame([(message(event(i, "click", at(0) + timedelta(minutes=i))),) for i in range(3)] + [("[]",), ("{}",), ("",), (None,)], "value STRING")
    assert sent.filter(ingest.has_unknown_fields(F.col("value"))).count() == 0
