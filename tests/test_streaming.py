"""Streams against batches, restarts, late and repeated events, the metric table."""

from __future__ import annotations

import json
import random
from datetime import date

import pytest

from shop import at, event, frame, message, write_messages
from tidemark.operators import metrics as m
from tidemark.operators.sessions import session_stream, sessions
from tidemark.schemas import METRIC_COLUMNS, METRIC_KEY
from tidemark.sources import files
from tidemark.sources.streams import read_events_stream
from tidemark.streaming import run, sinks
from tidemark.streaming.metric_table import MetricTable

ONCE = sinks.Trigger(available_now=True)


def shop_rows(n: int = 120) -> list[dict]:
    rng = random.Random(5)
    kinds = ["click", "purchase", "add_to_cart", "product_view"]
    return [
        event(
            i,
            rng.choice(kinds),
            at(i * 0.7),
            user_id=f"u{rng.randint(1, 5)}",
            sku=rng.choice(["s1", "s2"]),
            sale_price=rng.choice([None, 3.25]),
            time_on_page_sec=rng.choice([None, 40]),
        )
        for i in range(n)
    ]


def json_stream(spark, folder):
    return read_events_stream(spark, "json", folder, maxFilesPerTrigger="1")


def rows_of(df, columns=METRIC_COLUMNS) -> list[tuple]:
    return sorted(tuple(r) for r in df.select(*columns).collect())


def put(folder, rows, pieces):
    size = -(-len(rows) // pieces)
    for i in range(pieces):
        part = [message(r) for r in rows[i * size : (i + 1) * size]]
        write_messages(folder, f"part{i}.json", part, i)


def test_stream_equals_batch(spark, folder):
    """The same events in six batches and in one, for every metric query."""
    rows = shop_rows()
    put(f"{folder}/in", rows, 6)
    layout = run.Layout(f"{folder}/out")
    run.start_all(spark, json_stream(spark, f"{folder}/in"), layout, ONCE).wait()
    table = MetricTable(spark, layout.metrics)
    batch = m.all_metrics(frame(spark, rows))
    assert rows_of(table.current()) == rows_of(batch)
    stored = spark.read.parquet(layout.raw_events)
    assert stored.count() == len(rows)
    assert {f.name for f in stored.schema} >= {"event_date", "category_name", "ingested_at"}
    table.compact()
    table.vacuum()
    assert rows_of(table.current()) == rows_of(batch)
    assert rows_of(table.current(date(2024, 3, 2))) == []
    assert rows_of(table.current(date(2024, 3, 1), date(2024, 3, 1))) == rows_of(batch)


def test_restart_goes_on_where_it_stopped(spark, folder):
    rows = shop_rows()
    put(f"{folder}/in", rows[:60], 2)
    layout = run.Layout(f"{folder}/out")
    only = ("counts_1m", "raw_events")
    run.start_all(spark, json_stream(spark, f"{folder}/in"), layout, ONCE, only=only).wait()
    for i, start in enumerate(range(60, 120, 20)):
        lines = [message(r) for r in rows[start : start + 20]]
        write_messages(f"{folder}/in", f"later{i}.json", lines, 10 + i)
    run.start_all(spark, json_stream(spark, f"{folder}/in"), layout, ONCE, only=only).wait()
    current = MetricTable(spark, layout.metrics).current()
    assert rows_of(current) == rows_of(m.counts_1m(frame(spark, rows)))
    assert spark.read.parquet(layout.raw_events).count() == len(rows)


def test_repeated_events_are_stored_once(spark, folder):
    rows = shop_rows(30)
    put(f"{folder}/in", rows + rows[:10], 2)
    layout = run.Layout(f"{folder}/out")
    stream = json_stream(spark, f"{folder}/in")
    # The repeats lie 20 minutes back; the watermark has to reach that far.
    both = ("raw_events", "unique_events")
    run.start_all(spark, stream, layout, ONCE, watermark="1 hour", only=both).wait()
    stored = spark.read.parquet(layout.unique_events)
    assert stored.count() == stored.select("event_id").distinct().count() == 30
    assert spark.read.parquet(layout.raw_events).count() == 40


def test_late_events_are_stored_all_the_same(spark, folder):
    pieces = [[event(1, "click", at(60))], [event(2, "click", at(61))], [event(3, "purchase", at(0))]]
    for i, rows in enumerate(pieces):
        write_messages(f"{folder}/in", f"{i}.json", [message(r) for r in rows], i)
    layout = run.Layout(f"{folder}/out")
    stream = json_stream(spark, f"{folder}/in")
    run.start_all(spark, stream, layout, ONCE, only=("raw_events",)).wait()
    ids = {r.event_id for r in spark.read.parquet(layout.raw_events).collect()}
    assert ids == {"e1", "e2", "e3"}


def test_files_of_a_batch_do_not_grow_with_the_shuffle(spark, folder):
    rows = shop_rows(40)
    put(f"{folder}/in", rows, 1)
    layout = run.Layout(f"{folder}/out")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        only = ("raw_events", "hourly")
        run.start_all(spark, json_stream(spark, f"{folder}/in"), layout, ONCE, only=only).wait()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    stored = files.matching(spark, f"{layout.raw_events}/event_date=*/part-*")
    assert len(stored) == len({r["timestamp"].date() for r in rows})
    batch = files.matching(spark, f"{layout.metrics}/updates/query=hourly/run=0/batch_id=0/part-*")
    assert 1 <= len(batch) <= 2


def test_late_events_are_dropped_behind_the_watermark(spark, folder):
    on_time = [event(1, "click", at(0)), event(2, "click", at(60))]
    between = [event(3, "click", at(61))]
    late = [event(4, "click", at(0.5)), event(5, "click", at(57))]
    for i, rows in enumerate([on_time, between, between, late]):
        write_messages(f"{folder}/in", f"{i}.json", [message(r) for r in rows], i)
    layout = run.Layout(f"{folder}/out")
    stream = json_stream(spark, f"{folder}/in")
    run.start_all(spark, stream, layout, ONCE, only=("counts_1m",)).wait()
    counts = {
        r.window_start: r.metric_value
        for r in MetricTable(spark, layout.metrics)
        .current()
        .filter("metric_name = 'events_1m'")
        .collect()
    }
    # An hour late: not counted. Within five minutes: counted.
    assert counts == {at(0): 1, at(60): 1, at(61): 2, at(57): 1}


def test_dead_letters_keep_their_reason(spark, folder):
    good = message(event(1, "click", at()))
    lines = [good, "nonsense", good.replace("click", "bogus")]
    write_messages(f"{folder}/in", "a.json", lines, 0)
    layout = run.Layout(f"{folder}/out")
    stream = json_stream(spark, f"{folder}/in")
    run.start_all(spark, stream, layout, ONCE, only=("dead_letters",)).wait()
    found = [(r.error_reason, r.message) for r in spark.read.parquet(layout.dead_letters).collect()]
    bogus = good.replace("click", "bogus")
    assert sorted(found) == [("Invalid Event Type", bogus), ("Null Event ID", "nonsense")]


def test_dead_letters_are_published(spark, folder):
    write_messages(f"{folder}/in", "a.json", [message(event(1, "click", at())), "nonsense"], 0)
    layout = run.Layout(f"{folder}/out")
    run.start_all(
        spark,
        json_stream(spark, f"{folder}/in"),
        layout,
        ONCE,
        only=("dead_letters",),
        publish=("json", f"{folder}/published"),
    ).wait()
    texts = [r.value for r in spark.read.text(f"{folder}/published/dead_letters").collect()]
    bodies = [json.loads(t) for t in texts]
    assert [(b["error_reason"], b["message"]) for b in bodies] == [("Null Event ID", "nonsense")]
    assert "arrived_at" in bodies[0]


def test_session_stream_equals_batch_for_closed_sessions(spark, folder):
    rng = random.Random(9)
    rows = [
        event(i, "click", at(15 * rng.randint(0, 60)), user_id=f"u{rng.randint(1, 4)}")
        for i in range(80)
    ]
    rows.sort(key=lambda r: r["timestamp"])
    rows.append(event(99, "click", at(5000), user_id="sentinel"))
    put(f"{folder}/in", rows, 3)
    events, _ = run.clean_stream(json_stream(spark, f"{folder}/in"), "5 minutes")
    (
        session_stream(events)
        .writeStream.outputMode("append")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{folder}/out", format="parquet")
        .awaitTermination()
    )
    columns = ["user_id", "session_start", "session_end", "event_count", "duration_us"]
    batch = sessions(frame(spark, rows)).filter("user_id <> 'sentinel'")
    assert rows_of(spark.read.parquet(f"{folder}/out"), columns) == rows_of(batch, columns)


def test_published_messages(spark, folder):
    rows = shop_rows(20)
    put(f"{folder}/in", rows, 1)
    layout = run.Layout(f"{folder}/out")
    run.start_all(
        spark,
        json_stream(spark, f"{folder}/in"),
        layout,
        ONCE,
        only=("rates_5m",),
        publish=("json", f"{folder}/published"),
    ).wait()
    texts = [r.value for r in spark.read.text(f"{folder}/published/rates_5m").collect()]
    want = m.rates_5m(frame(spark, rows)).collect()
    assert len(texts) == len(want)
    for body in map(json.loads, texts):
        assert list(body) == list(METRIC_COLUMNS)
        assert body["dimension_key"] == "" and isinstance(body["metric_value"], str)


def test_run_forever_ends_with_its_query(spark, folder):
    rows = shop_rows(10)
    put(f"{folder}/in", rows, 1)
    layout = run.Layout(f"{folder}/out")
    stream = json_stream(spark, f"{folder}/in")
    run.run_forever(spark, stream, layout, trigger=ONCE, only=("counts_1m",))
    current = MetricTable(spark, layout.metrics).current()
    assert rows_of(current) == rows_of(m.counts_1m(frame(spark, rows)))


def test_failing_batch_fails_the_query(spark, folder):
    """A write that goes wrong is never passed over."""
    put(f"{folder}/in", shop_rows(5), 1)
    clean, _ = run.clean_stream(json_stream(spark, f"{folder}/in"))

    def broken(batch, batch_id):
        raise RuntimeError("disk full")

    query = (
        m.counts_1m(clean)
        .writeStream.outputMode("update")
        .foreachBatch(broken)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    with pytest.raises(Exception, match="disk full"):
        query.awaitTermination()


# -- the metric table ---------------------------------------------------------


def metric_rows(spark, *pairs):
    rows = [
        (at(60 * hour), at(60 * hour + 60), "1h", "segment_distribution", float(v), "user_segment", s)
        for hour, s, v in pairs
    ]
    schema = (
        "window_start TIMESTAMP, window_end TIMESTAMP, window_type STRING, metric_name STRING, "
        "metric_value DOUBLE, dimension_key STRING, dimension_value STRING"
    )
    return spark.createDataFrame(rows, schema)


def state_of(table) -> dict:
    rows = table.current().collect()
    assert len({tuple(r[c] for c in METRIC_KEY) for r in rows}) == len(rows)
    return {(r.window_start, r.dimension_value): r.metric_value for r in rows}


def test_empty_table(spark, folder):
    table = MetricTable(spark, f"{folder}/t")
    assert table.current().count() == 0 and table.compact() == 0


def test_newest_batch_wins_and_replays_change_nothing(spark, folder):
    table = MetricTable(spark, f"{folder}/t")
    write = table.batch_writer("q")
    write(metric_rows(spark, (0, "vip", 1), (0, "new", 5)), 0)
    write(metric_rows(spark, (0, "vip", 2)), 1)
    want = {(at(0), "vip"): 2, (at(0), "new"): 5}
    assert state_of(table) == want
    write(metric_rows(spark, (0, "vip", 2)), 1)
    assert state_of(table) == want
    audit = table.audit().collect()
    assert sorted((r.batch_id, r.metrics_count) for r in audit) == [(0, 2), (1, 1)]


def test_empty_batch_leaves_no_trace_in_the_audit(spark, folder):
    table = MetricTable(spark, f"{folder}/t")
    write = table.batch_writer("q")
    write(metric_rows(spark, (0, "vip", 1)), 0)
    write(metric_rows(spark, (0, "vip", 1)).limit(0), 1)
    assert table.audit().count() == 1 and len(state_of(table)) == 1


def test_compaction_keeps_the_state(spark, folder):
    table = MetricTable(spark, f"{folder}/t")
    write = table.batch_writer("q")
    write(metric_rows(spark, (0, "vip", 1), (20, "vip", 7)), 0)
    assert table.compact() == 1
    write(metric_rows(spark, (0, "vip", 3)), 1)
    want = {(at(0), "vip"): 3, (at(20 * 60), "vip"): 7}
    assert state_of(table) == want
    assert table.compact() == 2 and state_of(table) == want
    table.vacuum()
    assert state_of(table) == want
    assert files.children(spark, f"{folder}/t/updates/query=q/run=0") == []
    # Only the touched date was rewritten.
    assert "window_date=2024-03-02" in files.children(spark, f"{folder}/t/base/version=1")
    assert "window_date=2024-03-01" not in files.children(spark, f"{folder}/t/base/version=1")
    assert table.compact() == 2


def test_unfinished_compaction_is_invisible(spark, folder):
    """A base folder without its state file, as a crash leaves it."""
    table = MetricTable(spark, f"{folder}/t")
    write = table.batch_writer("q")
    write(metric_rows(spark, (0, "vip", 1)), 0)
    wrong = metric_rows(spark, (0, "vip", 99)).selectExpr(
        "*", "current_timestamp() AS computed_at", "0 AS run", "9L AS batch_id"
    )
    wrong.write.parquet(f"{folder}/t/base/version=1/window_date=2024-03-01")
    assert state_of(table) == {(at(0), "vip"): 1}
    assert table.compact() == 1
    assert state_of(table) == {(at(0), "vip"): 1}


def test_a_batch_being_written_is_left_alone(spark, folder):
    """Compaction between a half-written batch and its end loses nothing."""
    table = MetricTable(spark, f"{folder}/t")
    write = table.batch_writer("q")
    write(metric_rows(spark, (0, "vip", 1)), 0)
    half = metric_rows(spark, (0, "vip", 2)).selectExpr("*", "current_timestamp() AS computed_at")
    half.write.parquet(f"{folder}/t/updates/query=q/run=0/batch_id=1")
    files.delete(spark, f"{folder}/t/updates/query=q/run=0/batch_id=1/_SUCCESS")
    assert state_of(table) == {(at(0), "vip"): 1}
    assert table.compact() == 1
    table.vacuum()
    write(metric_rows(spark, (0, "vip", 2), (1, "new", 3)), 1)
    want = {(at(0), "vip"): 2, (at(60), "new"): 3}
    assert state_of(table) == want
    assert table.compact() == 2 and state_of(table) == want


def test_upkeep_leaves_only_dated_folders(spark, folder):
    put(f"{folder}/in", shop_rows(20), 2)
    layout = run.Layout(f"{folder}/out")
    only = ("counts_1m",)
    run.start_all(spark, json_stream(spark, f"{folder}/in"), layout, ONCE, only=only).wait()
    before = rows_of(MetricTable(spark, layout.metrics).current())
    assert run.upkeep(spark, layout) == 1
    assert rows_of(MetricTable(spark, layout.metrics).current()) == before
    assert not files.matching(spark, f"{layout.metrics}/updates/*/*/*/_SUCCESS")


def test_a_range_reads_its_dates_alone(spark, folder):
    table = MetricTable(spark, f"{folder}/t")
    rows = [(24 * d, "vip", d) for d in range(10)]
    table.batch_writer("q")(metric_rows(spark, *rows), 0)
    table.compact()
    table.vacuum()
    read = table.current(date(2024, 3, 3), date(2024, 3, 3)).inputFiles()
    assert read and all("window_date=2024-03-03" in name for name in read)


def test_a_new_run_outranks_the_old_one(spark, folder):
    """A new checkpoint counts its batches from 0 again."""
    table = MetricTable(spark, f"{folder}/t")
    table.batch_writer("q", run=0)(metric_rows(spark, (0, "vip", 1)), 50)
    table.batch_writer("q", run=1)(metric_rows(spark, (0, "vip", 2)), 0)
    assert state_of(table) == {(at(0), "vip"): 2}
    table.compact()
    assert state_of(table) == {(at(0), "vip"): 2}


def test_current_is_a_hash_aggregate(spark, folder, plan):
    table = MetricTable(spark, f"{folder}/t")
    table.batch_writer("q")(metric_rows(spark, (0, "vip", 1)), 0)
    text = plan(table.current())
    assert "HashAggregate" in text and "SortAggregate" not in text


# -- insert if absent -----------------------------------------------------------


def people(spark, *rows):
    return spark.createDataFrame(list(rows), "user_id STRING, username STRING")


def test_insert_absent(spark, folder):
    path = f"{folder}/users"
    load = lambda *rows: sinks.insert_absent(people(spark, *rows), path, "user_id", "username")
    assert load(("1", "ann"), ("2", "bob"), ("2", "bob"), ("3", "ann")) == (2, 2)
    assert load(("1", "ann"), ("2", "bob")) == (0, 2)
    # Clash on the second key only skips that row, not its whole batch.
    assert load(("4", "bob"), ("5", "eve"), (None, "zoe")) == (1, 2)
    assert load(("6", None), ("7", None)) == (2, 0)
    got = {r.user_id: r.username for r in spark.read.parquet(path).collect()}
    assert got == {"1": "ann", "2": "bob", "5": "eve", "6": None, "7": None}
