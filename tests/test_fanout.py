"""All sinks from one read, the event store, and windows repaired after late events."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest

from shop import at, event, frame, message, write_messages
from tidemark.operators import metrics as m
from tidemark.schemas import METRIC_COLUMNS
from tidemark.sources import files, tables as t
from tidemark.sources.streams import read_events_stream
from tidemark.streaming import fanout, repair, run, sinks
from tidemark.streaming.event_store import EventStore
from tidemark.streaming.metric_table import MetricTable

ONCE = sinks.Trigger(available_now=True)


def shop_rows(n: int = 120, step: float = 0.7) -> list[dict]:
    rng = random.Random(5)
    kinds = ["click", "purchase", "add_to_cart", "product_view", "page_view"]
    return [
        event(
            i,
            rng.choice(kinds),
            at(i * step),
            user_id=f"u{rng.randint(1, 5)}",
            user_segment=rng.choice(["casual", None]),
            category=rng.choice(["books", "toys", None]),
            sku=rng.choice(["s1", "s2", None]),
            sale_price=rng.choice([None, 3.25]),
            time_on_page_sec=rng.choice([None, 40, 3]),
        )
        for i in range(n)
    ]


def json_stream(spark, folder):
    return read_events_stream(spark, "json", folder, maxFilesPerTrigger="1")


def rows_of(df, columns=METRIC_COLUMNS) -> list[tuple]:
    return sorted(tuple(r) for r in df.select(*columns).collect())


def put(folder, pieces, first=0):
    for i, rows in enumerate(pieces, first):
        write_messages(folder, f"part{i}.json", [r if isinstance(r, str) else message(r) for r in rows], i)


def cut(rows, n):
    size = -(-len(rows) // n)
    return [rows[i * size : (i + 1) * size] for i in range(n)]


def ids_of(df) -> list[str]:
    return sorted(r.event_id for r in df.select("event_id").collect())


def test_fanout_equals_batch(spark, folder):
    """Events out of order over days, dead letters, and a batch of nothing but those."""
    rows = shop_rows(90) + shop_rows(60, 47.0)
    for i, row in enumerate(rows):
        row["event_id"] = f"e{i}"
    random.Random(2).shuffle(rows)
    bad = ["no json", message(event(900, "bogus", at(1))), message(event(901, "click", at(2), user_id=None))]
    put(f"{folder}/in", [*cut(rows, 4), bad])
    layout = run.Layout(f"{folder}/out")
    query = fanout.start_fanout(spark, json_stream(spark, f"{folder}/in"), layout, ONCE, ("json", f"{folder}/sent"), compact_every=2)
    query.awaitTermination()
    batch = m.all_metrics(frame(spark, rows))
    assert rows_of(MetricTable(spark, layout.metrics).current()) == rows_of(batch)
    assert ids_of(EventStore(spark, layout.event_store).current()) == sorted(r["event_id"] for r in rows)
    dead = fanout.DeadLetters(spark, layout.dead_letter_store).current().collect()
    assert sorted((r.event_id or "", r.error_reason, r.message) for r in dead) == sorted(
        [("", "Null Event ID", bad[0]), ("e900", "Invalid Event Type", bad[1]), ("e901", "Null User ID", bad[2])]
    )
    # Every message was read once a trigger.
    assert sum(p["numInputRows"] for p in query.recentProgress) == len(rows) + len(bad)
    sent = spark.read.text(f"{folder}/sent/{sinks.METRICS_TOPIC}")
    assert sent.count() >= batch.count()
    assert spark.read.text(f"{folder}/sent/{sinks.DEAD_LETTER_TOPIC}").count() == 3
    fanout.upkeep(spark, layout)
    assert rows_of(MetricTable(spark, layout.metrics).current()) == rows_of(batch)
    assert ids_of(EventStore(spark, layout.event_store).current()) == sorted(r["event_id"] for r in rows)


@pytest.mark.parametrize("place", ["dead", "sums", "rollup", "metrics"])
def test_a_crash_between_two_sinks_is_replayed(spark, folder, place, monkeypatch):
    rows = shop_rows(60)
    put(f"{folder}/in", cut(rows, 3))
    layout = run.Layout(f"{folder}/out")
    made = fanout.FanOut.__init__

    def broken(self, *args, **options):
        made(self, *args, **options)
        write = self.write[place]

        def fail(batch, batch_id):
            if batch_id == 1:
                # Half of its work is done.
                write(batch.limit(1), batch_id)
                raise RuntimeError("the job dies here")
            return write(batch, batch_id)

        self.write[place] = fail

    monkeypatch.setattr(fanout.FanOut, "__init__", broken)
    query = fanout.start_fanout(spark, json_stream(spark, f"{folder}/in"), layout, ONCE)
    with pytest.raises(Exception, match="the job dies here"):
        query.awaitTermination()
    monkeypatch.setattr(fanout.FanOut, "__init__", made)
    fanout.start_fanout(spark, json_stream(spark, f"{folder}/in"), layout, ONCE).awaitTermination()
    assert rows_of(MetricTable(spark, layout.metrics).current()) == rows_of(m.all_metrics(frame(spark, rows)))
    assert ids_of(EventStore(spark, layout.event_store).current()) == sorted(r["event_id"] for r in rows)


def test_the_batch_is_parsed_once(spark, folder, plan, monkeypatch):
    """What the writers get stands on the kept rows, not on the messages."""
    seen = []
    made = fanout.FanOut.__init__

    def watching(self, *args, **options):
        made(self, *args, **options)
        for name in ("store", "dead", "sums", "users", "rollup"):
            self.write[name] = lambda batch, n, name=name: seen.append((name, plan(batch))) or 0
        self.write["metrics"] = lambda batch, n: 0

    monkeypatch.setattr(fanout.FanOut, "__init__", watching)
    messages = spark.createDataFrame([(message(event(1, "click", at(0))).encode(), at(0))], "value BINARY, timestamp TIMESTAMP")
    fanout.FanOut(spark, run.Layout(f"{folder}/out"))(messages, 0)
    assert {name for name, _ in seen} == {"store", "dead", "sums", "users", "rollup"}
    assert all("InMemoryTableScan" in text for _, text in seen)


def late_pieces():
    """Two hours of events; some of the first hour come last."""
    rows = shop_rows(160, 1.1)
    late = [r for i, r in enumerate(rows[:60]) if i % 4 == 0]
    on_time = [r for r in rows if r not in late]
    return rows, [*cut(on_time, 4), late]


def test_late_events_are_in_their_windows_at_once(spark, folder):
    rows, pieces = late_pieces()
    put(f"{folder}/in", pieces)
    layout = run.Layout(f"{folder}/out")
    fanout.start_fanout(spark, json_stream(spark, f"{folder}/in"), layout, ONCE).awaitTermination()
    assert rows_of(MetricTable(spark, layout.metrics).current()) == rows_of(m.all_metrics(frame(spark, rows)))


def test_repair_of_late_windows(spark, folder):
    """A stateful run leaves late events out; the repair brings their windows up to date."""
    rows, pieces = late_pieces()
    put(f"{folder}/in", pieces)
    layout = run.Layout(f"{folder}/out")
    only = ("counts_1m", "rates_5m", "hourly", "time_on_page_5m", "active_users_1m", "event_store")
    run.start_all(spark, json_stream(spark, f"{folder}/in"), layout, ONCE, only=only).wait()
    table, store = MetricTable(spark, layout.metrics), EventStore(spark, layout.event_store)
    want = rows_of(m.all_metrics(frame(spark, rows)))
    assert rows_of(table.current()) != want
    n = repair.repair_late(spark, store, table, "5 minutes")
    assert 0 < n < len(want) and rows_of(table.current()) == want
    late = {r["timestamp"].replace(second=0, microsecond=0) for r in pieces[-1]}
    closed = {r.window_start for r in repair.late_windows(store.current(), "5 minutes").filter("window_type = '1m'").collect()}
    assert closed >= late
    # Again, over compacted tables.
    store.compact()
    store.vacuum()
    table.compact()
    table.vacuum()
    assert repair.repair_late(spark, store, table, "5 minutes") == n
    assert rows_of(table.current()) == want
    assert repair._next(spark, table, 0) == repair.FIRST_REPAIR + 2


def test_nothing_late_nothing_repaired(spark, folder):
    # Four minutes in all: no window can have been closed when an event came.
    put(f"{folder}/in", cut(shop_rows(40, 0.1), 2))
    layout = run.Layout(f"{folder}/out")
    run.start_all(spark, json_stream(spark, f"{folder}/in"), layout, ONCE, only=("counts_1m", "event_store")).wait()
    table = MetricTable(spark, layout.metrics)
    before = rows_of(table.current())
    assert repair.repair_late(spark, EventStore(spark, layout.event_store), table, "5 minutes") == 0
    assert rows_of(table.current()) == before


# -- the event store ---------------------------------------------------------------


def stored_batches(spark, store, batches, first=0):
    write = store.batch_writer("events")
    for n, rows in enumerate(batches, first):
        write(frame(spark, rows).selectExpr("*", "timestamp AS kafka_timestamp"), n)


def test_each_event_is_seen_once_before_during_and_after(spark, folder):
    rows = shop_rows(80, 60.0)
    store = EventStore(spark, f"{folder}/events")
    stored_batches(spark, store, cut(rows, 4))
    want = sorted(r["event_id"] for r in rows)
    before = store.current()
    store.compact()
    assert ids_of(before) == ids_of(store.current()) == want
    stored_batches(spark, store, [[event(500, "click", at(0))], rows[60:]], 4)
    # Batch 5 has not committed: nobody sees it.
    files.delete(spark, f"{folder}/events/updates/query=events/run=0/batch_id=5/_SUCCESS")
    assert ids_of(store.current()) == sorted([*want, "e500"])
    store.compact()
    store.vacuum()
    assert ids_of(store.current()) == sorted([*want, "e500"])
    # A compaction that died leaves a folder without a state file.
    frame(spark, rows[:5]).selectExpr("*", "0 AS run").write.parquet(f"{folder}/events/base/version=9/event_date=2024-03-01")
    assert ids_of(store.current()) == sorted([*want, "e500"])


def test_files_are_packed_by_size(spark, folder):
    """Small folders are packed again, one that has reached the size is left alone."""
    rows = shop_rows(40)
    store = EventStore(spark, f"{folder}/events", target_bytes=1 << 30)
    for n, part in enumerate(cut(rows, 8)):
        stored_batches(spark, store, [part], n)
        store.compact()
    store.vacuum()
    assert len(files.matching(spark, f"{folder}/events/base/*/event_date=2024-03-01/part-*")) == 1
    store.target_bytes = 1
    stored_batches(spark, store, [[event(99, "click", at(1))]], 8)
    store.compact()
    store.vacuum()
    folders = files.matching(spark, f"{folder}/events/base/*/event_date=2024-03-01")
    assert [f.split("version=")[1].split("/")[0] for f in folders] == ["8", "9"]
    assert ids_of(store.current()) == sorted([*(r["event_id"] for r in rows), "e99"])


def test_a_range_reads_its_dates_alone(spark, folder):
    rows = [event(n, "click", at(0) + timedelta(days=n)) for n in range(5)]
    store = EventStore(spark, f"{folder}/events")
    stored_batches(spark, store, cut(rows, 2))
    store.compact()
    some = store.current(date(2024, 3, 2), date(2024, 3, 3))
    assert ids_of(some) == ["e1", "e2"]
    assert len(some.inputFiles()) == 2
    daily = t.read_raw_events(spark, _moved(spark, folder)).filter("event_date = DATE '2024-03-04'")
    assert ids_of(daily) == ["e3"]
    scan = daily._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in scan


def _moved(spark, folder) -> t.Tables:
    """The store where the batch jobs look for it."""
    store = EventStore(spark, f"{folder}/shop/event_store")
    write = store.batch_writer("events")
    write(EventStore(spark, f"{folder}/events").current().drop("run", "batch_id"), 0)
    store.compact()
    return t.Tables(f"{folder}/shop")


def test_an_empty_store(spark, folder):
    store = EventStore(spark, f"{folder}/events")
    assert store.current().collect() == [] and store.compact() == 0
    stored_batches(spark, store, [[]])
    assert store.current().collect() == [] and not files.exists(spark, f"{folder}/events/audit/query=events/run=0/batch_id=0")
