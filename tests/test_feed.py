"""The supplied events as a stream: a piece of time is a micro-batch, however many files hold it."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest

from tidemark.sources import adapter

START = datetime(2024, 1, 1)


def tables(spark, folder, minutes):
    """Events of users 0 to 4 and products 0 to 2 in several files, and what is known of them."""
    rows = [
        (i, START + timedelta(minutes=minute), i % 5, "purchase", 1.0, json.dumps({"k": i % 3}))
        for i, minute in enumerate(minutes)
    ]
    events = spark.createDataFrame(rows, adapter.EVENTS)
    events.repartition(5).write.parquet(f"{folder}/events.parquet")
    places = spark.createDataFrame([(1, "VIETNAM", 2)], "n_nationkey INT, n_name STRING, n_regionkey INT")
    places.write.parquet(f"{folder}/nation.parquet")
    spark.createDataFrame([(2, "ASIA")], "r_regionkey INT, r_name STRING").write.parquet(f"{folder}/region.parquet")
    people = [(n, f"c{n}", 1, 1.0, "BUILDING") for n in range(1, 5)]
    fields = "c_custkey LONG, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
    spark.createDataFrame(people, fields).write.parquet(f"{folder}/customer.parquet")
    parts = [(n, f"p{n}", "brand", "type", 1, 2.0) for n in range(2)]
    fields = "p_partkey LONG, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE"
    spark.createDataFrame(parts, fields).write.parquet(f"{folder}/part.parquet")


def batches(stream, folder):
    """The messages of each micro-batch."""
    taken = {}

    def take(batch, number):
        taken[number] = [json.loads(bytes(r["value"])) for r in batch.collect()]

    writer = stream.writeStream.foreachBatch(take).option("checkpointLocation", f"{folder}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    return [taken[n] for n in sorted(taken)]


def ids(batch):
    return sorted(int(message["event_id"]) for message in batch)


@pytest.mark.parametrize("file_rows, count", [(100_000, 1), (5, 4)])
def test_a_piece_is_a_batch(spark, folder, monkeypatch, file_rows, count):
    tables(spark, folder, range(120))
    monkeypatch.setattr(adapter.Feed, "FILE_ROWS", file_rows, raising=False)
    feed = adapter.Feed(spark, folder, sentinel=True)
    feed.put()
    taken = batches(feed.messages(), folder)
    assert [ids(b) for b in taken] == [list(range(n * 20, n * 20 + 20)) for n in range(6)] + [[-1]]
    assert feed.files == count


def test_small_and_empty_pieces_fill_their_batch(spark, folder, monkeypatch):
    """Nearly all events in the first sixth, none in most others: still a batch a piece."""
    tables(spark, folder, [0] * 100 + [59, 60])
    monkeypatch.setattr(adapter.Feed, "FILE_ROWS", 5, raising=False)
    feed = adapter.Feed(spark, folder)
    feed.put()
    assert [ids(b) for b in batches(feed.messages(), folder)] == [list(range(100)), [], [], [], [], [100, 101]]


def test_users_and_products_are_joined_before_the_stream(spark, folder):
    tables(spark, folder, range(120))
    stream = adapter.message_stream(spark, folder, user=True, product=True, late=True)
    assert "Join" not in stream._jdf.queryExecution().analyzed().toString()
    taken = batches(stream, folder)
    assert len(taken) == 6 and sorted(i for b in taken for i in ids(b)) == list(range(120))
    known = {int(x["event_id"]): (x["user"].get("country"), x["product"].get("sku")) for b in taken for x in b}
    assert known == {i: ("ASIA" if i % 5 else None, f"SKU-{i % 3}" if i % 3 < 2 else None) for i in range(120)}
    assert {0, 20, 40}.isdisjoint(ids(taken[0])) and 0 in ids(taken[3])


def test_state_is_as_wide_as_a_batch_asks_for(spark, folder, monkeypatch):
    tables(spark, folder, range(120))
    monkeypatch.setattr(adapter.Feed, "FILE_ROWS", 2, raising=False)
    feed = adapter.Feed(spark, folder)
    width = "spark.sql.shuffle.partitions"
    before = spark.conf.get(width)
    try:
        for given, used in ((200, max(10, spark.sparkContext.defaultParallelism)), (3, 3)):
            spark.conf.set(width, given)
            with feed.state_width():
                assert int(spark.conf.get(width)) == used
            assert int(spark.conf.get(width)) == given
    finally:
        spark.conf.set(width, before)
