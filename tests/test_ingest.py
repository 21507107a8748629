from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ingest
from tidemark.sources.streams import kafka_options, read_events_stream

GOOD = {
    "event_id": "1",
    "event_type": "purchase",
    "timestamp": "2024-03-01T10:00:00.123456+00:00",
    "user": {"user_id": "u", "city": "Hue"},
    "product": {"sale_price": 2.5, "subcategory": "x"},
    "event_data": {"quantity": 2, "referrer": "ads"},
}

CASES = [
    ("valid", GOOD, None),
    ("zulu time", {**GOOD, "event_type": "click", "timestamp": "2024-03-01T10:00:00Z"}, None),
    ("no event id", {k: v for k, v in GOOD.items() if k != "event_id"}, "Null Event ID"),
    ("no user", {**GOOD, "user": {}}, "Null User ID"),
    ("no user struct", {k: v for k, v in GOOD.items() if k != "user"}, "Null User ID"),
    ("bad type", {**GOOD, "event_type": "bogus"}, "Invalid Event Type"),
    ("no type", {k: v for k, v in GOOD.items() if k != "event_type"}, "Invalid Event Type"),
    ("bad time", {**GOOD, "timestamp": "soon"}, "Null Timestamp"),
    ("text quantity", {**GOOD, "event_data": {"quantity": "x"}}, None),
    ("huge price", {**GOOD, "product": {"sale_price": 1e30}}, None),
    ("first rule wins", {"event_type": "bogus"}, "Null Event ID"),
]


def messages(spark, texts):
    rows = [(t.encode(), datetime(2024, 3, 1, 11)) for t in texts]
    return spark.createDataFrame(rows, "value BINARY, timestamp TIMESTAMP")


@pytest.mark.parametrize("name,body,reason", CASES, ids=[c[0] for c in CASES])
def test_verdict(spark, name, body, reason):
    flat = ingest.flatten(ingest.parse(messages(spark, [json.dumps(body)])))
    (row,) = ingest.validate(flat).collect()
    assert row["error_reason"] == reason
    assert flat.filter(ingest.is_valid()).count() == (reason is None)


@pytest.mark.parametrize("text", ["not json", "", "[1]", "{"])
def test_text_that_is_no_event(spark, text):
    clean, dead = ingest.ingest(messages(spark, [text]))
    assert clean.count() == 0
    assert [r["error_reason"] for r in dead.collect()] == ["Null Event ID"]


def test_values(spark):
    clean, _ = ingest.ingest(messages(spark, [json.dumps(GOOD)]))
    (row,) = clean.collect()
    assert row["timestamp"] == datetime(2024, 3, 1, 10, 0, 0, 123456)
    assert row["kafka_timestamp"] == datetime(2024, 3, 1, 11)
    assert (float(row["sale_price"]), row["quantity"], row["referrer"]) == (2.5, 2, "ads")
    assert (row["city"], row["subcategory"]) == ("Hue", "x")


def test_bad_leaf_loses_only_itself(spark):
    body = {**GOOD, "event_data": {"quantity": "x", "referrer": "ads"}}
    clean, _ = ingest.ingest(messages(spark, [json.dumps(body)]))
    (row,) = clean.select("quantity", "event_id", "user_id").collect()
    assert tuple(row) == (None, "1", "u")


def test_each_message_is_parsed_once(spark, plan):
    clean, _ = ingest.ingest(messages(spark, [json.dumps(GOOD)]))
    assert plan(clean).count("from_json") == 1


def test_only_needed_fields_are_decoded(spark, plan):
    clean, _ = ingest.ingest(messages(spark, [json.dumps(GOOD)]), ("sale_price", "quantity"))
    assert set(clean.columns) == {*ingest.VALIDATED, "sale_price", "quantity"}
    (row,) = clean.collect()
    assert (row.user_id, float(row.sale_price), row.quantity) == ("u", 2.5, 2)
    assert "screen_size" not in plan(clean) and "referrer" not in plan(clean)


def test_stored_form_renames(spark):
    clean, _ = ingest.ingest(messages(spark, [json.dumps(GOOD)]))
    stored = ingest.to_stored(clean)
    assert "category_name" in stored.columns and "position_in_list" in stored.columns
    (row,) = stored.collect()
    assert str(row["event_date"]) == "2024-03-01"
    assert row["ingested_at"] == datetime(2024, 3, 1, 11)


def test_repeats_keep_the_earliest(spark, plan):
    rows = [("a", datetime(2024, 1, 1, 2), 1), ("a", datetime(2024, 1, 1, 1), 2)]
    rows += [("b", datetime(2024, 1, 1), 3)] * 5
    df = spark.createDataFrame(rows, "event_id STRING, timestamp TIMESTAMP, n INT")
    kept = ingest.drop_repeats(df)
    assert sorted((r.event_id, r.n) for r in kept.collect()) == [("a", 2), ("b", 3)]


def test_repeats_shrink_before_the_shuffle(spark, plan):
    df = spark.range(100).select(
        (F.col("id") % 3).cast("string").alias("event_id"),
        F.timestamp_seconds("id").alias("timestamp"),
    )
    text = plan(ingest.drop_repeats(df))
    below_shuffle = text[text.index("Exchange"):]
    assert "WindowGroupLimit" in below_shuffle and "Partial" in below_shuffle


def test_kafka_options():
    assert kafka_options("broker:9092", maxOffsetsPerTrigger="5") == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "raw-events",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "5",
    }


def test_unknown_stream_kind(spark):
    with pytest.raises(ValueError):
        read_events_stream(spark, "carrier pigeon", "x")
