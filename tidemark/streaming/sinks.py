"""Sinks of the streaming queries and the insert-if-absent load of dimensions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidemark.functions.columns import salt
from tidemark.operators.ingest import PAYLOAD, to_stored
from tidemark.schemas import DEAD_LETTER_TOPIC, METRICS_TOPIC
from tidemark.sources import files
from tidemark.streaming.event_store import EventStore
from tidemark.streaming.metric_table import MetricTable


@dataclass(frozen=True)
class Trigger:
    """How often a query runs, or once over what is there (``available_now``)."""

    every: str = "10 seconds"
    available_now: bool = False

    def apply(self, writer: DataStreamWriter) -> DataStreamWriter:
        if self.available_now:
            return writer.trigger(availableNow=True)
        return writer.trigger(processingTime=self.every)


def _start(
    writer: DataStreamWriter, name: str, checkpoint: str, trigger: Trigger
) -> StreamingQuery:
    named = writer.queryName(name).option("checkpointLocation", checkpoint)
    return trigger.apply(named).start()


def start_raw_events(
    clean: DataFrame, path: str, checkpoint: str, trigger: Trigger
) -> StreamingQuery:
    """Append every valid event by date, however late it comes.

    Nothing here keeps state: an operator with a watermark would drop what lies
    behind it. There is no shuffle either, so a batch writes as many files as
    the source has partitions. The file sink's own log makes a restarted batch
    appear exactly once; repeated ids go when the events are staged.
    """
    writer = (
        to_stored(clean)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .partitionBy("event_date")
    )
    return _start(writer, "raw_events", checkpoint, trigger)


def start_event_store(
    clean: DataFrame, store: EventStore, checkpoint: str, trigger: Trigger, run: int = 0
) -> StreamingQuery:
    """Append every valid event to a store that can be compacted, however late it comes."""
    writer = clean.writeStream.outputMode("append").foreachBatch(store.batch_writer("event_store", run))
    return _start(writer, "event_store", checkpoint, trigger)


def once_within_watermark(clean: DataFrame) -> DataFrame:
    """Each event id once; what lies behind the watermark is dropped.

    Copies of an id that is sent without end are first thinned out by arrival
    time, in several tasks.
    """
    return (
        clean.withColumn("_salt", salt("kafka_timestamp"))
        .dropDuplicatesWithinWatermark(["event_id", "_salt"])
        .dropDuplicatesWithinWatermark(["event_id"])
        .drop("_salt")
    )


def start_unique_events(
    clean: DataFrame, path: str, checkpoint: str, trigger: Trigger
) -> StreamingQuery:
    """A live copy of the events without repeats, for readers who cannot wait for staging."""
    writer = (
        to_stored(once_within_watermark(clean))
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .partitionBy("event_date")
    )
    return _start(writer, "unique_events", checkpoint, trigger)


def start_dead_letters(
    dead: DataFrame, path: str, checkpoint: str, trigger: Trigger
) -> StreamingQuery:
    """Store dead letters with their reason and the message as it came."""
    writer = dead.writeStream.outputMode("append").format("parquet").option("path", path)
    return _start(writer, "dead_letters", checkpoint, trigger)


def encode_dead_letters(dead: DataFrame) -> DataFrame:
    """Dead letters as JSON text: why, when it arrived, and the message as it came."""
    fields = ["error_reason", F.col("kafka_timestamp").cast("string").alias("arrived_at"), PAYLOAD]
    return dead.select(F.to_json(F.struct(*fields)).alias("value"))


def start_dead_letter_messages(
    dead: DataFrame, kind: str, location: str, checkpoint: str, trigger: Trigger
) -> StreamingQuery:
    """Publish dead letters: to their Kafka topic, or as text files."""
    encoded = encode_dead_letters(dead)
    return _publish(encoded, kind, location, DEAD_LETTER_TOPIC, "dead_letters", checkpoint, trigger)


def start_metrics(
    metrics: DataFrame,
    table: MetricTable,
    name: str,
    checkpoint: str,
    trigger: Trigger,
    run: int = 0,
    mode: str = "update",
) -> StreamingQuery:
    writer = metrics.writeStream.outputMode(mode).foreachBatch(table.batch_writer(name, run))
    return _start(writer, name, checkpoint, trigger)


def encode_metrics(metrics: DataFrame) -> DataFrame:
    """Metric rows as JSON text; times and the number are strings."""
    texts = ("window_start", "window_end", "metric_value")
    names = (
        "window_start",
        "window_end",
        "window_type",
        "metric_name",
        "metric_value",
        "dimension_key",
        "dimension_value",
    )
    fields = [(F.col(n).cast("string") if n in texts else F.col(n)).alias(n) for n in names]
    return metrics.select(F.to_json(F.struct(*fields)).alias("value"))


def start_metric_messages(
    metrics: DataFrame,
    kind: str,
    location: str,
    name: str,
    checkpoint: str,
    trigger: Trigger,
) -> StreamingQuery:
    """Publish metric rows: to a Kafka topic, or as text files, one folder per batch."""
    return _publish(encode_metrics(metrics), kind, location, METRICS_TOPIC, name, checkpoint, trigger)


def _publish(
    encoded: DataFrame,
    kind: str,
    location: str,
    topic: str,
    name: str,
    checkpoint: str,
    trigger: Trigger,
) -> StreamingQuery:
    writer = encoded.writeStream.outputMode("update")
    if kind == "kafka":
        writer = (
            writer.format("kafka")
            .option("kafka.bootstrap.servers", location)
            .option("topic", topic)
        )
    elif kind == "json":
        writer = writer.foreachBatch(
            lambda batch, n: batch.write.mode("overwrite").text(f"{location}/{name}/batch_id={n}")
        )
    else:
        raise ValueError(f"unknown message kind: {kind}")
    return _start(writer, f"messages_{name}", checkpoint, trigger)


def insert_absent(
    incoming: DataFrame, path: str, key: str, unique: str
) -> tuple[int, int]:
    """Append the rows whose key and second unique column are both new.

    Returns (inserted, skipped). Running it again inserts nothing, so a load
    that failed may simply be repeated.
    """
    spark: SparkSession = incoming.sparkSession
    seen = Observation()
    fresh = incoming.observe(seen, F.count(F.lit(1)).alias("n")).filter(F.col(key).isNotNull())
    if files.exists(spark, path):
        table = spark.read.schema(incoming.schema).parquet(path)
        for column in (key, unique):
            fresh = fresh.join(table.select(column), column, "left_anti")
    by_key = Window.partitionBy(key).orderBy(F.col(unique).asc_nulls_last())
    fresh = fresh.withColumn("_place", F.row_number().over(by_key)).filter("_place = 1")
    # A missing unique value clashes with nothing, as in SQL: such rows are told
    # apart by their key and never form one large group.
    alone = F.when(F.col(unique).isNull(), F.col(key))
    by_unique = Window.partitionBy(unique, alone).orderBy(key)
    fresh = fresh.withColumn("_place", F.row_number().over(by_unique)).filter("_place = 1")
    # Both numbers come from the write: neither side is computed twice.
    written = Observation()
    fresh = fresh.select(*incoming.columns).observe(written, F.count(F.lit(1)).alias("n"))
    fresh.write.mode("append").parquet(path)
    inserted = written.get["n"]
    return inserted, seen.get["n"] - inserted
